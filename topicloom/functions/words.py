"""Word lists used by the text expressions."""

# English stopwords. Entries with apostrophes are left out, since cleaned
# text holds none.
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn
    hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Words that every abstract uses.
DOMAIN_STOPWORDS = tuple(
    """
    abstract paper propose proposed method approach result results show demonstrate
    present study work presented proposal novel new algorithm framework model models
    learning learn learned training data dataset datasets experiment experimental
    evaluation evaluate performance improve improvement problem problems solution
    solutions task tasks using use used based base bases provide provides proposes
    introduce introduces introduction develop develops development
    """.split()
)

# Words in s that are no plurals, which no ending tells apart.
NO_PLURALS = tuple(
    """
    always perhaps whereas besides sometimes towards afterwards backwards upwards thus hence
    across unless plus versus alas pancreas atlas alias bias canvas gas texas christmas chaos
    cosmos ethos pathos asbestos kudos news series species lens headquarters
    """.split()
)

# Endings of sciences, which are singular.
SCIENCE_ENDINGS = ("dynamics", "matics", "physics", "nomics", "omics", "istics", "onics", "botics")

# Plurals that the suffix rules get wrong.
IRREGULAR_PLURALS = {
    "alias": "alias",
    "aliases": "alias",
    "analyses": "analysis",
    "analytics": "analytics",
    "atlas": "atlas",
    "axes": "axis",
    "bias": "bias",
    "biases": "bias",
    "caches": "cache",
    "canvas": "canvas",
    "chaos": "chaos",
    "children": "child",
    "corpora": "corpus",
    "crises": "crisis",
    "criteria": "criterion",
    "dynamics": "dynamics",
    "economics": "economics",
    "feet": "foot",
    "gas": "gas",
    "gases": "gas",
    "geese": "goose",
    "genomics": "genomics",
    "graphics": "graphics",
    "headaches": "headache",
    "heuristics": "heuristic",
    "hypotheses": "hypothesis",
    "indices": "index",
    "lens": "lens",
    "lenses": "lens",
    "linguistics": "linguistics",
    "lives": "life",
    "logistics": "logistics",
    "mathematics": "mathematics",
    "matrices": "matrix",
    "mechanics": "mechanics",
    "men": "man",
    "mice": "mouse",
    "news": "news",
    "niches": "niche",
    "phenomena": "phenomenon",
    "physics": "physics",
    "robotics": "robotics",
    "semantics": "semantics",
    "series": "series",
    "species": "species",
    "statistics": "statistics",
    "syntheses": "synthesis",
    "teeth": "tooth",
    "theses": "thesis",
    "vertices": "vertex",
    "wives": "wife",
    "wolves": "wolf",
    "women": "woman",
}
