"""Rows that no operator may stumble over."""

SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 700} and{i % 13} the" for i in range(6000))
ODD_ROWS = [
    (1, None, None, None, None, "x"),
    (2, "", "en", "s", 0, "x"),
    (3, " \t\n\x0b\x0c\r ", "en", "s", 7, "x"),
    (4, "one", "en", None, 3, "x"),
    (5, "one two", "fr", "s", 7, "x"),
    (6, LONG, "en", "s", len(LONG), "x"),
    (7, LONG, "en", "s", len(LONG), "x"),
    (8, LONG + " tail", "en", "s", None, "x"),
    (8, LONG + " tail", "en", "s", None, "x"),
    (None, "no id here at all", "en", "s", 4, "x"),
    (9, "日本語 ﬁ ß 😀 <|endoftext|> a b é́", "de", "s", 9, "x"),
    (10, "ONE", "en", "s", 3, "x"),
]
#: Names that operators use themselves.
CLASHES = [
    "row", "words", "n_words", "stratum", "kept", "score", "bands", "set_key", "rep", "h", "w", "ids", "y", "part",
    "cutoffs", "sentences",
]
