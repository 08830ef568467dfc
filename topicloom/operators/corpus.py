"""Corpus assembly: category quotas, deduplication and caps over a table of papers.

``papers`` has ``id``, ``published`` and ``categories ARRAY<STRING>``; other columns are
carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.config import TopicConfig
from topicloom.runtime import cut_lineage, lookup_join, top_per_group


def newest_first() -> list[Column]:
    """Latest publication first, id breaking ties."""
    return [F.desc("published"), F.asc("id")]


def from_raw(papers: DataFrame) -> DataFrame:
    """Papers as the operators here expect them, from the table as it is landed.

    Comma-separated ``categories`` become a list (empty where there are none), and a missing
    ``primary_category`` is the first of them.
    """
    out = ensure_categories(papers)
    if out.schema["categories"].dataType.simpleString() == "string":
        names = F.transform(F.split(F.coalesce("categories", F.lit("")), ","), lambda c: F.trim(c))
        out = out.withColumn("categories", F.filter(names, lambda c: c != ""))
    primary = F.nullif(F.trim("primary_category"), F.lit(""))
    return out.withColumn("primary_category", F.coalesce(primary, F.get("categories", F.lit(0))))


def in_category(papers: DataFrame, category: str) -> DataFrame:
    """Papers that list the category anywhere."""
    return papers.where(F.array_contains("categories", category))


def category_quota(max_results: int, n_categories: int, per_query: int = 2000) -> int:
    """Papers requested per category: twice the even share, within the page limit."""
    return min(2 * (max_results // n_categories), max_results, per_query)


def category_candidates(papers: DataFrame, categories: Sequence[str], quota: int) -> DataFrame:
    """Newest ``quota`` papers of each category: ``(id, published, category, rank)``.

    Ranks are taken before the year filter and the deduplication, so a paper that is
    dropped later still uses up its place. An id that occurs several times counts once,
    with its newest date.
    """
    wanted = F.array(*[F.lit(c) for c in categories])
    listed = papers.select(
        "id", "published", F.explode(F.array_intersect("categories", wanted)).alias("category")
    )
    listed = listed.groupBy("id", "category").agg(F.max("published").alias("published"))
    return top_per_group(listed, ["category"], newest_first(), quota, spread="id")


def publication_year(papers: DataFrame) -> DataFrame:
    return papers.withColumn("year", F.year("published"))


def from_year(papers: DataFrame, min_year: int) -> DataFrame:
    return papers.where(F.year("published") >= min_year)


def first_category(listed: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per id: the earliest of ``categories`` keeps the paper; others don't count."""
    priority = {c: i for i, c in enumerate(categories)}
    rank = F.coalesce(*[F.when(F.col("category") == c, F.lit(i)) for c, i in priority.items()])
    best = listed.where(rank.isNotNull()).groupBy("id").agg(F.min(F.struct(rank.alias("priority"), F.col("category"))).alias("first"))
    return best.select("id", F.col("first.category").alias("category"))


def cap(papers: DataFrame, max_results: int, order: list[Column] | None = None) -> DataFrame:
    """First ``max_results`` papers in order: a top-k, not a full sort."""
    return papers.orderBy(*(order or newest_first())).limit(max_results)


def keep_first(papers: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in order, with partial aggregation before the shuffle.

    ``order`` names plain ascending columns, so the first row is a minimum of structs.
    """
    rest = [c for c in papers.columns if c != key]
    first = papers.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("row")
    )
    return first.select(key, *[F.col("row")[c].alias(c) for c in rest]).select(*papers.columns)


def flatten_lists(papers: DataFrame, columns: Sequence[str] = ("authors", "categories")) -> DataFrame:
    """List columns as comma-separated text."""
    return papers.withColumns({c: F.array_join(c, ", ") for c in columns if c in papers.columns})


def short_id(c: Column | str) -> Column:
    """Last segment of a URL path."""
    return F.element_at(F.split(F.col(c) if isinstance(c, str) else c, "/"), -1)


def ensure_categories(papers: DataFrame) -> DataFrame:
    """Add empty category columns where they are missing."""
    missing = [c for c in ("categories", "primary_category") if c not in papers.columns]
    return papers.withColumns({c: F.lit("") for c in missing}) if missing else papers


def collection_totals(papers: DataFrame) -> DataFrame:
    """One row: papers, first and last year."""
    return papers.agg(
        F.count(F.lit(1)).alias("n_papers"), F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )


def largest_categories(papers: DataFrame, n: int = 10) -> DataFrame:
    counts = papers.groupBy("primary_category").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "primary_category").limit(n)


def assemble_corpus(
    papers: DataFrame,
    categories: Sequence[str] | None = None,
    max_results: int | None = None,
    min_year: int | None = None,
    config: TopicConfig = TopicConfig(),
) -> DataFrame:
    """Collect the newest papers of each category in turn, up to ``max_results``.

    Each category asks for one page, its quota; what is left of ``max_results`` can make
    the quota smaller. A paper belongs to the first category whose page shows it.

    Only the candidate ids, at most categories x page size, are kept between the steps;
    the loop reads one count per category.
    """
    categories = list(config.categories if categories is None else categories)
    max_results = config.max_results if max_results is None else max_results
    min_year = config.min_year if min_year is None else min_year
    quota = category_quota(max_results, len(categories), config.max_results_per_category)

    ranked = category_candidates(papers, categories, quota).where(F.year("published") >= min_year)
    places = [
        F.min(F.when(F.col("category") == c, F.col("rank"))).alias(f"place_{i}") for i, c in enumerate(categories)
    ]
    candidates = cut_lineage(ranked.groupBy("id").agg(*places))

    taken: list[Column] = []
    collected = 0
    for i in range(len(categories)):
        page = min(quota, max_results - collected)
        if page <= 0:
            break
        taken.append(F.when(F.col(f"place_{i}") <= page, F.lit(i)))
        collected = candidates.where(F.coalesce(*taken).isNotNull()).count()
    if not taken:
        return papers.limit(0).withColumns({"collected_for": F.lit(""), "year": F.year("published")})

    chosen = candidates.select("id", F.coalesce(*taken).alias("_step")).where(F.col("_step").isNotNull())
    names = F.array(*[F.lit(c) for c in categories])
    found = lookup_join(papers, chosen, "id", how="inner")
    # rows that repeat an id: the newest stays, among equal dates the first by content
    order = [F.desc("published"), *[F.hash(c) for c in papers.columns]]
    kept = (
        found.withColumn("_copy", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
        .where("_copy = 1")
        .drop("_copy")
    )
    return kept.withColumns({"collected_for": F.get(names, F.col("_step")), "year": F.year("published")}).drop("_step")
