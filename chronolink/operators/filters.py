"""Page filters. All but the rule join are plain predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


CATEGORY_LINE = r"(?m)^\s*\[\[Category:([^|\]\n]+)"
DISAMBIGUATION_LINE = r"(?m)^(?:\{\{disambig(?:uation)?(?:\|[^}]*)?\}\}|__DISAMBIG__)"


def keep_articles(pages: DataFrame) -> DataFrame:
    """Main name space, no redirects."""
    return pages.filter((F.col("ns") == 0) & F.col("redirect_to").isNull())


def drop_disambig(pages: DataFrame) -> DataFrame:
    """Leave out pages with a disambiguation mark at the start of a line."""
    return pages.filter(~F.col("wikitext").rlike(DISAMBIGUATION_LINE))


def filter_id_range(pages: DataFrame, low: int = -1, high: int = -1) -> DataFrame:
    """Keep ids from ``low`` to ``high``; -1 leaves a side open."""
    if low != -1:
        pages = pages.filter(F.col("page_id") >= low)
    if high != -1:
        pages = pages.filter(F.col("page_id") <= high)
    return pages


def min_length(articles: DataFrame, n: int) -> DataFrame:
    """Keep articles whose title and text lines together have at least ``n`` characters."""
    lines = F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    # the title line counts with its line end
    return articles.filter(F.length("title") + 1 + lines >= n)


def category_names(wikitext: Column) -> Column:
    """Distinct category names of a page, in text order."""
    return F.array_distinct(F.regexp_extract_all(wikitext, F.lit(CATEGORY_LINE), F.lit(1)))


def page_categories(pages: DataFrame) -> DataFrame:
    """One row per page and category."""
    return pages.select("page_id", F.explode(category_names(F.col("wikitext"))).alias("category"))


def filter_categories(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Keep a row if it has an included category (or none is asked for) and no excluded one.

    ``rules`` has the columns category and mode (``include`` or ``exclude``), of any number. Each row is
    decided by its own text; a null text has no categories. Rules are applied to the distinct sets of
    categories, without page text, and the sets that pass select the rows: where they are few, AQE
    broadcasts them and pages stay where they are.
    """
    named = F.coalesce(F.array_sort(category_names(F.col("wikitext"))), F.array().cast("array<string>"))
    sets = pages.select(named.alias("_categories")).distinct()
    hits = (
        sets.select("_categories", F.explode_outer("_categories").alias("category"))
        .join(rules.select("category", "mode"), "category", "left")
        .groupBy("_categories")
        .agg(
            F.coalesce(F.max(F.col("mode") == "include"), F.lit(False)).alias("included"),
            F.coalesce(F.max(F.col("mode") == "exclude"), F.lit(False)).alias("excluded"),
        )
    )
    if not rules.filter(F.col("mode") == "include").isEmpty():
        hits = hits.filter("included")
    passing = hits.filter("NOT excluded").select("_categories")
    return pages.withColumn("_categories", named).join(passing, "_categories", "left_semi").drop("_categories")
