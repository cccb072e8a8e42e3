"""Headings and numbered list items as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolink.functions.lines import BULLET, compact_lines, heading_lines


def headings(pages: DataFrame, column: str = "wikitext") -> DataFrame:
    """One row per heading; ``filled`` says whether it has content before the next one that ends it."""
    return pages.select(
        "page_id", F.posexplode(heading_lines(F.col(column))).alias("heading_no", "h")
    ).select("page_id", "heading_no", "h.level", "h.title", "h.filled")


def list_items(pages: DataFrame, column: str = "wikitext") -> DataFrame:
    """One row per list item of a page, in text order, with its bullet or number."""
    pattern = rf"(?md)^{BULLET}(-|\d+\.) ([^\n]*)$"
    hits = F.regexp_extract_all(compact_lines(F.col(column)), F.lit(pattern), F.lit(0))
    return pages.select("page_id", F.posexplode(hits).alias("item_no", "item")).select(
        "page_id",
        "item_no",
        F.regexp_extract("item", pattern, 1).alias("marker"),
        F.regexp_extract("item", pattern, 2).alias("item"),
    )
