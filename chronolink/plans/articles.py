"""The extract jobs as compositions of column steps: pages -> articles -> tagged text -> pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.functions.compose import replace_where
from chronolink.functions.dates import tag_dates
from chronolink.functions.lines import BULLET, compact_lines
from chronolink.functions.markup import cleaning_steps
from chronolink.operators.pairs import pair_dates
from chronolink.operators.sentences import sentences


def apply_steps(
    df: DataFrame, steps: Iterable[Callable[[Column], Column]], column: str = "text"
) -> DataFrame:
    """Run column steps one after the other. Each is a projection of its own for the analyzer; the
    optimizer folds them into one."""
    for step in steps:
        df = df.withColumn(column, step(F.col(column)))
    return df


def clean_text(
    pages: DataFrame,
    keep_sections: bool = False,
    keep_lists: bool = True,
    **switches,
) -> DataFrame:
    """Pages to articles: ``page_id, rev_id, title, text``. One projection, no exchange.

    ``switches`` are those of ``markup.cleaning_steps``: keep_links, keep_tables, accepted,
    encode_links, ignored_tags, discarded_elements, protect_nowiki.
    """
    articles = pages.select("page_id", "rev_id", "title", F.col("wikitext").alias("text"))
    return apply_steps(
        articles,
        [*cleaning_steps(**switches), lambda x: compact_lines(x, keep_sections, keep_lists)],
    )


def tag_articles(articles: DataFrame) -> DataFrame:
    """List items become sentences, dates become TIMEX3 elements; this text is what gets stored."""
    prose = replace_where(F.col("text"), BULLET, rf"{BULLET}([^\n]*)(?:\n|\z)", "$1.\n")
    return articles.withColumn("text", tag_dates(prose))


def extract_pairs(pages: DataFrame, whole_doc: bool = False) -> DataFrame:
    """The main job: which linked titles go with which dates, sentence by sentence."""
    return pair_dates(sentences(tag_articles(clean_text(pages)), whole_doc=whole_doc))
