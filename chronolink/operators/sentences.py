"""Sections and sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.functions.compose import OPEN, cut_at

# A stop, which stays, with the blank or quote behind it; a line end; a bullet mark.
SENTENCE_END = r'(?=[.:;?!\nB])(?:([.:;?!])[ "]|\n|BULLET::::)'
MIN_SENTENCE = 4


def doc_text(articles: DataFrame) -> Column:
    """An article in the stored form, header and closing tag included."""
    return F.concat(
        F.lit('<doc id="'), F.col("page_id").cast("string"),
        F.lit('" revid="'), F.coalesce(F.col("rev_id").cast("string"), F.lit("None")),
        F.lit('" title="'), F.col("title"), F.lit('">\n'),
        F.col("title"), F.lit("\n\n"), F.col("text"), F.lit("\n\n</doc>\n"),
    )


def split_sentences(text: Column) -> Column:
    """Sentences of a text as an array; those of three characters or less are left out."""
    return F.filter(cut_at(text, SENTENCE_END, f"$1{OPEN}"), lambda s: F.length(s) >= MIN_SENTENCE)


def sentences(articles: DataFrame, whole_doc: bool = False) -> DataFrame:
    """One row per sentence; ``sid`` counts the kept sentences of a page from 0.

    With ``whole_doc`` the header, the title line and the closing tag of the stored form are counted
    too, which gives the numbers of the original CSV files.
    """
    text = doc_text(articles) if whole_doc else F.col("text")
    return articles.select(
        "page_id", F.posexplode(split_sentences(text)).alias("sid", "sentence")
    )


def sections(articles: DataFrame) -> DataFrame:
    """Articles with kept section titles, cut in front of each title."""
    parts = F.split(F.col("text"), r"(?=Section::::)", -1)
    return articles.select("page_id", F.posexplode(parts).alias("section_no", "section"))
