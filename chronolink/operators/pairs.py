"""Mentions and link-date pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronolink.functions.compose import OPEN, cut_at, is_match, let
from chronolink.functions.dates import (
    ANCHOR,
    TAGS,
    TIMEX,
    date_kind,
    merge_intervals,
    normalize_date,
    year_range,
)

_MENTION = rf"{ANCHOR}|{TIMEX}"
_UNTITLED_ANCHOR = r'<a href=" *">[^\n]*?</a>'


def clean_sentence(sentence: Column) -> Column:
    """The sentence without anchor and date tags."""
    return F.regexp_replace(sentence, TAGS, "")


def mentions(sentences: DataFrame) -> DataFrame:
    """Links and dates of tagged sentences in text order; intervals are merged first."""
    hits = F.regexp_extract_all(merge_intervals(F.col("sentence")), F.lit(_MENTION), F.lit(0))
    m = F.col("mention")
    is_link = m.startswith("<a ")
    return sentences.select(
        "page_id", "sid", F.posexplode(hits).alias("pos", "mention")
    ).select(
        "page_id",
        "sid",
        "pos",
        F.when(is_link, "link").otherwise("date").alias("kind"),
        F.when(is_link, F.regexp_extract(m, ANCHOR, 1)).alias("link"),
        F.when(~is_link, F.regexp_extract(m, TIMEX, 1)).alias("value"),
        F.when(~is_link, F.regexp_extract(m, TIMEX, 2)).alias("surface"),
    )


def pair_dates(sentences: DataFrame) -> DataFrame:
    """Every link with the dates that follow it in its sentence, before the next link.

    Row-local: the sentence is cut at its links, so there is no exchange and it also runs on streams.
    ``link_ord`` counts the links of a sentence from 1.
    """

    def dates_in(tail: Column) -> Column:
        values = F.regexp_extract_all(tail, F.lit(TIMEX), F.lit(1))
        return F.filter(F.transform(values, normalize_date), lambda date: date.isNotNull())

    def groups(s: Column) -> Column:
        def cut(pieces: Column) -> Column:
            def pair(piece: Column, i: Column) -> Column:
                tail = F.get(pieces, i + 1)
                return F.struct(
                    F.shiftright(i + 1, 1).alias("link_ord"),
                    piece.alias("link"),
                    F.when(is_match(i) & tail.contains("<TIMEX3 "), dates_in(tail)).alias("dates"),
                )

            return F.transform(pieces, pair)

        # titles and the texts behind their links take turns
        return F.filter(let(cut_at(s, ANCHOR, f"{OPEN}$1{OPEN}"), cut), lambda pair: F.size(pair["dates"]) > 0)

    def titled(s: Column) -> Column:
        untitled = s.contains('<a href=""') | s.contains('<a href=" ')
        return F.when(untitled, F.regexp_replace(s, _UNTITLED_ANCHOR, "")).otherwise(s)

    merged = let(merge_intervals(F.col("sentence")), titled)
    # a sentence without both tags cannot give a pair
    candidates = sentences.filter(
        F.col("sentence").contains("<a href=") & F.col("sentence").contains("<TIMEX3 ")
    )
    return candidates.select(
        "page_id",
        "sid",
        clean_sentence(F.col("sentence")).alias("sentence"),
        F.explode(groups(merged)).alias("pair"),
    ).select(
        "page_id",
        "sid",
        F.col("pair.link_ord").alias("link_ord"),
        F.col("pair.link").alias("link"),
        F.col("pair.dates").alias("dates"),
        "sentence",
    )


def pair_mentions(mentions: DataFrame) -> DataFrame:
    """The same pairs from a table of mentions: each date goes to the nearest link before it.

    One exchange on (page_id, sid); the aggregation reuses the partitioning of the window. A group is
    one sentence.
    """
    w = W.partitionBy("page_id", "sid").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    is_link = (F.col("kind") == "link") & (F.col("link") != "")
    return (
        mentions.withColumn("link_ord", F.count_if(is_link).over(w).cast("int"))
        .withColumn("link", F.last(F.when(is_link, F.col("link")), ignorenulls=True).over(w))
        .withColumn("date", normalize_date(F.col("value")))
        .filter((F.col("link_ord") > 0) & F.col("date").isNotNull())
        .groupBy("page_id", "sid", "link_ord")
        .agg(
            F.first("link").alias("link"),
            F.array_sort(F.collect_list(F.struct("pos", "date"))).alias("dated"),
        )
        .select("page_id", "sid", "link_ord", "link", F.col("dated.date").alias("dates"))
    )


def pair_years(pairs: DataFrame) -> DataFrame:
    """One row per link and date, with the kind of the date and the years it spans."""
    exploded = pairs.select("page_id", "sid", "link_ord", "link", F.explode("dates").alias("date"))
    years = year_range(F.col("date"))
    return exploded.withColumns(
        {
            "kind": date_kind(F.col("date")),
            "from_year": years["from_year"],
            "to_year": years["to_year"],
        }
    )


def date_kind_counts(pairs: DataFrame) -> DataFrame:
    """How many dates of each kind a linked title has."""
    return (
        pairs.select("link", F.explode("dates").alias("date"))
        .groupBy("link", date_kind(F.col("date")).alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def link_timeline(pairs: DataFrame) -> DataFrame:
    """Dates per kind and century (of their first year), with subtotals per kind and a grand total."""
    years = pair_years(pairs)
    century = F.floor(F.col("from_year") / 100).cast("int")
    return (
        years.select("link", "kind", century.alias("century"))
        .rollup("kind", "century")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("link").alias("links"))
    )
