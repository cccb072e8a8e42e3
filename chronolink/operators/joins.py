"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.session import stored

#: A key is heavy if it has more than one in ``PARTS`` of all rows, so fewer than ``PARTS`` keys are.
PARTS = 256


def heavy_keys(rows: DataFrame, on: str, parts: int = PARTS) -> DataFrame:
    """``(on, _salts)``: the heavy keys of ``rows`` and over how many places each is to be spread.

    Rows are counted by key, combined before the shuffle; the result has fewer than ``parts`` rows whatever comes in.
    """
    counts = stored(rows.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n")), "keys")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    salts = F.ceil(F.col("_n") * parts / F.lit(max(1, total))).cast("int")
    return counts.filter(F.col("_n") * parts > total).select(on, salts.alias("_salts"))


def spread_rows(rows: DataFrame, heavy: DataFrame, on: str, spread_by: list[str | Column], parts: int = PARTS) -> DataFrame:
    """``rows`` with ``_salt``: 0, but for rows of heavy keys, which go by a hash of ``spread_by`` that a repeated task
    computes alike. Rows without a key find nothing wherever they are and go anywhere."""
    place = F.xxhash64(*spread_by)
    salt = F.when(F.col(on).isNull(), F.pmod(place, F.lit(parts))).otherwise(F.pmod(place, F.coalesce("_salts", F.lit(1))))
    return rows.join(F.broadcast(heavy), on, "left").withColumn("_salt", salt.cast("int")).drop("_salts")


def repeat_lookup(lookup: DataFrame, heavy: DataFrame, on: str) -> DataFrame:
    """``lookup`` with ``_salt``: once, but for heavy keys, which stand in every place their rows may be in."""
    places = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return lookup.join(F.broadcast(heavy), on, "left").withColumn("_salt", F.explode(places)).drop("_salts")


def spread_join(
    rows: DataFrame, lookup: DataFrame, on: str, spread_by: list[str | Column], how: str = "left", parts: int = PARTS
) -> DataFrame:
    """Join ``rows`` with a lookup table that has one row per key, or a few; heavy keys are found by counting.

    AQE splits skewed partitions only where a join reads its shuffles directly, which an aggregated lookup
    table prevents. Only what belongs to heavy keys is repeated; the table of heavy keys is broadcast.
    """
    heavy = heavy_keys(rows, on, parts)
    keyed = spread_rows(rows, heavy, on, spread_by, parts)
    return keyed.join(repeat_lookup(lookup, heavy, on), [on, "_salt"], how).drop("_salt")
