"""Stored documents back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_END = "</doc>\n"
# Header attributes, then everything up to the end of the block.
_DOC = r'(?s)<doc id="(\d*)"(?: revid="(\d*)")?[^\n]* title="([^>]*)">\n(.*)$'


def _blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", DOC_END).text(path).filter(F.col("value").contains("<doc id="))


def read_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Blocks (``value``) that ``read_docs`` cannot read."""
    return _blocks(spark, path).filter(~F.col("value").rlike(_DOC))


def read_docs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Articles out of ``<doc ..> .. </doc>`` blocks. The block end separates records, so big files
    are read by many tasks. The title line is not part of the text. Blocks whose header cannot be read
    are left out; ``read_rejects`` returns them."""
    text = F.substring(F.col("body"), F.length("title") + 3, F.length("body"))
    return (
        _blocks(spark, path)
        .filter(F.col("value").rlike(_DOC))
        .select(
            F.regexp_extract("value", _DOC, 1).try_cast("bigint").alias("page_id"),
            F.regexp_extract("value", _DOC, 2).try_cast("bigint").alias("rev_id"),
            F.regexp_extract("value", _DOC, 3).alias("title"),
            F.regexp_extract("value", _DOC, 4).alias("body"),
        )
        .select("page_id", "rev_id", "title", F.regexp_replace(text, r"\n\n\z", "").alias("text"))
    )
