"""Rule files, word lists, phrase lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_category_rules(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``category, mode``: ``^`` excludes, anything else includes; comments and blank lines are skipped."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    excluded = F.col("line").startswith("^")
    return (
        spark.read.text(path)
        .select(line.alias("line"))
        .filter((F.col("line") != "") & ~F.col("line").startswith("#"))
        .select(
            F.regexp_replace("line", r"^\^+", "").alias("category"),
            F.when(excluded, "exclude").otherwise("include").alias("mode"),
        )
        .distinct()
    )


def read_word_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``word``: one entry per line, trimmed; comments and blank lines are skipped."""
    return (
        spark.read.text(path)
        .select(F.regexp_replace("value", r"^[ \t\r\n]+|[ \t\r\n]+$", "").alias("word"))
        .filter((F.col("word") != "") & ~F.col("word").startswith("#"))
        .distinct()
    )


def read_phrases(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``phrase, tags``: tab-separated; of equal phrases one entry is kept."""
    return (
        spark.read.option("sep", "\t")
        .option("quote", "")
        .schema("phrase STRING, tags STRING")
        .csv(path)
        .filter(F.trim("phrase") != "")
        .groupBy(F.regexp_replace(F.trim("phrase"), r"\s+", " ").alias("phrase"))
        .agg(F.max("tags").alias("tags"))
    )
