"""Versions of a table, files in ranges of ids, counters inside a job."""

import pytest
from pyspark.sql import functions as F

from chronolink.operators import filters, pages
from chronolink.sinks import versions, writers


def values(df):
    return sorted(r.v for r in df.collect())


def test_a_reader_sees_one_version(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.versions(spark, root) == {}
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    numbers = spark.range(50).select(F.col("id").alias("v"))
    assert versions.write_version(numbers, root) == 1
    reader = versions.read_version(spark, root)
    # the new version is made from the old one, and the reader goes on
    assert versions.write_version(reader.filter("v < 5").withColumn("v", F.col("v") + 100), root) == 2
    assert values(reader) == list(range(50))
    assert values(versions.read_version(spark, root)) == [100, 101, 102, 103, 104]
    assert values(versions.read_version(spark, root, 1)) == list(range(50))


def test_what_is_not_committed_is_not_read(spark, tmp_path):
    """A writer that fails, or that comes second, leaves readers with what was there."""
    root = str(tmp_path / "t")
    numbers = spark.range(3).select(F.col("id").alias("v"))
    versions.write_version(numbers, root)
    failing = numbers.withColumn("v", F.when(F.col("v") < 2, F.col("v")).otherwise(F.raise_error(F.lit("stop")).cast("long")))
    with pytest.raises(Exception, match="stop"):
        versions.write_version(failing, root)
    assert values(versions.read_version(spark, root)) == [0, 1, 2] and list(versions.versions(spark, root)) == [1]
    versions.write_version(numbers.filter("v = 1"), root, expected=1)
    with pytest.raises(FileExistsError):
        versions.write_version(numbers.filter("v = 2"), root, expected=1)
    assert values(versions.read_version(spark, root)) == [1] and list(versions.versions(spark, root)) == [1, 2]


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(5):
        versions.write_version(spark.range(k, k + 1).select(F.col("id").alias("v")), root)
    assert versions.drop_versions(spark, root, keep=2) == [1, 2, 3]
    assert sorted(versions.versions(spark, root)) == [4, 5] and values(versions.read_version(spark, root)) == [4]
    assert values(versions.read_version(spark, root, 4)) == [3]
    assert versions.drop_versions(spark, root, keep=2) == [] and versions.write_version(spark.range(1).select(F.col("id").alias("v")), root) == 6


def scanned_rows(df):
    """Rows that the scans of a plan gave out when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        inner = leaf.plan() if leaf.nodeName().startswith("ResultQueryStage") else leaf
        found = inner.collectLeaves()
        for k in range(found.size()):
            metric = found.apply(k).metrics().get("numOutputRows")
            total += metric.get().value() if metric.isDefined() else 0
    return total


def test_a_range_skips_groups_of_rows(spark, tmp_path):
    """Of 20,000 pages in random order a range of 50 reads a small part; without ranges, nearly all."""
    rows = spark.range(20_000).select(
        F.xxhash64("id").alias("order"), F.col("id").alias("page_id"), F.repeat(F.md5(F.col("id").cast("string")), 20).alias("text")
    ).orderBy("order").drop("order")
    rows.write.option("parquet.block.size", 1 << 16).parquet(str(tmp_path / "mixed"))
    writers.write_clustered(rows, str(tmp_path / "ranges"), group_bytes=1 << 16)
    mixed, ranges = (filters.filter_id_range(spark.read.parquet(str(tmp_path / n)), 7000, 7049) for n in ("mixed", "ranges"))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, ranges.collect())) and ranges.count() == 50
    few, many = scanned_rows(ranges), scanned_rows(mixed)
    assert 50 <= few < 2_000 and few * 5 < many


def test_counters_come_with_the_job(spark, page):
    table = page("a", "{{disambig}}", "c", None).unionByName(page("x", ns=10)).unionByName(page("#REDIRECT [[A]]").withColumn("redirect_to", F.lit("A")))
    seen, counters = pages.counted(table, "one")
    assert filters.keep_articles(seen).count() == 4
    assert counters.get == pages.corpus_stats(table).first().asDict()
    nothing, counters = pages.counted(table.limit(0), "two")
    assert nothing.count() == 0 and counters.get == {"pages": 0, "articles": 0, "kept": 0}
