from pyspark.sql import functions as F

from chronolink.operators.filters import keep_articles
from chronolink.plans.corpus import corpus
from chronolink.streaming import streams

SF = "/root/testdata/sf0.001"


def test_seeded_state_has_an_entry_per_bucket(spark, tmp_path, monkeypatch):
    """However many revisions there are, the state is looked at once per bucket; null keys are keys."""
    monkeypatch.setattr(streams, "BUCKETS", 4)
    pages = keep_articles(corpus(spark, SF)).limit(80).withColumns({
        "page_id": F.expr("CASE WHEN page_id % 7 <> 0 THEN page_id END"), "rev_id": F.expr("CASE WHEN page_id % 3 <> 0 THEN rev_id END"),
    }).cache()
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    pages.unionByName(pages).coalesce(1).write.parquet(path)
    source = spark.readStream.schema(pages.schema).parquet(path)
    stored = pages.filter("page_id % 2 = 0").select("rev_id", "page_id", "title")
    with streams._setting(spark, streams._PROVIDER, streams._ROCKSDB):
        query = streams._start(streams.fresh_pages(source, stored), out, state)
    query.awaitTermination()
    expected = pages.select("page_id", "rev_id").distinct().exceptAll(stored.select("page_id", "rev_id").distinct())
    found = spark.read.parquet(out)
    assert found.columns == pages.columns
    assert sorted(map(repr, found.select("page_id", "rev_id").collect())) == sorted(map(repr, expected.collect()))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4
