import corpus_pipeline
from chronolink.llm import pii, simhash, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    """Each stage against what it should do to the rows it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "suffix_dedup", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = stage(spark, docs, SF)
        rows = after.collect()
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert {r.doc_id for r in rows} == {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0}
        elif name == "simhash":
            assert sorted(r.doc_id for r in rows) == sorted({r.component_id for r in simhash.near_duplicates(docs).collect()})
        elif name == "suffix_dedup":
            cut = {r.doc_id: r for r in suffix_dedup.dedup(docs, with_text=True).collect()}
            assert len(rows) == len(before) and all(r.text == (cut[r.doc_id].kept if cut[r.doc_id].n_removed else before[r.doc_id].text) for r in rows)
        elif name == "pii":
            clean = [r for r in pii.detect(docs).collect() if not r.spans]
            now = {r.doc_id: r.text for r in rows}
            assert len(now) == len(before) and all(now[r.doc_id] == r.text for r in clean)
            assert all(now[i] != r.text for i, r in before.items() if i not in {c.doc_id for c in clean})
        if name != "packing":
            assert after.columns == columns and all(r.n_chars == len(r.text) for r in rows)
            docs = spark.createDataFrame(rows, after.schema)
        else:
            assert {r.doc_id for r in rows} == set(before)


def test_run_and_odd_documents(spark, messy, documents):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for docs in (messy, documents([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            rows = out.count()
            assert rows <= docs.count() or name == "packing"


def test_rows_without_ids_and_ids_with_two_texts(spark, documents):
    """Rows that are no near copies stay, whatever their ids are; of near copies one row stays."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(k)) for k in range(10)] + [(None, text(3)), (7, text(20)), (7, text(21)), (8, text(21)), (9, text(0))]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, documents(rows), SF).collect()]
    want = [(None, text(k)) for k in range(1, 10)] + [(7, text(20)), (7, text(21)), (9, text(0))]
    assert len(got) == len(want) and set(got) == set(want)
