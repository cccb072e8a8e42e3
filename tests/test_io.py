import bz2
import glob
import gzip

import pytest
from pyspark.sql import functions as F

from chronolink.operators.filters import keep_articles
from chronolink.plans.articles import clean_text, extract_pairs
from chronolink.plans.corpus import corpus
from chronolink.sinks import writers
from chronolink.sources import docs, dump, lists
from chronolink.streaming import streams

SF = "/root/testdata/sf0.001"
DUMP = """<mediawiki>
<siteinfo><base>https://en.example.org/wiki/Main</base><namespaces>
<namespace key="-2" case="first-letter">Media</namespace>
<namespace key="0" case="first-letter" />
<namespace key="10" case="first-letter">Template</namespace></namespaces></siteinfo>
<page><title>Alpha &amp; Co</title><ns>0</ns><id>1</id><revision><id>11</id><contributor><username>u</username><id>99</id></contributor>
<text xml:space="preserve">
 A [[Beta|b]]s in 1999 &lt;ref&gt;x&lt;/ref&gt; &amp;nbsp;.
* item [[Gamma]] 2001
[[Category:X]]
</text></revision></page>
<page><title>Red</title><ns>0</ns><id>2</id><redirect title="Alpha" /><revision><id>12</id>
<text xml:space="preserve">#REDIRECT [[Alpha]]</text></revision></page>
<page><title>Empty</title><ns>0</ns><id>3</id><revision><id>13</id><text xml:space="preserve" /></revision></page>
<page><title>Broken</title><ns>0</ns><id>4</id><revision><id>14<text>x</revision></page>
<page><title>Plain</title><ns>0</ns><id>5</id><revision><id>15</id><text>no attribute</text></revision></page>
</mediawiki>
"""


@pytest.fixture(params=["xml", "bz2", "gz"])
def dump_path(request, tmp_path):
    path = tmp_path / f"dump.xml{'' if request.param == 'xml' else '.' + request.param}"
    opener = {"xml": open, "bz2": bz2.open, "gz": gzip.open}[request.param]
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(DUMP)
    return str(path)


def test_dump(spark, dump_path):
    rows = {r.page_id: r for r in dump.read_dump(spark, dump_path).collect()}
    assert sorted(rows) == [1, 2, 3, 5]  # the broken page is left out
    first = rows[1]
    assert (first.rev_id, first.title, first.ns, first.redirect_to) == (11, "Alpha & Co", 0, None)
    assert first.wikitext == (
        "\n A [[Beta|b]]s in 1999 <ref>x</ref> &nbsp;.\n* item [[Gamma]] 2001\n[[Category:X]]\n"
    )
    assert rows[2].redirect_to == "Alpha" and rows[3].wikitext == "" and rows[5].wikitext == "no attribute"
    assert [r.page_id for r in keep_articles(dump.read_dump(spark, dump_path)).orderBy("page_id").collect()] == [1, 3, 5]


def test_broken_pages_can_be_looked_at(spark, dump_path):
    broken = dump.read_elements(spark, dump_path).filter("_corrupt_record IS NOT NULL").collect()
    assert len(broken) == 1 and "Broken" in broken[0]._corrupt_record


def test_siteinfo(spark, dump_path):
    assert sorted((r.ns_key, r.ns_name) for r in dump.read_namespaces(spark, dump_path).collect()) == [
        (-2, "Media"), (0, ""), (10, "Template"),
    ]
    assert [r.urlbase for r in dump.read_urlbase(spark, dump_path).collect()] == ["https://en.example.org/wiki"]


@pytest.mark.parametrize("compression", [None, "bzip2"])
def test_one_big_file_is_read_by_many_tasks(spark, tmp_path, compression):
    pages = corpus(spark, SF)
    noise = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat(i.cast("string"), F.col("title")), 512)), " ")
    pages = pages.withColumn("wikitext", F.concat("wikitext", F.lit("\n"), noise))
    writers.write_dump(pages.coalesce(1), str(tmp_path), {0: "", 10: "Template"}, "https://x/Main", compression)
    assert len(glob.glob(f"{tmp_path}/part-*")) == 1
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1024 * 1024))
    try:
        read = dump.read_dump(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 2
        assert read.exceptAll(pages).isEmpty() and read.count() == pages.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_docs(spark, tmp_path, page):
    articles = clean_text(page("A [[B|c]] 1999.\n\n* x", "second & \"q\"", ""))
    writers.write_docs(articles, str(tmp_path / "docs"), max_records=1, compression="bzip2", ordered=True)
    back = docs.read_docs(spark, str(tmp_path / "docs"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, articles.collect()))
    writers.write_docs(articles, str(tmp_path / "bare"), with_revision=False)
    assert {r.rev_id for r in docs.read_docs(spark, str(tmp_path / "bare")).collect()} == {None}


def test_json(spark, tmp_path, page):
    writers.write_json(clean_text(page("x")), str(tmp_path / "j"), "https://x/wiki")
    row = spark.read.json(str(tmp_path / "j")).first()
    assert (row.id, row.url, row.title, row.text, row.revid) == ("0", "https://x/wiki?curid=0", "Page 0", "Page 0\n\nx", "0")


def test_pair_lines_are_escaped(spark, tmp_path):
    pairs = spark.createDataFrame(
        [(1, 2, 1, "A;b", ["1999", "[1990,1995]"], "x\\y; \"z\"")],
        "page_id BIGINT, sid INT, link_ord INT, link STRING, dates ARRAY<STRING>, sentence STRING",
    )
    expected = 'artid=1;senid=2;link=A\\;b;dates=[1999,[1990,1995]];sentence=x\\\\y\\; "z"'
    assert writers.format_pairs(pairs).first().line == expected
    writers.write_pairs(pairs, str(tmp_path / "p"))
    written = b""
    for part in glob.glob(str(tmp_path / "p" / "part-*")):
        with open(part, "rb") as f:
            written += f.read()
    assert written.decode() == expected + "\r\n"


def test_output_files_are_bounded_and_ordered(spark, tmp_path):
    pairs = extract_pairs(keep_articles(corpus(spark, SF)))
    writers.write_pairs(pairs, str(tmp_path / "p"), max_records=500, ordered=True)
    written = []
    for part in sorted(glob.glob(str(tmp_path / "p" / "part-*"))):
        with open(part, encoding="utf-8", newline="") as f:
            found = [int(line.split(";")[0].removeprefix("artid=")) for line in f.read().split("\r\n") if line]
        assert len(found) <= 500 and found == sorted(found)
        written.append((found[0], found[-1]))
    assert written == sorted(written)


def test_overwriting_replaces_all(spark, tmp_path, page):
    target = str(tmp_path / "d")
    writers.write_docs(clean_text(page("a", "b")), target)
    writers.write_docs(clean_text(page("c")), target)
    assert docs.read_docs(spark, target).count() == 1


def test_lists(spark, tmp_path):
    (tmp_path / "rules").write_text("# note\n\n^Out\n  In  \nIn\n^^Twice\n")
    assert sorted(map(tuple, lists.read_category_rules(spark, str(tmp_path / "rules")).collect())) == [
        ("In", "include"), ("Out", "exclude"), ("Twice", "exclude"),
    ]
    (tmp_path / "words").write_text("# note\n\n etc. \r\nMr\n")
    assert sorted(r.word for r in lists.read_word_list(spark, str(tmp_path / "words")).collect()) == ["Mr", "etc."]
    (tmp_path / "phrases").write_text('as  well\tRB\n\n"in" front of\tIN NN IN\n')
    assert sorted(map(tuple, lists.read_phrases(spark, str(tmp_path / "phrases")).collect())) == [
        ('"in" front of', "IN NN IN"), ("as well", "RB"),
    ]


def test_dump_stream_gives_the_batch_result(spark, tmp_path):
    pages = corpus(spark, SF)
    parts = str(tmp_path / "parts")
    writers.write_dump(pages.repartition(4, "page_id"), parts, {0: ""}, "https://x/Main", "bzip2")
    source = keep_articles(dump.stream_dump(spark, parts, max_files_per_trigger=1))
    found = streams.run_to_end(spark, lambda p, c: streams.stream_pairs(source, p, c), "t")
    expected = extract_pairs(keep_articles(pages))
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def test_stream_dedupe_with_bounded_state(spark, tmp_path):
    pages = corpus(spark, SF).select("page_id", "rev_id").withColumn("seen", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    path = str(tmp_path / "in")
    pages.unionByName(pages).repartition(3).write.parquet(path)
    source = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = streams.run_to_end(spark, lambda p, c: streams.stream_dedupe(source, p, c, "seen", "1 hour"), "t")
    assert found.count() == pages.count() and found.exceptAll(pages).isEmpty()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    pages = keep_articles(corpus(spark, SF))
    path = str(tmp_path / "in")
    pages.write.parquet(path)
    stored = pages.filter("page_id % 2 = 0").select("page_id", "rev_id")
    out = str(tmp_path / "out")
    for checkpoint in ("c1", "c2"):  # the second run starts over, as after a lost checkpoint
        source = spark.readStream.schema(pages.schema).parquet(path)
        streams.stream_incremental(source, stored, out, str(tmp_path / checkpoint)).awaitTermination()
    found = spark.read.parquet(out).drop("run", "batch_id")
    expected = extract_pairs(pages.filter("page_id % 2 = 1"))
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def test_a_revision_in_two_batches_and_a_new_checkpoint(spark, tmp_path):
    """Extracted once, and what an older checkpoint wrote stays."""
    pages = keep_articles(corpus(spark, SF)).limit(40).cache()
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages.coalesce(1).write.parquet(path)
    pages.coalesce(1).write.mode("append").parquet(path)
    stored = pages.limit(0).select("page_id", "rev_id")
    source = lambda: spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(path)
    streams.stream_incremental(source(), stored, out, str(tmp_path / "c1")).awaitTermination()
    more = pages.withColumn("page_id", F.col("page_id") + 1_000_000)
    more.coalesce(1).write.mode("append").parquet(path)
    streams.stream_incremental(source(), stored, out, str(tmp_path / "c2")).awaitTermination()
    found = spark.read.parquet(out).drop("run", "batch_id")
    expected = extract_pairs(pages.unionByName(more))
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def test_seeded_state_outlives_the_table_it_came_from(spark, tmp_path):
    """Over three batches and a restart: stored keys count once the table is empty, repeated revisions go through once."""
    pages = keep_articles(corpus(spark, SF)).limit(60).cache()
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    pages.coalesce(1).write.parquet(path)
    pages.unionByName(pages).coalesce(1).write.mode("append").parquet(path)
    source = lambda: spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stored = pages.filter("page_id % 2 = 0").select("rev_id", "page_id", "title")
    streams.stream_seeded(source(), stored.unionByName(stored), out, state).awaitTermination()
    newer = pages.withColumn("rev_id", F.col("rev_id") + 1)
    newer.unionByName(pages).coalesce(1).write.mode("append").parquet(path)
    streams.stream_seeded(source(), stored.limit(0), out, state).awaitTermination()
    found = spark.read.parquet(out)
    expected = extract_pairs(pages.filter("page_id % 2 = 1").unionByName(newer))
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_dump_parts_are_documents(spark, tmp_path):
    import xml.etree.ElementTree as ET

    pages = corpus(spark, SF).limit(50)
    writers.write_dump(pages.repartition(3), str(tmp_path / "d"), {0: "", 10: "Te<mp & late"}, "https://x/a&b/Main")
    found = [ET.parse(f).getroot() for f in glob.glob(f"{tmp_path}/d/part-*")]
    assert all(root.tag == "mediawiki" for root in found)
    assert sum(len(root.findall("page")) for root in found) == 50
    assert dump.read_dump(spark, str(tmp_path / "d")).exceptAll(pages).isEmpty()


def test_rejects_are_kept_apart(spark, tmp_path):
    (tmp_path / "docs").write_text('<doc id="1" revid="2" title="A">\nA\n\nx\n\n</doc>\n<doc id="3" title="a > b">\nq\n\ny\n\n</doc>\n')
    assert [r.page_id for r in docs.read_docs(spark, str(tmp_path / "docs")).collect()] == [1]
    assert docs.read_rejects(spark, str(tmp_path / "docs")).count() == 1
    (tmp_path / "dump").write_text("<mediawiki><page><title>A</title><id>1</id></page>\n<page><title>B</titel></page></mediawiki>")
    assert dump.read_dump(spark, str(tmp_path / "dump")).count() == 1
    assert dump.dump_rejects(spark, str(tmp_path / "dump")).count() == 1


def test_ordered_files_compute_their_rows_once(spark, tmp_path):
    """Bounds of ranges are sampled from a stored table, so the work in front of them is not done twice."""
    from chronolink.sinks import bounded

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = spark.range(90, -1, -1, 3).selectExpr("id AS page_id", "0 AS sid", "1 AS link_ord", "array('1999') AS dates", "'L' AS link", "'s' AS sentence")
    found = source.mapInPandas(counted, source.schema)
    writers.write_pairs(found, str(tmp_path / "p"), ordered=True)
    assert seen.value == 91
    written = [open(f).read() for f in sorted(glob.glob(f"{tmp_path}/p/part-*"))]
    assert [line.split(";")[0] for text in written for line in text.splitlines()] == [f"artid={i}" for i in range(91)]
    lines = source.select("page_id", "sid", "link_ord", F.col("page_id").cast("string").alias("value"))
    bounded.write_bounded(lines.mapInPandas(counted, lines.schema), str(tmp_path / "b"), ["page_id", "sid", "link_ord"], 50)
    assert seen.value == 182 and bounded.read_bounded(spark, str(tmp_path / "b")).count() == 91
