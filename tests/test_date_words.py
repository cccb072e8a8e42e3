"""Dates by dictionary: golden rows, an unknown language, another dictionary, odd texts."""

import pytest

from chronolink.operators.date_words import dates_by_language

GOLDEN = {
    "en": [
        ("Born 3 March 1995.", ["1995-03-03"]), ("the 3rd of March, 1995", ["1995-03-03"]), ("July 14, 1789 and May 2001", ["1789-07-14", "2001-05"]),
        ("the 19th century", ["18"]), ("44 BC, 1066 and 100 BCE", ["BC0044", "1066", "BC0100"]), ("the 1990s", ["199"]),
        ("on 45 March 1995", ["1995-03"]), ("May I go, 12 of 99, a century", []), ("March March 1995", ["1995-03"]), ("x1995 1995x 19955", []),
    ],
    "de": [
        ("Am 3. März 1995, im Mai 2001", ["1995-03-03", "2001-05"]), ("im 19. Jahrhundert", ["18"]), ("44 v. Chr. bis 30 vor Christus", ["BC0044", "BC0030"]),
        ("die 1990er", ["199"]), ("3 March 1995", ["1995"]),
    ],
    "fr": [("le 1er août 1914", ["1914-08-01"]), ("au 19e siècle", ["18"]), ("en 52 av. J.-C.", ["BC0052"]), ("3 FÉVRIER 1848", ["1848-02-03"])],
    "es": [("el 3 de marzo de 1995", ["1995-03-03"]), ("marzo del 2001", ["2001-03"]), ("siglo 19", ["18"]), ("44 a. C.", ["BC0044"])],
    "xx": [("3 March 1995 or 3. März 1848", ["1995", "1848"])],
    None: [("in 1995", ["1995"]), (None, []), ("", []), (" \n", []), ("x: 1995 :: d:3 m01:y 2001 y:", ["1995", "2001"])],
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, lang, text, "clash", 0) for i, (lang, text, _) in enumerate(_flat())]
    texts = spark.createDataFrame(rows, "doc_id INT, lang STRING, text STRING, value STRING, ord INT")
    return [(r.doc_id, r.ord, r.surface, r.value) for r in dates_by_language(texts).orderBy("doc_id", "ord").collect()]


def _flat():
    return [(lang, text, values) for lang, cases in GOLDEN.items() for text, values in cases]


def test_values_in_order(found):
    expected = [(i, n, v) for i, (_, _, values) in enumerate(_flat()) for n, v in enumerate(values, 1)]
    assert [(i, n, v) for i, n, _, v in found] == expected


def test_surfaces_are_the_tokens(found):
    surfaces = {s for *_, s, _ in found}
    assert {"3rd of March , 1995", "July 14 , 1789", "44 v . Chr", "3 de marzo de 1995", "1990er", "52 av . J"} <= surfaces


def test_a_dictionary_of_ones_own_and_a_long_text(spark):
    words = {"it": {"marzo": "m03", "secolo": "c"}}
    long = "il 3 marzo 1995 e poi " * 20_000 + "w" * 100_000
    texts = spark.createDataFrame([("a", "it", long), ("b", "en", "3 March 1995"), ("c", "it", "3 secolo")], "page STRING, lang STRING, text STRING")
    got = dates_by_language(texts, "page", words).groupBy("page", "value").count().collect()
    assert {(r.page, r.value): r["count"] for r in got} == {("a", "1995-03-03"): 20_000, ("b", "1995"): 1, ("c", "02"): 1}


def test_no_exchange_and_no_text_beyond_the_scan(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = dates_by_language(texts)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan
    assert dates_by_language(texts.limit(0)).collect() == []
