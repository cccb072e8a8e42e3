import random
import re

import pytest
from pyspark.sql import functions as F

from chronolink.functions import titles
from chronolink.operators import filters, links, pages, templates, tokens
from chronolink.plans.articles import clean_text


# --- filters -----------------------------------------------------------------------------------------
RULED = [
    "[[Category:A]]\n[[Category:B|k]]", "x\n [[Category:C]]", "no", "[[Category:A]]\n[[Category:C]]", "[[Category:D]] [[Category:A]]",
]


@pytest.mark.parametrize("rules, expected", [
    ([], [0, 1, 2, 3, 4]),
    ([("A", "include")], [0, 3]),
    ([("C", "exclude")], [0, 2, 4]),
    ([("A", "include"), ("C", "exclude")], [0]),
    ([("A", "include"), ("A", "exclude")], []),
    ([("zzz", "include")], []),
])
def test_category_rules(spark, page, rules, expected):
    table = spark.createDataFrame(rules, "category STRING, mode STRING")
    kept = filters.filter_categories(page(*RULED), table)
    assert sorted(r.page_id for r in kept.collect()) == expected


def test_category_rules_decide_row_by_row(spark):
    """Two revisions of a page, and a page without text."""
    rows = [(1, 10, "[[Category:A]]"), (1, 11, "none"), (2, 20, None)]
    pages_df = spark.createDataFrame(rows, "page_id LONG, rev_id LONG, wikitext STRING")
    rule = lambda *r: spark.createDataFrame(list(r), "category STRING, mode STRING")
    kept = lambda r: sorted((x.page_id, x.rev_id) for x in filters.filter_categories(pages_df, r).collect())
    assert kept(rule(("A", "include"))) == [(1, 10)]
    assert kept(rule(("A", "exclude"))) == [(1, 11), (2, 20)]


@pytest.mark.parametrize("text, kept", [
    ("{{disambig}}", False), ("x\n{{disambiguation|geo}}", False), ("__DISAMBIG__", False),
    ("see {{disambig}}", True), ("{{disambigx}}", True),
])
def test_disambiguation(page, text, kept):
    assert filters.drop_disambig(page(text)).isEmpty() is not kept


def test_id_range_reaches_the_scan(spark, tmp_path, page):
    page("a", "b", "c").write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    ranged = filters.filter_id_range(stored, 1, -1).select("page_id")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(page_id,1)" in plan and "ReadSchema: struct<page_id:bigint>" in plan
    assert sorted(r.page_id for r in ranged.collect()) == [1, 2]
    assert filters.filter_id_range(stored).count() == 3 and filters.filter_id_range(stored, 1, 1).count() == 1


def test_min_length(spark):
    articles = spark.createDataFrame([(1, "abc", "x\ny")], "page_id BIGINT, title STRING, text STRING")
    assert filters.min_length(articles, 6).count() == 1 and filters.min_length(articles, 7).count() == 0


# --- page tables ----------------------------------------------------------------------------------------
def test_dedupe_keeps_the_newest_of_a_hot_page(spark):
    hot = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("page_id"), (F.col("id") % 700).alias("rev_id"), F.lit("t").alias("title")
    )
    cold = spark.range(10, 20).select(F.col("id").alias("page_id"), F.lit(5).cast("bigint").alias("rev_id"), F.lit("u").alias("title"))
    out = pages.dedupe_pages(hot.unionByName(cold)).orderBy("page_id").collect()
    assert [(r.page_id, r.rev_id) for r in out] == [(1, 699)] + [(i, 5) for i in range(10, 20)]


def test_reused_and_changed_are_all(spark, page):
    new = page(*"abcdef")
    old = spark.createDataFrame([(0, 0), (1, 10), (1, 10), (2, 1), (9, 90)], "page_id BIGINT, rev_id BIGINT")
    reusable, changed = pages.split_changed(new, old)
    assert sorted(r.page_id for r in reusable.collect()) == [0, 1]
    assert sorted(r.page_id for r in changed.collect()) == [2, 3, 4, 5]
    marked = pages.mark_reusable(new, old)
    assert marked.count() == 6 and sorted(r.page_id for r in marked.filter("reusable").collect()) == [0, 1]
    assert sorted(r.page_id for r in pages.changed_pages(new, old).collect()) == [2, 3, 4, 5]
    unknown = new.withColumn("rev_id", F.when(F.col("page_id") != 3, F.col("rev_id")))
    assert sorted(r.page_id for r in pages.changed_pages(unknown, old).collect()) == [2, 3, 4, 5]
    stored = old.distinct().select("*", F.lit("t").alias("title"), F.lit("stored").alias("text"))
    out = pages.update_articles(new, stored, clean_text).orderBy("page_id").collect()
    assert [r.text for r in out] == ["stored", "stored", "c", "d", "e", "f"]


# --- links and titles -----------------------------------------------------------------------------------
def test_redirects(spark, page):
    pages_ = page("#REDIRECT [[B]]", "#redirect: [[C|x]] more", "see #REDIRECT [[D]]")
    table = links.redirects(pages_)
    assert sorted(map(tuple, table.collect())) == [("Page 0", "B"), ("Page 1", "C|x")]
    edges = spark.createDataFrame([(1, "Page 0"), (2, "Z")], "page_id BIGINT, link STRING")
    assert sorted(map(tuple, links.resolve_redirects(edges, table).collect())) == [(1, "B"), (2, "Z")]


@pytest.mark.parametrize("title, expected", [
    (" _foo__bar_ ", "Foo bar"), ("template:  x y", "Template:X y"), ("3001:  the_odyssey", "3001: The odyssey"),
    ("talk:x", "Talk:X"), (":x", ":X"), ("", ""), ("a:", "A:"),
])
def test_normalize_title(apply, title, expected):
    assert apply(titles.normalize_title, title) == [expected]


@pytest.mark.parametrize("title, expected", [
    ("A", ("", "A", "A", "", "A")), ("T:A/b/c", ("T", "A/b/c", "A/b", "c", "A")), ("T:U:x/", ("T", "U:x/", "U:x", "", "U:x")),
])
def test_title_parts(apply, title, expected):
    assert tuple(apply(titles.title_parts, title)[0]) == expected


# --- templates --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("text, expected", [
    ("a<!-- x -->b<noinclude>doc</noinclude>c", "abc"),
    ("a<noinclude >unclosed", "a"), ("a<noinclude/>b", "ab"),
    ("<onlyinclude>x</onlyinclude>y<onlyinclude>z\n</onlyinclude>", "xz\n"),
    ("a<includeonly>b</includeonly>", "ab"),
])
def test_template_body(apply, text, expected):
    assert apply(templates.template_body, text) == [expected]


def test_last_definition_wins(page):
    defined = templates.templates(page("old", "new", "<noinclude>x</noinclude>", "#REDIRECT [[T]]", title="Template:T", ns=10))
    assert [(r.title, r.body, r.page_id) for r in defined.collect()] == [("Template:T", "new", 1)]


@pytest.mark.parametrize("text, expected", [
    ("{{t|a|b|c|2=B}}", [("Template:T", {"1": "a", "2": "B", "3": "c"})]),
    ("{{t|2=B|a|b}}", [("Template:T", {"1": "a", "2": "b"})]),
    ("{{t| x = 1=2 | y }}", [("Template:T", {"x": "1=2", "1": "y"})]),
    ("{{t|[[A|b]] |c= [[D|e]] }}", [("Template:T", {"1": "[[A|b]] ", "c": " [[D|e]] "})]),
    ("{{a|{{b|x}}|y}}", [("Template:B", {"1": "x"}), ("Template:A", {"1": "", "2": "y"})]),
    ("{{:Main page}}{{#if:x|y}}{{lc:X}}{{}}", [("Main page", {})]),
    ("{{t\n|a=1\n|b=2\n}}", [("Template:T", {"a": "1", "b": "2"})]),
    ("{{t|{{{1|none}}}}}", [("Template:T", {"1": ""})]),
    ("{{a}} {{b}} {{ {{c}}", [("Template:A", {}), ("Template:B", {}), ("Template:C", {})]),
    ("{{{{{{x}}}}}}", []),
])
def test_template_calls(page, text, expected):
    rows = templates.template_calls(page(text)).orderBy("call_no").collect()
    assert [(r.template, r.params) for r in rows] == expected


def test_template_joins(page, spark):
    calls = templates.template_calls(page("{{a}}{{a}}{{b}}{{c}}"))
    known = spark.createDataFrame([("Template:A", "x", 1), ("Template:D", "y", 2)], "title STRING, body STRING, page_id BIGINT")
    moved = spark.createDataFrame([("Template:C", "Template:D")], "from_title STRING, to_title STRING")
    used = templates.template_usage(calls, known, moved).orderBy("template").collect()
    assert [tuple(r) for r in used] == [("Template:A", 2, True, "x"), ("Template:B", 1, False, ""), ("Template:D", 1, True, "y")]
    assert [tuple(r) for r in templates.missing_templates(calls, known, moved).collect()] == [("Template:B", 1)]


# --- tokens -------------------------------------------------------------------------------------------------
GOLDEN = [
    ("en", 'He said: "It\'s 3.5, isn\'t it?" (Yes!)...', "He|said|:|\"|It|'s|3.5|,|is|n't|it|?|\"|(|Yes|!|)|..."),
    ("en", "U.S.A. etc. and so on.", "U.|S.|A.|etc.|and|so|on|."),
    ("en", "a,b;c!d 1,000 3:45 x.y", "a|,|b|;|c|!|d|1,000|3:45|x.|y"),
    ("en", "<b class=x>Bold text</b>and <i>more", "<b class=x>|Bold|text|</b>|and|<i>|more"),
    ("en", "well--known --x y--", "well--known|--|x|y|--"),
    ("en", "they'd've can't", "they|'d|'ve|ca|n't"),
    ("fr", "l'homme d'été donne-t-il parle-moi qu'elle aujourd'hui", "l'|homme|d'|été|donne|-t-il|parle|-moi|qu'|elle|aujourd'hui"),
    ("it", "dell'arte un'altra", "dell'|arte|un'|altra"),
    ("de", "Am 3. Mai 19. er kam.", "Am|3.|Mai|19.|er|kam|."),
    ("es", "(hola). ¿que?", "(|hola|)|.|¿|que|?"),
    ("en", "", ""),
]


def counted(spark, rows, listed=None):
    documents = spark.createDataFrame(rows, "lang STRING, text STRING")
    table = spark.createDataFrame([(w,) for w in listed], "word STRING") if listed else None
    return {(r.lang, r.token): r.n for r in tokens.token_counts(documents, table).collect()}


@pytest.mark.parametrize("lang, text, expected", GOLDEN)
def test_tokens_by_hand(spark, lang, text, expected):
    want = {}
    for token in expected.split("|") if expected else []:
        want[lang, token] = want.get((lang, token), 0) + 1
    assert counted(spark, [(lang, text)], ["etc."]) == want


@pytest.mark.parametrize("lang", ["en", "fr", "it", "gl", "de", "es"])
def test_token_properties(spark, lang):
    """Tokens hold the text's characters and no blanks; a listed word stays whole."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab.,!?'\"()-: 1…s%") for _ in range(40)) for _ in range(300)]
    found = counted(spark, [(lang, t) for t in texts])
    letters = lambda parts: sorted(c for part in parts for c in part if not c.isspace())
    assert letters(t for (_, token), n in found.items() for t in [token] * n) == letters(texts)
    assert all(token and not re.search(r"\s", token) for _, token in found)
    assert counted(spark, [(lang, "zz. zz.")], ["zz."]) == {(lang, "zz."): 2}
    twice = counted(spark, [(lang, t) for t in texts] * 2)
    assert twice == {k: 2 * n for k, n in found.items()}


def read_phrases(words, phrases):
    """Left to right, the longest phrase at each position."""
    counts, i = {}, 0
    by_length = sorted((p.split() for p in phrases), key=lambda p: (-len(p), p), reverse=False)
    while i < len(words):
        best = None
        for p in by_length:
            span = words[i:i + len(p)]
            if len(p) > 1 and len(span) == len(p) and all(
                a in (b, b.lower(), b[:1].upper() + b[1:].lower()) for a, b in zip(p, span)
            ):
                if best is None or len(p) > len(best) or (len(p) == len(best) and p > best):
                    best = p
        if best:
            counts[" ".join(best)] = counts.get(" ".join(best), 0) + 1
        i += len(best) if best else 1
    return counts


def test_phrases_against_a_plain_loop(spark):
    rng = random.Random(7)
    phrases = ["a b", "a b c", "b c", "c a", "A a", "a a", "b b b b", "c", "New york", "x y z w v", "a b c a b c a"]
    texts = [" ".join(rng.choice(["a", "b", "c", "A", "B"]) for _ in range(60)) for _ in range(80)]
    texts += ["a a a a a a a", "NEW YORK new York New york", "x y z w v x y", "a", ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    table = spark.createDataFrame([(p, "NN") for p in phrases], "phrase STRING, tags STRING")
    got = {r.phrase: r.n for r in tokens.phrase_counts(documents, table).collect()}
    want = {}
    for t in texts:
        for phrase, n in read_phrases(t.split(), phrases).items():
            want[phrase] = want.get(phrase, 0) + n
    assert got == want


def test_phrase_trie(spark):
    """Edges of shared beginnings stand once; a phrase may end inside another one."""
    table = spark.createDataFrame([(" a b ", "x"), ("a b c", "x"), ("a b c", "y"), ("a b d", "x"), ("e", "x"), ("", "x")], "phrase STRING, tags STRING")
    got = {(r.level, r.node, r.before, r.word, r.child, r.ends) for r in tokens.phrase_trie(table).collect()}
    assert got == {(2, "a", "a", "b", "a b", True), (3, "a b", "b", "c", "a b c", True), (3, "a b", "b", "d", "a b d", True)}


def test_long_phrases_and_near_misses(spark):
    """A phrase of 25 words is found where all of it stands; where its last word differs, the shorter one is."""
    words = [f"w{i % 7}" for i in range(25)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(["W0", *words[1:24], "other"]), "w0 w1", ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    table = spark.createDataFrame([(" ".join(words), "x"), ("w0 w1 w2", "x")], "phrase STRING, tags STRING")
    got = {(r.doc_id, r.pos): r.n for r in tokens.phrase_hits(documents, table).collect()}
    short = {(d, p): 3 for d in (0, 1, 2) for p in range(0, 22, 7)}
    assert got == {**short, (0, 0): 25}
    none = tokens.phrase_hits(documents, table.limit(0))
    assert none.columns == ["doc_id", "pos", "n", "phrase"] and none.collect() == []


def test_many_parameters(spark, page):
    """Of equal names the last counts, numbered ones among them; the work does not grow with the square of their number."""
    text = "{{T|a|2=x|b|k=1|k=2|" + "|".join(f"p{i % 900}={i}" for i in range(3000)) + "|last}}"
    params = templates.template_calls(page(text)).first().params
    want = {"1": "a", "2": "b", "3": "last", "k": "2"} | {f"p{i % 900}": str(i) for i in range(3000)}
    assert dict(params) == want
    assert dict(templates.template_calls(page("{{T|x|1=y}}")).first().params) == {"1": "y"}
    assert dict(templates.template_calls(page("{{T}}")).first().params) == {}
