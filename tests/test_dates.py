import pytest
from pyspark.sql import functions as F

from chronolink.functions import dates as d
from chronolink.operators import pairs as p
from chronolink.operators.sentences import sentences
from chronolink.plans.articles import extract_pairs, tag_articles


@pytest.mark.parametrize("value, expected", [
    ("2001", "2001"), ("2001-05", "2001-05"), ("2001-05-12", "2001"), ("2001-SP", "2001"),
    ("BC0044", "BC0044"), ("20015", "2001"), ("XXXX-05", None), ("199", "DECADE 199"),
    ("BC19", "CENTURY BC19"), ("19", "CENTURY 19"), ("[1990,1995]", "[1990,1995]"),
    ("[1990-01-02,1995]", "[1990-01-02,1995]"), ("[199,200]", None), ("PRESENT_REF", None),
    ("BC199", "DECADE BC199"), ("", None),
])
def test_normalize(apply, value, expected):
    assert apply(d.normalize_date, value) == [expected]


def tagged(surface, value, tid=1):
    return f'<TIMEX3 tid="t{tid}" type="DATE" value="{value}">{surface}</TIMEX3>'


@pytest.mark.parametrize("surface, value", [
    ("1999", "1999"), ("5 May 1999", "1999-05-05"), ("5th May, 1999", "1999-05-05"),
    ("May 15, 1999", "1999-05-15"), ("May 1999", "1999-05"), ("1999-05-15", "1999-05-15"),
    ("1999-05", "1999-05"), ("44 BC", "BC0044"), ("44 B.C.", "BC0044"), ("476 AD", "0476"),
    ("AD 79", "0079"), ("A.D. 79", "0079"), ("1990s", "199"), ("19th century", "18"),
    ("1st century BC", "BC00"), ("3rd century", "02"), ("12 BCE", "BC0012"), ("90 CE", "0090"),
])
def test_tagging(apply, surface, value):
    assert apply(d.tag_dates, f"In {surface}, x") == [f"In {tagged(surface, value)}, x"]


@pytest.mark.parametrize("text", ["x1999", "19990", "199", "Customer#000001999x", "1999x", "in the Maybe 19"])
def test_no_date(apply, text):
    assert apply(d.tag_dates, text) == [text]


def test_several_dates_are_numbered(apply):
    assert apply(d.tag_dates, "1998-2000") == [tagged("1998", "1998", 1) + "-" + tagged("2000", "2000", 2)]
    assert apply(d.tag_dates, "1998–2000, 5.") == [tagged("1998", "1998") + "–" + tagged("2000", "2000", 2) + ", 5."]


def test_dated_titles_lose_their_anchor(apply):
    text = '<a href="1999 in film">year 1999</a> <a href="Film">in 1999</a>'
    assert apply(d.tag_dates, text) == [
        "year " + tagged("1999", "1999") + '</a> <a href="Film">in ' + tagged("1999", "1999", 2) + "</a>"
    ]


def test_year_range(spark):
    dates = ["1999", "1999-05", "BC0044", "DECADE 199", "CENTURY 18", "CENTURY BC00", "[1990,1995-02]", "[BC0010,0005]"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(dates)], "i INT, date STRING")
    out = rows.select("i", d.year_range(F.col("date")).alias("y"), d.date_kind(F.col("date")).alias("k")).orderBy("i")
    assert [(r.y.from_year, r.y.to_year, r.k) for r in out.collect()] == [
        (1999, 1999, "date"), (1999, 1999, "date"), (-44, -44, "date"), (1990, 1999, "decade"),
        (1800, 1899, "century"), (-99, 0, "century"), (1990, 1995, "interval"), (-10, 5, "interval"),
    ]


@pytest.mark.parametrize("wikitext, expected", [
    ("In 1900 [[A]] 1999 and 2001 [[B]] [[C]] 1950", [("A", ["1999", "2001"]), ("C", ["1950"])]),
    ("[[A]] 1999 [[A]] 1999", [("A", ["1999"]), ("A", ["1999"])]),
    ("1999 [[A]]", []),
    ("[[A|born 1999]] 2000", [("A", ["2000"])]),
    ("[[A]] 1990 – 1995 – 1999", [("A", ["[1990,1995]", "1999"])]),
    ("[[A]] 1990s and the 5th century", [("A", ["DECADE 199", "CENTURY 04"])]),
    ("[[A]] 5 May 1990 – 6 June 1991", [("A", ["[1990-05-05,1991-06-06]"])]),
    ("[[A]] 1980s – 1990s", []),
    ("[[A]] the [[1999 in film|film of 1998]] 1997", [("A", ["1998", "1997"])]),
    ("[[|no title]] 1999 [[A]] [[ |x 1998]] 1997", [("A", ["1997"])]),
    ("[[St. Louis]] 1999", []),
    ("[[Who?]] 1999", []),
    ("[[A|b]] (1999; 2000)", [("A", ["1999"])]),
])
def test_pairs_of_a_sentence(spark, page, wikitext, expected):
    pages = page(wikitext)
    found = extract_pairs(pages).orderBy("sid", "link_ord").collect()
    assert [(r.link, r.dates) for r in found] == expected
    from chronolink.plans.articles import clean_text

    window = p.pair_mentions(p.mentions(sentences(tag_articles(clean_text(pages)))))
    assert sorted((r.sid, r.link_ord, r.link, r.dates) for r in window.collect()) == sorted(
        (r.sid, r.link_ord, r.link, r.dates) for r in found
    )


def test_clean_sentence_keeps_the_dash(page):
    row = extract_pairs(page("The [[A|b]] of 1990 – 1995.")).first()
    assert (row.sentence, row.dates) == ("The b of 1990 – 1995.", ["[1990,1995]"])


def test_every_date_stands_behind_its_link(spark):
    from chronolink.operators.filters import keep_articles
    from chronolink.plans.corpus import corpus

    pages = keep_articles(corpus(spark, "/root/testdata/sf0.001"))
    for r in extract_pairs(pages).select("link", "dates", "sentence").collect():
        at = r.sentence.find("the land" if r.link.startswith("NATION") and "the land" in r.sentence else r.link)
        for date in r.dates:
            year = date.strip("[").split(",")[0].removeprefix("DECADE ").removeprefix("BC").lstrip("0")
            assert at >= 0 and (date.startswith("CENTURY") or year in r.sentence[at:])


def test_numbers_of_the_stored_form(page):
    text = "First one. [[A]] 1999"
    assert [r.sid for r in extract_pairs(page(text, title="Alpha")).collect()] == [1]
    # header, title line, then the body
    assert [r.sid for r in extract_pairs(page(text, title="Alpha"), whole_doc=True).collect()] == [3]
    assert [r.sid for r in extract_pairs(page(text, title="Abc"), whole_doc=True).collect()] == [2]


def test_sentences(spark, page):
    text = 'One. Two: three; "Four?" five! six "x" Mr. A.\nSeven\nab'
    articles = spark.createDataFrame([(1, text)], "page_id BIGINT, text STRING")
    assert [r.sentence for r in sentences(articles).orderBy("sid").collect()] == [
        "One.", "Two:", "three;", '"Four?', " five!", 'six "x" Mr.', "Seven",
    ]


def test_texts_may_hold_the_characters_that_frame_matches(spark, apply):
    """Control characters of a text stay where they are, whatever they stand beside."""
    import random
    import re

    from chronolink.functions.compose import rewrite_matches
    from chronolink.operators.sentences import split_sentences

    rng = random.Random(4)
    texts = ["\x03", "\x04\x05", "\x05b", "In 1999\x03. x\x04y, 2001", "a\x05c. b\x05ab! c"]
    texts += ["".join(rng.choice("\x03\x04\x05\x06\x07abc1. \n") for _ in range(40)) for _ in range(200)]
    marked = apply(lambda c: rewrite_matches(c, r"[a1]+", lambda m, i: F.concat(F.lit("<"), m, i.cast("string"), F.lit(">"))), *texts)
    for text, got in zip(texts, marked):
        numbers = iter(range(1000))
        assert got == re.sub("[a1]+", lambda m: f"<{m[0]}{next(numbers)}>", text)
    assert apply(lambda c: split_sentences(c), *texts) == [
        [s for s in re.sub('([.:;?!])[ "]|\n|BULLET::::', lambda m: (m[1] or "") + "\ue000", t).split("\ue000") if len(s) > 3] for t in texts
    ]


def test_intervals_pair_off_from_the_left(apply):
    import re

    from chronolink.functions.dates import merge_intervals

    def tag(i, value, mod=""):
        return f'<TIMEX3 tid="t{i}" type="DATE" value="{value}"{mod}>{value}</TIMEX3>'

    one = r'<TIMEX3 tid="([^"]*)" type="DATE" value="([^"]*)">([^<]*)</TIMEX3>'
    a, b, c, d = (tag(i, 1990 + i) for i in range(4))
    odd = tag(9, 1999, ' mod="APPROX"')
    texts = [
        f"x {a}–{b} y", f"{a} – {b} – {c}", f"{a}–{b}–{c} –{d}.", f"{a}  – {b}", f"{a}-{b}", f"{a}–{odd}–{b}", f"{odd}–{a}–{b}–",
        f"– {a}", f"{a} –", "no – date", "", f"{a}–\n{b}", f"\x03{a}\x04–{b}\x05", f"{a}–{b} and {c}–{d}", f"{a}––{b}–{c}",
    ]
    joined = r'<TIMEX3 tid="\1" type="DATE" value="[\2,\5]">\3-\6</TIMEX3>'
    expected = [re.sub(rf"{one} ?– ?{one}", joined, t) for t in texts]
    assert apply(merge_intervals, *texts) == expected
    assert apply(merge_intervals, None) == [None]


def test_titles_and_their_colons(apply):
    from chronolink.functions.titles import normalize_title

    cases = {
        " _foo__bar _": "Foo bar", "template:  box": "Template:Box", "template:box": "Template:Box", "talk: box": "Talk: Box",
        "talk:box": "Talk:Box", "a:": "A:", "a: ": "A:", ":x": ":X", "a:b:c": "A:B:c", "": "", ":": ":", "\tx": " x", "é_:ü": "É :Ü",
    }
    assert apply(normalize_title, *cases) == list(cases.values())
    assert apply(normalize_title, None) == [None]
