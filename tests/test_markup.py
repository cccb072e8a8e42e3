import pytest
from pyspark.sql import functions as F

from chronolink.functions.compose import escape_frames, occurrences, unescape_frames
from chronolink.functions import markup as m
from chronolink.plans.articles import clean_text


@pytest.mark.parametrize("text, expected", [
    ("a{{x}}b", "ab"),
    ("a{{x|{{y|{{z}}}}}}b", "ab"),
    ("a{{math|x_{1} }}b", "ab"),
    ("a{{math|x_{1}}}b", "a}b"),
    ("a{{x}", "a{{x}"),
    ("{{a}} {{ {{b}}", " {{ "),
    ("none", "none"),
    (None, None),
])
def test_templates(apply, text, expected):
    assert apply(m.drop_templates, text, "x") [0] == expected


def test_nesting_has_no_depth_limit(apply):
    deep = "{{a|" * 60 + "}}" * 60
    links = "[[File:x|" * 25 + "y" + "]]" * 25
    divs = "<div>" * 40 + "x" + "</div>" * 40
    tables = "{|\n" * 20 + "|}" * 20
    assert apply(m.drop_templates, f"a{deep}b") == ["ab"]
    assert apply(m.strip_links, f"a{links}b") == ["ab"]
    assert apply(m.drop_elements, f"a{divs}b") == ["ab"]
    assert apply(m.drop_tables, f"a{tables}b") == ["ab"]


@pytest.mark.parametrize("step, text, expected", [
    (m.drop_templates, "{{" + "x{y} " * 200_000 + "}}", ""),
    (m.drop_tables, "{|" + "\n|-\n| cell {x}" * 100_000 + "\n|}", ""),
    (m.strip_links, "[[File:a|" + "caption [x] " * 100_000 + "]]", ""),
    (m.drop_elements, "<div>" + "text <i> <br> " * 100_000 + "</div>", ""),
    (m.drop_comments, "<!--" + "x\n" * 500_000 + "-->", ""),
    (m.number_placeholders, "<math>" + "x\n" * 300_000 + "</math>", "formula_1"),
])
def test_long_markup(apply, step, text, expected):
    assert apply(step, text) == [expected]


def test_unclosed_markup_in_a_long_page(apply):
    filler = "word [x] {y} <z> " * 50_000
    for opener, step in (
        ("{{", m.drop_templates), ("{|", m.drop_tables), ("[[", m.strip_links), ("<div>", m.drop_elements),
    ):
        assert apply(step, opener + filler) == [opener + filler]


@pytest.mark.parametrize("text, expected", [
    ("[[T]]s", '<a href="T">T</a>s'),
    ("[[T |x| the label ]]", '<a href="T">the label</a>'),
    ("[[File:a.png|thumb|see [[B]] now]]x", "x"),
    ("[[:File:a]] [[w:Foo|bar]]", ' <a href="w:Foo">bar</a>'),
    ("[[2001: Film]]", ""),
    ("[[Who?]] [[A#B|c]]", '<a href="Who?">Who?</a> <a href="A#B">c</a>'),
    ("[[open", "[[open"),
    ("[[A|b $1 \\ c]]", '<a href="A">b $1 \\ c</a>'),
])
def test_links(apply, text, expected):
    assert apply(m.strip_links, text) == [expected]


def test_link_options(apply):
    assert apply(lambda c: m.strip_links(c, keep_links=False), "[[A b|c]]s [[D]]") == ["cs D"]
    assert apply(lambda c: m.strip_links(c, accepted=("File",)), "[[File:a|b]][[w:x]]") == ['<a href="File:a">b</a>']
    assert apply(lambda c: m.strip_links(c, encode=True), "[[A b/é|c]]") == ['<a href="A%20b/%C3%A9">c</a>']


@pytest.mark.parametrize("text, expected", [
    ("'''''a''''' '''b''' ''c''", 'a b "c"'),
    ("''\"q\"''", '"q"'),
    ("'''open", "open"),
])
def test_emphasis(apply, text, expected):
    assert apply(m.strip_emphasis, text) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("a [http://x.org label] b [//y z] [x] [mailto:q@r]", "a  b  [x] "),
    ("[HTTP://x.org a\nb]", "[HTTP://x.org a\nb]"),
])
def test_external_links(apply, text, expected):
    assert apply(m.drop_external_links, text) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("&lt;&amp;lt;&nbsp;&eacute;&bogus;&#65;&#x41;&#xZZ; &", "<&lt;\xa0é&bogus;AA&#xZZ; &"),
    ("&#128512;&#x1F600;&#55296;&#99999999;", "\U0001f600\U0001f600&#55296;&#99999999;"),
    ("&amp;#38;", "&#38;"),
])
def test_entities(apply, text, expected):
    assert apply(m.unescape_entities, text) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("a<ref>x<ref>y</ref></ref>b<ref name='c'>d</ref>", "ab"),
    ("<DIV class=x>a</div>b<div>c", "b<div>c"),
    ("<table><tr><td>x</td></tr></table>y<ul><li>z</ul>", "y"),
    ("<source lang=x>a</source><sub>2</sub>", ""),
])
def test_elements(apply, text, expected):
    assert apply(m.drop_elements, text) == [expected]


def test_inline_markup_is_the_three_steps_at_once(apply):
    text = "a<!-- <b> \n-->b<br /><B>c</ b></B><hr/><span style='x'>d</span><bdo>e</bdo>"
    one_pass = apply(m.drop_inline_markup, text)
    assert one_pass == ["abc" + "d<bdo>e</bdo>"]
    assert one_pass == apply(lambda c: m.strip_tags(m.drop_selfclosing(m.drop_comments(c))), text)


def test_placeholders_share_numbers(apply):
    text = "<math>b</math> <math>a</math> <math>b</math> <code lang='x'>c</code> <Math>z</Math>"
    assert apply(m.number_placeholders, text) == ["formula_1 formula_2 formula_1 codice_1 formula_4"]


@pytest.mark.parametrize("step, opener", [
    (m.drop_comments, "<!-- "), (m.number_placeholders, "<math> "), (m.shield_code, "<syntaxhighlight a> "),
])
def test_openers_without_end(apply, step, opener):
    text = opener + "x " + opener * 100_000
    assert apply(step, text) == [text]


def test_closed_ones_go_unclosed_ones_stay(apply):
    assert apply(m.drop_inline_markup, "a<!-- b -->c<b>d</b><!-- <i>e") == ["acd<!-- e"]
    assert apply(m.number_placeholders, "<math>a</math> <math>b") == ["formula_1 <math>b"]


def test_normalize(apply):
    assert apply(m.normalize_text, "a\n--- !!\nb <<x>>\ty  z.....,,u,.") == ["a\nb «x» y z...,u."]


def test_code_is_left_alone(page):
    text = 'x<b>y</b> <syntaxhighlight lang="c">if (a &lt; b) <b>z</b> <!-- k --></syntaxhighlight> &lt;'
    assert clean_text(page(text)).first().text == "xy if (a &lt; b) <b>z</b> <!-- k --> <"


def test_nowiki(apply):
    text = "{{a}}<nowiki>{{b}}</nowiki>{{c}}"
    assert apply(lambda c: m.drop_templates(c, protect_nowiki=True), text) == ["<nowiki>{{b}}</nowiki>"]


def test_keep_tables(page):
    text = 'a\n{| class="t"\n! style="width:50%;"|Head\n|-\n|cell\n|}\nb'
    out = clean_text(page(text), keep_tables=True).first().text
    assert "cell" in out and "Head" in out and "|" not in out and "style" not in out


def test_clean_text_changes_clean_text_no_more(page):
    text = "Plain line.\n\n'''Bold''' [[A|b]] {{x}}<br/> &eacute; ==no==\n== H ==\n* item\n\nEnd (x)."
    once = clean_text(page(text), keep_links=False)
    again = clean_text(once.select("page_id", "rev_id", "title", F.col("text").alias("wikitext")), keep_links=False)
    assert once.first().text.replace("BULLET::::", "") == again.first().text.replace("BULLET::::", "")


def test_cleaning_is_one_projection_over_the_scan(spark, page):
    plan = clean_text(page("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("step", [escape_frames, unescape_frames, lambda c: occurrences(c, "[[")])
def test_steps_hold_their_input_once(spark, step):
    rows = spark.createDataFrame([("x",)], "text STRING")
    plan = rows.select(step(F.regexp_replace("text", "a", "b")).alias("out"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") == 1


def test_frames_come_back(apply):
    texts = ["a\x03b\x04c\x05d", "\x05\x06", "plain [[x]] [[y", "", None]
    assert apply(lambda c: unescape_frames(escape_frames(c)), *texts) == texts
    assert apply(lambda c: occurrences(c, "[["), *texts) == [0, 0, 2, 0, None]
