"""Steps over a text do no work that the text does not ask for, and give what they gave with it."""

import random
import re

from pyspark.sql import functions as F

from chronolink.functions import markup as m
from chronolink.functions.compose import let, rewrite_matches, until_stable
from chronolink.operators.pairs import pair_dates

LEVEL = re.compile(m.INNERMOST_TEMPLATE)


def by_counts(text):
    """Rounds as long as the number of openers falls."""
    before = None
    while text.count("{{") and (before is None or text.count("{{") < before):
        before, text = text.count("{{"), LEVEL.sub("", text)
    return text


def test_one_level_is_not_counted(apply):
    never = lambda t: F.raise_error(F.lit("counted")).cast("int")
    drop = lambda x: F.regexp_replace(x, m.INNERMOST_TEMPLATE, "")
    texts = ["a{{x}}b", "a{{x", "none", None]
    assert apply(lambda c: until_stable(c, drop, "{{", never), *texts) == ["ab", "a{{x", "none", None]


def test_templates_by_length_as_by_count(apply):
    dice = random.Random(7)
    texts = ["".join(dice.choices("{}a", (5, 5, 1), k=dice.randint(0, 40))) for _ in range(600)]
    texts += ["{" * k + "{{a}}" * n + "}" * j for k in range(6) for n in range(4) for j in range(6)]
    assert apply(m.drop_templates, *texts) == [by_counts(t) for t in texts]


def test_elements_by_length_as_by_count(apply):
    dice = random.Random(8)
    parts = ["<div>", "</div>", "<ref>", "</ref>", "<", "a", "</", ">", "<b>"]
    texts = ["".join(dice.choices(parts, k=dice.randint(0, 24))) for _ in range(300)]
    names = "|".join(m.DISCARDED_ELEMENTS)
    body = r"(?:[^<]++|<(?!\s*+\1\b[^>/]*+>|\s*+/\s*+\1>))*+"
    innermost = rf"(?i)<\s*+({names})\b[^>/]*+>{body}<\s*+/\s*+\1>"
    counted = lambda t: until_stable(t, lambda x: F.regexp_replace(x, innermost, ""), "<")
    assert apply(m.drop_elements, *texts) == apply(counted, *texts)


def test_placeholders_keep_control_characters(apply):
    texts = ["a\x03b\x04c", "<math>x</math>", "< MATH >x</math> y", "no math"]
    assert apply(m.number_placeholders, *texts) == ["a\x03b\x04c", "formula_1", "formula_1 y", "no math"]


def test_control_characters_do_not_move_pairs(spark):
    tag = '<TIMEX3 tid="t1" type="DATE" value="1999">1999</TIMEX3>'
    rows = [(1, 0, f'x\x03y\x04z <a href="A">a</a> {tag} <a href="B\x03">b</a> {tag}')]
    found = pair_dates(spark.createDataFrame(rows, "page_id LONG, sid INT, sentence STRING"))
    assert [(r.link_ord, r.link, r.dates) for r in found.collect()] == [(1, "A", ["1999"]), (2, "B\x03", ["1999"])]


def test_matches_by_their_place(apply):
    texts = ["", "a", "1", "a1b22c", "12", "\x031\x04\x05\x06", None]
    numbered = apply(lambda c: rewrite_matches(c, r"\d+", lambda x, i: F.concat(x, F.lit(":"), i.cast("string"))), *texts)
    assert numbered == ["", "a", "1:0", "a1:0b22:1c", "12:0", "\x031:0\x04\x05\x06", None]


def test_let_derives_no_type_for_each_row(spark):
    plan = spark.range(1).select(let(F.col("id"), lambda x: x + 1).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert "element_at(" in plan and ")[0]" not in plan
