"""PII: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

All of it is column expressions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import whole_text

NEAR = 48
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """What a kind of personal data looks like.

    ``pattern`` proposes spans ``m``; those failing ``valid`` (SQL over ``m``) are dropped. A span scores
    ``score``, and ``boost`` more with one of the words ``near`` (a pattern) close by, before or after, or with
    a span of its kind close by that has one. ``gate`` is a cheap
    test that each text with a match passes.
    """

    name: str
    pattern: str
    valid: str
    gate: str
    score: float
    near: str = ""
    boost: float = 0.0


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (acc, i) -> acc + CASE
    WHEN i % 2 = 1 THEN int(substring({_DIGITS}, -i, 1))
    WHEN int(substring({_DIGITS}, -i, 1)) > 4 THEN 2 * int(substring({_DIGITS}, -i, 1)) - 9
    ELSE 2 * int(substring({_DIGITS}, -i, 1)) END) % 10 = 0"""
_PLAIN = "replace(m, ' ', '')"
_MOD97 = f"""aggregate(split(concat(substring({_PLAIN}, 5), substring({_PLAIN}, 1, 4)), ''), 0, (acc, c) -> CASE
    WHEN c = '' THEN acc WHEN c < 'A' THEN (acc * 10 + int(c)) % 97 ELSE (acc * 100 + ascii(c) - 55) % 97 END) = 1"""

# Where a run of a class is entered, only its start or the end of the match before can begin a match;
# saying so keeps long runs linear.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", "contains(text, '@')", 0.8, "e-?mail|contact|write", 0.2),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)",
         "rlike(text, '[0-9][.][0-9]')", 0.6, "address|host|server|login", 0.2),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
         "rlike(text, '[0-9][ -]?[0-9]')", 0.8, "card|visa|credit|pay", 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15",
         "contains(text, '+')", 0.6, "phone|call|tel|fax|mobile", 0.3),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         _MOD97, "rlike(text, '[A-Z]{2}[0-9]{2}[ A-Z0-9]')", 0.7, "iban|account|bank", 0.3),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         "NOT rlike(m, '^(000|666|9)|-00-|-0000$')", "rlike(text, '[0-9]{3}-[0-9]{2}-')", 0.3, "ssn|social|security", 0.5),
)


def _spans_of(kind: Kind) -> str:
    """SQL: spans of a kind in ``text``. Each match comes with the gap before it; lengths of gaps and
    matches add up to code-point positions, and ``i`` is the match's place among them."""
    gap = f"(?s)(.*?)({kind.pattern}|\\z)"
    pairs = f"""zip_with(regexp_extract_all(text, r'{gap}', 1), regexp_extract_all(text, r'{gap}', 2),
        (g, m) -> named_struct('g', g, 'm', m))"""
    folded = """aggregate(p, named_struct('at', 0L, 'i', 1, 'out', cast(array() AS array<struct<start: bigint, end: bigint, m: string, i: int>>)),
        (acc, x) -> named_struct('at', acc.at + length(x.g) + length(x.m), 'i', acc.i + 1, 'out', CASE WHEN x.m = '' THEN acc.out ELSE
            concat(acc.out, array(named_struct('start', acc.at + length(x.g), 'end', acc.at + length(x.g) + length(x.m), 'm', x.m, 'i', acc.i))) END)).out"""
    valid = f"filter({folded}, x -> {kind.valid.replace('(m,', '(x.m,')})"
    form = "array<struct<start: bigint, end: bigint, near: boolean>>"
    # a gap and match have two characters at least, so half as many of them fill the window
    before = f"""right(concat(array_join(transform(slice(p, greatest(1, x.i - {NEAR // 2}), least(x.i - 1, {NEAR // 2})),
        q -> right(concat(q.g, q.m), {NEAR})), ''), element_at(p, x.i).g), {NEAR})"""
    after = f"left(array_join(transform(slice(p, x.i + 1, {NEAR // 2}), q -> left(concat(q.g, q.m), {NEAR})), ''), {NEAR})"
    near = f"rlike({before}, '(?i){kind.near}') OR rlike({after}, '(?i){kind.near}')" if kind.near else "false"
    spans = f"transform({valid}, x -> named_struct('start', x.start, 'end', x.end, 'near', {near}))"

    def chained(rows: str, apart: str) -> str:
        """Spans whose neighbour before in ``rows`` is near a word are near it as well, if close by."""
        hit = f"(x.near OR (acc.near AND {apart} <= {NEAR}))"
        return f"""aggregate({rows}, named_struct('start', 0L, 'end', 0L, 'near', false, 'out', cast(array() AS {form})),
            (acc, x) -> named_struct('start', x.start, 'end', x.end, 'near', {hit}, 'out',
                concat(acc.out, array(named_struct('start', x.start, 'end', x.end, 'near', {hit}))))).out"""

    ahead = chained(spans, "x.start - acc.end")
    both = f"reverse({chained(f'reverse({ahead})', 'acc.start - x.end')})"
    score = f"CASE WHEN x.near THEN {kind.score + kind.boost}D ELSE {kind.score}D END"
    return f"""CASE WHEN {kind.gate} THEN flatten(transform(array({pairs}), p -> transform({both if kind.near else spans},
        x -> named_struct('kind', '{kind.name}', 'start', x.start, 'end', x.end, 'score', {score})))) ELSE
        cast(array() AS array<struct<kind: string, start: bigint, end: bigint, score: double>>) END"""


def detect(
    docs: DataFrame, kinds: tuple[Kind, ...] = BASE + ADDED, threshold: float = THRESHOLD, column: str = "spans"
) -> DataFrame:
    """``docs`` with ``column``: array of ``(kind, start, end, score)`` by kind as listed, then start.

    Positions are code points, the end is exclusive. Spans of ``BASE`` kinds are all kept, those of
    others from ``threshold`` on. Null and empty texts have no spans; a column of that name is replaced.
    """
    base = {k.name for k in BASE}
    inner = docs.select(F.struct(*docs.columns).alias("_llm_row"), whole_text().alias("text"))
    found = []
    for kind in kinds:
        spans = F.expr(_spans_of(kind))
        found.append(spans if kind.name in base else F.filter(spans, lambda s: s["score"] >= threshold))
    rest = [F.col("_llm_row")[c].alias(c) for c in docs.columns if c != column]
    return inner.select(*rest, F.concat(*found).alias(column))


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + ADDED, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets; overlapping spans become one,
    named after the first. Texts without spans, null among them, stay as they are."""
    found = detect(docs, kinds, threshold, "_llm_spans")
    ordered = "array_sort(transform(_llm_spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    cut = f"""aggregate({ordered}, named_struct('out', '', 'at', 0L), (acc, s) -> CASE
        WHEN s.start < acc.at THEN named_struct('out', acc.out, 'at', greatest(acc.at, s.end))
        ELSE named_struct('out', concat(acc.out, substring(text, int(acc.at) + 1, int(s.start - acc.at)), '[', upper(s.kind), ']'),
            'at', s.end) END, acc -> concat(acc.out, substring(text, int(acc.at) + 1)))"""
    clean = F.expr(f"CASE WHEN size(_llm_spans) = 0 THEN text ELSE {cut} END")
    return found.select(*[clean.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
