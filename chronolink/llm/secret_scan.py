"""Secret scans: patterns for known forms, and the guess cost of values in a credential context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import whole_text, written

#: Log10 of the guesses from which a value counts as chosen to be secret.
SECRET_COST = 10.5
#: Corpus words that prose is told by, at most, and how often one stands there at least.
FREQUENT_WORDS = 20_000
LEAST_COUNT = 3

# Words that guessing starts with, most likely first.
WORDS = (
    "password pass admin welcome login letmein qwerty monkey dragon master hello sunshine princess football "
    "shadow secret baseball superman batman trustno test user guest root default changeme example sample "
    "dummy placeholder none null true false your value key token string text here insert enter api username "
    "email account server local host database mysql postgres redis oracle system manager public private "
    "spring summer autumn winter january february march april june july august september october november "
    "december monday friday sunday love money freedom hunter killer soccer hockey tiger ginger pepper cookie "
    "coffee flower diamond silver golden purple orange yellow blue green black white red the and you for"
).split()
# Neighbours on a keyboard and in counting.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "0123456789", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujm")

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?ai:pwd|pass(?:phrase|code|wd|word)?|secret|token|bearer|credentials?|auth|api_?key|access_?key|private_?key)"""
    r"""["']?[\x20\t]{0,4}(?:[:=]|\bis\b)?[\x20\t]{0,4}["']?(?P<value>[!-~]{6,})|://[^\s:@/]{1,64}:(?P<login>[^\s@/]{6,})@"""
)
# For Spark: a word of prose in its first group; values in a credential context match without it.
_PLAIN_WORD = (
    r"""(?<![A-Za-z0-9])(?i:pwd|pass(?:phrase|code|wd|word)?|secret|token|bearer|credentials?|auth|api_?key|access_?key|private_?key)"""
    r"""["']?[\x20\t]{0,4}(?:[:=]|\bis\b)?[\x20\t]{0,4}["']?[!-~]{6,}|://[^\s:@/]{1,64}:[^\s@/]{6,}@"""
    r"""|(?<![A-Za-z0-9])([A-Z]?[a-z]{3,}|[A-Z]{4,})(?![A-Za-z0-9])"""
)
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_LEET = str.maketrans("@4301!$5+7", "aaeoiisstt")
_CLASSES = ((lambda c: c in "_-.", 3), (str.islower, 26), (str.isupper, 26), (str.isdigit, 10))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the plain forms, leftmost and without overlap per kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


class GuessCost:
    """The least cost at which a value is pieced together from what guessers try."""

    def __init__(self, words: list[str]):
        self.words = {w: math.log10(rank + 1) for rank, w in reversed(list(enumerate(words, 1)))}
        self.longest = max(map(len, self.words), default=0)
        self.next = {a + b for row in ROWS for r in (row, row[::-1]) for a, b in zip(r, r[1:])}

    def pieces(self, value: str, lower: str, plain: str, at: int) -> Iterator[tuple[int, float]]:
        """``(end, cost)`` of words, dates, keyboard walks and repeats that begin at a position."""
        for end in range(at + 3, min(len(value), at + self.longest) + 1):
            cost = self.words.get(lower[at:end])
            if cost is None and (cost := self.words.get(plain[at:end])) is not None:
                cost += 0.6
            if cost is not None:
                part = value[at:end]
                yield end, cost + (0.0 if part.islower() else 0.3 if part[1:].islower() or part.isupper() else 0.1 * len(part))
        for match in filter(None, [_DATE.match(value, at)]):
            yield match.end(), math.log10(120 * (366 if match.end() - at > 4 else 1))
        end = at + 1
        while end < len(value) and lower[end - 1 : end + 1] in self.next:
            end += 1
            if end - at >= 3:
                yield end, math.log10(50 * (end - at))
        for unit in range(1, 9):
            end = at + 2 * unit
            if at >= unit and value[at - unit : at] == value[at : at + unit]:
                continue  # counted from where the repeats begin
            while end <= len(value) and value[end - unit : end] == value[at : at + unit]:
                yield end, sum(map(char_cost, value[at : at + unit])) + math.log10(end - at)
                end += unit

    def __call__(self, value: str) -> float:
        """Log10 of the guesses, by dynamic programming over positions: to a position's least cost each
        piece that begins there is added, or one character by brute force; each change of kind costs."""
        n, lower = len(value), value.lower()
        plain = lower.translate(_LEET)
        least = [0.0] + [math.inf] * n  # after a whole piece
        brute = [math.inf] * (n + 1)  # within a run of single characters
        for at in range(n):
            here = min(least[at], brute[at])
            one = char_cost(value[at])
            brute[at + 1] = min(brute[at + 1], brute[at] + one, least[at] + 0.3 + one)
            for end, cost in self.pieces(value, lower, plain, at):
                least[end] = min(least[end], here + 0.3 + cost)
        return min(least[n], brute[n])


def char_cost(c: str) -> float:
    return math.log10(next((size for test, size in _CLASSES if test(c)), 33))


def frequent_words(docs: DataFrame, most: int = FREQUENT_WORDS, least: int = LEAST_COUNT) -> list[str]:
    """The most frequent words of the texts, in lower case; what stands in a credential context is not counted.

    Words are dealt to ranges by count, then alphabet. Only the first ranges that hold ``most`` words are sorted to the
    end, so the driver gets fewer than twice as many, however many partitions and words of one count there are.
    """
    found = F.explode(F.regexp_extract_all(whole_text(), F.lit(_PLAIN_WORD), F.lit(1)))
    counts = docs.select(found.alias("word")).filter("word <> ''").groupBy(F.lower("word").alias("word")).count()
    order = [F.desc("count"), F.asc("word")]
    ranged = counts.filter(F.col("count") >= least).repartitionByRange(*order)
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "words")
    sizes = {r.part: r["count"] for r in ranged.groupBy("part").count().collect()}  # a row per range
    last, held = -1, 0
    for part in sorted(sizes):
        if held >= most:
            break
        last, held = part, held + sizes[part]
    top = ranged.filter(F.col("part") <= last).orderBy(*order).limit(most)
    return [r.word for r in top.select("word").collect()]


def added_spans(
    text: str, cost: GuessCost, secret_cost: float = SECRET_COST, letters_cost: GuessCost | None = None
) -> list[tuple[int, int, str]]:
    """Values in a credential context that are costly to guess. ``letters_cost`` decides as well about
    those of letters alone, which can be words of prose."""
    found = []
    for match in _CONTEXT.finditer(text):
        group = "value" if match["value"] is not None else "login"
        value = match[group].rstrip(".,;:!?)'\"")
        if len(value) < 6 or cost(value) < secret_cost:
            continue
        if letters_cost is None or not value.isalpha() or letters_cost(value) >= secret_cost:
            found.append((match.start(group), match.start(group) + len(value), "guess"))
    return found


def scan(docs: DataFrame, words: tuple[str, ...] = tuple(WORDS), secret_cost: float = SECRET_COST) -> DataFrame:
    """``(doc_id, spans)`` for each row: array of ``(start, end, kind)`` by start, then kind, in code points.

    Kinds are assign, access and hex, and guess for what the guess cost adds; base spans always stay.
    Null and empty texts have no spans; repeated rows are scanned repeatedly; other columns are not read.
    ``words`` replaces the guessers' word list, most likely first. Values of letters alone are also pieced
    together from the corpus's own frequent words, so that prose after a credential word is no secret: the
    ``FREQUENT_WORDS`` most frequent ones that stand at least ``LEAST_COUNT`` times. That word list depends on the
    table, and so do such added spans; base spans do not.
    """
    frequent = frequent_words(docs)
    order = {k: i for i, k in enumerate(("assign", "access", "hex", "guess"))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cost, letters_cost = GuessCost(list(words)), GuessCost([*words, *frequent])
        for batch in batches:
            spans = []
            for text in batch.text:
                found = base_spans(text) + added_spans(text, cost, secret_cost, letters_cost)
                found.sort(key=lambda s: (s[0], order[s[2]], s[1]))
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
            yield pd.DataFrame({"doc_id": batch.doc_id, "spans": spans})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(
        run, f"doc_id {kind}, spans ARRAY<STRUCT<start: LONG, end: LONG, kind: STRING>>"
    )
