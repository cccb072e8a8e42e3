"""Dates in several languages, by a dictionary of date words.

Tokens are looked up in the word list of their text's language, which gives each a class; the order of classes
makes a date, whatever the language. Row-local: no exchange, and a further language is a further list of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.functions.compose import let

# --- fixed values -------------------------------------------------------------------------------
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
#: Classes: ``o`` between parts, ``s`` behind the number of a day or century, ``t`` behind the year of a decade,
#: ``c`` and ``g`` century behind and before its number, ``e`` before Christ in one word, ``v`` and ``h`` in two.
WORDS = {
    "en": {"of": "o", "st": "s", "nd": "s", "rd": "s", "th": "s", "s": "t", "century": "c", "bc": "e", "bce": "e"},
    "de": {"er": "t", "jahrhundert": "c", "jahrhunderts": "c", "v": "v", "vor": "v", "chr": "h", "christus": "h"},
    "fr": {"er": "s", "e": "s", "siècle": "c", "av": "v", "avant": "v", "j": "h"},
    "es": {"de": "o", "del": "o", "siglo": "g", "a": "v", "antes": "v", "c": "h", "cristo": "h"},
}
# -------------------------------------------------------------------------------------------------

TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


def date_words() -> dict[str, dict[str, str]]:
    """Class of each date word by language; months are ``m`` and their number."""
    return {
        lang: {w: f"m{i:02d}" for i, w in enumerate(MONTHS[lang].split(), 1)} | WORDS[lang] for lang in MONTHS
    }


def _part(kinds: str) -> str:
    return rf"[{kinds}]\d*:[^ ]+ "


#: Dates in a row of classed tokens, the longest first. No date begins within a token, since a class
#: alone is followed by a colon.
SHAPES = "|".join((
    rf"{_part('d')}(?:{_part('p')})?(?:{_part('o')})?{_part('m')}(?:{_part('oq')})?{_part('y')}",
    rf"{_part('m')}{_part('d')}(?:{_part('q')})?{_part('y')}",
    rf"{_part('m')}(?:{_part('oq')})?{_part('y')}",
    rf"{_part('d')}(?:{_part('p')})?{_part('c')}",
    rf"{_part('g')}{_part('d')}",
    rf"{_part('dny')}{_part('e')}",
    rf"{_part('dny')}{_part('v')}(?:{_part('p')})?{_part('h')}",
    _part("k"),
    _part("y"),
))


def classed(tokens: Column, words: Column) -> Column:
    """``class:token`` of every token with a blank behind it, in one string."""

    def kind(token: Column) -> Column:
        number = F.regexp_extract(token, "^[0-9]*", 0)
        digits = F.length(number)
        known = F.try_element_at(words, F.lower(F.substring(token, digits + 1, F.length(token))))
        plain = (F.length(token) == digits) | (known == "s")
        day = (digits <= 2) & F.coalesce(number.try_cast("int"), F.lit(0)).between(1, 31)
        return (
            F.when(token == ".", "p").when(token == ",", "q")
            .when(digits == 0, F.when(known.isin("s", "t"), "x").otherwise(F.coalesce(known, F.lit("x"))))
            .when(plain & day, "d")
            .when((F.length(token) == digits) & (digits == 4), "y")
            .when((F.length(token) == digits) & (digits <= 3), "n")
            .when((known == "t") & (digits == 4) & number.endswith("0"), "k")
            .otherwise("x")
        )

    return F.array_join(F.transform(tokens, lambda t: F.concat(kind(t), F.lit(":"), t, F.lit(" "))), "")


def date_value(found: Column) -> Column:
    """The value of a match of ``SHAPES``, in the form of the tagged dates: ``YYYY[-MM[-DD]]``, ``BCYYYY``, ``YYY``
    for a decade, ``YY`` for a century, which is the one before the number of its years."""

    def number(kinds: str) -> Column:
        return F.regexp_extract(found, rf"[{kinds}]:(\d+)", 1)

    def two(value: Column) -> Column:
        return F.lpad(value, 2, "0")

    month = F.regexp_extract(found, r"m(\d\d):", 1)
    # class letters alone, in order
    shape = F.regexp_replace(found, r"\d*:[^ ]+ ", "")
    return (
        F.when(shape.rlike("[cg]"), two((number("d").try_cast("int") - 1).cast("string")))
        .when(shape.rlike("[eh]"), F.concat(F.lit("BC"), F.lpad(number("dny"), 4, "0")))
        .when(shape == "k", F.substring(number("k"), 1, 3))
        .when(shape.contains("m") & shape.contains("d"), F.concat_ws("-", number("y"), month, two(number("d"))))
        .when(shape.contains("m"), F.concat_ws("-", number("y"), month))
        .otherwise(number("y"))
    )


def dates_by_language(texts: DataFrame, key: str = "doc_id", words: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """``(key, ord, surface, value)``: the dates of every text, ``ord`` from 1, by the words of the language in ``lang``.

    The surface is the date's tokens, a blank between each. Languages without words, and null, have plain years only;
    null and empty texts have no dates. ``words`` replaces ``date_words()``: class by word in lower case, by language.
    """
    lists = date_words() if words is None else words

    def literal(entries: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(v) for pair in entries.items() for v in pair]) if entries else F.expr(
            "CAST(map() AS MAP<STRING, STRING>)"
        )

    chosen = literal({})
    for lang, entries in lists.items():
        chosen = F.when(F.col("lang") == lang, literal(entries)).otherwise(chosen)
    tokens = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    row = let(chosen, lambda mine: classed(tokens, mine))
    found = texts.select(key, F.posexplode(F.regexp_extract_all(row, F.lit(SHAPES), F.lit(0))).alias("ord", "found"))
    surface = F.rtrim(F.regexp_replace("found", r"(^| )[a-z]\d*:", "$1"))
    return found.select(key, (F.col("ord") + 1).alias("ord"), surface.alias("surface"), date_value(F.col("found")).alias("value"))
