"""Date mentions: finding, valuing, tagging, normalising.

Dates stay strings, because BC years, decades and centuries are not calendar dates. A tagged date is
a TIMEX3 element as the TimeML standard defines it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronolink.functions.compose import (
    escape_frames,
    let,
    match_of,
    rest_of,
    rewrite_matches,
    split_matches,
    unescape_frames,
)
from chronolink.functions.markup import WORD

# --- fixed values -------------------------------------------------------------------------------
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)
# -------------------------------------------------------------------------------------------------

_MONTH = "|".join(MONTHS)
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
_ERA_BC = r"(?:BCE?|B\.C\.(?:E\.)?)"
_ERA_AD = r"(?:AD|CE|A\.D\.)"

# Longest form first: the engine takes the first alternative that matches. Forms are grouped by their
# first character, so that most positions of a text are passed over after one look.
_DIGIT_FIRST = (
    rf"{_DAY} (?:{_MONTH}),? \d{{4}}",
    r"\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])",
    r"\d{4}-(?:0[1-9]|1[0-2])",
    rf"\d{{1,2}}(?:st|nd|rd|th) century(?: {_ERA_BC})?",
    rf"\d{{1,4}} ?(?:{_ERA_BC}|{_ERA_AD})",
    r"\d{3}0s",
    r"\d{4}",
)
_MONTH_FIRST = (rf"(?:{_MONTH}) {_DAY},? \d{{4}}", rf"(?:{_MONTH}),? \d{{4}}")
_ERA_FIRST = (rf"{_ERA_AD} ?\d{{1,4}}",)


def _starting(first: str, forms: tuple[str, ...]) -> str:
    return rf"(?={first})(?<!{WORD})(?:{'|'.join(forms)})(?!{WORD})"


# digits are listed, since a class of single characters takes one look
DATE = r"(?=[0123456789ACDFJMNOS])(?:{})".format(
    "|".join(
        (
            _starting(r"\d", _DIGIT_FIRST),
            _starting("[JFMASOND]", _MONTH_FIRST),
            _starting("[AC]", _ERA_FIRST),
        )
    )
)

TIMEX = r'<TIMEX3 tid="[^"]*" type="DATE" value="([^"]*)"(?: mod="[^"]*")?>([^<]*)</TIMEX3>'
ANCHOR = r'<a href=" *([^\n]*?)">[^\n]*?</a>'
TAGS = r"<(?:/(?:TIMEX3|a)|(?:TIMEX3|a) [^\n>]*+)>"


def date_value(surface: Column) -> Column:
    """TIMEX3 value of a matched date: ``YYYY[-MM[-DD]]``, ``BCYYYY``, ``YYY`` decade, ``YY`` century."""

    def two(number: Column) -> Column:
        return F.lpad(number, 2, "0")

    def month(name: Column) -> Column:
        names = F.array(*[F.lit(m) for m in MONTHS])
        return two(F.array_position(names, name).cast("string"))

    def group(pattern: str, n: int) -> Column:
        return F.regexp_extract(surface, pattern, n)

    day_first = rf"^(\d{{1,2}})(?:st|nd|rd|th)? ({_MONTH}),? (\d{{4}})$"
    month_first = rf"^({_MONTH}) (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})$"
    month_only = rf"^({_MONTH}),? (\d{{4}})$"
    era = F.when(surface.rlike(rf" ?{_ERA_BC}$"), "BC").otherwise("")
    number = group(r"(\d+)", 1)
    return (
        F.when(surface.rlike(r"^\d{4}(?:-\d{2}){0,2}$"), surface)
        .when(
            surface.rlike(day_first),
            F.concat_ws("-", group(day_first, 3), month(group(day_first, 2)), two(group(day_first, 1))),
        )
        .when(
            surface.rlike(month_first),
            F.concat_ws("-", group(month_first, 3), month(group(month_first, 1)), two(group(month_first, 2))),
        )
        .when(
            surface.rlike(month_only),
            F.concat_ws("-", group(month_only, 2), month(group(month_only, 1))),
        )
        # the 19th century is the years 18xx
        .when(
            surface.contains("century"),
            F.concat(era, two((number.cast("int") - 1).cast("string"))),
        )
        .when(surface.rlike(r"^\d{3}0s$"), F.substring(surface, 1, 3))
        .otherwise(F.concat(era, F.lpad(number, 4, "0")))
    )


def drop_dated_anchors(text: Column) -> Column:
    """A link whose title holds a date is no link: its opening tag goes, its label stays text."""
    return F.regexp_replace(text, rf'<a href="[^"<>\n]*?{DATE}[^"<>\n]*+">', "")


def tag_dates(text: Column) -> Column:
    """Wrap every date in a TIMEX3 element, numbered per page."""

    def tag(surface: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<TIMEX3 tid="t'), (i + 1).cast("string"), F.lit('" type="DATE" value="'),
            date_value(surface), F.lit('">'), surface, F.lit("</TIMEX3>"),
        )

    return rewrite_matches(drop_dated_anchors(text), DATE, tag)


def merge_intervals(sentence: Column) -> Column:
    """Two tagged dates joined by an en dash become one ``[from,till]``.

    The sentence is cut behind each tagged date. A string holds one flag per piece, 1 where only a dash lies before
    the next date; its flags are paired off from the left, so that of three dates in a row the first two are joined.
    """

    def plain(piece: Column) -> Column:
        return ~match_of(piece).contains('" mod="')

    def joined(first: Column, second: Column) -> Column:
        parts = [F.regexp_extract(match_of(p), TIMEX, n) for n in (1, 2) for p in (first, second)]
        tid = F.regexp_extract(match_of(first), 'tid="([^"]*)"', 1)
        return F.concat(
            F.lit('<TIMEX3 tid="'), tid, F.lit('" type="DATE" value="['), parts[0], F.lit(","), parts[1],
            F.lit(']">'), parts[2], F.lit("-"), parts[3], F.lit("</TIMEX3>"),
        )

    def join_pieces(pieces: Column) -> Column:
        def flag(piece: Column, i: Column) -> Column:
            dash = F.btrim(rest_of(piece), F.lit(" ")) == "–"
            short = ~rest_of(piece).contains("  ")
            after = F.get(pieces, i + 1)
            return F.when((i > 0) & after.isNotNull() & dash & short & plain(piece) & plain(after), "1").otherwise("0")

        flags = F.regexp_replace(F.array_join(F.transform(pieces, flag), ""), "1[01]", "<>")

        def written(roles: Column) -> Column:
            def one(piece: Column, i: Column) -> Column:
                role = F.substring(roles, i + 1, F.lit(1))
                return (
                    F.when(i == 0, piece)
                    .when(role == "<", joined(piece, F.get(pieces, i + 1)))
                    .when(role == ">", rest_of(piece))
                    .otherwise(F.concat(match_of(piece), rest_of(piece)))
                )

            return F.array_join(F.transform(pieces, one), "")

        return let(flags, written)

    def merged(text: Column) -> Column:
        cut = unescape_frames(let(split_matches(escape_frames(text), TIMEX), join_pieces))
        return F.when(text.contains("–") & text.contains("<TIMEX3 "), cut).otherwise(text)

    return let(sentence, merged)


def normalize_date(value: Column) -> Column:
    """The value a pair carries; null for what is not a usable date.

    A value is an era, digits and a remainder; how many digits there are says what it dates. Of years
    only a month that ends the value is kept. An interval holds two years, each with or without more.
    """
    era = F.when(value.startswith("BC"), F.lit("BC")).otherwise("")
    plain = F.substring(value, F.length(era) + 1, F.length(value))
    digits = F.regexp_extract(plain, r"^\d*", 0)
    rest = F.substring(plain, F.length(digits) + 1, F.length(plain))
    count = F.length(digits)
    month = F.when((count == 4) & rest.rlike(r"^-\d\d\z"), rest).otherwise("")
    bounds = F.split(F.trim(value, F.lit("[]")), ",")
    dated = F.forall(bounds, lambda b: b.rlike(r"^(?:BC)?\d{4}(?:-\d\d)*\z"))
    interval = value.startswith("[") & value.endswith("]") & (F.size(bounds) == 2) & dated
    return (
        F.when(value.rlike(r"^\d{4}(?:-\d\d)?\z"), value)  # most are plain years
        .when(value.rlike(r"^\d{4}-\d\d-\d\d\z"), F.left(value, F.lit(4)))
        .when(count >= 4, F.concat(era, F.left(digits, F.lit(4)), month))
        .when((count == 3) & (rest == ""), F.concat(F.lit("DECADE "), era, digits))
        .when((count == 2) & (rest == ""), F.concat(F.lit("CENTURY "), era, digits))
        .when(interval, value)
    )


def date_kind(date: Column) -> Column:
    """``decade``, ``century``, ``interval`` or ``date`` for a normalised date."""
    return (
        F.when(date.startswith("DECADE"), "decade")
        .when(date.startswith("CENTURY"), "century")
        .when(date.startswith("["), "interval")
        .otherwise("date")
    )


def year_range(date: Column) -> Column:
    """``struct<from_year, to_year>`` of a normalised date; years BC are negative."""

    def years(token: Column, scale: int) -> Column:
        low = F.regexp_extract(token, r"(\d+)", 1).cast("int") * scale
        high = low + (scale - 1)
        bc = token.contains("BC")
        return F.struct(
            F.when(bc, -high).otherwise(low).alias("from_year"),
            F.when(bc, -low).otherwise(high).alias("to_year"),
        )

    till = F.regexp_extract(date, r",((?:BC)?\d{4})", 1)
    return (
        F.when(date.startswith("DECADE"), years(date, 10))
        .when(date.startswith("CENTURY"), years(date, 100))
        .when(
            date.startswith("["),
            F.struct(
                years(F.regexp_extract(date, r"^\[((?:BC)?\d{4})", 1), 1)["from_year"].alias("from_year"),
                years(till, 1)["to_year"].alias("to_year"),
            ),
        )
        .otherwise(years(F.regexp_extract(date, r"^((?:BC)?\d{4})", 1), 1))
    )
