"""Small combinators over string columns.

All of them embed their input expression once, so long chains stay linear in size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    # element_at keeps its type; an index into the array would derive it again for each row
    return F.element_at(F.transform(F.array(value), body), 1)


def replace_where(text: Column, literal: str, pattern: str, replacement: str) -> Column:
    """regexp_replace for texts that contain ``literal``, which every match has; others pass through.

    Looking for the literal works on bytes and costs far less than decoding and matching.
    """
    return let(
        text,
        lambda t: F.when(
            t.contains(literal), F.regexp_replace(t, pattern, replacement)
        ).otherwise(t),
    )


def occurrences(text: Column, literal: str) -> Column:
    """How often ``literal`` occurs in ``text``."""

    def count(t: Column) -> Column:
        removed = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(literal), F.lit("")))
        return F.when(t.contains(literal), (removed / len(literal.encode())).cast("int")).otherwise(F.when(t.isNotNull(), 0))

    return let(text, count)


_CHUNK = 8


def loop_while(
    start: Column,
    active: Callable[[Column], Column],
    advance: Callable[[Column], Column],
    most_rounds: Column,
) -> Column:
    """Advance a state struct while it is active, ``most_rounds`` times at most.

    Most pages need one round or two, which are taken directly. Beyond that: a fold cannot stop early,
    and every step of it copies the state, which here holds a whole page. So rounds are taken in chunks
    of chunks, and an inactive state passes over a chunk in one step.
    """

    def chunk(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        steps = F.sequence(F.lit(1), F.lit(_CHUNK))
        return lambda acc: F.aggregate(steps, acc, lambda inner, _: guarded(step)(inner))

    def guarded(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda acc: F.when(active(acc), step(acc)).otherwise(acc)

    def rest(state: Column) -> Column:
        chunks = F.sequence(F.lit(1), F.ceil(most_rounds / _CHUNK**2).cast("int") + 1)
        body = guarded(chunk(chunk(advance)))
        folded = F.aggregate(chunks, state, lambda acc, _: body(acc))
        return F.when(active(state), folded).otherwise(state)

    once = guarded(advance)
    return let(once(start), lambda first: let(once(first), rest))


def until_stable(
    text: Column,
    step: Callable[[Column], Column],
    opener: str,
    measure: Callable[[Column], Column] | None = None,
) -> Column:
    """Apply ``step`` until the number of ``opener``s stops falling.

    This resolves markup nested to any depth with flat patterns: a round handles the innermost level,
    so there are as many effective rounds as levels. A page without ``opener`` is passed through, and one is
    done with the round that leaves no ``opener`` or changes nothing, before anything is counted. ``measure`` may
    stand for the number where it falls with it and costs less.
    """

    def size(t: Column) -> Column:
        return measure(t) if measure else occurrences(t, opener)

    def settled(n: Column, before: Column) -> Column:
        return ~n.contains(opener) | (n == before)

    def run(t: Column) -> Column:
        def advance(acc: Column) -> Column:
            return let(
                step(acc["text"]),
                lambda n: F.struct(
                    n.alias("text"), size(n).alias("now"), acc["now"].alias("before")
                ),
            )

        def active(acc: Column) -> Column:
            return acc["text"].contains(opener) & (acc["now"] < acc["before"])

        def rest(first: Column, second: Column) -> Column:
            start = F.struct(second.alias("text"), size(second).alias("now"), size(first).alias("before"))
            return loop_while(start, active, advance, occurrences(t, opener))["text"]

        def third(first: Column) -> Column:
            return let(
                step(first),
                lambda second: F.when(settled(second, first), second).otherwise(rest(first, second)),
            )

        def after(first: Column) -> Column:
            return F.when(settled(first, t) | (size(first) >= size(t)), first).otherwise(third(first))

        return F.when(t.contains(opener), let(step(t), after)).otherwise(t)

    return let(text, run)


# Frame a match while a text is taken apart. XML text cannot hold these characters; other texts can, so there they
# are written as ESCAPE and another control character in the meantime, which no pattern here looks for.
OPEN, CLOSE, ESCAPE = "\x03", "\x04", "\x05"
_ESCAPED = {ESCAPE: ESCAPE + "\x06", OPEN: ESCAPE + "\x07", CLOSE: ESCAPE + "\x08"}


def framed(text: Column) -> Column:
    """Whether ``text`` has frame characters of its own."""
    return text.contains(OPEN) | text.contains(CLOSE) | text.contains(ESCAPE)


def escape_frames(text: Column) -> Column:
    """``text`` without frame characters of its own."""

    def escape(t: Column) -> Column:
        escaped = t
        for raw, held in _ESCAPED.items():
            escaped = F.replace(escaped, F.lit(raw), F.lit(held))
        return F.when(framed(t), escaped).otherwise(t)

    return let(text, escape)


def unescape_frames(text: Column) -> Column:
    """What ``escape_frames`` took away is back."""

    def unescape(t: Column) -> Column:
        plain = t
        for raw, held in reversed(_ESCAPED.items()):
            plain = F.replace(plain, F.lit(held), F.lit(raw))
        return F.when(t.contains(ESCAPE), plain).otherwise(t)

    return let(text, unescape)


def split_matches(text: Column, pattern: str | Column, keep: str = "$0") -> Column:
    """The text up to the first match, then one piece per match: ``keep``, CLOSE, what follows.

    One regexp_replace finds the matches (its pattern is compiled once per task); the split itself is
    at a plain character.
    """
    return F.split(F.regexp_replace(text, pattern, f"{OPEN}{keep}{CLOSE}"), OPEN, -1)


def match_of(piece: Column) -> Column:
    """What ``split_matches`` kept of the match in front of a piece."""
    return F.substring_index(piece, CLOSE, 1)


def rest_of(piece: Column) -> Column:
    """The text of a piece behind its match."""
    return F.substring_index(piece, CLOSE, -1)


def cut_at(text: Column, pattern: str | Column, marks: str) -> Column:
    """The pieces of ``text`` between the OPENs of ``marks``, which stand in place of each match.

    With the kept part of a match between two OPENs, pieces of text and matches take turns. Only texts that have
    frame characters of their own are escaped, piece by piece back again.
    """

    def cut(t: Column) -> Column:
        return F.split(F.regexp_replace(t, pattern, marks), OPEN, -1)

    return let(
        text, lambda t: F.when(framed(t), F.transform(cut(escape_frames(t)), unescape_frames)).otherwise(cut(t))
    )


def is_match(i: Column) -> Column:
    """Whether the piece at ``i`` is a match, where texts and matches take turns."""
    return i.bitwiseAND(F.lit(1)) == 1


def rewrite_matches(
    text: Column, pattern: str | Column, rewrite: Callable[[Column, Column], Column]
) -> Column:
    """Replace every match by ``rewrite(match, index)``; replaced text is not scanned again."""
    pieces = F.transform(
        cut_at(text, pattern, f"{OPEN}$0{OPEN}"),
        lambda piece, i: F.when(is_match(i), rewrite(piece, F.shiftright(i, 1))).otherwise(piece),
    )
    return F.array_join(pieces, "")
