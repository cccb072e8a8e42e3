"""Line rules: lists, headings, residual lines. Row-local, so a page never leaves its task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronolink.functions.compose import OPEN, cut_at, let, replace_where, rewrite_matches

BULLET = "BULLET::::"
SECTION = "Section::::"

_BARE = BULLET + "-"

# (?d): only \n ends a line. A heading needs its closing run, what follows it is ignored.
HEADING = r"(?d)^(==+)\s*(.*?)\s*\1"
_LIST_PREFIX = r"(?md)^[*#;][*#;:]*+"

# Inside this module a heading line is: mark, level as a run of '=', title.
_HEAD = "\x01"
_FILLED = "\x02"
_HEADS = r"(?md)^[\x01\x02](=+)([^\n]*)"
# Headings and blank lines between two pieces of content, and those behind the last piece.
_HEAD_BLOCK = r"(?md)(?:^(?:\x01[^\n]*+)?\n)++"
_HEAD_TAIL = r"(?:(?:\A|\n)(?:\x01[^\n]*+)?)++\z"


def number_list_items(text: Column) -> Column:
    """Write list items as ``BULLET::::- item`` or ``BULLET::::n. item``.

    ``n`` counts the items of one level in a run of lines that share the marker prefix of that
    level. Levels are handled from the outside in, as many as the page has.
    """

    def number_level(t: Column, depth: Column) -> Column:
        outer = (depth - 2).cast("string")
        prefix = F.when(depth == 1, F.lit("#")).otherwise(
            F.concat(F.lit("[*#;][*#;:]{"), outer, F.lit("}#"))
        )
        run = F.concat(F.lit("(?md)^("), prefix, F.lit(r")[^\n]*+(?:\n\1[^\n]*+)*+"))
        item = F.concat(F.lit("(?md)^"), prefix, F.lit(r"(?![*#;:])[^\S\n]*+(?=\S)"))
        return rewrite_matches(
            t,
            run,
            lambda lines, _i: F.array_join(
                F.transform(
                    cut_at(lines, item, OPEN),
                    lambda piece, n: F.when(n == 0, piece).otherwise(
                        F.concat(F.lit(BULLET), n.cast("string"), F.lit(". "), piece)
                    ),
                ),
                "",
            ),
        )

    def number(t: Column) -> Column:
        prefixes = F.regexp_extract_all(t, F.lit(_LIST_PREFIX), F.lit(0))
        # only levels that have items
        levels = F.array_sort(F.array_distinct(F.transform(prefixes, lambda p: F.length(p))))
        return F.when(t.contains("#"), F.aggregate(levels, t, number_level)).otherwise(t)

    return F.regexp_replace(let(text, number), _LIST_PREFIX + r"[^\S\n]*+", BULLET + "- ")


def _with_stop(title: Column) -> Column:
    return F.when((title == "") | title.rlike(r"[!?]\z"), title).otherwise(F.concat(title, F.lit(".")))


def _is_residue(line: Column) -> Column:
    """Leftovers of tables and templates, lines in brackets, lines of dots and dashes."""
    return (
        line.startswith("{")
        | line.startswith("|")
        | line.endswith("}")
        | (line.startswith("(") & line.endswith(")"))
        | ((line.startswith(".") | line.startswith("-") | (line == "")) & (F.btrim(line, F.lit(".-")) == ""))
    )


def _trim_ends(text: Column) -> Column:
    """The text without line ends at its ends; trimming looks at every character, so most texts pass by."""
    return let(
        text,
        lambda t: F.when(t.startswith("\n") | t.endswith("\n"), F.btrim(t, F.lit("\n"))).otherwise(t),
    )


def kept_lines(text: Column, keep_lists: bool = True) -> Column:
    """The lines of a page that survive, as an array; headings are marked, blank lines stay single.

    A marker without an item is dropped, but it belongs to its list. Residues of markup go: table and template lines, bracketed or dotted lines, indents and
    preformatted lines. The line right after a list is always kept, and a preformatted one is kept
    when it opens a section.
    """

    def select(lines: Column) -> Column:
        def keep(line: Column, i: Column) -> Column:
            before = F.coalesce(F.get(lines, i - 1), F.lit(""))
            before2 = F.coalesce(F.get(lines, i - 2), F.lit(""))
            opens = before.startswith(_HEAD) | ((before == "") & before2.startswith(_HEAD))
            return (
                (line == "")
                | line.startswith(_HEAD)
                | line.startswith(BULLET)
                | before.startswith(BULLET)
                | (~_is_residue(line) & (~line.startswith(" ") | opens))
            )

        kept = F.filter(lines, keep)
        return F.filter(
            kept, lambda line: (line != _BARE) if keep_lists else ~line.startswith(BULLET)
        )

    def mark(line: Column) -> Column:
        return (
            F.when(
                line.startswith("==") & line.rlike(HEADING),
                F.concat(
                    F.lit(_HEAD),
                    F.regexp_extract(line, HEADING, 1),
                    _with_stop(F.regexp_extract(line, HEADING, 2)),
                ),
            )
            .when(
                line.startswith("++"),
                _with_stop(F.regexp_extract(line, r"(?d)^\+\+(.*)..\z", 1)),
            )
            .when(line.startswith(BULLET), F.rtrim(line))
            .otherwise(line)
        )

    def unindented(t: Column) -> Column:
        # a line end in front gives the first line the same look as the others
        dropped = F.regexp_replace(F.concat(F.lit("\n"), t), r"\n:[^\n]*+", "")
        return F.when(t.startswith(":") | t.contains("\n:"), dropped).otherwise(t)

    listed = number_list_items(_trim_ends(let(text, unindented)))
    return let(F.transform(F.split(listed, "\n", -1), mark), select)


def _settle_headings(text: Column) -> Column:
    """Mark the headings that have content as filled, and put them behind any blank line.

    A heading waits until content comes; one of the same or a higher level replaces it before that.
    """

    def settle(block: Column, _i: Column) -> Column:
        def level(head: Column) -> Column:
            return F.length(F.regexp_extract(head, _HEADS, 1))

        def render(heads: Column) -> Column:
            lines = F.transform(
                heads,
                lambda h, i: F.concat(
                    F.when(
                        F.exists(
                            F.slice(heads, i + 2, F.size(heads)), lambda g: level(g) <= level(h)
                        ),
                        F.lit(_HEAD),
                    ).otherwise(F.lit(_FILLED)),
                    F.regexp_replace(h, r"^\x01", ""),
                    F.lit("\n"),
                ),
            )
            blank = F.when(block.rlike(r"(?md)^\n"), "\n").otherwise("")
            return F.concat(blank, F.array_join(lines, ""))

        return let(F.regexp_extract_all(block, F.lit(_HEADS), F.lit(0)), render)

    return rewrite_matches(text, _HEAD_BLOCK, settle)


def _split_tail(text: Column) -> Column:
    """Struct of the page up to its last content, and the headings and blank lines behind it."""
    return let(
        text,
        lambda t: let(
            F.regexp_extract(t, _HEAD_TAIL, 0),
            lambda tail: F.struct(
                F.substring(t, F.lit(1), F.length(t) - F.length(tail)).alias("body"),
                tail.alias("tail"),
            ),
        ),
    )


def compact_lines(text: Column, keep_sections: bool = False, keep_lists: bool = True) -> Column:
    """Apply the line rules and give the page back as one string."""
    lines = kept_lines(text, keep_lists)
    if keep_sections:
        body = _settle_headings(_split_tail(F.array_join(lines, "\n"))["body"])
        body = F.regexp_replace(body, r"(?md)^\x01[^\n]*+\n", "")
        body = F.regexp_replace(body, r"(?md)^\x02=+", SECTION)
    else:
        body = F.array_join(F.filter(lines, lambda line: ~line.startswith(_HEAD)), "\n")
    return _trim_ends(replace_where(body, "\n\n\n", r"\n{3,}", "\n\n"))


def heading_lines(text: Column) -> Column:
    """All headings of a page as ``array<struct<level, title, filled>>`` in text order."""
    settled = let(
        _split_tail(F.array_join(kept_lines(text), "\n")),
        lambda p: F.concat(_settle_headings(p["body"]), p["tail"]),
    )
    return F.transform(
        F.regexp_extract_all(settled, F.lit(_HEADS), F.lit(0)),
        lambda head: F.struct(
            F.length(F.regexp_extract(head, _HEADS, 1)).alias("level"),
            F.regexp_extract(head, _HEADS, 2).alias("title"),
            head.startswith(_FILLED).alias("filled"),
        ),
    )
