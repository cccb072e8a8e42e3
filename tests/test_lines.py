import pytest

from chronolink.functions import lines as l
from chronolink.operators.headings import headings, list_items


def compact(**kw):
    return lambda c: l.compact_lines(c, **kw)


@pytest.mark.parametrize("text, expected", [
    ("# a\n# b", "BULLET::::1. a\nBULLET::::2. b"),
    ("# a\n## x\n## y\n# b\n## z", "BULLET::::1. a\nBULLET::::1. x\nBULLET::::2. y\nBULLET::::2. b\nBULLET::::1. z"),
    ("# a\n\n# b", "BULLET::::1. a\n\nBULLET::::1. b"),
    ("# a\n* b\n# c", "BULLET::::1. a\nBULLET::::- b\nBULLET::::1. c"),
    ("* a\n*# b\n*# c\n* d", "BULLET::::- a\nBULLET::::1. b\nBULLET::::2. c\nBULLET::::- d"),
    ("# a\n:note\n# b", "BULLET::::1. a\nBULLET::::2. b"),
    ("#\n# b", "BULLET::::1. b"),
    ("; term\n*: x", "BULLET::::- term\nBULLET::::- x"),
    ("*  spaced  ", "BULLET::::- spaced"),
])
def test_lists(apply, text, expected):
    assert apply(compact(), text) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("a\n| cell\n{x\nfoo}\n(aside)\n...\n--\n:indent\n pre\nb", "a\nb"),
    ("a\n\n\n\nb\n\n", "a\n\nb"),
    ("\n\na", "a"),
    ("* i\n| kept after a list", "BULLET::::- i\n| kept after a list"),
    ("== H ==\n pre opens the section\n pre", " pre opens the section"),
    ("++Title++\nx", "Title.\nx"),
    ("a\n|x\n\n|y\n\nb", "a\n\nb"),
])
def test_line_rules(apply, text, expected):
    assert apply(compact(), text) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("a\n== H ==\nb", "a\nSection::::H.\nb"),
    ("== H ==\n\nb", "Section::::H.\nb"),
    ("a\n== H ==\n\nb", "a\n\nSection::::H.\nb"),
    ("== Empty ==\n== Full? ==\nb", "Section::::Full?\nb"),
    ("== A ==\n=== B ===\nb", "Section::::A.\nSection::::B.\nb"),
    ("== A ==\n=== B ===\n== C ==\nc", "Section::::C.\nc"),
    ("=== B ===\n== C ==\n* c", "Section::::C.\nBULLET::::- c"),
    ("a\n== Last ==", "a"),
    ("== A ==\n{x\n== B ==\n|y", ""),
    ("==A== trailing\nx", "Section::::A.\nx"),
    ("== no heading\nx", "== no heading\nx"),
])
def test_sections(apply, text, expected):
    assert apply(compact(keep_sections=True), text) == [expected]


def test_lists_may_be_left_out(apply):
    assert apply(compact(keep_lists=False), "a\n* b\n# c\nd") == ["a\nd"]


def test_headings_table(page):
    text = "x\n== A ==\n=== B ===\n== C ==\nc\n=== D ===\n"
    rows = headings(page(text)).orderBy("heading_no").collect()
    assert [(r.level, r.title, r.filled) for r in rows] == [
        (2, "A.", False), (3, "B.", False), (2, "C.", True), (3, "D.", False),
    ]


def test_list_items_table(page):
    rows = list_items(page("# a\n# b\n* c")).orderBy("item_no").collect()
    assert [(r.marker, r["item"]) for r in rows] == [("1.", "a"), ("2.", "b"), ("-", "c")]


def test_long_pages(apply):
    n = 20_000
    text = "\n".join(["== H ==", *(f"# item {i}" for i in range(n)), "", *("plain text line" for _ in range(n))])
    out = apply(compact(keep_sections=True), text)[0].split("\n")
    assert len(out) == 2 * n + 2
    assert out[n] == f"BULLET::::{n}. item {n - 1}"
