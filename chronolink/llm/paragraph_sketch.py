"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is a row of cells; each digest is added to three of them. Subtracting two sketches leaves the
digests in which the documents differ, and peeling cells that hold one digest recovers them. Where a
sketch is too small for the difference, larger ones are tried. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolink.llm.common import whole_text, written

CELLS = 24
ROUNDS = 12
#: Cells of one row of a larger sketch, digests that a row gets on average, rounds of peeling it, retries.
ROW_CELLS = 12
ROW_DIGESTS = 3
ROW_ROUNDS = 5
RETRIES = 3
#: Where one paragraph ends: line ends, and within a line the ends of sentences and table cells.
BOUNDARY = r"(?<=[.!?|])\s+|\n+"

_CHECK = "xxhash64({k}, 77L) & 4294967295L"
_EMPTY = "named_struct('n', 0, 'k', 0L, 'c', 0L)"


def digests(text: str, boundary: str = BOUNDARY) -> str:
    """SQL: the distinct digests of the paragraphs of a text."""
    return f"array_distinct(transform(filter(split({text}, r'{boundary}'), p -> p <> ''), p -> xxhash64(p)))"


def _places(seed: str, cells: int = CELLS) -> str:
    third = cells // 3
    return ", ".join(f"int(pmod(xxhash64(k, {seed}, {j}), {third})) + {j * third}" for j in range(3))


def cells_of(found: str, seed: str = "0", cells: int = CELLS) -> str:
    """SQL: the cells of an array of digests; ``seed`` picks the places."""
    placed = f"transform({found}, k -> named_struct('k', k, 'c', {_CHECK.format(k='k')}, 'at', array({_places(seed, cells)})))"
    added = "named_struct('n', x.n + 1, 'k', x.k ^ d.k, 'c', x.c ^ d.c)"
    return f"""aggregate(array({placed}), array(), (acc, ds) -> transform(sequence(0, {cells - 1}), i ->
        aggregate(filter(ds, d -> d.at[i div {cells // 3}] = i), {_EMPTY}, (x, d) -> {added})),
        acc -> acc)""".replace(
        "array(), (acc, ds)", "cast(array() AS array<struct<n: int, k: bigint, c: bigint>>), (acc, ds)"
    )


def peeled(mine: str, other: str, seed: str = "0", cells: int = CELLS, rounds: int = ROUNDS) -> str:
    """SQL: how many digests the difference of two sketches holds; null where it can't be taken apart."""
    minus = f"zip_with({mine}, {other}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"
    return taken_apart(minus, seed, cells, rounds)


def difference_of(mine: str, other: str, seed: str, cells: int) -> str:
    """SQL: the cells of one array of digests less those of another, filled at once."""
    placed = lambda found, n: (
        f"transform({found}, k -> named_struct('n', {n}, 'k', k, 'c', {_CHECK.format(k='k')}, 'at', array({_places(seed, cells)})))"
    )
    third = cells // 3
    return f"""transform(array(concat({placed(mine, 1)}, {placed(other, -1)})), ds -> transform(sequence(0, {cells - 1}), i ->
        aggregate(filter(ds, d -> d.at[i div {third}] = i), {_EMPTY},
            (x, d) -> named_struct('n', x.n + d.n, 'k', x.k ^ d.k, 'c', x.c ^ d.c))))[0]"""


def taken_apart(minus: str, seed: str, cells: int, rounds: int) -> str:
    """SQL: how many digests the cells of a difference hold; null where they can't be taken apart. A round that
    finds no cell with one digest is the last one: nothing is left, or nothing that can be peeled."""
    third = cells // 3
    pure = f"""array_distinct(transform(filter(s.cells, x -> abs(x.n) = 1 AND x.c = ({_CHECK.format(k='x.k')})),
        x -> named_struct('n', x.n, 'k', x.k, 'c', x.c)))"""
    placed = f"transform({pure}, p -> named_struct('n', p.n, 'k', p.k, 'c', p.c, 'at', transform(array(p.k), k -> array({_places(seed, cells)}))[0]))"
    round_ = f"""aggregate(array({placed}), s, (s, ps) -> CASE WHEN size(ps) = 0 THEN named_struct(
        'cells', s.cells, 'found', s.found, 'going', false) ELSE named_struct(
        'cells', transform(s.cells, (x, i) -> aggregate(filter(ps, p -> p.at[i div {third}] = i), x,
            (x, p) -> named_struct('n', x.n - p.n, 'k', x.k ^ p.k, 'c', x.c ^ p.c))),
        'found', s.found + size(ps), 'going', true) END)"""
    return f"""aggregate(sequence(1, {rounds}), named_struct('cells', {minus}, 'found', 0, 'going', true),
        (s, r) -> CASE WHEN s.going THEN {round_} ELSE s END,
        s -> CASE WHEN exists(s.cells, x -> x.n <> 0 OR x.k <> 0 OR x.c <> 0) THEN NULL ELSE s.found END)"""


def serialised(cells: str) -> str:
    return f"array_join(transform({cells}, x -> concat_ws('.', x.n, lower(hex(x.k)), lower(hex(x.c)))), '-')"


def _row(found: str, level: int) -> str:
    """SQL: in how many digests ``found.a`` and ``found.b`` differ, by one row of a larger sketch; where it
    can't be taken apart, by eight rows in other places. Two digests that share all their places every time
    are compared as sets in the end."""
    if level == RETRIES:
        return f"size(array_except({found}.a, {found}.b)) + size(array_except({found}.b, {found}.a))"
    seed, name = str(level + 1), f"g{level + 1}"
    tried = taken_apart(difference_of(f"{found}.a", f"{found}.b", seed, ROW_CELLS), seed, ROW_CELLS, ROW_ROUNDS)
    again = f"aggregate({_split(found, '8', 10 + level)}, 0, (t, {name}) -> t + {_row(name, level + 1)})"
    return f"coalesce({tried}, {again})"


def _split(found: str, parts: str, seed: int) -> str:
    """SQL: the digests of ``found.a`` and ``found.b`` dealt over ``parts`` rows by a hash, which is taken once."""
    placed = lambda side: f"transform({found}.{side}, d -> named_struct('d', d, 'o', int(pmod(xxhash64(d, {seed}L), {parts}))))"
    dealt = lambda side: f"transform(filter(m{seed}.{side}, x -> x.o = o{seed}), x -> x.d)"
    return f"""transform(array(named_struct('a', {placed('a')}, 'b', {placed('b')})), m{seed} -> transform(
        sequence(0, int({parts}) - 1), o{seed} -> named_struct('a', {dealt('a')}, 'b', {dealt('b')})))[0]"""


def differing(mine: str, other: str, mine_cells: str, other_cells: str) -> str:
    """SQL: in how many digests two documents differ. First the sketches themselves are subtracted and
    peeled; where they are too small, a larger sketch of as many rows as the digests ask for is tried. Rows
    are dealt in two steps, so that the work for a long text grows less than with its square."""
    both = f"named_struct('a', {mine}, 'b', {other})"
    rows = f"((size({mine}) + size({other})) div {ROW_DIGESTS} + 1)"
    step = f"ceil(sqrt({rows}))"
    dealt = f"flatten(transform({_split(both, step, 5)}, g -> {_split('g', step, 6)}))"
    larger = f"aggregate({dealt}, 0, (t, g0) -> t + {_row('g0', 0)})"
    return f"coalesce({peeled(mine_cells, other_cells)}, {larger})"


def likeness(mine: str, other: str, differing: str) -> str:
    """SQL: the Jaccard likeness of two sets, from their sizes and the size of their difference."""
    both = f"(size({mine}) + size({other}))"
    return f"CASE WHEN {both} = 0 THEN 1D ELSE ({both} - {differing}) / double({both} + {differing}) END"


def _order(keys: DataFrame) -> DataFrame:
    """``keys (id, h, n)`` with the key ``(prev_id, prev_h, prev_n)`` before each in descending order,
    around the end. Ranges of keys are ordered apart; the driver sees one key of each range."""
    ranged = written(
        keys.repartitionByRange(F.desc("id"), "h").withColumn("range", F.spark_partition_id()), "order"
    )
    near = Window.partitionBy("range").orderBy(F.desc("id"), "h")
    one = F.struct(F.col("id").alias("prev_id"), F.col("h").alias("prev_h"), F.col("n").alias("prev_n"))
    last = ranged.groupBy("range").agg(F.max_by(one, F.struct(-F.col("id"), "h")).alias("last")).orderBy("range").collect()
    ends = [(r["range"], last[i - 1]["last"]) for i, r in enumerate(last)]
    before = keys.sparkSession.createDataFrame(
        [(k, tuple(e)) for k, e in ends], "range INT, end STRUCT<prev_id: LONG, prev_h: LONG, prev_n: INT>"
    )
    lagged = ranged.withColumn("prev", F.lag(one).over(near)).join(F.broadcast(before), "range")
    return lagged.select("id", "h", F.coalesce("prev", "end").alias("prev")).select("id", "h", "prev.*")


def fingerprints(docs: DataFrame, boundary: str = BOUNDARY) -> DataFrame:
    """Each document's sketch against that of its edited text and of the next document.

    Columns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. The next document is that of the next smaller id, after the last
    the first; the edited text has its second half replaced by the beginning of the next document. Null
    texts count as empty; two empty texts are alike (1). Null ids come last. Rows with one id and text
    count as one document and are returned repeatedly; of one id with several texts, each is a
    document. A text is moved once, its beginning once more; the order is found on keys alone.
    """
    least = F.lit(-(1 << 63) + 1)
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), least).alias("id"), whole_text().alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    order = _order(base.select("id", "h", F.length("text").alias("n")).distinct())
    own = base.join(order, ["id", "h"])  # both uses of it below read one shuffle of the texts
    following = own.select(
        F.col("prev_id").alias("id"), F.col("prev_h").alias("h"),
        F.expr("left(text, prev_n div 2)").alias("head"), F.expr(digests("text", boundary)).alias("next"),
    ).dropDuplicates(["id", "h"])
    joined = own.select("id", "h", "text").join(following, ["id", "h"])
    joined = joined.withColumn("n", F.length("text")).withColumn("edited", F.expr("concat(left(text, n - n div 2), head)"))
    found = joined.select(
        "id", "n", F.sha2("edited", 256).alias("edited_sha256"), "next",
        F.expr(digests("text", boundary)).alias("own"), F.expr(digests("edited", boundary)).alias("changed"),
    )
    sketched = found.withColumns({
        "own_cells": F.expr(cells_of("own")), "changed_cells": F.expr(cells_of("changed")), "next_cells": F.expr(cells_of("next")),
    })
    result = sketched.withColumns({
        "d_edited": F.expr(differing("own", "changed", "own_cells", "changed_cells")),
        "d_next": F.expr(differing("own", "next", "own_cells", "next_cells")),
    })
    return result.select(
        F.when(F.col("id") != least, F.col("id")).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"), "edited_sha256", F.expr(serialised("own_cells")).alias("fingerprint"),
        F.expr(serialised("changed_cells")).alias("edited_fingerprint"),
        F.expr(likeness("own", "changed", "d_edited")).alias("near_edited"), F.expr(likeness("own", "next", "d_next")).alias("near_next"),
    )
