"""Repair of conversations: the cheapest edits that leave an optional system row and user-assistant pairs.

Iterative-deepening A*: depth first through the edits in ASCII order of their initials, under a cost bound
that grows to the least overrun, with a table of what each failed state still needs at least. The first path
that ends well is the cheapest and, among the cheapest, the least in ASCII. Long conversations are searched in
windows of rows, from each state a window may begin in to each it may end in, which are then chained backwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolink.llm.common import written

#: Rows of a window.
WINDOW = 64
#: Rows a task hands over at a time.
ROWS = 10_000
SPACES = " \t\n\x0b\f\r"
# faults, the first of a row counts
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# states: nothing yet, after the system row, after a user's, after an assistant's
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # state after a row that an insertion or a new role fits in
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (EMPTY, ASSISTANT)
DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1
PAIRS = ("su", "ua", "au")


def cheapest(rows: list[tuple[str, int]], begin: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits of ``rows (role initial, fault)`` from one state to one of others."""
    if not any(_reachable(rows, begin, end) for end in ends):
        return None
    n = len(rows)
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        forced[i] = forced[i + 1] + (0, DELETE, DELETE, UNFINISHED)[rows[i][1]]
    needs: dict[tuple[int, int], int] = {}  # of failed states: what any way to the end costs at least
    path: list[str] = []

    def deeper(i: int, state: int, left: int) -> int:
        """0 with the edits in ``path`` if they cost no more than ``left``, else more than ``left``: what any cost at least."""
        if i == n and state in ends:
            return 0
        least = needs.get((i, state), forced[i])
        if least > left:
            return least
        over = 1 << 60
        for letter, cost, to, at in _edits(rows, i, state):
            if cost > left:
                need = needs.get((at, to), forced[at])
            else:
                path.append(letter)
                need = deeper(at, to, left - cost)
                if not need:
                    return 0
                path.pop()
            over = min(over, need + cost)
        needs[i, state] = over
        return over

    bound = forced[0]
    while need := deeper(0, begin, bound):
        bound = need
    return bound, "".join(path)


def _edits(rows: list[tuple[str, int]], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """``(initial, cost, state, row)`` of what may be done at row ``i``, in ASCII order."""
    if i == len(rows):
        return [("I", INSERT, NEXT[state], i)]
    initial, fault = rows[i]
    found = [("D", DELETE, state, i + 1), ("I", INSERT, NEXT[state], i)]
    if fault not in (BLANK, DUPLICATE):
        more = UNFINISHED if fault == TRUNCATED else 0
        if initial in KEEPS[state]:
            found.append(("K", more, KEEPS[state][initial], i + 1))
        found.append(("R", REROLE + more, NEXT[state], i + 1))
    return found


def _reachable(rows: list[tuple[str, int]], begin: int, end: int) -> bool:
    if end == EMPTY:
        return begin == EMPTY
    if end == SYSTEM:
        return begin == SYSTEM or begin == EMPTY and any(c == "s" and f in (NONE, TRUNCATED) for c, f in rows)
    return True


@dataclass
class Chain:
    """Edits of a window and what follows them; compared as one string."""

    cost: int
    edits: str
    after: Chain | None = None

    def letters(self) -> Iterator[str]:
        at: Chain | None = self
        while at:
            yield from at.edits
            at = at.after

    def before(self, other: Chain) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        for a, b in zip(self.letters(), other.letters()):
            if a != b:
                return a < b
        return False


def chained(windows: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, str]:
    """The cheapest way through windows, each given as the cheapest edits by the states it begins and ends in."""
    best: dict[int, Chain] = {state: Chain(0, "") for state in ENDS}
    for window in reversed(windows):
        now: dict[int, Chain] = {}
        for (begin, end), (cost, edits) in window.items():
            if end in best:
                way = Chain(cost + best[end].cost, edits, best[end])
                if begin not in now or way.before(now[begin]):
                    now[begin] = way
        best = now
    return best[EMPTY].cost, "".join(best[EMPTY].letters())


@dataclass
class Conversation:
    """One conversation as its rows arrive in order: counts, searched windows, role initials and digests."""

    key: str
    first: int | None = None
    last: int | None = None
    distinct: int = 0
    illegal: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    rows: list[tuple[str, int]] = field(default_factory=list)
    windows: list[dict] = field(default_factory=list)
    initials: list[str] = field(default_factory=list)
    digests: bytearray = field(default_factory=bytearray)

    def add(self, turn: int | None, initial: str, fault: int, digest: bytes) -> None:
        if len(self.rows) == WINDOW:
            self.close()
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        self.faults[fault] += 1
        self.illegal += bool(self.initials) and self.initials[-1] + initial not in PAIRS
        self.initials.append(initial)
        self.rows.append((initial, fault))
        self.digests += digest

    def close(self) -> None:
        """Search a window that is not the whole conversation."""
        ways = {(b, e): cheapest(self.rows, b, (e,)) for b in (range(4) if self.windows else (EMPTY,)) for e in range(4)}
        self.windows.append({k: way for k, way in ways.items() if way})
        self.rows = []

    def result(self) -> Iterator[tuple]:
        """A row of figures; then each row that stays or is put in, with its place, digest, and new role if it gets one."""
        if self.windows:
            self.close()
            cost, audit = chained(self.windows)
        else:
            cost, audit = cheapest(self.rows, EMPTY, ENDS)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        yield (self.key, -1, None, None, gaps, *self.faults[1:], self.illegal, cost, audit)
        row, state = 0, EMPTY
        for place, edit in enumerate(audit):
            taken = row
            row += edit != "I"
            if edit != "D":
                state = KEEPS[state][self.initials[taken]] if edit == "K" else NEXT[state]
                digest = None if edit == "I" else bytes(self.digests[16 * taken : 16 * row])
                role = None if edit == "K" else "user" if state == USER else "assistant"
                yield (self.key, place, digest, role, *[None] * 7)


EDITS = (
    "conv STRING, place LONG, digest BINARY, role STRING, gaps LONG, blank LONG, duplicate LONG, truncated LONG, "
    "illegal LONG, cost LONG, audit STRING"
)


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _marked(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, digest)`` with nulls of text as one space."""
    given = rows.select(
        _named("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), _named("role").alias("role"), _named("text").alias("text")
    )
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return given.withColumn("digest", F.unhex(F.left(F.sha2(told, 256), F.lit(32))))


def _edited(marked: DataFrame) -> DataFrame:
    """``EDITS`` of each conversation. Texts are told by their digests, so none of them is moved here."""
    end = F.rtrim("text", F.lit(SPACES))
    seen = Window.partitionBy("conv", "digest").orderBy(F.asc_nulls_first("turn"))
    compact = marked.select(
        "conv", "turn", "role", F.left("role", F.lit(1)).alias("initial"), "digest", (end == "").alias("blank"),
        F.right(end, F.lit(1)).isin(".", "!", "?").alias("finished"),
    )
    faults = compact.withColumn("again", F.row_number().over(seen) > 1).select(
        "conv", "turn", "role", "initial", "digest",
        F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(~F.col("finished"), TRUNCATED).otherwise(NONE).alias("fault"),
    )
    ordered = faults.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == DUPLICATE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in EDITS.split(", ")]
        open_: Conversation | None = None
        out: list[tuple] = []
        for batch in batches:
            rows = zip(batch.conv, batch.turn, batch.no_turn, batch.initial, batch.fault, batch.digest)
            for conv, turn, no_turn, initial, fault, digest in rows:
                if open_ is None or open_.key != conv:
                    for row in open_.result() if open_ else ():
                        out.append(row)
                        if len(out) == ROWS:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                    open_ = Conversation(conv)
                open_.add(None if no_turn else int(turn), initial, fault, bytes(digest))
        for row in open_.result() if open_ else ():
            out.append(row)
            if len(out) == ROWS:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    sent = ordered.select(
        "conv", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"), "initial", "fault", "digest"
    )
    return sent.mapInPandas(run, EDITS)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation in
    ``rows (conv_id, turn, role, text)``, and its repaired messages ``(conv, place, role, text)``, to be ordered by place.

    ``conv`` is the id as text, one space for null; null roles and texts are one space too. Rows stand in
    order of turn, nulls first, rows of one turn in order of role, then of a hash of the text. An empty role fits
    nowhere. Other columns are not read. One task walks through a conversation in order and keeps some sixty
    bytes of each of its rows, not the texts; the audit of a conversation is one value.
    """
    marked = _marked(rows)
    edits = written(_edited(marked), "edits")
    figures = edits.filter("place = -1").drop("place", "digest", "role")
    chosen = edits.filter("place >= 0").select("conv", "place", "digest", F.col("role").alias("new"))
    texts = marked.select("conv", "digest", "role", "text").dropDuplicates(["conv", "digest"])
    stays = chosen.filter(F.col("digest").isNotNull()).join(texts, ["conv", "digest"])
    kept = stays.select("conv", "place", F.coalesce("new", "role").alias("role"), "text")
    put_in = chosen.filter(F.col("digest").isNull()).select("conv", "place", F.col("new").alias("role"), F.lit("").alias("text"))
    return figures, kept.unionByName(put_in)


def repaired_hashes(messages: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)`` over the messages' ``role:text``, joined by line ends; texts pass one after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sha = None, None
        for batch in batches:
            done = []
            for conv, role, text in zip(batch.conv, batch.role, batch.text):
                if conv != key:
                    done += [(key, sha.hexdigest())] if sha else []
                    key, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
        yield pd.DataFrame([(key, sha.hexdigest())] if sha else [], columns=["conv", "repaired_sha256"])

    ordered = messages.repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.select("conv", "role", "text").mapInPandas(run, "conv STRING, repaired_sha256 STRING")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as a faulty channel leaves them: by a hash of ``conv_id:turn`` one in twenty each is dropped, emptied, loses
    its sentence marks, comes twice, or gets the role user. Nulls are one space."""
    fate = F.crc32(F.concat(_named("conv_id"), F.lit(":"), _named("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _named("role").alias("role"), _named("text").alias("text"), fate.alias("fate"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter("fate > 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    )


def repaired(conversations: DataFrame) -> DataFrame:
    """Figures and the hash of the repaired messages of every conversation after damage; one without rows has zeros."""
    figures, messages = repair(damaged(conversations))
    ids = conversations.select("conv_id", _named("conv_id").alias("conv")).distinct()
    found = ids.join(figures, "conv", "left").join(repaired_hashes(messages), "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
