"""SentencePiece BPE with offsets: normalisation that records where each byte came from, and pieces projected back.

The normaliser replaces the longest prefix that its compiled character map knows (a double-array trie), and
keeps for every normalised byte the source byte it stands for. Merging then works on normalised words, and
the lengths of a text's pieces, summed up, are looked up in that record: every piece gets its byte span
in the text as it was given.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chronolink.llm.common import whole_text

SPACE = "▁"
#: Fixed values of the model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Words of more characters merge by a heap, shorter ones side by side in arrays.
SHORT = 48
#: Characters of short words that merge side by side.
HELD_CHARS = 1_000_000
#: Words whose ids a task remembers before it starts anew.
KNOWN_WORDS = 400_000
_NONE = np.int64(1) << 62


class CharacterMap:
    """The compiled character map: the size of a double array, the array, and the replacements, zero-ended."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]
        self.alone: dict[str, bool] = {}

    @staticmethod
    def _below(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def walk(self, data: bytes) -> tuple[int, int, int]:
        """Length of the longest rule that ``data`` begins with, its value, and the node that all of ``data`` leads to, -1 if none."""
        node, best, value = self._below(self.units[0]), 0, 0
        for n, byte in enumerate(data, 1):
            node ^= byte
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != byte:
                return best, value, -1
            node ^= self._below(unit)
            if unit >> 8 & 1:
                best, value = n, self.units[node] & 0x7FFFFFFF
        return best, value, node

    def rule(self, text: str, at: int) -> tuple[int, str]:
        """Characters that the longest rule at ``at`` takes, and what it puts there; a character without a rule stays."""
        first = text[at]
        if first not in self.alone:  # whether no rule of more characters begins with this one
            node = self.walk(first.encode())[2]
            self.alone[first] = node < 0 or not any(
                (node ^ b) < len(self.units) and self.units[node ^ b] & 0x800000FF == b for b in range(1, 256)
            )
        data = (first if self.alone[first] else text[at : at + 64]).encode()
        size, value, _ = self.walk(data)
        if not size:
            return 1, first
        end = self.replacements.index(b"\0", value)
        return len(data[:size].decode()), self.replacements[value:end].decode()


@dataclass
class Model:
    """What encoding and decoding need of a model file; it does not grow with the data."""

    pieces: list[str]
    kinds: list[int]
    scores: list[float]
    character_map: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = False
    escape: bool = True
    byte_fallback: bool = True
    unknown_surface: str = " ⁇ "
    eos: int = 2
    symbols: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        """Symbols are pieces that may be merged into, and characters; pairs ``left, right -> symbol`` by rank."""
        mergeable = {p: s for p, k, s in zip(self.pieces, self.kinds, self.scores) if k == NORMAL and p}
        names = dict.fromkeys(sorted(mergeable)) | dict.fromkeys(sorted(set("".join(mergeable))))
        self.symbols = {name: i for i, name in enumerate(names)}
        order = {s: i for i, s in enumerate(sorted(set(mergeable.values()), reverse=True))}
        found = [
            (self.symbols[p[:k]] << 32 | self.symbols[p[k:]], order[s], self.symbols[p])
            for p, s in mergeable.items() for k in range(1, len(p)) if p[:k] in self.symbols and p[k:] in self.symbols
        ]
        table = np.array(sorted(found) or np.zeros((0, 3)), np.int64).reshape(-1, 3)
        self.pair, self.rank, self.merged = (np.ascontiguousarray(table[:, i]) for i in range(3))

    def cutter(self) -> re.Pattern | None:
        """Words that merge on their own, since no piece goes over their ends; None if the whole text is one.

        They end before a space, and after letters before a sign that no piece has after one of these; a
        character that only stands alone in pieces, or is in none, is a word.
        """
        longer = [p for p, k in zip(self.pieces, self.kinds) if k == NORMAL and len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer):
            return None
        inner = set("".join(longer)) - {SPACE}
        letters = {c for c in inner if c.isalpha()}
        bound = {b for p in longer for a, b in zip(p, p[1:]) if a in letters} - letters
        # half a surrogate, which no text holds, stands for an empty class
        a, j, s = ("".join(map(re.escape, sorted(x))) or "\ud800" for x in (letters, bound, inner - letters - bound))
        rest = f"[{a}]*+(?:[{j}][{s}{j}]*+[{a}]*+)*+"
        return re.compile(f"{SPACE}++[{s}{j}]*+{rest}|[{s}{j}]++{rest}|[{a}]++{rest}|[^{a}{j}{s}{SPACE}]")


def read_model(path: str) -> Model:
    """A BPE model without symbols of its user or unused pieces."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, train = proto.normalizer_spec, proto.trainer_spec
    kinds = [p.type for p in proto.pieces]
    if train.model_type != BPE or {USER_DEFINED, UNUSED} & set(kinds) or train.treat_whitespace_as_suffix:
        raise ValueError("only BPE models without user-defined or unused pieces, spaces before words")
    return Model(
        [p.piece for p in proto.pieces], kinds, [p.score for p in proto.pieces], norm.precompiled_charsmap, norm.add_dummy_prefix,
        norm.remove_extra_whitespaces, norm.escape_whitespaces, train.byte_fallback, train.unk_surface, train.eos_id,
    )


class Words(dict):
    """Numbers for words in order of their arrival; ``fresh`` are those whose ids are not known yet.

    Words go by what follows their one space, or by all of them after a null character.
    """

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.fresh: list[str] = []

    def __missing__(self, name: str) -> int:
        self.fresh.append(name[1:] if name[:1] == "\0" else SPACE + name)
        self[name] = number = len(self)
        return number


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices ``values[start : start + count]`` one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - counts)).astype(kind), counts)
    at += np.arange(total, dtype=kind)
    return values.take(at)


class Strings:
    """Byte strings by number, joined many at a time."""

    def __init__(self, strings: list[bytes]):
        self.values = np.frombuffer(b"".join(strings), np.uint8)
        self.counts = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def join(self, ids: np.ndarray) -> bytes:
        return gather(self.values, self.starts[ids], self.counts[ids]).tobytes()


class Coder:
    """Encodes and decodes texts; remembers the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.map = CharacterMap(model.character_map) if model.character_map else None
        self.cut = model.cutter()
        self.lines = not any("\n" in p for p in model.pieces)  # a line's end is a word
        self.names = list(model.symbols)
        self.ids = {p: i for i, p in enumerate(model.pieces)}
        self.unknown = model.kinds.index(UNKNOWN)
        normal = [k == NORMAL for k in model.kinds]
        by_symbol = [i if (i := self.ids.get(n, -1)) >= 0 and normal[i] else -1 for n in self.names]
        self.by_symbol = np.array([*by_symbol, -1], np.int64)
        bytes_of = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.byte_ids = [bytes_of.get(b, self.unknown) for b in range(256)]
        self.value = np.full(len(model.pieces), -1, np.int16)
        self.value[[*bytes_of.values()]] = [*bytes_of]
        self.size = np.array([len(p.encode()) if k == NORMAL else 0 for p, k in zip(model.pieces, model.kinds)], np.int64)
        self.surfaces = Strings([self._surface(p, k) for p, k in zip(model.pieces, model.kinds)])
        self.decimals = Strings([f"{i} ".encode() for i in range(len(model.pieces))])
        self.at_char = np.arange(0x110000, dtype=np.int64) + len(self.names)
        for name, i in model.symbols.items():
            if len(name) == 1:
                self.at_char[ord(name)] = i
        self._pair_table()
        self.forget()

    def _pair_table(self) -> None:
        """Pairs by hash, each in the first free slot after its own."""
        m, bits = self.model, 21
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_pair = np.zeros(1 << bits, np.int64)
        left, slot = np.arange(len(m.pair)), self._slot(m.pair)
        while len(left):
            first = np.unique(slot, return_index=True)[1]
            first = first[self.slot_key[slot[first]] == -1]
            self.slot_key[slot[first]], self.slot_pair[slot[first]] = m.pair[left[first]], left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 where the key is none."""
        slot = self._slot(key)
        held = self.slot_key[slot]
        out = np.where(held == key, self.slot_pair[slot], -1)
        open_ = np.flatnonzero((held != key) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slot_key) - 1)
            held = self.slot_key[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.slot_pair[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def forget(self) -> None:
        self.words = Words({"\0": 0})  # nothing, between the ends of two lines
        self.flat = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(1, np.int64)

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        return {CONTROL: "", UNKNOWN: self.model.unknown_surface}.get(kind, piece.replace(SPACE, " ")).encode()

    # --- normalisation -------------------------------------------------------------------------------
    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte of ``text`` it stands for."""
        m = self.model
        space = SPACE if m.escape else " "
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map is None and not m.squeeze:
            data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            wide = len(space.encode())
            spaces = np.flatnonzero(data == 32)
            front = wide if m.dummy_prefix else 0
            step = np.ones(front + len(data) + (wide - 1) * len(spaces) + 1, np.int32)  # from each byte's source to the next one's
            step[: front + 1] = 0
            for k in range(1, wide):
                step[front + spaces + (wide - 1) * np.arange(len(spaces)) + k] = 0
            back = np.cumsum(step, dtype=np.int32)
            return (space if m.dummy_prefix else "") + text.replace(" ", space), back
        return self._mapped(text, space)

    def _mapped(self, text: str, space: str) -> tuple[str, np.ndarray]:
        m, at, begin = self.model, 0, 0
        steps = []  # what each rule puts, and the byte where its source begins
        while at < len(text):
            n, put = self.map.rule(text, at) if self.map else (1, text[at])
            steps.append((put, begin))
            begin += len(text[at : at + n].encode())
            at += n
        first = 0
        if m.squeeze:
            while first < len(steps) and steps[first][0] == " ":
                first += 1
        if first == len(steps):
            return "", np.full(1, begin, np.int64)
        out, back = [], []

        def add(put: str, source: int) -> None:
            out.append(put)
            back.extend([source] * len(put.encode()))

        if m.dummy_prefix:
            add(space, steps[first][1])
        after_space = m.squeeze
        for put, source in steps[first:]:
            put = put.lstrip(" ") if after_space else put
            if put:
                add(put.replace(" ", space), source)
                after_space = m.squeeze and put.endswith(" ")
        text, end = "".join(out), begin
        if m.squeeze:
            while text.endswith(space):
                text = text[: -len(space)]
                del back[len(text.encode()) + 1 :]
                end = back.pop()
        return text, np.array([*back, end], np.int64)

    # --- merging ---------------------------------------------------------------------------------------
    def learn(self) -> None:
        """Find the ids of fresh words, shorter ones side by side."""
        fresh, self.words.fresh = self.words.fresh, []
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        number, counts, flat = [], [], []  # of words in order of their ids in flat

        def keep(which: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
            number.append(which)
            counts.append(n)
            flat.append(ids.astype(np.int32))

        short = np.flatnonzero(sizes <= SHORT)
        step = HELD_CHARS // SHORT
        for begin in range(0, len(short), step):
            self._merge_short(fresh, short[begin : begin + step], keep)
        for i in np.flatnonzero(sizes > SHORT):
            ids = self._ids(self._merge_long(fresh[i]), fresh[i])
            keep(np.array([i]), np.array([len(ids)]), np.array(ids, np.int32))
        if fresh:
            n, which = np.concatenate(counts), np.argsort(np.concatenate(number))
            starts = len(self.flat) + np.cumsum(n) - n
            self.starts, self.counts = np.concatenate([self.starts, starts[which]]), np.concatenate([self.counts, n[which]])
            self.flat = np.concatenate([self.flat, *flat])

    def _ids(self, symbols: list[int], word: str) -> list[int]:
        """The ids of symbols; a character that is no piece becomes its bytes or the unknown piece."""
        ids, at = [], 0
        for s in symbols:
            size = len(self.names[s]) if s < len(self.names) else 1
            i = int(self.by_symbol[min(s, len(self.names))])
            if i >= 0:
                ids.append(i)
            elif self.model.byte_fallback:
                ids.extend(self.byte_ids[b] for b in word[at : at + size].encode("utf-8", "replace"))
            else:
                ids.append(self.unknown)
            at += size
        return ids

    def _merge_short(self, fresh: list[str], which: np.ndarray, keep) -> None:
        """Words in one array: in each round every word contracts its leftmost pair of the best rank."""
        m, texts = self.model, [fresh[i] for i in which]
        symbol = self.at_char[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")]
        word = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        merged = np.zeros(len(symbol), np.int64)  # what a symbol and the next one make, and at which rank
        rank = np.full(len(symbol), _NONE)

        def look(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < len(symbol) - 1)]
            at = at[word[at] == word[at + 1]]
            found = self._find(symbol[at] << 32 | symbol[at + 1])
            rank[at] = np.where(found >= 0, m.rank[found], _NONE)
            merged[at] = m.merged[found]

        if len(m.pair):
            look(np.arange(len(symbol)))
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(symbol)])
            best = np.minimum.reduceat(np.where(rank == _NONE, _NONE, rank << 32 | np.arange(len(rank))), starts)
            done = best == _NONE
            ended = np.repeat(done, sizes)
            if done.any():
                ids = self.by_symbol[np.minimum(symbol[ended], len(self.names))]
                n, w = sizes[done], word[starts[done]]
                begin = np.cumsum(n) - n
                plain = np.minimum.reduceat(ids, begin) >= 0
                keep(which[w[plain]], n[plain], ids[np.repeat(plain, n)])
                for a, b, i in zip(starts[done][~plain], sizes[done][~plain], w[~plain]):
                    ids = self._ids(symbol[a : a + b].tolist(), texts[i])
                    keep(which[[i]], np.array([len(ids)]), np.array(ids))
            places = best[~done] & 0xFFFFFFFF
            symbol[places] = merged[places]
            rank[places] = _NONE
            stays = ~ended
            stays[places + 1] = False
            places = (np.cumsum(stays) - 1)[places]
            symbol, word, rank, merged = symbol[stays], word[stays], rank[stays], merged[stays]
            rank[places[places > 0] - 1] = _NONE
            look(np.concatenate([places - 1, places]))

    def _merge_long(self, word: str) -> list[int]:
        """One word by a heap of its pairs, best rank first, then leftmost."""
        m = self.model
        symbols = self.at_char[np.frombuffer(word.encode("utf-32-le", "replace"), "<u4")].tolist()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        pairs = dict(zip(m.pair.tolist(), zip(m.rank.tolist(), m.merged.tolist()))) if not hasattr(self, "pairs") else self.pairs
        self.pairs, heap = pairs, []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(symbols) and (p := pairs.get(symbols[i] << 32 | symbols[after[i]])):
                heap.append((p[0], i, p[1], symbols[i], symbols[after[i]]))

        for i in range(len(symbols)):
            offer(i)
        heapq.heapify(heap)
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= len(symbols) or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = merged, -1, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            for k in (before[i], i):
                size = len(heap)
                offer(k)
                if len(heap) > size:
                    heapq._siftdown(heap, 0, len(heap) - 1)
        return [s for s in symbols if s != -1]

    # --- texts -------------------------------------------------------------------------------------------
    def _names(self, text: str) -> list[str]:
        """The words of a normalised text, as ``Words`` has them."""
        if not self.cut:
            return ["\0" + text] if text else []
        if self.lines and text.startswith(SPACE) and SPACE * 2 not in text and "\0" not in text:
            return text.replace("\n", f"{SPACE}\0\n{SPACE}\0").split(SPACE)[1:]
        return [w[1:] if w[0] == SPACE else "\0" + w for w in self.cut.findall(text)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(ids, begins, ends)`` of each text; spans are bytes of the text as it was given. No end id."""
        if len(self.words) > KNOWN_WORDS:
            self.forget()
        normal = [self.normalize(t) for t in texts]
        number, found = self.words.__getitem__, []
        for t, _ in normal:
            names = self._names(t)
            found.append(np.fromiter(map(number, names), np.int64, len(names)))
        self.learn()
        out = []
        for (text, back), words in zip(normal, found):
            ids = gather(self.flat, self.starts[words], self.counts[words])
            sizes = self._sizes(ids, text)
            if not self.model.byte_fallback:
                unknown = ids == self.unknown
                first = ~(unknown & np.r_[False, unknown[:-1]])  # a run of unknown characters is one piece
                sizes = np.add.reduceat(sizes, np.flatnonzero(first)) if len(ids) else sizes
                ids = ids[first]
            ends = np.cumsum(sizes)
            out.append((ids, back[ends - sizes], back[ends]))
        return out

    def _sizes(self, ids: np.ndarray, text: str) -> np.ndarray:
        """Normalised bytes of each piece; of the bytes of a character the last piece has them all."""
        sizes = self.size[ids]
        value = self.value[ids]
        lead = np.flatnonzero((value >= 0) & ((value < 0x80) | (value >= 0xC0)))
        if len(lead):
            v = value[lead]
            wide = 1 + (v >= 0xC0) + (v >= 0xE0) + (v >= 0xF0).astype(np.int64)
            sizes[lead + wide - 1] = wide
        if not self.model.byte_fallback and (unknown := np.flatnonzero(ids == self.unknown)).size:
            sizes[unknown] = [len(c.encode()) for c in text if c not in self.ids or self.model.kinds[self.ids[c]] != NORMAL][: len(unknown)]
        return sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids: spaces for the space sign, none for the one in front, bytes joined to characters."""
        data = self.surfaces.join(ids)
        if self.model.dummy_prefix or self.model.squeeze:
            front = next((i for i in map(int, ids) if self.model.kinds[i] != CONTROL), None)
            if front is not None and self.model.pieces[front].startswith(SPACE):
                data = data[1:]
        try:
            data.decode()
        except UnicodeDecodeError:  # only ids that no text encodes to: each odd byte becomes a replacement character
            data = b"".join(
                c.encode("utf-8") if not 0xDC80 <= ord(c) <= 0xDCFF else "�".encode() for c in data.decode("utf-8", "surrogateescape")
            )
        return data

    def decimal(self, ids: np.ndarray) -> bytes:
        """Ids as decimal numbers, joined by one space."""
        return self.decimals.join(ids)[:-1]


def encode_decode(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32)`` of each row; ``with_spans`` adds ``ids``, ``begins``, ``ends`` and ``decoded``.

    The end id follows the pieces of every text, an empty one included, and has no span. ``ids_sha256``
    is over decimal ids joined by one space; ``spans_crc32`` over begins, then ends, as little-endian
    64-bit integers. Null texts count as empty; repeated rows are coded repeatedly; other columns are not
    read. A text is held whole by its task, as is a word; the model does not grow with the data and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING, spans_crc32 LONG"
    schema += ", ids ARRAY<INT>, begins ARRAY<LONG>, ends ARRAY<LONG>, decoded STRING" if with_spans else ""

    def row(coder: Coder, coded: tuple) -> tuple:
        ids, begins, ends = coded
        listed = np.append(ids, np.int32(coder.model.eos))
        decoded = coder.decode(listed)
        crc = zlib.crc32(ends.astype("<i8").tobytes(), zlib.crc32(begins.astype("<i8").tobytes()))
        told = hashlib.sha256(coder.decimal(listed)).hexdigest()
        found = len(listed), told, hashlib.sha256(decoded).hexdigest(), crc
        return (*found, listed, begins, ends, decoded.decode()) if with_spans else found

    names = [c.split()[0] for c in schema.split(", ")][1:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Model.__new__(Model)
        vars(known).update(shared.value)
        coder = Coder(known)
        for batch in batches:
            rows = [row(coder, coded) for coded in coder.encode(list(batch.text))]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch.doc_id.to_numpy())
            yield out

    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(run, schema)
