"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary comes from a SentencePiece model file, whose path is a
parameter. Its pieces carry log scores. Where the file holds ranks instead (a
BPE model), the scores are Zipf's: piece number r has log score
``-log(r + 2.7)`` up to a constant, so that frequent pieces are likely ones.
Nothing is trained.

Encoding: spaces become the marker ``▁`` and one is put in front (as the file's
settings say); of all cuts into pieces the one with the largest sum of scores is
taken; a character that no piece covers is spelled in byte pieces, or ``<unk>``
without them. Equal sums: at every end the longest last piece wins. Decoding
joins pieces, bytes included, turns markers into spaces and drops the one in
front.

Pieces of the used kind never have a marker after another character, so a text
can be cut before every marker run and each distinct unit of a batch is solved
once, all units side by side in numpy: the trie walks all positions together,
the Viterbi step runs over the offsets within a unit. A vocabulary with other
pieces is solved on whole texts.

Defined results: a null or empty text has no pieces and decodes to the empty
text. NUL and any other character go through byte pieces. A text that contains
the marker itself decodes to spaces there. Rows are independent of each other;
extra columns stay as they are.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import blocks, joined, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_UNITS = 200_000
BATCH_BYTES = 1 << 18
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class DoubleArray:
    """A trie of byte strings in two arrays: child of node n by byte c is base[n] + c if check there is n."""

    def __init__(self, words: dict[bytes, int]):
        tree: list[dict[int, int]] = [{}]
        ends = {}
        for word, value in words.items():
            node = 0
            for c in word:
                if c not in tree[node]:
                    tree[node][c] = len(tree)
                    tree.append({})
                node = tree[node][c]
            ends[node] = value
        room = 1 << 18
        base, check, value = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
        used = np.zeros(room, bool)
        used[0], place, todo = True, {0: 0}, [0]
        value[0] = ends.get(0, -1)
        hint: dict[int, int] = {}  # by number of children: where the search goes on
        for node in todo:
            children = tree[node]
            if not children:
                continue
            codes = np.fromiter(children, np.int64)
            b, window = hint.get(len(codes), 1), 32
            while True:
                if b + window + 512 > len(used):
                    grow = len(used)
                    base, used = np.concatenate([base, np.zeros(grow, np.int32)]), np.concatenate([used, np.zeros(grow, bool)])
                    check, value = (np.concatenate([x, np.full(grow, -1, np.int32)]) for x in (check, value))
                free = ~used[np.arange(b, b + window)[:, None] + codes].any(axis=1)
                if free.any():
                    b += int(free.argmax())
                    break
                b, window = b + window, min(window * 2, 4096)
            hint[len(codes)] = b + 1 if len(codes) > 1 else b
            at = place[node]
            base[at] = b
            for c, child in children.items():
                used[b + c], check[b + c], value[b + c] = True, at, ends.get(child, -1)
                place[child] = b + c
                todo.append(child)
        last = int(np.flatnonzero(used).max()) + 513
        self.base, self.check, self.value = base[:last], check[:last], value[:last]

    def matches(self, data: np.ndarray, limit: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, value) of all words at ``starts`` that end by the start's ``limit``."""
        out, at, node, k = [], starts, np.zeros(len(starts), np.int32), 0
        while len(at):
            inside = at + k < limit
            at, node, limit = at[inside], node[inside], limit[inside]
            step = self.base[node] + data[at + k]
            good = self.check[step] == node
            at, node, limit, k = at[good], step[good], limit[good], k + 1
            found = self.value[node]
            hit = found >= 0
            out.append((at[hit], at[hit] + k, found[hit]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def zipf_scores(count: int) -> np.ndarray:
    raw = -np.log(np.arange(count) + 2.7)
    return raw - math.log(np.exp(raw).sum())


class Solved:
    """Units already cut: their place, and their ids in a row."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, units: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def take(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units at these places, in a row, and their number per unit."""
        start = self.ends[row]
        counts = self.ends[row + 1] - start
        shift = start - (np.cumsum(counts) - counts)
        return self.ids[np.arange(int(counts.sum())) + np.repeat(shift, counts)], counts


@dataclass
class Vocabulary:
    """Pieces with scores and kinds; what encoding and decoding need of a model file."""

    pieces: list[str]
    scores: np.ndarray
    normal: np.ndarray
    byte_id: np.ndarray
    unknown: int
    prefix: bool = True

    def __post_init__(self):
        self.trie = DoubleArray({p.encode(): i for i, p in enumerate(self.pieces) if self.normal[i]})
        self.low = float(self.scores[self.normal].min()) - UNKNOWN_PENALTY
        self.cut = not any(re.search(f"[^{MARK}]{MARK}", p) for i, p in enumerate(self.pieces) if self.normal[i])
        self.bytes_of = [b"" for _ in self.pieces]
        for i, p in enumerate(self.pieces):
            if self.normal[i]:
                self.bytes_of[i] = p.encode()
        for b, i in enumerate(self.byte_id):
            if i >= 0:
                self.bytes_of[i] = bytes([b])
        self.bytes_of[self.unknown] = " ⁇ ".encode()

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        byte_id = np.full(256, -1, np.int64)
        for i in range(n):
            if model.is_byte(i):
                byte_id[int(model.id_to_piece(i)[3:5], 16)] = i
        normal = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(n)])
        scores = np.array([model.get_score(i) for i in range(n)])
        ranks = scores[normal & (scores > -1e8)]
        if len(ranks) and np.array_equal(ranks, np.round(ranks)):  # ranks of merges, not log probabilities
            scores = np.zeros(n)
            scores[normal] = zipf_scores(int(normal.sum()))
        return cls([model.id_to_piece(i) for i in range(n)], scores, normal, byte_id, model.unk_id())

    def marked(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def units(self, text: str) -> list[str]:
        line = self.marked(text)
        return _UNIT.findall(line) if self.cut else [line] * bool(line)

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The best cut of each unit: all ids in a row, and their number per unit."""
        data, offsets = joined([u.encode() for u in units])
        size = len(data)
        if not size:
            return np.zeros(0, np.int32), np.zeros(len(units), np.int64)
        first = (data & 0xC0) != 0x80
        starts = np.flatnonzero(first)
        unit = np.searchsorted(offsets, starts, "right") - 1
        a, b, piece = self.trie.matches(data.astype(np.int32), offsets[unit + 1], starts)
        after = np.append(starts[1:], size)
        alone = np.ones(size, bool)
        alone[a[b == after[np.searchsorted(starts, a)]]] = False
        lone = starts[alone[starts]]
        a = np.concatenate([a, lone])
        b = np.concatenate([b, after[np.searchsorted(starts, lone)]])
        piece = np.concatenate([piece, np.full(len(lone), -1)]).astype(np.int64)
        gain = np.where(piece >= 0, self.scores[piece], self.low)
        # Edges in order of how far into its unit each ends, then by end, then by start: of equal sums the longest wins.
        depth = b - offsets[np.searchsorted(offsets, a, "right") - 1]
        order = np.lexsort((a, b, depth))
        a, b, piece, gain, depth = a[order], b[order], piece[order], gain[order], depth[order]
        back, how = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        ends_at = np.full(size + 1, -np.inf)
        begin = np.zeros(size + 1, bool)
        begin[offsets[:-1]] = True
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(depth)) + 1, [len(a)]])
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            from_, to = a[lo:hi], b[lo:hi]
            value = np.where(begin[from_], 0.0, ends_at[from_]) + gain[lo:hi]
            head = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, head)
            equal = value == np.repeat(top, np.diff(np.append(head, hi - lo)))
            index = np.where(equal, np.arange(hi - lo), hi)
            pick = np.minimum.reduceat(index, head)
            at = to[head]
            ends_at[at], back[at], how[at] = top, from_[pick], piece[lo:hi][pick]
        return self._follow(data, offsets, back, how)

    def _follow(self, data: np.ndarray, offsets: np.ndarray, back: np.ndarray, how: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths of all units from their ends to their beginnings, step by step together."""
        at, unit = offsets[1:].copy(), np.arange(len(offsets) - 1)
        steps = []
        alive = at > offsets[:-1]
        at, unit = at[alive], unit[alive]
        while len(at):
            steps.append((unit, at, back[at], how[at]))
            at = back[at]
            on = at > offsets[unit]
            at, unit = at[on], unit[on]
        unit, end, begin, piece = (np.concatenate(x) for x in zip(*steps))
        order = np.argsort(end, kind="stable")
        unit, end, begin, piece = unit[order], end[order], begin[order], piece[order]
        if (piece < 0).any():
            unit, piece = self._spell(data, unit, begin, end, piece)
        return piece.astype(np.int32), np.bincount(unit, minlength=len(offsets) - 1)

    def _spell(self, data, unit, begin, end, piece) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in the place of uncovered characters."""
        fallback = bool((self.byte_id >= 0).all())
        times = np.where((piece < 0) & fallback, end - begin, 1)
        row = np.repeat(np.arange(len(piece)), times)
        within = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        out = piece[row]
        missing = out < 0
        out[missing] = self.byte_id[data[begin[row[missing]] + within[missing]]] if fallback else self.unknown
        return unit[row], out

    def encode(
        self, texts: list[str], solved: Solved | None = None, cache: int = CACHE_UNITS, at_once: int = BATCH_BYTES,
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and their number per text. ``solved`` keeps up to ``cache`` units; ``at_once`` characters are solved together."""
        solved = Solved() if solved is None else solved
        cut = [self.units(t) for t in texts]
        distinct = set(itertools.chain.from_iterable(cut))
        if len(solved.place) + len(distinct) > cache:
            solved.clear()
        fresh, part, size = [u for u in distinct if u not in solved.place], [], 0
        for u in fresh:
            part.append(u)
            size += len(u)
            if size >= at_once:
                solved.add(part, *self.solve(part))
                part, size = [], 0
        if part:
            solved.add(part, *self.solve(part))
        many = np.fromiter(map(len, cut), np.int64, len(cut))
        row = np.fromiter(map(solved.place.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(many.sum()))
        ids, counts = solved.take(row)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(many)]
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray) -> str:
        """Pieces and bytes joined, markers as spaces; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join([self.bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def _together(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def encoder(df: DataFrame, path: str = MODEL_PATH):
    """A function from a text column to its array of piece ids. The vocabulary (its size is the file's) is sent once."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    solved: list[Solved] = []

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        solved[:] = solved or [Solved()]
        return _together([_lists(*shared.value.encode(part, solved[0])) for part in blocks(texts)], pa.list_(pa.int32()))

    return encode


def encoded(df: DataFrame, text_name: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """``df`` without the text, with ``ids``. Half a megabyte of text is encoded and handed over at a time, so a task never holds a batch of ids."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    others = [c for c in df.columns if c != text_name]
    rows = df.select(F.col(f"`{text_name}`").alias("text"), F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved = Solved()
        for whole in batches:
            for batch in slices(whole, 0, 1 << 19):
                texts = ["" if t is None else t for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(1), _lists(*shared.value.encode(texts, solved, 1 << 16, 1 << 16))], names=["row", "ids"])
            pa.default_memory_pool().release_unused()

    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).select("row.*", "ids")


def decoder(df: DataFrame, path: str = MODEL_PATH):
    """A function from a column of piece ids to the text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array([shared.value.decode(np.asarray(x or [], np.int64)) for x in ids.to_pylist()], pa.string())

    return decode


def round_trip(df: DataFrame, path: str = MODEL_PATH):
    """A function from a text column to (ids, text): the pieces and what they decode to."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    solved: list[Solved] = []
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType())])

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        solved[:] = solved or [Solved()]
        parts = []
        for part in blocks(texts):
            ids, counts = shared.value.encode(part, solved[0])
            ends = np.cumsum(counts)
            decoded = pa.array([shared.value.decode(ids[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())], pa.string())
            parts.append(pa.StructArray.from_arrays([_lists(ids, counts), decoded], names=["ids", "text"]))
        return _together(parts, pa.struct([("ids", pa.list_(pa.int32())), ("text", pa.string())]))

    return run
