"""Alignment of two tokenizers over every document, with corpus-wide counts of linked ids.

Both tokenizers encode the same bytes, a space and the text. Byte offsets at
which a token of either side ends cut the text into groups, and tokens whose
bytes overlap are linked.

After full tokenisation the shared ends before a space-marked token split a
document into windows of a word or so. A window is known by its two tuples of
token ids, and its groups and links follow from them, so each distinct window is
aligned once and remembered; all windows of a block are told apart side by side
by a hash, which is checked against the ids themselves. Tables of remembered
windows are emptied when they hold ``MEMO`` of them.

A document leaves the tokenising task with its distinct linked pairs. Their
counts over all documents are an aggregate with map-side combine. To bring
counts back, the ``HEAD`` most frequent pairs are broadcast, a fixed number of
rows whatever the corpus; only the rest, which by Zipf's law is little, meets
its counts in a shuffle. No hot pair is left in that shuffle.

The first tokenizer is a byte-level BPE file whose ids are the ranks of its
merges, which tiktoken's engine encodes; a text that engine refuses (millions of
spaces in a row) and a file of another kind go to the tokenizers library. The
second is a SentencePiece model. Special tokens' strings are plain text.

Defined results: null and empty texts, and texts whose joined tokens of either
side are not the bytes of a space and the text, have no tokens: zeros and an
empty digest. They count in no pair. Rows are documents, so equal rows each
count; other columns are kept in ``_doc``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import settled, slices, staged

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 1 << 19
MEMO = 1 << 17
BLOCK = 1 << 18
MARK = "▁"
# Fixed value: how a byte-level BPE file without a pattern of its own cuts texts before merging.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_APART = np.array([-1], np.int32).tobytes()  # no id


def _byte_characters() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary: printable Latin-1 as itself, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """The first tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, path: str = BYTE_BPE):
        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        characters, vocabulary = _byte_characters(), file["model"]["vocab"]
        special = {t["id"]: t["content"] for t in file["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for word, i in vocabulary.items():
            self.bytes_of[i] = special[i].encode() if i in special else bytes(characters[c] for c in word)
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in file["model"]["merges"]]
        plain = {b: i for i, b in enumerate(self.bytes_of) if b and i not in special}
        # merge number i makes id 256 + i: ids are ranks, the settings are the usual ones
        ranked = all(vocabulary.get(m) == 256 + i for i, m in enumerate(merges)) and len(plain) == 256 + len(merges)
        before, model = file["pre_tokenizer"] or {}, file["model"]
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not file["normalizer"]
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=WORDS, mergeable_ranks=plain, special_tokens={}) if (
            ranked and usual and not model.get("ignore_merges") and not model.get("dropout")) else None

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            ids = None
            if self.fast:
                try:
                    ids = self.fast.encode_ordinary(text)
                except BaseException as refused:  # the engine's panics are no Exceptions
                    if type(refused).__name__ != "PanicException":
                        raise
            out.append(self._plainly(text) if ids is None else ids)
        return out

    def _plainly(self, text: str) -> list[int]:
        if self.slow is None:
            self.slow = tokenizers.Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode_batch_fast([text], add_special_tokens=False)[0].ids


class PieceBpe:
    """The second tokenizer; it puts the space in front by itself."""

    def __init__(self, path: str = PIECE_BPE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """Lengths and first bytes of one tokenizer's tokens."""

    def __init__(self, tokenizer: Callable[[list[str]], list[list[int]]]):
        self.encode, self.bytes_of = tokenizer, tokenizer.bytes_of
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes_of])
        texts = [str(i) for i in range(len(self.bytes_of))]
        self.plain, self.commas, self.bars, self.semicolons = (np.array([t + x for t in texts], object) for x in ("", ",", "|", ";"))

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join([self.bytes_of[i] for i in ids]) == data


def _cut(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids of some runs in a row."""
    return ids[np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)]


class Memo:
    """Windows already aligned: by their ids on both sides, a place in the lists."""

    def __init__(self, sides: tuple[Side, Side]):
        self.sides = sides
        self.place: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.groups, self.links, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, keys: list[bytes], ids: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """Aligns the windows whose ids stand in a row, ``counts`` of them for each, all side by side."""
        ends = [np.cumsum(side.length[x]) for side, x in zip(self.sides, ids)]
        last = ends[0][np.cumsum(counts[0]) - 1]  # both sides of a window spell the same bytes
        # between two ends of either side lies one token of each: a link
        cuts = np.union1d(*ends)
        links = ids[0][np.searchsorted(ends[0], cuts)] << 32 | ids[1][np.searchsorted(ends[1], cuts)]
        shared = np.intersect1d(*ends, assume_unique=True)
        per_window = lambda at: np.bincount(np.searchsorted(last, at), minlength=len(keys))
        group = [np.searchsorted(shared, e) for e in ends]
        # a comma inside a group's side, then a bar, and a semicolon between groups
        inner = [np.append(g[1:] == g[:-1], False) for g in group]
        final = np.zeros(len(ids[1]), bool)
        final[np.cumsum(counts[1]) - 1] = True
        words = np.concatenate([
            np.where(inner[0], self.sides[0].commas[ids[0]], self.sides[0].bars[ids[0]]),
            np.where(inner[1], self.sides[1].commas[ids[1]], np.where(final, self.sides[1].plain[ids[1]], self.sides[1].semicolons[ids[1]]))])
        words = words[np.argsort(np.concatenate([group[0] * 2, group[1] * 2 + 1]), kind="stable")].tolist()
        stops = np.cumsum(counts[0] + counts[1]).tolist()
        self.place.update(zip(keys, range(len(self.texts), len(self.texts) + len(keys))))
        self.texts += ["".join(words[a:b]) for a, b in zip([0, *stops], stops)]
        self.groups = np.concatenate([self.groups, per_window(shared)])
        self.links = np.concatenate([self.links, links])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(per_window(cuts))])


def _hashes(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash for each run of ids; runs begin at ``starts`` and none is empty."""
    within = (np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))).astype(np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MIX + within * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)


def _same(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Whether each run holds the same ids as run number ``like`` of it."""
    counts = stops - starts
    same = counts == counts[like]
    checked = np.where(same, counts, 0)
    run = np.repeat(np.arange(len(starts)), checked)
    within = np.arange(len(run)) - np.repeat(np.cumsum(checked) - checked, checked)
    differs = ids[starts[run] + within] != ids[starts[like[run]] + within]
    same[run[differs]] = False
    return same


class Aligner:
    """Both tokenizers and the remembered windows of a task."""

    def __init__(self, paths: tuple[str, str]):
        self.sides = Side(ByteBpe(paths[0])), Side(PieceBpe(paths[1]))
        self.memo = Memo(self.sides)

    def windows(self, tokens: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(places in the memo of all windows in a row, number of windows per document); no document is without tokens."""
        ids = [np.concatenate([np.array(t[s], np.int64) for t in tokens]) for s in (0, 1)]
        ends = [np.cumsum(side.length[x]) for side, x in zip(self.sides, ids)]
        # documents stand in a row, each with a space in front, so a document's last end is an anchor as well
        last = ends[0][np.cumsum([len(t[0]) for t in tokens]) - 1]
        shared, at_a, at_b = np.intersect1d(ends[0], ends[1], assume_unique=True, return_indices=True)
        follows = [np.append(side.spaced[x[1:]], True) for side, x in zip(self.sides, ids)]
        anchor = follows[0][at_a] & follows[1][at_b]
        stops = at_a[anchor] + 1, at_b[anchor] + 1
        starts = tuple(np.concatenate([[0], x[:-1]]) for x in stops)
        key = _hashes(ids[0], starts[0]) * _MIX ^ _hashes(ids[1], starts[1])
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        same = _same(ids[0], starts[0], stops[0], first[which]) & _same(ids[1], starts[1], stops[1], first[which])
        if len(self.memo.texts) > MEMO:
            self.memo = Memo(self.sides)
        known, first = self.memo.place, np.concatenate([first, np.flatnonzero(~same)])  # those whose hash is another window's as well
        raw = [x.astype(np.int32).tobytes() for x in ids]
        edges = [(4 * x[first]).tolist() for side in zip(starts, stops) for x in side]
        keys = [raw[0][a:b] + _APART + raw[1][c:d] for a, b, c, d in zip(*edges)]
        fresh = {key: w for key, w in zip(keys, first.tolist()) if key not in known}
        if fresh:
            new = np.fromiter(fresh.values(), np.int64, len(fresh))
            sizes = [stops[s][new] - starts[s][new] for s in (0, 1)]
            self.memo.add(list(fresh), [_cut(ids[s], starts[s][new], sizes[s]) for s in (0, 1)], sizes)
        found = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        places = found[which]
        places[~same] = found[len(found) - int((~same).sum()):]
        counts = np.diff(np.searchsorted(shared[anchor], last, "right"), prepend=0)
        return places, counts

    def run(self, texts: list[str]) -> dict[str, list]:
        """By column, the values of each text."""
        out = {"n_a": [0] * len(texts), "n_b": [0] * len(texts), "n_groups": [0] * len(texts), "n_links": [0] * len(texts),
               "groups": [None] * len(texts), "pairs": [[]] * len(texts), "times": [[]] * len(texts)}
        asked = [i for i, t in enumerate(texts) if t]
        encoded = zip(asked, self.sides[0].encode([" " + texts[i] for i in asked]), self.sides[1].encode([texts[i] for i in asked]) if asked else [])
        kept, tokens = [], []
        for i, a, b in encoded:
            data = b" " + texts[i].encode()
            if self.sides[0].spells(a, data) and self.sides[1].spells(b, data):
                kept.append(i)
                tokens.append((a, b))
        if not kept:
            return out
        places, counts = self.windows(tokens)
        memo = self.memo
        used, which = np.unique(places, return_inverse=True)
        sizes = memo.ends[used + 1] - memo.ends[used]
        pairs, code = np.unique(_cut(memo.links, memo.ends[used], sizes), return_inverse=True)
        begin = np.cumsum(sizes) - sizes
        # the links of all windows of all documents in a row, as places in ``pairs``
        many = sizes[which]
        at = np.repeat(begin[which] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        document = np.repeat(np.repeat(np.arange(len(kept)), counts), many)
        found, times = np.unique(document * len(pairs) + code[at], return_counts=True)
        edges = np.searchsorted(found, np.arange(len(kept) + 1) * len(pairs))
        stops = np.cumsum(counts)
        groups = memo.groups[places]
        for n, (i, (a, b)) in enumerate(zip(kept, tokens)):
            own, mine = places[stops[n] - counts[n]:stops[n]], slice(edges[n], edges[n + 1])
            text = ";".join([memo.texts[p] for p in own.tolist()])
            out["n_a"][i], out["n_b"][i], out["n_groups"][i] = len(a), len(b), int(groups[stops[n] - counts[n]:stops[n]].sum())
            out["n_links"][i] = int(times[mine].sum())
            out["groups"][i] = text
            out["pairs"][i], out["times"][i] = pairs[found[mine] % len(pairs)], times[mine]
        return out


def _lists(values: list) -> pa.ListArray:
    ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.asarray(v, np.int64) for v in values] or [np.zeros(0, np.int64)])))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _tokenised(paths: tuple[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(_doc, row, text) to (_doc, row, _COUNTS, groups_sha256, pairs, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(paths)
        for whole in batches:
            for batch in slices(whole, 2, BLOCK):
                out = aligner.run(batch.column("text").to_pylist())
                digests = ["" if g is None else hashlib.sha256(g.encode()).hexdigest() for g in out["groups"]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_doc"), batch.column("row"), *(pa.array(out[c], pa.int64()) for c in _COUNTS),
                     pa.array(digests, pa.string()), _lists(out["pairs"]), _lists(out["times"])],
                    names=["_doc", "row", *_COUNTS, "groups_sha256", "pairs", "times"])

    return run


def align_documents(docs: DataFrame, text_name: str = "text", paths: tuple[str, str] = (BYTE_BPE, PIECE_BPE)) -> DataFrame:
    """(_doc: the columns but the text, row, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), written as a table.

    ``pairs`` are the distinct linked ids of a document, a * 2^32 + b, ``times`` how often each is linked.
    """
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_name)).alias("_doc")
    rows = docs.select(others, F.monotonically_increasing_id().alias("row"), F.col(f"`{text_name}`").alias("text"))
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType([
        rows.schema["_doc"], T.StructField("row", long), *(T.StructField(c, long) for c in _COUNTS),
        T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", longs), T.StructField("times", longs)])
    return staged(rows.mapInArrow(_tokenised(paths), schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each pair is linked, and whether that is the most for its first id."""
    counts = settled(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return settled(counts.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def with_counts(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum."""
    top = F.broadcast(counts.orderBy(F.desc("n"), "pair").limit(head))
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    usual = links.join(top, "pair").groupBy("row").agg(*sums)
    rare = links.join(top, "pair", "left_anti").join(counts, "pair").groupBy("row").agg(*sums)
    both = settled(usual.union(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "sums")
    return aligned.drop("pairs", "times").join(both, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])


def cross_tokenizer(
    docs: DataFrame, text_name: str = "text", paths: tuple[str, str] = (BYTE_BPE, PIECE_BPE), head: int = HEAD,
) -> tuple[DataFrame, DataFrame]:
    """(per row of ``docs``: _doc, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum; (pair, n, best) of all linked ids)."""
    aligned = align_documents(docs, text_name, paths)
    counts = pair_counts(aligned)
    return with_counts(aligned, counts, head), counts
