"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, everything but letters becomes one space, and every run
of 2, 3 and 4 bytes of the result is hashed to a row of an embedding table. The
rows are averaged over the whole text and a linear layer with softmax gives one
probability per language. Embeddings and layer are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows.

Rejection is calibrated on a part of the sample that training does not see: a
temperature makes the probabilities honest, and the threshold is the lowest
score above which the accepted texts reach the asked precision.

Since layer and average are both linear, prediction adds up one row per subword
of the table ``embedding x layer``: no text is cut, and memory follows the
longest text, not the batch.

Defined results: a null text or one without a letter gets ``und`` with score 0
and is rejected. Rows without text or language do not train. With one language,
every text with a letter gets it; with none, every text gets ``und``. Rows that
repeat are judged alike. Other columns are never read by the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import utf8

UNKNOWN = "und"
BUCKETS = 1 << 15
DIMENSION = 16
SIZES = (2, 3, 4)
#: Labelled rows used for each language, on average, and the most bytes of one of them; both bound what the driver holds.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 1200
PRECISION = 0.95
MAX_LANGUAGES = 500
_CHUNK = 1 << 18
RESULT = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def letters(text: bytes) -> np.ndarray:
    """Lower-case letters of a text in UTF-8, runs of anything else as one space, a space at both ends; empty without a letter."""
    low = text.decode("utf-8", "replace").lower()
    if not any(c.isalpha() for c in low):
        return np.zeros(0, np.uint8)
    raw = np.frombuffer(b" " + low.encode("utf-8", "replace") + b" ", np.uint8)
    kept = np.where(_LETTER[raw], raw, np.uint8(32))
    fresh = np.ones(len(kept), bool)
    fresh[1:] = (kept[1:] != 32) | (kept[:-1] != 32)
    return kept[fresh]


def subwords(line: np.ndarray) -> np.ndarray:
    """Buckets of all runs of 2, 3 and 4 bytes."""
    if len(line) < 2:
        return np.zeros(0, np.int32)
    wide = line.astype(np.uint32)
    runs, value = [], wide
    for n in range(2, max(SIZES) + 1):
        value = value[:-1] * np.uint32(256) + wide[n - 1:]
        if n in SIZES and len(value):
            mixed = (value + np.uint32(n)) * np.uint32(2654435761)
            runs.append((mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return np.concatenate(runs)


@dataclass(frozen=True)
class Model:
    """Languages, their logits per subword bucket, bias, temperature and the score below which a text is rejected."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, line: np.ndarray) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for at in range(0, max(len(line) - 1, 1), _CHUNK):  # chunks share no run, and miss none
            found = subwords(line[at:at + _CHUNK + max(SIZES) - 1]) if at + _CHUNK >= len(line) else _aligned(line, at)
            total += np.bincount(found, minlength=BUCKETS) @ self.table if len(found) > BUCKETS else self.table[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(n, 1) + self.bias

    def judge(self, text: bytes) -> tuple[str, float, bool]:
        line = letters(text)
        if not len(line) or not self.languages:
            return UNKNOWN, 0.0, False
        p = softmax(self.logits(line)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def _aligned(line: np.ndarray, at: int) -> np.ndarray:
    """Runs that begin in the chunk at ``at``, each once."""
    longest = max(SIZES)
    piece = line[at:at + _CHUNK + longest - 1]
    found, start = subwords(piece), 0
    parts = []
    for n in SIZES:
        parts.append(found[start:start + min(_CHUNK, len(piece) - n + 1)])
        start += len(piece) - n + 1
    return np.concatenate(parts)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, str]], seed: int = 6, steps: int = 2500, rate: float = 1.0, precision: float = PRECISION) -> Model:
    """A model of (language, text) samples; one in five is kept for the calibration."""
    rng = np.random.default_rng(seed)
    languages = tuple(sorted({lang for lang, _ in samples}))
    lines = [(languages.index(lang), subwords(letters(text.encode()))) for lang, text in samples]
    lines = [x for x in lines if len(x[1])]
    held = [x for i, x in enumerate(lines) if i % 5 == 4]
    train = [x for i, x in enumerate(lines) if i % 5 != 4]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    layer = np.zeros((len(languages), DIMENSION), np.float32)
    bias = np.zeros(len(languages), np.float32)
    batch = 16
    epochs = max(4, -(-steps * batch // max(len(train), 1))) if train else 0
    whole, done = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        order = rng.permutation(len(train))
        for at in range(0, len(order), batch):
            picked = [train[i] for i in order[at:at + batch]]
            ids = np.concatenate([p[1] for p in picked])
            sizes = np.array([len(p[1]) for p in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(embedding[ids], starts, axis=0) / sizes[:, None].astype(np.float32)
            error = softmax(mean @ layer.T + bias)
            error[np.arange(len(picked)), [p[0] for p in picked]] -= 1
            step = np.float32(rate * (1 - done / whole))
            back = (error @ layer).astype(np.float32) / sizes[:, None].astype(np.float32)
            layer -= step * (error.T @ mean).astype(np.float32)
            bias -= step * error.sum(axis=0).astype(np.float32) / batch
            np.subtract.at(embedding, ids, step * np.repeat(back, sizes, axis=0))
            done += len(picked)
    model = Model(languages, embedding @ layer.T, bias.astype(np.float64), 1.0, 0.0)
    return calibrated(model, held, precision)


def calibrated(model: Model, held: list[tuple[int, np.ndarray]], precision: float) -> Model:
    """Temperature by likelihood, then the lowest threshold whose accepted texts are right so often."""
    if not held:
        return model
    logits = np.stack([model.table[ids].mean(axis=0) + model.bias for _, ids in held])
    truth = np.array([y for y, _ in held])
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(share >= precision)
    last = enough[-1] if len(enough) else 0
    threshold = 0.0 if last == len(order) - 1 else float(score[order][last])
    return Model(model.languages, model.table, model.bias, temperature, threshold)


def sample(
    docs: DataFrame, learn: Column, text_name: str = "text", lang_name: str = "lang", id_name: str = "doc_id",
    rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
) -> list[tuple[str, str]]:
    """About ``rows`` labelled rows a language, chosen by a hash; of a long text a slice from a hashed place."""
    usable = docs.where(learn & F.col(lang_name).isNotNull() & (F.length(text_name) > 0))
    counts = dict(usable.groupBy(lang_name).count().limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))))
    dice = F.pmod(F.xxhash64(F.lit("langid"), id_name, F.length(text_name)), F.lit(1 << 20)) / (1 << 20)
    place = F.pmod(F.xxhash64(F.lit("slice"), id_name), F.greatest(F.length(text_name) - most_bytes // 2, F.lit(1))) + 1
    # slices of all lengths, so that short texts are known as well
    size = (F.lit(most_bytes // 2) / F.pow(F.lit(2.0), F.pmod(F.xxhash64(F.lit("size"), id_name), F.lit(6)))).cast("int")
    drawn = usable.where(dice < share[F.col(lang_name)]).select(
        F.col(lang_name).alias("lang"), F.substring(F.col(text_name), place.cast("int"), size).alias("slice"), F.xxhash64(id_name, text_name).alias("k"))
    return [(r["lang"], r["slice"]) for r in sorted(drawn.collect(), key=lambda r: (r["k"], r["lang"], r["slice"]))]


def predictor(docs: DataFrame, model: Model):
    """A function from a text column to a column of (lang, score, accepted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.judge(t) for t in utf8(texts)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.StructArray.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())],
            names=["lang", "score", "accepted"])

    return predict


def held_out(id_name: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", lang_name: str = "lang") -> DataFrame:
    """``docs`` as struct column _doc, and _found with lang, score and accepted; trained on the rows not held out."""
    model = fit(sample(docs, ~held_out(id_name), text_name, lang_name, id_name))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.col(text_name).alias("_text"))
    return packed.withColumn("_found", predictor(docs, model)(F.col("_text"))).drop("_text")
