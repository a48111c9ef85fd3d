"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

An anchor's positives are its best rows of the same label, by inner product. A
positive's hard negatives are the best rows of other labels whose score lies in
a window below the positive's own, so that they are near but no false negatives.

A node of the tree has several split points; a row belongs to the nearest one.
Each split point stores, for every sibling subtree, the range of distances from
itself to the subtree's rows, and each subtree the range of its squared norms. A
window of scores is an annulus of distances around the anchor, since
``|a - x|^2 = |a|^2 + |x|^2 - 2 a.x``. A subtree is eliminated if for some split
point the annulus, moved by that point's distance from the anchor, misses the
range. What is left is followed down, nearest first; leaves are scored exactly,
and the k-th best score found so far raises the window's lower end.

The root is global: its split points are chosen from a bounded sample
(``SAMPLE``), its ranges come from an aggregate over all rows, and every row is
in one of its cells. A large cell is dealt into blocks of ``BLOCK_ROWS``, each with a
tree of its own, so a label or a point that holds a third of all rows is many
blocks. Anchors visit the blocks of cells that are not eliminated, some
``BLOCK_QUERIES`` at a time, so a task holds one block and one set of anchors.
Positives are looked for in the anchor's own cell first, which bounds the
distances for the others.

All scores are exact: components are scaled and floored to integers, and sums
stay below 2^53. The tree only saves work; no row is left out of the search.

Defined results: rows with a null id or label, a null vector, or a null or
non-finite component take no part, nor do rows whose scaled squared norm exceeds
2^53. Shorter vectors are filled up with zeros. Rows with the anchor's own id are
never among its answers. Rows that agree in id and score count once; anchors that
share an id and differ are several anchors. Fewer rows than wanted give all.
Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.support import staged

SPLITS = 64
SAMPLE = 4096
BLOCK_ROWS = 1 << 14
BLOCK_QUERIES = 1 << 10
DEGREE = 16
LEAF = 128
EXACT = float(1 << 53)
NEAR = 1e-6  # roots are rounded; a distance this far outside is still inside
WINDOWS = "array<struct<name: long, low: double, high: double>>"
Batches = Iterator[pa.RecordBatch]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, filled up with zeros."""
    counts = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(counts), width))
    out[np.arange(width) < counts[:, None]] = vectors.flatten().to_numpy()
    return out


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """Places of up to ``count`` different points: the first, then always the one farthest from those chosen."""
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def squared(rows: np.ndarray, norms: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all points."""
    return norms[:, None] + (points ** 2).sum(axis=1) - 2 * (rows @ points.T)


class Ranges:
    """What a node knows of its subtrees: distances from every split point, and squared norms."""

    def __init__(self, points: np.ndarray, near: np.ndarray, far: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.points, self.near, self.far, self.least, self.most = points, near, far, least, most
        self.norms = (points ** 2).sum(axis=1)

    def closest(self, anchor: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distance of each split point; by subtree, the smallest and the largest distance that a row of it can have)."""
        d = np.sqrt(np.maximum(norm + self.norms - 2 * (self.points @ anchor), 0.0))[:, None]
        return d[:, 0], np.maximum(d - self.far, self.near - d).max(axis=0), (d + self.far).min(axis=0)

    def alive(self, bounds: tuple, norm: float, low: float, high: float) -> np.ndarray:
        """Which subtrees may hold a row with a score from ``low`` to ``high``."""
        _, nearest, farthest = bounds
        outer = norm + self.most - 2 * low
        inner = np.sqrt(np.maximum(norm + self.least - 2 * high, 0.0))
        return (outer >= 0) & (nearest <= np.sqrt(np.maximum(outer, 0.0)) + NEAR) & (farthest >= inner - NEAR)


class Tree:
    """The rows of one block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.rows, self.ids, self.labels = rows, ids, labels
        self.norms = (rows ** 2).sum(axis=1)
        self.leaves_read = 0
        self.nodes: list[tuple[Ranges, list[int]] | np.ndarray] = []
        todo: list[tuple[np.ndarray, list[int], int]] = [(np.arange(len(ids)), [], 0)]
        while todo:
            own, parent, slot = todo.pop()
            if parent:
                parent[slot] = len(self.nodes)
            ranges, parts = self._split(own) if len(own) > LEAF else (None, [])
            if ranges is None:
                self.nodes.append(own)
                continue
            children = [-1] * len(parts)
            self.nodes.append((ranges, children))
            todo += [(part, children, i) for i, part in enumerate(parts)]

    def _split(self, own: np.ndarray) -> tuple[Ranges | None, list[np.ndarray]]:
        rows = self.rows[own]
        distance = squared(rows, self.norms[own], rows[:1])[:, 0]
        if not distance.max() > 0:
            return None, []  # all the same
        sample = np.concatenate([[0, distance.argmax()], np.linspace(0, len(own) - 1, 4 * DEGREE).astype(np.int64)])
        points = rows[sample[spread(rows[sample], DEGREE)]]
        far = squared(rows, self.norms[own], points)
        part = far.argmin(axis=1)
        far = np.sqrt(np.maximum(far, 0.0))
        parts = [np.flatnonzero(part == j) for j in range(len(points))]
        parts = [p for p in parts if len(p)]
        ranges = Ranges(
            points, np.stack([far[p].min(axis=0) for p in parts], 1), np.stack([far[p].max(axis=0) for p in parts], 1),
            np.array([self.norms[own[p]].min() for p in parts]), np.array([self.norms[own[p]].max() for p in parts]))
        return ranges, [own[p] for p in parts]

    def search(self, anchor: np.ndarray, own_id: int, label: int, same: bool, low: float, high: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows of the same label, or of others, with scores from ``low`` to ``high``."""
        norm = float(anchor @ anchor)
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        todo = [(0, -np.inf, 0.0)]
        while todo:
            at, nearest, most = todo.pop()
            if nearest > NEAR and (nearest - NEAR) ** 2 > norm + most - 2 * low:
                continue  # the lower end has risen since
            node = self.nodes[at]
            if isinstance(node, np.ndarray):
                self.leaves_read += 1
                found = self.rows[node] @ anchor
                good = ((self.labels[node] == label) == same) & (found >= low) & (found <= high) & (self.ids[node] != own_id)
                if good.any():
                    ids, scores = best(np.concatenate([ids, self.ids[node][good]]), np.concatenate([scores, found[good]]), k)
                    if len(ids) == k:
                        low = max(low, scores[-1])
                continue
            ranges, children = node
            bounds = ranges.closest(anchor, norm)
            alive = np.flatnonzero(ranges.alive(bounds, norm, low, high))
            for j in alive[np.argsort(-bounds[1][alive], kind="stable")].tolist():
                todo.append((children[j], bounds[1][j], ranges.most[j]))
        return ids, scores


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first by score, then by id; what agrees in both counts once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    return ids[new][:k], scores[new][:k]


def usable(rows: DataFrame, queries: Column, label: Column, id_name: str, vector_name: str, scale: int) -> DataFrame:
    """(id, label, v, asks) of the rows that take part; v holds the scaled components as integers."""
    v = F.col(f"`{vector_name}`")
    named = rows.select(F.col(f"`{id_name}`").cast("long").alias("id"), label.cast("long").alias("label"), v.alias("x"), F.coalesce(queries, F.lit(False)).alias("asks"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    named = named.where("id is not null and label is not null and x is not null").where(~F.exists("x", odd))
    scaled = named.withColumn("y", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("double")))
    norm = F.aggregate("y", F.lit(0.0), lambda s, c: s + c * c)
    return scaled.where(norm <= EXACT).select("id", "label", F.transform("y", lambda c: c.cast("int")).alias("v"), "asks")


class Forest:
    """The global root over the usable rows of a table, and its blocks."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        self.width = rows.agg(F.max(F.size("v"))).first()[0] or 1
        width = self.width
        sample = rows.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
        points = matrix(sample, width) if len(sample) else np.zeros((1, width))
        points = points[spread(points, SPLITS)]
        self.points = points
        shared = spark.sparkContext.broadcast(points)

        def nearest(batches: Batches) -> Batches:
            for batch in batches:
                x = matrix(batch.column("v"), width)
                cell = squared(x, (x ** 2).sum(axis=1), shared.value).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

        self.rows = staged(rows.mapInArrow(nearest, "id long, label long, v array<int>, asks boolean, cell int"), "cells")

        def reach(batches: Batches) -> Batches:
            m = len(shared.value)
            near, far = np.full((m, m), np.inf), np.full((m, m), -np.inf)
            least, most, count = np.full(m, np.inf), np.full(m, -np.inf), np.zeros(m, np.int64)
            for batch in batches:
                x = matrix(batch.column("v"), width)
                norms = (x ** 2).sum(axis=1)
                d = squared(x, norms, shared.value)
                cells = batch.column("cell").to_numpy()
                for j in np.unique(cells):
                    own = cells == j
                    near[:, j], far[:, j] = np.minimum(near[:, j], d[own].min(axis=0)), np.maximum(far[:, j], d[own].max(axis=0))
                    least[j], most[j] = min(least[j], norms[own].min()), max(most[j], norms[own].max())
                    count[j] += own.sum()
            i, j = np.nonzero(np.isfinite(near))
            columns = [i, j, near[i, j], far[i, j], least[j], most[j], count[j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "near", "far", "least", "most", "n"])

        seen = self.rows.mapInArrow(reach, "i long, j long, near double, far double, least double, most double, n long")
        m = len(points)
        near, far = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        least, most, parts = np.zeros(m), np.zeros(m), np.zeros(m, np.int64)
        for i, j, a, b, c, d, n in seen.groupBy("i", "j").agg(
                F.min("near"), F.max("far"), F.min("least"), F.max("most"), F.sum("n")).collect():  # SPLITS squared rows at most
            near[i, j], far[i, j], least[j], most[j] = max(a, 0.0) ** .5, max(b, 0.0) ** .5, c, d
            parts[j] = -(-n // BLOCK_ROWS)
        self.ranges = Ranges(points, near, far, least, most)
        self.parts = parts
        spans = spark.createDataFrame([(j, int(n)) for j, n in enumerate(parts) if n], "cell int, parts int")
        part = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int").alias("part")
        self.blocks = self.rows.join(F.broadcast(spans), "cell").select("id", "label", "v", "cell", part)
        self.spans = spans

    def visits(self, asking: DataFrame, skip_own: bool | None) -> DataFrame:
        """``asking`` (q, id, label, v, cell, windows: array of name, low, high) once per cell that is not eliminated.

        ``skip_own``: False gives the anchor's own cell only, True all others, None all.
        """
        shared = asking.sparkSession.sparkContext.broadcast((self.ranges, self.parts > 0))
        width = self.width

        def route(batches: Batches) -> Batches:
            ranges, full = shared.value
            for batch in batches:
                x = matrix(batch.column("v"), width)
                own = batch.column("cell").to_numpy()
                row, cell = [], []
                for i, windows in enumerate(batch.column("windows").to_pylist()):
                    if skip_own is False:
                        alive = np.arange(len(full)) == own[i]
                    else:
                        norm = float(x[i] @ x[i])
                        bounds = ranges.closest(x[i], norm)
                        alive = np.zeros(len(full), bool)
                        for w in windows:
                            alive |= ranges.alive(bounds, norm, w["low"], w["high"])
                        alive &= full
                        if skip_own:
                            alive[own[i]] = False
                    found = np.flatnonzero(alive)
                    row.append(np.full(len(found), i))
                    cell.append(found)
                row, cell = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (row, cell))
                kept = batch.select(["q", "id", "label", "v", "windows"]).take(pa.array(row.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(cell.astype(np.int32))], names=[*kept.schema.names, "cell"])

        return asking.select("q", "id", "label", "v", "cell", "windows").mapInArrow(route, f"q long, id long, label long, v array<int>, windows {WINDOWS}, cell int")

    def search(self, asking: DataFrame, same: bool, k: int, skip_own: bool | None = None) -> DataFrame:
        """(q, name, other_id, score): the k best of every visited block, by anchor and window."""
        chunks = -(-asking.count() // BLOCK_QUERIES) or 1
        visits = self.visits(asking, skip_own).join(F.broadcast(self.spans), "cell")
        visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        visits = visits.withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int"))
        blocks = self.blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        key = ["cell", "part", "chunk"]
        spark = asking.sparkSession
        tasks = min(max(int(self.parts.sum()) * chunks, 1), max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        width = self.width

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[list] = [[], [], [], []]
            if left.num_rows and right.num_rows:
                tree = Tree(matrix(left.column("v").combine_chunks(), width), left.column("id").to_numpy(), left.column("label").to_numpy())
                asked = matrix(right.column("v").combine_chunks(), width)
                for i, (q, own, label, windows) in enumerate(zip(*(right.column(c).to_pylist() for c in ("q", "id", "label", "windows")))):
                    for w in windows:
                        ids, scores = tree.search(asked[i], own, label, same, w["low"], w["high"], k)
                        for column, values in zip(out, (np.full(len(ids), q), np.full(len(ids), w["name"]), ids, scores)):
                            column.append(values)
            columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
            return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["q", "name", "other_id", "score"])

        # a number of partitions is given, since adaptive execution would put small blocks with much work into one task
        return blocks.repartition(tasks, *key).groupBy(*key).cogroup(visits.repartition(tasks, *key).groupBy(*key)).applyInArrow(
            run, "q long, name long, other_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q", "name").orderBy(F.desc("score"), "other_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k)


def _window(name: Column, low: Column, high: Column) -> Column:
    return F.struct(name.alias("name"), low.cast("double").alias("low"), high.cast("double").alias("high"))


def _percent(score: Column, percent: int) -> Column:
    """floor(score * percent / 100), in whole numbers."""
    hundredfold = score * percent
    return ((hundredfold - F.pmod(hundredfold, F.lit(100))) / 100).cast("long")


def mine(
    rows: DataFrame, queries: Column, label: Column, id_name: str = "vec_id", vector_name: str = "embedding",
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``queries`` says which rows are anchors. A negative's score is from ``low`` to ``high`` percent of the positive's.
    """
    forest = Forest(usable(rows, queries, label, id_name, vector_name, scale))
    endless = F.lit(float("inf"))
    anchors = staged(forest.rows.where("asks").select("id", "label", "v", "cell").distinct().withColumn("q", F.monotonically_increasing_id()), "anchors")
    anywhere = anchors.withColumn("windows", F.array(_window(F.lit(0).cast("long"), -endless, endless)))
    own = staged(_first(forest.search(anywhere, True, positives, skip_own=False), positives), "own")
    bound = own.where(F.col("rank") == positives).select("q", F.col("score").cast("double").alias("bound"))
    bounded = staged(anchors.join(bound, "q", "left").withColumn(
        "windows", F.array(_window(F.lit(0).cast("long"), F.coalesce("bound", -endless), endless))), "bounded")
    others = forest.search(bounded, True, positives, skip_own=True)
    pairs = staged(_first(own.drop("rank").union(others), positives).select(
        "q", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score")
    named = pairs.groupBy("q").agg(F.collect_set(_window(score, -_percent(-score, low), _percent(score, high))).alias("windows"))
    asking = staged(anchors.join(named.withColumn("windows", F.filter("windows", lambda w: w["low"] <= w["high"])), "q"), "asking")
    found = _first(forest.search(asking, False, negatives), negatives)
    by_anchor = anchors.select("q", F.col("id").alias("anchor_id"))
    return pairs.join(found.withColumnRenamed("name", "positive_score"), ["q", "positive_score"]).join(by_anchor, "q").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
