"""Mixing sources to target weights with a min-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern (the sorted set of their sources), so the flow network has one node per
pattern and per source, never per document. Arcs from the start to a pattern
carry the pattern's words once for each permitted repetition, each repetition
dearer than the one before (a convex cost), pattern to source arcs are free,
and each source's quota limits what it may take. The cheapest flow that fills
the quotas thus repeats as little as possible.

The words a pattern gives are then turned into documents: every document is
taken as often as the full repetitions say, and a seeded choice of documents
once more. The few that are large beside their pattern are chosen first, so
that the others can fill what they leave. Those are taken in the order of a
hash; hash buckets are summed first, so only the one bucket in which the amount
runs out is put in order. What a misfit leaves open is filled until no document
fits.

Bounds: patterns and sources are listed on the driver; more than
``MAX_PATTERNS`` raise an error, nothing is cut.

Defined results: a null text has size 0; documents of size 0 are taken 0 times.
A document without any source forms a pattern that gives nothing. A null source
is a source of its own, last in order. Rows that are equal in id and size are
taken alike; each has its own answer. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import staged

REPEATS = 3
BUCKETS = 4096
SEED = 20
MAX_PATTERNS = 10_000
LARGE = 256
CANDIDATES = 32
STEPS = 64
SALT = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def code_point_order(source: str | None) -> tuple:
    return (source is None, source or "")


def cycled_weights(sources: Sequence[str | None]) -> dict[str | None, int]:
    """1, 2, 3, 1, 2, ... to the sources by code point, null last."""
    return {s: i % 3 + 1 for i, s in enumerate(sorted(sources, key=code_point_order))}


def targets(sizes: dict[str | None, int], weights: dict[str | None, int], total: int, repeats: int = REPEATS) -> dict[str | None, float]:
    """Shares of ``total`` by weight; what exceeds ``repeats`` times a source's size goes to the others by weight."""
    out: dict[str | None, Fraction] = {}
    active = list(sizes)
    while active:
        left, weight = total - sum(out.values(), Fraction(0)), sum(weights[s] for s in active)
        share = {s: left * Fraction(weights[s], weight) for s in active}
        full = [s for s in active if share[s] > repeats * sizes[s]]
        if not full:
            out.update(share)
            break
        out.update({s: Fraction(repeats * sizes[s]) for s in full})
        active = [s for s in active if s not in out]
    return {s: float(v) for s, v in out.items()}


def min_cost_flow(arcs: list[tuple[int, int, int, int]], nodes: int, start: int, end: int) -> list[int]:
    """Flow of each arc (from, to, capacity, cost >= 0) in a cheapest flow of largest value: shortest paths with potentials."""
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, room, cost = [], [], []
    for a, b, capacity, price in arcs:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, 0]
        cost += [price, -price]
    potential = [0] * nodes
    while True:
        far, via = [math.inf] * nodes, [-1] * nodes
        far[start], heap = 0, [(0, start)]
        while heap:
            d, n = heapq.heappop(heap)
            if d > far[n]:
                continue
            for e in graph[n]:
                if room[e] and (x := d + cost[e] + potential[n] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = x, e
                    heapq.heappush(heap, (x, to[e]))
        if math.isinf(far[end]):
            return [room[2 * i + 1] for i in range(len(arcs))]
        potential = [p + f if f < math.inf else p for p, f in zip(potential, far)]
        path, n = [], end
        while n != start:
            path.append(via[n])
            n = to[via[n] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def route(patterns: dict[tuple, int], quotas: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple, dict[str | None, int]]:
    """Words that each pattern (of that many words) gives to each of its sources."""
    names, sources = list(patterns), sorted(quotas, key=code_point_order)
    place = {s: 1 + len(names) + i for i, s in enumerate(sources)}
    end = 1 + len(names) + len(sources)
    arcs, owner = [], []
    for i, p in enumerate(names):
        arcs += [(0, 1 + i, patterns[p], 2 ** r - 1) for r in range(repeats)]
        owner += [None] * repeats
        for s in p:
            arcs.append((1 + i, place[s], patterns[p] * repeats, 0))
            owner.append((p, s))
    for s in sources:
        arcs.append((place[s], end, quotas[s], 0))
        owner.append(None)
    out: dict[tuple, dict[str | None, int]] = {p: {} for p in names}
    for which, flow in zip(owner, min_cost_flow(arcs, end + 1, 0, end)):
        if which and flow:
            out[which[0]][which[1]] = flow
    return out


def _ordered(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (_id, _size, ...) with the place of each in the seeded order, and its bucket."""
    return rows.withColumn("_order", F.xxhash64(F.lit(seed), "_id", "_size")).withColumn("_bucket", F.pmod("_order", F.lit(BUCKETS)).cast("int"))


PLAN = "_members array<string>, _full long, _rounds array<struct<most: long, cut: int, upto: long>>"
SINGLE = "_members array<string>, _order long, _single boolean"
NONE = -(2 ** 63)


def pick_large(units: list[tuple[int, int]], rest: int, gap: int) -> tuple[list[int], int]:
    """(orders of the (size, order) to take, what stays open of ``gap``), so that smaller units of ``rest`` words can fill it.

    Largest first, each with the chance that what is wanted has in what is there.
    One that does not fit is left out, one without which the gap could not be
    filled is taken; where both hold, it is taken if that comes nearer.
    """
    taken, after = [], rest + sum(size for size, _ in units)
    for size, order in sorted(units, key=lambda u: (-u[0], u[1])):
        there, after = after, after - size
        needed = after < gap
        if size <= gap:
            take = needed or (order + 2 ** 63) * there < gap * 2 ** 64
        else:
            take = needed and size - gap < gap - after
        if take:
            taken.append(order)
            gap -= size
    return taken, max(gap, 0)


def choose(sized: DataFrame, gives: dict[tuple, int], seed: int = SEED) -> tuple[list[tuple], list[tuple]]:
    """What to take of each pattern so that the words come to ``gives``: rows of PLAN and of SINGLE.

    Every document is taken _full times. Once more goes who is named in SINGLE,
    and else who is not larger than ``most`` of a round and in a bucket before
    its ``cut``, or in that bucket and not after ``upto`` in the order. So the
    plan is a few numbers per pattern, and applies to any row by itself.

    Rows with one place in the order are a unit. Units above the LARGE-th part
    of their pattern (fewer than LARGE) are chosen first, one by one. The others
    fill the rest along the order; what the first that does not fit leaves open
    is filled with the largest that fit, and with further rounds along the order
    where many are needed, until none fits. Where rows repeat so often that more
    than LARGE units of small rows exceed what is open, that is less than a
    LARGE-th of the pattern, and STEPS times the CANDIDATES largest that fit
    may fill it. So the plan has a fixed size for each pattern.
    """
    spark = sized.sparkSession
    units = staged(
        _ordered(sized.where("_size > 0"), seed).groupBy("_members", "_bucket", "_order", "_size").agg(F.sum("_size").alias("_unit")), "units")
    sums = {tuple(m): (n, several) for m, n, several in units.groupBy("_members").agg(F.sum("_unit"), F.max(F.expr("_unit > _size"))).collect()}
    full, gap = dict.fromkeys(gives, 0), dict.fromkeys(gives, 0)
    for m, (n, _) in sums.items():
        full[m], gap[m] = divmod(gives.get(m, 0), n)
    rounds: dict[tuple, list[tuple]] = {m: [] for m in gives}
    single: dict[tuple, bool] = {}

    def plan() -> tuple[list[tuple], list[tuple]]:
        return [(list(m), full[m], rounds[m]) for m in gives], [(list(m), order, take) for (m, order), take in single.items()]

    def by_pattern(values: dict[tuple, tuple], columns: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame([(list(m), *v) for m, v in values.items()], f"_members array<string>, {columns}"))

    def untaken(most: dict[tuple, int]) -> DataFrame:
        return _planned(units, plan()).where(~F.col("_more")).join(by_pattern({m: (n,) for m, n in most.items()}, "_most long"), "_members")

    def crowded(most: dict[tuple, int]) -> set[tuple]:
        """Patterns with more than LARGE units beyond ``most`` whose rows are not; each of them is an exception of a round.

        Such units hold more than LARGE times ``most`` words, so what is open is a small part of the pattern.
        """
        if not any(sums[m][1] for m in most):
            return set()
        units_of = untaken(most).where("_size <= _most and _unit > _most").groupBy("_members").count()
        return {tuple(m) for m, _ in units_of.where(F.col("count") > LARGE).collect()}

    def along(most: dict[tuple, int]) -> None:
        """Takes the units up to ``most`` in the order, to the first that does not fit into the gap."""
        stay = crowded(most)
        most = {m: n for m, n in most.items() if m not in stay}
        if not most:
            return
        left = untaken(most)
        fits = left.where("_unit <= _most")
        held: dict[tuple, dict[int, int]] = {}
        for members, bucket, n in fits.groupBy("_members", "_bucket").agg(F.sum("_unit")).collect():  # at most BUCKETS a pattern
            held.setdefault(tuple(members), {})[bucket] = n
        cuts = {}
        for m, buckets in held.items():
            cut, before = BUCKETS, 0
            for b in sorted(buckets):
                if before + buckets[b] > gap[m]:
                    cut = b
                    break
                before += buckets[b]
            gap[m] -= before
            cuts[m] = (cut, gap[m])
        edge = fits.join(by_pattern(cuts, "_cut int, _left long"), "_members").where("_bucket = _cut").withColumn("_so_far", F.sum("_unit").over(
            Window.partitionBy("_members").orderBy("_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        ends = {
            tuple(m): (upto, n) for m, upto, n in
            edge.where("_so_far <= _left").groupBy("_members").agg(F.max("_order"), F.max("_so_far")).collect()}
        now = {}
        for m, (cut, _) in cuts.items():
            upto, n = ends.get(m, (NONE, 0))
            gap[m] -= n
            now[m] = (cut, upto)
            rounds[m].append((most[m], cut, upto))
        # rows of a unit beyond the limit cannot see it where they are within the limit themselves
        if any(sums[m][1] for m in now):
            hidden = left.where("_size <= _most and _unit > _most").join(by_pattern(now, "_cut int, _upto long"), "_members")
            for members, order in hidden.where("_bucket < _cut or _bucket = _cut and _order <= _upto").select("_members", "_order").collect():
                single[tuple(members), order] = False

    def best(most: dict[tuple, int]) -> dict[tuple, bool]:
        """Takes the largest of up to CANDIDATES units that fit; by pattern with such units, whether one of them is left."""
        # the best of each of some salted parts first: a busy pattern's candidates never meet in one task
        rank = [F.row_number().over(Window.partitionBy("_members", *salt).orderBy(F.desc("_unit"), "_order")) for salt in (["salt"], [])]
        top = untaken(most).where("_unit <= _most").withColumn("salt", F.pmod("_order", F.lit(SALT)))
        top = top.withColumn("n", rank[0]).where(F.col("n") <= CANDIDATES).withColumn("n", rank[1]).where(F.col("n") <= CANDIDATES)
        left: dict[tuple, bool] = {}
        for members, size, order, _ in sorted(top.select("_members", "_unit", "_order", "n").collect(), key=lambda r: r["n"]):
            m = tuple(members)
            fits = size <= gap[m]
            left[m] = left.get(m, False) or not fits
            if fits:
                gap[m] -= size
                single[m, order] = True
        return left

    large: dict[tuple, list[tuple[int, int]]] = {m: [] for m in sums}
    for members, size, order in units.join(by_pattern({m: (n // LARGE,) for m, (n, _) in sums.items()}, "_most long"), "_members").where(
            "_unit > _most").select("_members", "_unit", "_order").collect():
        large[tuple(members)].append((size, order))
    for m, some in large.items():
        taken, gap[m] = pick_large(some, sums[m][0] - sum(size for size, _ in some), gap[m])
        single.update({(m, order): True for order in taken})
    along({m: n // LARGE for m, (n, _) in sums.items() if gap[m]})
    tight: dict[tuple, int] = {}  # of patterns that no round along the order fits any more: steps taken
    while True:
        fitted = best({m: g for m, g in gap.items() if g and tight.get(m, 0) < STEPS})
        if not fitted:
            break
        if some := {m: gap[m] for m in fitted if gap[m] and sums[m][1]}:
            for m in crowded(some):
                tight[m] = tight.get(m, 0) + 1
        # all candidates fitted, so there may be many more: along the order with them
        if many := {m: gap[m] for m, left in fitted.items() if gap[m] and not left}:
            along(many)
    # one that is larger than what is left comes nearer than none if it is below twice that
    over = untaken({m: g for m, g in gap.items() if g}).where("_unit > _most and _unit < 2 * _most").groupBy("_members")
    for members, nearest in over.agg(F.min(F.struct("_unit", "_order")).alias("best")).collect():
        single[tuple(members), nearest["_order"]] = True
    return plan()


def _planned(ordered: DataFrame, plan: tuple[list[tuple], list[tuple]]) -> DataFrame:
    """With _full and _more by the plan of the row's pattern."""
    spark = ordered.sparkSession
    rows = ordered.join(F.broadcast(spark.createDataFrame(plan[0], PLAN)), "_members")
    rows = rows.join(F.broadcast(spark.createDataFrame(plan[1], SINGLE)), ["_members", "_order"], "left")
    inside = F.exists("_rounds", lambda r: (F.col("_size") <= r["most"]) & (
        (F.col("_bucket") < r["cut"]) | (F.col("_bucket") == r["cut"]) & (F.col("_order") <= r["upto"])))
    return rows.withColumn("_more", F.coalesce("_single", inside)).drop("_rounds", "_single")


def _sized(docs: DataFrame, members: Column, id_name: str, text_name: str, *more: Column) -> DataFrame:
    return docs.select(
        F.col(id_name).alias("_id"), F.array_sort(F.array_distinct(members)).alias("_members"), word_count(F.col(text_name)).alias("_size"), *more)


def plan_mix(
    docs: DataFrame, members: Column, id_name: str = "doc_id", text_name: str = "text",
    weights: dict[str | None, int] | None = None, repeats: int = REPEATS, seed: int = SEED,
) -> tuple[DataFrame, tuple[list[tuple], list[tuple]], dict[str | None, dict]]:
    """(sizes of the documents, plan, per source: size, weight, target, words routed to it)."""
    sized = staged(_sized(docs, members, id_name, text_name), "sizes")
    counted = sized.groupBy("_members").agg(F.sum("_size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(counted) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r[0]): r[1] for r in counted}
    sizes: dict[str | None, int] = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    weights = weights or cycled_weights(list(sizes))
    wanted = targets(sizes, weights, sum(patterns.values()), repeats)
    flows = route(patterns, {s: round(t) for s, t in wanted.items()}, repeats)
    plan = choose(sized, {p: sum(f.values()) for p, f in flows.items()}, seed)
    report = {
        s: {"size": sizes[s], "weight": weights[s], "target": wanted[s], "routed": sum(f.get(s, 0) for f in flows.values())}
        for s in sizes
    }
    return sized, plan, report


def mix(
    docs: DataFrame, members: Column, id_name: str = "doc_id", text_name: str = "text",
    weights: dict[str | None, int] | None = None, repeats: int = REPEATS, seed: int = SEED,
) -> tuple[DataFrame, dict[str | None, dict]]:
    """(one row per document: _id, _members, _size, _taken; per source: size, weight, target, words routed to it).

    ``members`` is an array column with the sources of a document, ``weights`` their weights (default: 1, 2, 3 in turn).
    """
    sized, plan, report = plan_mix(docs, members, id_name, text_name, weights, repeats, seed)
    taken = _planned(_ordered(sized, seed), plan)
    return taken.select("_id", "_members", "_size", (F.col("_size") * (F.col("_full") + F.col("_more").cast("long"))).alias("_taken")), report


def with_targets(taken: DataFrame, report: dict[str | None, dict]) -> DataFrame:
    """Adds _source_size and _target of the first source in _members."""
    rows = [(s, r["size"], r["target"]) for s, r in report.items()]
    schema = T.StructType([
        T.StructField("_source", T.StringType()), T.StructField("_source_size", T.LongType()), T.StructField("_target", T.DoubleType())])
    sources = taken.sparkSession.createDataFrame(rows, schema)
    return taken.join(F.broadcast(sources), F.col("_members")[0].eqNullSafe(F.col("_source")), "left")


def repeat_rows(
    docs: DataFrame, members: Column, id_name: str = "doc_id", text_name: str = "text", repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. The plan applies to each row by itself: no text is shuffled."""
    _, plan, _ = plan_mix(docs, members, id_name, text_name, repeats=repeats, seed=seed)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    planned = _planned(_ordered(_sized(docs, members, id_name, text_name, row), seed), plan).where("_size > 0")
    times = F.col("_full") + F.col("_more").cast("long")
    return planned.where(times > 0).select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), times))).select("_doc.*")
