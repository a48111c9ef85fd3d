import llm_support as S
import pytest
from pyspark.sql import functions as F

from stationflow.llm import mixture


def test_targets_stop_at_three_times_and_share_the_rest():
    sizes = {"a": 100, "b": 10, "c": 1000, None: 0}
    weights = mixture.cycled_weights(list(sizes))
    assert weights == {"a": 1, "b": 2, "c": 3, None: 1}
    found = mixture.targets(sizes, weights, 1110)
    assert found["b"] == 30 and found[None] == 0
    assert sum(found.values()) == pytest.approx(1110)
    assert found["c"] == pytest.approx(3 * found["a"])


def test_flow_repeats_as_little_as_possible():
    # the shared pattern serves both; b can be filled without repeating its own documents
    flows = mixture.route({("a",): 100, ("b",): 50, ("a", "b"): 100}, {"a": 100, "b": 150})
    assert sum(flows[("b",)].values()) == 50 and flows[("a", "b")] == {"b": 100} and flows[("a",)] == {"a": 100}
    flows = mixture.route({("a",): 10}, {"a": 25})
    assert flows == {("a",): {"a": 25}}
    assert mixture.route({("a",): 10}, {"a": 99}) == {("a",): {"a": 30}}


def brute_cost(patterns, quotas):
    """Cheapest cost of the largest flow by trying all splits of small amounts."""
    names = list(patterns)
    best = {}

    def go(i, left, cost):
        if i == len(names):
            filled = sum(quotas.values()) - sum(left.values())
            best[filled] = min(best.get(filled, 10**9), cost)
            return
        p = names[i]
        own = [s for s in p]

        def give(k, left, used):
            if k == len(own):
                price = sum(max(0, min(used - r * patterns[p], patterns[p])) * (2 ** r - 1) for r in range(3))
                go(i + 1, left, cost + price)
                return
            for x in range(min(left[own[k]], 3 * patterns[p] - used) + 1):
                give(k + 1, left | {own[k]: left[own[k]] - x}, used + x)

        give(0, left, 0)

    go(0, dict(quotas), 0)
    top = max(best)
    return top, best[top]


def test_flow_equals_brute_force():
    patterns, quotas = {("a",): 2, ("a", "b"): 2, ("b", "c"): 1}, {"a": 5, "b": 4, "c": 2}
    flows = mixture.route(patterns, quotas)
    filled = sum(sum(f.values()) for f in flows.values())
    cost = sum(sum(max(0, min(sum(f.values()) - r * patterns[p], patterns[p])) * (2 ** r - 1) for r in range(3)) for p, f in flows.items())
    assert (filled, cost) == brute_cost(patterns, quotas)


def test_mix_of_many_documents(spark):
    rows = [S.row(i, "w " * (i % 97 + 1), source=f"s{i % 4}" if i % 3 else "big") for i in range(4000)]
    docs = S.frame(spark, rows)
    taken, report = mixture.mix(docs, F.array("source"))
    found = taken.collect()
    assert len(found) == 4000
    got = {}
    for r in found:
        assert r["_taken"] <= 3 * r["_size"] and r["_taken"] % r["_size"] == 0
        got[r["_members"][0]] = got.get(r["_members"][0], 0) + r["_taken"]
    for s, r in report.items():
        assert abs(got[s] - r["target"]) <= 2
    again, _ = mixture.mix(docs.repartition(7), F.array("source"))
    assert S.plain(again, "_id", "_taken") == S.plain(taken, "_id", "_taken")


def test_one_document_with_half_of_the_words(spark):
    # of 8,000 words, "a" gives a third; "b" two thirds: its own 4,000 once and 1,333 again, which the long one would exceed
    sizes = {"a": [7] * 571 + [3], "b": [2000] + [5] * 400}
    docs = S.frame(spark, [S.row(1000 * k + i, "w " * n, source=s) for k, s in enumerate(sizes) for i, n in enumerate(sizes[s])])
    for seed in range(3):
        taken, report = mixture.mix(docs, F.array("source"), seed=seed)
        got = {r["_members"][0]: r["n"] for r in taken.groupBy("_members").agg(F.sum("_taken").alias("n")).collect()}
        for s, r in report.items():
            assert abs(got[s] - r["target"]) <= 4


def test_many_misfits_and_copies_are_filled(spark):
    # half of the words wanted; one huge document, long ones, copies taken alike, and single words, more than any list of candidates
    sizes = [20000] + [900] * 10 + [100] * 40 + [1] * 6000
    rows = [(str(i), ["s"], n) for i, n in enumerate(sizes)] + [("copies", ["s"], 3)] * 400
    sized = spark.createDataFrame(rows, "_id string, _members array<string>, _size long")
    for share, seed in [(0.3, 1), (0.5, 2), (0.5, 3), (0.9, 4)]:
        wanted = round(sum(r[2] for r in rows) * share)
        planned = mixture._planned(mixture._ordered(sized, seed), mixture.choose(sized, {("s",): wanted}, seed)).where("_more")
        copies = planned.where("_id = 'copies'").count()
        assert planned.agg(F.sum("_size")).first()[0] == wanted and copies in (0, 400)


@pytest.mark.parametrize("copies", [2, 5])
def test_the_plan_does_not_grow_with_repeated_ids(spark, copies):
    entries = []
    for n in (3000, 12000):
        rows = spark.range(n).selectExpr("cast(id as string) as _id", "array('s') as _members", "590 + id % 20 as _size", f"explode(sequence(1, {copies})) as c").drop("c")
        rows = rows.union(spark.range(60).selectExpr("concat('small', id)", "array('s')", "1 + id % 7"))
        wanted = n * 599 * copies * 2 // 5 + 77
        full, single = mixture.choose(rows, {("s",): wanted}, 3)
        got = mixture._planned(mixture._ordered(rows, 3), (full, single)).where("_more").agg(F.sum("_size")).first()[0]
        assert abs(got - wanted) <= 600 * copies
        entries.append(len(single) + sum(len(r) for _, _, r in full))
    assert max(entries) <= mixture.STEPS * mixture.CANDIDATES and entries[1] <= entries[0] + 64


def test_large_units_leave_what_the_rest_can_fill():
    for seed in range(200):
        places = [(seed * 7919 + i * 104729) * 2654435761 % 2 ** 64 - 2 ** 63 for i in range(3)]
        units = list(zip([500, 300, 100], places))
        taken, gap = mixture.pick_large(units, 400, 900)
        assert 0 <= gap <= 400 and sum(n for n, p in units if p in taken) == 900 - gap
    # neither with nor without it: what comes nearer
    assert mixture.pick_large([(90, 5)], 10, 60) == ([5], 0) and mixture.pick_large([(90, 5)], 10, 40) == ([], 40)


def test_odd_documents(spark):
    taken, report = mixture.mix(S.odd(spark), F.array("source"))
    rows = mixture.with_targets(taken, report).collect()
    assert len(rows) == len(S.ODD)
    sizes = {r["_id"]: r["_size"] for r in rows}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[7] == 54000
    assert all(r["_taken"] <= 3 * r["_size"] for r in rows)
    assert {r["_source_size"] for r in rows if r["_members"] == [None]} == {4}


def test_several_memberships(spark):
    docs = S.frame(spark, [S.row(i, "w " * 10, source="ab"[i % 2]) for i in range(200)])
    members = F.when(F.col("doc_id") < 50, F.array(F.lit("a"), F.lit("b"))).when(F.col("doc_id") == 199, F.array().cast("array<string>")).otherwise(F.array("source"))
    taken, report = mixture.mix(docs, members)
    assert {tuple(r["_members"]) for r in taken.collect()} == {("a",), ("b",), ("a", "b"), ()}
    assert sum(r["routed"] for r in report.values()) == sum(r["_taken"] for r in taken.collect())


def test_repeat_rows(spark):
    rows = [S.row(i, "w " * 10, source="a" if i < 20 else "b") for i in range(60)]
    out = mixture.repeat_rows(S.frame(spark, rows), F.array("source"))
    counts = out.groupBy("source").count().collect()
    # weights 1 and 2: 200 of 600 words, and 400
    assert {r["source"]: r["count"] for r in counts} == {"a": 20, "b": 40} and out.columns == S.SCHEMA.fieldNames()


def test_empty_table(spark):
    taken, report = mixture.mix(S.empty(spark), F.array("source"))
    assert taken.count() == 0 and report == {}
    assert mixture.with_targets(taken, report).count() == 0
    assert mixture.repeat_rows(S.empty(spark), F.array("source")).count() == 0
