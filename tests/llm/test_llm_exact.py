import hashlib

import llm_support as S
import numpy as np

from stationflow.llm import exact


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return {t: (best[t], len(ids)) for t, ids in groups.items()}


def test_groups_equal_brute_force(spark):
    found = exact.groups(S.odd(spark)).collect()
    expected = brute(S.ODD)
    assert len(found) == len(S.ODD)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expected.items()}
    for r in found:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        assert r.kept <= (r.doc_id == r.keep_id)
    kept = [r.text_sha256 for r in found if r.kept]
    assert sorted(kept) == sorted(by_sha)  # one of each text, also of equal rows


def test_parts_of_the_filter_give_the_same(spark):
    rows = [S.row(i, f"text {i % 900}") for i in range(5000)]
    docs = S.frame(spark, rows)
    assert exact.filter_parts(5000, 1 << 16)[0] > 1
    assert S.plain(exact.groups(docs, max_bits=1 << 16), "doc_id", "keep_id", "group_size", "kept") == S.plain(
        exact.groups(docs), "doc_id", "keep_id", "group_size", "kept")


def test_deduplicate_keeps_whole_rows(spark):
    docs = S.odd(spark)
    out = exact.deduplicate(docs)
    assert out.columns == docs.columns
    kept = S.plain(out, "doc_id", "text")
    expected = {(best, t) for t, (best, _) in brute(S.ODD).items()}
    assert {(i, t or "") for i, t in kept} == expected and len(kept) == len(expected)


def test_most_single_rows_pass_the_filter(spark):
    docs = S.frame(spark, [S.row(i, f"text {i}") for i in range(3000)] + [S.row(9000 + i, "same") for i in range(50)])
    hashed = docs.selectExpr("xxhash64(text) as h", "text")
    again, once = exact.split_repeats(hashed, "h", hashed.count())
    assert again.where("text = 'same'").count() == 50
    assert once.count() > 2900 and again.count() + once.count() == 3050


def test_segments_pack_both_ways():
    for n in (0, 10, 60000):
        at = np.sort(np.random.default_rng(n).choice(exact.SEGMENT_BITS, n, replace=False))
        assert (np.flatnonzero(exact._unpack(exact._pack(at))) == at).all()


def test_empty_table(spark):
    assert exact.groups(S.empty(spark)).count() == 0
    assert exact.deduplicate(S.empty(spark)).count() == 0
