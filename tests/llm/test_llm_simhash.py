import random

import llm_support as S
import xxhash

from stationflow.llm import components, simhash


def brute_print(text):
    line = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = line.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    label = list(range(len(prints)))
    todo = True
    while todo:
        todo = False
        for i, a in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j]).bit_count() <= simhash.TAU and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    todo = True
    return label


def test_odd_documents(spark):
    found = simhash.near_groups(S.odd(spark)).collect()
    prints = [brute_print(r[1]) for r in S.ODD]
    label = brute_components(prints)
    low = {}
    for r, k in zip(S.ODD, label):
        if r[0] is not None:
            low[k] = min(low.get(k, r[0]), r[0])
    expected = sorted((str(r[0]), f"{p:016x}", str(low.get(k))) for r, p, k in zip(S.ODD, prints, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected


def clustered(rng, centers, each, bits):
    out = set()
    for _ in range(centers):
        center = rng.getrandbits(64)
        for _ in range(each):
            x = center
            for _ in range(rng.randrange(bits + 1)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_join_what_brute_force_joins(spark):
    rng = random.Random(2)
    prints = clustered(rng, 12, 40, 4) + [rng.getrandbits(64) for _ in range(100)]
    prints = sorted(set(prints))
    label = brute_components(prints)
    for bucket in (1, 4, 64):  # all keys crowded, some, none
        links = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bucket)
        for a, b in links.collect():
            assert (a ^ b).bit_count() if a >= 0 and b >= 0 else True
        roots = {r["node"]: r["root"] for r in components.components(links).collect()}
        groups, expected = {}, {}
        for p, k in zip(prints, label):
            groups.setdefault(roots.get(signed(p), signed(p)), set()).add(p)
            expected.setdefault(k, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_keep_one_of_each_group(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [S.row(30 + i, base + " tail" * i) for i in range(3)] + [S.row(1, "another text of some words"), S.row(2, None)]
    out = simhash.keep_one(S.frame(spark, rows))
    expected = {r.component_id for r in simhash.near_groups(S.frame(spark, rows)).collect()}
    assert {r.doc_id for r in out.collect()} == expected and out.columns == S.SCHEMA.fieldNames()


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (7000, 7000), (None, 3)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(301)) and all(found[1000 + i] == 1000 for i in range(301)) and found[7000] == 7000


def test_empty_table(spark):
    assert simhash.near_groups(S.empty(spark)).count() == 0
    assert simhash.keep_one(S.empty(spark)).count() == 0
