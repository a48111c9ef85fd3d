import glob

import llm_support as S
import numpy as np

from stationflow.llm import pieces, tokenfiles
from stationflow.session import scratch_path


def test_counts_equal_the_encoder(spark):
    v = pieces.Vocabulary.load()
    expected = sorted((str(r[0]), int(v.encode([r[1] or ""])[1][0])) for r in S.ODD)
    for size in (2, 1000, tokenfiles.BLOCK):
        found = tokenfiles.count_documents(S.odd(spark).limit(8) if size == 2 else S.odd(spark), size=size)
        got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in found.collect())
        assert got == expected if size > 2 else len(got) == 8


def test_files_are_flat(spark):
    path = scratch_path(spark, "flat")
    tokenfiles.write(S.frame(spark, [S.row(i, f"text {i}") for i in range(50)]).repartition(2), path)
    v = pieces.Vocabulary.load()
    data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/kind=tokens/part-*")))
    ids = np.frombuffer(data, "<u2")
    docs = [x.tolist() for x in np.split(ids, np.flatnonzero(ids == tokenfiles.END) + 1)][:-1]
    assert sorted(docs) == sorted([*v.encode([f"text {i}"])[0].tolist(), tokenfiles.END] for i in range(50))


def brute(ids, end):
    out, n = [], 0
    for x in ids:
        if x == end:
            out.append(n)
            n = 0
        else:
            n += 1
    return out + [n] * (n > 0)


def test_blocks_are_stitched(spark, tmp_path):
    rng = np.random.default_rng(4)
    cases = {
        "mixed": rng.integers(0, 6, 500), "none": np.full(300, 7), "only": np.full(40, 2), "one": np.array([5]), "end": np.array([5, 2]),
        "long": np.concatenate([np.full(1000, 9), [2], np.full(3, 9)]),
    }
    for width in (2, 4):
        folder = tmp_path / str(width)
        folder.mkdir()
        for name, ids in cases.items():
            (folder / name).write_bytes(ids.astype(f"<u{width}").tobytes() + b"\x01" * (name == "one"))
        for size in (4, 64, 1 << 20):
            found = tokenfiles.counts(spark, str(folder), end=2, width=width, size=size).collect()
            for name, ids in cases.items():
                own = sorted((r["document"], r["first"], r["n_tokens"]) for r in found if r["path"].endswith("/" + name))
                lengths = brute(ids.tolist(), 2)
                firsts = np.cumsum([0, *(n + 1 for n in lengths)])[:-1].tolist()
                assert own == list(zip(range(len(lengths)), firsts, lengths)), (name, size)


def test_empty_table(spark):
    assert tokenfiles.count_documents(S.empty(spark)).count() == 0
