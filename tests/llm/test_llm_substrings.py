import hashlib
import random
import re

import llm_support as S
import pytest
from hypothesis import given
from hypothesis import strategies as st

import numpy as np
from stationflow.llm import queries, substrings, wordhash


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, words=50):
    """Per row: words, removed words, kept words joined."""
    least = {}
    own = [(-(2 ** 63) if r[0] is None else r[0], split(r[1])) for r in rows]
    for i, w in own:
        for at in range(len(w) - words + 1):
            key = tuple(w[at:at + words])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, w), r in zip(own, rows):
        gone = set()
        for at in range(len(w) - words + 1):
            if least[tuple(w[at:at + words])] < i:
                gone.update(range(at, at + words))
        out.append((r[0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def found(docs, words=50):
    out = substrings.remove_repeats(docs, words=words)
    return S.plain(out, "_doc.doc_id", "_found.n_words", "_found.n_removed", "_found.kept")


def passages(seed):
    """Documents that share passages of 45 to 120 words at any place, one of them in a third of all."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    pool = [[word() for _ in range(n)] for n in (45, 49, 50, 51, 60, 70, 71, 120)]
    rows = []
    for i in range(240):
        text = [word() for _ in range(draw.randrange(0, 130))]
        for p in [pool[-2]] * (i % 3 == 0) + draw.sample(pool, draw.randrange(0, 3)):
            a = draw.randrange(0, 8)
            text += p[a if draw.random() < .4 else 0:] + [word() for _ in range(draw.randrange(0, 90))]
        rows.append(S.row(draw.randrange(10 ** 6), draw.choice([" ", "\n", " \t "]).join(text)))
    return rows


def test_the_cover_holds_every_difference():
    for words in (10, 21, 22, 50):
        period, cover = substrings.cover_for(words)
        assert period <= words and all(any((a - b) % period == d for a in cover for b in cover) for d in range(period))


def test_passages_equal_brute_force(spark):
    rows = passages(1)
    assert found(S.frame(spark, rows).repartition(5)) == brute(rows)
    assert sum(r[2] for r in brute(rows)) > 5000


@pytest.mark.parametrize("words", [5, 22, 30])
def test_other_lengths_equal_brute_force(spark, words):
    rows = passages(words)[:80]
    assert found(S.frame(spark, rows), words) == brute(rows, words)


@pytest.mark.parametrize("hot", [1, 40])
def test_hot_keys_and_others_meet_alike(spark, hot):
    docs = S.frame(spark, passages(4)[:120])
    key = lambda df: sorted((r.id, r.own, tuple(sorted(r.starts))) for r in df.collect())
    assert key(substrings.repeats(docs, hot=hot)) == key(substrings.repeats(docs)) != []


def test_near_copies_copies_and_ids(spark):
    base = [f"x{i}" for i in range(200)]
    near = base[:90] + ["other"] + base[91:]
    rows = [
        S.row(5, " ".join(base)), S.row(3, " ".join(near)), S.row(9, "  ".join(base)), S.row(9, "\n".join(base)),
        S.row(None, " ".join(base[100:160])), S.row(7, " ".join(base[:49])), S.row(8, " ".join(base[:50])), S.row(11, " ".join(base * 2)),
    ]
    assert found(S.frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = S.ODD
    out = substrings.remove_repeats(S.odd(spark))
    assert set(out.columns) == {"_doc", "_found"}
    assert found(S.odd(spark)) == brute(rows)


def test_empty_table(spark):
    assert substrings.remove_repeats(S.empty(spark)).count() == 0


def test_a_hot_passage_is_never_gathered(spark):
    plan = substrings.remove_repeats(S.frame(spark, passages(2)[:20]))._jdf.queryExecution().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(3000)).encode() + b" " + b"y" * 5000 + b" end"
    whole, _ = wordhash.word_hashes([text])
    monkeypatch.setattr(wordhash, "BLOCK", 700)
    cut, first = wordhash.word_hashes([text, b"", text])
    assert first.tolist() == [0, 3002, 3002, 6004]
    assert (cut[:3002] == whole).all() and (cut[3002:] == whole).all()


@given(st.lists(st.text(alphabet="ab é\t\n\x1f", max_size=12), max_size=6))
def test_word_hashes_tell_words_apart(texts):
    hashes, first = wordhash.word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in split(t)]
    assert np.diff(first).tolist() == [len(split(t)) for t in texts]
    assert len(hashes) == len(words)
    by_word = dict(zip(words, hashes.tolist()))
    assert [by_word[w] for w in words] == hashes.tolist() and len(set(by_word.values())) == len(by_word)


def test_query_gives_digests(spark, tmp_path):
    rows = passages(3)[:60]
    S.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = S.plain(queries.op13_substrings(spark, str(tmp_path)), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows)]
    assert out == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
