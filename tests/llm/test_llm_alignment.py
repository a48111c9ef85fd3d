import hashlib
import random

import llm_support as S
import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers

from stationflow.llm import alignment, queries

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    """Tokens and bytes by the libraries' own functions."""
    first = tokenizers.Tokenizer.from_file(alignment.BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    character = alignment._byte_characters()

    def bytes_a(i):
        word = first.id_to_token(i)
        return b"<|endoftext|>" if i == 50256 else bytes(character[c] for c in word)

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        data = (" " + text).encode()
        la, lb = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
        return (a, b, la, lb) if text and b"".join(la) == data == b"".join(lb) else ([], [], [], [])

    return tokens


def brute(texts, plain):
    """Per text the columns of the contract, by comparing every token with every other."""
    linked, out = [], []
    for text in texts:
        a, b, la, lb = plain(text or "")
        ends_a, ends_b = np.cumsum([len(x) for x in la]).tolist(), np.cumsum([len(x) for x in lb]).tolist()
        spans = lambda ids, lengths, ends: [(i, e - len(x), e) for i, x, e in zip(ids, lengths, ends)]
        x, y = spans(a, la, ends_a), spans(b, lb, ends_b)
        linked.append([(i, j) for i, s, e in x for j, u, v in y if s < v and u < e])
        cuts = [0] + sorted(set(ends_a) & set(ends_b))
        groups = [
            ",".join(str(i) for i, s, e in x if lo <= s and e <= hi) + "|" + ",".join(str(i) for i, s, e in y if lo <= s and e <= hi)
            for lo, hi in zip(cuts, cuts[1:])]
        out.append([len(a), len(b), len(groups), len(linked[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    counts, most = {}, {}
    for links in linked:
        for pair in set(links):
            counts[pair] = counts.get(pair, 0) + 1
    for (i, _), n in counts.items():
        most[i] = max(most.get(i, 0), n)
    for row, links in zip(out, linked):
        row[4:4] = [sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links)]
    return [tuple(row) for row in out]


def texts(seed, n=60):
    draw = random.Random(seed)
    pool = "the quick brown fox jumps über naïve 東京 привет don't we'll <|endoftext|> <s> 3.14159 a_b-c http://x.y/z?q=1 ▁ 🙂   \x00 fin".split(" ")
    gap = lambda: draw.choice([" ", " ", " ", "  ", "\n", "\t ", "", "   \n"])
    return [gap() + "".join(draw.choice(pool) + gap() for _ in range(draw.randrange(40))) for _ in range(n)]


def found(spark, rows, **more):
    out, counts = alignment.cross_tokenizer(S.frame(spark, rows).repartition(3), **more)
    got = sorted(tuple(r) for r in out.select("_doc.doc_id", *COLUMNS).collect())
    return got, counts


@pytest.mark.parametrize("head", [alignment.HEAD, 5])
def test_equals_brute_force(spark, plain, head):
    own = texts(4)
    got, counts = found(spark, [S.row(i, t) for i, t in enumerate(own)], head=head)
    expected = brute(own, plain)
    assert got == [(i, *e) for i, e in enumerate(expected)]
    assert sum(e[3] for e in expected) > 1000 and counts.where("best").count() < counts.count()


def test_odd_rows(spark, plain):
    rows = [r for r in S.ODD if r[0] is not None and len(r[1] or "") < 1000]
    out, _ = alignment.cross_tokenizer(S.frame(spark, rows).repartition(2))
    got = sorted(tuple(r) for r in out.select("_doc.doc_id", *COLUMNS).collect())
    assert got == sorted((r[0], *e) for r, e in zip(rows, brute([r[1] for r in rows], plain)))
    assert "text" not in out.select("_doc.*").columns and len(out.select("_doc.*").columns) == len(S.SCHEMA) - 1
    assert alignment.cross_tokenizer(S.odd(spark))[0].count() == len(S.ODD)


def test_empty_table(spark):
    out, counts = alignment.cross_tokenizer(S.empty(spark))
    assert out.count() == 0 and counts.count() == 0


def test_query_over_a_table(spark, plain, small_dir):
    docs = pq.read_table(f"{small_dir}/documents.parquet").to_pylist()
    short = [d for d in docs if len(d["text"]) < 700]
    whole = {r.doc_id: r for r in queries.op11_alignment(spark, small_dir).collect()}
    assert len(whole) == len(docs)
    for d, e in zip(short, brute([d["text"] for d in short], plain)):
        r = whole[d["doc_id"]]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*e[:4], e[6])
    assert all(r.n_best <= r.n_links <= r.count_sum for r in whole.values())


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner((alignment.BYTE_BPE, alignment.PIECE_BPE))


def test_equal_hashes_and_a_full_memo_change_nothing(monkeypatch, aligner):
    own = texts(9)
    expected = aligner.run(own)
    monkeypatch.setattr(alignment, "_hashes", lambda ids, starts: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(alignment, "MEMO", 0)
    got = aligner.run(own)
    for column in expected:
        assert [np.array_equal(a, b) for a, b in zip(expected[column], got[column])] == [True] * len(own)


def test_the_fast_engine_gives_the_files_ids(aligner):
    fast, slow = aligner.sides[0].encode, tokenizers.Tokenizer.from_file(alignment.BYTE_BPE)
    slow.encode_special_tokens = True
    assert fast.fast is not None
    for text in [*texts(2, 200), " " * 5000, "a" * 5000, "'s 'T 'll I'm’s ́e x​y ²½ ١٢ Ⅷ \r\n\x85 z"]:
        assert fast([text])[0] == slow.encode(text, add_special_tokens=False).ids


def test_a_text_the_fast_engine_refuses(aligner):
    class Refusing:
        def encode_ordinary(self, text):
            raise type("PanicException", (BaseException,), {})()

    first = alignment.ByteBpe()
    expected, first.fast = first([" some text"]), Refusing()
    assert first([" some text"]) == expected


def test_windows_are_one_word_or_so(aligner):
    aligner.memo = alignment.Memo(aligner.sides)
    out = aligner.run(["one two three one two three " * 500])
    assert len(aligner.memo.texts) <= 8 and out["n_groups"][0] >= 3000
