import llm_support as S
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stationflow.llm import pieces, support


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def brute(v, unit):
    """Best cut over all pieces; at equal sums the longest last piece."""
    ids = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
    best = [(0.0, [])] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(end):
            piece = ids.get(unit[start:end])
            if piece is None and end - start > 1:
                continue
            path = [piece] if piece is not None else [int(v.byte_id[b]) for b in unit[start:end].encode()]
            value = best[start][0] + (v.scores[piece] if piece is not None else v.low)
            if best[end] is None or value > best[end][0]:
                best[end] = (value, best[start][1] + path)
    return best[-1][1]


def each(v, texts):
    ids, counts = v.encode(texts)
    return np.split(ids, np.cumsum(counts)[:-1])


def test_cuts_equal_brute_force(vocabulary, spark, small_dir):
    texts = [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("text").limit(40).collect()]
    units = sorted({u for t in texts for u in vocabulary.units(t)})[:600] + ["▁▁▁a", "▁𓀀é", "▁▁", "𓀀𓀀", "▁supercalifragilistic"]
    ids, counts = vocabulary.solve(units)
    for unit, found in zip(units, np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == brute(vocabulary, unit), unit


def test_whole_texts_equal_cut_ones(vocabulary):
    text = "The same  text, with   blanks and 日本 𓀀"
    cut = each(vocabulary, [text])[0].tolist()
    vocabulary.cut = False
    try:
        assert each(vocabulary, [text])[0].tolist() == cut
    finally:
        vocabulary.cut = True


def test_matches_the_library_on_a_unigram_model(tmp_path):
    sentencepiece.set_random_generator_seed(1)
    raw = open(pieces.MODEL_PATH, "rb").read()
    # the same file with the trainer's model type changed from BPE (2) to unigram (1): field 3 of the trainer's settings
    at = raw.find(b"\x18\x02 \x80\xfa\x01")
    if at < 0:
        pytest.skip("the model file has another layout")
    patched = raw[:at] + b"\x18\x01" + raw[at + 2:]
    library = sentencepiece.SentencePieceProcessor(model_proto=patched)
    v = pieces.Vocabulary.load()
    v.scores = np.array([library.get_score(i) for i in range(library.vocab_size())])
    v.low = float(v.scores[v.normal & (v.scores > -1e8)].min()) - pieces.UNKNOWN_PENALTY
    for text in ("Hello world", "a quick brown fox", "two  blanks"):
        assert each(v, [text])[0].tolist() == library.encode(text)


def test_round_trip(spark):
    docs = S.odd(spark)
    found = docs.select("doc_id", "text", pieces.round_trip(docs)(F.col("text")).alias("r")).collect()
    for r in found:
        assert r["r"]["text"] == (r["text"] or "").replace("▁", " ")
    assert {r["doc_id"]: len(r["r"]["ids"]) for r in found}[2] == 0
    both = docs.select("text", pieces.decoder(docs)(pieces.encoder(docs)(F.col("text"))).alias("back")).collect()
    assert all(b == (t or "").replace("▁", " ") for t, b in both)


def test_unknown_without_byte_pieces(vocabulary):
    v = pieces.Vocabulary(["<unk>", "▁", "a", "ab"], np.array([0.0, -1, -2, -2.5]), np.array([False, True, True, True]), np.full(256, -1), 0)
    assert each(v, ["ab", "az", ""])[0].tolist() == [1, 3]
    assert each(v, ["az"])[0].tolist() == [1, 2, 0]


def test_cache_is_emptied_when_full(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_UNITS", 3)
    solved = pieces.Solved()
    texts = ["one two three four", "five six one"]
    first = [x.tolist() for x in each(vocabulary, texts)]
    assert [np.split(*(lambda i, c: (i, np.cumsum(c)[:-1]))(*vocabulary.encode([t], solved)))[0].tolist() for t in texts] == first


def test_empty_table(spark):
    docs = S.empty(spark)
    assert docs.select(pieces.encoder(docs)(F.col("text"))).count() == 0


def test_rows_encoded_in_a_stream(spark, monkeypatch):
    docs = S.odd(spark)
    monkeypatch.setattr(pieces, "slices", lambda batch, column, most: support.slices(batch, column, 1))  # one row at a time
    out = pieces.encoded(docs)
    assert out.columns == [c for c in docs.columns if c != "text"] + ["ids"]
    expected = docs.select("doc_id", "a.b".join("``"), pieces.encoder(docs)(F.col("text")).alias("ids"))
    key = lambda rows: sorted(map(str, rows))
    assert key(out.select("doc_id", "`a.b`", "ids").collect()) == key(expected.collect())
    assert pieces.encoded(S.empty(spark)).count() == 0
