import zlib

import llm_support as S
import numpy as np

from stationflow.llm import langid

WORDS = {"en": "the and of this with house water light".split(), "de": "der und nicht schön Straße Wasser Licht".split(), "es": "el niño agua casa luz está también".split()}


def text(lang, i, words=12):
    rng = np.random.default_rng(i)
    return " ".join(rng.choice(WORDS[lang], words))


def many(n=600):
    langs = list(WORDS)
    return [S.row(i, text(langs[i % 3], i), langs[i % 3]) for i in range(n)]


def test_held_out_rows_are_recognised(spark):
    found = langid.identify(S.frame(spark, many())).select("_doc.doc_id", "_doc.lang", "_found.*").toDF("doc_id", "truth", "lang", "score", "accepted").collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(found) == 600 and sum(r.truth == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_documents(spark):
    docs = S.frame(spark, many() + [S.row(1000 + (r[0] or 0), *r[1:4]) if r[0] else r for r in S.ODD])
    found = {r["doc_id"]: r for r in langid.identify(docs).select("_doc.doc_id", "_found.*").collect()}
    for i in (1001, 1002, 1003, 1012):
        assert (found[i]["lang"], found[i]["score"], found[i]["accepted"]) == ("und", 0.0, False)
    assert found[1007]["lang"] == "en" and found[1009]["lang"] in WORDS


def test_held_out_rows_do_not_train(spark):
    docs = S.frame(spark, many())
    changed = S.frame(spark, [S.row(r[0], "zzz " * 9, "xx") if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r for r in many()])
    a = langid.fit(langid.sample(docs, ~langid.held_out()))
    b = langid.fit(langid.sample(changed, ~langid.held_out()))
    assert a.languages == b.languages == ("de", "en", "es") and np.array_equal(a.table, b.table)


def test_chunks_of_long_texts_add_up():
    model = langid.fit([(k, text(k, i)) for k in WORDS for i in range(40)])
    line = langid.letters((text("de", 1, 3000)).encode())
    whole = model.logits(line)
    before, langid._CHUNK = langid._CHUNK, 997
    try:
        assert np.allclose(model.logits(line), whole)
    finally:
        langid._CHUNK = before


def test_rejection_reaches_the_asked_precision():
    rng = np.random.default_rng(1)
    samples = [(k, text(k, i)) for k in WORDS for i in range(100)] + [(list(WORDS)[i % 3], text("en", i)) for i in range(60)]
    rng.shuffle(samples)
    model = langid.fit([tuple(s) for s in samples], precision=0.99)
    assert model.threshold > 0


def test_no_training_rows(spark):
    found = langid.identify(S.frame(spark, [S.row(1, "some text", None)])).select("_found.lang").collect()
    assert [r.lang for r in found] == ["und"]
    assert langid.identify(S.empty(spark)).count() == 0
