import compare
import corpus_pipeline
import llm_support as S
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stationflow.llm import exact, langid, mixture, oracle, pieces, simhash
from stationflow.llm.queries import QUERIES


def test_every_operator_has_one_query():
    for n in range(1, 14):
        assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(oracle.ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, small_dir, name):
    assert compare.differences(QUERIES[name](spark, small_dir), compare.duck(small_dir), oracle.ORACLE[name]) == []


def test_stages_equal_their_plain_versions(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").withColumn("_doc", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, small_dir)
        if name != "tokens":
            assert out.columns == docs.columns
        after = out.collect()
        ids = sorted(r.doc_id for r in after)
        if name == "language":
            accepted = langid.identify(docs).where("_found.accepted").select("_doc.doc_id").collect()
            assert ids == sorted(r.doc_id for r in accepted) and len(ids) >= 0.95 * len(before)
        elif name == "exact_copies":
            best = {}
            for r in before:
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert ids == sorted(best.values())
        elif name == "near_copies":
            prints = [(r.doc_id, simhash.fingerprint(r.text.encode())) for r in before]
            label = {i: i for i, _ in prints}
            for _ in prints:
                moved = False
                for i, p in prints:
                    for j, q in prints:
                        if label[j] < label[i] and (p ^ q).bit_count() <= 2:
                            label[i], moved = label[j], True
                if not moved:
                    break
            assert ids == sorted(set(label.values()))
        elif name == "mixed_sources":
            taken, _ = mixture.mix(docs, F.array("source"))
            assert ids == sorted(r["_id"] for r in taken.collect() if r["_size"] for _ in range(r["_taken"] // r["_size"]))
        else:
            v = pieces.Vocabulary.load()
            assert len(after) == len(before)
            texts = {r.doc_id: r.text for r in before}
            assert all(r.ids == v.encode([texts[r.doc_id]])[0].tolist() and r.n_pieces == len(r.ids) for r in after)
        docs = spark.createDataFrame(after, out.schema)


def test_odd_and_empty_documents(spark, tmp_path):
    for name, docs in (("odd", S.odd(spark)), ("empty", S.empty(spark))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in rows} <= {r[0] for r in S.ODD}


def test_repeated_rows_leave_one(spark):
    docs = S.frame(spark, [S.row(1, "same text")] * 5)
    assert exact.deduplicate(docs).count() == 1
