"""DuckDB SQL for the queries of this package that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op8_top_k"] = """
WITH codes AS (
    SELECT vec_id AS id,
           list_aggregate(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (64 - i)::INT ELSE 0::HUGEINT END), 'sum')::HUGEINT AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
    SELECT q.id AS query_id, r.id AS neighbor_id, bit_count(xor(q.code, r.code))::BIGINT AS distance
    FROM codes q JOIN codes r ON q.id % 100 = 0 AND q.id <> r.id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, neighbor_id, distance
FROM pairs
QUALIFY rank <= 10
"""

ORACLE["op13_substrings"] = """
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
    SELECT row, doc_id, place, md5(array_to_string(list_slice(words, place, place + 49), ' ')) AS content
    FROM docs, unnest(range(1, len(words) - 48)) AS starts(place)
), judged AS (
    SELECT row, place, coalesce(doc_id, -9223372036854775808) > min(coalesce(doc_id, -9223372036854775808)) OVER (PARTITION BY content) AS again
    FROM windows
), placed AS (
    SELECT d.row, d.doc_id, p.place, d.words[p.place] AS word, coalesce(max(CASE WHEN j.again THEN 1 ELSE 0 END)
           OVER (PARTITION BY d.row ORDER BY p.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM docs d CROSS JOIN unnest(range(1, len(d.words) + 1)) AS p(place) LEFT JOIN judged j ON j.row = d.row AND j.place = p.place
), kept AS (
    SELECT row, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (gone = 0) AS text
    FROM placed GROUP BY row
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
"""

ORACLE["op12_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, r.label = a.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER first)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW first AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 5
"""
