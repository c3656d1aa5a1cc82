"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op2_substring_dedup": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
        g AS (SELECT doc_id, i, w[i:i + 12] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        m AS (SELECT gram, min(doc_id) AS earliest FROM g GROUP BY gram),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (gram) WHERE earliest < doc_id),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages),
        h AS (SELECT *, sha1(body) AS x FROM p)
        SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(x, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
            CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> keeper THEN keeper END AS refers_to
        FROM h""",
    "op7_exact_top_k": """
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 20""",
    "op8_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '{_WORD}') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, w[i:i + 3] AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other)
        SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
            sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
