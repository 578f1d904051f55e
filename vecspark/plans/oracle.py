"""DuckDB SQL that states the result of each registered query."""

from __future__ import annotations

_EMB = """
items AS (SELECT vec_id::VARCHAR AS id, vec_id, embedding::DOUBLE[] AS v, label,
  CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, label / 4.0 AS weight, label % 3 AS level,
  't' || (label % 2) AS tag1, 'u' || label AS tag2 FROM embeddings),
queries AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings)"""

_DIST = {
    "euclidean": "list_distance(qv, v)",
    "squared_euclidean": "list_distance(qv, v) * list_distance(qv, v)",
    "cosine": "CASE WHEN list_distance(v, list_transform(v, lambda x: 0.0)) = 0 OR "
              "list_distance(qv, list_transform(qv, lambda x: 0.0)) = 0 THEN 1.0 ELSE list_cosine_distance(qv, v) END",
}

# Label means, rounded as in the workload: the lists and the codes.
_MEANS = """
cells AS (SELECT label, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, unnest(embedding::DOUBLE[]) AS x FROM embeddings),
mean_cells AS (SELECT label AS list_id, pos, round(avg(x), 6) AS x FROM cells GROUP BY label, pos),
means AS (SELECT list_id, list(x ORDER BY pos) AS c FROM mean_cells GROUP BY list_id)"""

_ASSIGNED = """
assigned AS (SELECT id, arg_min(list_id, (d, list_id)) AS list_id
  FROM (SELECT id, list_id, list_distance(v, c) AS d FROM items, means) GROUP BY id)"""

_LIST_RANK = """
list_rank AS (SELECT query_id, list_id, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(qv, c), list_id) AS n
  FROM queries, means)"""


def _top(pairs: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, id))::INTEGER AS rank,
      id, distance FROM ({pairs})) WHERE rank <= {k}"""


def _knn(metric: str, k: int = 10, where: str = "true") -> str:
    return _top(f"SELECT query_id, id, {_DIST[metric]} AS distance FROM queries, items WHERE {where}", k)


_FILTERS = {
    "eq": "parity = 'even' AND label = 4",
    "in": "label IN (1, 3, 5)",
    "range": "weight >= 0.5 AND weight < 1.5",
    "or": "label = 0 OR (parity = 'odd' AND level <> 1)",
    "nested": "level = 2",
    "array": "(tag1 = 't1' OR tag2 = 't1') AND NOT label > 5",
    "all": "tag1 = 't0' AND tag2 = 'u6'",
    "nor": "NOT (label <= 3)",
    "nin": "label NOT IN (2, 7)",
}

_IVF_PAIRS = """SELECT q.query_id, i.id, list_distance(qv, v) AS distance FROM queries q
  JOIN list_rank r ON r.query_id = q.query_id JOIN assigned a ON a.list_id = r.list_id JOIN items i ON i.id = a.id
  WHERE r.n <= {n}"""


def _ivf(n: int) -> str:
    return f"WITH {_EMB}, {_MEANS}, {_ASSIGNED}, {_LIST_RANK}"


def _score(metric: str, expression: str) -> str:
    return f"WITH {_EMB}, hits AS ({_knn(metric)}) SELECT query_id, rank, id, round({expression}, 6) AS score FROM hits"


_PQ = f"""WITH {_EMB}, {_MEANS},
books AS (SELECT s AS sub, list_id AS code, list_slice(c, s * 8 + 1, s * 8 + 8) AS b FROM means, range(8) t(s)),
parts AS (SELECT id, s AS sub, list_slice(v, s * 8 + 1, s * 8 + 8) AS p FROM items, range(8) t(s)),
codes AS (SELECT id, sub, arg_min(code, (list_distance(p, b), code)) AS code FROM parts JOIN books USING (sub) GROUP BY id, sub),
code_rows AS (SELECT id, list(code ORDER BY sub) AS cs FROM codes GROUP BY id),
gaps AS (SELECT query_id, sub, code, list_distance(list_slice(qv, sub * 8 + 1, sub * 8 + 8), b) AS g FROM queries, books),
tables AS (SELECT query_id, sub, list(g * g ORDER BY code) AS t FROM gaps GROUP BY query_id, sub),
wide AS (SELECT query_id, list(t ORDER BY sub) AS t FROM tables GROUP BY query_id),
estimates AS (SELECT query_id, id, sqrt(t[1][cs[1]+1] + t[2][cs[2]+1] + t[3][cs[3]+1] + t[4][cs[4]+1]
  + t[5][cs[5]+1] + t[6][cs[6]+1] + t[7][cs[7]+1] + t[8][cs[8]+1]) AS distance FROM wide, code_rows)"""

# The embedding of documents and benchmark texts.
_TEXT = r"""
texts AS (SELECT doc_id::VARCHAR AS key, 'd' AS kind, text FROM documents
  UNION ALL SELECT item_id::VARCHAR, 'q', text FROM benchmark),
words AS (SELECT key, kind, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h
  FROM (SELECT key, kind, unnest(regexp_split_to_array(lower(text), '\s+')) AS w FROM texts)),
slots AS (SELECT key, kind, h % 64 AS pos, sum(CASE WHEN h // 64 % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS x FROM words GROUP BY ALL),
summed AS (SELECT key, kind, pos, coalesce(x, 0.0) AS x FROM (SELECT key, kind, j AS pos FROM texts, range(64) t(j)) LEFT JOIN slots USING (key, kind, pos)),
lengths AS (SELECT key, kind, sqrt(sum(x * x)) AS n FROM summed GROUP BY ALL),
text_cells AS (SELECT key, kind, pos, CASE WHEN n > 0 THEN round(x / n, 6) ELSE 0.0 END AS x FROM summed JOIN lengths USING (key, kind)),
vectors AS (SELECT key, kind, list(x ORDER BY pos) AS v FROM text_cells GROUP BY ALL),
text_pairs AS (SELECT q.key::BIGINT AS query_id, d.key AS id,
  CASE WHEN list_sum(list_transform(d.v, lambda x: abs(x))) = 0 OR list_sum(list_transform(q.v, lambda x: abs(x))) = 0 THEN 1.0
    ELSE list_cosine_distance(q.v, d.v) END AS distance, lang
  FROM vectors q, vectors d JOIN documents ON doc_id = d.key::BIGINT WHERE q.kind = 'q' AND d.kind = 'd')"""

# The same with the places of words, their presence and noise seeded by the text.
_ORDERED_TEXT = r"""
texts AS (SELECT doc_id::VARCHAR AS key, 'd' AS kind, text FROM documents
  UNION ALL SELECT item_id::VARCHAR, 'q', text FROM benchmark),
words AS (SELECT key, kind, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i
  FROM (SELECT key, kind, regexp_split_to_array(lower(text), '\s+') AS w FROM texts)),
slots AS (SELECT key, kind, ((('0x' || substr(md5(w), 1, 8))::BIGINT) * 7) % 64 AS s, count(*) AS tf, sum(0.5 / (i + 1)) AS p
  FROM words GROUP BY ALL),
spread AS (SELECT key, kind, s AS pos, tf::DOUBLE AS x FROM slots
  UNION ALL SELECT key, kind, s + 1, p FROM slots WHERE s + 1 < 64
  UNION ALL SELECT key, kind, s + 2, 0.3 * tf FROM slots WHERE s + 2 < 64),
lcg AS (WITH RECURSIVE r(j, a, c) AS (SELECT 0, 9301::BIGINT, 49297::BIGINT
  UNION ALL SELECT j + 1, (a * 9301) % 233280, (c * 9301 + 49297) % 233280 FROM r WHERE j < 63) SELECT * FROM r),
noise AS (SELECT key, kind, j AS pos, (((a * (('0x' || substr(md5(text), 1, 8))::BIGINT % 233280) + c) % 233280)
  / 233280.0::DOUBLE - 0.5) * 0.2 AS x FROM texts, lcg),
summed AS (SELECT key, kind, pos, sum(x) AS x FROM (SELECT * FROM spread UNION ALL SELECT * FROM noise) GROUP BY ALL),
lengths AS (SELECT key, kind, sqrt(sum(x * x)) AS n FROM summed GROUP BY ALL),
text_cells AS (SELECT key, kind, pos, round(x / n, 6) AS x FROM summed JOIN lengths USING (key, kind)),
vectors AS (SELECT key, kind, list(x ORDER BY pos) AS v FROM text_cells GROUP BY ALL),
text_pairs AS (SELECT q.key::BIGINT AS query_id, d.key AS id, list_cosine_distance(q.v, d.v) AS distance, lang
  FROM vectors q, vectors d JOIN documents ON doc_id = d.key::BIGINT WHERE q.kind = 'q' AND d.kind = 'd')"""

_BATCH = """
base AS (SELECT vec_id::VARCHAR AS id, label, embedding[1]::DOUBLE AS x0, embedding AS v FROM embeddings),
batch AS (SELECT id, label, 2 AS seq, -x0 AS x0 FROM base WHERE label % 2 = 0
  UNION ALL SELECT 'n' || id, label, 1, -x0 FROM base WHERE label % 2 = 1),
merged AS (SELECT * FROM batch UNION ALL SELECT id, label, 0, x0 FROM base WHERE id NOT IN (SELECT id FROM batch))"""

_FAULTS = """SELECT vec_id AS row, list_filter([
  CASE WHEN label = 0 THEN 'missing required ''id'' field' END,
  CASE WHEN label = 1 THEN '''id'' cannot be blank' END,
  CASE WHEN label = 2 THEN 'vector cannot be empty' END,
  CASE WHEN label = 4 AND len(list_filter(embedding, lambda x: x > 0)) > 0 THEN 'vector elements must be finite numbers' END,
  CASE WHEN label = 5 THEN 'missing required ''vector'' field' END,
  CASE WHEN label = 3 THEN 'vector dimension must be 64' END,
  CASE WHEN label = 6 THEN 'metadata must be an object or null' END], lambda m: m IS NOT NULL) AS e FROM embeddings"""

_ROUND_HITS = "SELECT query_id, rank, id, round(distance, 6) AS distance FROM hits"


def _filter_counts() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS filter_name, count(*) FILTER (WHERE {where}) AS n_match, count(*) AS n_total FROM items"
        for name, where in _FILTERS.items())
    return f"WITH {_EMB} {rows}"


def _recall_filtered() -> str:
    rows = []
    for name in ("eq", "in", "range", "nested"):
        where = _FILTERS[name]
        exact = _knn("euclidean", 10, where)
        found = _top(_IVF_PAIRS.format(n=3) + f" AND ({where})", 10)
        rows.append(f"""SELECT '{name}' AS filter_name, round(avg(CASE WHEN f = 0 AND e = 0 THEN 1.0 WHEN e = 0 THEN 0.0
          ELSE common / least(e, 100) END), 6) AS recall, round(avg(f), 6) AS mean_returned, round(avg(e), 6) AS mean_expected
          FROM (SELECT q.query_id, (SELECT count(*) FROM ({found}) x WHERE x.query_id = q.query_id) AS f,
            (SELECT count(*) FROM ({exact}) x WHERE x.query_id = q.query_id) AS e,
            (SELECT count(*) FROM ({found}) x JOIN ({exact}) y USING (query_id, id) WHERE x.query_id = q.query_id) AS common
            FROM queries q)""")
    return _ivf(3) + " " + " UNION ALL ".join(rows)


_RECALL = f"""{_ivf(3)}, exact AS ({_knn("euclidean")}), found AS ({_top(_IVF_PAIRS.format(n=3), 10)}),
per_query AS (SELECT e.query_id, count(f.id) / count(*) AS recall FROM exact e
  LEFT JOIN found f ON f.query_id = e.query_id AND f.id = e.id GROUP BY e.query_id)"""

_MMR = f"""WITH {_EMB}, hits AS ({_knn("cosine", 6)}),
cand AS (SELECT query_id, rank, h.id, greatest(0.0, 1 - distance / 2) AS score, v FROM hits h JOIN items USING (id)),
one AS (SELECT * FROM cand WHERE rank = 1),
two AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.query_id ORDER BY
    0.5 * c.score - 0.5 * greatest(0.0, list_cosine_similarity(c.v, o.v)) DESC, c.rank) AS n
  FROM cand c JOIN one o USING (query_id) WHERE c.rank <> o.rank) WHERE n = 1),
three AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.query_id ORDER BY
    0.5 * c.score - 0.5 * greatest(0.0, list_cosine_similarity(c.v, o.v), list_cosine_similarity(c.v, t.v)) DESC, c.rank) AS n
  FROM cand c JOIN one o USING (query_id) JOIN two t USING (query_id) WHERE c.rank NOT IN (o.rank, t.rank)) WHERE n = 1)
SELECT query_id, 1 AS mmr_rank, id, round(score, 6) AS score FROM one
UNION ALL SELECT query_id, 2, id, round(score, 6) FROM two UNION ALL SELECT query_id, 3, id, round(score, 6) FROM three"""


def statements() -> dict[str, str]:
    out = {
        "knn_euclidean": f"WITH {_EMB}, hits AS ({_knn('euclidean')}) {_ROUND_HITS}",
        "knn_sqeuclidean": f"WITH {_EMB}, hits AS ({_knn('squared_euclidean')}) {_ROUND_HITS}",
        "knn_cosine": f"WITH {_EMB}, hits AS ({_knn('cosine')}) {_ROUND_HITS}",
        "knn_nested": f"""WITH {_EMB}, hits AS ({_knn('cosine')})
            SELECT query_id, count(*)::INTEGER AS n_hits, string_agg(id, ',' ORDER BY rank) AS hit_ids FROM hits GROUP BY query_id""",
        "knn_payload": f"""WITH {_EMB}, hits AS ({_knn('euclidean', 3)})
            SELECT query_id, rank, id, 'o' || level AS owner, round(v[1], 6) AS x0, len(v)::INTEGER AS dim FROM hits JOIN items USING (id)""",
        "score_cosine": _score("cosine", "greatest(0.0, 1 - distance / 2)"),
        "score_euclidean": _score("euclidean", "exp(-distance)"),
        "score_sqeuclidean": _score("squared_euclidean", "exp(-sqrt(distance))"),
        "score_other": _score("euclidean", "1 / (1 + distance)"),
        "ivf_probe_search": f"{_ivf(3)}, hits AS ({_top(_IVF_PAIRS.format(n=3), 10)}) {_ROUND_HITS}",
        "ivf_full_probe": f"WITH {_EMB}, hits AS ({_knn('euclidean')}) {_ROUND_HITS}",
        "pq_search": f"{_PQ}, hits AS ({_top('FROM estimates', 10)}) {_ROUND_HITS}",
        "pq_search_rerank": f"""{_PQ}, best AS ({_top('FROM estimates', 20)}), hits AS ({_top(
            'SELECT b.query_id, b.id, list_distance(qv, v) AS distance FROM best b JOIN queries q ON q.query_id = b.query_id '
            'JOIN items i ON i.id = b.id', 10)}) {_ROUND_HITS}""",
        "filter_events_json": """SELECT event_id, event_type, (props ->> 'k')::BIGINT AS k FROM events
            WHERE ((props ->> 'k')::BIGINT < 10 OR (props ->> 'k')::BIGINT IN (69, 89)) AND (props ->> 'k')::BIGINT NOT IN (3, 5)""",
        "filter_candidate_counts": _filter_counts(),
        "get_by_ids": """SELECT event_id AS pos, event_id::VARCHAR AS id, label, round(embedding[1]::DOUBLE, 6) AS x0
            FROM events JOIN embeddings ON vec_id = event_id""",
        "delete_by_ids": """SELECT vec_id::VARCHAR AS id, label FROM embeddings
            WHERE vec_id NOT IN (SELECT conv_id FROM conversations)""",
        "upsert_merge": f"WITH {_BATCH} SELECT id, label, seq, round(x0, 6) AS x0 FROM merged",
        "latest_per_id": """SELECT user_id::VARCHAR AS id, event_id, event_type FROM (SELECT *, row_number() OVER
            (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
        "list_ids": "SELECT vec_id::VARCHAR AS id FROM embeddings ORDER BY id",
        "num_vectors": "SELECT count(*) AS num_vectors FROM embeddings",
        "id_difference": """SELECT doc_id::VARCHAR AS id FROM documents EXCEPT ALL SELECT doc_id::VARCHAR FROM labels""",
        "id_intersection": """SELECT doc_id::VARCHAR AS id FROM documents INTERSECT SELECT vec_id::VARCHAR FROM embeddings""",
        "validate_items": f"SELECT row, len(e)::INTEGER AS n_errors, array_to_string(e, '; ') AS errors FROM ({_FAULTS})",
        "validate_split": f"SELECT row, CASE WHEN len(e) = 0 THEN 'good' ELSE 'bad' END AS side FROM ({_FAULTS})",
        "l2_normalize": """WITH v AS (SELECT vec_id::VARCHAR AS id, list_transform(embedding::DOUBLE[], lambda x: x * label) AS v
              FROM embeddings), n AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM v)
            SELECT id, (generate_subscripts(v, 1) - 1)::INTEGER AS pos,
              round(unnest(list_transform(v, lambda x: CASE WHEN n > 0 THEN x / n ELSE x END)), 6) AS x FROM n""",
        "similarity_to_label": f"""WITH {_EMB}, {_MEANS} SELECT id, round(list_cosine_similarity(v, c), 6) AS cos_sim,
              round(list_cosine_distance(v, c), 6) AS cos_dist, round(list_distance(v, c), 6) AS euclid,
              round(list_distance(v, c) * list_distance(v, c), 6) AS sq_euclid FROM items JOIN means ON list_id = label""",
        "centroid_update": f"WITH {_MEANS} SELECT list_id, pos, x FROM mean_cells",
        "ivf_assign": f"WITH {_EMB}, {_MEANS}, {_ASSIGNED} SELECT id, list_id FROM assigned",
        "list_sizes": f"WITH {_EMB}, {_MEANS}, {_ASSIGNED} SELECT list_id, count(*) AS n FROM assigned GROUP BY list_id",
        "ivf_probe_lists": f"WITH {_EMB}, {_MEANS}, {_LIST_RANK} SELECT query_id, (n - 1)::INTEGER AS pos, list_id FROM list_rank WHERE n <= 3",
        "greedy_search": f"""WITH {_EMB}, {_MEANS}, {_ASSIGNED}, {_LIST_RANK},
            sizes AS (SELECT list_id, count(*) AS s FROM assigned GROUP BY list_id),
            filled AS (SELECT query_id, r.list_id, sum(coalesce(s, 0)) OVER (PARTITION BY query_id ORDER BY n) - coalesce(s, 0) AS before
              FROM list_rank r LEFT JOIN sizes z ON z.list_id = r.list_id),
            hits AS ({_top('''SELECT q.query_id, i.id, list_distance(qv, v) AS distance FROM queries q
              JOIN filled f ON f.query_id = q.query_id JOIN assigned a ON a.list_id = f.list_id JOIN items i ON i.id = a.id
              WHERE before < 60''', 10)}) {_ROUND_HITS}""",
        "kmeans_train": """SELECT count(*) AS n_rows, round(sqrt(count(*)))::BIGINT AS n_lists, true AS converged FROM embeddings""",
        "auto_probe_calibration": f"""WITH {_EMB}, {_MEANS}, {_ASSIGNED}, {_LIST_RANK}, hits AS ({_knn('euclidean', 21)}),
            near AS (SELECT r.n AS n_probes FROM hits h JOIN assigned a ON a.id = h.id
              JOIN list_rank r ON r.query_id = h.query_id AND r.list_id = a.list_id WHERE h.id <> h.query_id::VARCHAR),
            per_count AS (SELECT n_probes, count(*) AS found FROM near GROUP BY n_probes)
            SELECT n_probes::INTEGER AS n_probes, round((sum(found) OVER (ORDER BY n_probes))::DOUBLE
              / (sum(found) OVER ())::DOUBLE, 6) AS recall FROM per_count""",
        "pq_train": """SELECT s::INTEGER AS sub, count(*) AS n_rows, least(16, count(DISTINCT list_slice(embedding, s * 8 + 1, s * 8 + 8))) AS n_codes
            FROM embeddings, range(8) t(s) GROUP BY s""",
        "text_embed_function": """SELECT doc_id::VARCHAR AS id, length(text)::DOUBLE AS x0,
            (length(text) - length(replace(text, 'e', '')))::DOUBLE AS x1,
            (length(text) - length(replace(text, ' ', '')))::DOUBLE AS x2 FROM documents""",
        "pq_encode": f"{_PQ} SELECT id, sub::INTEGER AS sub, code::SMALLINT AS code FROM codes",
        "recall_at_k": f"{_RECALL} SELECT query_id, round(recall, 6) AS recall FROM per_query",
        "mean_recall": f"{_RECALL} SELECT round(avg(recall), 6) AS recall FROM per_query",
        "recall_filtered": _recall_filtered(),
        "text_embed": f"WITH {_ORDERED_TEXT} SELECT key AS id, pos::INTEGER AS pos, x FROM text_cells WHERE kind = 'd'",
        "text_search": f"""WITH {_ORDERED_TEXT}, hits AS ({_top('FROM text_pairs', 4)}) SELECT query_id, rank, id,
            round(distance, 6) AS distance, lang FROM hits JOIN documents ON doc_id = id::BIGINT""",
        "text_search_score": f"""WITH {_ORDERED_TEXT}, hits AS ({_top("FROM text_pairs WHERE lang IN ('en', 'fr')", 4)})
            SELECT query_id, rank, id, round(greatest(0.0, 1 - distance / 2), 6) AS score FROM hits""",
        "mmr_search": _MMR,
        "pack_unpack_documents": """SELECT doc_id::VARCHAR AS id, text AS page_content, lang, n_chars, true AS text_key_gone
            FROM documents""",
        "contents_base64": "SELECT doc_id::VARCHAR AS id, base64(encode(text)) AS encoded, true AS same FROM documents",
        "seal_roundtrip": "SELECT doc_id::VARCHAR AS id, text AS page_content, true AS hidden FROM documents",
        "items_json_roundtrip": "SELECT doc_id::VARCHAR AS id, text AS contents, doc_id::DOUBLE AS x0, source FROM documents",
        "ingest_arrays": """SELECT vec_id::VARCHAR AS id, round(embedding[1]::DOUBLE, 6) AS x0, true AS no_contents FROM embeddings""",
        "collection_describe": """SELECT 'vectors' AS index_name, 'ivfflat' AS index_type, false AS is_trained,
            any_value(len(embedding))::INTEGER AS dimension, 'euclidean' AS metric, count(*)::INTEGER AS num_vectors FROM embeddings""",
        "collection_changes": f"""WITH {_BATCH} SELECT id, round(x0, 6) AS x0, 64 AS dim FROM merged
            WHERE id NOT IN (SELECT conv_id::VARCHAR FROM conversations)""",
        "collection_query_untrained": f"""WITH {_EMB}, hits AS ({_knn('euclidean', 10, _FILTERS['in'])})
            SELECT query_id, rank, id, round(distance, 6) AS distance, label FROM hits JOIN items USING (id)""",
        "collection_query_trained": f"WITH {_EMB}, hits AS ({_knn('euclidean')}) {_ROUND_HITS}",
        "collection_recall_gates": "SELECT count(*) > 0 AS auto_probes_reach_gate FROM embeddings",
        "collection_query_contents": f"""WITH {_TEXT}, hits AS ({_top("FROM text_pairs WHERE lang = 'en'", 4)})
            SELECT query_id, rank, id, length(text)::INTEGER AS n_text, round(greatest(0.0, 1 - distance / 2), 6) AS score
            FROM hits JOIN documents ON doc_id = id::BIGINT""",
        "stream_upsert": "SELECT vec_id::VARCHAR AS id, round(embedding[1]::DOUBLE, 6) AS x0 FROM embeddings",
        "stream_query": f"WITH {_EMB}, hits AS ({_knn('euclidean')}) {_ROUND_HITS}",
    }
    for name, where in _FILTERS.items():
        out[f"knn_filtered_{name}"] = f"WITH {_EMB}, hits AS ({_knn('euclidean', 10, where)}) {_ROUND_HITS}"
    return out
