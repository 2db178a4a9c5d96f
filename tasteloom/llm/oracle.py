"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in _RULES)



def _clusters(rounds: int, k: int, dims: int) -> str:
    """Lloyd rounds over whole-number vectors, one pair of steps per round."""
    steps = [f"""
        fine AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
            WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, q) - 1 AS cluster, q AS c FROM fine
            QUALIFY cluster < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, vec_id, q, arg_min(cluster, d * {k} + cluster) AS cluster, min(d) AS distance FROM (
                SELECT r, vec_id, q, cluster, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(q, c)])::BIGINT AS d
                FROM fine, c{n}) GROUP BY r, vec_id, q)""")
        if n < rounds:
            steps.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT cluster, coalesce(m, c) AS c FROM c{n} LEFT JOIN (
                SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
                    SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
                        SELECT cluster, unnest(q) AS x, unnest(range(len(q))) AS i FROM a{n}) GROUP BY cluster, i) GROUP BY cluster)
                USING (cluster))""")
    return "WITH" + ",".join(steps) + f"""
        SELECT vec_id, a.cluster::INT AS cluster, distance,
            (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
            sha256(array_to_string([x::VARCHAR FOR x IN c], ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""


SQL: dict[str, str] = {
    "op5_url_cascade": f"""
        WITH cut AS (
            SELECT row_number() OVER () AS r, page_id,
                translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        rules(v, h, p) AS (VALUES {_RULE_ROWS}),
        fit AS (
            SELECT r, h || p AS rule, v,
                row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC) AS best
            FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
        FROM cut LEFT JOIN (SELECT * FROM fit WHERE best = 1) USING (r)""",
    "op7_norm_topk": """
        WITH fine AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM fine a JOIN fine b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_hard_negatives": """
        WITH fine AS (
            SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS MATERIALIZED (
            SELECT a.r, a.vec_id AS anchor_id, b.vec_id, b.r AS other, a.label = b.label AS same,
                list_dot_product([x::DOUBLE FOR x IN a.q], [x::DOUBLE FOR x IN b.q])::BIGINT AS score
            FROM fine a JOIN fine b ON a.vec_id % 100 = 0 AND a.r <> b.r),
        positives AS (
            SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
                row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS nth
            FROM scored WHERE same),
        negatives AS (
            SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY p.r, nth ORDER BY score DESC, vec_id, other)::INT AS rank
            FROM positives p JOIN scored n ON n.r = p.r AND nth <= 5 AND NOT same
                AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM negatives WHERE rank <= 10""",
    "op12_simplex_clusters": _clusters(rounds=3, k=16, dims=64),
    "op13_source_mix": """
        WITH words AS (
            SELECT doc_id, source, md5('mix:' || doc_id) AS h,
                coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        sizes AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM words GROUP BY source),
        filled AS (
            SELECT *, row_number() OVER (ORDER BY source_size * (10 // weight), source NULLS LAST) AS nth,
                3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER ahead, 0) AS rest_words,
                2 * (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS rest_weight
            FROM sizes
            WINDOW ahead AS (ORDER BY source_size * (10 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
            SELECT rest_words AS w, rest_weight AS v FROM filled
            WHERE rest_words * weight <= 2 * source_size * rest_weight ORDER BY nth LIMIT 1),
        targets AS (
            SELECT source, source_size, CASE WHEN w * weight > 2 * source_size * v THEN (2 * source_size)::DOUBLE
                ELSE (w * weight)::DOUBLE / v::DOUBLE END AS target
            FROM filled, level),
        placed AS (
            SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
                sum(size) OVER (PARTITION BY words.source ORDER BY h NULLS LAST, doc_id, size
                    ROWS UNBOUNDED PRECEDING)::BIGINT - size AS ahead
            FROM words JOIN targets ON words.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
            CASE WHEN source_size = 0 THEN 0
                ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - ahead)) END::BIGINT AS taken
        FROM placed""",
}
