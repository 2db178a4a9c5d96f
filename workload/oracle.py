"""The queries again, as SQL for DuckDB on the same tables."""

from __future__ import annotations

REVIEWS = """
reviews AS (
  SELECT l_orderkey AS "Id", CAST(o_custkey AS VARCHAR) AS "UserId", CAST(l_partkey AS VARCHAR) AS "ProductId",
         CAST(ceil(l_quantity / 10) AS FLOAT) AS "Score", CAST(epoch(o_orderdate) AS BIGINT) AS "Time"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PAIRS = REVIEWS + """,
pairs AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "UserId", "ProductId"
                                 ORDER BY "Time" DESC, "Score" DESC, "Id" DESC) AS rn FROM reviews)
  WHERE rn = 1)"""

DIRTY = REVIEWS + """,
dirty AS (
  SELECT "Id", CASE WHEN "Id" % 23 <> 0 THEN "UserId" END AS "UserId", "ProductId",
         CASE WHEN "Id" % 17 <> 0 AND "Id" % 19 <> 0 THEN "Score" END AS "Score",
         CASE WHEN "Id" % 29 <> 0 THEN "Time" END AS "Time"
  FROM reviews)"""

FEED = REVIEWS + """,
feed AS (
  SELECT CASE "Id" % 50 WHEN 4 THEN CAST("Id" AS VARCHAR) WHEN 5 THEN 'b' || "Id" WHEN 6 THEN 'd' || "Id"
                        ELSE "UserId" END AS "UserId",
         CASE WHEN "Id" % 50 > 6 THEN "ProductId" END AS "ProductId",
         CASE WHEN "Id" % 50 = 5 THEN CAST(4 AS FLOAT) WHEN "Id" % 50 > 6 THEN "Score" END AS "Score",
         CASE WHEN "Id" % 50 > 6 THEN "Time" END AS "Time"
  FROM reviews WHERE "Id" % 50 > 3)"""

BEST = PAIRS + """,
keen AS (SELECT "UserId" FROM reviews GROUP BY 1 HAVING count(*) >= 40),
best AS (
  SELECT * FROM (
    SELECT "UserId", "ProductId", CAST("Score" AS DOUBLE) AS score,
           row_number() OVER (PARTITION BY "UserId" ORDER BY "Score" DESC, CAST("ProductId" AS BIGINT)) AS rank
    FROM pairs)
  WHERE rank <= 5),
stored AS (SELECT * FROM best WHERE "UserId" IN (SELECT "UserId" FROM keen)),
popular AS (
  SELECT string_agg("ProductId", '|' ORDER BY n DESC, "ProductId") AS items FROM (
    SELECT "ProductId", count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, "ProductId" LIMIT 5))"""

RUNS = """
runs AS (
  SELECT p_brand AS name, p_partkey + 1 AS version,
         ['None', 'Staging', 'Production', 'Archived'][p_size % 4 + 1] AS stage,
         CAST(10 * (1 + p_partkey % 2) AS INTEGER) AS rank, CAST(0.05 AS DOUBLE) * (1 + p_partkey % 2) AS "regParam",
         p_retailprice / 1000 AS rmse, p_type AS path
  FROM part)"""


def _index(source: str, column: str) -> str:
    return f"""SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS idx, n FROM (
      SELECT "{column}" AS label, count(*) AS n FROM {source} GROUP BY 1)"""


def _filtered(users: int, items: int) -> str:
    return PAIRS + f""",
u AS (SELECT "UserId", "ProductId", "Score" FROM pairs WHERE "UserId" IN (
  SELECT "UserId" FROM pairs GROUP BY 1 HAVING count(*) >= {users})),
kept AS (SELECT * FROM u WHERE "ProductId" IN (SELECT "ProductId" FROM u GROUP BY 1 HAVING count(*) >= {items}))"""


def _train_frame(users: int, items: int) -> str:
    return f"""WITH {_filtered(users, items)},
ui AS ({_index('kept', 'UserId')}), ii AS ({_index('kept', 'ProductId')})
SELECT "UserId", "ProductId", "Score", CAST(ui.idx AS DOUBLE) AS user_index, CAST(ii.idx AS DOUBLE) AS item_index
FROM kept JOIN ui ON ui.label = "UserId" JOIN ii ON ii.label = "ProductId" """


def _sides(predicate: str, yes: str, no: str) -> str:
    return f"""WITH {REVIEWS} SELECT *, CASE WHEN {predicate} THEN '{yes}' ELSE '{no}' END AS side FROM reviews"""


def _dot(sign: int) -> str:
    return f"""SELECT user_index, CAST(rank AS INTEGER) AS rank, item_index, score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_index ORDER BY score DESC, item_index) AS rank FROM (
    SELECT u.vec_id AS user_index, i.vec_id AS item_index,
           round({sign} * list_inner_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS score
    FROM embeddings u, embeddings i))
WHERE rank <= 5"""


def _rate(seconds: int, step: int) -> str:
    return f"""SELECT make_timestamp(first * {step} * 1000000) AS window_start, event_type, n,
       round(n / {float(seconds)}, 9) AS per_second
FROM (
  SELECT first, event_type, count(*) AS n
  FROM (SELECT event_type, CAST(floor(floor(epoch(ts)) / {step}) AS BIGINT) AS slot FROM events),
       LATERAL (SELECT unnest(range(slot - {seconds // step - 1}, slot + 1)) AS first)
  GROUP BY 1, 2)"""


SQL: dict[str, str] = {
    "ratings_from_orders": f"WITH {REVIEWS} SELECT * FROM reviews",
    "csv_roundtrip": "SELECT * FROM part",
    "csv_roundtrip_text": "SELECT * FROM documents",
    "replay_messages": f"""WITH {DIRTY}
        SELECT "UserId", "ProductId",
               CASE WHEN "Id" % 19 = 0 THEN CAST('NaN' AS FLOAT) ELSE "Score" END AS "Score", "Time"
        FROM dirty WHERE "Id" % 10 >= 6 AND "UserId" IS NOT NULL AND "Time" IS NOT NULL""",
    "parse_messages": f"WITH {FEED} SELECT * FROM feed",
    "stream_parse": f"WITH {FEED} SELECT * FROM feed",
    "clean_nulls": f"""WITH {DIRTY} SELECT "UserId", "ProductId", "Score" FROM dirty
        WHERE "UserId" IS NOT NULL AND "ProductId" IS NOT NULL AND "Score" IS NOT NULL""",
    "dedup_latest": f"WITH {PAIRS} SELECT * FROM pairs",
    "dedup_pairs": f"""WITH {REVIEWS}
        SELECT "UserId", "ProductId", arg_max("Score", ("Time", "Score", "Id")) AS "Score" FROM reviews GROUP BY 1, 2""",
    "user_activity": f"""WITH {REVIEWS} SELECT "UserId", count(*) AS n FROM reviews GROUP BY 1""",
    "item_activity": f"""WITH {REVIEWS} SELECT "ProductId", count(*) AS n FROM reviews GROUP BY 1""",
    "distinct_users": f"""WITH {REVIEWS} SELECT DISTINCT "UserId" FROM reviews""",
    "active_users": f"""WITH {PAIRS} SELECT * FROM pairs WHERE "UserId" IN (
        SELECT "UserId" FROM pairs GROUP BY 1 HAVING count(*) >= 3)""",
    "filter_5_5": f"WITH {_filtered(5, 5)} SELECT * FROM kept",
    "filter_40_20": f"WITH {_filtered(40, 20)} SELECT * FROM kept",
    "popular_products": f"""WITH {REVIEWS} SELECT "ProductId", count(*) AS n FROM reviews GROUP BY 1
        ORDER BY n DESC, "ProductId" LIMIT 5""",
    "label_index_users": f"WITH {REVIEWS} {_index('reviews', 'UserId')}",
    "label_index_items": f"WITH {REVIEWS} {_index('reviews', 'ProductId')}",
    "index_unseen_keep": f"""WITH {REVIEWS}, early AS (SELECT * FROM reviews WHERE "Id" % 10 < 6),
        ui AS ({_index('early', 'UserId')})
        SELECT reviews.*, CAST(coalesce(idx, (SELECT count(*) FROM ui)) AS DOUBLE) AS user_index
        FROM reviews LEFT JOIN ui ON label = "UserId" """,
    "known_users": f"""WITH {REVIEWS}, early AS (SELECT * FROM reviews WHERE "Id" % 10 < 6),
        ui AS ({_index('early', 'UserId')})
        SELECT label AS "UserId", CAST(idx AS DOUBLE) AS user_index FROM ui
        WHERE label IN (SELECT "UserId" FROM early WHERE ("Id" * 31 + CAST("ProductId" AS BIGINT)) % 100 < 80)""",
    "holdout_split": _sides("""("Id" * 31 + CAST("ProductId" AS BIGINT)) % 100 < 80""", "train", "test"),
    "replay_split": _sides('"Id" % 10 >= 6', "replay", "train"),
    "preprocess_frame": f"""WITH {PAIRS},
        kept AS (SELECT * FROM pairs WHERE "UserId" IN (SELECT "UserId" FROM pairs GROUP BY 1 HAVING count(*) >= 3)),
        ui AS ({_index('kept', 'UserId')}), ii AS ({_index('kept', 'ProductId')})
        SELECT "Id", "ProductId", "UserId", CAST("Score" AS DOUBLE) AS "Score",
               CAST(ui.idx AS DOUBLE) AS user_index, CAST(ii.idx AS DOUBLE) AS item_index
        FROM kept JOIN ui ON ui.label = "UserId" JOIN ii ON ii.label = "ProductId" """,
    "train_frame": _train_frame(5, 5),
    "train_frame_40_20": _train_frame(40, 20),
    "rmse_eval": f"""WITH {REVIEWS},
        means AS (SELECT "UserId", avg(CAST("Score" AS DOUBLE)) AS p FROM reviews WHERE "Id" % 10 < 6 GROUP BY 1)
        SELECT round(sqrt(avg(pow("Score" - p, 2))), 6) AS rmse, count(p) AS n_scored, count(*) AS n_total,
               round(count(p) / count(*), 6) AS coverage
        FROM reviews LEFT JOIN means USING ("UserId") WHERE "Id" % 10 >= 6""",
    "topn_factor_dot": _dot(1),
    "recs_label_lookup": f"""WITH {PAIRS}, ii AS ({_index('pairs', 'ProductId')}),
        sold AS (SELECT * FROM pairs WHERE "ProductId" IN (
          SELECT "ProductId" FROM pairs GROUP BY 1 HAVING count(*) >= 30)),
        names AS ({_index('sold', 'ProductId')}),
        ranked AS (SELECT * FROM (
          SELECT "UserId", idx, CAST("Score" AS DOUBLE) AS score,
                 row_number() OVER (PARTITION BY "UserId" ORDER BY "Score" DESC, idx) AS rank
          FROM pairs JOIN ii ON label = "ProductId") WHERE rank <= 5)
        SELECT "UserId", CAST(row_number() OVER (PARTITION BY "UserId" ORDER BY rank) - 1 AS INTEGER) AS pos,
               label AS "ProductId", round(score, 6) AS score
        FROM ranked JOIN names USING (idx)""",
    "recs_json": f"""WITH {BEST} SELECT "UserId", CAST(rank - 1 AS INTEGER) AS pos, "ProductId", score FROM best""",
    "recs_format": """SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN 'B' || user_id || '|' || event_id || '|raw' WHEN 3 THEN 'None|7'
             WHEN 4 THEN '{"other":' || user_id || '}' ELSE '' END AS items,
        CASE event_id % 5 WHEN 0 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS n_items
        FROM events""",
    "upsert_latest": """WITH lists AS (
          SELECT event_id % (user_id % 4 + 1) AS batch, CAST(user_id AS VARCHAR) AS "UserId",
                 max(event_type) AS "ProductId", max(value) AS score FROM events GROUP BY 1, 2)
        SELECT "UserId", 0 AS pos, arg_max("ProductId", batch) AS "ProductId",
               round(arg_max(score, batch), 6) AS score
        FROM lists GROUP BY 1""",
    "serve_point_lookup": f"""WITH {BEST} SELECT "UserId", CAST(rank - 1 AS INTEGER) AS pos, "ProductId", score FROM best
        WHERE "UserId" = '7'""",
    "serve_lookup_fallback": f"""WITH {BEST}, lists AS (
          SELECT "UserId", string_agg("ProductId", '|' ORDER BY rank) AS items FROM stored GROUP BY 1)
        SELECT event_id, CAST(user_id AS VARCHAR) AS "UserId", coalesce(lists.items, popular.items) AS items
        FROM events CROSS JOIN popular LEFT JOIN lists ON "UserId" = CAST(user_id AS VARCHAR)""",
    "serve_lookup_text": f"""WITH {BEST}, lists AS (
          SELECT "UserId", CASE WHEN CAST("UserId" AS BIGINT) % 7 = 3 THEN ''
                 ELSE string_agg("ProductId", '|' ORDER BY rank) END AS items
          FROM best WHERE CAST("UserId" AS BIGINT) % 5 <> 1 GROUP BY 1)
        SELECT event_id, CAST(user_id AS VARCHAR) AS "UserId", coalesce(lists.items, popular.items) AS items
        FROM events CROSS JOIN popular LEFT JOIN lists ON "UserId" = CAST(user_id AS VARCHAR)""",
    "serve_empty_table": f"""WITH {BEST} SELECT CAST(c_custkey AS VARCHAR) AS "UserId", items
        FROM customer CROSS JOIN popular""",
    "recs_count": f"""WITH {BEST} SELECT count(DISTINCT "UserId") AS total_recommendations FROM best""",
    "registry_latest": f"""WITH {RUNS} SELECT name, version, stage, rank, round("regParam", 6) AS "regParam", path
        FROM runs WHERE stage <> 'Archived' QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
    "registry_versions": f"WITH {RUNS} SELECT name, stage, max(version) AS version FROM runs GROUP BY 1, 2",
    "registry_metrics": f"""WITH {RUNS}, newest AS (
          SELECT * FROM runs WHERE name = 'Brand#12' AND stage = 'None' ORDER BY version DESC LIMIT 1)
        SELECT round(max(rmse), 6) AS rmse, CAST(max(rank) AS DOUBLE) AS rank, round(max("regParam"), 6) AS "regParam",
               CASE WHEN count(*) = 0 THEN 'no version found' END AS error
        FROM newest""",
    "rate_by_handler": _rate(3600, 3600),
    "rate_by_handler_5m": _rate(300, 60),
    "p99_exact": "SELECT event_type, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1",
    "p99_histogram": """WITH edges AS (
          SELECT unnest([1, 2, 5, 10, 25, 50, 100, 250, 500, 'Infinity'::DOUBLE]) AS le,
                 unnest([0, 1, 2, 5, 10, 25, 50, 100, 250, 500]) AS low),
        counted AS (
          SELECT event_type, le, low, count(*) FILTER (value <= le) AS upto, count(*) FILTER (value <= low) AS before,
                 count(*) * 0.99 AS target
          FROM events, edges GROUP BY 1, 2, 3)
        SELECT event_type, round(CASE WHEN isinf(le) THEN 500
                 ELSE low + (le - low) * (target - before) / (upto - before) END, 6) AS p99
        FROM counted WHERE upto >= target
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY le) = 1""",
    "gauge_sum_by_group": """WITH newest AS (
          SELECT event_type, user_id, arg_max(value, (ts, event_id)) AS value FROM events
          WHERE regexp_full_match(event_type, 'c.*|pur.*|view') GROUP BY 1, 2)
        SELECT event_type, round(sum(value), 6) AS total FROM newest GROUP BY 1""",
    "stream_rate_by_handler": """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events
        GROUP BY 1, 2
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "stream_recommend": f"""SELECT CAST(user_index AS VARCHAR) AS "UserId", CAST(rank - 1 AS INTEGER) AS pos,
               'item-' || item_index AS "ProductId", score
        FROM ({_dot(1)}) WHERE user_index IN (SELECT user_id * 5 FROM events)""",
    "stream_model_swap": f"""WITH again AS (SELECT DISTINCT user_id * 5 AS u FROM events WHERE CAST(value AS FLOAT) > 100)
        SELECT CAST(user_index AS VARCHAR) AS "UserId", CAST(rank - 1 AS INTEGER) AS pos, 'item-' || item_index AS "ProductId", score
        FROM (SELECT * FROM ({_dot(1)}) WHERE user_index NOT IN (SELECT u FROM again)
              UNION ALL SELECT * FROM ({_dot(-1)}) WHERE user_index IN (SELECT u FROM again))
        WHERE user_index IN (SELECT user_id * 5 FROM events)""",
}
SQL["upsert_compacted"] = SQL["upsert_latest"]
SQL["serve_snapshot_lookup"] = SQL["serve_point_lookup"]
SQL["als_predict"] = f"""WITH {REVIEWS},
    pairs AS (SELECT DISTINCT CAST("UserId" AS BIGINT) AS u, CAST("ProductId" AS BIGINT) AS i FROM reviews),
    train AS (SELECT * FROM pairs WHERE (u * 31 + i) % 100 < 60),
    test AS (SELECT u IN (SELECT u FROM train) AND i IN (SELECT i FROM train) AS known
             FROM pairs WHERE (u * 31 + i) % 100 >= 60)
    SELECT count_if(known) AS n_scored, count(*) AS n_total, round(count_if(known) / count(*), 6) AS coverage,
           true AS beats_mean FROM test"""
_KNOWN = f"""{_filtered(5, 5)},
    known AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS "UserId" FROM events
              WHERE CAST(user_id AS VARCHAR) IN (SELECT "UserId" FROM kept))"""
SQL["recommend_als"] = f"""WITH {_KNOWN} SELECT "UserId", 5 AS n_items, true AS in_order, true AS distinct_items,
    true AS as_built_in FROM known"""
SQL["als_save_load"] = f"""WITH {_KNOWN} SELECT "UserId", true AS same_list FROM known"""
SQL["tune_als"] = f"""WITH frame AS ({_train_frame(5, 5)}),
    sizes AS (SELECT count_if((user_index * 31 + item_index) % 100 < 80) AS n_train,
                     count_if((user_index * 31 + item_index) % 100 >= 80) AS n_test FROM frame)
    SELECT CAST(rank AS INTEGER) AS rank, CAST(reg AS DOUBLE) AS "regParam", n_train, n_test, true AS finite,
           true AS best_is_least
    FROM (VALUES (10), (20)) AS r(rank) CROSS JOIN (VALUES (0.1), (0.05)) AS g(reg) CROSS JOIN sizes"""
SQL["register_model"] = """SELECT 'recommender' AS name, CAST(version AS BIGINT) AS version, 'None' AS stage,
    CAST(4 AS INTEGER) AS rank, CAST(0.1 AS DOUBLE) AS "regParam", true AS measured FROM (VALUES (1), (2)) AS v(version)"""
SQL["rate_counter_resets"] = """WITH samples AS (
        SELECT event_type, user_id % 3 AS instance, epoch_us(ts) AS us, CAST(row_number() OVER (
            PARTITION BY event_type, user_id % 3, (epoch_us(ts) // 1000000 + user_id % 3 * 7200) // 86400 ORDER BY ts, event_id) AS DOUBLE) AS v
        FROM events),
    placed AS (
        SELECT event_type, instance, us, v, 3600000000 * unnest(range((us + 3599999999) // 3600000000, (us + 3599999999) // 3600000000 + 6)) AS stop
        FROM samples),
    steps AS (
        SELECT *, lag(v) OVER w AS before FROM placed WINDOW w AS (PARTITION BY event_type, instance, stop ORDER BY us, v)),
    windows AS (
        SELECT event_type, stop, count(*) AS n, min(us) / 1e6 AS t0, max(us) / 1e6 AS t1, arg_min(v, (us, v)) AS v0,
            sum(CASE WHEN before IS NULL THEN 0 WHEN v < before THEN v ELSE v - before END) AS rise
        FROM steps GROUP BY event_type, instance, stop HAVING count(*) > 1 AND max(us) > min(us)),
    gaps AS (
        SELECT *, t1 - t0 AS span, (t1 - t0) / (n - 1) AS every, t0 - (stop / 1e6 - 21600) AS ahead, stop / 1e6 - t1 AS behind FROM windows),
    edges AS (
        SELECT *, CASE WHEN ahead < 1.1 * every THEN ahead ELSE every / 2 END AS a,
            CASE WHEN behind < 1.1 * every THEN behind ELSE every / 2 END AS b, CASE WHEN rise > 0 THEN span * v0 / rise ELSE 'Infinity' END AS z
        FROM gaps),
    rates AS (SELECT event_type, stop, rise * (span + least(a, z) + b) / span AS increase FROM edges)
    SELECT event_type, make_timestamp(stop) AS at, round(sum(increase), 6) AS increase, round(sum(increase / 21600), 9) AS per_second
    FROM rates GROUP BY 1, 2"""
SQL["gauge_sum_range"] = """WITH samples AS (
        SELECT event_type, user_id, value, ts, event_id, epoch_us(ts) AS us FROM events WHERE regexp_full_match(event_type, 'c.*|pur.*|view')),
    steps AS (
        SELECT *, 60000000 * unnest(range((us + 59999999) // 60000000, (us + 300000000 + 59999999) // 60000000)) AS minute FROM samples),
    held AS (SELECT event_type, user_id, minute, arg_max(value, (ts, event_id)) AS value FROM steps GROUP BY 1, 2, 3)
    SELECT event_type, make_timestamp(minute) AS at, round(sum(value), 6) AS total FROM held GROUP BY 1, 2"""
SQL["p99_sliding"] = """WITH placed AS (
        SELECT event_type, value, date_trunc('hour', ts) - INTERVAL 1 HOUR * unnest(range(6)) AS window_start FROM events)
    SELECT window_start, event_type, count(*) AS n, true AS within FROM placed GROUP BY 1, 2
    HAVING window_start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""
SQL["upsert_bucketed"] = SQL["upsert_latest"]
SQL["stream_error_replay"] = f"""WITH {FEED}
    SELECT 'event' AS told, CAST(NULL AS BIGINT) AS "offset", "UserId", "ProductId", "Score", "Time", count(*) AS n FROM feed GROUP BY ALL
    UNION ALL
    SELECT ['not an object', 'empty', 'not an object', 'no user'][1 + "Id" % 50], "Id", NULL, NULL, NULL, NULL, count(*)
    FROM reviews WHERE "Id" % 50 <= 3 GROUP BY ALL
    UNION ALL SELECT 'observed', NULL, NULL, NULL, NULL, NULL, count(*) FROM reviews
    UNION ALL SELECT 'observed bad', NULL, NULL, NULL, NULL, NULL, count_if("Id" % 50 <= 3) FROM reviews"""
SQL["register_concurrent"] = """SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(rank) AS BIGINT) AS ranks, min(version) AS first,
    max(version) AS last, CAST(count(*) AS BIGINT) AS returned, CAST(count(DISTINCT version) AS BIGINT) AS paths
    FROM (VALUES (2, CAST(1 AS BIGINT)), (3, CAST(2 AS BIGINT))) AS v(rank, version)"""
SQL["label_index_growth"] = f"""WITH {REVIEWS},
    names AS (SELECT "UserId" || '/' || "ProductId" AS pair, "Id" % 2 AS half FROM reviews),
    counted AS (SELECT pair, min(half) AS half, count(*) AS n, count_if(half = 0) AS n0 FROM names GROUP BY 1)
    SELECT pair, CAST(row_number() OVER (ORDER BY half, CASE half WHEN 0 THEN n0 ELSE n END DESC, pair) - 1 AS DOUBLE) AS idx, n FROM counted"""
SQL["als_hot_user"] = f"""WITH {REVIEWS},
    pairs AS (SELECT DISTINCT CAST("UserId" AS BIGINT) AS u, CAST("ProductId" AS BIGINT) AS i FROM reviews)
    SELECT (CASE WHEN (u * 31 + i) % 3 = 0 THEN 1000000000 ELSE u END) + 1099511627776 AS id, count(*) AS n, true AS as_mllib,
        true AS fit_as_good FROM pairs GROUP BY 1"""
SQL["stream_users_once"] = """WITH RECURSIVE ticks AS (
        SELECT DISTINCT user_id * 5 AS u, epoch_us(ts) // 1000000 // 1440 * 1440 AS tick FROM events),
    due AS (
        SELECT u, min(tick) AS tick FROM ticks GROUP BY 1
        UNION ALL
        SELECT d.u, min(t.tick) FROM due AS d JOIN ticks AS t ON t.u = d.u AND t.tick >= d.tick + 86400 GROUP BY 1)
    SELECT CAST(u AS VARCHAR) AS "UserId", tick FROM due"""
SQL["lookup_many"] = """SELECT CAST(l_orderkey AS VARCHAR) AS "UserId", 0 AS pos, CAST(max(l_partkey) AS VARCHAR) AS "ProductId",
        CAST(sum(l_linenumber) AS DOUBLE) AS score
    FROM lineitem WHERE l_orderkey IN (SELECT event_id FROM events) GROUP BY l_orderkey"""
