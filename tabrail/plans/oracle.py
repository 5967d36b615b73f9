"""DuckDB SQL text for the correctness oracle (one string per query).

Shared common table expressions mirror the fixture frames; each query's
SQL is written independently of the Spark code path, from the operator's
definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from tabrail.plans.fixtures import CHARGE_FEATURES, STUMP_FEATURES

SEED = 42


def _k(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


CHARGE = f"""charge AS (
  SELECT concat_ws(':', {_k('l_orderkey')}, {_k('l_partkey')}, {_k('l_suppkey')},
                   {_k('l_linenumber')}, {_k('l_quantity')}) AS row_key,
         CAST(l_quantity AS DOUBLE) AS l_quantity,
         CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
         CAST(l_discount AS DOUBLE) AS l_discount,
         CAST(l_tax AS DOUBLE) AS l_tax,
         CAST(l_linenumber AS DOUBLE) AS l_linenumber,
         CAST(p_size AS DOUBLE) AS p_size,
         CAST(p_retailprice AS DOUBLE) AS p_retailprice,
         CAST(o_totalprice AS DOUBLE) AS o_totalprice,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) / 100000 AS target
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

FEATS = ", ".join(CHARGE_FEATURES)

# S2 on charge: train when md5('42:bernoulli:' || key) < 'cccccccc'.
BERNOULLI = f"""bern AS (
  SELECT *, CASE WHEN md5('{SEED}:bernoulli:' || row_key) < 'cccccccc'
                 THEN 'train' ELSE 'test' END AS part
  FROM charge),
train AS (SELECT * EXCLUDE (part) FROM bern WHERE part = 'train'),
test AS (SELECT * EXCLUDE (part) FROM bern WHERE part = 'test')"""

# S1 on charge: first ceil(0.2 n) rows in (md5, key) order are the test part,
# numbered 0..k-1 (the replay ids); train rows have no id.
EXACT = f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('{SEED}:exact:' || row_key), row_key) - 1 AS id,
         count(*) OVER () AS n_all
  FROM charge),
exact AS (
  SELECT * EXCLUDE (n_all, id),
         CASE WHEN id < ceil(n_all * CAST(0.2 AS DOUBLE)) THEN id END AS id,
         CASE WHEN id < ceil(n_all * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part
  FROM ranked),
stream_part AS (SELECT * EXCLUDE (part) FROM exact WHERE part = 'test'),
prep_train AS (SELECT * EXCLUDE (part, id) FROM exact WHERE part = 'train')"""


def stump(train: str, features: Sequence[str] = STUMP_FEATURES, name: str = "best") -> str:
    """Best single split over all midpoints of consecutive distinct values:
    maximise ls^2/ln + rs^2/rn; left is value <= threshold."""
    unions = "\n    UNION ALL ".join(
        f"SELECT '{f}' AS f, {i} AS fi, {f} AS v, target AS y FROM {train}"
        for i, f in enumerate(features)
    )
    return f"""{name}_long AS (
    {unions}),
{name}_g AS (SELECT f, fi, v, count(*) AS n, sum(y) AS s FROM {name}_long GROUP BY f, fi, v),
{name}_c AS (
  SELECT f, fi, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv,
         sum(n) OVER (PARTITION BY f ORDER BY v ROWS UNBOUNDED PRECEDING) AS ln,
         sum(s) OVER (PARTITION BY f ORDER BY v ROWS UNBOUNDED PRECEDING) AS ls,
         sum(n) OVER (PARTITION BY f) AS tn, sum(s) OVER (PARTITION BY f) AS ts
  FROM {name}_g),
{name} AS (
  SELECT f, (v + nv) / 2 AS thr, ls / ln AS lmean, (ts - ls) / (tn - ln) AS rmean
  FROM {name}_c WHERE nv IS NOT NULL
  ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, fi, v
  LIMIT 1)"""


def stump_predict(alias: str, best: str = "best", features: Sequence[str] = STUMP_FEATURES) -> str:
    cases = " ".join(f"WHEN '{f}' THEN {alias}.{f}" for f in features)
    return (f"CASE WHEN (CASE {best}.f {cases} END) <= {best}.thr "
            f"THEN {best}.lmean ELSE {best}.rmean END")


def tree(train: str, test: str, features: Sequence[str], depth: int, name: str = "tr", middle: str = "node") -> str:
    """An unsampled tree, one unrolled step a level; ``<name>_out`` holds
    row_key, target and prediction of every row of ``test``.

    ``middle``: thresholds lie in the middle of neighbouring values of the
    node's rows ("node") or of all train rows ("all", as binned search does
    when every value has a bin of its own)."""
    cols = ", ".join(features)
    value = "CASE fi " + " ".join(f"WHEN {i} THEN {{0}}.{f}" for i, f in enumerate(features)) + " END"
    ctes = [f"{name}_r0 AS (SELECT row_key, target, {cols}, 1 AS node FROM {train})",
            f"{name}_x0 AS (SELECT row_key, target, {cols}, 1 AS node FROM {test})"]
    follow = "nv"
    if middle == "all":
        unions = " UNION ".join(f"SELECT {i} AS fi, {f} AS v FROM {train}" for i, f in enumerate(features))
        ctes.append(f"{name}_v AS (SELECT fi, v, lead(v) OVER (PARTITION BY fi ORDER BY v) AS av FROM ({unions}))")
        follow = "av"
    for d in range(depth):
        unions = " UNION ALL ".join(f"SELECT node, {i} AS fi, {f} AS v, target AS y FROM {name}_r{d}" for i, f in enumerate(features))
        more = f" JOIN {name}_v USING (fi, v)" if middle == "all" else ""
        ctes.append(f"{name}_g{d} AS (SELECT node, fi, v, count(*) AS n, sum(y) AS s FROM ({unions}) GROUP BY node, fi, v)")
        ctes.append(f"""{name}_c{d} AS (
  SELECT node, fi, v, lead(v) OVER w AS nv, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS ln,
         sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS ls,
         sum(n) OVER (PARTITION BY node, fi) AS tn, sum(s) OVER (PARTITION BY node, fi) AS ts
  FROM {name}_g{d} WINDOW w AS (PARTITION BY node, fi ORDER BY v))""")
        ctes.append(f"""{name}_b{d} AS (
  SELECT node AS bn, fi, (v + {follow}) / 2 AS thr FROM {name}_c{d}{more} WHERE nv IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, fi, v) = 1)""")
        for t in ("r", "x"):
            side = f"CASE WHEN {value.format('t')} <= thr THEN 0 ELSE 1 END"
            ctes.append(f"{name}_{t}{d + 1} AS (SELECT t.* REPLACE (CASE WHEN bn IS NULL THEN node ELSE 2 * node + {side} END AS node) "
                        f"FROM {name}_{t}{d} t LEFT JOIN {name}_b{d} ON node = bn)")
    ctes.append(f"{name}_m AS (SELECT node, sum(target) / count(*) AS prediction FROM {name}_r{depth} GROUP BY node)")
    ctes.append(f"{name}_out AS (SELECT row_key, target, prediction FROM {name}_x{depth} JOIN {name}_m USING (node))")
    return ",\n".join(ctes)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ticks: events as a result stream (prediction = 40 + k/5).
TICKS = """ticks AS (
  SELECT event_id AS id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         value AS actual_price,
         40.0 + CAST(json_extract_string(props, '$.k') AS INTEGER) / 5 AS prediction
  FROM events),
results AS (
  SELECT id, actual_price, prediction AS predicted_price,
         prediction - actual_price AS error,
         (prediction - actual_price) / actual_price * 100 AS error_percentage
  FROM ticks)"""


def r6(sql: str, doubles: Sequence[str], digits: int = 6) -> str:
    """Round the named columns (values of sums), as the queries do."""
    if not doubles:
        return sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


ALL = list(CHARGE_FEATURES)
DOUBLES = [*ALL, "target"]
SCORES = ["predicted_price", "error", "error_percentage"]

# The model rows of the reference: S1 train, then S2 train ("80% of 80%").
TRAIN80 = f"""bern2 AS (
  SELECT *, CASE WHEN md5('{SEED}:bernoulli:' || row_key) < 'cccccccc'
                 THEN 'train' ELSE 'test' END AS part
  FROM prep_train),
train2 AS (SELECT * EXCLUDE (part) FROM bern2 WHERE part = 'train'),
test2 AS (SELECT * EXCLUDE (part) FROM bern2 WHERE part = 'test')"""

MODEL = with_(CHARGE, EXACT, TRAIN80, stump("train2"))
P_STREAM = stump_predict("s")
SCORED_STREAM = r6(
    MODEL + f"""SELECT s.id, s.target AS actual_price, {P_STREAM} AS predicted_price,
       {P_STREAM} - s.target AS error,
       ({P_STREAM} - s.target) / s.target * 100 AS error_percentage
FROM stream_part s CROSS JOIN best""",
    SCORES,
)
STREAM_PREDICTIONS = r6(MODEL + f"SELECT s.id, {P_STREAM} AS prediction FROM stream_part s CROSS JOIN best",
                        ["prediction"])

# Requests: faults keyed on the order key (see fixtures.requests).
REQ = """req AS (
  SELECT row_key AS request_id, CAST(split_part(row_key, ':', 1) AS BIGINT) AS ok, * FROM charge),
decoded AS (
  SELECT request_id, ok,
         CASE WHEN ok % 89 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN ok % 101 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN ok % 97 = 0 THEN NULL ELSE l_tax END AS l_tax,
         l_linenumber, p_size, p_retailprice, o_totalprice
  FROM req),
parsed AS (
  SELECT request_id,
         l_quantity, l_extendedprice, l_discount,
         CASE WHEN ok % 97 = 0 THEN 0.0 ELSE l_tax END AS l_tax,
         l_linenumber, p_size, p_retailprice, o_totalprice,
         CASE WHEN ok % 89 = 0 THEN 500 WHEN ok % 101 = 0 THEN 400 ELSE 0 END AS status
  FROM decoded),
parsed_r AS (
  SELECT *, CASE status WHEN 500 THEN 'null value in a numeric field'
                        WHEN 400 THEN 'invalid input: not a number' END AS reason
  FROM parsed),
checked AS (
  SELECT * REPLACE (
           CASE WHEN status = 0 AND (""" + " OR ".join(f"{c} = 0" for c in ALL) + """) THEN 400
                ELSE status END AS status,
           CASE WHEN status = 0 AND (""" + " OR ".join(f"{c} = 0" for c in ALL) + """)
                THEN 'all fields are required' ELSE reason END AS reason)
  FROM parsed_r),
valid AS (SELECT *, status = 0 AS valid FROM checked)"""


def _describe() -> str:
    parts = []
    for i, c in enumerate(DOUBLES):
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column, count({c}) AS count, avg({c}) AS mean, "
            f"stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25, "
            f"quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max "
            f"FROM charge"
        )
    return r6(with_(CHARGE) + "\nUNION ALL ".join(parts),
              ["mean", "std", "p25", "p50", "p75"], 7)


def _dataset_report() -> str:
    feats = ", ".join(f"('feature', '{i}', '{c}')" for i, c in enumerate(ALL))
    return with_(CHARGE, EXACT) + f"""SELECT * FROM (VALUES {feats},
    ('label', 'target', 'median price, unit $100,000')) AS t(section, key, value)
UNION ALL SELECT 'count', 'total', CAST(count(*) AS VARCHAR) FROM exact
UNION ALL SELECT 'count', 'train', CAST(count(*) FILTER (WHERE part = 'train') AS VARCHAR) FROM exact
UNION ALL SELECT 'count', 'stream', CAST(count(*) FILTER (WHERE part <> 'train') AS VARCHAR) FROM exact"""


def _schema_report() -> str:
    rows = [(0, "row_key", "string")] + [(i + 1, c, "double") for i, c in enumerate(DOUBLES)]
    return with_(CHARGE) + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS \"values\" FROM charge" for i, c, t in rows)


LAST100 = "last100 AS (SELECT * FROM results ORDER BY id DESC LIMIT 100)"
P_TEST = stump_predict("t")
P_REQ = stump_predict("v")


def oracle_sql() -> dict[str, str]:
    feats = ", ".join(ALL)
    q: dict[str, str] = {}
    q["csv_scan"] = with_(CHARGE) + f"SELECT {feats}, target FROM charge"
    q["feature_table"] = q["csv_scan"]
    q["replay_scan"] = (with_(CHARGE, EXACT) + f"SELECT {feats}, target, id FROM stream_part WHERE id < 200")
    q["rows_to_frame"] = with_(CHARGE) + f"SELECT row_key, {feats} FROM charge"
    q["results_reader"] = SCORED_STREAM
    q["model_load"] = STREAM_PREDICTIONS
    q["csv_write"] = with_(CHARGE, EXACT) + f"SELECT row_key, {feats}, target, part FROM exact"
    q["publish_table"] = (
        with_(CHARGE, EXACT)
        + "SELECT CASE part WHEN 'train' THEN 'train_data' ELSE 'streaming_data' END AS table_name, "
          "row_key, target FROM exact")
    q["materialize_if_absent"] = with_(CHARGE, EXACT) + "SELECT row_key, target FROM stream_part"
    results = with_(TICKS) + "SELECT * FROM results"
    q["stream_json_sink"] = results
    q["stream_debug_tap"] = results
    q["model_save"] = STREAM_PREDICTIONS
    replayed = with_(CHARGE, EXACT) + f"SELECT id, {feats}, target AS actual_price FROM stream_part"
    q["replay_publish"] = with_(CHARGE, EXACT) + (
        f"SELECT id // 1000 AS block, id, {feats}, target AS actual_price FROM stream_part")
    q["csv_bad_lines"] = with_(CHARGE, EXACT) + """
SELECT id, CASE WHEN id % 97 <> 0 AND id % 101 <> 0 THEN l_quantity END AS l_quantity,
       CASE WHEN id % 97 = 0 OR id % 101 <> 0 THEN target END AS actual_price,
       CASE WHEN id % 97 = 0 THEN 'text' WHEN id % 101 = 0 THEN 'short' ELSE 'long' END AS fault
FROM stream_part WHERE id % 97 = 0 OR id % 101 = 0 OR id % 103 = 0"""
    q["run_status_log"] = with_(CHARGE, EXACT) + (
        "SELECT 'started' AS status, '2024-01-01T00:00:00' AS timestamp, 'prediction' AS stage, "
        "CAST(NULL AS VARCHAR) AS model_path, CAST(NULL AS BIGINT) AS rows "
        "UNION ALL SELECT 'completed', '2024-01-01T00:01:00', 'prediction', NULL, count(*) FROM stream_part")
    q["feature_columns"] = with_(CHARGE) + f"SELECT row_key, {feats} FROM charge"
    q["assemble_vector"] = (
        with_(CHARGE) + "SELECT row_key, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(ALL)) + " FROM charge")
    q["json_decode"] = with_(CHARGE, REQ) + f"SELECT request_id, {feats} FROM decoded"
    q["json_encode"] = with_(TICKS) + (
        "SELECT id, CAST(to_json({'id': id, 'actual_price': actual_price, 'predicted_price': predicted_price, "
        "'error': error, 'error_percentage': error_percentage}) AS VARCHAR) AS value FROM results")
    q["replay_record"] = replayed
    q["stream_source"] = replayed
    q["data_loss_tolerance"] = with_(CHARGE, EXACT) + (
        f"SELECT id, {feats}, target AS actual_price, "
        "(SELECT count(*) FROM stream_part WHERE id // 500 = 2) AS lost FROM stream_part WHERE id // 500 <> 2")
    q["prediction_error"] = results
    q["unit_convert"] = (with_(TICKS) + "SELECT id, actual_price * 100 AS actual_k, predicted_price * 100 AS "
                           "predicted_k, abs(error) * 100 AS abs_error_k FROM results")
    q["price_format"] = (with_(TICKS) + "SELECT id, round(prediction, 4) AS predicted_price, "
                           "round(prediction * 100000, 2) AS predicted_price_usd, "
                           "'$' || format('{:,.2f}', prediction * 100000) AS formatted_price FROM ticks")
    q["result_line"] = with_(TICKS) + (
        "SELECT id, printf('ID: %4d | Actual: $%6.2fK | Predicted: $%6.2fK | Error: %6.2f%%', id, "
        "actual_price * 100, predicted_price * 100, error_percentage) AS line FROM results")
    q["replay_progress_line"] = with_(CHARGE, EXACT) + (
        f"SELECT id, printf('sent record %d/%d | {ALL[0]}=%.2f | actual price=$%.2fK', id + 1, "
        f"(SELECT count(*) FROM stream_part), {ALL[0]}, target * 100) AS line FROM stream_part")
    q["schema_report"] = _schema_report()
    q["request_parse"] = with_(CHARGE, REQ) + f"SELECT request_id, {feats}, status, reason FROM parsed_r"
    q["request_validate"] = with_(CHARGE, REQ) + "SELECT request_id, status, reason, valid FROM valid"
    q["request_forms"] = with_(CHARGE) + (
        "SELECT request_id, "
        + ", ".join(f"CASE k WHEN 1 THEN NULL WHEN 3 THEN 0.0 ELSE {c} END AS {c}" for c in ALL)
        + ", CASE WHEN k = 1 THEN 500 WHEN k = 3 OR z THEN 400 ELSE 0 END AS status, "
        "CASE WHEN k = 1 THEN 'body is not a JSON object' WHEN k = 3 OR z THEN 'all fields are required' END AS reason, "
        "k <> 1 AND k <> 3 AND NOT z AS valid FROM (SELECT row_key AS request_id, "
        "CAST(split_part(row_key, ':', 1) AS BIGINT) % 5 AS k, " + " OR ".join(f"{c} = 0" for c in ALL) + " AS z, * FROM charge)")
    q["request_form_rules"] = with_(CHARGE, REQ) + (
        "SELECT request_id, "
        + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in ALL) + " AS missing, "
        + " + ".join(f"CAST(coalesce({c} < 0, false) AS INTEGER)" for c in ALL[:6]) + " AS negative, "
        + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in ALL) + " + "
        + " + ".join(f"CAST(coalesce({c} < 0, false) AS INTEGER)" for c in ALL[:6]) + " AS violations "
        "FROM decoded")
    q["exact_split"] = with_(CHARGE, EXACT) + "SELECT row_key, id, part FROM exact"
    q["bernoulli_split"] = with_(CHARGE, BERNOULLI) + "SELECT row_key, part FROM bern"
    q["head_n"] = (with_(TICKS) + "SELECT id, actual_price, prediction FROM ticks ORDER BY ts, id LIMIT 200")
    q["sample_rows"] = r6(MODEL + f"SELECT t.target, {P_TEST} AS prediction FROM test2 t CROSS JOIN best "
                          "ORDER BY t.row_key LIMIT 10", ["prediction"])
    q["last_n"] = with_(TICKS, LAST100) + "SELECT * FROM last100"
    q["row_counts"] = with_(CHARGE, EXACT, TRAIN80) + (
        "SELECT 'prepare' AS scope, count(*) AS total, count(*) FILTER (WHERE part = 'train') AS train, "
        "count(*) FILTER (WHERE part <> 'train') AS test FROM exact "
        "UNION ALL SELECT 'train', count(*), count(*) FILTER (WHERE part = 'train'), "
        "count(*) FILTER (WHERE part <> 'train') FROM bern2")
    q["describe"] = _describe()
    m = "SELECT {} FROM ticks"
    rm = "sqrt(avg(pow(prediction - actual_price, 2))) AS rmse"
    ma = "avg(abs(prediction - actual_price)) AS mae"
    r2 = "1 - sum(pow(prediction - actual_price, 2)) / (var_pop(actual_price) * count(*)) AS r2"
    q["rmse"] = r6(with_(TICKS) + m.format(rm), ["rmse"])
    q["mae"] = r6(with_(TICKS) + m.format(ma), ["mae"])
    q["r2"] = r6(with_(TICKS) + m.format(r2), ["r2"])
    q["regression_report"] = r6(with_(TICKS) + m.format(f"{rm}, {ma}, {r2}, count(*) AS n"),
                                ["rmse", "mae", "r2"])
    q["live_metrics"] = r6(with_(TICKS, LAST100) + (
        "SELECT avg(abs(error) * 100) AS mae_k, sqrt(avg(pow(abs(error) * 100, 2))) AS rmse_k, "
        "count(*) AS samples FROM last100 HAVING count(*) > 0"), ["mae_k", "rmse_k"])
    q["live_metrics_stream"] = r6(with_(TICKS) + """
SELECT b.batch, avg(abs(error) * 100) AS mae_k, sqrt(avg(pow(abs(error) * 100, 2))) AS rmse_k, count(*) AS samples
FROM (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n FROM results) AS p
JOIN (SELECT unnest(range(0, CAST((SELECT count(*) FROM results) AS BIGINT), 1000)) // 1000 AS batch) AS b
  ON pos < least(1000 * (batch + 1), n) AND pos >= least(1000 * (batch + 1), n) - 100
GROUP BY b.batch""", ["mae_k", "rmse_k"])
    q["dataset_report"] = _dataset_report()
    q["tree_fit_exact"] = r6(with_(CHARGE, EXACT, TRAIN80, stump("train2", ALL)) +
                             "SELECT f AS feature, thr AS threshold, lmean AS left_prediction, "
                             "rmean AS right_prediction FROM best", ["left_prediction", "right_prediction"])
    q["tree_fit_depth3"] = r6(with_(CHARGE, EXACT, TRAIN80, tree("train2", "test2", ALL, 3)) +
                              "SELECT * FROM tr_out", ["prediction"])
    q["forest_fit_depth3"] = r6(with_(CHARGE, EXACT, TRAIN80, tree("train2", "test2", STUMP_FEATURES, 3, middle="all")) +
                                "SELECT * FROM tr_out", ["prediction"])
    q["model_score"] = r6(MODEL + f"SELECT t.row_key, t.target, {P_TEST} AS prediction FROM test2 t CROSS JOIN best",
                          ["prediction"])
    q["predict_batch"] = STREAM_PREDICTIONS
    q["score_requests"] = (with_(CHARGE, EXACT, TRAIN80, stump("train2"), REQ) + f"""SELECT v.request_id,
       v.valid AS success,
       CASE WHEN v.valid THEN 200 ELSE v.status END AS status,
       CASE WHEN v.valid THEN round({P_REQ}, 4) END AS predicted_price,
       CASE WHEN v.valid THEN round({P_REQ} * 100000, 2) END AS predicted_price_usd,
       CASE WHEN v.valid THEN '$' || format('{{:,.2f}}', {P_REQ} * 100000) END AS formatted_price,
       v.reason AS error
FROM valid v CROSS JOIN best""")
    q["evaluate_model"] = r6(MODEL + f"""SELECT sqrt(avg(pow(p - target, 2))) AS rmse, avg(abs(p - target)) AS mae,
       1 - sum(pow(p - target, 2)) / (var_pop(target) * count(*)) AS r2, count(*) AS n
FROM (SELECT t.target, {P_TEST} AS p FROM test2 t CROSS JOIN best)""", ["rmse", "mae", "r2"])
    q["row_position_id"] = with_(CHARGE) + (
        "SELECT row_key, row_number() OVER (ORDER BY target, row_key) - 1 AS id FROM charge")
    q["sample_index"] = with_(TICKS, LAST100) + (
        "SELECT row_number() OVER (ORDER BY id) - 1 AS sample_index, id FROM last100")
    q["rolling_last_n_metrics"] = r6(with_(TICKS) + """SELECT id,
       avg(abs(error) * 100) OVER w AS mae_k,
       sqrt(avg(pow(abs(error) * 100, 2)) OVER w) AS rmse_k,
       count(*) OVER w AS samples
FROM results WINDOW w AS (ORDER BY id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""", ["mae_k", "rmse_k"])
    q["monitor_series"] = (with_(TICKS, LAST100) + (
        "SELECT row_number() OVER (ORDER BY id) - 1 AS sample_index, id, actual_price * 100 AS actual_k, "
        "predicted_price * 100 AS predicted_k, abs(error) * 100 AS abs_error_k FROM last100"))
    q["stream_score"] = r6(MODEL + f"""SELECT s.id,
       CASE WHEN ok AND s.id % 103 <> 0 THEN s.target END AS actual_price, CASE WHEN ok THEN {P_STREAM} END AS predicted_price,
       CASE WHEN ok AND s.id % 103 <> 0 THEN {P_STREAM} - s.target END AS error,
       CASE WHEN ok AND s.id % 103 <> 0 THEN ({P_STREAM} - s.target) / s.target * 100 END AS error_percentage,
       CASE WHEN NOT ok THEN 'missing or invalid field' END AS reason
FROM (SELECT *, id % 97 <> 0 AND id % 101 <> 0 AS ok FROM stream_part) s CROSS JOIN best""", SCORES)
    q["stream_resume"] = SCORED_STREAM
    q["stream_replay"] = f"SELECT q.*, run FROM ({SCORED_STREAM}) AS q CROSS JOIN (VALUES (1), (2)) AS r(run)"
    q["stream_fan_out"] = f"SELECT q.*, consumer FROM ({SCORED_STREAM}) AS q CROSS JOIN (VALUES ('sink'), ('tap')) AS c(consumer)"
    q["bounded_run"] = f"SELECT q.*, 'limit' AS ended, true AS first_run_had_rows FROM ({SCORED_STREAM}) AS q"
    q["stream_decode_quarantine"] = r6(MODEL + f"""SELECT
       CASE WHEN ok THEN 'scored' ELSE 'rejected' END AS outcome,
       CASE WHEN s.id % 103 <> 0 AND s.id % 109 <> 0 THEN s.id END AS id,
       CASE WHEN s.id % 103 <> 0 AND s.id % 107 <> 0 THEN s.target END AS actual_price,
       CASE WHEN ok THEN {P_STREAM} END AS predicted_price,
       CASE WHEN ok AND s.id % 107 <> 0 THEN {P_STREAM} - s.target END AS error,
       CASE WHEN ok AND s.id % 107 <> 0 THEN ({P_STREAM} - s.target) / s.target * 100 END AS error_percentage,
       CASE WHEN s.id % 103 = 0 THEN 'not a JSON object' WHEN NOT ok THEN 'missing or invalid field' END AS reason,
       (SELECT count(*) FROM stream_part) AS rows_read
FROM (SELECT *, id % 97 <> 0 AND id % 101 <> 0 AND id % 103 <> 0 AS ok FROM stream_part) s CROSS JOIN best""", SCORES)
    q["prepare_job"] = _dataset_report()
    q["predict_job"] = SCORED_STREAM
    q["forest_fit_checks"] = r6(with_(CHARGE, EXACT, TRAIN80) + "SELECT row_key, target, true AS in_label_range, 100 AS trees, 10 AS depth, "
                                "count(*) OVER () AS rows, stddev_samp(target) OVER () AS label_std, true AS below_std FROM test2", ["label_std"])
    q["train_job_single_split"] = q["evaluate_model"]
    q["end_to_end_single_split"] = r6(MODEL + f"""SELECT row_number() OVER (ORDER BY id) - 1 AS sample_index, id,
       actual_price * 100 AS actual_k, predicted_price * 100 AS predicted_k,
       abs(predicted_price - actual_price) * 100 AS abs_error_k
FROM (SELECT s.id, s.target AS actual_price, {P_STREAM} AS predicted_price
      FROM stream_part s CROSS JOIN best ORDER BY s.id DESC LIMIT 100)""",
                                      ["predicted_k", "abs_error_k"])
    return q
