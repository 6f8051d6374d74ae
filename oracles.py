"""DuckDB equivalents of the queries, written against the shared tables."""

from __future__ import annotations

# The activity views.
EVENTS = r"""
ev AS (
  SELECT event_id,
         CASE WHEN event_id % 50 <> 0 THEN user_id END AS customer_number,
         value AS feature1,
         CAST(regexp_extract(props, '"k": (\d+)', 1) AS DOUBLE) AS feature2,
         value - 3 AS feature3,
         event_type AS feature4,
         CAST(ts AS DATE) AS date,
         CAST(event_type = 'purchase' AS INTEGER) AS target,
         CASE WHEN event_id % 37 = 0 THEN props END AS _rescued_data
  FROM events)
"""
CHECKED = EVENTS + """,
ok AS (SELECT * FROM ev WHERE customer_number IS NOT NULL AND _rescued_data IS NULL)
"""
RAW = r"""
raw AS (
  SELECT event_id,
         CASE WHEN event_id % 41 = 0 OR event_id % 50 = 0 THEN NULL ELSE user_id END AS customer_number,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE value END AS feature1,
         CAST(regexp_extract(props, '"k": (\d+)', 1) AS DOUBLE) AS feature2,
         value - 3 AS feature3,
         event_type AS feature4,
         CAST(ts AS DATE) AS date,
         CAST(event_type = 'purchase' AS INTEGER) AS target,
         CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 37 = 0 THEN
           '{' || concat_ws(',',
             CASE WHEN event_id % 41 = 0 THEN '"customer_number":"u' || user_id || '"' END,
             CASE WHEN event_id % 43 = 0 THEN '"feature1":"n/a"' END,
             CASE WHEN event_id % 37 = 0 THEN '"props":"' || replace(props, '"', '\"') || '"' END)
           || '}' END AS _rescued_data
  FROM events)
"""
RAW_CHECKED = RAW + """,
ok AS (SELECT * FROM raw WHERE customer_number IS NOT NULL AND _rescued_data IS NULL)
"""
ORDERS = """
od AS (
  SELECT o_orderkey AS order_key, o_custkey AS customer_number, o_totalprice AS feature1,
         CAST(o_orderkey % 30 AS DOUBLE) AS feature2, o_totalprice - 250000 AS feature3,
         o_orderpriority AS feature4, CAST(o_orderdate AS DATE) AS date,
         CAST(o_orderstatus = 'F' AS INTEGER) AS target
  FROM orders)
"""
PREDICTIONS = """
pr AS (
  SELECT o_custkey AS customer_number, CAST(o_totalprice > 250000 AS INTEGER) AS prediction,
         CAST(o_orderdate AS DATE) AS date
  FROM orders)
"""

COLUMNS = "customer_number, feature1, feature2, feature3, feature4, date, target"


def _newest(source: str, keys: str, tie: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY date DESC, {tie} DESC) = 1"
    )


def _features(source: str, tie: str, target: bool = False) -> str:
    label = ", arg_max({'v': target}, struct_pack(d := date, t := %s)).v AS target" % tie
    return f"""
SELECT customer_number, min(feature1) AS feature1, max(feature2) AS feature2,
       CAST(sum(CAST(round(feature3 * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS feature3,
       arg_max({{'v': feature4}}, struct_pack(d := date, t := {tie})).v AS feature4
       {label if target else ''}
FROM {source} GROUP BY customer_number"""


def _windows(source: str, begin: str, mid: str) -> str:
    return f"""
w AS (SELECT *, CASE WHEN date < DATE '{mid}' THEN 'baseline' ELSE 'current' END AS side
      FROM {source} WHERE date >= DATE '{begin}')
"""


EVENT_WINDOWS = EVENTS + "," + _windows("ev", "2024-01-17", "2024-01-24")
ORDER_WINDOWS = ORDERS + "," + _windows("od", "2001-07-18", "2001-07-25")
# 3,000 and 400 days before 2001-08-01.
HISTORY_WINDOWS = ORDERS + "," + _windows("od", "1993-05-15", "2000-06-27")

KS = """,
vals AS (
  SELECT side, 'feature1' AS feature, feature1 AS v FROM w
  UNION ALL SELECT side, 'feature2', feature2 FROM w
  UNION ALL SELECT side, 'feature3', feature3 FROM w),
cnt AS (
  SELECT feature, v, count(*) FILTER (side = 'baseline') AS c1, count(*) FILTER (side = 'current') AS c2
  FROM vals WHERE v IS NOT NULL GROUP BY feature, v),
cum AS (
  SELECT feature, sum(c1) OVER (PARTITION BY feature ORDER BY v) AS c1,
         sum(c2) OVER (PARTITION BY feature ORDER BY v) AS c2,
         sum(c1) OVER (PARTITION BY feature) AS n1, sum(c2) OVER (PARTITION BY feature) AS n2
  FROM cnt),
ks AS (
  SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
         CAST(max(abs(c1 * n2 - c2 * n1)) AS BIGINT) AS gap
  FROM cum GROUP BY feature)
"""

# Exact p-value: probability that a random lattice path from (0, 0) to (n1, n2)
# does not stay below the gap.
EXACT_PVALUE = """,
walk AS (
  SELECT feature, n1, n2, gap, 0::BIGINT AS k,
         list_transform(range(0, n1 + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS inside
  FROM ks
  UNION ALL
  SELECT feature, n1, n2, gap, k + 1,
         list_transform(inside, lambda x, p:
           CASE WHEN k + 1 - (p - 1) BETWEEN 0 AND n2 AND abs((p - 1) * n2 - (k + 2 - p) * n1) < gap
                THEN x * (n2 - (k + 1 - (p - 1)) + 1) / (n1 + n2 - k)
                     + CASE WHEN p > 1 THEN inside[p - 1] * (n1 - (p - 1) + 1) / (n1 + n2 - k) ELSE 0.0::DOUBLE END
                ELSE 0.0::DOUBLE END)
  FROM walk WHERE k < n1 + n2),
pv AS (SELECT feature, 1 - inside[n1 + 1] AS p_value FROM walk WHERE k = n1 + n2)
"""

# Limit distribution with a finite-sample correction.
PVALUE = """,
lim AS (
  SELECT feature, x + 1 / (6 * sqrt(n)) + (x - 1) / (4 * n) AS z
  FROM (SELECT feature, n, gap / (n1::DOUBLE * n2) * sqrt(n) AS x
        FROM (SELECT *, round(n1::DOUBLE * n2 / (n1 + n2)) AS n FROM ks))),
pv AS (
  SELECT feature, CASE WHEN z < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
         list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * j * j * z * z))))) END AS p_value
  FROM lim)
"""


PSI = """,
shares AS (
  SELECT feature, c1, c2,
         sum(c1) OVER p AS n1, sum(c2) OVER p AS n2,
         c1 / (sum(c1) OVER p)::DOUBLE AS r, c2 / (sum(c2) OVER p)::DOUBLE AS c,
         (min(CASE WHEN c1 > 0 THEN c1 END) OVER p) / (sum(c1) OVER p)::DOUBLE AS least1,
         (min(CASE WHEN c2 > 0 THEN c2 END) OVER p) / (sum(c2) OVER p)::DOUBLE AS least2
  FROM ccnt WINDOW p AS (PARTITION BY feature)),
filled AS (
  SELECT feature, n1, n2,
         CASE WHEN c1 > 0 THEN r WHEN least1 <= 1e-4 THEN least1 / 1e6 ELSE 1e-4 END AS r,
         CASE WHEN c2 > 0 THEN c WHEN least2 <= 1e-4 THEN least2 / 1e6 ELSE 1e-4 END AS c
  FROM shares),
psi AS (
  SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
         sum((r - c) * ln(r / c)) AS psi
  FROM filled GROUP BY feature)
"""


def _psi(features: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS VARCHAR) AS v FROM w" for f in features
    )
    return f""",
cats AS ({rows}),
ccnt AS (
  SELECT feature, v, count(*) FILTER (side = 'baseline') AS c1, count(*) FILTER (side = 'current') AS c2
  FROM cats WHERE v IS NOT NULL GROUP BY feature, v)""" + PSI


def _binned(windows: str, features: list[str]) -> str:
    """Counts (feature, v, c1, c2) per equal step, or per value where the baseline has 20 values or fewer."""
    rows = " UNION ALL ".join(f"SELECT side, '{f}' AS feature, {f} AS x FROM w WHERE {f} IS NOT NULL" for f in features)
    return "WITH " + windows + f""",
nums AS ({rows}),
ends AS (
  SELECT feature, min(x) AS low, max(x) AS high, ceil(log2(count(*)) + 1) AS k, count(DISTINCT x) FILTER (side = 'baseline') AS kinds
  FROM nums GROUP BY feature),
ccnt AS (
  SELECT feature, CASE WHEN kinds > 20 THEN least(k - 1, floor((x - low) * k / (high - low))) ELSE x END AS v,
         count(*) FILTER (side = 'baseline') AS c1, count(*) FILTER (side = 'current') AS c2
  FROM nums JOIN ends USING (feature) GROUP BY ALL)"""


def _categories(windows: str, features: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS VARCHAR) AS v FROM w WHERE {f} IS NOT NULL" for f in features
    )
    return "WITH " + windows + f""",
cats AS ({rows}),
ccnt AS (
  SELECT feature, v, count(*) FILTER (side = 'baseline') AS c1, count(*) FILTER (side = 'current') AS c2
  FROM cats GROUP BY feature, v)"""


# Scores of the counts per feature and value.
JENSEN_SHANNON = """,
js AS (
  SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
         sqrt(greatest(sum(CASE WHEN r > 0 THEN r * ln(2 * r / (r + c)) ELSE 0 END
                           + CASE WHEN c > 0 THEN c * ln(2 * c / (r + c)) ELSE 0 END) / 2, 0)) AS score
  FROM (SELECT feature, sum(c1) OVER p AS n1, sum(c2) OVER p AS n2, c1 / (sum(c1) OVER p)::DOUBLE AS r, c2 / (sum(c2) OVER p)::DOUBLE AS c
        FROM ccnt WINDOW p AS (PARTITION BY feature))
  GROUP BY feature)
"""

# The lower regularised incomplete gamma function as a plain sum over logarithms.
CHI_SQUARE = """,
stat AS (
  SELECT feature, max(n1) AS n1, max(n2) AS n2, min(c1) AS least, (count(*) - 1) / 2.0 AS a,
         sum((c2 - c1 * n2 / n1) * (c2 - c1 * n2 / n1) / nullif(c1 * n2 / n1, 0)) / 2 AS x
  FROM (SELECT feature, c1::DOUBLE AS c1, c2::DOUBLE AS c2, (sum(c1) OVER p)::DOUBLE AS n1, (sum(c2) OVER p)::DOUBLE AS n2
        FROM ccnt WINDOW p AS (PARTITION BY feature))
  GROUP BY feature),
chi AS (
  SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2,
         CASE WHEN least = 0 THEN 0 WHEN a = 0 OR x <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(
           range(0, 2000), lambda j: exp((a + j) * ln(x) - x - lgamma(a + j + 1))))) END AS score
  FROM stat)
"""

WASSERSTEIN = """,
dist AS (
  SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
         sum(coalesce((nv - v) * abs(c1 / n1::DOUBLE - c2 / n2::DOUBLE), 0)) AS distance
  FROM (SELECT feature, v, lead(v) OVER p AS nv, sum(c1) OVER p AS c1, sum(c2) OVER p AS c2,
               sum(c1) OVER (PARTITION BY feature) AS n1, sum(c2) OVER (PARTITION BY feature) AS n2
        FROM cnt WINDOW p AS (PARTITION BY feature ORDER BY v))
  GROUP BY feature),
wd AS (
  SELECT feature, n1, n2, distance, distance / greatest(dev, 0.001) AS score
  FROM dist JOIN (SELECT feature, stddev_pop(v) AS dev FROM vals WHERE side = 'baseline' GROUP BY feature) USING (feature))
"""


def _report(windows: str, own: str = "") -> str:
    return "WITH RECURSIVE " + windows + KS + PVALUE + _psi(["feature4"]) + f""",
limits AS (SELECT 'feature1' AS feature, 0.15::DOUBLE AS threshold UNION ALL SELECT 'feature2', {own or '0.15'}::DOUBLE
           UNION ALL SELECT 'feature3', 0.15::DOUBLE UNION ALL SELECT 'feature4', 0.15::DOUBLE),
report AS (
  SELECT feature, 'ks' AS stattest, n1, n2, p_value AS score, threshold, p_value <= threshold AS detected
  FROM ks JOIN pv USING (feature) JOIN limits USING (feature)
  UNION ALL
  SELECT feature, 'psi', n1, n2, psi, threshold, psi >= threshold FROM psi JOIN limits USING (feature))
"""


def _confusion(keys: str, extra: str = "") -> str:
    on = " AND ".join(f"t.{k} = p.{k}" for k in keys.split(", "))
    return f"""
conf AS (
  SELECT CAST(count(*) FILTER (t.target = 1 AND p.prediction = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (t.target = 0 AND p.prediction = 1) AS BIGINT) AS fp,
         CAST(count(*) FILTER (t.target = 1 AND p.prediction = 0) AS BIGINT) AS fn,
         CAST(count(*) FILTER (t.target = 0 AND p.prediction = 0) AS BIGINT) AS tn
  FROM od t JOIN pr p ON {on} {extra}),
scored AS (
  SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2.0 * tp + fp + fn) ELSE 0.0 END::DOUBLE AS f1 FROM conf)
"""

ORDER_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_LEVELS = ["click", "error", "purchase", "signup", "view"]
COMPLETE = "feature1 IS NOT NULL AND feature2 IS NOT NULL AND feature3 IS NOT NULL"


def _logistic(rows: str, levels: list[str], steps: int = 30) -> str:
    """Tables x (rows to fit on) and best (weights w): Newton steps on 0.5 |w|^2 + sum of log losses.

    The intercept comes first and is not penalised. Each step sums gradient and Hessian over the rows
    as a matrix with one column more, and Gauss-Jordan elimination solves it. Levels without rows
    have a zero gradient and keep the weight 0.
    """
    inputs = ["1.0", *[f"coalesce(feature4 = '{v}', false)::INTEGER" for v in levels], "feature1", "feature2", "feature3"]
    n = len(inputs)
    matrix = ", ".join(
        "["
        + ", ".join(f"sum(p * (1 - p) * v[{i}] * v[{j}]){' + 1' if i == j > 1 else ''}" for j in range(1, n + 1))
        + f", sum((p - target) * v[{i}]){f' + any_value(w[{i}])' if i > 1 else ''}]"
        for i in range(1, n + 1)
    )
    return f"""
x AS MATERIALIZED (
  SELECT target, CAST([{", ".join(inputs)}] AS DOUBLE[]) AS v FROM {rows} WHERE {COMPLETE} AND target IS NOT NULL),
fit(step, w) AS (
  SELECT 0, CAST([{", ".join(["0"] * n)}] AS DOUBLE[])
  UNION ALL
  SELECT step + 1, list_transform(w, lambda b, i: b - solved[i][{n + 1}])
  FROM (
    -- The first element is the matrix itself; the reduction's index i runs from 2 on.
    SELECT step, w, list_reduce(list_resize([m], {n + 1}, m), lambda a, same, i: list_transform(a, lambda r, k:
             CASE WHEN k = i - 1 THEN list_transform(r, lambda e: e / r[i - 1])
                  ELSE list_transform(r, lambda e, c: e - r[i - 1] * a[i - 1][c] / a[i - 1][i - 1]) END)) AS solved
    FROM (
      SELECT step, any_value(w) AS w, [{matrix}] AS m
      FROM (SELECT step, w, v, target, 1 / (1 + exp(-list_dot_product(v, w))) AS p FROM fit, x WHERE step < {steps})
      GROUP BY step))),
best AS (SELECT w FROM fit WHERE step = {steps})
"""


def _scores(rows: str, levels: list[str], day: str) -> str:
    inputs = ["1.0", *[f"coalesce(feature4 = '{v}', false)::INTEGER" for v in levels], "feature1", "feature2", "feature3"]
    return f"""
SELECT customer_number, CASE WHEN {COMPLETE} THEN CAST(probability > 0.5 AS INTEGER) END AS prediction,
       CASE WHEN {COMPLETE} THEN probability END AS probability, DATE '{day}' AS prediction_date
FROM (SELECT f.*, 1 / (1 + exp(-list_dot_product(CAST([{", ".join(inputs)}] AS DOUBLE[]), w))) AS probability FROM {rows} f, best)"""



def _unit(k: int) -> str:
    block, part = divmod(k, 4)
    return (
        f"((('0x' || substr(md5(event_id || '-{block}'), {8 * part + 1}, 8))::BIGINT)::DOUBLE + 0.5)"
        " / 4294967296.0::DOUBLE"
    )


EVENT_COLUMNS = "event_id, " + COLUMNS

ORACLES: dict[str, str] = {
    "scan_activity": f"WITH {EVENTS} SELECT * FROM ev",
    "scan_named_table": f"WITH {ORDERS} SELECT * FROM od",
    "cutoff_training": f"WITH {ORDERS} SELECT * FROM od WHERE date >= DATE '1999-08-02'",
    "cutoff_eval": f"WITH {ORDERS} SELECT * FROM od WHERE date >= DATE '2001-06-30'",
    "cutoff_drift": f"WITH {ORDERS} SELECT * FROM od WHERE date >= DATE '2001-06-02'",
    "rescue_conform": f"WITH {RAW} SELECT * FROM raw",
    "bronze_stream_ingest": f"WITH {RAW} SELECT * FROM raw",
    "generate_activity": f"""
SELECT CAST(floor(1 + {_unit(0)} * 99) AS INTEGER) AS customer_number,
       round({_unit(1)} * 75, 2) AS feature1,
       round({_unit(2)} * 30, 2) AS feature2,
       round(3 + 5 * sqrt(-2 * ln({_unit(4)})) * cos(2 * pi() * {_unit(5)}), 2) AS feature3,
       CASE WHEN {_unit(3)} < 0.33 THEN 'Low' WHEN {_unit(3)} < 0.66 THEN 'Medium'
            WHEN {_unit(3)} < 0.99 THEN 'High' ELSE 'Unknown' END AS feature4,
       DATE '2024-01-31' AS date,
       CASE WHEN {_unit(6)} < 0.4 THEN 0 ELSE 1 END AS target
FROM events""",
    "dq_expect_or_drop": f"WITH {CHECKED} SELECT * FROM ok",
    "dq_expect_or_drop_stream": f"WITH {RAW_CHECKED} SELECT * FROM ok",
    "dq_metrics": f"""
WITH {EVENTS}
SELECT 'customer_number' AS rule, CAST(count(customer_number) AS BIGINT) AS passed,
       CAST(count(*) - count(customer_number) AS BIGINT) AS failed FROM ev
UNION ALL
SELECT '_rescued_data', CAST(count(*) - count(_rescued_data) AS BIGINT), CAST(count(_rescued_data) AS BIGINT) FROM ev""",
    "dq_metrics_stream": f"""
WITH {RAW}
SELECT 'customer_number' AS rule, CAST(count(customer_number) AS BIGINT) AS passed,
       CAST(count(*) - count(customer_number) AS BIGINT) AS failed FROM raw
UNION ALL
SELECT '_rescued_data', CAST(count(*) - count(_rescued_data) AS BIGINT), CAST(count(_rescued_data) AS BIGINT) FROM raw""",
    "silver_scd1": f"WITH {CHECKED} " + _newest("ok", "customer_number", "event_id", EVENT_COLUMNS),
    "silver_scd1_daily": f"WITH {CHECKED} "
    + _newest("ok", "date, customer_number", "event_id", EVENT_COLUMNS),
    "silver_scd1_stream": f"WITH {RAW_CHECKED} "
    + _newest("ok", "customer_number", "event_id", EVENT_COLUMNS),
    "silver_scd1_daily_stream": f"WITH {RAW_CHECKED} "
    + _newest("ok", "date, customer_number", "event_id", EVENT_COLUMNS),
    "run_medallion": f"WITH {RAW_CHECKED} "
    + _newest("ok", "date, customer_number", "event_id", EVENT_COLUMNS),
    "silver_deletes_stream": f"WITH {RAW_CHECKED} SELECT * FROM ("
    + _newest("ok", "customer_number", "event_id", EVENT_COLUMNS)
    + ") WHERE feature4 <> 'error'",
    "bronze_mixed_schemas": f"""
WITH {EVENTS}
SELECT * REPLACE (
  CASE WHEN event_id % 3 = 1 AND event_id % 41 = 0 THEN NULL ELSE customer_number END AS customer_number,
  CASE WHEN event_id % 3 <> 2 THEN target END AS target,
  CASE WHEN event_id % 6 = 0 THEN '{{"extra":"' || feature4 || '"}}'
       WHEN event_id % 3 = 1 AND event_id % 41 = 0 AND event_id % 50 <> 0
       THEN '{{"customer_number":"u' || customer_number || '"}}' END AS _rescued_data)
FROM ev""",
    "silver_same_day_correction": f"WITH {CHECKED}, "
    "runs AS (SELECT * FROM ok QUALIFY row_number() OVER "
    "(PARTITION BY date, customer_number, event_id % 2 ORDER BY event_id DESC) = 1), "
    "kept AS (SELECT * FROM runs QUALIFY row_number() OVER "
    "(PARTITION BY date, customer_number ORDER BY event_id % 2 DESC) = 1) "
    f"SELECT {EVENT_COLUMNS} FROM (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN feature1 "
    "WHEN event_id % 3 <> 0 THEN feature1 - 1000 END AS feature1) FROM kept)",
    "feature_table_merge": f"WITH {CHECKED}, daily AS ("
    + _newest("ok", "date, customer_number", "event_id", COLUMNS)
    + ") SELECT * REPLACE (CASE WHEN date < DATE '2024-01-10' THEN -feature1 ELSE feature1 END AS feature1) FROM daily",
    "scd1_out_of_order": f"WITH {ORDERS} " + _newest("od", "customer_number", "order_key"),
    "scd1_deletes": f"WITH {CHECKED} SELECT * FROM ("
    + _newest("ok", "customer_number", "event_id", EVENT_COLUMNS)
    + ") WHERE feature4 <> 'error'",
    "latest_per_partition": f"WITH {ORDERS} " + _newest("od", "customer_number", "order_key"),
    "latest_per_date": f"WITH {ORDERS} " + _newest("od", "date", "order_key"),
    "training_table": f"WITH {ORDERS} " + _newest("od", "date, customer_number", "order_key", COLUMNS),
    "refresh_training_table": f"WITH {RAW_CHECKED} "
    + _newest("ok", "date, customer_number", "event_id", COLUMNS),
    "online_features": f"WITH {CHECKED} " + _features("ok", "event_id"),
    "online_publish": f"WITH {CHECKED} " + _features("ok", "event_id"),
    "refresh_online_features": f"WITH {RAW_CHECKED}, daily AS ("
    + _newest("ok", "date, customer_number", "event_id")
    + ") "
    + _features("daily", "event_id"),
    "training_features": f"WITH {ORDERS}, recent AS (SELECT * FROM od WHERE date >= DATE '1999-08-02') "
    + _features("recent", "order_key", target=True),
    "feature_table_roundtrip": f"WITH {CHECKED} "
    + _newest("ok", "date, customer_number", "event_id", COLUMNS),
    "feature_table_refresh": f"WITH {CHECKED}, daily AS ("
    + _newest("ok", "date, customer_number", "event_id", COLUMNS)
    + ") SELECT * REPLACE (CASE WHEN date < DATE '2024-01-10' THEN -feature1 ELSE feature1 END AS feature1) FROM daily",
    "predictions_write": """
SELECT user_id AS customer_number, CAST(value > 20 AS INTEGER) AS prediction, value AS probability,
       CAST(ts AS DATE) AS prediction_date FROM events""",
    "cutoff_predictions": f"WITH {PREDICTIONS} SELECT * FROM pr WHERE date >= DATE '2001-06-30'",
    "eval_join": f"""
WITH {ORDERS}, {PREDICTIONS}
SELECT t.date, t.customer_number, t.target, p.prediction
FROM od t JOIN pr p ON t.date = p.date AND t.customer_number = p.customer_number""",
    "eval_join_by_date": f"WITH {ORDERS}, {PREDICTIONS}, {_confusion('date')} SELECT * FROM conf",
    "f1_eval": f"WITH {ORDERS}, {PREDICTIONS}, {_confusion('date, customer_number')} SELECT * FROM scored",
    "f1_eval_by_date": f"WITH {ORDERS}, {PREDICTIONS}, {_confusion('date')} SELECT * FROM scored",
    "retrain_decision": f"WITH {ORDERS}, {PREDICTIONS}, "
    + _confusion(
        "date, customer_number",
        "WHERE t.date BETWEEN DATE '2001-06-30' AND DATE '2001-07-31' AND p.date >= DATE '2001-06-30'",
    )
    + " SELECT f1, f1 < 0.6 AS retrain FROM scored",
    "drift_windows": f"WITH {EVENT_WINDOWS} SELECT * FROM w",
    "drift_ks": f"WITH {EVENT_WINDOWS} {KS} SELECT feature, n1, n2, round(gap / (n1::DOUBLE * n2), 9) AS d FROM ks",
    "drift_ks_history": f"WITH {HISTORY_WINDOWS} {KS} SELECT feature, n1, n2, round(gap / (n1::DOUBLE * n2), 9) AS d FROM ks",
    "drift_ks_orders": f"""
WITH RECURSIVE {ORDER_WINDOWS} {KS} {EXACT_PVALUE}
SELECT feature, n1, n2, round(gap / (n1::DOUBLE * n2), 9) AS d, round(p_value, 7) AS p_value
FROM ks JOIN pv USING (feature)""",
    "drift_psi": f"WITH {EVENT_WINDOWS} {_psi(['feature4'])} SELECT feature, n1, n2, round(psi, 9) AS psi FROM psi",
    "drift_psi_orders": f"WITH {ORDER_WINDOWS} {_psi(['feature4', 'customer_number'])} SELECT feature, n1, n2, round(psi, 9) AS psi FROM psi",
    "drift_psi_numeric": _binned(ORDER_WINDOWS, ["feature1", "feature2", "feature3"]) + PSI
    + " SELECT feature, n1, n2, round(psi, 9) AS score FROM psi",
    "drift_jensen_shannon_numeric": _binned(HISTORY_WINDOWS, ["feature1", "feature2", "feature3"]) + JENSEN_SHANNON
    + " SELECT feature, n1, n2, round(score, 9) AS score FROM js",
    "drift_jensen_shannon": _categories(ORDER_WINDOWS, ["feature4", "customer_number"]) + JENSEN_SHANNON
    + " SELECT feature, n1, n2, round(score, 9) AS score FROM js",
    "drift_chi_square": _categories(HISTORY_WINDOWS, ["feature4", "feature2", "customer_number"]) + CHI_SQUARE
    + " SELECT feature, n1, n2, round(score, 7) AS score FROM chi",
    "drift_wasserstein": f"WITH {HISTORY_WINDOWS} {KS} {WASSERSTEIN} "
    + "SELECT feature, n1, n2, round(distance, 4) AS distance, round(score, 7) AS score FROM wd",
    "drift_ks_ranges": f"""
WITH {ORDERS}, sk AS (
  SELECT date, exp(4 * ((order_key * 7919 % 1000003) / 1000003.0 - 0.5)) * feature1 AS feature1, NULL::DOUBLE AS feature2, NULL::DOUBLE AS feature3
  FROM od), {_windows("sk", "1993-05-15", "2000-06-27")} {KS}
SELECT feature, n1, n2, round(gap / (n1::DOUBLE * n2), 9) AS d FROM ks""",
    "drift_report_tests": f"""
WITH RECURSIVE {HISTORY_WINDOWS} {KS} {PVALUE} {WASSERSTEIN}, {_binned("XX", ["feature3"]).split("XX,", 1)[1]} {JENSEN_SHANNON},
kcnt AS (
  SELECT feature4 AS v, count(*) FILTER (side = 'baseline') AS c1, count(*) FILTER (side = 'current') AS c2 FROM w WHERE feature4 IS NOT NULL GROUP BY feature4),
chi AS (
  SELECT max(n1) AS n1, max(n2) AS n2, (count(*) - 1) / 2.0 AS a,
         sum((c2 - c1 * n2 / n1) * (c2 - c1 * n2 / n1) / (c1 * n2 / n1)) / 2 AS x
  FROM (SELECT c1::DOUBLE AS c1, c2::DOUBLE AS c2, (sum(c1) OVER ())::DOUBLE AS n1, (sum(c2) OVER ())::DOUBLE AS n2 FROM kcnt)),
report AS (
  SELECT feature, 'ks' AS stattest, n1, n2, p_value AS score, 0.15::DOUBLE AS threshold, p_value <= 0.15 AS detected FROM ks JOIN pv USING (feature) WHERE feature = 'feature1'
  UNION ALL SELECT feature, 'wasserstein', n1, n2, score, 0.1, score >= 0.1 FROM wd WHERE feature = 'feature2'
  UNION ALL SELECT feature, 'jensenshannon', n1, n2, score, 0.15, score >= 0.15 FROM js
  UNION ALL SELECT 'feature4', 'chisquare', CAST(n1 AS BIGINT), CAST(n2 AS BIGINT), p, 0.05, p <= 0.05 FROM (
    SELECT *, 1 - list_sum(list_transform(range(0, 2000), lambda j: exp((a + j) * ln(x) - x - lgamma(a + j + 1)))) AS p FROM chi))
SELECT feature, stattest, n1, n2, round(score, 7) AS score, threshold, detected FROM report""",
    "rescue_fractions": """
SELECT o_orderkey AS order_key,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS customer_number,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS date,
       CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey + 0.5 AS DOUBLE) END AS key_rescued,
       o_orderkey % 11 = 0 AS date_rescued,
       CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS nested,
       o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 5 = 0 AS rescued
FROM orders""",
    "drift_report": _report(EVENT_WINDOWS)
    + " SELECT feature, stattest, n1, n2, round(score, 7) AS score, threshold, detected FROM report",
    "drift_report_orders": _report(ORDER_WINDOWS, "0.9")
    + " SELECT feature, stattest, n1, n2, round(score, 7) AS score, threshold, detected FROM report",
    "drift_any": _report(EVENT_WINDOWS) + " SELECT bool_or(detected) AS any_drift FROM report",
    "drift_detection": _report(
        CHECKED
        + ", daily AS ("
        + _newest("ok", "date, customer_number", "event_id")
        + "), "
        + _windows("daily", "2024-01-17", "2024-01-24")
    )
    + """
SELECT feature AS item, detected AS flag FROM report
UNION ALL SELECT 'any_drift', bool_or(detected) FROM report
UNION ALL SELECT 'retrained', bool_or(detected) FROM report""",
    "ohe_features": f"""
WITH {EVENTS}
SELECT event_id, feature4, CAST(feature4 = 'click' AS INTEGER) AS is_click,
       CAST(feature4 = 'purchase' AS INTEGER) AS is_purchase, CAST(feature4 = 'signup' AS INTEGER) AS is_signup,
       CAST(feature4 = 'view' AS INTEGER) AS is_view, 4 AS slots FROM ev""",
    "train_logistic": f"WITH RECURSIVE {ORDERS}, recent AS (SELECT * FROM od WHERE date >= DATE '1999-08-02'), f AS ("
    + _features("recent", "order_key", target=True) + "), " + _logistic("f", ORDER_LEVELS) + f"""
SELECT unnest(['intercept', {", ".join(f"'feature4={v}'" for v in ORDER_LEVELS)}, 'feature1', 'feature2', 'feature3']) AS feature,
       unnest(list_transform(w, lambda b, i: CASE WHEN i IN (7, 9) THEN round(b, 10) ELSE round(b, 3) END)) AS weight
FROM best""",
    "predict_batch": f"WITH RECURSIVE {ORDERS}, recent AS (SELECT * FROM od WHERE date >= DATE '1999-08-02'), f AS ("
    + _features("recent", "order_key", target=True) + "), " + _logistic("f", ORDER_LEVELS)
    + "SELECT * REPLACE (round(probability, 2) AS probability) FROM (" + _scores("f", ORDER_LEVELS, "2001-08-01") + ")",
    "score_and_evaluate": f"WITH RECURSIVE {RAW_CHECKED}, od AS ("
    + _newest("ok", "date, customer_number", "event_id") + "), f AS (" + _features("od", "event_id", target=True) + "), "
    + _logistic("f", EVENT_LEVELS) + ", pr AS (SELECT customer_number, prediction, prediction_date AS date FROM ("
    + _scores("f", EVENT_LEVELS, "2024-01-29") + ")), "
    + _confusion("date, customer_number", "WHERE t.date BETWEEN DATE '2023-12-30' AND DATE '2024-01-30'") + """
SELECT CASE WHEN tp + fp + fn + tn > 0 THEN f1 END AS f1, tp + fp + fn + tn > 0 AND f1 < 0.6 AS retrain,
       CASE WHEN tp + fp + fn + tn > 0 AND f1 < 0.6 THEN 2 END AS version FROM scored""",
    "registry_roundtrip": f"""
WITH {ORDERS}
SELECT v.version, v.stage, n.scored
FROM (VALUES (1, 'Archived'), (2, 'Production')) v(version, stage),
     (SELECT CAST(count(DISTINCT customer_number) AS BIGINT) AS scored FROM od WHERE date >= DATE '1999-08-02') n""",
    "registry_latest_run": """
SELECT o_custkey AS experiment, o_orderkey AS version, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS end_time
FROM orders ORDER BY end_time DESC, version DESC LIMIT 1""",
    "registry_latest_runs": """
SELECT o_custkey AS experiment, o_orderkey AS version, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS end_time
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "registry_stage": r"""
WITH st AS (
  SELECT user_id AS model, CAST(regexp_extract(props, '"k": (\d+)', 1) AS INTEGER) AS version,
         CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging'
                         WHEN 'error' THEN 'Archived' ELSE 'None' END AS stage,
         event_id AS seq
  FROM events),
own AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY seq DESC) = 1)
SELECT model, version,
       CASE WHEN stage IN ('Staging', 'Production') AND EXISTS (
              SELECT 1 FROM st s WHERE s.model = own.model AND s.stage = own.stage AND s.seq > own.seq)
            THEN 'Archived' ELSE stage END AS stage
FROM own""",
}
