"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: only the key-rule dirt snippets
(:mod:`medallion.plans.dirt`) are shared.  Casts that differ between the two
engines are spelled out (DuckDB rounds double->int, Spark truncates: ``trunc``;
DuckDB's boolean cast is narrower: explicit ``CASE``).
"""
from __future__ import annotations

from medallion.plans.dirt import (EVENT_CSV, EVENT_DIRT, EVENT_JSON, EVENT_JSON_NULL_CARDHOLDER,
                                  EVENT_JSON_TRUNCATED, EVENT_LOG_BROKEN, FRAUD_PREFIXES, sql_select)

NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def num(x: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({x}), '{NUM_RE}') THEN try_cast(trim({x}) AS DOUBLE) END)"


def boolset(x: str) -> str:
    return (f"(CASE WHEN lower(trim({x})) IN ('true','1','1.0','yes') THEN true "
            f"WHEN lower(trim({x})) IN ('false','0','0.0','no') THEN false END)")


def boolcast(x: str) -> str:
    return (f"(CASE WHEN lower(trim({x})) IN ('t','true','y','yes','1') THEN true "
            f"WHEN lower(trim({x})) IN ('f','false','n','no','0') THEN false END)")


def title(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE upper(substr(lower({x}),1,1)) || substr(lower({x}),2) END)"


def norm_cat(x: str) -> str:
    return f"(CASE WHEN upper(trim({x})) = 'NAN' THEN NULL ELSE nullif(trim({x}), '') END)"


DE = f"dirty_events AS (SELECT {sql_select(EVENT_DIRT)} FROM events)"
CE = (f"coerced_events AS (SELECT event_id, tx_id, {num('raw_value')} AS value_num, "
      f"{num('raw_hour')} AS hour_num, {boolset('raw_flag')} AS flag, raw_cat AS cat FROM dirty_events)")
DL = ("dl AS (SELECT l_orderkey, l_linenumber, "
      "CASE WHEN l_orderkey % 5 = 0 THEN l_quantity + 500 ELSE l_quantity END AS qty, "
      "CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 50 WHEN l_orderkey % 5 = 0 THEN l_extendedprice * 10 "
      "WHEN l_orderkey % 13 = 0 THEN l_extendedprice * 4 ELSE l_extendedprice END AS price, "
      "CASE WHEN l_orderkey % 83 = 0 THEN l_discount + 1 ELSE l_discount END AS disc FROM lineitem)")
WITH_CE = f"WITH {DE}, {CE} "
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TX = "CASE WHEN event_id % 3 = 0 THEN 'TX-2024-4' ELSE 'TX-2024-0' END || printf('%07d', event_id)"

# Parsed log fields computed from the event columns the lines were rendered from.
PARSED = f"""SELECT {TX} AS transaction_id, CAST(hour(ts) AS INTEGER) AS transaction_hour,
  CAST(user_id AS VARCHAR) AS user_id, value AS amount, 'ARS' AS currency,
  event_type AS merchant_category,
  CASE WHEN user_id % 2 = 0 THEN 'Card' ELSE 'Transfer' END AS method,
  CASE event_id % 3 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'DECLINED' ELSE 'FLAGGED' END AS status,
  event_id % 4 = 0 AS is_foreign_transaction, event_id % 5 = 0 AS location_mismatch,
  CAST(user_id % 101 AS INTEGER) AS device_trust_score,
  CAST(CAST(event_id % 12 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) AS DOUBLE) AS velocity_last_24h,
  CAST(18 + user_id % 60 AS INTEGER) AS cardholder_age, event_type = 'error' AS is_fraud,
  CASE WHEN event_id % 3 <> 0 THEN '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' END AS ip,
  CASE WHEN event_id % 5 = 2 THEN CAST(event_id % 4 AS INTEGER) ELSE 0 END AS failed_attempts
FROM events WHERE NOT ({EVENT_LOG_BROKEN})"""
NOTE = " OR ".join(f"starts_with(transaction_id, '{p}')" for p in FRAUD_PREFIXES)

RISK = """round(least(1.0, greatest(0.0, 0.05
  + CASE WHEN coalesce(is_foreign_transaction, false) THEN 0.25 ELSE 0 END
  + CASE WHEN coalesce(location_mismatch, false) THEN 0.25 ELSE 0 END
  + CASE WHEN coalesce(amount >= 500, false) THEN 0.15 ELSE 0 END
  + CASE WHEN coalesce(velocity_last_24h >= 10, false) THEN 0.10 ELSE 0 END
  + CASE WHEN coalesce(device_trust_score <= 40, false) THEN 0.10 ELSE 0 END)), 2)::DOUBLE"""


def csv_flow_sql() -> str:
    cols = ["transaction_id", "amount", "transaction_hour", "foreign_transaction", "location_mismatch",
            "device_trust_score", "velocity_last_24h", "cardholder_age", "is_fraud"]
    c0 = ", ".join([f"{num(c)} AS {c}" for c in cols] + ["merchant_category"])
    rest = ["amount", "transaction_hour", "merchant_category", "foreign_transaction", "location_mismatch",
            "device_trust_score", "velocity_last_24h", "cardholder_age", "is_fraud"]

    def fence(prev, col, f, name):
        return (f"f_{name} AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 "
                f"FROM {prev}), {name} AS (SELECT {prev}.* FROM {prev}, f_{name} "
                f"WHERE {col} >= q1 - {f} * (q3 - q1) AND {col} <= q3 + {f} * (q3 - q1))")
    return f"""WITH raw AS (SELECT {sql_select(EVENT_CSV, keep=())} FROM events),
c0 AS (SELECT {c0} FROM raw),
c1 AS (SELECT * FROM c0 WHERE transaction_id IS NOT NULL AND transaction_id = floor(transaction_id)),
c2 AS (SELECT min(transaction_id) AS transaction_id, {", ".join(rest)} FROM c1 GROUP BY ALL),
c3 AS (SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_id, {", ".join(rest)} FROM c2),
c4 AS (SELECT transaction_id, amount, transaction_hour, merchant_category,
  CAST(coalesce(foreign_transaction, 0.0) AS INTEGER) AS foreign_transaction,
  CAST(coalesce(location_mismatch, 0.0) AS INTEGER) AS location_mismatch,
  device_trust_score, velocity_last_24h, cardholder_age,
  CAST(coalesce(is_fraud, 0.0) AS INTEGER) AS is_fraud
  FROM c3 WHERE coalesce(is_fraud, 0.0) IN (0.0, 1.0) AND coalesce(foreign_transaction, 0.0) IN (0.0, 1.0)
  AND coalesce(location_mismatch, 0.0) IN (0.0, 1.0)),
m AS (SELECT quantile_cont(amount, 0.5) AS m_amount, quantile_cont(device_trust_score, 0.5) AS m_trust,
  quantile_cont(velocity_last_24h, 0.5) AS m_vel, quantile_cont(cardholder_age, 0.5) AS m_age FROM c4),
c5 AS (SELECT transaction_id, coalesce(amount, m_amount) AS amount, transaction_hour, merchant_category,
  foreign_transaction, location_mismatch, coalesce(device_trust_score, m_trust) AS device_trust_score,
  coalesce(velocity_last_24h, m_vel) AS velocity_last_24h, coalesce(cardholder_age, m_age) AS cardholder_age,
  is_fraud FROM c4, m),
{fence("c5", "cardholder_age", "1.5", "c6")},
{fence("c6", "device_trust_score", "1.5", "c7")},
{fence("c7", "velocity_last_24h", "1.5", "c8")},
{fence("c8", "amount", "3.0", "c9")},
c10 AS (SELECT * REPLACE ({title(norm_cat("merchant_category"))} AS merchant_category) FROM c9),
mc AS (SELECT merchant_category AS mode_cat FROM c10 WHERE merchant_category IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
mh AS (SELECT transaction_hour AS mode_hour FROM c10 WHERE transaction_hour IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
c11 AS (SELECT c10.* REPLACE (coalesce(merchant_category, (SELECT mode_cat FROM mc)) AS merchant_category,
  coalesce(transaction_hour, (SELECT mode_hour FROM mh)) AS transaction_hour) FROM c10)
SELECT transaction_id, amount,
  CAST(trunc(transaction_hour) AS INTEGER) AS transaction_hour, merchant_category, foreign_transaction,
  location_mismatch, device_trust_score, velocity_last_24h,
  CAST(trunc(cardholder_age) AS INTEGER) AS cardholder_age, is_fraud
FROM c11 WHERE transaction_hour BETWEEN 0 AND 23"""


def json_flow_sql(unreadable: str | None = None, digits: int | None = 6) -> str:
    x = EVENT_JSON
    readable = f"WHERE NOT ({unreadable})" if unreadable else ""
    nc = EVENT_JSON_NULL_CARDHOLDER

    def i(e):
        return f"CAST(trunc({num(e)}) AS INTEGER)"
    return f"""WITH j AS (SELECT {x['transaction_id']} AS transaction_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, {num(x['amount'])} AS amount,
  {i(x['transaction_hour'])} AS transaction_hour, {x['merchant_category']} AS merchant_category,
  CASE WHEN {nc} THEN NULL ELSE {i(x['age'])} END AS cardholder_age,
  CASE WHEN {nc} THEN NULL ELSE {x['country']} END AS cardholder_country,
  {x['device_type']} AS device_type, {x['operating_system']} AS device_os,
  {num(x['device_trust_score'])} AS device_trust_score, {num(x['velocity_last_24h'])} AS velocity_last_24h,
  {num(x['ip_risk_score'])} AS ip_risk_score, {x['city']} AS city, {x['country']} AS country,
  {boolset(x['is_foreign_transaction'])} AS is_foreign_transaction,
  {boolset(x['location_mismatch'])} AS location_mismatch, {x['method']} AS auth_method,
  {i(x['failed_attempts'])} AS failed_attempts, {x['is_fraud']} AS is_fraud FROM events {readable}),
f AS (SELECT * FROM j WHERE transaction_id IS NOT NULL),
g AS (SELECT * REPLACE (coalesce(amount, (SELECT avg(amount) FROM f)) AS amount) FROM f)
SELECT * REPLACE ({'amount' if digits is None else f'round(amount, {digits})'} AS amount,
  CASE WHEN starts_with(transaction_id, 'TX-2024-4') THEN true ELSE is_fraud END AS is_fraud),
  CAST(starts_with(transaction_id, 'TX-2024-4') AS INTEGER) AS id_flag
FROM g WHERE amount IS NOT NULL AND transaction_hour IS NOT NULL AND merchant_category IS NOT NULL
  AND cardholder_age IS NOT NULL AND is_foreign_transaction IS NOT NULL AND location_mismatch IS NOT NULL
  AND transaction_hour BETWEEN 0 AND 23 AND cardholder_age BETWEEN 0 AND 120
  AND device_trust_score BETWEEN 0 AND 100 AND velocity_last_24h BETWEEN 0 AND 10"""


def json_stage_audit_sql() -> str:
    body = json_flow_sql(f"({EVENT_JSON_TRUNCATED}) OR event_id % 89 = 5")
    head, where = body.rsplit("FROM g WHERE", 1)
    complete, _ = where.split("  AND transaction_hour BETWEEN")
    ctes = head[:head.rindex("SELECT * REPLACE")].rstrip()
    return f"""{ctes},
n AS (SELECT (SELECT count(*) FROM events) AS a, (SELECT count(*) FROM events WHERE NOT ({EVENT_JSON_TRUNCATED})) AS b,
  (SELECT count(*) FROM j) AS c, (SELECT count(*) FROM f) AS d, (SELECT count(*) FROM g WHERE {complete}) AS e,
  (SELECT count(*) FROM ({body})) AS f)
SELECT stage_no::INT AS stage_no, stage, rows, removed FROM (
  SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS stage_no,
    unnest(['scanned', 'readable', 'not_empty', 'with_id', 'dedupe', 'complete', 'in_range']) AS stage,
    unnest([a, b, c, d, d, e, f]) AS rows, unnest([0, a - b, b - c, c - d, 0, d - e, e - f]) AS removed FROM n)"""


def csv_stage_audit_sql() -> str:
    body = csv_flow_sql()
    head, final = body.rsplit("\nSELECT transaction_id", 1)
    stages = [("read", "raw"), ("integral_id", "c1"), ("dedupe", "c2"), ("flags", "c4"), ("iqr", "c9"),
              ("hour_range", "out")]
    counts = " UNION ALL ".join(f"SELECT {i} AS stage_no, '{name}' AS stage, count(*) AS n FROM {t}"
                                for i, (name, t) in enumerate(stages))
    return (f"{head},\nout AS (SELECT transaction_id{final}),\nst AS ({counts})\n"
            "SELECT stage_no, stage, n AS rows, CAST(coalesce(lag(n) OVER (ORDER BY stage_no) - n, 0) AS BIGINT) "
            "AS removed FROM st")


def logs_flow_sql() -> str:
    return f"""WITH p AS ({PARSED})
SELECT transaction_id, amount, transaction_hour, merchant_category, is_foreign_transaction, location_mismatch,
  device_trust_score, velocity_last_24h, cardholder_age,
  CASE WHEN {NOTE} THEN true ELSE is_fraud END AS is_fraud,
  {RISK} AS ip_risk_score, CAST(({NOTE}) AS INTEGER) AS id_flag
FROM p"""


GOLD = """SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, amount, transaction_hour,
  lower(merchant_category) AS merchant_category, foreign_transaction, location_mismatch, device_trust_score,
  velocity_last_24h, cardholder_age, is_fraud, 0 AS id_flag, 'csv' AS source, 1 AS priority FROM csv
UNION ALL
SELECT transaction_id, amount, transaction_hour, lower(merchant_category), CAST(is_foreign_transaction AS INTEGER),
  CAST(location_mismatch AS INTEGER), device_trust_score, velocity_last_24h, cardholder_age,
  CAST(is_fraud AS INTEGER), id_flag, 'json', 2 FROM js
UNION ALL
SELECT transaction_id, amount, transaction_hour, lower(merchant_category), CAST(is_foreign_transaction AS INTEGER),
  CAST(location_mismatch AS INTEGER), CAST(device_trust_score AS DOUBLE), velocity_last_24h, cardholder_age,
  CAST(is_fraud AS INTEGER), id_flag, 'logs', 3 FROM logs"""


def gold_union_sql() -> str:
    return f"WITH csv AS ({csv_flow_sql()}), js AS ({json_flow_sql(digits=None)}), logs AS ({logs_flow_sql()}) {GOLD}"


def gold_latest_sql() -> str:
    return f"""WITH csv AS ({csv_flow_sql()}), js AS ({json_flow_sql(digits=None)}), logs AS ({logs_flow_sql()}),
u AS ({GOLD})
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY priority DESC) AS rn
  FROM u) WHERE rn = 1"""


GOLD_CATS = ["click", "error", "purchase", "signup", "view"]
GOLD_NUM = ["amount", "transaction_hour", "foreign_transaction", "location_mismatch", "device_trust_score",
            "velocity_last_24h", "cardholder_age", "is_fraud", "id_flag"]
GOLD_COLS = [*GOLD_NUM, *[f"cat_{c}" for c in GOLD_CATS], "src_csv", "src_json", "src_logs"]


def gold_frame() -> str:
    """Model frame of the gold table: numbers and one-hot columns, rows with a null number left out."""
    hot = [f"CAST(coalesce(merchant_category = '{c}', false) AS DOUBLE) AS cat_{c}" for c in GOLD_CATS]
    hot += [f"CAST(source = '{x}' AS DOUBLE) AS src_{x}" for x in ("csv", "json", "logs")]
    return (f"gold AS ({gold_union_sql()}), frame AS (SELECT source || '-' || transaction_id AS row_id, "
            + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in GOLD_NUM) + ", " + ", ".join(hot)
            + " FROM gold WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in GOLD_NUM) + ")")


def _corr(a: str, b: str) -> str:
    return (f"CASE WHEN (SELECT min({a}) = max({a}) OR min({b}) = max({b}) FROM frame) THEN NULL "
            f"ELSE (SELECT round(corr({a}, {b}), 6) + 0.0 FROM frame) END")


def _sketch_col(t: str, c: str, number: bool) -> str:
    """One line of the sketch summary: exact where at most 512 values occur."""
    v = f"CAST({c} AS DOUBLE)" if number else f"CAST({c} AS VARCHAR)"
    num = """round(avg(v), 7) AS mean, round(stddev_samp(v), 6) AS std, min(v) + 0.0 AS "min",
  round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
  max(v) + 0.0 AS "max\"""" if number else ", ".join(
        f'CAST(NULL AS DOUBLE) AS "{m}"' for m in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    top = "CASE WHEN count(DISTINCT v) <= 512 THEN (SELECT v FROM f ORDER BY n DESC, v LIMIT 1) END"
    return f"""SELECT * FROM (WITH x AS (SELECT {v} AS v FROM {t}),
  f AS (SELECT v, count(*) AS n FROM x WHERE v IS NOT NULL GROUP BY v)
SELECT '{t}' AS table_name, '{c}' AS column_name, count(v) AS count, count(DISTINCT v) <= 512 AS exact,
  CASE WHEN count(DISTINCT v) <= 512 THEN count(DISTINCT v) END AS "unique",
  {top if number else 'CAST(NULL AS DOUBLE)'} AS top, {'CAST(NULL AS VARCHAR)' if number else top} AS top_text,
  CASE WHEN count(DISTINCT v) <= 512 THEN (SELECT max(n) FROM f) END AS freq, {num} FROM x)"""


def _quart(table, col, f, disc=False):
    q = "quantile_disc" if disc else "quantile_cont"
    return (f"SELECT '{col}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
            f"round(q1 - {f} * (q3 - q1), 6) AS lo, round(q3 + {f} * (q3 - q1), 6) AS hi FROM "
            f"(SELECT {q}({col}, 0.25) AS q1, {q}({col}, 0.75) AS q3 FROM {table})")


LI_TEXT = ["l_returnflag", "l_linestatus", "l_shipdate"]
LI_ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", *LI_TEXT]


def _summary_col(c):
    if c in LI_TEXT:
        top, text, rest = "CAST(NULL AS DOUBLE)", "(SELECT v FROM f ORDER BY n DESC, v LIMIT 1)", ", ".join(
            f'CAST(NULL AS DOUBLE) AS "{m}"' for m in ("mean", "std", "min", "q25", "q50", "q75", "max"))
        v = f"CAST({c} AS VARCHAR)"
    else:
        top, text, rest = "(SELECT v FROM f ORDER BY n DESC, v LIMIT 1)", "CAST(NULL AS VARCHAR)", """round(avg(v), 7) AS mean,
  round(stddev_samp(v), 6) AS std, min(v) + 0.0 AS "min", round(quantile_cont(v, 0.25), 6) AS q25,
  round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75, max(v) + 0.0 AS "max\""""
        v = f"CAST({c} AS DOUBLE)"
    return f"""SELECT * FROM (WITH x AS (SELECT {v} AS v FROM lineitem),
  f AS (SELECT v, count(*) AS n FROM x WHERE v IS NOT NULL GROUP BY v)
SELECT '{c}' AS column_name, count(v) AS count, count(DISTINCT v) AS "unique", {top} AS top, {text} AS top_text,
  (SELECT max(n) FROM f) AS freq, {rest} FROM x)"""


def _outlier_col(c, f):
    return f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q1 - {f} * (q3 - q1), 6) AS lo, round(q3 + {f} * (q3 - q1), 6) AS hi,
  (SELECT count(*) FROM dl WHERE {c} < q1 - {f} * (q3 - q1) OR {c} > q3 + {f} * (q3 - q1)) AS n_outliers,
  round(med, 6) AS median, mx AS max_value
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3,
  max({c}) AS mx FROM dl)"""


UNIFY = """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS amount, o_orderstatus AS status,
  'csv' AS source, 1 AS priority FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_totalprice * 2, 'O-json', 'json', 2 FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_totalprice + 1, NULL, 'logs', 3 FROM orders WHERE o_orderpriority = '1-URGENT'"""
UNIFY_LATEST = f"""SELECT order_id, amount, status, source, priority FROM (SELECT *, row_number() OVER
  (PARTITION BY order_id ORDER BY priority DESC) AS rn FROM ({UNIFY})) WHERE rn = 1"""

UPSERT_TARGET = """SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS c_name, c_nationkey, c_acctbal,
  c_mktsegment FROM customer"""
UPSERT = f"""WITH t AS ({UPSERT_TARGET}),
s AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey,
  CASE WHEN c_custkey % 11 = 0 THEN c_mktsegment ELSE c_name END AS c_name, c_nationkey,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer)
SELECT CASE WHEN s.c_custkey IS NOT NULL THEN s.c_custkey ELSE t.c_custkey END AS c_custkey,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey"""

HASH42 = "('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8))::BIGINT"
SPLIT = f"""WITH h AS (SELECT doc_id, toxic, {HASH42} AS h FROM labels),
t AS (SELECT toxic, quantile_disc(h, 0.2) AS thr FROM h GROUP BY toxic)
SELECT h.doc_id, h.toxic, CASE WHEN h.h <= t.thr THEN 'test' ELSE 'train' END AS split
FROM h JOIN t ON h.toxic IS NOT DISTINCT FROM t.toxic"""
PRED = """p AS (SELECT l.quality AS a, CAST(d.n_chars >= 2000 AS INTEGER) AS p FROM labels l JOIN documents d USING (doc_id))"""
CM = f"""WITH {PRED}, g AS (SELECT x.a, y.p FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(p))
SELECT g.a AS actual, g.p AS predicted, (SELECT count(*) FROM p WHERE p.a = g.a AND p.p = g.p) AS n FROM g"""
REPORT = f"""WITH cm AS ({CM}),
per AS (SELECT c, tp, support, pred_n,
  CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM (
  SELECT x.c, (SELECT sum(n) FROM cm WHERE actual = x.c AND predicted = x.c) AS tp,
   (SELECT sum(n) FROM cm WHERE actual = x.c) AS support, (SELECT sum(n) FROM cm WHERE predicted = x.c) AS pred_n
  FROM (VALUES (0), (1)) x(c))),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
  sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM per2)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round(tp / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM tot"""


def _sequential_iqr():
    return f"""WITH {DL},
fq AS (SELECT quantile_cont(qty, 0.25) AS q1, quantile_cont(qty, 0.75) AS q3 FROM dl),
s1 AS (SELECT dl.* FROM dl, fq WHERE qty >= q1 - 1.5 * (q3 - q1) AND qty <= q3 + 1.5 * (q3 - q1)),
fp AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM s1),
s2 AS (SELECT s1.* FROM s1, fp WHERE price >= q1 - 3.0 * (q3 - q1) AND price <= q3 + 3.0 * (q3 - q1)),
fd AS (SELECT quantile_cont(disc, 0.25) AS q1, quantile_cont(disc, 0.75) AS q3 FROM s2)
SELECT l_orderkey, l_linenumber FROM s2, fd WHERE disc >= q1 - 1.5 * (q3 - q1) AND disc <= q3 + 1.5 * (q3 - q1)"""


def _simultaneous_iqr():
    parts = []
    for c, f in (("qty", "1.5"), ("price", "3.0"), ("disc", "1.5")):
        parts.append(f"{c} BETWEEN (SELECT quantile_cont({c}, 0.25) - {f} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM dl) "
                     f"AND (SELECT quantile_cont({c}, 0.75) + {f} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM dl)")
    return f"WITH {DL} SELECT l_orderkey, l_linenumber FROM dl WHERE " + " AND ".join(parts)


# The ten greatest importances, the planted column first, then by name.
TREE_TOP = ["transaction_hour", *sorted([*[c for c in GOLD_NUM if c not in ("transaction_hour", "is_fraud", "id_flag")],
                                       *[f"cat_{c}" for c in GOLD_CATS]])][:10]


def oracle_sql() -> dict[str, str]:
    pairs = [(a, b) for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]]
    cat_lower = f"lower({norm_cat('raw_cat')})"
    q: dict[str, str] = {
        "clean_csv_flow": csv_flow_sql(),
        "bronze_csv_flow": csv_flow_sql(),
        "bronze_json_flow": json_flow_sql(EVENT_JSON_TRUNCATED),
        "csv_stage_audit": csv_stage_audit_sql(),
        "clean_logs_flow": logs_flow_sql(),
        "gold_union": gold_union_sql(),
        "gold_latest": gold_latest_sql(),
        "coerce_numeric": WITH_CE + "SELECT event_id, value_num FROM coerced_events",
        "coerce_int": f"WITH {DE} SELECT event_id, CAST(trunc({num('raw_hour')}) AS INTEGER) AS hour_int FROM dirty_events",
        "coerce_bool": f"WITH {DE} SELECT event_id, {boolset('raw_flag')} AS flag_set, {boolcast('raw_flag')} AS flag_cast FROM dirty_events",
        "bool_threshold": WITH_CE + "SELECT event_id, value_num / 500.0 >= 0.5 AS is_high FROM coerced_events",
        "bool_to_int": WITH_CE + "SELECT event_id, CAST(flag AS INTEGER) AS flag FROM coerced_events",
        "coerce_timestamp": f"WITH {DE} SELECT event_id, try_cast(raw_ts AS TIMESTAMP) AS ts_parsed FROM dirty_events",
        "conform_typed": """SELECT l_orderkey, try_cast(l_linenumber AS TINYINT) AS l_linenumber,
  try_cast(trunc(l_quantity) AS SMALLINT) AS l_quantity, try_cast(trunc(l_extendedprice) AS SMALLINT) AS l_extendedprice,
  l_returnflag, concat_ws(',',
   CASE WHEN l_orderkey IS NULL THEN 'l_orderkey' END,
   CASE WHEN l_linenumber IS NOT NULL AND try_cast(l_linenumber AS TINYINT) IS NULL THEN 'l_linenumber' END,
   CASE WHEN l_quantity IS NOT NULL AND try_cast(trunc(l_quantity) AS SMALLINT) IS NULL THEN 'l_quantity' END,
   CASE WHEN l_extendedprice IS NOT NULL AND try_cast(trunc(l_extendedprice) AS SMALLINT) IS NULL THEN 'l_extendedprice' END
  ) AS violations FROM lineitem""",
        "flatten_nested": """SELECT o_orderkey, o_totalprice, o_orderstatus, c_custkey, c_name, c_mktsegment, c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey""",
        "drop_sparse": f"WITH {DE} SELECT event_id, raw_hour, raw_cat FROM dirty_events",
        "clamp": WITH_CE + "SELECT event_id, CASE WHEN value_num IS NOT NULL THEN least(greatest(value_num, 0.0), 300.0) END AS value_clamped FROM coerced_events",
        "keep_integral": f"WITH {DE} SELECT event_id, id_num FROM (SELECT event_id, {num('raw_id')} AS id_num FROM dirty_events) WHERE id_num IS NOT NULL AND id_num = floor(id_num)",
        "keep_in": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
        "keep_at_most": WITH_CE + "SELECT event_id, hour_num FROM coerced_events WHERE hour_num <= 24",
        "clean_flag": f"WITH {DE} SELECT event_id, CAST(coalesce({num('raw_flag')}, 0.0) AS INTEGER) AS flag FROM dirty_events WHERE coalesce({num('raw_flag')}, 0.0) IN (0.0, 1.0)",
        "keep_between": WITH_CE + "SELECT event_id, hour_num, value_num FROM coerced_events WHERE hour_num BETWEEN 0 AND 23 AND value_num BETWEEN 0 AND 400",
        "drop_nulls": WITH_CE + "SELECT event_id, value_num, hour_num FROM coerced_events WHERE value_num IS NOT NULL AND hour_num IS NOT NULL",
        "validate_rows": WITH_CE + """, v AS (SELECT event_id, concat_ws(',',
   CASE WHEN NOT coalesce(value_num BETWEEN 0 AND 500, false) THEN 'value_range' END,
   CASE WHEN NOT coalesce(hour_num BETWEEN 0 AND 23, false) THEN 'hour_range' END,
   CASE WHEN flag IS NULL THEN 'flag_known' END) AS violations FROM coerced_events)
SELECT event_id, violations = '' AS _valid, violations FROM v""",
        "count_prefix": f"""WITH {DE} SELECT 'events' AS source, CAST(count_if(starts_with(tx_id, 'TX-2024-4')) AS BIGINT) AS n_rows FROM dirty_events
UNION ALL SELECT 'customer', CAST(count_if(starts_with(CAST(c_custkey AS VARCHAR), 'TX-2024-4')) AS BIGINT) FROM customer""",
        "null_counts": WITH_CE + """SELECT CAST(count_if(value_num IS NULL) AS BIGINT) AS value_num, CAST(count_if(hour_num IS NULL) AS BIGINT) AS hour_num,
  CAST(count_if(flag IS NULL) AS BIGINT) AS flag, CAST(count_if(cat IS NULL) AS BIGINT) AS cat FROM coerced_events""",
        "null_counts_long": WITH_CE + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM coerced_events"
            for c in ("value_num", "hour_num", "flag", "cat")),
        "value_counts": f"""WITH {DE}, c AS (SELECT {title(norm_cat('raw_cat'))} AS category FROM dirty_events)
SELECT category, count(*) AS "count", count(*) / (SELECT count(*) FROM dirty_events) AS share FROM c GROUP BY category""",
        "class_balance": """SELECT toxic, count(*) AS "count", count(*) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY toxic""",
        "distinct_sample": "SELECT DISTINCT event_type FROM events ORDER BY event_type LIMIT 3",
        "numeric_ranges": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) + 0.0 AS min_value, CAST(max({c}) AS DOUBLE) + 0.0 AS max_value FROM lineitem"
            for c in LI_NUM),
        "summary_sketch": " UNION ALL ".join(
            [_sketch_col("lineitem", c, c not in LI_TEXT) for c in LI_ALL]
            + [_sketch_col("documents", c, c in ("doc_id", "n_chars")) for c in ("doc_id", "text", "lang", "source", "n_chars")]),
        "corr_gold": f"WITH {gold_frame()} " + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {_corr(a, b)} AS r" for i, a in enumerate(GOLD_COLS) for b in GOLD_COLS[i + 1:]),
        "label_corr_gold": f"WITH {gold_frame()} " + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {_corr(c, 'is_fraud')} AS r" for c in GOLD_COLS if c != "is_fraud"),
        "csv_rejects": """SELECT CASE WHEN event_id % 211 = 3 THEN 'too many fields' WHEN event_id % 223 = 4 THEN 'too few fields'
   ELSE 'read' END AS outcome, count(*) AS n_rows FROM events GROUP BY 1""",
        "json_file_report": """SELECT event_id // 500 AS file_no, CASE WHEN event_id // 500 % 7 = 1 THEN 0 ELSE count(*) END AS n_rows,
  CASE WHEN event_id // 500 % 7 = 1 THEN 0 ELSE count(*) FILTER (event_id % 89 = 5) END AS n_empty,
  event_id // 500 % 7 = 1 AS rejected, CASE WHEN event_id // 500 % 7 = 1 THEN '[' END AS reject_start
FROM events GROUP BY event_id // 500""",
        "logs_stage_audit": f"""WITH n AS (SELECT count(*) AS lines, count(*) FILTER (NOT ({EVENT_LOG_BROKEN})) AS parsed FROM events)
SELECT 0::INT AS stage_no, 'read' AS stage, lines AS rows, 0::BIGINT AS removed FROM n
UNION ALL SELECT 1, 'parsed', parsed, lines - parsed FROM n UNION ALL SELECT 2, 'dedupe', parsed, 0 FROM n""",
        "json_stage_audit": json_stage_audit_sql(),
        "json_array_flow": json_flow_sql("event_id // 500 % 7 = 1 OR event_id % 89 = 5"),
        "index_hour": f"""WITH silver AS ({csv_flow_sql()}),
n AS (SELECT transaction_hour, row_number() OVER (ORDER BY count(*) DESC, CAST(transaction_hour AS VARCHAR)) - 1 AS idx
  FROM silver WHERE transaction_hour IS NOT NULL GROUP BY transaction_hour),
e AS (SELECT event_id, CASE event_id % 50 WHEN 0 THEN 99 WHEN 1 THEN NULL ELSE hour(ts) END AS transaction_hour FROM events)
SELECT event_id, CAST(coalesce(n.idx, (SELECT count(*) FROM n)) AS DOUBLE) AS hour_idx FROM e LEFT JOIN n USING (transaction_hour)""",
        "append_gate": """SELECT 'table' AS batch, count(*) AS n_rows, CAST(NULL AS BOOLEAN) AS accepted, CAST(NULL AS VARCHAR) AS column_name,
  CAST(NULL AS VARCHAR) AS table_type, CAST(NULL AS VARCHAR) AS incoming_type FROM customer
UNION ALL SELECT 'good', count(*), true, NULL, NULL, NULL FROM customer WHERE c_nationkey >= 20
UNION ALL SELECT 'bad', 0, false, * FROM (VALUES ('c_custkey', 'bigint', 'string'), ('c_acctbal', 'double', NULL),
  ('c_extra', NULL, 'int')) v(a, b, c)""",
        "typed_load_skipping": f"""WITH {DE}, h AS (SELECT CASE WHEN event_id % 3 = 1 THEN 12 ELSE
   try_cast(trunc({num('raw_hour')}) AS TINYINT) END AS hour, CASE WHEN event_id % 3 = 1 THEN '12' ELSE raw_hour END AS raw FROM dirty_events)
SELECT lo AS from_hour, hi AS to_hour, (SELECT count(*) FROM h WHERE hour BETWEEN lo AND hi) AS n_rows, true AS few_files
FROM (VALUES (0, 2), (12, 12), (20, 23)) v(lo, hi)""",
        "bucketed_join": """SELECT c_custkey, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment""",
        "tree_cv": """SELECT i AS impurity, CAST(d AS INTEGER) AS max_depth, 1.0::DOUBLE AS train_accuracy, 1.0::DOUBLE AS cv_accuracy,
  i = 'gini' AND d = 1 AS is_best FROM (VALUES ('gini'), ('entropy')) x(i), range(1, 7) y(d)""",
        "tree_importances": "SELECT feature, importance FROM (VALUES " + ", ".join(
            f"('{c}', {1.0 if c == 'transaction_hour' else 0.0}::DOUBLE)" for c in TREE_TOP) + ") v(feature, importance)",
        "tree_rule_table": """WITH x AS (SELECT CAST(l_quantity > 25 AS INTEGER) AS label FROM lineitem)
SELECT label, label AS by_model, label AS by_rules, count(*) AS n FROM x GROUP BY label""",
        "summary": " UNION ALL ".join(_summary_col(c) for c in LI_ALL),
        "outlier_report": f"WITH {DL} " + " UNION ALL ".join(_outlier_col(c, "1.5") for c in ("qty", "price", "disc")),
        "outlier_examples": f"""WITH {DL}, f AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM dl)
SELECT l_orderkey, l_linenumber, price FROM dl, f WHERE price < q1 - 3.0 * (q3 - q1) OR price > q3 + 3.0 * (q3 - q1)
ORDER BY price DESC, l_orderkey, l_linenumber LIMIT 10""",
        "box_stats": """WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS v FROM documents),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM d)
SELECT 'n_chars' AS column_name, (SELECT min(v) FROM d) AS min_value, round(q1, 6) AS q1, round(med, 6) AS median,
  round(q3, 6) AS q3, (SELECT max(v) FROM d) AS max_value,
  (SELECT min(v) FROM d WHERE v >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  (SELECT max(v) FROM d WHERE v <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  (SELECT count(*) FROM d WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM q""",
        "fences": f"WITH {DL} " + " UNION ALL ".join(_quart("dl", c, "1.5") for c in ("qty", "price", "disc")),
        "fences_disc": f"WITH {DL} " + " UNION ALL ".join(_quart("dl", c, "1.5", True) for c in ("qty", "price", "disc")),
        "duplicate_keys": "SELECT text, count(*) AS repetitions FROM documents GROUP BY text HAVING count(*) > 1",
        "duplicate_rows": "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)",
        "corr_matrix": " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in pairs),
        "label_correlations": " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(corr({c}, CAST(l_returnflag = 'R' AS INTEGER)), 6) AS r FROM lineitem"
            for c in LI_NUM),
        "fill_const": WITH_CE + "SELECT event_id, coalesce(value_num, 0.0) AS value_num, coalesce(cat, 'unknown') AS cat FROM coerced_events",
        "fill_median": WITH_CE + """SELECT event_id,
  round(coalesce(value_num, (SELECT quantile_cont(value_num, 0.5) FROM coerced_events)), 6) AS value_num,
  round(coalesce(hour_num, (SELECT quantile_cont(hour_num, 0.5) FROM coerced_events)), 6) AS hour_num FROM coerced_events""",
        "fill_mean": WITH_CE + "SELECT event_id, round(coalesce(value_num, (SELECT avg(value_num) FROM coerced_events)), 6) AS value_num FROM coerced_events",
        "fill_mode": f"""WITH {DE}, c AS (SELECT event_id, {cat_lower} AS cat FROM dirty_events),
m AS (SELECT cat FROM c WHERE cat IS NOT NULL GROUP BY cat ORDER BY count(*) DESC, cat LIMIT 1)
SELECT event_id, coalesce(c.cat, (SELECT cat FROM m)) AS cat FROM c""",
        "null_if": f"WITH {DE} SELECT event_id, CASE WHEN upper(trim(raw_cat)) = 'NAN' THEN NULL ELSE raw_cat END AS cat FROM dirty_events",
        "iqr_filter_sequential": _sequential_iqr(),
        "iqr_filter_simultaneous": _simultaneous_iqr(),
        "normalize_category": f"WITH {DE} SELECT event_id, {title(norm_cat('raw_cat'))} AS category FROM dirty_events",
        "map_category": """SELECT c_custkey, CASE lower(trim(c_mktsegment)) WHEN 'automobile' THEN 'auto'
  WHEN 'building' THEN 'construction' WHEN 'machinery' THEN 'industrial' ELSE lower(trim(c_mktsegment)) END AS segment FROM customer""",
        "blank_to_null": f"WITH {DE} SELECT event_id, nullif(trim(raw_cat), '') AS cat FROM dirty_events",
        "parse_logs": PARSED,
        "risk_score": f"""WITH p AS ({PARSED}), s AS (SELECT transaction_id, {RISK} AS risk_score FROM p)
SELECT transaction_id, risk_score, CASE WHEN risk_score >= 0.65 THEN 'high' WHEN risk_score >= 0.35 THEN 'medium' ELSE 'low' END AS risk_band FROM s""",
        "relabel_by_prefix": f"""WITH p AS ({PARSED}) SELECT transaction_id,
  CASE WHEN {NOTE} THEN true ELSE is_fraud END AS is_fraud FROM p""",
        "relabel_rule_table": f"""WITH p AS ({PARSED}),
r AS (SELECT DISTINCT printf('TX-2024-0%05d', o_orderkey % 1000) AS prefix FROM orders)
SELECT transaction_id, CASE WHEN substr(transaction_id, 1, 14) IN (SELECT prefix FROM r) THEN true
  ELSE is_fraud END AS is_fraud FROM p""",
        "prefix_flag": f"WITH {DE} SELECT tx_id, CAST(coalesce(starts_with(tx_id, 'TX-2024-4'), false) AS INTEGER) AS id_flag FROM dirty_events",
        "dedupe_rows": "SELECT DISTINCT text, lang, source FROM documents",
        "dedupe_by_key": """SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM (SELECT *, row_number() OVER
  (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
        "resequence": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq FROM orders",
        "velocity_last_24h": """SELECT event_id, count(*) OVER w AS velocity,
  CAST(sum(CAST(round(value, 2) AS DECIMAL(18, 6))) OVER w AS DOUBLE) AS amount_in_range FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)""",
        "unify_sources": UNIFY,
        "unify_latest": UNIFY_LATEST,
        "unify_latest_columns": f"""SELECT order_id, arg_max(amount, priority) AS amount,
  arg_max(status, CASE WHEN status IS NOT NULL THEN priority END) AS status,
  arg_max(source, priority) AS source, max(priority) AS priority FROM ({UNIFY}) GROUP BY order_id""",
        "view_sql": f"SELECT source, count(*) AS n_rows, max(amount) AS max_amount FROM ({UNIFY_LATEST}) GROUP BY source",
        "view_uniqueness": f"SELECT order_id, count(*) AS repetitions FROM ({UNIFY_LATEST}) GROUP BY order_id HAVING count(*) > 1",
        "upsert": UPSERT,
        "update_where": """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
        "delete_where": "SELECT * FROM customer WHERE NOT coalesce(c_mktsegment = 'AUTOMOBILE', false)",
        "append_conformed": """SELECT * FROM customer UNION ALL
SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey >= 20""",
        "diff_versions": f"""WITH o AS ({UPSERT_TARGET}), n AS (SELECT * FROM ({UPSERT}) WHERE c_custkey % 17 <> 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
  CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_name IS DISTINCT FROM n.c_name
  OR o.c_nationkey IS DISTINCT FROM n.c_nationkey OR o.c_acctbal IS DISTINCT FROM n.c_acctbal
  OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment""",
        "index_category": """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
r AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx FROM c)
SELECT e.event_id, CAST(r.idx AS DOUBLE) AS event_type_idx FROM events e JOIN r USING (event_type)""",
        "one_hot": """SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS seg_AUTOMOBILE,
  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS seg_BUILDING, CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS seg_FURNITURE,
  CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS seg_HOUSEHOLD, CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS seg_MACHINERY
FROM customer""",
        "stratified_split": SPLIT,
        "split_report": f"SELECT split, count(*) AS rows, round(avg(CAST(toxic AS DOUBLE)), 6) AS label_rate FROM ({SPLIT}) GROUP BY split",
        "rebalance": f"""WITH c AS (SELECT CAST(count_if(toxic IS NOT DISTINCT FROM 1) AS DOUBLE) AS pos,
  CAST(count_if(toxic IS DISTINCT FROM 1) AS DOUBLE) AS neg FROM labels),
k AS (SELECT least(1.0, (pos * (1.0::DOUBLE - 0.15::DOUBLE) / 0.15::DOUBLE) / neg) AS keep_neg, pos, neg FROM c),
k2 AS (SELECT keep_neg, CASE WHEN keep_neg >= 1.0 THEN least(1.0, (neg * 0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)) / pos) ELSE 1.0 END AS keep_pos FROM k)
SELECT doc_id, toxic FROM labels, k2 WHERE CASE WHEN toxic IS NOT DISTINCT FROM 1
  THEN {HASH42}::DOUBLE / 4294967296.0::DOUBLE < keep_pos ELSE {HASH42}::DOUBLE / 4294967296.0::DOUBLE < keep_neg END""",
        "confusion_matrix": CM,
        "classification_report": REPORT,
        "prediction_counts": f"""WITH {PRED},
a AS (SELECT CAST(a AS DOUBLE) AS class, count(*) AS actual FROM p GROUP BY 1),
b AS (SELECT CAST(p AS DOUBLE) AS class, count(*) AS predicted FROM p GROUP BY 1)
SELECT coalesce(a.class, b.class) AS class, coalesce(actual, 0) AS actual, coalesce(predicted, 0) AS predicted
FROM a FULL OUTER JOIN b ON a.class = b.class""",
        "unparsed_lines": f"SELECT 'cut off ' || CAST(event_id AS VARCHAR) AS value FROM events WHERE {EVENT_LOG_BROKEN}",
        "typed_load": f"""WITH {DE}, d AS (SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '12' ELSE raw_hour END AS raw_hour,
   CASE WHEN event_id % 5 = 0 THEN '900719925474' || lpad(CAST(event_id AS VARCHAR), 7, '0') ELSE raw_id END AS id FROM dirty_events),
t AS (SELECT event_id, id, raw_hour, CAST(trunc(CAST(id AS DECIMAL(38, 10))) AS BIGINT) AS big_id,
   try_cast(trunc({num('raw_hour')}) AS TINYINT) AS hour FROM d)
SELECT event_id, big_id, hour, CASE WHEN raw_hour IS NOT NULL AND hour IS NULL THEN 'hour' ELSE '' END AS violations FROM t""",
        "shared_index": """WITH c AS (SELECT 'customer' AS side, c_custkey AS key, c_mktsegment AS cat FROM customer
  UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'BUILDING' WHEN o_orderkey % 50 = 1 THEN NULL
    ELSE o_orderpriority END FROM orders),
n AS (SELECT cat, row_number() OVER (ORDER BY count(*) DESC, cat) - 1 AS idx FROM c WHERE cat IS NOT NULL GROUP BY cat)
SELECT side, key, CAST(coalesce(n.idx, (SELECT count(*) FROM n)) AS DOUBLE) AS idx FROM c LEFT JOIN n USING (cat)""",
        "model_chain": f"""WITH {gold_frame()}, h AS (SELECT CAST(transaction_hour > 11 AS INTEGER) AS label,
   ('0x' || substr(md5(row_id || ':42'), 1, 8))::BIGINT AS h FROM frame),
t AS (SELECT label, quantile_disc(h, 0.2) AS thr FROM h GROUP BY label)
SELECT CASE WHEN h <= thr THEN 'test' ELSE 'train' END AS split, label, label AS prediction, count(*) AS n
FROM h JOIN t USING (label) GROUP BY ALL""",
        "tree_leaves": "SELECT CAST(x AS INTEGER) AS prediction, CAST(1 AS BIGINT) AS leaves FROM (VALUES (0), (1)) v(x)",
        "load_audit": """SELECT x.event_type, coalesce(c.n, 0) AS n_rows, coalesce(c.n, 0) > 0 AS present
FROM (VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')) x(event_type)
LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) c USING (event_type)""",
    }
    return q
