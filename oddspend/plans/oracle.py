"""Independent ANSI SQL for every query that SQL can express.

Texts are composed of named CTEs: raw -> card (cleaned) -> feats -> enc.
"""

from oddspend import schema as S

P = "OVER (PARTITION BY \"User\" ORDER BY transaction_datetime, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
W = "(PARTITION BY \"User\" ORDER BY transaction_datetime, row_id)"
DEC = 'CAST("Amount" AS DECIMAL(18,6))'
SQ = 'CAST(CAST("Amount" AS DECIMAL(30,6)) * CAST("Amount" AS DECIMAL(30,6)) AS DECIMAL(38,12))'
_HIGH = "(({c} // 2147483648) % 2147483647)"
_MIXED = "((({c} % 2147483648) * 1103515245 + (" + _HIGH + " * 69621) % 2147483647 + {seed}) % 2147483647)"
HASH = "(" + _MIXED + " * 2147483648 + (" + _MIXED + " * 48271 + " + _HIGH + ") % 2147483647)"

TXN = """txn AS (SELECT event_id AS row_id, user_id AS "User", ts AS transaction_datetime, value AS "Amount",
 CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS "Merchant Name", event_type AS channel,
 CAST(event_type = 'error' AS INT) AS is_fraud, CAST(hour(ts) AS BIGINT) AS txn_hour,
 CAST(isodow(ts) - 1 AS BIGINT) AS txn_day_of_week FROM events)"""

ORDERS = """txn AS (SELECT o_orderkey AS row_id, o_custkey AS "User", o_orderdate AS transaction_datetime, o_totalprice AS "Amount",
 o_orderpriority AS "Merchant Name", o_orderstatus AS status, CAST(o_orderstatus = 'P' AS INT) AS is_fraud,
 CAST(hour(o_orderdate) AS BIGINT) AS txn_hour, CAST(isodow(o_orderdate) - 1 AS BIGINT) AS txn_day_of_week FROM orders)"""

LINES = """txn AS (SELECT o_custkey AS "User", l_shipdate AS transaction_datetime, l_extendedprice AS "Amount",
 l_suppkey AS "Merchant Name", l_returnflag, l_linestatus, l_quantity, l_discount, l_tax,
 CAST(l_returnflag = 'R' AS INT) AS is_fraud, CAST(hour(l_shipdate) AS BIGINT) AS txn_hour,
 CAST(isodow(l_shipdate) - 1 AS BIGINT) AS txn_day_of_week FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def raw(junk=False):
    bad = "WHEN event_id % 211 = 0 THEN 'n/a'" if junk else ""
    return f"""ev AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
one AS (SELECT event_id AS row_id, user_id AS "User", event_id % 3 AS "Card", CAST(year(ts) AS INT) AS "Year",
 CAST(CASE WHEN event_id % 307 = 0 THEN 2 ELSE month(ts) END AS INT) AS "Month",
 CAST(CASE WHEN event_id % 307 = 0 THEN 30 ELSE day(ts) END AS INT) AS "Day",
 CASE WHEN event_id % 401 = 0 THEN '25:61' WHEN event_id % 403 = 0 THEN '7' WHEN event_id % 409 = 0 THEN 'xx:10'
  ELSE strftime(ts, '%H:%M') END AS "Time",
 CASE WHEN event_id % 97 = 0 THEN NULL {bad}
  WHEN event_id % 29 = 0 THEN '$-' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
  ELSE '$' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS "Amount",
 CASE WHEN event_id % 41 = 0 THEN NULL WHEN k % 3 = 0 THEN 'Chip Transaction' WHEN k % 3 = 1 THEN 'Swipe Transaction'
  ELSE 'Online Transaction' END AS "Use Chip",
 k AS "Merchant Name", 'City' || (k % 20) AS "Merchant City",
 CASE WHEN k % 3 = 2 THEN NULL ELSE 'S' || (k % 7) END AS "Merchant State",
 CASE WHEN k % 3 = 2 THEN NULL ELSE CAST(10000 + k AS DOUBLE) END AS "Zip", CAST(5000 + k % 12 AS INT) AS "MCC",
 CASE WHEN event_id % 50 = 0 THEN 'Insufficient Balance' END AS "Errors?",
 CASE WHEN event_type = 'error' THEN 'Yes' WHEN event_id % 503 = 0 THEN 'Maybe' ELSE 'No' END AS "Is Fraud?" FROM ev),
raw AS (SELECT * FROM one UNION ALL SELECT * REPLACE (row_id + 1000000000000 AS row_id) FROM one WHERE row_id % 101 = 0)"""


AMT = "TRY_CAST(regexp_replace(\"Amount\", '[$,]', '', 'g') AS DOUBLE)"


def piece(i, top):
    return (f"CAST(trunc(least(greatest(coalesce(TRY_CAST(split_part(\"Time\", ':', {i}) AS DOUBLE), 0), 0), {top})) AS BIGINT)")


PARSED = f"""parsed AS (SELECT * REPLACE ({AMT} AS "Amount"),
 CAST(TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}} {{:02d}}:{{:02d}}:00', "Year", "Month", "Day", {piece(1, 23)}, {piece(2, 59)})
  AS TIMESTAMP) AS TIMESTAMP) AS transaction_datetime FROM raw),
timed AS (SELECT *, CAST(hour(transaction_datetime) AS BIGINT) AS txn_hour,
 CAST(isodow(transaction_datetime) - 1 AS BIGINT) AS txn_day_of_week FROM parsed WHERE transaction_datetime IS NOT NULL)"""
FILL = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), 'UNKNOWN') AS \"{c}\"" for c in S.CATEGORICALS)
CLEAN_COLS = [*S.RAW_COLUMNS, S.TS, S.HOUR, S.WEEKDAY]
_C = ", ".join(f'"{c}"' for c in CLEAN_COLS)
CARD = f"""{raw()}, {PARSED},
filled AS (SELECT * REPLACE ({FILL}, coalesce("Zip", -1) AS "Zip",
 coalesce("Amount", (SELECT median("Amount") FROM timed)) AS "Amount") FROM timed),
uniq AS (SELECT min(row_id) AS row_id, {_C} FROM filled GROUP BY {_C}),
bound AS (SELECT round(quantile_cont("Amount", 0.001), 6) AS lo, round(quantile_cont("Amount", 0.999), 6) AS hi FROM uniq),
txn AS (SELECT * EXCLUDE ("Is Fraud?", lo, hi) REPLACE (CASE WHEN "Amount" < lo THEN lo WHEN "Amount" > hi THEN hi ELSE "Amount" END AS "Amount"),
 CAST(coalesce("Is Fraud?" = 'Yes', FALSE) AS INT) AS is_fraud FROM uniq, bound)"""

# casts through text round the exact decimal once
HIST = f"""h0 AS (SELECT *, row_number() OVER {W} - 1 AS n,
 CAST(CAST(sum({DEC}) {P} AS VARCHAR) AS DOUBLE) AS s1,
 CAST(CAST(sum({SQ}) {P} AS VARCHAR) AS DOUBLE) AS s2,
 max({DEC}) {P} AS mx, min({DEC}) {P} AS mn,
 (epoch_us(transaction_datetime) - lag(epoch_us(transaction_datetime)) OVER {W}) / 60000000.0::DOUBLE AS gap,
 CAST(CAST(sum({DEC}) OVER (PARTITION BY "User" ORDER BY transaction_datetime, row_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS VARCHAR) AS DOUBLE) AS roll,
 count(*) OVER (PARTITION BY "User" ORDER BY epoch_us(transaction_datetime) RANGE BETWEEN UNBOUNDED PRECEDING AND 3600000001 PRECEDING) AS old,
 CAST(row_number() OVER (PARTITION BY "User", "Merchant Name" ORDER BY transaction_datetime, row_id) = 1 AS INT) AS new_m,
 CAST(row_number() OVER (PARTITION BY "User", CAST(transaction_datetime AS DATE) ORDER BY transaction_datetime, row_id) = 1 AS INT) AS new_d FROM txn),
h1 AS (SELECT *, CASE WHEN n > 0 THEN s1 / n END AS mean, greatest(coalesce(sum(new_d) {P}, 0), 1) AS days,
 CAST(coalesce(sum(new_m) {P}, 0) AS BIGINT) AS merchants,
 CASE WHEN n > 1 AND mx > mn THEN (n * s2 - s1 * s1) / (n * (n - 1)) END AS var FROM h0),
mstat AS (SELECT "Merchant Name", c, s1 / c AS m_mean, CASE WHEN c > 1 AND mx > mn THEN (c * s2 - s1 * s1) / (c * (c - 1)) END AS m_var FROM (
 SELECT "Merchant Name", count(*) AS c, CAST(CAST(sum({DEC}) AS VARCHAR) AS DOUBLE) AS s1,
 CAST(CAST(sum({SQ}) AS VARCHAR) AS DOUBLE) AS s2, max({DEC}) AS mx, min({DEC}) AS mn
 FROM txn WHERE "Merchant Name" IS NOT NULL GROUP BY 1)),
feats AS (SELECT h1.* EXCLUDE (n, s1, s2, mx, mn, gap, roll, old, new_m, new_d, mean, days, merchants, var),
 coalesce(mean, "Amount") AS customer_avg_amount, coalesce(CAST(mx AS DOUBLE), "Amount") AS customer_max_amount,
 CAST(n AS BIGINT) AS customer_txn_count,
 coalesce(c / CAST((SELECT count("Merchant Name") FROM txn) AS DOUBLE), 0) AS merchant_txn_frequency,
 coalesce(s1, 0) / days AS avg_daily_spending,
 CAST(txn_day_of_week IN (5, 6) AS BIGINT) AS weekend_indicator, CAST(txn_hour BETWEEN 9 AND 17 AS BIGINT) AS business_hour_indicator,
 coalesce(gap, (SELECT median(gap) FROM h0), 0) AS time_since_prev_txn,
 CASE WHEN n > 0 THEN roll / least(n, 5) ELSE "Amount" END AS rolling_avg_amount,
 CAST(n - old AS BIGINT) AS transaction_velocity, merchants AS merchant_diversity,
 CAST(n AS DOUBLE) / days AS customer_activity_frequency,
 CASE WHEN var > 0 THEN ("Amount" - mean) / sqrt(var) ELSE 0 END AS amount_deviation_from_customer_mean,
 CASE WHEN m_var > 0 THEN ("Amount" - m_mean) / sqrt(m_var) ELSE 0 END AS amount_zscore_by_merchant
 FROM h1 LEFT JOIN mstat USING ("Merchant Name"))"""

INTS = {"customer_txn_count", "weekend_indicator", "business_hour_indicator", "transaction_velocity", "merchant_diversity"}


def r6(c, alias=None):
    return f'round("{c}", 6) AS "{alias or c}"'


def plain(c):
    """Unrounded: both engines divide the same exact sums, so the bits agree."""
    return f'CAST("{c}" AS DOUBLE) AS "{c}"'


#: The features that look at the customer's own payments only.
OWN_FEATURES = [c for c in S.FEATURES if c.startswith("customer_")] + [
    "avg_daily_spending", "time_since_prev_txn", "rolling_avg_amount", "transaction_velocity", "merchant_diversity", "amount_deviation_from_customer_mean"]
FEATURE_LIST = ", ".join(f'"{c}"' if c in INTS else plain(c) for c in S.FEATURES)


def split(src="feats", seed=42):
    h = HASH.format(c="row_id", seed=seed)
    return f"""split0 AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {h}, row_id) AS rk,
 count(*) OVER (PARTITION BY is_fraud) AS cnt FROM {src}),
parts AS (SELECT * EXCLUDE (rk, cnt), CASE WHEN rk <= ceil(round(cnt * 0.2::DOUBLE, 9)) THEN 'test' ELSE 'train' END AS split FROM split0)"""


CATS = [*S.CATEGORICALS, S.MERCHANT]
FREQ = "freq AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST(\"{c}\" AS VARCHAR) AS val, count(*) AS n, count(*) / CAST((SELECT count(*) FROM parts WHERE split = 'train') AS DOUBLE) AS f "
    f"FROM parts WHERE split = 'train' GROUP BY 2" for c in CATS) + ")"
SCALE = "sc AS (SELECT " + ", ".join(
    f'avg("{c}"::DOUBLE) AS "m_{c}", stddev_pop("{c}"::DOUBLE) AS "s_{c}"' for c in S.NUMERIC_INPUTS) + " FROM parts WHERE split = 'train')"
ENC_COLS = [f"{c}_freq" for c in CATS] + [f"{c}_scaled" for c in S.NUMERIC_INPUTS]
ENC = "enc AS (SELECT parts.*, " + ", ".join(
    f"coalesce((SELECT f FROM freq WHERE col = '{c}' AND val = CAST(\"{c}\" AS VARCHAR)), (SELECT min(f) FROM freq WHERE col = '{c}')) AS \"{c}_freq\""
    for c in CATS) + ", " + ", ".join(
    f'(parts."{c}" - sc."m_{c}") / CASE WHEN sc."s_{c}" = 0 THEN 1 ELSE sc."s_{c}" END AS "{c}_scaled"' for c in S.NUMERIC_INPUTS) + " FROM parts, sc)"

SCORED = """scored AS (SELECT 'customer_deviation' AS model, row_id, abs(amount_deviation_from_customer_mean) AS score, is_fraud AS label FROM feats
 UNION ALL SELECT 'merchant_zscore', row_id, abs(amount_zscore_by_merchant), is_fraud FROM feats),
cutoff AS (SELECT model, quantile_cont(score, 0.98) AS cut FROM scored GROUP BY 1),
rows1 AS (SELECT scored.*, CAST(score >= cut AS INT) AS flag FROM scored JOIN cutoff USING (model)),
g AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM rows1 GROUP BY 1, 2),
t AS (SELECT *, sum(p) OVER a AS tp, sum(n) OVER a AS fp, sum(p) OVER (PARTITION BY model) AS pos, sum(n) OVER (PARTITION BY model) AS neg
 FROM g WINDOW a AS (PARTITION BY model ORDER BY score DESC)),
areas AS (SELECT model, sum(p * (neg - fp + n / 2.0::DOUBLE)) / (max(pos)::DOUBLE * max(neg)::DOUBLE) AS roc_auc,
 sum(p * tp / (tp + fp)::DOUBLE) / max(pos)::DOUBLE AS average_precision FROM t GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, row_id) AS rn FROM rows1),
ks AS (SELECT unnest([50, 100, 500]) AS k),
atk AS (SELECT model, CAST(k AS BIGINT) AS k, sum(label) FILTER (WHERE rn <= k) AS hits, count(*) AS total, sum(label) AS positives FROM ranked, ks GROUP BY 1, 2),
cls AS (SELECT model, CAST(sum(flag) AS BIGINT) AS n_flagged, CAST(sum(label) AS BIGINT) AS n_actual_fraud, CAST(sum(flag * label) AS BIGINT) AS n_flagged_correctly FROM rows1 GROUP BY 1),
cls2 AS (SELECT model, coalesce(n_flagged_correctly / nullif(n_flagged, 0)::DOUBLE, 0) AS "precision", coalesce(n_flagged_correctly / nullif(n_actual_fraud, 0)::DOUBLE, 0) AS recall,
 coalesce(2 * n_flagged_correctly / nullif(n_flagged + n_actual_fraud, 0)::DOUBLE, 0) AS f1, n_flagged, n_actual_fraud, n_flagged_correctly FROM cls),
wide AS (SELECT a.model, roc_auc, average_precision,
 max(hits / least(k, total)::DOUBLE) FILTER (WHERE k = 50) AS precision_at_50, max(hits / positives::DOUBLE) FILTER (WHERE k = 50) AS recall_at_50,
 max(hits / least(k, total)::DOUBLE) FILTER (WHERE k = 100) AS precision_at_100, max(hits / positives::DOUBLE) FILTER (WHERE k = 100) AS recall_at_100,
 max(hits / least(k, total)::DOUBLE) FILTER (WHERE k = 500) AS precision_at_500, max(hits / positives::DOUBLE) FILTER (WHERE k = 500) AS recall_at_500,
 max(total) AS n_test_rows FROM areas a JOIN atk USING (model) GROUP BY 1, 2, 3)"""

FLAGGED = """sc0 AS (SELECT *, abs(amount_deviation_from_customer_mean) AS anomaly_score FROM feats),
fl AS (SELECT *, CAST(anomaly_score >= (SELECT quantile_cont(anomaly_score, 0.98) FROM sc0) AS INT) AS is_anomaly FROM sc0)"""


def hist_sql(src, value, bins):
    return f"""vals AS (SELECT {value} AS v FROM {src}), ends AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
wid AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1 END AS w FROM ends)
SELECT bin, round(lo + bin * w, 6) AS lo, round(lo + (bin + 1) * w, 6) AS hi, count(*) AS n FROM (
 SELECT CAST(least(floor((v - lo) / w), {bins - 1}) AS BIGINT) AS bin, lo, w FROM vals, wid WHERE v IS NOT NULL) GROUP BY bin, lo, w"""


def with_(*parts):
    return "WITH " + ", ".join(parts) + " "


def describe_sql(src, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(\"{c}\") AS count, round(avg(\"{c}\"::DOUBLE), 7) AS mean, round(stddev_samp(\"{c}\"::DOUBLE), 7) AS std, "
        f"min(\"{c}\")::DOUBLE AS min, round(quantile_cont(\"{c}\"::DOUBLE, 0.25), 6) AS p25, round(quantile_cont(\"{c}\"::DOUBLE, 0.5), 6) AS p50, "
        f"round(quantile_cont(\"{c}\"::DOUBLE, 0.75), 6) AS p75, max(\"{c}\")::DOUBLE AS max FROM {src}" for c in cols)


def describe_text_sql(src, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", "
        f"arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT CAST(\"{c}\" AS VARCHAR) AS v, count(*) AS n FROM {src} WHERE \"{c}\" IS NOT NULL GROUP BY 1)" for c in cols)


MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS missing, round(100.0::DOUBLE * count(*) FILTER (WHERE \"{c}\" IS NULL) / count(*), 3) AS pct FROM raw"
    for c in S.RAW_COLUMNS)
_RC = ", ".join(f'"{c}"' for c in S.RAW_COLUMNS)
DUPES = f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicate_rows FROM (SELECT count(*) AS n FROM raw GROUP BY {_RC})"
CARDINAL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") AS n_distinct FROM raw" for c in [S.MERCHANT, *S.CATEGORICALS, S.USER, S.CARD])
CORR_COLS = ["Amount", "customer_avg_amount", "rolling_avg_amount", "transaction_velocity", "time_since_prev_txn", "amount_zscore_by_merchant"]


def explain_ctes():
    items = ", ".join(f"{{'pos': {i}, 'feature': '{c}', 'v': \"{c}\"}}" for i, c in enumerate(ENC_COLS))
    return f"""ref AS (SELECT u.feature AS feature, avg(u.v) AS m, stddev_pop(u.v) AS s FROM (SELECT unnest([{items}]) AS u FROM enc WHERE split = 'train') GROUP BY 1),
cutx AS (SELECT quantile_cont(abs(amount_deviation_from_customer_mean), 0.98) AS c FROM enc),
long AS (SELECT row_id, unnest([{items}]) AS u FROM enc, cutx WHERE abs(amount_deviation_from_customer_mean) >= c),
z AS (SELECT row_id, u.pos AS pos, u.feature AS feature, u.v AS v, m, (u.v - m) / CASE WHEN s < 1e-9 THEN 1 ELSE s END AS z FROM long JOIN ref ON ref.feature = u.feature),
rk AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(z) DESC, pos) AS rank FROM z),
words AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in S.DESCRIPTIONS.items())}) AS w(base, says)),
said AS (SELECT rk.*, coalesce(says, regexp_replace(feature, '_(scaled|freq)$', '')) AS description FROM rk LEFT JOIN words ON base = regexp_replace(feature, '_(scaled|freq)$', ''))"""


def knn_ctes(k):
    d = "list_sum(list_transform(range(1, 65), lambda i: (a.e[i] - b.e[i]) * (a.e[i] - b.e[i])))"
    return f"""v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
pairs AS (SELECT a.id AS id, b.id AS nbr, sqrt({d}) AS dist FROM v a, v b WHERE a.id <> b.id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM pairs) WHERE rank <= {k}),
kd AS (SELECT id, max(dist) AS kdist FROM knn GROUP BY 1),
lrd AS (SELECT knn.id AS id, 1 / (avg(greatest(dist, kdist)) + 1e-10::DOUBLE) AS lrd FROM knn JOIN kd ON kd.id = nbr GROUP BY 1),
lof AS (SELECT knn.id AS id, avg(o.lrd) / any_value(s.lrd) AS lof FROM knn JOIN lrd o ON o.id = nbr JOIN lrd s ON s.id = knn.id GROUP BY 1)"""


def _feature(*cols, src=TXN):
    return with_(src, HIST) + "SELECT row_id, " + ", ".join(f'"{c}"' if c in INTS else plain(c) for c in cols) + " FROM feats"


def oracle_sql():
    T, TS = with_(TXN), with_(TXN, HIST, SCORED)
    F_, L = with_(TXN, HIST, FLAGGED), with_(LINES)
    R, RJ, C = with_(raw()), with_(raw(True)), with_(CARD)
    CF = with_(CARD, HIST, FLAGGED)
    E = with_(CARD, HIST, split(), FREQ, SCALE, ENC)
    raw_cols = _RC
    clean_cols = ", ".join(f'"{c}"' for c in ["row_id", *[c for c in CLEAN_COLS if c != "Is Fraud?"], "is_fraud"])
    n_users = "greatest(1, floor((SELECT count(*) FROM users) * 0.05 + 0.5))"
    return {
        "suspicious_now": with_(TXN, HIST) + """SELECT row_id, "User", round("Amount", 6) AS "Amount", customer_txn_count, transaction_velocity,
 round(customer_avg_amount, 6) AS customer_avg_amount, round(amount_deviation_from_customer_mean, 6) AS amount_deviation_from_customer_mean
 FROM feats WHERE abs(amount_deviation_from_customer_mean) > 3 AND transaction_velocity >= 1 ORDER BY abs(amount_deviation_from_customer_mean) DESC, row_id""",
        "scan_project": R + f"SELECT {raw_cols} FROM raw",
        "user_sample": R + f""", users AS (SELECT DISTINCT "User" AS u FROM raw), pick AS (SELECT u, row_number() OVER (ORDER BY {HASH.format(c='u', seed=42)}, u) AS rk FROM users)
SELECT row_id, "User" FROM raw WHERE "User" IN (SELECT u FROM pick WHERE rk <= {n_users})""",
        "head_n": R + 'SELECT row_id, "User", "Amount" FROM raw ORDER BY row_id LIMIT 1000',
        "parquet_roundtrip": with_(TXN, HIST) + f"SELECT row_id, is_fraud, {FEATURE_LIST} FROM feats",
        "profile_counts": R + "SELECT count(*) AS n_rows, CAST(15 AS BIGINT) AS n_cols FROM raw",
        "profile_missing": R + f"SELECT * FROM ({MISSING}) WHERE missing > 0",
        "profile_duplicates": R + DUPES,
        "profile_cardinality": R + CARDINAL,
        "profile_amount": RJ + f"SELECT count(*) FILTER (WHERE {AMT} < 0) AS n_negative, count(*) FILTER (WHERE {AMT} IS NULL) AS n_non_numeric FROM raw",
        "profile_labels": R + "SELECT count(*) FILTER (WHERE \"Is Fraud?\" NOT IN ('Yes', 'No')) AS n_unexpected_labels FROM raw",
        "profile_report": RJ + f"""SELECT 'n_rows' AS metric, NULL::VARCHAR AS "column", count(*)::DOUBLE AS "value" FROM raw UNION ALL SELECT 'n_cols', NULL, 15
UNION ALL SELECT 'missing', "column", missing FROM ({MISSING}) WHERE missing > 0 UNION ALL SELECT 'missing_pct', "column", pct FROM ({MISSING}) WHERE missing > 0
UNION ALL SELECT 'duplicate_rows', NULL, n_duplicate_rows FROM ({DUPES}) UNION ALL SELECT 'cardinality', "column", n_distinct FROM ({CARDINAL})
UNION ALL SELECT 'negative', 'Amount', count(*) FILTER (WHERE {AMT} < 0) FROM raw UNION ALL SELECT 'non_numeric', 'Amount', count(*) FILTER (WHERE {AMT} IS NULL) FROM raw
UNION ALL SELECT 'unexpected_labels', 'Is Fraud?', count(*) FILTER (WHERE "Is Fraud?" NOT IN ('Yes', 'No')) FROM raw""",
        "describe_numeric": L + describe_sql("txn", ["Amount", "l_quantity", "l_discount", "l_tax"]),
        "describe_text": R + describe_text_sql("raw", ["Use Chip", "Merchant City", "Merchant State", "Errors?", "Is Fraud?"]),
        "clean_amount": R + f'SELECT row_id, {AMT} AS "Amount" FROM raw',
        "parse_datetime": with_(raw(), PARSED) + "SELECT row_id, transaction_datetime, txn_hour, txn_day_of_week FROM timed",
        "time_parts": L + 'SELECT "User", transaction_datetime, txn_hour, txn_day_of_week, count(*) AS n FROM txn GROUP BY ALL',
        "fill_missing": R + f'SELECT row_id, {FILL}, coalesce("Zip", -1) AS "Zip" FROM raw',
        "impute_median": R + f', a AS (SELECT row_id, {AMT} AS v FROM raw) SELECT row_id, round(coalesce(v, (SELECT median(v) FROM a)), 6) AS "Amount" FROM a',
        "dedupe_rows": R + f"SELECT min(row_id) AS row_id, {raw_cols} FROM raw GROUP BY {raw_cols}",
        "dedupe_subset": R + """SELECT row_id, "User", "Merchant Name", "Day", "Amount" FROM (SELECT *, row_number() OVER (PARTITION BY "User", "Merchant Name", "Day" ORDER BY row_id) AS rn FROM raw) WHERE rn = 1""",
        "winsorize": L + """, b AS (SELECT round(quantile_cont("Amount", 0.001), 6) AS lo, round(quantile_cont("Amount", 0.999), 6) AS hi FROM txn)
SELECT round(CASE WHEN "Amount" < lo THEN lo WHEN "Amount" > hi THEN hi ELSE "Amount" END, 6) AS "Amount", count(*) AS n FROM txn, b GROUP BY 1""",
        "extract_label": R + "SELECT row_id, CAST(coalesce(\"Is Fraud?\" = 'Yes', FALSE) AS INT) AS is_fraud FROM raw",
        "clean_full": C + f"SELECT {clean_cols} FROM txn",
        "min_history_filter": with_(ORDERS) + """SELECT row_id, "User" FROM txn WHERE "User" IN (SELECT "User" FROM txn GROUP BY 1 HAVING count(*) >= 5)""",
        "feat_customer_avg": _feature("customer_avg_amount"),
        "feat_customer_max": _feature("customer_max_amount"),
        "feat_customer_count": _feature("customer_txn_count"),
        "feat_amount_deviation": _feature("amount_deviation_from_customer_mean"),
        "feat_merchant_freq": _feature("merchant_txn_frequency"),
        "feat_merchant_zscore": _feature("amount_zscore_by_merchant"),
        "feat_time_flags": _feature("weekend_indicator", "business_hour_indicator"),
        "feat_time_since_prev": _feature("time_since_prev_txn"),
        "feat_rolling_avg": _feature("rolling_avg_amount"),
        "feat_velocity": _feature("transaction_velocity"),
        "feat_merchant_diversity": _feature("merchant_diversity"),
        "feat_daily_spend": _feature("avg_daily_spending"),
        "feat_activity_freq": _feature("customer_activity_frequency"),
        "features_full": with_(TXN, HIST) + f"SELECT row_id, {FEATURE_LIST} FROM feats",
        "features_orders": with_(ORDERS, HIST) + f"SELECT row_id, {FEATURE_LIST} FROM feats",
        "features_card": with_(CARD, HIST) + f"SELECT row_id, {FEATURE_LIST} FROM feats",
        "customer_profiles": T + f""", o AS (SELECT *, epoch_us(transaction_datetime) AS us, CAST(transaction_datetime AS DATE) AS d,
 row_number() OVER (PARTITION BY "User" ORDER BY transaction_datetime DESC, row_id DESC) AS back,
 max(epoch_us(transaction_datetime)) OVER (PARTITION BY "User") AS last_us FROM txn),
m AS (SELECT "User", count(*) AS nm FROM (SELECT DISTINCT "User", "Merchant Name" FROM txn) GROUP BY 1)
SELECT "User", count(*) AS n, CAST(CAST(sum({DEC}) AS VARCHAR) AS DOUBLE) AS s1, CAST(CAST(sum({SQ}) AS VARCHAR) AS DOUBLE) AS s2,
 CAST(max({DEC}) AS DOUBLE) AS mx, CAST(min({DEC}) AS DOUBLE) AS mn, count(DISTINCT d) AS nd, any_value(nm) AS nm,
 count(*) FILTER (WHERE us < last_us - 3600000000) AS old, arg_min(row_id, (us, row_id)) AS first_id, arg_max(row_id, (us, row_id)) AS last_id,
 CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day,
 CAST(CAST(sum({DEC}) FILTER (WHERE back <= 5) AS VARCHAR) AS DOUBLE) AS tail_sum FROM o JOIN m USING ("User") GROUP BY 1""",
        "profiled_features": with_(TXN, HIST) + """, o AS (SELECT row_id, epoch_us(transaction_datetime) AS us FROM txn), c AS (SELECT us AS cut FROM (SELECT us, row_number() OVER (ORDER BY us) AS rn FROM o) WHERE rn = (SELECT greatest(1, CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT)) FROM o))
SELECT row_id, """ + ", ".join("gap AS time_since_prev_txn" if c == "time_since_prev_txn" else f'"{c}"' if c in INTS else plain(c) for c in OWN_FEATURES) + """
 FROM feats JOIN (SELECT row_id, gap FROM h0) USING (row_id) JOIN o USING (row_id), c WHERE us > cut""",
        "merchant_stats_lines": L + f""", m AS (SELECT "Merchant Name", count(*) AS m_count, CAST(CAST(sum({DEC}) AS VARCHAR) AS DOUBLE) AS s1, CAST(CAST(sum({SQ}) AS VARCHAR) AS DOUBLE) AS s2 FROM txn GROUP BY 1)
SELECT "Merchant Name", m_count, round(s1 / m_count, 6) AS m_mean, round(sqrt((m_count * s2 - s1 * s1) / (m_count * (m_count - 1))), 4) AS m_std FROM m""",
        "stratified_split": with_(TXN, split("txn")) + "SELECT row_id, is_fraud, split FROM parts",
        "time_split": T + """, o AS (SELECT row_id, epoch_us(transaction_datetime) AS us FROM txn), c AS (SELECT us AS cut FROM (SELECT us, row_number() OVER (ORDER BY us) AS rn FROM o) WHERE rn = (SELECT greatest(1, CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT)) FROM o))
SELECT row_id, CASE WHEN us > cut THEN 'test' ELSE 'train' END AS split FROM o, c""",
        "freq_fit": with_(CARD, split("txn"), FREQ) + 'SELECT col AS "column", val AS "value", n, round(f, 6) AS freq FROM freq',
        "freq_transform": E + "SELECT row_id, " + ", ".join(r6(f"{c}_freq") for c in CATS) + " FROM enc",
        "scale_standard": E + "SELECT row_id, " + ", ".join(r6(f"{c}_scaled") for c in S.NUMERIC_INPUTS) + " FROM enc",
        "scale_robust": L + """, q AS (SELECT quantile_cont("Amount", 0.25) AS a, median("Amount") AS m, quantile_cont("Amount", 0.75) AS b, quantile_cont(l_tax, 0.25) AS ta, median(l_tax) AS tm, quantile_cont(l_tax, 0.75) AS tb FROM txn)
SELECT round(("Amount" - m) / CASE WHEN b = a THEN 1 ELSE b - a END, 6) AS "Amount_scaled", round((l_tax - tm) / CASE WHEN tb = ta THEN 1 ELSE tb - ta END, 6) AS l_tax_scaled, count(*) AS n FROM txn, q GROUP BY 1, 2""",
        "scale_minmax": L + """, q AS (SELECT min("Amount") AS a, max("Amount") AS b, min(l_quantity) AS c, max(l_quantity) AS d FROM txn)
SELECT round(("Amount" - a) / CASE WHEN b = a THEN 1 ELSE b - a END, 6) AS "Amount_scaled", round((l_quantity - c) / CASE WHEN d = c THEN 1 ELSE d - c END, 6) AS l_quantity_scaled, count(*) AS n FROM txn, q GROUP BY 1, 2""",
        "encode_full": E + "SELECT row_id, split, is_fraud, " + ", ".join(r6(c) for c in ENC_COLS) + " FROM enc",
        "score_threshold": TS + "SELECT model, round(cut, 6) AS threshold FROM cutoff",
        "flag_anomalies": TS + "SELECT model, row_id, flag FROM rows1",
        "normalize_score": TS + ", e AS (SELECT model, min(score) AS lo, max(score) AS hi FROM scored GROUP BY 1) SELECT model, row_id, round(CASE WHEN hi - lo < 1e-12 THEN 0 ELSE (score - lo) / (hi - lo) END, 6) AS normalized FROM scored JOIN e USING (model)",
        "fixed_sample": T + f"SELECT row_id FROM txn ORDER BY {HASH.format(c='row_id', seed=42)}, row_id LIMIT 400",
        "knn_edges": with_(knn_ctes(35)) + "SELECT id, nbr, CAST(rank AS BIGINT) AS rank, round(dist, 6) AS dist FROM knn",
        "lof_score": with_(knn_ctes(35)) + "SELECT id AS row_id, round(lof, 6) AS lof FROM lof",
        "mahalanobis_score": with_(TXN, HIST) + """, x AS (SELECT row_id, "Amount" AS a, rolling_avg_amount AS b FROM feats), c AS (SELECT avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab FROM x)
SELECT row_id, round((vb * (a - ma) * (a - ma) - 2 * ab * (a - ma) * (b - mb) + va * (b - mb) * (b - mb)) / (va * vb - ab * ab), 5) AS distance FROM x, c""",
        "precision_at_k": TS + "SELECT model, k, round(hits / least(k, total)::DOUBLE, 6) AS precision_at_k FROM atk",
        "recall_at_k": TS + "SELECT model, k, round(hits / positives::DOUBLE, 6) AS recall_at_k FROM atk",
        "roc_auc": TS + "SELECT model, round(roc_auc, 6) AS roc_auc FROM areas",
        "average_precision": TS + "SELECT model, round(average_precision, 6) AS average_precision FROM areas",
        "ranking_metrics": TS + """SELECT model, 'roc_auc' AS metric, round(roc_auc, 6) AS "value" FROM areas UNION ALL SELECT model, 'average_precision', round(average_precision, 6) FROM areas
UNION ALL SELECT model, 'precision_at_' || k, round(hits / least(k, total)::DOUBLE, 6) FROM atk UNION ALL SELECT model, 'recall_at_' || k, round(hits / positives::DOUBLE, 6) FROM atk""",
        "classification_metrics": TS + 'SELECT model, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, n_flagged, n_actual_fraud, n_flagged_correctly FROM cls2',
        "roc_curve": TS + """SELECT model, round(fp / neg::DOUBLE, 6) AS fpr, round(tp / pos::DOUBLE, 6) AS tpr, round(score, 6) AS threshold FROM t WHERE pos > 0 AND neg > 0
UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE FROM t WHERE pos > 0 AND neg > 0""",
        "pr_curve": TS + """SELECT model, round(tp / (tp + fp)::DOUBLE, 6) AS "precision", round(tp / pos::DOUBLE, 6) AS recall, round(score, 6) AS threshold FROM t WHERE pos > 0 AND neg > 0
UNION ALL SELECT DISTINCT model, 1.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE FROM t WHERE pos > 0 AND neg > 0""",
        "evaluate_models": TS + "SELECT wide.model, " + ", ".join(f"round({c}, 6) AS {c}" for c in ["roc_auc", "average_precision", *[f"{m}_at_{k}" for k in (50, 100, 500) for m in ("precision", "recall")]]) + ', round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, n_flagged, n_actual_fraud, n_flagged_correctly, n_test_rows FROM wide JOIN cls2 USING (model)',
        "model_table": TS + "SELECT model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM wide ORDER BY roc_auc DESC, model",
        "recommend_model": TS + """, m AS (SELECT *, CASE model WHEN 'customer_deviation' THEN 0.4 ELSE 0.2 END AS sec, max(roc_auc) OVER () AS best FROM areas), near AS (SELECT * FROM m WHERE best - roc_auc <= 0.02::DOUBLE)
SELECT model AS recommended_model, 'roc_auc' AS primary_metric, round(roc_auc, 6) AS metric_value, (SELECT string_agg(model, ',' ORDER BY model) FROM near) AS candidates FROM near ORDER BY sec, average_precision DESC, model LIMIT 1""",
        "base_feature": E + "SELECT feature, regexp_replace(feature, '_(scaled|freq)$', '') AS base_feature, round(m, 6) AS mean FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(\"{c}\") AS m FROM enc" for c in ENC_COLS) + ")",
        "explain_topn": with_(CARD, HIST, split(), FREQ, SCALE, ENC, explain_ctes()) + "SELECT row_id, CAST(rank AS BIGINT) AS rank, feature, round(z, 3) AS z_score, round(v, 4) AS \"value\", round(m, 4) AS reference_mean, description FROM said WHERE rank <= 5",
        "explain_text": with_(CARD, HIST, split(), FREQ, SCALE, ENC, explain_ctes()) + """SELECT row_id, 'Flagged mainly for: ' || string_agg(description || ' (' || CASE WHEN round(z, 3) > 0 THEN 'far above normal' ELSE 'far below normal' END || ', z=' || CASE WHEN round(z, 3) >= 0 THEN '+' ELSE '' END || CAST(CAST(CAST(round(z, 3) AS DECIMAL(18,3)) AS DECIMAL(18,2)) AS VARCHAR) || ')', '; ' ORDER BY rank) || '.' AS explanation FROM said WHERE rank <= 3 GROUP BY row_id""",
        "correlation_matrix": with_(TXN, HIST) + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(\"{a}\", \"{b}\"), 6) AS corr FROM feats" for a in CORR_COLS for b in CORR_COLS),
        "amount_histogram": with_(LINES) + ", " + hist_sql("txn", '"Amount"', 60),
        "amount_log_histogram": with_(LINES) + ", " + hist_sql("txn", 'ln(1 + greatest("Amount", 0))', 60),
        "amount_box_by_category": L + """, q AS (SELECT l_returnflag AS c, count(*) AS n, quantile_cont("Amount", 0.25) AS q1, quantile_cont("Amount", 0.5) AS med, quantile_cont("Amount", 0.75) AS q3 FROM txn GROUP BY 1)
SELECT l_returnflag, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3, round(min("Amount") FILTER (WHERE "Amount" >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
 round(max("Amount") FILTER (WHERE "Amount" <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high FROM txn JOIN q ON c = l_returnflag GROUP BY 1""",
        "customer_frequency_hist": L + ", per AS (SELECT count(*) AS n FROM txn GROUP BY \"User\"), " + hist_sql("per", "CAST(n AS DOUBLE)", 40),
        "top_merchants": L + 'SELECT "Merchant Name", count(*) AS n FROM txn GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20',
        "hourly_volume": T + "SELECT txn_hour AS hour, count(*) AS n FROM txn GROUP BY 1",
        "daily_volume": L + "SELECT CAST(transaction_datetime AS DATE) AS day, count(*) AS n FROM txn GROUP BY 1",
        "weekday_volume": L + "SELECT txn_day_of_week AS weekday, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][txn_day_of_week + 1] AS name, count(*) AS n FROM txn GROUP BY 1, 2",
        "top_customer_spend": L + 'SELECT "User", count(*) AS n, round(avg("Amount"), 6) AS avg_amount FROM txn GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15',
        "top_merchant_spend": L + 'SELECT "Merchant Name", count(*) AS n, round(avg("Amount"), 6) AS avg_amount FROM txn GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15',
        "score_histogram": with_(TXN, HIST, FLAGGED) + ", " + hist_sql("fl", "anomaly_score", 60),
        "runtime_long": TS + """, m AS (SELECT model, count(*)::DOUBLE AS a, sum(label)::DOUBLE AS b FROM scored GROUP BY 1) SELECT model, 'train_time_seconds' AS stage, a AS seconds FROM m UNION ALL SELECT model, 'prediction_time_seconds', b FROM m""",
        "scatter_points": F_ + """SELECT row_id, round("Amount", 6) AS x, round(customer_avg_amount, 6) AS y, CASE WHEN is_anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END AS kind FROM fl""",
        "anomaly_rate_by_mcc": CF + 'SELECT "MCC", round(avg(is_anomaly), 6) AS rate, count(*) AS n FROM fl GROUP BY 1 HAVING count(*) >= 5 ORDER BY rate DESC, 1 LIMIT 15',
        "anomaly_rate_by_channel": CF + 'SELECT "Use Chip", round(avg(is_anomaly), 6) AS rate, count(*) AS n FROM fl GROUP BY 1',
        "anomaly_rate_by_hour": F_ + "SELECT txn_hour, round(avg(is_anomaly), 6) AS rate, count(*) AS n FROM fl GROUP BY 1",
        "anomaly_rate_by_weekday": F_ + "SELECT txn_day_of_week, round(avg(is_anomaly), 6) AS rate, count(*) AS n FROM fl GROUP BY 1",
        "impact_summary": F_ + f"""SELECT count(*) AS n_total, CAST(sum(is_anomaly) AS BIGINT) AS n_flagged, round(100.0::DOUBLE * sum(is_anomaly) / count(*), 6) AS flagged_pct,
 round(CAST(sum({DEC}) FILTER (WHERE is_anomaly = 1) AS DOUBLE), 2) AS flagged_value, round(100.0::DOUBLE * CAST(sum({DEC}) FILTER (WHERE is_anomaly = 1) AS DOUBLE) / CAST(sum({DEC}) AS DOUBLE), 6) AS value_share_pct FROM fl""",
        "top_flagged_merchants": F_ + f'SELECT "Merchant Name", count(*) AS flagged_count, round(CAST(sum({DEC}) AS DOUBLE), 2) AS total_flagged_amount FROM fl WHERE is_anomaly = 1 GROUP BY 1 ORDER BY flagged_count DESC, 1 LIMIT 15',
        "dataset_summary": L + 'SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_columns, count(DISTINCT "User") AS n_customers, count(DISTINCT "Merchant Name") AS n_merchants FROM txn',
        "flagged_sorted": F_ + 'SELECT row_id, "User", round("Amount", 6) AS "Amount", round(anomaly_score, 6) AS anomaly_score FROM fl WHERE is_anomaly = 1',
        "prediction_counters": F_ + "SELECT count(*) AS n_scored, CAST(sum(is_anomaly) AS BIGINT) AS n_flagged, round(100.0::DOUBLE * avg(is_anomaly), 6) AS flagged_pct FROM fl",
    }
