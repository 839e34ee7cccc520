"""DuckDB SQL for each registered query, over the views of the supplied tables.

Money is turned into integer cents and rates are rounded half-even on a decimal,
which is exactly what the Spark expressions do.
"""

from __future__ import annotations


def half_up_div(n: str, d: int) -> str:
    return f"(CASE WHEN ({n}) >= 0 THEN (({n}) + {d // 2}) // {d} ELSE -(({d // 2} - ({n})) // {d}) END)"


IN_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
OUT_CENTS = half_up_div(f"{IN_CENTS} * (100 - CAST(round(l_discount * 100) AS BIGINT))", 100)

# Common table expressions shared by the oracle queries.
ITEMS = f"""
items AS (
  SELECT l_orderkey AS tx_id, 'in' AS side, CAST(l_suppkey AS VARCHAR) AS addr, {IN_CENTS} AS value
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'out', CAST(l_partkey AS VARCHAR), {OUT_CENTS}
  FROM lineitem
)"""

SIZES = """
sizes AS (
  SELECT l_orderkey AS tx_id, CAST(sum(l_quantity) AS BIGINT) AS size, count(*) AS n_items
  FROM lineitem GROUP BY l_orderkey
)"""

HEADER_ONLY = """
header AS (
  SELECT o_orderkey AS tx_id, CAST(o_orderkey AS VARCHAR) AS hash,
         CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate) AS BIGINT) AS time,
         s.size, s.n_items
  FROM orders JOIN sizes s ON s.tx_id = o_orderkey
)"""

HEADER = SIZES + "," + HEADER_ONLY

FEES = (
    ITEMS
    + ","
    + SIZES
    + """,
dist AS (SELECT DISTINCT tx_id, side, addr, value FROM items),
totals AS (
  SELECT tx_id, sum(CASE WHEN side = 'in' THEN value END) AS in_total,
         sum(CASE WHEN side = 'out' THEN value END) AS out_total
  FROM dist GROUP BY tx_id
),
fees_all AS (
  SELECT CAST(t.tx_id AS VARCHAR) AS hash, s.size, CAST(t.in_total AS BIGINT) AS in_total,
         CAST(t.out_total AS BIGINT) AS out_total, CAST(t.in_total - t.out_total AS BIGINT) AS fee,
         CAST(round_even(CAST((t.in_total - t.out_total) / s.size AS DECIMAL(30,9)), 2) AS DOUBLE) AS fee_rate
  FROM totals t JOIN sizes s USING (tx_id)
),
fees AS (SELECT * FROM fees_all WHERE fee_rate >= 0)"""
)

SUMMARY = """
summary AS (
  SELECT count(*) AS total_hash,
         CAST(sum(CAST(round(fee_rate * 100) AS BIGINT)) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 100.0)
           AS mean_fee_rate,
         CAST(coalesce(sum(out_total), 0) AS BIGINT) AS volume_sat
  FROM fees
)"""


DOC_HEADER_COLS = """'utx' AS op, h.hash, CAST(0 AS INTEGER) AS lock_time, CAST(1 AS INTEGER) AS ver, h.size, h.time,
       h.tx_id AS tx_index, h.n_items AS vin_sz, h.n_items AS vout_sz, '0.0.0.0' AS relayed_by"""


INPUTS = f"""
inputs AS (
  SELECT {DOC_HEADER_COLS},
         CAST(4294967295 AS BIGINT) AS in_sequence, true AS in_spent, l_partkey AS in_tx_index,
         CAST(0 AS BIGINT) AS in_type, CAST(l_suppkey AS VARCHAR) AS in_addr, {IN_CENTS} AS in_value,
         CAST(l_linenumber - 1 AS BIGINT) AS in_n, l_returnflag AS in_script, l_linestatus AS in_sig_script
  FROM lineitem JOIN header h ON h.tx_id = l_orderkey
)"""

OUTPUTS = f"""
outputs AS (
  SELECT {DOC_HEADER_COLS},
         false AS out_spent, l_orderkey AS out_tx_index, CAST(0 AS BIGINT) AS out_type,
         CAST(l_partkey AS VARCHAR) AS out_addr, {OUT_CENTS} AS out_value,
         CAST(l_linenumber - 1 AS BIGINT) AS out_n, l_linestatus AS out_script
  FROM lineitem JOIN header h ON h.tx_id = l_orderkey
)"""

FLAT = f"""
flat AS (
  SELECT {DOC_HEADER_COLS}, 'in' AS side, CAST(4294967295 AS BIGINT) AS sequence, true AS spent,
         l_partkey AS item_tx_index, CAST(0 AS BIGINT) AS item_type, CAST(l_suppkey AS VARCHAR) AS addr,
         {IN_CENTS} AS value, CAST(l_linenumber - 1 AS BIGINT) AS n, l_returnflag AS script,
         l_linestatus AS sig_script
  FROM lineitem JOIN header h ON h.tx_id = l_orderkey
  UNION ALL
  SELECT {DOC_HEADER_COLS}, 'out', CAST(NULL AS BIGINT), false, l_orderkey, CAST(0 AS BIGINT),
         CAST(l_partkey AS VARCHAR), {OUT_CENTS}, CAST(l_linenumber - 1 AS BIGINT), l_linestatus,
         CAST(NULL AS VARCHAR)
  FROM lineitem JOIN header h ON h.tx_id = l_orderkey
)"""

DIST_IN = "dist_in AS (SELECT DISTINCT hash, in_addr, in_value, size FROM inputs)"
DIST_OUT = "dist_out AS (SELECT DISTINCT hash, out_addr, out_value, size FROM outputs)"
IN_TOT = """in_tot AS (
  SELECT hash, size AS trans_size, CAST(sum(in_value) AS BIGINT) AS in_total FROM dist_in GROUP BY hash, size
)"""
OUT_TOT = """out_tot AS (
  SELECT hash, size, CAST(sum(out_value) AS BIGINT) AS out_total FROM dist_out GROUP BY hash, size
)"""

# Items per transaction, however the adapter cut the order into documents.
PARTS = """
parts AS (SELECT tx_id, n_items AS n_part FROM sizes)"""

EVENT_TS = "(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(time))"


def coins_text(col: str) -> str:
    return f"printf('%d.%08d', {col} // 100000000, {col} % 100000000)"


HASH_BUCKET = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) % 100"

# Events with the share in which they arrive, and whether they come behind the watermark of the share.
DISORDERED = f"""
WITH ends AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 4 + 1 AS span FROM events),
placed AS (
  SELECT event_id, ts, (epoch_us(ts) - lo) // span AS share, {HASH_BUCKET.format("CAST(event_id AS VARCHAR)")} < 5 AS held
  FROM events, ends
),
newest AS (SELECT share, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM placed WHERE NOT held GROUP BY share),
arrived AS (
  SELECT event_id, ts, CASE WHEN held THEN share + 1 ELSE share END AS share FROM placed
  UNION ALL
  SELECT event_id, ts - to_microseconds(CAST(late_by * 1000000 AS BIGINT)), share + 1
  FROM newest, (VALUES (0.5), (1.0), (10.0)) AS l(late_by)
),
marks AS (SELECT s.share, (SELECT max(ts) FROM arrived a WHERE a.share < s.share) - INTERVAL 1 SECOND AS watermark
          FROM (SELECT DISTINCT share FROM arrived) s),
judged AS (
  SELECT event_id, ts, ws, coalesce(ws + INTERVAL 2 SECOND <= watermark, false) AS late
  FROM (SELECT *, time_bucket(INTERVAL 2 SECOND, ts) AS ws FROM arrived) JOIN marks USING (share)
)"""


# The second mapping of lineitem: items that repeat, fees of both signs.
COARSE_ITEMS = """
items AS (
  SELECT l_orderkey AS tx_id, 'in' AS side, l_returnflag AS addr, CAST(l_quantity AS BIGINT) * 100 AS value FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'out', l_linestatus,
         CAST(l_quantity AS BIGINT) * (100 + CAST(round(l_tax * 100) AS BIGINT) - CAST(round(l_discount * 100) AS BIGINT))
  FROM lineitem
)"""
COARSE_FEES = FEES.replace(ITEMS, COARSE_ITEMS)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


DESCRIBE = """
SELECT 'count' AS summary, CAST(count(*) AS DOUBLE) AS size, CAST(count(*) AS DOUBLE) AS fee,
       CAST(count(*) AS DOUBLE) AS fee_rate FROM fees
UNION ALL
SELECT 'mean', CAST(sum(size) AS DOUBLE) / CAST(count(*) AS DOUBLE),
       CAST(sum(fee) AS DOUBLE) / CAST(count(*) AS DOUBLE),
       CAST(sum(CAST(round(fee_rate * 100) AS BIGINT)) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 100.0) FROM fees
UNION ALL
SELECT 'stddev', round(stddev_samp(size), 4), round(stddev_samp(fee), 4), round(stddev_samp(fee_rate), 4) FROM fees
UNION ALL
SELECT 'min', CAST(min(size) AS DOUBLE), CAST(min(fee) AS DOUBLE), min(fee_rate) FROM fees
UNION ALL
SELECT 'max', CAST(max(size) AS DOUBLE), CAST(max(fee) AS DOUBLE), max(fee_rate) FROM fees"""

def fit_ctes(features: list[str], reg: float, alpha: float) -> str:
    """Elastic net on standardised features (one or two), by coordinate descent on their correlations:
    CTE ``model`` with intercept, b1, b2."""
    x1, x2 = (features * 2)[:2]
    soft = lambda v: f"(sign({v}) * greatest(abs({v}) - l1, 0.0) / (1.0 + l2))"
    two = "1.0" if len(features) == 2 else "0.0"
    return f"""
train AS (SELECT CAST({x1} AS DOUBLE) AS x1, CAST({x2} AS DOUBLE) AS x2, fee_rate AS y FROM fees WHERE {HASH_BUCKET.format('hash')} < 70),
m AS (
  SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(y) AS sy,
         covar_pop(x1, x2) / (stddev_pop(x1) * stddev_pop(x2)) * {two} AS r, covar_pop(x1, y) / (stddev_pop(x1) * stddev_pop(y)) AS c1,
         covar_pop(x2, y) / (stddev_pop(x2) * stddev_pop(y)) * {two} AS c2,
         {alpha} * {reg} / stddev_pop(y) AS l1, (1 - {alpha}) * {reg} / stddev_pop(y) AS l2
  FROM train
),
steps AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS z1, CAST(0 AS DOUBLE) AS z2
  UNION ALL
  SELECT k + 1, n1, {soft("(c2 - r * n1)")} FROM (SELECT k, {soft("(c1 - r * z2)")} AS n1, r, c2, l1, l2 FROM steps, m WHERE k < 3000)
),
model AS (
  SELECT z1 * sy / s1 AS b1, z2 * sy / s2 AS b2, my - z1 * sy / s1 * m1 - z2 * sy / s2 * m2 AS intercept FROM steps, m WHERE k = 3000
)"""


# Damaged payloads by the hash of their key (DAMAGED in the queries).
DEAD_LETTERS = f"""
SELECT hash AS key, outcome, CAST(CASE WHEN outcome = 'good' THEN 2 * n_part ELSE 0 END AS BIGINT) AS n_items
FROM (SELECT h.hash, p.n_part, CASE WHEN {HASH_BUCKET.format('h.hash')} < 4 THEN 'cut off' WHEN {HASH_BUCKET.format('h.hash')} < 8 THEN 'junk'
             WHEN {HASH_BUCKET.format('h.hash')} < 12 THEN 'overflow' ELSE 'good' END AS outcome
      FROM parts p JOIN header h USING (tx_id))"""


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


# Features and settings of the models (ONE_PASS in the queries).
LINEAR_FIT = fit_ctes(["size"], 0.5, 0.5)
POLY_FIT = fit_ctes(["size", "CAST(size AS DOUBLE) * size"], 0.3, 0.8)
PARITY_FIT = fit_ctes(["size", "fee_rate"], 0.5, 0.5)


def errors_sql(name: str, prediction: str) -> str:
    return f"""
SELECT '{name}' AS model, round(rmse, 6) AS rmse, round(mean_label, 6) AS mean_label, round(rmse / mean_label * 100, 6) AS rmse_percent, n
FROM (SELECT sqrt(avg(power(fee_rate - ({prediction}), 2))) AS rmse, avg(fee_rate) AS mean_label, count(*) AS n
      FROM fees, model WHERE {HASH_BUCKET.format('hash')} >= 70)"""


ORACLE: dict[str, str] = {
    # step 1
    "tx_fees": with_(FEES) + "\nSELECT * FROM fees",
    "fee_summary": with_(FEES, SUMMARY) + "\nSELECT * FROM summary",
    "tx_fees_docs": with_(FEES) + "\nSELECT * FROM fees",
    "tx_fees_rowlocal": with_(FEES) + "\nSELECT * FROM fees",
    # step 2
    "explode_inputs": with_(HEADER, INPUTS) + "\nSELECT * FROM inputs",
    "explode_outputs": with_(HEADER, OUTPUTS) + "\nSELECT * FROM outputs",
    "tx_flatten": with_(HEADER, FLAT) + "\nSELECT * FROM flat",
    "distinct_inputs": with_(HEADER, INPUTS, DIST_IN) + "\nSELECT * FROM dist_in",
    "distinct_outputs": with_(HEADER, OUTPUTS, DIST_OUT) + "\nSELECT * FROM dist_out",
    "input_totals": with_(HEADER, INPUTS, DIST_IN, IN_TOT) + "\nSELECT * FROM in_tot",
    "output_totals": with_(HEADER, OUTPUTS, DIST_OUT, OUT_TOT) + "\nSELECT * FROM out_tot",
    "join_in_out_totals": with_(HEADER, INPUTS, OUTPUTS, DIST_IN, DIST_OUT, IN_TOT, OUT_TOT)
    + """
SELECT i.hash, i.trans_size AS size, i.in_total, o.out_total
FROM in_tot i JOIN out_tot o ON o.hash = i.hash AND o.size = i.trans_size""",
    "self_join_hash": with_(HEADER, INPUTS, DIST_IN, IN_TOT)
    + """
SELECT d.hash, d.in_addr, d.in_value, t.hash AS unique_hash, t.in_total
FROM dist_in d JOIN in_tot t ON d.hash = t.hash""",
    "bround_values": with_(FEES)
    + """
SELECT hash, fee, size, CAST(fee AS DOUBLE) / size AS raw_rate, fee_rate FROM fees_all""",
    "coin_units": with_(FEES)
    + """
SELECT hash, CAST(in_total AS DOUBLE) / CAST(100000000 AS DOUBLE) AS in_coins,
       CAST(out_total AS DOUBLE) / CAST(100000000 AS DOUBLE) AS out_coins FROM fees""",
    "sum_distinct_in": with_(HEADER, INPUTS)
    + """
SELECT hash, CAST(sum(DISTINCT in_value) AS BIGINT) AS sum_distinct_in FROM inputs GROUP BY hash""",
    "distinct_values": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS in_addr FROM lineitem",
    "volume_by_time": with_(HEADER, OUTPUTS)
    + """
SELECT time, count(*) AS n_outputs, CAST(sum(out_value) AS BIGINT) AS volume_sat
FROM (SELECT DISTINCT hash, out_addr, out_value, time FROM outputs) GROUP BY time""",
    # step 3
    "src_envelope_parse": with_(HEADER, PARTS)
    + """
SELECT h.hash AS key, 'utx' AS op, h.hash, CAST(h.size AS INTEGER) AS size, h.time, h.n_items AS vin_sz, h.n_items AS vout_sz,
       CAST(p.n_part AS INTEGER) AS n_inputs, CAST(p.n_part AS INTEGER) AS n_outputs
FROM parts p JOIN header h USING (tx_id)""",
    "src_pubsublite_parse": with_(HEADER, PARTS)
    + """
SELECT h.hash AS key, 'utx' AS op, h.hash, CAST(h.size AS INTEGER) AS size, h.time, h.n_items AS vin_sz, h.n_items AS vout_sz,
       CAST(p.n_part AS INTEGER) AS n_inputs, CAST(p.n_part AS INTEGER) AS n_outputs
FROM parts p JOIN header h USING (tx_id)""",
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    # step 4
    "epoch_to_ts": with_(HEADER) + f"\nSELECT hash, time, {EVENT_TS} AS event_time FROM header",
    "window_tx_groups": with_(HEADER, FLAT)
    + f"""
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, hash, side, addr, value, size, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, {EVENT_TS}) AS ws, * FROM flat)
GROUP BY ws, hash, side, addr, value, size""",
    "window_total_trans": with_(HEADER)
    + f"""
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS total_trans
FROM (SELECT time_bucket(INTERVAL 2 SECOND, {EVENT_TS}) AS ws FROM header) GROUP BY ws""",
    "window_event_counts": """
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, ts) AS ws FROM events) GROUP BY ws""",
    # step 5
    "metrics_payload": with_(FEES, SUMMARY)
    + f"""
SELECT {coins_text('volume_sat')} AS vol, round(mean_fee_rate, 4) AS trans_fees, total_hash FROM summary""",
    "metrics_latest": with_(FEES, HEADER_ONLY, SUMMARY)
    + f""",
latest AS (SELECT CAST(max(year({EVENT_TS})) AS BIGINT) AS batch_id FROM fees f JOIN header h USING (hash))
SELECT l.batch_id, {coins_text('volume_sat')} AS vol, coalesce(round(mean_fee_rate, 4), 0.0) AS trans_fees, total_hash
FROM summary, latest l""",
    "describe_fees": with_(FEES) + DESCRIBE,
    "size_fee_corr": with_(FEES)
    + """
SELECT count(*) AS n, round(corr(CAST(size AS DOUBLE), fee_rate), 6) AS corr_size_fee_rate FROM fees""",
    "size_fee_histogram": with_(FEES)
    + """
SELECT CAST(floor(size / 100) * 100 AS INTEGER) AS size_bin, CAST(floor(fee_rate / 10) * 10 AS INTEGER) AS rate_bin,
       count(*) AS n_tx
FROM fees WHERE size BETWEEN 100 AND 1000 AND fee_rate BETWEEN 0 AND 100 GROUP BY 1, 2""",
    "scan_csv_roundtrip": with_(FEES) + "\nSELECT * FROM fees",
    # step 6
    "stream_json_dir": with_(HEADER, FLAT) + "\nSELECT * REPLACE (CAST(size AS INTEGER) AS size) FROM flat",
    "stream_append_parse": with_(HEADER, PARTS)
    + """
SELECT h.hash AS key, 'utx' AS op, h.hash, CAST(h.size AS INTEGER) AS size, h.time, h.n_items AS vin_sz, h.n_items AS vout_sz,
       CAST(p.n_part AS INTEGER) AS n_inputs, CAST(p.n_part AS INTEGER) AS n_outputs
FROM parts p JOIN header h USING (tx_id)""",
    "stream_fee_export": with_(FEES) + "\nSELECT * FROM fees",
    "stream_fee_snapshot": with_(FEES, SUMMARY)
    + f"""
SELECT {coins_text('volume_sat')} AS vol, round(mean_fee_rate, 4) AS trans_fees, total_hash FROM summary""",
    "stream_fee_deltas": with_(FEES, SUMMARY)
    + f"""
SELECT {coins_text('volume_sat')} AS vol, round(mean_fee_rate, 4) AS trans_fees, total_hash FROM summary""",
    "stream_metrics_latest": with_(FEES, SUMMARY)
    + f""",
snapshot AS (SELECT {coins_text('volume_sat')} AS vol, coalesce(round(mean_fee_rate, 4), 0.0) AS trans_fees, total_hash
             FROM summary)
SELECT true AS several_batches, vol, trans_fees, total_hash,
       concat('{{"vol":"', vol, '","trans_fees":', CAST(trans_fees AS VARCHAR), ',"total_hash":',
              CAST(total_hash AS VARCHAR), '}}') AS payload
FROM snapshot""",
    "stream_dedup": with_(HEADER, PARTS)
    + """
SELECT h.hash, CAST(h.size AS INTEGER) AS size, h.time, CAST(p.n_part AS INTEGER) AS n_inputs, CAST(p.n_part AS INTEGER) AS n_outputs
FROM parts p JOIN header h USING (tx_id)""",
    "stream_window_update": """
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, ts) AS ws FROM events) GROUP BY ws""",
    "stream_window_complete": """
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, ts) AS ws FROM events) GROUP BY ws""",
    "stream_window_append": """
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, ts) AS ws FROM events) GROUP BY ws
HAVING ws + INTERVAL 2 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 1 SECOND""",
    "stream_window_tx_groups": with_(HEADER, FLAT)
    + f"""
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, hash, side, addr, value, CAST(size AS INTEGER) AS size, 2 * count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, {EVENT_TS}) AS ws, * FROM flat)
GROUP BY ws, hash, side, addr, value, size
HAVING ws + INTERVAL 2 SECOND <= (SELECT max({EVENT_TS}) FROM flat) - INTERVAL 1 SECOND""",
    "stream_window_tx_totals": with_(HEADER, FLAT)
    + f""",
per_item AS (
  SELECT time_bucket(INTERVAL 2 SECOND, {EVENT_TS}) AS ws, hash, side, addr, value, size, 2 * count(*) AS count
  FROM flat GROUP BY 1, 2, 3, 4, 5, 6
)
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, hash, CAST(size AS INTEGER) AS size, count(*) AS n_items,
       CAST(sum(count) AS BIGINT) AS n_deliveries, CAST(sum(CASE WHEN side = 'in' THEN value END) AS BIGINT) AS in_total,
       CAST(sum(CASE WHEN side = 'out' THEN value END) AS BIGINT) AS out_total
FROM per_item GROUP BY ws, hash, size
HAVING ws + INTERVAL 2 SECOND <= (SELECT max({EVENT_TS}) FROM flat) - INTERVAL 1 SECOND""",
    "stream_live_totals": with_(FEES, SUMMARY)
    + f"""
SELECT true AS several_batches, true AS each_row_once, {coins_text('volume_sat')} AS vol, round(mean_fee_rate, 4) AS trans_fees, total_hash
FROM summary""",
    "stream_window_late": DISORDERED
    + """
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, count(*) AS count
FROM judged WHERE NOT late GROUP BY ws
HAVING ws + INTERVAL 2 SECOND <= (SELECT max(ts) FROM arrived) - INTERVAL 1 SECOND""",
    "stream_late_rows": DISORDERED
    + """
SELECT event_id, ts, (SELECT count(*) FROM judged WHERE NOT late) AS n_on_time FROM judged WHERE late""",
    "stream_dedup_bounded": with_(HEADER, PARTS)
    + f""",
ends AS (SELECT min(time) AS lo, max(time) AS hi FROM header),
mark AS (  -- the watermark of the last delivery: the newest time delivered before, less the delay
  SELECT max(time) - {30 * 86400} AS watermark FROM header WHERE {HASH_BUCKET.format('hash')} >= 3
)
SELECT h.hash, CAST(p.n_part AS BIGINT) AS n_inputs, CAST(p.n_part AS BIGINT) AS n_outputs, true AS state_falls, true AS some_dropped
FROM parts p JOIN header h USING (tx_id), mark m
WHERE {HASH_BUCKET.format('h.hash')} >= 3 OR h.time > m.watermark""",
    "stream_files_rate_limited": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    # step 7 (the regularised fits, predictions and errors get the rows-only check)
    "ml_features": with_(FEES) + "\nSELECT hash, CAST(size AS DOUBLE) AS f0, fee_rate FROM fees",
    "ml_poly_features": with_(FEES)
    + "\nSELECT hash, CAST(size AS DOUBLE) AS f0, CAST(size AS DOUBLE) * CAST(size AS DOUBLE) AS f1 FROM fees",
    # MinMaxScaler multiplies by a precomputed 1 / range.
    "ml_minmax": with_(FEES)
    + """,
r AS (SELECT min(CAST(size AS DOUBLE)) AS mn0, max(CAST(size AS DOUBLE)) AS mx0,
             min(fee_rate) AS mn1, max(fee_rate) AS mx1 FROM fees)
SELECT hash,
       CASE WHEN mx0 = mn0 THEN 0.5 ELSE (CAST(size AS DOUBLE) - mn0) * (CAST(1 AS DOUBLE) / (mx0 - mn0)) + 0.0 END AS s0,
       CASE WHEN mx1 = mn1 THEN 0.5 ELSE (fee_rate - mn1) * (CAST(1 AS DOUBLE) / (mx1 - mn1)) + 0.0 END AS s1
FROM fees, r""",
    "ml_split_counts": with_(FEES)
    + """
SELECT CASE WHEN CAST(('0x' || substr(md5(hash), 1, 8)) AS BIGINT) % 100 < 70 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n
FROM fees GROUP BY 1""",
    "ml_onepass_linear": with_recursive(FEES, LINEAR_FIT) + "\nSELECT round(intercept, 6) AS intercept, round(b1, 6) AS c0 FROM model",
    "ml_onepass_poly": with_recursive(FEES, POLY_FIT)
    + "\nSELECT round(intercept, 6) AS intercept, round(b1, 6) AS c0, round(b2, 6) AS c1 FROM model",
    "ml_onepass_parity": with_recursive(FEES, PARITY_FIT)
    + "\nSELECT round(intercept, 6) AS intercept, round(b1, 6) AS c0, round(b2, 6) AS c1 FROM model",
    "ml_onepass_errors": "SELECT * FROM ("
    + with_recursive(FEES, LINEAR_FIT)
    + errors_sql("linear", "intercept + b1 * size")
    + ") UNION ALL SELECT * FROM ("
    + with_recursive(FEES, POLY_FIT)
    + errors_sql("poly", "intercept + b1 * size + b2 * (CAST(size AS DOUBLE) * size)")
    + ")",
    "ml_onepass_roundtrip": with_recursive(FEES, LINEAR_FIT)
    + f"""
SELECT hash, fee_rate, round(intercept + b1 * size, 6) AS prediction FROM fees, model WHERE {HASH_BUCKET.format('hash')} >= 70""",
    "ml_exact_split": with_(FEES)
    + """
SELECT hash, CASE WHEN row_number() OVER (ORDER BY CAST(('0x' || substr(md5(hash), 1, 15)) AS BIGINT)) <= floor(0.7 * count(*) OVER ())
            THEN 'train' ELSE 'test' END AS split
FROM fees""",
    # the second mapping, dead letters, admission, compaction
    "tx_fees_signed": with_(COARSE_FEES) + "\nSELECT * FROM fees",
    "distinct_items_repeated": with_(COARSE_ITEMS)
    + """
SELECT CAST(tx_id AS VARCHAR) AS hash, side, count(DISTINCT (addr, value)) AS n_distinct, count(*) AS n_items FROM items GROUP BY tx_id, side""",
    "window_tx_groups_repeated": with_(COARSE_ITEMS, HEADER)
    + f"""
SELECT ws AS window_start, ws + INTERVAL 2 SECOND AS window_end, hash, side, addr, value, size, count(*) AS count
FROM (SELECT time_bucket(INTERVAL 2 SECOND, {EVENT_TS}) AS ws, * FROM items JOIN header USING (tx_id))
GROUP BY ws, hash, side, addr, value, size""",
    "size_fee_histogram_fine": with_(COARSE_FEES)
    + """
SELECT CAST(floor(size / 10) * 10 AS INTEGER) AS size_bin, CAST(floor(fee_rate) AS INTEGER) AS rate_bin, count(*) AS n_tx
FROM fees WHERE size BETWEEN 50 AND 250 AND fee_rate BETWEEN 1 AND 6 GROUP BY 1, 2""",
    "src_dead_letters": with_(HEADER, PARTS) + DEAD_LETTERS,
    "stream_dead_letters": with_(HEADER, PARTS) + DEAD_LETTERS,
    "stream_admission": "SELECT event_type, count(*) AS count, true AS in_band FROM events GROUP BY event_type",
    "metrics_compacted": with_(FEES, HEADER_ONLY, SUMMARY)
    + f""",
latest AS (SELECT CAST(max(year({EVENT_TS})) AS BIGINT) AS batch_id FROM fees f JOIN header h USING (hash))
SELECT l.batch_id, {coins_text('volume_sat')} AS vol, coalesce(round(mean_fee_rate, 4), 0.0) AS trans_fees, total_hash,
       true AS same_before_and_after, true AS few_folders
FROM summary, latest l""",
    "stream_profile": with_(FEES)
    + """
SELECT count(*) AS n, round(avg(size), 6) AS mean_size, round(stddev_samp(size), 6) AS sd_size, round(avg(fee), 4) AS mean_fee,
       round(stddev_samp(fee), 4) AS sd_fee, round(avg(fee_rate), 6) AS mean_fee_rate, round(stddev_samp(fee_rate), 6) AS sd_fee_rate,
       round(corr(CAST(size AS DOUBLE), fee_rate), 6) AS corr_size_fee_rate
FROM fees""",
}
