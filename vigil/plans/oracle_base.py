"""DuckDB SQL building blocks for the independent oracle (CTEs over the driver views).

Written directly in SQL (window ``row_number``, ``quantile_cont``, list
aggregates), not generated from the Spark expressions, so the two sides only
share the specification.
"""

from __future__ import annotations

V = range(1, 29)
VCOLS = ", ".join(f"v{i}" for i in V)
VLIST = "[" + VCOLS + "]"


def with_(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


CARD = f"""card AS (
  SELECT e.event_id AS row_id,
         CAST((epoch_us(e.ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000000 AS DOUBLE) AS time,
         {", ".join(f"CAST(m.embedding[{i}] AS DOUBLE) AS v{i}" for i in V)},
         e.value AS amount,
         CASE WHEN e.event_type = 'error' AND m.label = 0 THEN 1 ELSE 0 END AS is_fraudulent
  FROM events e JOIN embeddings m ON m.vec_id = e.event_id % 500)"""

CLEAN_CARD = f"""card_stats AS (
  SELECT quantile_cont(abs(amount), 0.99) AS q99, max(time) AS max_time FROM card),
clean_card0 AS (
  SELECT c.row_id, c.time, {", ".join(f"c.v{i}" for i in V)},
         CASE WHEN abs(c.amount) > s.q99 THEN s.q99 ELSE abs(c.amount) END AS amount,
         c.is_fraudulent,
         make_timestamp(1672531200000000
           + CAST(round(c.time / s.max_time * 15552000.0 * 1000000.0) AS BIGINT)) AS transaction_date
  FROM card c CROSS JOIN card_stats s),
clean_card AS (
  SELECT *, CAST(hour(transaction_date) AS INTEGER) AS transaction_hour FROM clean_card0)"""

CARD_POS = """card_pos AS (
  SELECT *, row_number() OVER (ORDER BY transaction_date, row_id) - 1 AS pos, count(*) OVER () AS n
  FROM clean_card)"""

CARD_SPLIT = """card_split AS (
  SELECT * EXCLUDE (pos, n),
         CASE WHEN pos < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split
  FROM card_pos)"""

CARD_P = """card_p AS (
  SELECT quantile_cont(amount, 0.25) AS a25, quantile_cont(amount, 0.5) AS a50,
         quantile_cont(amount, 0.75) AS a75, quantile_cont(amount, 0.9) AS a90,
         quantile_cont(amount, 0.95) AS a95,
         avg(hour(transaction_date)) AS hmean, stddev_samp(hour(transaction_date)) AS hstd
  FROM card_split WHERE split = 'train')"""


def _temporal(td: str = "s.transaction_date") -> str:
    h = f"hour({td})"
    dow = f"(isodow({td}) - 1)"
    return f"""CAST({h} AS INTEGER) AS hour, CAST({dow} AS INTEGER) AS day_of_week,
    CAST(day({td}) AS INTEGER) AS day_of_month, CAST(month({td}) AS INTEGER) AS month,
    CAST(quarter({td}) AS INTEGER) AS quarter,
    CAST({dow} >= 5 AS INTEGER) AS is_weekend,
    CAST({h} >= 23 OR {h} <= 6 AS INTEGER) AS is_late_night,
    CAST({h} BETWEEN 9 AND 17 AS INTEGER) AS is_business_hours,
    CAST({h} BETWEEN 7 AND 9 OR {h} BETWEEN 17 AND 19 AS INTEGER) AS is_rush_hour,
    sin(2 * pi() * {h} / 24) AS hour_sin, cos(2 * pi() * {h} / 24) AS hour_cos,
    sin(2 * pi() * {dow} / 7) AS day_sin, cos(2 * pi() * {dow} / 7) AS day_cos,
    sin(2 * pi() * month({td}) / 12) AS month_sin, cos(2 * pi() * month({td}) / 12) AS month_cos,
    CAST({h} BETWEEN 0 AND 4 AS INTEGER) AS is_high_risk_hour,
    CAST(month({td}) IN (12, 1) AS INTEGER) AS is_holiday_period,
    abs({h} - p.hmean) / (p.hstd + 1e-8) AS hour_deviation"""


def _amount(a: str = "s.amount") -> str:
    return f"""ln(1 + {a}) AS amount_log, sqrt({a}) AS amount_sqrt,
    ({a} - p.a50) / (CASE WHEN p.a75 - p.a25 = 0 THEN 1.0 ELSE p.a75 - p.a25 END) AS amount_scaled,
    CAST(coalesce({a} > p.a50, false) AS INTEGER) AS amount_above_50,
    CAST(coalesce({a} > p.a75, false) AS INTEGER) AS amount_above_75,
    CAST(coalesce({a} > p.a90, false) AS INTEGER) AS amount_above_90,
    CAST(coalesce({a} > p.a95, false) AS INTEGER) AS amount_above_95,
    {a} / (p.a50 + 1e-8) AS amount_ratio_to_median,
    {a} / (p.a95 + 1e-8) AS amount_ratio_to_95th,
    abs({a} - p.a50) / (p.a50 + 1e-8) AS amount_volatility"""


CARD_F1 = f"""card_f1 AS (
  SELECT s.row_id, s.split, s.is_fraudulent, s.time, {", ".join(f"s.v{i}" for i in V)},
    s.amount, s.transaction_hour,
    {_amount()},
    list_avg({VLIST}) AS v_features_mean,
    list_stddev_samp({VLIST}) AS v_features_std,
    list_max({VLIST}) AS v_features_max,
    list_min({VLIST}) AS v_features_min,
    list_max({VLIST}) - list_min({VLIST}) AS v_features_range,
    list_avg(list_transform({VLIST}, lambda x: abs(x))) AS v_features_abs_mean,
    {_temporal()}
  FROM card_split s CROSS JOIN card_p p)"""

CARD_BS = f"""card_bs AS (
  SELECT split, {", ".join(f"avg(v{i}) AS m{i}, stddev_samp(v{i}) AS s{i}" for i in V)},
         quantile_cont(v_features_mean, 0.95) AS qm, quantile_cont(v_features_std, 0.95) AS qs
  FROM card_f1 GROUP BY split)"""

_VOUT = " OR ".join(f"coalesce(abs(f.v{i} - b.m{i}) > 2 * b.s{i}, false)" for i in V)

CARD_F = f"""card_f2 AS (
  SELECT f.*,
    f.amount * f.v_features_mean AS amount_v_mean_interaction,
    f.amount * f.v_features_std AS amount_v_std_interaction,
    f.amount * f.hour AS amount_hour_interaction, f.amount * f.day_of_week AS amount_day_interaction,
    {", ".join(f"f.amount * f.v{k} AS amount_v{k}_interaction" for k in range(1, 11))},
    {", ".join(f"f.hour * f.v{k} AS hour_v{k}_interaction" for k in range(1, 6))},
    CAST(f.amount > p.a95 AND f.is_late_night = 1 AS INTEGER) AS high_risk_combination,
    CAST(f.is_high_risk_hour = 1 AND f.amount > p.a75 AS INTEGER) AS suspicious_time_pattern,
    CAST(f.is_weekend = 1 AND f.amount > p.a90 AS INTEGER) AS weekend_high_value,
    (f.amount - p.a50) / (p.a75 - p.a50 + 1e-8) AS amount_z_score,
    CAST(abs((f.amount - p.a50) / (p.a75 - p.a50 + 1e-8)) > 2 AS INTEGER) AS amount_outlier,
    CAST({_VOUT} AS INTEGER) AS v_features_outlier,
    CAST(({_VOUT}) AND f.amount > p.a75 AS INTEGER) AS high_v_features_risk,
    CAST(f.is_rush_hour = 1 AND f.amount > p.a90 AS INTEGER) AS rush_hour_high_value,
    CAST(coalesce(f.v_features_mean > b.qm, false) AS INTEGER) AS _vm_hi,
    CAST(coalesce(f.v_features_std > b.qs, false) AS INTEGER) AS _vs_hi
  FROM card_f1 f JOIN card_bs b ON b.split = f.split CROSS JOIN card_p p),
card_f3 AS (
  SELECT * EXCLUDE (_vm_hi, _vs_hi),
    CAST(3 * amount_above_95 + 2 * is_late_night + 3 * amount_outlier + 4 * high_risk_combination
      + 3 * suspicious_time_pattern + 2.5 * weekend_high_value + 2.5 * rush_hour_high_value
      + 3 * v_features_outlier + 4 * high_v_features_risk + 2 * _vm_hi + 2 * _vs_hi AS DOUBLE)
      AS comprehensive_risk_score
  FROM card_f2),
card_f AS (
  SELECT *, CAST(comprehensive_risk_score <= 2 AS INTEGER) AS low_risk,
    CAST(comprehensive_risk_score > 2 AND comprehensive_risk_score <= 6 AS INTEGER) AS medium_risk,
    CAST(comprehensive_risk_score > 6 AS INTEGER) AS high_risk
  FROM card_f3)"""

CARD_FEATURES = [CARD, CLEAN_CARD, CARD_POS, CARD_SPLIT, CARD_P, CARD_F1, CARD_BS, CARD_F]

# ---------------------------------------------------------------------------
# shop
# ---------------------------------------------------------------------------

SHOP = """first_order AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey),
shop AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
         o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INT)) AS transaction_date,
         l.l_extendedprice * (1 - l.l_discount) AS transaction_amount,
         l.l_quantity AS quantity, CAST(13 + c.c_custkey % 90 AS INTEGER) AS customer_age,
         CAST(date_diff('day', f.first_date, o.o_orderdate) AS INTEGER) AS account_age_days,
         n.n_name AS customer_location, o.o_orderpriority AS payment_method,
         p.p_type AS product_category, c.c_mktsegment AS device_used,
         CASE WHEN l.l_returnflag = 'R' AND l.l_discount >= 0.09 THEN 1 ELSE 0 END AS is_fraudulent
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN first_order f ON f.o_custkey = o.o_custkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey)"""

CLEAN_SHOP = """shop_stats AS (
  SELECT quantile_cont(abs(transaction_amount), 0.99) AS qa, quantile_cont(abs(quantity), 0.99) AS qq
  FROM shop),
clean_shop0 AS (
  SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.l_extendedprice, s.transaction_date,
    CASE WHEN abs(s.transaction_amount) > t.qa THEN t.qa ELSE abs(s.transaction_amount) END AS transaction_amount,
    CASE WHEN abs(s.quantity) > t.qq THEN t.qq ELSE abs(s.quantity) END AS quantity,
    CAST(CASE WHEN s.customer_age < 13 THEN 13 WHEN s.customer_age > 100 THEN 100 ELSE s.customer_age END
         AS INTEGER) AS customer_age,
    CAST(CASE WHEN abs(s.account_age_days) > 3650 THEN 3650 ELSE abs(s.account_age_days) END AS INTEGER)
      AS account_age_days,
    s.customer_location, s.payment_method, s.product_category, s.device_used, s.is_fraudulent,
    CAST(hour(s.transaction_date) AS INTEGER) AS transaction_hour
  FROM shop s CROSS JOIN shop_stats t),
clean_shop AS (
  SELECT row_number() OVER (ORDER BY transaction_date, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            quantity, l_extendedprice) - 1 AS row_id,
         * EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
  FROM clean_shop0)"""

SHOP_SPLIT = """shop_split AS (
  SELECT *, CASE WHEN row_id < floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split,
    CASE WHEN customer_age > 0 AND customer_age <= 18 THEN 'teen'
         WHEN customer_age > 18 AND customer_age <= 25 THEN 'young'
         WHEN customer_age > 25 AND customer_age <= 35 THEN 'adult'
         WHEN customer_age > 35 AND customer_age <= 50 THEN 'middle'
         WHEN customer_age > 50 AND customer_age <= 65 THEN 'senior'
         WHEN customer_age > 65 AND customer_age <= 100 THEN 'elderly' END AS age_group
  FROM clean_shop)"""

SHOP_P = """shop_p AS (
  SELECT quantile_cont(transaction_amount, 0.25) AS a25, quantile_cont(transaction_amount, 0.5) AS a50,
         quantile_cont(transaction_amount, 0.75) AS a75, quantile_cont(transaction_amount, 0.9) AS a90,
         quantile_cont(transaction_amount, 0.95) AS a95,
         quantile_cont(quantity, 0.25) AS q25, quantile_cont(quantity, 0.5) AS q50,
         quantile_cont(quantity, 0.75) AS q75, quantile_cont(quantity, 0.9) AS q90,
         quantile_cont(quantity, 0.95) AS q95,
         avg(hour(transaction_date)) AS hmean, stddev_samp(hour(transaction_date)) AS hstd,
         count(*) AS n_train
  FROM shop_split WHERE split = 'train'),
enc_age AS (
  SELECT age_group AS category, CAST(row_number() OVER (ORDER BY age_group) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT age_group FROM shop_split WHERE split = 'train' AND age_group IS NOT NULL)),
enc_loc AS (
  SELECT customer_location AS category, count(*) AS freq, count(*) / max(p.n_train) AS share
  FROM shop_split CROSS JOIN shop_p p WHERE split = 'train' GROUP BY customer_location),
enc_pm AS (
  SELECT payment_method AS category, avg(is_fraudulent) AS rate,
         CAST(row_number() OVER (ORDER BY payment_method) - 1 AS INTEGER) AS code
  FROM shop_split WHERE split = 'train' GROUP BY payment_method),
enc_pc AS (
  SELECT product_category AS category, avg(is_fraudulent) AS rate,
         CAST(row_number() OVER (ORDER BY product_category) - 1 AS INTEGER) AS code
  FROM shop_split WHERE split = 'train' GROUP BY product_category),
enc_du AS (
  SELECT device_used AS category, avg(is_fraudulent) AS rate,
         CAST(row_number() OVER (ORDER BY device_used) - 1 AS INTEGER) AS code
  FROM shop_split WHERE split = 'train' GROUP BY device_used)"""

SHOP_F1 = f"""shop_f1 AS (
  SELECT s.row_id, s.split, s.is_fraudulent, s.transaction_amount, s.quantity, s.customer_age,
    s.account_age_days, s.transaction_hour,
    {_amount("s.transaction_amount")},
    {_temporal()},
    ea.code AS age_group_encoded,
    CAST(s.customer_age <= 18 AS INTEGER) AS young_customer,
    CAST(s.customer_age >= 65 AS INTEGER) AS senior_customer,
    CASE WHEN s.customer_age <= 18 THEN 2 WHEN s.customer_age >= 65 THEN 1 ELSE 0 END AS age_risk,
    ln(1 + s.account_age_days) AS account_age_days_log,
    s.account_age_days / 7 AS account_age_weeks, s.account_age_days / 30 AS account_age_months,
    CAST(s.account_age_days <= 7 AS INTEGER) AS new_account,
    CAST(s.account_age_days <= 30 AS INTEGER) AS recent_account,
    CAST(s.account_age_days > 90 AS INTEGER) AS established_account,
    CAST(s.account_age_days > 365 AS INTEGER) AS old_account,
    CASE WHEN s.account_age_days <= 7 THEN 3 WHEN s.account_age_days <= 30 THEN 2
         WHEN s.account_age_days <= 90 THEN 1 ELSE 0 END AS account_age_risk,
    CAST(coalesce(el.freq, 0) AS DOUBLE) AS location_freq,
    coalesce(el.share, 0.0) AS location_risk_score,
    CAST(coalesce(el.freq, 0) <= 5 AS INTEGER) AS rare_location,
    pm.code AS payment_method_encoded, coalesce(pm.rate, 0.0) AS payment_method_fraud_rate,
    pc.code AS product_category_encoded, coalesce(pc.rate, 0.0) AS product_category_fraud_rate,
    du.code AS device_used_encoded, coalesce(du.rate, 0.0) AS device_used_fraud_rate,
    ln(1 + s.quantity) AS quantity_log, s.quantity / (s.account_age_days + 1) AS quantity_per_day,
    (s.quantity - p.q50) / (CASE WHEN p.q75 - p.q25 = 0 THEN 1.0 ELSE p.q75 - p.q25 END) AS quantity_scaled,
    CAST(s.quantity > p.q75 AS INTEGER) AS quantity_above_75,
    CAST(s.quantity > p.q90 AS INTEGER) AS quantity_above_90,
    CAST(s.quantity > p.q95 AS INTEGER) AS quantity_above_95,
    CAST(s.transaction_amount > p.a90 AND s.quantity <= 1 AS INTEGER) AS high_value_low_quantity,
    CAST(s.transaction_amount < p.a50 AND s.quantity > p.q90 AS INTEGER) AS low_value_high_quantity,
    s.transaction_amount / (s.quantity + 1) AS avg_amount_per_item,
    s.transaction_amount / (s.quantity * s.account_age_days + 1) AS purchase_efficiency,
    1.0 / (s.account_age_days + 1) AS transaction_velocity,
    s.transaction_amount / (s.account_age_days + 1) AS amount_velocity,
    s.quantity / (s.account_age_days + 1) AS quantity_velocity,
    s.transaction_amount AS amount_per_transaction, s.quantity AS quantity_per_transaction,
    CAST(s.transaction_amount / (s.account_age_days + 1) > p.a95 AS INTEGER) AS high_amount_velocity,
    CAST(s.quantity / (s.account_age_days + 1) > p.q95 AS INTEGER) AS high_quantity_velocity
  FROM shop_split s CROSS JOIN shop_p p
  LEFT JOIN enc_age ea ON ea.category = s.age_group
  LEFT JOIN enc_loc el ON el.category = s.customer_location
  LEFT JOIN enc_pm pm ON pm.category = s.payment_method
  LEFT JOIN enc_pc pc ON pc.category = s.product_category
  LEFT JOIN enc_du du ON du.category = s.device_used)"""

SHOP_F = """shop_f2 AS (
  SELECT f.*,
    CAST(f.high_value_low_quantity = 1 OR f.low_value_high_quantity = 1 AS INTEGER) AS unusual_purchase_pattern,
    CAST(f.high_amount_velocity * 2.0 + f.high_quantity_velocity * 1.5 + f.new_account * 2.0 AS DOUBLE)
      AS velocity_risk_score
  FROM shop_f1 f),
shop_f3 AS (
  SELECT f.*,
    f.transaction_amount * f.quantity AS amount_quantity_interaction,
    f.transaction_amount / (f.quantity + 1) AS amount_quantity_ratio,
    f.customer_age * f.account_age_days AS age_account_interaction,
    f.customer_age / (f.account_age_days + 1) AS age_account_ratio,
    f.transaction_amount * f.hour AS amount_hour_interaction,
    f.transaction_amount * f.day_of_week AS amount_day_interaction,
    f.transaction_amount * f.age_risk AS amount_risk_interaction,
    f.quantity * f.account_age_risk AS quantity_risk_interaction,
    f.location_freq * f.device_used_encoded AS location_device_interaction,
    f.payment_method_encoded * f.product_category_encoded AS payment_product_interaction,
    f.customer_age * f.transaction_amount * f.hour AS age_amount_time_interaction,
    f.account_age_days * f.quantity * f.location_freq AS account_quantity_location_interaction,
    CAST(f.transaction_amount > p.a95 AND f.is_late_night = 1 AS INTEGER) AS high_risk_combination,
    CAST(f.new_account = 1 AND f.transaction_amount > p.a90 AS INTEGER) AS new_account_high_amount,
    CAST(f.young_customer = 1 AND f.transaction_amount > p.a75 AS INTEGER) AS young_customer_high_amount,
    CAST(f.rare_location = 1 AND f.transaction_amount > p.a75 AS INTEGER) AS rare_location_high_amount,
    CAST(f.is_high_risk_hour = 1 AND f.transaction_amount > p.a75 AS INTEGER) AS suspicious_time_pattern,
    CAST(f.is_weekend = 1 AND f.transaction_amount > p.a90 AS INTEGER) AS weekend_high_value,
    CAST(f.device_used_fraud_rate > 0.1 AND f.transaction_amount > p.a75 AS INTEGER) AS high_risk_device,
    CAST(f.payment_method_fraud_rate > 0.1 AND f.transaction_amount > p.a75 AS INTEGER) AS high_risk_payment,
    CAST(f.product_category_fraud_rate > 0.1 AND f.transaction_amount > p.a75 AS INTEGER) AS high_risk_product,
    (f.transaction_amount - p.a50) / (p.a75 - p.a50 + 1e-8) AS amount_z_score,
    (f.quantity - p.q50) / (p.q75 - p.q50 + 1e-8) AS quantity_z_score,
    CAST(abs((f.transaction_amount - p.a50) / (p.a75 - p.a50 + 1e-8)) > 2 AS INTEGER) AS amount_outlier,
    CAST(abs((f.quantity - p.q50) / (p.q75 - p.q50 + 1e-8)) > 2 AS INTEGER) AS quantity_outlier,
    CAST(f.velocity_risk_score > 3 AND f.transaction_amount > p.a75 AS INTEGER) AS velocity_anomaly,
    CAST(f.age_risk > 0 AND f.account_age_risk > 1 AND f.transaction_amount > p.a75 AS INTEGER)
      AS high_risk_customer_profile,
    CAST(f.location_risk_score > 0.05 AND f.transaction_amount > p.a90 AS INTEGER) AS foreign_high_value,
    CAST(f.is_rush_hour = 1 AND f.transaction_amount > p.a90 AS INTEGER) AS rush_hour_high_value,
    CAST(f.new_account = 1 AND f.is_late_night = 1 AND f.transaction_amount > p.a90 AS INTEGER)
      AS multi_risk_pattern,
    CAST(f.young_customer = 1 AND f.rare_location = 1 AND f.is_high_risk_hour = 1
         AND f.transaction_amount > p.a75 AS INTEGER) AS sophisticated_fraud_pattern
  FROM shop_f2 f CROSS JOIN shop_p p),
shop_f4 AS (
  SELECT *, CAST(amount_outlier = 1 AND quantity_outlier = 1 AS INTEGER) AS unusual_amount_pattern FROM shop_f3),
shop_f5 AS (
  SELECT *, CAST(3 * amount_above_95 + 2 * is_late_night + 3 * new_account + 2 * young_customer
      + 2 * rare_location + 2 * quantity_above_95 + 4 * high_risk_combination + 4 * new_account_high_amount
      + 3 * young_customer_high_amount + 3 * rare_location_high_amount + 2 * unusual_purchase_pattern
      + 2 * velocity_risk_score + 3 * suspicious_time_pattern + 2.5 * weekend_high_value
      + 3 * high_risk_device + 3 * high_risk_payment + 3 * high_risk_product + 4 * unusual_amount_pattern
      + 4 * velocity_anomaly + 4 * high_risk_customer_profile + 3.5 * foreign_high_value
      + 2.5 * rush_hour_high_value + 5 * multi_risk_pattern + 6 * sophisticated_fraud_pattern AS DOUBLE)
      AS comprehensive_risk_score
  FROM shop_f4),
shop_f AS (
  SELECT *, CAST(comprehensive_risk_score <= 2 AS INTEGER) AS low_risk,
    CAST(comprehensive_risk_score > 2 AND comprehensive_risk_score <= 6 AS INTEGER) AS medium_risk,
    CAST(comprehensive_risk_score > 6 AS INTEGER) AS high_risk
  FROM shop_f5)"""

SHOP_FEATURES = [SHOP, CLEAN_SHOP, SHOP_SPLIT, SHOP_P, SHOP_F1, SHOP_F]
