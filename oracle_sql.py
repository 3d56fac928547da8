"""DuckDB oracle SQL for the registered queries (run against the same parquet tables).

Independent of the Spark code: plain SQL over the pre-registered views. Dialect notes:
DuckDB's dayofweek is 0-based (Spark: 1=Sunday), its casts to integer round where Spark's
truncate (hence trunc()), and it has no xxhash64 (splits use an integer hash both can run).
Floating aggregates are compared at 8 decimals (past the last digit of any terminating mean of the test data, so no rounding ties).
"""

from __future__ import annotations

TRIPS = """trips AS (
    SELECT CAST(event_id % 2 + 1 AS INTEGER) AS VendorID,
           ts AS tpep_pickup_datetime,
           ts + to_seconds(CAST(floor(value * 60 + 0.5) AS BIGINT)) AS tpep_dropoff_datetime,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id % 7 AS BIGINT) END AS passenger_count,
           value * 0.45 AS trip_distance,
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 50 = 1 THEN CAST(99 AS BIGINT)
                ELSE CAST(1 + event_id % 6 AS BIGINT) END AS RatecodeID,
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 1 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
           event_type AS payment_type,
           value * 1.5 - 1.0 AS fare_amount,
           value * 1.5 AS total_amount,
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST(1.75 AS DOUBLE)
                ELSE CAST(0 AS DOUBLE) END AS Airport_fee,
           CASE WHEN event_id % 40 = 3 THEN NULL ELSE CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee
    FROM events)"""

TRIP_COLUMNS = [
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("RatecodeID", "bigint"),
    ("store_and_fwd_flag", "string"),
    ("payment_type", "string"),
    ("fare_amount", "double"),
    ("total_amount", "double"),
    ("Airport_fee", "double"),
    ("cbd_congestion_fee", "double"),
]

LINEITEM_COLUMNS = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]

ORDERS_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]

NUMERIC = {"int", "bigint", "double"}


def bucket(key: str) -> str:
    return f"CAST((({key}) % 2147483647 * 2654435761) % 4294967296 * 100 // 4294967296 AS INTEGER)"


def features(src: str) -> str:
    return f"""SELECT VendorID, passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, payment_type,
           fare_amount, total_amount, Airport_fee, cbd_congestion_fee,
           CAST(trunc(epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60) AS INTEGER) AS duration_minutes,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_week,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
           {bucket("CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT) * 7919 + CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)")} AS split_bucket
    FROM {src}"""


OUTLIER_RULES = [
    ("trip_distance_positive", "trip_distance > 0"),
    ("trip_distance_at_most_max", "trip_distance <= 200"),
    ("passenger_count_positive", "passenger_count > 0"),
    ("duration_positive", "duration_minutes > 0"),
    ("fare_amount_positive", "fare_amount > 0"),
    ("total_amount_positive", "total_amount > 0"),
    ("duration_at_most_max", "duration_minutes <= 240"),
    ("ratecode_not_excluded", "RatecodeID <> 99"),
]
OUTLIER_WHERE = " AND ".join(p for _, p in OUTLIER_RULES)


MODE_GAPS = ("tpep_dropoff_datetime", "fare_amount", "payment_type")


def _mode(col: str, src: str = "trips") -> str:
    return f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _trunc_mean(col: str, src: str = "trips") -> str:
    return f"(SELECT CAST(trunc(avg({col})) AS BIGINT) FROM {src})"


# The sequential rule on this data: passenger_count, RatecodeID (14.29 % null: bigint mean,
# truncated), store_and_fwd_flag (string: mode), Airport_fee (double: mean) are filled;
# cbd_congestion_fee (2.5 % null) is the last column, so its drop does not move the means.
IMPUTED = f"""imputed AS (
    SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
           coalesce(passenger_count, {_trunc_mean('passenger_count')}) AS passenger_count,
           trip_distance,
           coalesce(RatecodeID, {_trunc_mean('RatecodeID')}) AS RatecodeID,
           coalesce(store_and_fwd_flag, {_mode('store_and_fwd_flag')}) AS store_and_fwd_flag,
           payment_type, fare_amount, total_amount,
           coalesce(Airport_fee, (SELECT avg(Airport_fee) FROM trips)) AS Airport_fee,
           cbd_congestion_fee
    FROM trips WHERE cbd_congestion_fee IS NOT NULL)"""

SILVER_CTES = f"""{TRIPS},
{IMPUTED},
deduped AS (SELECT DISTINCT * FROM imputed),
featured AS ({features('deduped')}),
silver AS (SELECT * FROM featured WHERE {OUTLIER_WHERE}),
silver_enc AS (
    SELECT * REPLACE (CASE WHEN store_and_fwd_flag = 'N' THEN 0 WHEN store_and_fwd_flag = 'Y' THEN 1 END AS store_and_fwd_flag)
    FROM silver)"""

CATEGORY_COLUMNS = ["pickup_month", "pickup_hour", "pickup_day_week", "store_and_fwd_flag", "payment_type", "RatecodeID", "VendorID"]

SILVER_NUMERIC = [
    "VendorID", "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag", "fare_amount",
    "total_amount", "Airport_fee", "cbd_congestion_fee", "duration_minutes", "pickup_hour",
    "pickup_day_week", "pickup_month",
]


def _null_profile(table: str, cols: list[tuple[str, str]], prefix: str = "") -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        nan = f"count(*) FILTER (WHERE isnan({c}))" if t == "double" else "CAST(0 AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS position, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {nan} AS nan_count, "
            f"round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE), 8) AS null_pct "
            f"FROM {table}"
        )
    return prefix + "\nUNION ALL\n".join(parts)


def _describe(table: str, cols: list[tuple[str, str]], prefix: str = "") -> str:
    parts = []
    for c, t in cols:
        if t not in NUMERIC:
            continue
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({x}), 8) AS mean, "
            f"round(stddev_samp({x}), 8) AS stddev, round(min({x}), 8) AS \"min\", round(max({x}), 8) AS \"max\" FROM {table}"
        )
    return prefix + "\nUNION ALL\n".join(parts)


def _describe_all(table: str, cols: list[tuple[str, str]], prefix: str = "") -> str:
    parts = []
    for c, t in cols:
        if t in NUMERIC:
            x, text = f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)"
        elif t == "string":
            x, text = "CAST(NULL AS DOUBLE)", c
        else:
            continue
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({x}), 8) AS mean, round(stddev_samp({x}), 8) AS stddev, "
            f"round(min({x}), 8) AS \"min\", round(max({x}), 8) AS \"max\", min({text}) AS min_text, max({text}) AS max_text FROM {table}"
        )
    return prefix + "\nUNION ALL\n".join(parts)


def _policy_steps(columns: list[tuple[str, str]]) -> str:
    """The sequential rule as a chain of steps over ``v``, each deciding from the frame that the one before left."""
    steps, before = [], "v"
    for i, (c, t) in enumerate(columns):
        mean = f"SELECT avg({c}) FROM {before}" if t == "DOUBLE" else f"SELECT CAST(trunc(avg({c})) AS {t}) FROM {before}"
        below = f"(SELECT count(*) FILTER ({c} IS NULL) * 100.0 FROM {before}) < 5 * (SELECT count(*) FROM v)"
        steps.append(f"s{i} AS (SELECT * REPLACE (coalesce({c}, ({mean})) AS {c}) FROM {before} WHERE {c} IS NOT NULL OR NOT {below})")
        before = f"s{i}"
    return ",\n".join(steps) + f"\nSELECT * REPLACE (round(fare_amount, 8) AS fare_amount, round(total_amount, 8) AS total_amount) FROM {before}"


def _profile_columns() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS position, '{t}' AS data_type, count(*) AS n_rows, "
        f"CAST({len(TRIP_COLUMNS)} AS INTEGER) AS n_columns, count({c}) AS n_non_null FROM trips"
        for i, (c, t) in enumerate(TRIP_COLUMNS)
    ]
    return f"WITH {TRIPS}\n" + "\nUNION ALL\n".join(parts)


def _dup(name: str, src: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {src}) AS n_rows, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS n_distinct, "
        f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS n_duplicates"
    )


def _pair(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    xv = f"CASE WHEN {both} THEN CAST({x} AS DOUBLE) END"
    yv = f"CASE WHEN {both} THEN CAST({y} AS DOUBLE) END"
    return f"covar_pop({xv}, {yv}) / nullif(sqrt(var_pop({xv}) * var_pop({yv})), 0)"


def _corr_long() -> str:
    cols = SILVER_NUMERIC
    idx = {}
    aggs = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            idx[(i, j)] = f"c_{i}_{j}"
            aggs.append(f"{_pair(cols[i], cols[j])} AS c_{i}_{j}")
    f1, f2, vals = [], [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            f1.append(f"'{a}'")
            f2.append(f"'{b}'")
            vals.append(idx[(min(i, j), max(i, j))])
    return (
        f"corr_long AS (SELECT unnest([{', '.join(f1)}]) AS feature1, unnest([{', '.join(f2)}]) AS feature2, "
        f"unnest([{', '.join(vals)}]) AS corr_value FROM (SELECT {', '.join(aggs)} FROM silver_enc))"
    )


def queries_sql() -> dict[str, str]:
    s = f"WITH {SILVER_CTES}\n"
    t = f"WITH {TRIPS}\n"
    out: dict[str, str] = {
        "scan_trips": t + "SELECT * FROM trips",
        "bronze_counts": "SELECT 'trips' AS table_name, count(*) AS n_rows, CAST(12 AS INTEGER) AS n_columns FROM events",
        "bronze_extra_columns": t
        + ", extra AS (SELECT *, total_amount - fare_amount AS new_fee FROM trips)\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS position, '{typ}' AS data_type, count(*) AS n_rows, "
            f"count({c}) AS n_non_null, {'false' if c == 'new_fee' else 'true'} AS declared FROM extra"
            for i, (c, typ) in enumerate([*TRIP_COLUMNS, ("new_fee", "double")])
        ),
        "roundtrip_parquet": t + "SELECT * FROM trips",
        "silver_trips": s + "SELECT * FROM silver",
        "null_profile": _null_profile("trips", TRIP_COLUMNS, t),
        "null_profile_lineitem": _null_profile("lineitem", LINEITEM_COLUMNS),
        "null_profile_orders": _null_profile("orders", ORDERS_COLUMNS),
        "describe_orders": _describe("orders", ORDERS_COLUMNS),
        "profile_columns": _profile_columns(),
        "describe_numeric": _describe("trips", TRIP_COLUMNS, t),
        "describe_columns": _describe_all("trips", TRIP_COLUMNS, t),
        "describe_orders_columns": _describe_all("orders", ORDERS_COLUMNS),
        "describe_lineitem": _describe("lineitem", LINEITEM_COLUMNS),
        "duplicate_report": t
        + ", twice AS (SELECT * FROM trips UNION ALL SELECT * FROM trips)\n"
        + "\nUNION ALL\n".join([_dup("trips", "trips"), _dup("trips_twice", "twice"), _dup("lineitem", "lineitem"), _dup("orders", "orders")]),
        "drop_sparse_nulls": t + "SELECT * FROM trips WHERE cbd_congestion_fee IS NOT NULL",
        "impute_mean": t
        + f"""SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
           coalesce(passenger_count, {_trunc_mean('passenger_count')}) AS passenger_count,
           trip_distance,
           coalesce(RatecodeID, {_trunc_mean('RatecodeID')}) AS RatecodeID,
           store_and_fwd_flag, payment_type, fare_amount, total_amount,
           coalesce(Airport_fee, (SELECT avg(Airport_fee) FROM trips)) AS Airport_fee,
           coalesce(cbd_congestion_fee, (SELECT avg(cbd_congestion_fee) FROM trips)) AS cbd_congestion_fee
    FROM trips""",
        "impute_mode": t
        + f"""SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
           coalesce(passenger_count, {_mode('passenger_count')}) AS passenger_count,
           trip_distance,
           coalesce(RatecodeID, {_mode('RatecodeID')}) AS RatecodeID,
           coalesce(store_and_fwd_flag, {_mode('store_and_fwd_flag')}) AS store_and_fwd_flag,
           payment_type, fare_amount, total_amount,
           coalesce(Airport_fee, {_mode('Airport_fee')}) AS Airport_fee,
           coalesce(cbd_congestion_fee, {_mode('cbd_congestion_fee')}) AS cbd_congestion_fee
    FROM trips""",
        "impute_mode_unique": t
        + f""", gaps AS (
            SELECT tpep_pickup_datetime, {", ".join(f"CASE WHEN day(tpep_pickup_datetime) % 3 <> 0 THEN {c} END AS {c}" for c in MODE_GAPS)} FROM trips)
           SELECT tpep_pickup_datetime, {", ".join(f"coalesce({c}, {_mode(c, 'gaps')}) AS {c}" for c in MODE_GAPS)} FROM gaps""",
        "impute_policy": f"WITH {TRIPS},\n{IMPUTED}\nSELECT * FROM imputed",
        "impute_policy_order": """WITH v AS (
            SELECT CASE WHEN event_id % 30 <> 0 THEN CAST(event_id % 2 + 1 AS INTEGER) END AS VendorID, ts AS tpep_pickup_datetime,
                   CASE WHEN event_id % 15 <> 0 THEN CAST(event_id % 2 + 3 AS BIGINT) END AS passenger_count,
                   CASE WHEN event_id % 7 <> 3 THEN value * 1.5 - 1.0 END AS fare_amount, value * 1.5 AS total_amount FROM events),
        """
        + _policy_steps([("VendorID", "INTEGER"), ("passenger_count", "BIGINT"), ("fare_amount", "DOUBLE"), ("total_amount", "DOUBLE")]),
        "dedup_rows": t + "SELECT DISTINCT * FROM (SELECT * FROM trips UNION ALL SELECT * FROM trips)",
        "distinct_months": t + "SELECT DISTINCT CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month FROM trips",
        "time_features": t + features("trips"),
        "encode_flag": t
        + "SELECT * REPLACE (CASE WHEN store_and_fwd_flag = 'N' THEN 0 WHEN store_and_fwd_flag = 'Y' THEN 1 END AS store_and_fwd_flag) FROM trips",
        "log_target": s
        + "SELECT round(trip_distance, 8) AS trip_distance, duration_minutes, round(ln(1 + duration_minutes), 8) AS duration_log, "
        "round(exp(ln(1 + duration_minutes)) - 1, 8) AS duration_restored FROM silver",
        "outlier_filter": t + f"SELECT * FROM ({features('trips')}) WHERE {OUTLIER_WHERE}",
        "outlier_reject_reasons": t
        + f", featured AS ({features('trips')})\n"
        + "\nUNION ALL\n".join(
            [f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS n_rows FROM featured" for name, p in OUTLIER_RULES]
            + [
                f"SELECT 'any_rule' AS rule, count(*) FILTER (WHERE NOT coalesce({OUTLIER_WHERE}, false)) AS n_rows FROM featured",
                f"SELECT 'kept' AS rule, count(*) FILTER (WHERE coalesce({OUTLIER_WHERE}, false)) AS n_rows FROM featured",
            ]
        ),
        "avg_duration_by_hour": s + "SELECT pickup_hour, round(avg(duration_minutes), 8) AS avgduration FROM silver GROUP BY pickup_hour",
        "avg_duration_one_hour": s
        + "SELECT pickup_hour, round(avg(duration_minutes), 8) AS avgduration FROM silver WHERE pickup_hour = 8 GROUP BY pickup_hour",
        "avg_duration_out_of_range_hour": s
        + "SELECT pickup_hour, round(avg(duration_minutes), 8) AS avgduration FROM silver GROUP BY pickup_hour",
        "avg_duration_one_hour_sql": s
        + "SELECT pickup_hour, round(avg(duration_minutes), 8) AS avgduration FROM silver WHERE pickup_hour = 8 GROUP BY pickup_hour",
        "payment_analysis": s
        + "SELECT payment_type, count(*) AS total_trips, round(avg(duration_minutes), 8) AS avg_duration FROM silver GROUP BY payment_type",
        "payment_analysis_sql": s
        + "SELECT payment_type, count(*) AS total_trips, round(avg(duration_minutes), 8) AS avg_duration FROM silver GROUP BY payment_type",
        "avg_duration_by_category": s
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS category, CAST({c} AS VARCHAR) AS category_value, count(*) AS n_trips, "
            f"round(avg(duration_minutes), 8) AS avg_duration FROM silver_enc GROUP BY {c}"
            for c in CATEGORY_COLUMNS
        ),
        "corr_matrix": f"WITH {SILVER_CTES},\n{_corr_long()}\nSELECT feature1, feature2, round(corr_value, 8) AS corr_value FROM corr_long",
        "corr_matrix_wide": f"WITH {SILVER_CTES},\n{_corr_long()}\nSELECT feature1, "
        + ", ".join(f"round(max(CASE WHEN feature2 = '{c}' THEN corr_value END), 8) AS {c}" for c in SILVER_NUMERIC)
        + " FROM corr_long GROUP BY feature1",
        "duration_histogram": s
        + "SELECT CAST(floor(CAST(duration_minutes AS DOUBLE) / 5.0) * 5.0 AS DOUBLE) AS bucket_start, count(*) AS n_rows FROM silver GROUP BY 1",
        "histogram_lineitem_quantity": "SELECT CAST(floor(l_quantity / 5.0) * 5.0 AS DOUBLE) AS bucket_start, count(*) AS n_rows "
        "FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1",
    }
    out["feature_frame"] = s + (
        "SELECT [trip_distance, CAST(pickup_hour AS DOUBLE), CAST(pickup_month AS DOUBLE), Airport_fee, "
        "CAST(pickup_day_week AS DOUBLE), CAST(RatecodeID AS DOUBLE), fare_amount] AS features, "
        "duration_minutes, round(ln(1 + duration_minutes), 8) AS duration_log FROM silver"
    )
    out["train_test_split"] = (
        "SELECT event_id, CASE WHEN ((event_id % 2147483647) * 2654435761) % 4294967296 * 100 // 4294967296 < 70 "
        "THEN 'train' ELSE 'test' END AS split FROM events"
    )
    base = "(SELECT CAST(duration_minutes AS DOUBLE) AS y, trip_distance * 2.2 AS p FROM silver)"
    out["eval_r2"] = s + (
        f"SELECT count(y - p) AS n, round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y - p)), 8) AS r2 FROM {base}"
    )
    out["eval_mae"] = s + (
        f"SELECT count(y - p) AS n, round(avg(abs(y - p)), 8) AS mae, round(sqrt(sum((y - p) * (y - p)) / count(y - p)), 8) AS rmse FROM {base}"
    )
    # Spark casts a double to decimal by rounding its printed (shortest) form half up; DuckDB rounds
    # the binary value. Going through the printed form states Spark's rule in DuckDB.
    def money(c: str, p: int) -> str:
        return f"CAST(CAST({c} AS VARCHAR) AS DECIMAL({p},2)) AS {c}"

    out["silver_relational"] = s + (
        "SELECT CAST(VendorID AS SMALLINT) AS VendorID, CAST(passenger_count AS SMALLINT) AS passenger_count, "
        f"{money('trip_distance', 6)}, CAST(RatecodeID AS SMALLINT) AS RatecodeID, store_and_fwd_flag, payment_type, "
        f"{money('fare_amount', 10)}, {money('total_amount', 10)}, {money('Airport_fee', 10)}, "
        f"{money('cbd_congestion_fee', 10)}, CAST(duration_minutes AS DECIMAL(10,2)) AS duration_minutes, pickup_hour, pickup_day_week, pickup_month FROM silver"
    )
    inputs = "trip_distance, pickup_hour, pickup_month, Airport_fee, pickup_day_week, RatecodeID, fare_amount"
    present = " AND ".join(f"{c} IS NOT NULL" for c in inputs.split(", "))
    valid = (
        f"{present} AND pickup_hour BETWEEN 0 AND 23 AND pickup_month BETWEEN 1 AND 12 AND pickup_day_week BETWEEN 1 AND 7 "
        "AND RatecodeID >= 1 AND trip_distance >= 0 AND Airport_fee >= 0 AND fare_amount >= 0"
    )
    out["train_split_counts"] = s + "SELECT CASE WHEN split_bucket < 70 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows FROM silver GROUP BY 1"
    out["linear_fit_distance"] = s + (
        "SELECT count(*) AS n, round(regr_slope(duration_minutes, trip_distance), 6) AS slope, "
        "round(regr_intercept(duration_minutes, trip_distance), 6) AS intercept, round(regr_r2(duration_minutes, trip_distance), 6) AS r2 FROM silver"
    )
    out["model_roundtrip_equal"] = s + "SELECT count(*) AS n, count(*) AS n_equal FROM silver WHERE split_bucket >= 70"
    out["tree_routes_equal"] = s + (
        "SELECT model, count(*) AS n, count(*) AS n_equal FROM silver, (VALUES ('gbt'), ('rf')) AS m(model) WHERE split_bucket >= 70 GROUP BY model"
    )
    out["first_tree_leaves"] = s + "SELECT count(*) AS n_rows, count(*) AS n_counted, true AS all_equal FROM silver WHERE split_bucket < 70"
    out["score_requests_flags"] = t + (
        f"SELECT {inputs}, duration_minutes, coalesce({valid}, false) AS payload_valid, {present} AS has_prediction FROM ({features('trips')})"
    )
    out["prediction_log_entries"] = s + f"SELECT {inputs}, 'gbt_duration_minutes_v1' AS model_version, CAST(NULL AS INTEGER) AS user_id FROM silver"
    out["stream_score_inputs"] = f"WITH {TRIPS},\n{IMPUTED}\nSELECT {inputs}, duration_minutes, payment_type, true AS inputs_present FROM ({features('imputed')}) WHERE {OUTLIER_WHERE}"
    scored = f"SELECT {{}} FROM ({features('imputed')}) WHERE {OUTLIER_WHERE}"
    out["stream_prediction_log"] = f"WITH {TRIPS},\n{IMPUTED}\n" + scored.format(f"{inputs}, 'gbt_duration_minutes_v1' AS model_version, CAST(NULL AS INTEGER) AS user_id")
    out["stream_dedup"] = f"WITH {TRIPS},\n{IMPUTED},\nonce AS (SELECT DISTINCT * FROM imputed)\n" + (
        f"SELECT {inputs}, duration_minutes, payment_type, true AS inputs_present, (SELECT 2 * count(*) FROM trips) AS n_read, CAST(0 AS BIGINT) AS n_late "
        f"FROM ({features('once')}) WHERE {OUTLIER_WHERE}"
    )
    out["dedup_by_hash"] = t + "SELECT DISTINCT * FROM (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE passenger_count >= 4)"
    out["landing_waves"] = t + "\nUNION ALL\n".join(
        f"SELECT {w} AS landed_batch, count(*) AS n_rows, count(passenger_count) AS n_passengers, {fees} AS n_new_fee FROM trips"
        for w, fees in ((0, "CAST(0 AS BIGINT)"), (1, "count(total_amount - fare_amount)"))
    )
    out["silver_month_rewrite"] = s + (
        "SELECT * REPLACE (" + ", ".join(f"round({c}, 8) AS {c}" for c in ("trip_distance", "fare_amount", "Airport_fee", "cbd_congestion_fee"))
        + ", round(CASE WHEN pickup_month = (SELECT max(pickup_month) FROM silver) THEN total_amount + 1.0 ELSE total_amount END, 8) AS total_amount) FROM silver"
    )
    out["maintained_by_hour"] = out["avg_duration_by_hour"]
    out["maintained_payment"] = out["payment_analysis"]
    fares = "[0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]"
    out["fare_quantiles_exact"] = s + f"SELECT unnest(CAST({fares} AS DOUBLE[])) AS quantile, unnest(quantile_disc(fare_amount, {fares})) AS fare_amount FROM silver"
    out["prediction_log_versions"] = s + (
        "SELECT 'lr_duration_minutes_v' || v AS model_version, b AS batch_id, CAST(v AS INTEGER) AS user_id, count(*) AS n_rows, count(*) AS n_predicted "
        "FROM silver, (VALUES (1), (2)) AS versions(v), (VALUES ('morning'), ('evening')) AS batches(b) GROUP BY v, b"
    )
    out["prediction_log_one_batch"] = s + f"SELECT {inputs}, 'lr_duration_minutes_v2' AS model_version, 'evening' AS batch_id, 2 AS user_id FROM silver"
    out["path_segments"] = "SELECT page_id, list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) AS segment FROM pages"
    quantiles = "[0.01, 0.25, 0.5, 0.75, 0.99]"
    out["duration_quantiles_exact"] = s + (
        f"SELECT unnest(CAST({quantiles} AS DOUBLE[])) AS quantile, unnest(quantile_disc(duration_minutes, {quantiles})) AS duration_minutes FROM silver"
    )
    out["preview_trips"] = t + (
        "SELECT * FROM trips ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance LIMIT 20"
    )
    plan_rows = []
    for i, (c, typ) in enumerate(TRIP_COLUMNS):
        if c == "store_and_fwd_flag":
            fill = _mode(c)
        elif typ == "bigint":
            fill = f"CAST({_trunc_mean(c)} AS VARCHAR)"
        elif typ in NUMERIC:
            fill = f"CAST((SELECT avg({c}) FROM trips) AS VARCHAR)"
        else:
            fill = "NULL"
        k = f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM trips)"
        pct = f"{k} * 100.0 / (SELECT count(*) FROM trips)"
        action = f"CASE WHEN {k} = 0 THEN 'none' WHEN {pct} < 5 THEN 'drop' WHEN {'true' if typ in NUMERIC else 'false'} THEN 'fill_mean' ELSE 'fill_mode' END"
        plan_rows.append(
            f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS position, '{typ}' AS data_type, {k} AS null_count, "
            f"round(CAST({k} AS DOUBLE) / CAST((SELECT count(*) FROM trips) AS DOUBLE) * 100.0, 8) AS null_pct, {action} AS action, "
            f"CASE WHEN {action} IN ('fill_mean', 'fill_mode') THEN {fill} END AS fill_value"
        )
    out["null_policy_plan"] = t + "\nUNION ALL\n".join(plan_rows)
    for c in CATEGORY_COLUMNS:
        out[f"avg_duration_by_{c}"] = s + f"SELECT {c}, round(avg(duration_minutes), 8) AS avg_duration FROM silver_enc GROUP BY {c}"
    return out
