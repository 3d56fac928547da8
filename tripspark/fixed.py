"""These must equal the reference's for results to match.

Everything else in the library is our own design; these are the data contract and parameters
the reference's results depend on, stated once, in their natural order.
"""

# Raw trip file, in file order (the order matters for the sequential null policy).
RAW_TRIP_COLUMNS = (
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("RatecodeID", "bigint"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("Airport_fee", "double"),
    ("cbd_congestion_fee", "double"),
)

# Null policy: a column whose null share is below this percentage drops its null rows,
# otherwise it is filled.
NULL_DROP_THRESHOLD_PCT = 5.0

# Outlier rules: 0 < trip_distance <= 200, passenger_count > 0, 0 < duration <= 240 minutes,
# fare_amount > 0, total_amount > 0, RatecodeID != 99.
MAX_TRIP_DISTANCE = 200.0
MAX_DURATION_MINUTES = 240
EXCLUDED_RATECODE = 99

# Flag encoding: N -> 0, Y -> 1, anything else -> null.
FLAG_NO = "N"
FLAG_YES = "Y"

# Model input vector, in order.
FEATURE_ORDER = (
    "trip_distance",
    "pickup_hour",
    "pickup_month",
    "Airport_fee",
    "pickup_day_week",
    "RatecodeID",
    "fare_amount",
)

# Category columns of the per-category mean-duration report, in order.
CATEGORY_COLUMNS = (
    "pickup_month",
    "pickup_hour",
    "pickup_day_week",
    "store_and_fwd_flag",
    "payment_type",
    "RatecodeID",
    "VendorID",
)

# Train / test split.
TRAIN_FRACTION = 0.7

# Gradient-boosted trees (the Spark defaults the reference relied on, seed 42).
GBT_PARAMS = dict(maxIter=20, maxDepth=5, maxBins=32, stepSize=0.1, subsamplingRate=1.0, lossType="squared", seed=42)

# Relational silver table, in order (the duration under our ASCII name).
SILVER_TABLE_COLUMNS = (
    ("VendorID", "smallint"),
    ("passenger_count", "smallint"),
    ("trip_distance", "numeric(6,2)"),
    ("RatecodeID", "smallint"),
    ("store_and_fwd_flag", "text"),
    ("PULocationID", "integer"),
    ("DOLocationID", "integer"),
    ("payment_type", "smallint"),
    ("fare_amount", "numeric(10,2)"),
    ("extra", "numeric(10,2)"),
    ("mta_tax", "numeric(10,2)"),
    ("tip_amount", "numeric(10,2)"),
    ("tolls_amount", "numeric(10,2)"),
    ("improvement_surcharge", "numeric(10,2)"),
    ("total_amount", "numeric(10,2)"),
    ("congestion_surcharge", "numeric(10,2)"),
    ("Airport_fee", "numeric(10,2)"),
    ("cbd_congestion_fee", "numeric(10,2)"),
    ("duration_minutes", "numeric(10,2)"),
    ("pickup_hour", "integer"),
    ("pickup_day_week", "integer"),
    ("pickup_month", "integer"),
)

# Column names of the relational table that differ from ours.
SILVER_TABLE_NAMES = {"duration_minutes": "Durée_minutes"}
