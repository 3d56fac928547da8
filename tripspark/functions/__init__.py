"""Column expressions: everything here is a built-in Spark expression (JVM side, codegen)."""

from tripspark.functions.trip import (
    duration_minutes,
    encode_flag,
    from_log_target,
    last_path_segment,
    time_feature_columns,
    to_log_target,
)

__all__ = [
    "duration_minutes",
    "encode_flag",
    "from_log_target",
    "last_path_segment",
    "time_feature_columns",
    "to_log_target",
]
