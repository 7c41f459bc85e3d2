"""Declared schemas. Nothing in the package relies on schema inference."""
from pyspark.sql import types as T


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EVENT_TABLE = _struct(
    ("event_id", T.LongType()), ("ts", T.TimestampNTZType()), ("user_id", T.LongType()),
    ("event_type", T.StringType()), ("value", T.DoubleType()), ("props", T.StringType()),
)

# entity dimension as it arrives: GeoJSON-like, coordinates are [lon, lat]
NESTED_DIMENSION = _struct(
    ("properties", _struct(
        ("entity_id", T.LongType()), ("city", T.StringType()),
        ("county", T.StringType()), ("state", T.StringType()))),
    ("geometry", _struct(("coordinates", T.ArrayType(T.DoubleType())))),
)

CUSTOMER_CSV = _struct(
    ("custKey", T.LongType()), ("custName", T.StringType()), ("nationKey", T.IntegerType()),
    ("acctBal (USD)", T.DoubleType()), ("mktSegment", T.StringType()),
)

FORECAST_ROW = _struct(
    ("entity_id", T.StringType()), ("ds", T.TimestampNTZType()), ("y", T.DoubleType()),
    ("yhat", T.DoubleType()), ("yhat_lower", T.DoubleType()), ("yhat_upper", T.DoubleType()),
)

# a series that could not be forecast has one row with its error and no time
AUTO_FORECAST_ROW = T.StructType([*FORECAST_ROW.fields, T.StructField("error", T.StringType(), True)])

CHANGEPOINT_ROW = _struct(
    ("entity_id", T.StringType()), ("ds", T.TimestampNTZType()), ("slope_change", T.DoubleType()),
)

CURVE_MODEL_ROW = _struct(
    ("entity_id", T.StringType()), ("model_json", T.StringType()), ("params", T.StringType()),
    ("fit_start", T.TimestampNTZType()), ("fit_end", T.TimestampNTZType()), ("error", T.StringType()),
)

TRIAL_ROW = _struct(
    ("entity_id", T.StringType()), ("trial", T.IntegerType()), ("params", T.StringType()),
    ("ds", T.TimestampNTZType()), ("y", T.DoubleType()), ("yhat", T.DoubleType()),
    ("yhat_lower", T.DoubleType()), ("yhat_upper", T.DoubleType()), ("error", T.StringType()),
)

TRIAL_SCORE_ROW = _struct(
    ("entity_id", T.StringType()), ("trial", T.IntegerType()), ("smape", T.DoubleType()), ("error", T.StringType()),
)

RUN_ROW = _struct(
    ("run_id", T.StringType()), ("name", T.StringType()), ("status", T.StringType()),
    ("started", T.TimestampNTZType()), ("source_table", T.StringType()),
    ("params", T.MapType(T.StringType(), T.StringType())),
    ("metrics", T.MapType(T.StringType(), T.DoubleType())),
)
