"""Table layouts and the fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Feature names in model order.
FEATURES = (
    "return_1d",
    "return_3d",
    "return_5d",
    "return_10d",
    "price_vs_ma5",
    "price_vs_ma10",
    "ma5_vs_ma10",
    "volume_ratio",
    "volume_change",
    "volatility_5",
    "volatility_10",
    "oc_return",
    "hl_range",
    "close_position",
    "return_lag1",
    "return_lag2",
    "return_lag3",
)
SCALED = tuple(f"{name}_scaled" for name in FEATURES)

# Confidence tiers, weakest first.
TIERS = ("LOW", "MEDIUM", "HIGH")

# Rows a feature looks back (20-bar volume average) and a label looks ahead.
LOOKBACK = 19
LOOKAHEAD = 1

HORIZON = 15

PRICES = ("open", "high", "low", "close")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Raw bars as they arrive: the date is text and may carry a session marker.
RAW_BARS = _struct(
    ("date", T.StringType()),
    ("ticker", T.StringType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
)

# Typed bars: session 0 is the whole day, 1 and 2 are morning and afternoon.
BARS = _struct(
    ("ticker", T.StringType()),
    ("trade_date", T.DateType()),
    ("session", T.IntegerType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
)

FEATURE_TABLE = _struct(
    ("date", T.StringType()),
    ("ticker", T.StringType()),
    ("target", T.IntegerType()),
    *((name, T.DoubleType()) for name in SCALED),
    ("close", T.DoubleType()),
)

SCALER = _struct(
    ("feature", T.StringType()),
    ("mean", T.DoubleType()),
    ("std", T.DoubleType()),
)

STOCK_INFO = _struct(
    ("ticker", T.StringType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
)

NEXT_SESSION = _struct(
    ("prediction_date", T.DateType()),
    ("ticker", T.StringType()),
    ("latest_data_date", T.DateType()),
    ("predicted_for_date", T.DateType()),
    ("prediction", T.IntegerType()),
    ("signal", T.StringType()),
    ("probability", T.DoubleType()),
    ("confidence", T.StringType()),
)

FORECAST_LONG = _struct(
    ("ticker", T.StringType()),
    ("latest_data_date", T.DateType()),
    ("day", T.IntegerType()),
    ("date", T.DateType()),
    ("prediction", T.IntegerType()),
    ("signal", T.StringType()),
    ("probability", T.DoubleType()),
    ("confidence", T.StringType()),
)

# The five values kept for each forecast day, in the order of the wide table.
DAY_FIELDS = ("date", "prediction", "signal", "probability", "confidence")
_DAY_TYPES = {
    "date": T.DateType(),
    "prediction": T.IntegerType(),
    "signal": T.StringType(),
    "probability": T.DoubleType(),
    "confidence": T.StringType(),
}


def forecast_wide(days: int = HORIZON) -> T.StructType:
    return _struct(
        ("ticker", T.StringType()),
        ("latest_data_date", T.DateType()),
        *(
            (f"day_{day}_{field}", _DAY_TYPES[field])
            for day in range(1, days + 1)
            for field in DAY_FIELDS
        ),
    )


MODEL_RUNS = _struct(
    ("run_id", T.StringType()),
    ("model", T.StringType()),
    ("accuracy", T.DoubleType()),
    ("f1", T.DoubleType()),
    ("auc", T.DoubleType()),
    ("saved_at", T.TimestampNTZType()),
    ("params", T.MapType(T.StringType(), T.StringType())),
    ("train_seconds", T.DoubleType()),
)

# One run per JSON document, as the training job writes it.
METRICS_JSON = T.StructType(
    [
        T.StructField(
            "metrics",
            _struct(
                ("accuracy", T.DoubleType()),
                ("f1_score", T.DoubleType()),
                ("auc_roc", T.DoubleType()),
            ),
        ),
        T.StructField(
            "model_info",
            T.StructType(
                [
                    T.StructField("run_id", T.StringType()),
                    T.StructField("experiment_id", T.StringType()),
                    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
                    T.StructField("train_seconds", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("saved_at", T.StringType()),
    ]
)

PRICE_VOLUME_CSV = _struct(
    ("ticker", T.StringType()),
    ("close_price", T.DoubleType()),
    ("volume", T.DoubleType()),
)

SIGNAL_CSV = _struct(
    ("ticker", T.StringType()),
    ("signal", T.StringType()),
    ("confidence", T.DoubleType()),
)
