"""Table and message schemas."""

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()
TIMESTAMP, DATE, INT = T.TimestampType(), T.DateType(), T.IntegerType()

# The columns of every table and message.
RAW_BARS = _struct(
    ("symbol", STRING, False),
    ("date", TIMESTAMP, False),
    ("open", DOUBLE),
    ("high", DOUBLE),
    ("low", DOUBLE),
    ("close", DOUBLE),
    ("adjusted_close", DOUBLE),
    ("volume", LONG),
    ("ingested_at", TIMESTAMP),
)

INDICATORS = [
    "rsi_14", "macd", "macd_signal", "macd_hist",
    "bb_upper", "bb_lower", "bb_width", "atr_14", "return_1d", "return_5d",
]

# Records whose indicator values may all be missing.
INDICATOR_RECORD = _struct(
    ("symbol", STRING, False),
    ("date", DATE, False),
    *[(c, DOUBLE) for c in INDICATORS if c not in ("macd_hist", "bb_width")],
)

TICK = _struct(
    ("symbol", STRING),
    ("price", DOUBLE),
    ("volume", LONG),
    ("bid", DOUBLE),
    ("ask", DOUBLE),
    ("timestamp", TIMESTAMP),
    ("source", STRING),
)

HEADLINES = _struct(
    ("symbol", STRING),
    ("date", DATE),
    ("headline", STRING),
    ("summary", STRING),
    ("url", STRING),
    ("source", STRING),
    ("ingested_at", TIMESTAMP),
)


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# Warehouse tables; computation stays in double and is cast on the way in.
STOCK_PRICES = _struct(
    ("symbol", STRING, False),
    ("date", DATE, False),
    ("open", _dec(12, 4)),
    ("high", _dec(12, 4)),
    ("low", _dec(12, 4)),
    ("close", _dec(12, 4)),
    ("adjusted_close", _dec(12, 4)),
    ("volume", LONG),
    ("daily_return", _dec(10, 6)),
    ("vwap", _dec(12, 4)),
    ("price_range", _dec(12, 4)),
    ("ingested_at", TIMESTAMP),
    ("processed_at", TIMESTAMP),
)
TECHNICAL_INDICATORS = _struct(
    ("symbol", STRING, False),
    ("date", DATE, False),
    ("rsi_14", _dec(8, 4)),
    ("macd", _dec(12, 6)),
    ("macd_signal", _dec(12, 6)),
    ("macd_hist", _dec(12, 6)),
    ("bb_upper", _dec(12, 4)),
    ("bb_lower", _dec(12, 4)),
    ("bb_width", _dec(10, 6)),
    ("atr_14", _dec(12, 4)),
    ("return_1d", _dec(10, 6)),
    ("return_5d", _dec(10, 6)),
)
PREDICTIONS = _struct(
    ("symbol", STRING, False),
    ("prediction_date", DATE, False),
    ("predicted_price", _dec(12, 4), False),
    ("confidence_lower", _dec(12, 4)),
    ("confidence_upper", _dec(12, 4)),
    ("confidence_score", _dec(5, 4)),
    ("model_version", STRING),
    ("sentiment_score", _dec(6, 4)),
    ("sentiment_label", STRING),
    ("created_at", TIMESTAMP),
)
SENTIMENT = _struct(
    ("symbol", STRING, False),
    ("date", DATE, False),
    ("sentiment_compound", _dec(6, 4)),
    ("sentiment_positive", _dec(6, 4)),
    ("sentiment_negative", _dec(6, 4)),
    ("article_count", INT),
    ("created_at", TIMESTAMP),
)
PIPELINE_RUNS = _struct(
    ("dag_id", STRING, False),
    ("run_id", STRING, False),
    ("status", STRING, False),
    ("rows_processed", LONG),
    ("started_at", TIMESTAMP),
    ("completed_at", TIMESTAMP),
    ("error_message", STRING),
)

MODEL_DECISIONS = _struct(
    ("model_version", STRING, False),
    ("avg_sharpe", DOUBLE),
    ("avg_accuracy", DOUBLE),
    ("symbols", LONG),
    ("best_symbol", STRING),
    ("promoted", T.BooleanType()),
    ("decided_at", TIMESTAMP),
)
REJECTS = _struct(
    ("feed", STRING, False),
    ("symbol", STRING),
    ("item", STRING),
    ("reason", STRING),
    ("run_id", STRING),
)


def conform(df, schema: T.StructType):
    """Project ``df`` onto ``schema``, adding missing columns as NULL."""
    from pyspark.sql import functions as F

    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
