"""Explicit schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET = "Class"
PCA_FEATURES = [f"V{i}" for i in range(1, 29)]
CARD_FEATURES = ["Time", *PCA_FEATURES, "Amount"]

CARDS = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in CARD_FEATURES]
    + [T.StructField(TARGET, T.IntegerType())]
)

TRANSACTION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchantCategory", T.StringType()),
        T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

DAILY_METRICS = T.StructType(
    [
        T.StructField("total", T.LongType()),
        T.StructField("avg_score", T.DoubleType()),
        T.StructField("high_pct", T.DoubleType()),
        T.StructField("medium_pct", T.DoubleType()),
        T.StructField("low_pct", T.DoubleType()),
        T.StructField("batch_date", T.DateType()),
    ]
)

# What the daily job writes: the metrics, and how many rows reached the store or did not.
DAILY_RECORD = T.StructType(
    [
        *DAILY_METRICS.fields[:-1],
        T.StructField("success_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        DAILY_METRICS["batch_date"],
    ]
)

MODEL_CONFIG = T.StructType(
    [
        T.StructField(
            "model",
            T.StructType(
                [
                    T.StructField("algorithm", T.VariantType()),
                    T.StructField("hyperparameters", T.VariantType()),
                    T.StructField("performance", T.VariantType()),
                    T.StructField("tested_date", T.VariantType()),
                    T.StructField("approved_by", T.VariantType()),
                ]
            ),
        )
    ]
)
