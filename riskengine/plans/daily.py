"""The daily job: score, store, alert, monitor from one scored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from riskengine.operators.projections import banded
from riskengine.operators.quality import accepted, rejected
from riskengine.operators.risk import alert_chunks, alert_messages, drift, filled_days, risk_pct, risk_summary
from riskengine.schemas import DAILY_RECORD
from riskengine.sources.sinks import overwrite_days, publish_alerts, read_store, upsert_scored, write_daily
from riskengine.sources.readers import read_daily


def run_day(tx: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, history_from: str, day: str) -> DataFrame:
    """Score a batch and bring store, alerts and daily metrics up to date; returns the drift rows.

    The batch is scored once: the scores are kept for both writes, and alerts and totals
    read the stored rows of the day.
    """
    spark = tx.sparkSession
    out = out.rstrip("/")
    scored = score(tx).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        aside = rejected(scored, "fraud_score")
        overwrite_days(aside, f"{out}/quarantine", days=[day])
        good = banded(accepted(scored, "fraud_score"))
        upsert_scored(good, f"{out}/scored")
    finally:
        scored.unpersist()

    is_day = F.col("batch_date") == F.lit(day).cast("date")
    stored = read_store(spark, f"{out}/scored", good).filter(is_day)
    errors = spark.read.schema(aside.schema).parquet(f"{out}/quarantine").filter(is_day).agg(F.count("*"))
    publish_alerts(alert_messages(alert_chunks(stored)), f"{out}/alerts", days=[day])
    # A day without rows has a record too, of zeros.
    summary = risk_pct(filled_days(risk_summary(stored), day, day))
    record = summary.withColumns({"success_count": F.col("total"), "error_count": errors.scalar()})
    write_daily(record.select(DAILY_RECORD.fieldNames()), f"{out}/daily")
    history = read_daily(spark, f"{out}/daily", history_from, day)
    return drift(history).filter(is_day)
