"""Promotion of runs: check the parameters, then extend parameter, config and event history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskengine.operators.quality import validate_config, validate_params
from riskengine.operators.registry import config_rows, param_rows, promotion_events
from riskengine.session import checkpointed
from riskengine.sources.sinks import append_rows


def promote(runs: DataFrame, out: str, approver: str) -> DataFrame:
    """Append the valid runs to ``params``, ``configs`` and ``events`` under ``out``;
    returns the refused runs with their reasons.

    History only grows: the state before a promotion is the history at an earlier
    version, which is what a rollback reads.
    """
    out = out.rstrip("/")
    checked = checkpointed(validate_params(runs))
    valid = checked.filter("valid").drop("reasons", "valid")
    configs = validate_config(config_rows(valid, approver)).filter("valid").drop("reasons", "valid")
    append_rows(param_rows(valid), f"{out}/params")
    append_rows(configs, f"{out}/configs")
    backup = F.concat(F.lit("params/version-"), F.col("run_id").cast("string"))
    append_rows(promotion_events(valid, approver, backup), f"{out}/events")
    return checked.filter("not valid").select("run_id", "reasons")
