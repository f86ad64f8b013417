"""Data-quality checks. Each is one pass and returns a small DataFrame."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskengine.functions.scalars import is_missing, valid_score
from riskengine.schemas import CARD_FEATURES, TARGET

EXPECTED_ROWS = 284_807

# Name -> (type, lowest, highest, lowest allowed itself).
PARAM_RULES = {
    "max_depth": ("int", 1, 20, True),
    "eta": ("double", 0.0, 1.0, False),
    "num_round": ("int", 1, 1000, True),
    "subsample": ("double", 0.0, 1.0, False),
    "colsample_bytree": ("double", 0.0, 1.0, False),
}
REQUIRED_PARAMS = ("objective", "num_round", "max_depth", "eta", "subsample", "colsample_bytree")

# Field -> JSON type under "model".
CONFIG_FIELDS = {
    "algorithm": "string",
    "hyperparameters": "object",
    "performance": "object",
    "tested_date": "string",
    "approved_by": "string",
}


def _missing_aggs(df: DataFrame) -> list[Column]:
    return [F.count_if(is_missing(c, t)).alias(c) for c, t in df.dtypes]


def _rows(df_one: DataFrame, names: Sequence[str], value: str, *keep: str) -> DataFrame:
    """One wide row to (column_name, value) rows; explode keeps it inside one stage."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias(value)) for n in names])
    return df_one.select(*keep, F.explode(pairs).alias("x")).select("x.column_name", f"x.{value}", *keep)


def missing_counts(df: DataFrame) -> DataFrame:
    """Null-or-NaN rows per column, the total over all columns, and the fail flag."""
    one = df.agg(*_missing_aggs(df))
    total = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0).cast("bigint"))
    return _rows(one.withColumn("total_missing", total), df.columns, "missing", "total_missing").withColumn(
        "failed", F.col("total_missing") > 0
    )


def missing_total(df: DataFrame) -> DataFrame:
    one = df.agg(*_missing_aggs(df))
    return one.select(sum((F.col(f"`{c}`") for c in df.columns), F.lit(0).cast("bigint")).alias("missing_total"))


def missing_columns(df: DataFrame, required: Sequence[str] = (*CARD_FEATURES, TARGET)) -> DataFrame:
    """Presence of each required column, with its non-null rows when present."""
    have = set(df.columns)
    counts = [F.count(f"`{c}`" if c in have else F.lit(None)).alias(c) for c in required]
    rows = _rows(df.agg(*counts), required, "non_null")
    present = F.col("column_name").isin(*[c for c in required if c in have]) if have & set(required) else F.lit(False)
    return rows.withColumn("present", present)


def require_columns(df: DataFrame, required: Sequence[str] = (*CARD_FEATURES, TARGET)) -> DataFrame:
    """Schema check before any scan."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns not found: {', '.join(absent)}")
    return df


def row_count_check(df: DataFrame, expected: int = EXPECTED_ROWS) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(expected).cast("bigint").alias("expected"), (F.col("n_rows") == expected).alias("matches")
    )


def quality_gate(df: DataFrame, expected: int = EXPECTED_ROWS, strict: bool = False) -> dict[str, int]:
    """Columns, then missing values and row count in one job. Missing values raise;
    a different row count warns, or raises when ``strict``."""
    require_columns(df)
    found = df.agg(F.count("*").alias("_rows"), *_missing_aggs(df)).first().asDict()
    rows = found.pop("_rows")
    bad = {c: n for c, n in found.items() if n}
    if bad:
        raise ValueError(f"{sum(bad.values())} missing values: {bad}")
    if rows != expected:
        if strict:
            raise ValueError(f"{rows} rows, expected {expected}")
        warnings.warn(f"{rows} rows, expected {expected}; going on", stacklevel=2)
    return {"rows": rows, "missing": 0}


def quarantine_scores(df: DataFrame, score: str = "score") -> DataFrame:
    """Mark rows whose score breaks the [0, 1] constraint; null and NaN break it too."""
    return df.withColumn("quarantined", ~F.coalesce(valid_score(F.col(score)), F.lit(False)))


def accepted(df: DataFrame, score: str = "score") -> DataFrame:
    return df.filter(valid_score(F.col(score)))


def rejected(df: DataFrame, score: str = "score") -> DataFrame:
    return df.filter(~F.coalesce(valid_score(F.col(score)), F.lit(False)))


def validate_params(
    df: DataFrame, params: str = "params", rules: Mapping[str, tuple] = PARAM_RULES,
    required: Sequence[str] = REQUIRED_PARAMS,
) -> DataFrame:
    """Reasons a row of string hyperparameters is refused; an empty list passes."""
    m = F.col(params)
    reasons = [F.when(~F.map_contains_key(m, F.lit(p)), F.lit(f"missing:{p}")) for p in required]
    for name, (kind, low, high, closed) in rules.items():
        raw = F.try_element_at(m, F.lit(name))
        value = raw.try_cast(kind)
        inside = (value >= low if closed else value > low) & (value <= high)
        reasons.append(
            F.when(raw.isNotNull() & value.isNull(), F.lit(f"type:{name}")).when(
                raw.isNotNull() & ~(inside & ~F.isnan(value.cast("double"))), F.lit(f"range:{name}")
            )
        )
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).withColumn(
        "valid", F.size("reasons") == 0
    )


def validate_config(df: DataFrame, payload: str = "config") -> DataFrame:
    """Shape of JSON model configs: a ``model`` object with typed required fields."""
    # Its own column: the text is parsed once, not once per field.
    parsed = df.withColumn("_model", F.try_variant_get(F.try_parse_json(payload), "$.model", "variant"))
    section = F.col("_model")
    kinds = parsed.withColumns(
        {f"_kind_{f}": F.schema_of_variant(F.try_variant_get(section, f"$.{f}", "variant")) for f in CONFIG_FIELDS}
    )
    reasons = [F.when(section.isNull(), F.lit("missing:model"))]
    for field, kind in CONFIG_FIELDS.items():
        found = F.col(f"_kind_{field}")
        right = found.startswith("OBJECT") if kind == "object" else found == "STRING"
        reasons.append(
            F.when(section.isNotNull() & found.isNull(), F.lit(f"missing:{field}")).when(
                section.isNotNull() & ~right, F.lit(f"type:{field}")
            )
        )
    checked = kinds.withColumn("reasons", F.array_compact(F.array(*reasons)))
    return checked.withColumn("valid", F.size("reasons") == 0).drop("_model", *[f"_kind_{f}" for f in CONFIG_FIELDS])
