"""DuckDB text per query, over the whole given tables."""

from __future__ import annotations

from riskengine.operators.evaluation import FULL_GATE, PRODUCTION_BASELINE
from riskengine.plans.queries import CARD_COLS, SELECTION, THRESHOLDS
from riskengine.schemas import CARD_FEATURES, TARGET

LABEL = "cast(merchant_category = 'error' OR amount >= 150 AS int)"

# name -> (text, views it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "tx": (
        """SELECT event_id, concat('txn-', event_id) AS transaction_id, epoch_us(ts) // 1000 AS timestamp_ms,
        value AS amount, event_type AS merchant_category, user_id, cast(ts AS date) AS batch_date,
        cast(json_extract_string(props, '$.k') AS double) AS k FROM events""",
        (),
    ),
    "scored": (
        "SELECT *, least(1.0::double, amount / 200.0::double) AS fraud_score, timestamp_ms + 1000 AS scoring_ms FROM tx",
        ("tx",),
    ),
    "pred": (f"SELECT event_id AS id, batch_date, {LABEL} AS label, fraud_score AS score FROM scored", ("scored",)),
    "model_preds": (
        f"""SELECT 'amount_rule' AS algorithm, event_id AS id, {LABEL} AS label, fraud_score AS score FROM scored
        UNION ALL SELECT 'k_rule', event_id, {LABEL}, k / 100.0::double FROM scored""",
        ("scored",),
    ),
    "cards": (
        f"""SELECT event_id, cast(timestamp_ms / 1000 AS double) AS Time, k AS V1, cast(user_id AS double) AS V2,
        cast(event_id % 97 AS double) AS V3, amount AS Amount, {LABEL} AS Class FROM tx""",
        ("tx",),
    ),
    "cards_time": (
        """SELECT *, cast(extract(hour FROM make_timestamp(cast(round(Time * 1000000) AS bigint))) AS int) AS hour,
        cast(extract(isodow FROM make_timestamp(cast(round(Time * 1000000) AS bigint))) - 1 AS int) AS day_of_week FROM cards""",
        ("cards",),
    ),
    "wide": (
        """SELECT *, ln(1 + Amount) AS amount_log, sqrt(Amount) AS amount_sqrt, 0 AS is_night FROM cards_time""",
        ("cards_time",),
    ),
    "tx_dirty": (
        """SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 77 = 0 THEN 'NaN'::double
        ELSE amount END AS amount, merchant_category FROM tx""",
        ("tx",),
    ),
    "raw_scored": ("SELECT event_id, (amount - 20.0::double) / 200.0::double AS raw_score FROM tx_dirty", ("tx_dirty",)),
    "daily": (
        """SELECT batch_date, count(*) AS total, cast(count_if(fraud_score >= 0.8) AS bigint) AS high,
        cast(count_if(fraud_score >= 0.5 AND fraud_score < 0.8) AS bigint) AS medium,
        cast(count_if(fraud_score < 0.5) AS bigint) AS low, avg(fraud_score) AS avg_score FROM scored GROUP BY batch_date""",
        ("scored",),
    ),
    "daily_pct": (
        "SELECT *, high / total AS high_pct, medium / total AS medium_pct, low / total AS low_pct FROM daily",
        ("daily",),
    ),
    "base": (
        """SELECT d.*, (SELECT coalesce(avg(p.avg_score), 0.0::double) FROM daily_pct p
            WHERE p.batch_date BETWEEN d.batch_date - 30 AND d.batch_date - 1) AS baseline_score,
          (SELECT coalesce(avg(p.high_pct), 0.0::double) FROM daily_pct p
            WHERE p.batch_date BETWEEN d.batch_date - 30 AND d.batch_date - 1) AS baseline_high_pct,
          (SELECT count(*) FROM daily_pct p
            WHERE p.batch_date BETWEEN d.batch_date - 30 AND d.batch_date - 1) AS baseline_days
        FROM daily_pct d""",
        ("daily_pct",),
    ),
    "moved": (
        """SELECT *, abs(avg_score - baseline_score) AS avg_score_drift, abs(high_pct - baseline_high_pct) AS high_risk_drift,
        abs(avg_score - baseline_score) > 0.1 OR abs(high_pct - baseline_high_pct) > 0.05 AS drift_detected FROM base""",
        ("base",),
    ),
    "chunks": (
        """SELECT *, cast((rn - 1) // 100 AS bigint) AS chunk FROM (SELECT *, row_number() OVER
        (PARTITION BY batch_date ORDER BY fraud_score DESC, event_id) AS rn FROM scored WHERE fraud_score >= 0.8)""",
        ("scored",),
    ),
    "trials": (
        """SELECT o_orderkey AS trial_no, CASE WHEN o_orderstatus = 'O' THEN 'grid' ELSE 'random' END AS method,
        cast(3 + 2 * (o_custkey % 3) AS int) AS max_depth, cast(50 + 50 * (o_orderkey % 3) AS int) AS n_estimators,
        [0.01::double, 0.1::double, 0.2::double][o_custkey % 7 % 3 + 1] AS learning_rate,
        0.9::double + ((o_orderkey * 7) % 13) / 1000.0::double AS accuracy FROM orders""",
        (),
    ),
    "runs": (
        """SELECT o_orderkey AS run_id, o_orderpriority AS experiment_name, o_orderstatus AS algorithm, o_orderdate AS created,
        cast(o_custkey % 10 AS varchar) AS max_depth, (o_orderkey % 1000) / 1000.0::double AS accuracy FROM orders""",
        (),
    ),
    "param_history": (
        "SELECT o_orderpriority AS path, cast(o_custkey AS varchar) AS value, o_orderkey AS version FROM orders",
        (),
    ),
    "latency": (
        """SELECT event_id, CASE WHEN concat('0x', substr(md5(concat('ab:', event_id)), 1, 8))::bigint % 100 < 10
        THEN 'challenger' ELSE 'champion' END AS arm, value AS latency_ms FROM events""",
        (),
    ),
    "split_cards": (
        """SELECT *, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, concat('0x', substr(md5(concat('42:', event_id)), 1, 8))::bigint / 4294967296.0::double AS u FROM cards)""",
        ("cards",),
    ),
    "counts": (
        """SELECT cast(count_if(label = 1 AND score >= 0.5) AS bigint) AS tp, cast(count_if(label <> 1 AND score >= 0.5) AS bigint) AS fp,
        cast(count_if(label <> 1 AND score < 0.5) AS bigint) AS tn, cast(count_if(label = 1 AND score < 0.5) AS bigint) AS fn FROM pred""",
        ("pred",),
    ),
    "model_counts": (
        """SELECT algorithm, cast(count_if(label = 1 AND score >= 0.5) AS bigint) AS tp,
        cast(count_if(label <> 1 AND score >= 0.5) AS bigint) AS fp, cast(count_if(label <> 1 AND score < 0.5) AS bigint) AS tn,
        cast(count_if(label = 1 AND score < 0.5) AS bigint) AS fn FROM model_preds GROUP BY algorithm""",
        ("model_preds",),
    ),
}


def _rates(source: str) -> str:
    """accuracy, precision, recall and f1 beside the columns of a counts view."""
    return f"""SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::double ELSE 2 * precision * recall / (precision + recall) END AS f1
    FROM (SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
      CASE WHEN tp + fp = 0 THEN 0.0::double ELSE tp / (tp + fp) END AS precision,
      CASE WHEN tp + fn = 0 THEN 0.0::double ELSE tp / (tp + fn) END AS recall FROM {source})"""


VIEWS["metrics"] = (_rates("counts"), ("counts",))
VIEWS["model_metrics"] = (_rates("model_counts"), ("model_counts",))
VIEWS["model_auc"] = (
    """SELECT algorithm, sum(p * (below + q / 2.0)) / (sum(p) * sum(q)) AS auc FROM (
      SELECT algorithm, p, q, coalesce(sum(q) OVER (PARTITION BY algorithm ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT algorithm, score, count_if(label = 1)::double AS p, count_if(label <> 1)::double AS q FROM model_preds GROUP BY ALL))
    GROUP BY algorithm""",
    ("model_preds",),
)
VIEWS["auc"] = (
    """SELECT sum(p * (below + q / 2.0)) / (sum(p) * sum(q)) AS auc FROM (
      SELECT p, q, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score, count_if(label = 1)::double AS p, count_if(label <> 1)::double AS q FROM pred GROUP BY ALL))""",
    ("pred",),
)
VIEWS["step"] = (
    """SELECT sum(CASE WHEN label = 0 THEN above ELSE 0 END) / (sum(label)::double * (count(*) - sum(label))::double) AS auc_step
    FROM (SELECT label, sum(label) OVER (ORDER BY score DESC, id) AS above FROM pred)""",
    ("pred",),
)
VIEWS["curve"] = (
    """SELECT score, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER () AS np, sum(q) OVER () AS nq
    FROM (SELECT score, count_if(label = 1)::double AS p, count_if(label <> 1)::double AS q FROM pred GROUP BY ALL)
    WINDOW w AS (ORDER BY score DESC)""",
    ("pred",),
)
VIEWS["sweep"] = (
    f"""SELECT t AS threshold, cast(count_if(label = 1 AND score >= t) AS bigint) AS tp,
      cast(count_if(label <> 1 AND score >= t) AS bigint) AS fp, cast(count_if(label = 1 AND score < t) AS bigint) AS fn,
      cast(count_if(label <> 1 AND score < t) AS bigint) AS tn
    FROM pred, (SELECT unnest([{', '.join(f'{t}::double' for t in THRESHOLDS)}]) AS t) GROUP BY t""",
    ("pred",),
)


def _long(source: str, cols: list[str], keep: str = "") -> str:
    pre = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {pre}'{c}' AS feature, cast({c} AS double) AS value FROM {source}" for c in cols)


VIEWS["wide_long"] = (_long("wide", SELECTION, "Class"), ("wide",))
VIEWS["cards_long"] = (_long("cards", CARD_COLS, "Class"), ("cards",))
VIEWS["anova"] = (
    """SELECT feature, (sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f_score FROM (
      SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS gm
      FROM (SELECT feature, Class, count(*)::double AS n, avg(value) AS m, var_pop(value) AS v FROM wide_long GROUP BY ALL))
    GROUP BY feature""",
    ("wide_long",),
)


def _needs(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needs(VIEWS[name][1], seen)
            seen.append(name)
    return seen


def over(*names: str, sql: str) -> str:
    views = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in _needs(names, []))
    return f"WITH {views}\n{sql}" if views else sql


def rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


UNIT = "concat('0x', substr(md5(concat('{seed}:', event_id)), 1, 8))::bigint"
RATES = ("accuracy", "precision", "recall", "f1")
CARDS_OUT = "event_id, Time, V1, V2, V3, Amount, Class"
STORE = "transaction_id, timestamp_ms, batch_date, amount, merchant_category"

ORACLES: dict[str, str] = {
    # sources
    "src_csv": over("cards", sql=f"SELECT {CARDS_OUT} FROM cards"),
    "src_labeled_csv": over(
        "tx",
        sql="""SELECT cast(CASE WHEN merchant_category = 'error' THEN 0 ELSE 1 END AS int) AS label,
        cast(event_id AS double) AS event_id, amount, CASE WHEN merchant_category = 'purchase' THEN 0.0::double ELSE k END AS k
        FROM tx WHERE merchant_category IN ('click', 'error', 'purchase')""",
    ),
    "src_parquet": over("split_cards", sql="SELECT event_id, Amount, Class FROM split_cards WHERE split = 'validation'"),
    "src_json_batch": over(
        "tx",
        sql="""SELECT transaction_id AS id, timestamp_ms AS timestamp, amount, merchant_category AS merchantCategory, k,
        2 AS n_features FROM tx""",
    ),
    "src_daily_range": over(
        "daily_pct",
        sql=f"""SELECT batch_date, total, {rounded('avg_score', 'high_pct', 'medium_pct', 'low_pct')} FROM daily_pct
        WHERE batch_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-15'""",
    ),
    "src_latest_manifest": """SELECT event_type AS stage, event_id, ts, concat('executions/', event_id, '/output.json') AS output_path,
        user_id AS records FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    # sinks
    "sink_parquet": over("cards", sql=f"SELECT {CARDS_OUT} FROM cards"),
    "sink_labeled_csv": over(
        "cards", sql="SELECT Class AS label, cast(event_id AS double) AS event_id, Time, V1, V2, V3, Amount FROM cards"
    ),
    "sink_manifest": over(
        "split_cards",
        sql=f"""SELECT 'DataPrepStage' AS stage, 'SUCCESS' AS status, '{','.join(CARD_FEATURES)}' AS features, split, count(*) AS n
        FROM split_cards GROUP BY split""",
    ),
    "sink_upsert_scored": over(
        "scored",
        sql=f"""SELECT {STORE}, round(CASE WHEN merchant_category = 'error' THEN k / 100.0::double ELSE fraud_score END, 6) AS fraud_score,
        scoring_ms + CASE WHEN merchant_category = 'error' THEN 60000 ELSE 0 END AS scoring_ms FROM scored""",
    ),
    "sink_daily_metrics": over(
        "daily_pct", sql=f"SELECT batch_date, total, {rounded('avg_score', 'high_pct', 'medium_pct', 'low_pct')} FROM daily_pct"
    ),
    "sink_alert_batches": over(
        "chunks",
        sql="""SELECT batch_date, chunk AS batch_index, count(*) AS size,
        concat('Fraud Alert: ', count(*), ' High-Risk Transactions Detected') AS subject FROM chunks GROUP BY batch_date, chunk""",
    ),
    "sink_experiment_log": over("runs", sql="SELECT run_id, experiment_name, algorithm, max_depth, accuracy FROM runs"),
    # projections, filters, validation
    "proj_target_first": over("cards", sql=f"SELECT {CARDS_OUT} FROM cards"),
    "dq_missing_counts": over(
        "tx_dirty",
        sql="""SELECT column_name, missing, total_missing, total_missing > 0 AS failed FROM (
          SELECT column_name, missing, cast(sum(missing) OVER () AS bigint) AS total_missing FROM (
            SELECT 'event_id' AS column_name, cast(count_if(event_id IS NULL) AS bigint) AS missing FROM tx_dirty
            UNION ALL SELECT 'amount', cast(count_if(amount IS NULL OR isnan(amount)) AS bigint) FROM tx_dirty
            UNION ALL SELECT 'merchant_category', cast(count_if(merchant_category IS NULL) AS bigint) FROM tx_dirty))""",
    ),
    "dq_required_columns": over(
        "cards",
        sql=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS non_null, true AS present FROM cards"
            if c in ("Time", "V1", "V2", "V3", "Amount", "Class")
            else f"SELECT '{c}' AS column_name, count(NULL) AS non_null, false AS present FROM cards"
            for c in (*CARD_FEATURES, TARGET)
        ),
    ),
    "dq_row_count": over(
        "cards", sql="SELECT count(*) AS n_rows, 284807::bigint AS expected, count(*) = 284807 AS matches FROM cards"
    ),
    "dq_missing_total": over(
        "tx_dirty",
        sql="""SELECT cast(count_if(event_id IS NULL) + count_if(amount IS NULL OR isnan(amount))
        + count_if(merchant_category IS NULL) AS bigint) AS missing_total FROM tx_dirty""",
    ),
    "proj_clamp_score": over(
        "raw_scored",
        sql="""SELECT event_id, CASE WHEN raw_score IS NULL OR isnan(raw_score) THEN NULL
        ELSE round(least(greatest(raw_score, 0.0), 1.0), 6) END AS score FROM raw_scored""",
    ),
    "dq_score_quarantine": over(
        "raw_scored",
        sql="""SELECT event_id, raw_score IS NULL OR isnan(raw_score) OR raw_score < 0 OR raw_score > 1 AS quarantined FROM raw_scored""",
    ),
    "proj_risk_band": over(
        "scored",
        sql="""SELECT event_id, CASE WHEN fraud_score >= 0.8 THEN 'high' WHEN fraud_score >= 0.5 THEN 'medium' ELSE 'low' END AS risk_band
        FROM scored""",
    ),
    "filter_high_risk": over(
        "scored", sql="SELECT event_id, transaction_id, round(fraud_score, 6) AS fraud_score FROM scored WHERE fraud_score >= 0.8"
    ),
    "lookup_batch_date": over(
        "scored",
        sql="SELECT event_id, batch_date, round(fraud_score, 6) AS fraud_score FROM scored WHERE batch_date = DATE '2024-01-15'",
    ),
    "lookup_date_min_score": over(
        "scored",
        sql="""SELECT event_id, batch_date, round(fraud_score, 6) AS fraud_score FROM scored
        WHERE batch_date = DATE '2024-01-15' AND fraud_score >= 0.8""",
    ),
    "filter_failed_runs": """SELECT event_id, ts, concat('stage FAILED: ', event_id) AS message FROM events
        WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "proj_dynamic_threshold": over(
        "tx",
        sql="""SELECT event_id, cast(CASE WHEN amount * 50 > 10000 THEN 0.60 WHEN k < 20 THEN 0.70
        WHEN merchant_category = 'purchase' THEN 0.85 ELSE 0.75 END AS double) AS threshold FROM tx""",
    ),
    "dq_param_rules": """SELECT run_id, reasons, reasons = '' AS valid FROM (SELECT o_orderkey AS run_id, concat_ws(';',
          CASE WHEN o_orderstatus = 'F' THEN 'missing:colsample_bytree' END,
          CASE WHEN o_custkey % 25 NOT BETWEEN 1 AND 20 THEN 'range:max_depth' END,
          CASE WHEN NOT (o_orderkey % 120 > 0 AND o_orderkey % 120 <= 100) THEN 'range:eta' END,
          CASE WHEN o_custkey NOT BETWEEN 1 AND 1000 THEN 'range:num_round' END,
          CASE WHEN o_orderstatus = 'P' THEN 'type:subsample' END) AS reasons FROM orders)""",
    "dq_config_rules": """SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'P' THEN 'missing:approved_by'
        WHEN 'F' THEN 'type:hyperparameters' ELSE '' END AS reasons, o_orderstatus NOT IN ('P', 'F') AS valid FROM orders""",
    "proj_scored": over(
        "scored",
        sql="""SELECT transaction_id, timestamp_ms, amount, merchant_category, round(least(greatest(amount / 200.0::double, 0), 1), 6)
        AS fraud_score, scoring_ms FROM scored""",
    ),
    "filter_class_subset": over("cards", sql="SELECT event_id, V1, V2, V3, Amount FROM cards WHERE Class = 1"),
    "prof_schema_report": over(
        "tx_dirty",
        sql="""SELECT 0 AS position, 'event_id' AS column_name, 'bigint' AS dtype, count(event_id) AS non_null, count(*) AS n_rows FROM tx_dirty
        UNION ALL SELECT 1, 'amount', 'double', count(amount), count(*) FROM tx_dirty
        UNION ALL SELECT 2, 'merchant_category', 'string', count(merchant_category), count(*) FROM tx_dirty""",
    ),
    "filter_retention": over(
        "tx", sql="SELECT event_id, batch_date FROM tx WHERE batch_date > (SELECT max(batch_date) - 7 FROM tx)"
    ),
    "sink_retention": over(
        "tx", sql="SELECT event_id, batch_date FROM tx WHERE batch_date > (SELECT max(batch_date) - 7 FROM tx)"
    ),
    # splits
    "split_bernoulli": over("split_cards", sql="SELECT event_id, split FROM split_cards"),
    "split_exact": over(
        "cards",
        sql=f"""SELECT event_id, CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * 0.7) + floor(n * 0.15)
        THEN 'validation' ELSE 'test' END AS split FROM (SELECT event_id, row_number() OVER (ORDER BY
        {UNIT.format(seed=42)}, event_id) AS rn, count(*) OVER () AS n FROM cards)""",
    ),
    "split_report": over(
        "split_cards",
        sql="SELECT split, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct FROM split_cards GROUP BY split",
    ),
    "split_integrity": over(
        "cards",
        sql="""SELECT count(*) AS total, count(*) AS parts_total, 0::bigint AS lost, 0::bigint AS added, 0::bigint AS overlap,
        true AS ok FROM cards""",
    ),
    "split_two_way": over(
        "cards",
        sql=f"""SELECT event_id, CASE WHEN {UNIT.format(seed=42)} / 4294967296.0::double < 0.8 THEN 'train' ELSE 'test' END AS split
        FROM cards""",
    ),
    "ab_assign": over("latency", sql="SELECT event_id, arm FROM latency"),
    "ab_rollout_counts": f"""SELECT stage, challenger_pct, hours, cast(count_if(slot < challenger_pct) AS bigint) AS challenger,
        cast(count_if(slot >= challenger_pct) AS bigint) AS champion FROM (SELECT {UNIT.format(seed='ab')} % 100 AS slot FROM events),
        (VALUES (1, 1, 24), (2, 10, 48), (3, 50, 72), (4, 100, 0)) AS p(stage, challenger_pct, hours) GROUP BY ALL""",
    # features
    "feat_time": over(
        "cards_time",
        sql="SELECT event_id, hour, day_of_week, cast(day_of_week IN (5, 6) AS int) AS is_weekend, 0 AS is_night FROM cards_time",
    ),
    "feat_time_night_wrap": over(
        "cards_time",
        sql="""SELECT event_id, hour, day_of_week, cast(day_of_week IN (5, 6) AS int) AS is_weekend,
        cast(hour >= 22 OR hour <= 6 AS int) AS is_night FROM cards_time""",
    ),
    "feat_amount": over(
        "cards",
        sql="""SELECT event_id, round(ln(1 + Amount), 6) AS amount_log, round(Amount * Amount, 6) AS amount_squared,
        round(sqrt(Amount), 6) AS amount_sqrt FROM cards""",
    ),
    "feat_interaction": over(
        "cards",
        sql="""SELECT event_id, round(V1 * V2, 6) AS V1_x_V2, round(V3 * V1, 6) AS V3_x_V1, round(V1 * Amount, 6) AS V1_x_Amount
        FROM cards""",
    ),
    "feat_anova_f": over("anova", sql="SELECT feature, round(f_score, 6) AS f_score FROM anova"),
    "feat_select_k_best": over(
        "anova", sql="SELECT feature, round(f_score, 6) AS f_score FROM anova ORDER BY anova.f_score DESC, feature LIMIT 3"
    ),
    "prof_corr_matrix": over(
        "wide",
        sql=" UNION ALL ".join(
            f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL
            ELSE round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), 6) END AS corr FROM wide"""
            for i, a in enumerate([*SELECTION, "is_night", "Class"])
            for b in [*SELECTION, "is_night", "Class"][:i]
        ),
    ),
    "prof_target_corr": over(
        "wide_long",
        sql="""SELECT feature, round(abs(covar_pop(value, Class) / (stddev_pop(value) * stddev_pop(Class))), 6) AS abs_corr
        FROM wide_long GROUP BY feature""",
    ),
    "feat_vector": over(
        "tx",
        sql="SELECT event_id, concat(amount, ',', k, ',') AS payload, 3 AS n, amount AS first_value FROM tx",
    ),
    # aggregates and profiles
    "prof_summary": over(
        "tx_dirty",
        sql="""SELECT feature, count(value) AS count, count(*) - count(value) AS missing,
        round((count(*) - count(value)) * 100.0::double / count(*), 2) AS missing_pct, min(value) AS min, max(value) AS max,
        round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(median(value), 4) AS median FROM (
          SELECT 'event_id' AS feature, cast(event_id AS double) AS value FROM tx_dirty
          UNION ALL SELECT 'amount', CASE WHEN isnan(amount) THEN NULL ELSE amount END FROM tx_dirty) GROUP BY feature""",
    ),
    "prof_describe": over(
        "cards_time",
        sql="""SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
        round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75 FROM (
        """
        + _long(
            "(SELECT *, cast(day_of_week IN (5, 6) AS int) AS is_weekend, 0 AS is_night FROM cards_time)",
            ["hour", "day_of_week", "is_weekend", "is_night", *CARD_COLS],
        )
        + ") GROUP BY feature",
    ),
    **{
        name: over(
            "split_cards",
            sql=f"""SELECT {by}cast(count_if(Class = 0) AS bigint) AS negatives, cast(count_if(Class = 1) AS bigint) AS positives,
            count(*) AS total, round(count_if(Class = 0) * 100.0::double / count(*), 6) AS negative_pct,
            round(count_if(Class = 1) * 100.0::double / count(*), 6) AS positive_pct,
            round(CASE WHEN count_if(Class = 1) = 0 THEN 'Infinity'::double ELSE count_if(Class = 0) / count_if(Class = 1) END, 6)
            AS ratio FROM split_cards {'GROUP BY split' if by else ''}""",
        )
        for name, by in (("prof_class_balance", ""), ("prof_class_balance_split", "split, "))
    },
    "prof_histogram": over(
        "cards_long",
        sql="""SELECT Class, feature, cast(least(floor(50 * (value - lo) / (hi - lo)), 49) AS int) AS bin, count(*) AS n FROM (
          SELECT *, min(value) OVER (PARTITION BY Class, feature) AS lo, max(value) OVER (PARTITION BY Class, feature) AS hi
          FROM cards_long) GROUP BY ALL""",
    ),
    "prof_density": over(
        "cards_time",
        sql="""SELECT Class, bin, n, round(n / (sum(n) OVER (PARTITION BY Class) * ((hi - lo) / 24)), 6) AS density FROM (
          SELECT Class, cast(least(floor(24 * (value - lo) / (hi - lo)), 23) AS int) AS bin, lo, hi, count(*) AS n FROM (
            SELECT Class, hour::double AS value, min(hour) OVER (PARTITION BY Class)::double AS lo,
            max(hour) OVER (PARTITION BY Class)::double AS hi FROM cards_time) GROUP BY ALL)""",
    ),
    "prof_value_share": over(
        "cards_time",
        sql="""SELECT Class, day_of_week, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY Class), 6) AS share
        FROM cards_time GROUP BY Class, day_of_week""",
    ),
    "agg_rate_by": over(
        "cards_time",
        sql="""SELECT cast(day_of_week IN (5, 6) AS int) AS is_weekend, count(*) AS n, round(avg(Class), 6) AS rate FROM cards_time
        GROUP BY 1""",
    ),
    "agg_risk_summary": over("daily", sql="SELECT * REPLACE (round(avg_score, 6) AS avg_score) FROM daily"),
    "agg_risk_pct": over(
        "daily_pct", sql=f"SELECT batch_date, {rounded('high_pct', 'medium_pct', 'low_pct')} FROM daily_pct"
    ),
    "agg_load_totals": over(
        "tx",
        sql="""SELECT batch_date, count(*) AS total, cast(count_if(k >= 5) AS bigint) AS success_count,
        cast(count(*) - count_if(k >= 5) AS bigint) AS error_count FROM tx GROUP BY batch_date""",
    ),
    "agg_rate_by_period": over(
        "pred",
        sql="""SELECT CASE WHEN batch_date <= DATE '2024-01-20' THEN 'baseline' ELSE 'recent' END AS period, count(*) AS n,
        round(avg(label), 6) AS rate FROM pred GROUP BY 1""",
    ),
    "agg_risk_summary_filled": over(
        "daily",
        sql="""SELECT cast(c.d AS date) AS batch_date, coalesce(total, 0) AS total, coalesce(high, 0) AS high,
          coalesce(medium, 0) AS medium, coalesce(low, 0) AS low, round(coalesce(avg_score, 0), 6) AS avg_score
        FROM (SELECT unnest(generate_series(DATE '2023-12-30', DATE '2024-01-20', INTERVAL 1 DAY)) AS d) c
        LEFT JOIN (SELECT * FROM daily WHERE batch_date <> DATE '2024-01-10') x ON x.batch_date = cast(c.d AS date)""",
    ),
    "agg_latency": over(
        "latency",
        sql="""SELECT arm, count(*) AS n, round(avg(latency_ms), 6) AS avg_ms, round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
        round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms FROM latency GROUP BY arm""",
    ),
    "agg_pivot_mean": over(
        "trials",
        sql="""SELECT n_estimators, max_depth, round(avg(accuracy) FILTER (learning_rate = 0.01), 6) AS lr_001,
        round(avg(accuracy) FILTER (learning_rate = 0.1), 6) AS lr_01, round(avg(accuracy) FILTER (learning_rate = 0.2), 6) AS lr_02
        FROM trials GROUP BY n_estimators, max_depth""",
    ),
    "reshape_melt": over(
        "model_metrics",
        sql=" UNION ALL ".join(f"SELECT algorithm, '{m}' AS metric, round({m}, 6) AS score FROM model_metrics" for m in RATES),
    ),
    # joins
    "join_pred_actual": over("pred", sql="SELECT id, label, round(score, 6) AS score FROM pred"),
    "join_metric_baseline": over(
        "metrics", "auc",
        sql=" UNION ALL ".join(
            f"""SELECT '{m}' AS metric, round({m}, 6) AS current, {v}::double AS baseline, round({m} - {v}, 6) AS difference,
            round(({m} - {v}) * 100 / {v}, 6) AS percent_change, {m} > {v} AS improved FROM metrics, auc"""
            for m, v in PRODUCTION_BASELINE.items()
        ),
    ),
    "join_arm_compare": over(
        "scored",
        sql="""SELECT count(*) AS n, round(avg(fraud_score), 6) AS avg_champion, round(avg(k / 100), 6) AS avg_challenger,
        round(avg(abs(fraud_score - k / 100)), 6) AS mean_abs_diff,
        round(avg(cast((fraud_score >= 0.5) = (k / 100 >= 0.5) AS int)), 6) AS agreement FROM scored""",
    ),
    "ab_verdict": over(
        "scored",
        "latency",
        sql=f"""SELECT n, {rounded('champion_accuracy', 'challenger_accuracy', 'agreement', 'improvement_pct', 'p95_ms')},
          challenger_accuracy >= 0.9 AS accuracy_ok, p95_ms <= 100 AS latency_ok, improvement_pct >= 1 AS improvement_ok,
          challenger_accuracy >= 0.9 AND p95_ms <= 100 AND improvement_pct >= 1 AS passed
        FROM (SELECT *, (challenger_accuracy - champion_accuracy) * 100 / champion_accuracy AS improvement_pct FROM (
          SELECT count(*) AS n, avg(cast((fraud_score >= 0.5) = (label = 1) AS int)) AS champion_accuracy,
            avg(cast((k / 100 >= 0.5) = (label = 1) AS int)) AS challenger_accuracy,
            avg(cast((fraud_score >= 0.5) = (k / 100 >= 0.5) AS int)) AS agreement
          FROM (SELECT *, {LABEL} AS label FROM scored))),
        (SELECT quantile_cont(latency_ms, 0.95) AS p95_ms FROM latency WHERE arm = 'challenger')""",
    ),
    "join_baseline_range": over(
        "base", sql=f"SELECT batch_date, {rounded('baseline_score', 'baseline_high_pct')}, baseline_days FROM base"
    ),
    "join_current_model": """SELECT e.event_id, concat('executions/', m.event_id, '/output.json') AS model_path,
        m.event_id AS model_version FROM events e, (SELECT event_id FROM events WHERE event_type = 'purchase'
        ORDER BY ts DESC, event_id DESC LIMIT 1) m""",
    # windows, sorts, top-k
    "win_trailing_baseline": over(
        "base", sql=f"SELECT batch_date, {rounded('baseline_score', 'baseline_high_pct')}, baseline_days FROM base"
    ),
    "win_alert_chunks": over("chunks", sql="SELECT batch_date, event_id, rn, chunk FROM chunks"),
    "agg_alert_summary": over(
        "daily",
        sql="""SELECT batch_date, high AS high_risk_count, high AS alerts_sent, cast(ceil(high / 100) AS bigint) AS alert_batches
        FROM daily""",
    ),
    # The decimal text of a score rounded half up, as the message formats it.
    "agg_alert_message": over(
        "chunks",
        sql="""SELECT batch_date, chunk AS batch_index, count(*) AS size,
        concat('Fraud Alert: ', count(*), ' High-Risk Transactions Detected') AS subject,
        concat('High-Risk Fraud Transactions Detected', chr(10), 'Batch Date: ', batch_date, chr(10), 'Count: ', count(*), chr(10),
          chr(10), 'Transactions:', chr(10), string_agg(concat('  - ID: ', transaction_id, chr(10),
          '    Amount: $', cast(amount AS decimal(18,2)), chr(10),
          '    Fraud Score: ', cast(round(cast(cast(fraud_score AS varchar) AS decimal(38,20)), 4) AS decimal(18,4)), chr(10),
          '    Timestamp: ', timestamp_ms, chr(10), '    Merchant: ', merchant_category, chr(10), chr(10)), '' ORDER BY rn)) AS message
        FROM chunks GROUP BY batch_date, chunk""",
    ),
    "topk_trials": over(
        "trials",
        sql="SELECT * REPLACE (round(accuracy, 6) AS accuracy) FROM trials ORDER BY trials.accuracy DESC, trial_no LIMIT 10",
    ),
    "topk_best_trial": over(
        "trials",
        sql="""SELECT * REPLACE (round(accuracy, 6) AS accuracy) FROM trials
        QUALIFY row_number() OVER (PARTITION BY method ORDER BY trials.accuracy DESC, trial_no) = 1""",
    ),
    "topk_winner_recall": over(
        "model_metrics",
        sql=f"""SELECT algorithm, {rounded('recall', 'precision')} FROM model_metrics
        ORDER BY model_metrics.recall DESC, algorithm LIMIT 1""",
    ),
    "topk_high_risk": over(
        "scored",
        sql="""SELECT event_id, transaction_id, round(fraud_score, 6) AS fraud_score FROM scored WHERE fraud_score >= 0.8
        ORDER BY scored.fraud_score DESC, event_id LIMIT 50""",
    ),
    "win_latest_per_key": over(
        "tx",
        sql="""SELECT user_id, event_id, timestamp_ms, amount, merchant_category FROM tx
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms DESC, event_id DESC) = 1""",
    ),
    # drift and monitoring
    "drift_daily": over(
        "moved",
        sql=f"""SELECT batch_date, total, {rounded('avg_score', 'high_pct', 'baseline_score', 'baseline_high_pct',
        'avg_score_drift', 'high_risk_drift')}, drift_detected FROM moved""",
    ),
    "drift_alerts": over(
        "moved",
        sql=f"""SELECT batch_date, concat('Model Drift Detected: ', batch_date) AS subject,
        printf(concat('Model Distribution Drift Detected', chr(10), 'Batch Date: %s', chr(10), chr(10), 'Average Fraud Score:', chr(10),
          '  Current: %.4f', chr(10), '  Baseline: %.4f', chr(10), '  Drift: %.4f (threshold: 0.1)', chr(10), chr(10),
          'High Risk Percentage:', chr(10), '  Current: %.2f%%', chr(10), '  Baseline: %.2f%%', chr(10),
          '  Drift: %.4f (threshold: 0.05)', chr(10), chr(10), 'Action Required:', chr(10), '  - Review model performance', chr(10),
          '  - Consider retraining if drift persists', chr(10), '  - Investigate data quality issues', chr(10)),
          cast(batch_date AS varchar), avg_score, baseline_score, avg_score_drift, high_pct * 100, baseline_high_pct * 100,
          high_risk_drift) AS message, {rounded('avg_score_drift', 'high_risk_drift')} FROM moved WHERE drift_detected""",
    ),
    "drift_ks": over(
        "tx",
        sql=f"""SELECT feature, n_baseline, n_recent, round(statistic, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drifted FROM (
          SELECT *, CASE WHEN lam < 0.2 THEN 1.0::double ELSE least(greatest(list_sum(list_transform(range(1, 101),
            lambda i: (CASE WHEN i % 2 = 1 THEN 2.0::double ELSE -2.0::double END) * exp(-2.0::double * i * i * lam * lam))), 0), 1) END AS p FROM (
            SELECT *, sqrt(n_baseline * n_recent / (n_baseline + n_recent)) * statistic AS lam FROM (
              SELECT feature, cast(max(na) AS bigint) AS n_baseline, cast(max(nb) AS bigint) AS n_recent, max(abs(ra / na - rb / nb)) AS statistic FROM (
                SELECT feature, sum(a) OVER w AS ra, sum(b) OVER w AS rb, sum(a) OVER g AS na, sum(b) OVER g AS nb FROM (
                  SELECT feature, value, count_if(batch_date < DATE '2024-01-21')::double AS a, count_if(batch_date >= DATE '2024-01-21')::double AS b
                  FROM ({_long('tx', ['amount', 'k', 'user_id'], 'batch_date')}) GROUP BY feature, value)
                WINDOW w AS (PARTITION BY feature ORDER BY value), g AS (PARTITION BY feature))
              GROUP BY feature)))""",
    ),
    "drift_board_accuracy": over(
        "daily",
        "pred",
        sql="""SELECT metric, round(recent, 6) AS recent, round(baseline, 6) AS baseline, round(recent - baseline, 6) AS change,
          metric = 'accuracy' AND recent < 0.95 AS alert FROM (
          SELECT unnest([{'metric': 'avg_fraud_score', 'recent': coalesce(rs / rn, 0), 'baseline': coalesce(bs / bn, 0)},
            {'metric': 'high_risk_pct', 'recent': coalesce(rh / rn, 0), 'baseline': coalesce(bh / bn, 0)},
            {'metric': 'accuracy', 'recent': ra, 'baseline': ba}], recursive := true) FROM (
            SELECT sum(total) FILTER (age < 7) AS rn, sum(avg_score * total) FILTER (age < 7) AS rs, sum(high) FILTER (age < 7) AS rh,
              sum(total) FILTER (age BETWEEN 7 AND 36) AS bn, sum(avg_score * total) FILTER (age BETWEEN 7 AND 36) AS bs,
              sum(high) FILTER (age BETWEEN 7 AND 36) AS bh
            FROM (SELECT *, max(batch_date) OVER () - batch_date AS age FROM daily)), (
            SELECT avg(ok) FILTER (age < 7) AS ra, avg(ok) FILTER (age BETWEEN 7 AND 36) AS ba FROM (
              SELECT cast((score >= 0.5) = (label = 1) AS int) AS ok, max(batch_date) OVER () - batch_date AS age FROM pred)))""",
    ),
    # model queries: what holds for any fit
    "ml_score_batch": over(
        "cards",
        sql="SELECT event_id, true AS is_probability, cast(Time * 1000 AS bigint) AS scoring_ms, true AS tells_apart FROM cards",
    ),
    "ml_probe": over(
        "split_cards", sql="SELECT count(*) AS probed, true AS healthy, true AS tells_apart FROM split_cards WHERE split <> 'train'"
    ),
    "ml_grid_search": """SELECT cast(9 * d + 3 * e + n AS int) AS trial_no, 'grid' AS method, ['3', '5', '7'][d + 1] AS max_depth,
        ['0.01', '0.1', '0.2'][e + 1] AS eta, ['50', '100', '150'][n + 1] AS num_round, true AS judged, true AS tells_apart
        FROM range(3) d(d), range(3) e(e), range(3) n(n)""",
    "ml_cv_grid": """SELECT cast(3 * d + e AS int) AS trial_no, ['5', '7', '10'][d + 1] AS max_depth,
        ['0.15', '0.2', '0.25'][e + 1] AS eta, true AS tells_apart, true AS is_spread FROM range(3) d(d), range(3) e(e)""",
    "drift_board": over(
        "daily",
        sql="""SELECT metric, round(recent, 6) AS recent, round(baseline, 6) AS baseline, round(recent - baseline, 6) AS change FROM (
          SELECT unnest([{'metric': 'avg_fraud_score', 'recent': coalesce(rs / rn, 0), 'baseline': coalesce(bs / bn, 0)},
            {'metric': 'high_risk_pct', 'recent': coalesce(rh / rn, 0), 'baseline': coalesce(bh / bn, 0)}], recursive := true) FROM (
            SELECT sum(total) FILTER (age < 7) AS rn, sum(avg_score * total) FILTER (age < 7) AS rs, sum(high) FILTER (age < 7) AS rh,
              sum(total) FILTER (age BETWEEN 7 AND 36) AS bn, sum(avg_score * total) FILTER (age BETWEEN 7 AND 36) AS bs,
              sum(high) FILTER (age BETWEEN 7 AND 36) AS bh
            FROM (SELECT *, max(batch_date) OVER () - batch_date AS age FROM daily)))""",
    ),
    # evaluation
    "eval_metrics": over("metrics", sql=f"SELECT tp, fp, tn, fn, {rounded(*RATES)} FROM metrics"),
    "eval_auc_step": over("step", sql="SELECT round(auc_step, 6) AS auc_step FROM step"),
    "eval_auc_roc": over("auc", sql="SELECT round(auc, 6) AS auc FROM auc"),
    "eval_confusion": over(
        "counts",
        sql="""SELECT 0 AS label, 0 AS predicted, tn AS n FROM counts UNION ALL SELECT 0, 1, fp FROM counts
        UNION ALL SELECT 1, 0, fn FROM counts UNION ALL SELECT 1, 1, tp FROM counts""",
    ),
    "eval_roc_curve": over(
        "curve",
        sql="""SELECT round(score, 6) AS threshold, round(fp / nq, 6) AS fpr, round(tp / np, 6) AS tpr FROM curve
        UNION ALL SELECT 'Infinity'::double, 0, 0""",
    ),
    "eval_pr_curve": over(
        "curve",
        sql="""SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / np, 6) AS recall FROM curve
        UNION ALL SELECT NULL, 1, 0""",
    ),
    "eval_gate": over(
        "model_metrics",
        sql="""SELECT algorithm, round(accuracy, 6) AS accuracy, accuracy >= 0.9 AS meets_production, accuracy < 0.8 AS low_accuracy
        FROM model_metrics""",
    ),
    "eval_gate_full": over(
        "model_metrics", "model_auc",
        sql="SELECT algorithm, "
        + ", ".join(f"{m} >= {v} AS {m}_ok" for m, v in FULL_GATE.items())
        + ", "
        + " AND ".join(f"{m} >= {v}" for m, v in FULL_GATE.items())
        + " AS all_ok FROM model_metrics JOIN model_auc USING (algorithm)",
    ),
    "eval_threshold_sweep": over(
        "sweep",
        sql="""SELECT *, round(tp / (tp + fn), 6) AS tpr, round(fp / (fp + tn), 6) AS fpr,
        CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 6) END AS precision FROM sweep""",
    ),
    "eval_threshold_cost": over(
        "sweep",
        sql="""SELECT *, row_number() OVER (ORDER BY cost, threshold) = 1 AS is_best FROM (
        SELECT threshold, fp, fn, fp * 10.0::double + fn * 500.0::double AS cost FROM sweep)""",
    ),
    "eval_f_beta": over(
        "model_metrics",
        sql="SELECT algorithm, "
        + ", ".join(
            f"""CASE WHEN {b * b} * precision + recall = 0 THEN 0
            ELSE round({1 + b * b} * precision * recall / ({b * b} * precision + recall), 6) END AS {n}"""
            for n, b in (("f_half", 0.5), ("f_two", 2.0))
        )
        + " FROM model_metrics",
    ),
    "eval_report": over(
        "metrics", "auc", "step",
        sql=f"""SELECT tp, fp, tn, fn, {rounded(*RATES, 'auc', 'auc_step')}, accuracy >= 0.9 AS meets_production,
        accuracy < 0.8 AS low_accuracy, {', '.join(f'{m} >= {v} AS {m}_ok' for m, v in FULL_GATE.items())},
        {' AND '.join(f'{m} >= {v}' for m, v in FULL_GATE.items())} AS all_ok,
        {', '.join(f'round({m} - {v}, 6) AS {m}_change' for m, v in PRODUCTION_BASELINE.items())} FROM metrics, auc, step""",
    ),
    "eval_metrics_by_model": over(
        "model_metrics", "model_auc",
        sql=f"SELECT algorithm, tp, fp, tn, fn, {rounded(*RATES, 'auc')} FROM model_metrics JOIN model_auc USING (algorithm)",
    ),
    # scoring
    "ml_score_udf": over(
        "tx",
        sql="""SELECT event_id, round(least(greatest((amount - 20.0::double) / 200.0::double + k / 1000.0::double, 0), 1), 6) AS score
        FROM tx""",
    ),
    # experiments and registry
    "exp_query_runs": over(
        "runs",
        sql="""SELECT run_id, experiment_name, algorithm, created, round(accuracy, 6) AS accuracy,
        concat('{"max_depth":"', max_depth, '"}') AS hyperparameters FROM runs WHERE experiment_name = '1-URGENT'
        AND created BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' AND accuracy >= 0.5 AND max_depth = '7'
        ORDER BY created DESC, run_id DESC LIMIT 100""",
    ),
    "reg_params_as_of": over(
        "param_history",
        sql="""SELECT path, arg_max(value, version) AS value, max(version) AS version FROM param_history
        WHERE version <= (SELECT max(version) // 2 FROM param_history) GROUP BY path""",
    ),
    "reg_rollback": over(
        "param_history",
        sql="""SELECT path, arg_max(value, version) AS value, (SELECT max(version) + 1 FROM param_history) AS version,
        max(version) AS restored_from FROM param_history
        WHERE version <= (SELECT max(version) // 2 FROM param_history) GROUP BY path""",
    ),
    "reg_promotion_events": over(
        "runs",
        sql="""SELECT run_id, 'production-promotion' AS experiment_name, 'risk-team' AS approver,
        concat('backups/', strftime(created, '%Y%m%d-%H%M%S')) AS backup_key, max_depth AS promoted_max_depth,
        cast(run_id AS varchar) AS source, 4 AS n_params FROM runs""",
    ),
    "reg_config_history": over(
        "runs",
        sql="""SELECT name, current_version, archived, previous_version, current_tested, previous_depth FROM (
          SELECT experiment_name AS name, run_id AS current_version, count(*) OVER g - 1 AS archived,
            lag(run_id) OVER o AS previous_version, strftime(created, '%Y-%m-%d') AS current_tested,
            lag(max_depth) OVER o AS previous_depth, row_number() OVER (PARTITION BY experiment_name ORDER BY run_id DESC) AS rn
          FROM runs WINDOW g AS (PARTITION BY experiment_name), o AS (PARTITION BY experiment_name ORDER BY run_id))
        WHERE rn = 1""",
    ),
    "reg_promote": """SELECT path, count(*) AS n, max(version) AS version, max_by(value, version) AS value FROM (
          SELECT version, unnest(['objective', 'num_round', 'max_depth', 'eta', 'subsample', 'colsample_bytree']) AS path,
            unnest(['binary:logistic', cast(o_custkey AS varchar), cast(o_custkey % 25 AS varchar), cast(o_orderkey % 120 / 100.0::double AS varchar),
              '0.8', '0.8']) AS value
          FROM (SELECT *, o_orderkey AS version FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 25 BETWEEN 1 AND 20
            AND o_orderkey % 120 > 0 AND o_orderkey % 120 <= 100 AND o_custkey BETWEEN 1 AND 1000)) GROUP BY path""",
    "exp_merge_results": over(
        "trials", "model_metrics",
        sql="""SELECT * FROM (SELECT 'hyperparameter_tuning' AS section, round(accuracy, 6) AS best_score, max_depth,
          NULL::varchar AS best_algorithm, NULL::double AS f1, NULL::bigint AS n_features
          FROM trials ORDER BY trials.accuracy DESC, trial_no LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'algorithm_comparison', round(accuracy, 6), NULL, algorithm, round(f1, 6), NULL
          FROM model_metrics ORDER BY model_metrics.accuracy DESC, algorithm LIMIT 1)
        UNION ALL SELECT 'feature_engineering', NULL, NULL, NULL, NULL, 3""",
    ),
    "exp_compare_methods": over(
        "trials", sql="SELECT method, round(max(accuracy), 6) AS best_score, count(*) AS trials FROM trials GROUP BY method"
    ),
    # scalar functions
    "scalar_suite": """SELECT event_id, round(ln(1 + v), 6) AS v_log1p, round(v * v, 6) AS v_square, round(sqrt(v), 6) AS v_sqrt,
        round(abs(v - 50), 6) AS v_abs, round(cast(v AS decimal(18,4)), 1)::double AS v_round1,
        round(least(greatest((v - 20) / 100, 0), 1), 6) AS v_clamp, v BETWEEN 10 AND 20 AS v_between,
        t IN ('view', 'click') AS t_isin, cast(extract(hour FROM ts) AS int) AS t_hour, cast(extract(isodow FROM ts) - 1 AS int) AS t_weekday,
        cast(ts AS date) - 30 AS t_minus_30, cast(ts AS date) AS t_parsed, strftime(ts, '%Y%m%d-%H%M%S') AS t_suffix,
        epoch_us(ts) // 1000 AS t_millis, epoch_us(ts) // 1000 AS t_from_seconds, cast(cast(v AS decimal(18,2)) AS varchar) AS v_fmt2,
        concat(cast(floor(v) AS bigint), '%') AS v_pct, t AS s_trim, v AS s_double, 0.0::double AS s_not_double,
        concat(t, '|', user_id) AS s_split_join, concat('bucket-', t) AS p_bucket, concat('executions/', event_id, '/output.json') AS p_key,
        'output.json' AS p_base, concat('store://bucket-', t, '/executions/', event_id, '/output.json') AS p_stripped, true AS p_prefix,
        printf('run-%s-%05d', t, user_id) AS s_template, k AS m_get, concat(k, ',u') AS m_values, 1 AS m_filtered,
        concat('{"event_id":', event_id, ',"event_type":"', t, '"}') AS j_encoded, cast(k AS bigint) AS j_decoded,
        CASE WHEN v > 50 THEN v ELSE 0 END AS v_default,
        concat('StageError: ', t, CASE WHEN v > 60 THEN ' (caused by IOError: disk)' WHEN v > 50
          THEN ' (caused by IOError: No error message)' ELSE '' END) AS s_error,
        concat(t, '-', strftime(ts, '%Y%m%d-%H%M%S'), '-', substr(md5(cast(event_id AS varchar)), 1, 8)) AS s_run_id
        FROM (SELECT *, value AS v, event_type AS t, json_extract_string(props, '$.k') AS k FROM events)""",
    # streaming
    "stream_scored": over(
        "scored",
        sql="""SELECT transaction_id, batch_date, round(fraud_score, 6) AS fraud_score,
        CASE WHEN fraud_score >= 0.8 THEN 'high' WHEN fraud_score >= 0.5 THEN 'medium' ELSE 'low' END AS risk_band FROM scored""",
    ),
    "stream_daily_summary": over("daily", sql="SELECT * REPLACE (round(avg_score, 6) AS avg_score) FROM daily"),
    "stream_dedup": over("tx", sql="SELECT event_id, transaction_id, timestamp_ms, amount FROM tx"),
}
