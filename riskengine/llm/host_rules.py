"""Quality rules with a verdict per host, in DataFrame functions only.

Each text has its own counts and a base verdict. A text counts against its host if it fails
the base rules, holds many symbols for its words or repeats many of its lines; a host's
failure rate is drawn towards the rate of all hosts by a beta prior whose strength is fitted to the
spread of the hosts' rates (method of moments), so that a host with few texts is not judged
on them alone. Texts of a host whose drawn rate is over ``WORST`` go, whatever their own verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskengine.llm.frames import stored

# Fixed values of the base rules.
LEAST_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
# Fixed values of the rules that count against the host only.
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30

WORST = 0.5


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _repeat_words(h: Column) -> Column:
    """Words in windows of eight that stand twice or more in the text, by the words' hashes ``h``.

    Windows are compared by a hash of their eight word hashes. Most texts have no repeated
    window, which one distinct count shows; only the others are sorted and marked.
    """
    n = F.size(h) - (WINDOW - 1)
    parts = [F.slice(h, i + 1, n) for i in range(WINDOW)]
    keys = F.transform(F.arrays_zip(*parts), lambda w: F.xxhash64(*[w[str(i)] for i in range(WINDOW)]))
    return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(keys)


def _covered() -> Column:
    """Number of words in windows whose key occurs twice or more, from the column ``order``: (key, place) sorted."""
    order = F.col("order")
    n = F.size(order)
    none = F.array(F.lit(None).cast("struct<k:bigint,i:int>"))
    beside = F.arrays_zip(
        order, F.concat(none, F.slice(order, 1, n - 1)), F.concat(F.slice(order, 2, n - 1), none)
    )

    def again(x: Column) -> Column:
        own = x["order"]["k"]
        return F.coalesce(own == x["1"]["k"], F.lit(False)) | F.coalesce(own == x["2"]["k"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter(beside, again), lambda x: x["order"]["i"]))
    # A window adds its eight words less those the window before it has covered.
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, counts, base_failed, failed) per row; ``failed`` counts against the host. Null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    split = read.select("doc_id", "host", "text", _words(F.col("text")).alias("words"))
    hashed = split.select(
        "doc_id",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "").alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    keyed = hashed.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        _repeat_words(F.col("h")).alias("keys"),
    )
    # Columns of their own, so that no lambda below works them out per element.
    sorted_keys = F.sort_array(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    twice = F.size(F.array_distinct("keys")) < F.size("keys")
    ordered = keyed.withColumn("order", F.when(twice, sorted_keys)).drop("keys")
    counted = ordered.withColumn(
        "n_repeat_words", F.when(F.col("order").isNull(), 0).otherwise(_covered()).cast("bigint")
    ).drop("order")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    symbols = 100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines")
    return counted.withColumns({"base_failed": failed, "failed": failed | symbols | lines}).drop("n_lines")


def host_verdicts(rules: DataFrame, worst: float = WORST) -> DataFrame:
    """(host, n, failures, rate, host_ok): each host's failure rate drawn to the prior. A null host is a host.

    With mean m and variance v of the hosts' rates the prior is Beta(m s, (1 - m) s),
    s = m (1 - m) / v - 1, held between 1 and 1e6; hosts that do not differ give the largest s.
    """
    hosts = rules.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("int")).alias("failures")
    )
    own = F.col("failures") / F.col("n")
    prior = hosts.agg(F.avg(own).alias("m"), F.var_pop(own).alias("v"))  # one row
    spread = F.col("m") * (1 - F.col("m"))
    strength = F.when(F.col("v") > 0, F.least(F.lit(1e6), F.greatest(F.lit(1.0), spread / F.col("v") - 1))).otherwise(1e6)
    m, s = prior.select("m", strength.alias("s")).first()
    m, s = (0.0, 1e6) if m is None else (float(m), float(s))
    rate = (F.col("failures") + F.lit(m * s)) / (F.col("n") + F.lit(s))
    return hosts.select("host", "n", "failures", rate.alias("rate"), (rate <= worst).alias("host_ok"))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", worst: float = WORST
) -> DataFrame:
    """One row per input row: counts, ``base_failed`` and ``kept`` (own base verdict and the host's).

    Repeated rows each count. An empty table gives no rows. Other columns are not looked at.
    """
    rules = stored(measured(docs, id_col, text_col, host_col), "rules")
    verdicts = host_verdicts(rules, worst).select(F.col("host").alias("h"), "host_ok", F.col("rate").alias("host_rate"))
    joined = rules.join(verdicts, F.col("host").eqNullSafe(F.col("h")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
        F.round("host_rate", 6).alias("host_rate"),
    )
