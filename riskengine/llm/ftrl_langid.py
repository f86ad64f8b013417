"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of two to four bytes (A-Z as a-z; digits, signs and spaces as one kind of space) are
hashed to a fixed number of features. Document frequencies come from all training texts. The
regression is fitted by follow-the-regularised-leader with an elastic net (per-coordinate
steps; L1 keeps weights at exactly 0) on a bounded number of training texts per language,
and a temperature fitted on texts it has not seen makes its scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import as_fraction, held_out, id_text, map_batches
from riskengine.llm.tokens import LOWER

BITS = 15
FEATURES = 1 << BITS
PER_LANGUAGE = 600  # most training texts per language, about; chosen by a hash of the id
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"
SEED = 77

_letters = [*range(ord("a"), ord("z") + 1)]
CLASS = LOWER.copy()
CLASS[[b for b in range(128) if LOWER[b] not in _letters]] = 0x20


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs, with a space added before and after."""
    b = np.full(len(text) + 2, 0x20, dtype=np.uint32)
    b[1:-1] = CLASS[np.frombuffer(text, dtype=np.uint8)]
    total = np.zeros(FEATURES, dtype=np.int64)
    grams = b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        grams = (grams[:-1] << np.uint32(8)) | b[n - 1 :]
        at = (grams * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(32 - BITS)
        total += np.bincount(at, minlength=FEATURES)
    found = np.flatnonzero(total)
    return found, total[found]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            df[counts(text.as_py())[0]] += 1
            n += 1
    at = np.flatnonzero(df)
    # Feature -1: the number of texts.
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n))], ["feature", "n"]
    )


def vector(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = counts(text)
    x = (1 + np.log(n)) * idf[at]
    size = np.sqrt((x * x).sum())
    return at, (x / size if size > 0 else x).astype(np.float32)


def _vectors(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = idf.value
        for batch in batches:
            both = [vector(t.as_py(), weights) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("calibrate"),
                    batch.column("order"),
                    pa.array([a.astype(np.int32).tobytes() for a, _ in both], pa.binary()),
                    pa.array([x.tobytes() for _, x in both], pa.binary()),
                ],
                ["lang", "calibrate", "order", "at", "x"],
            )

    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader, proximal form, one weight per feature and class."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = _softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, from a fine grid."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20.0), 200))
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(rows: pd.DataFrame) -> tuple[list[str], np.ndarray, float]:
    """(languages, weights, temperature) from vectors in the order of their ids' hashes."""
    rows = rows.sort_values(["order", "lang"], kind="stable")
    learn, rest = rows[~rows["calibrate"]], rows[rows["calibrate"]]
    langs = sorted(learn["lang"].unique())
    model = Ftrl(len(langs))
    number = {x: i for i, x in enumerate(langs)}
    sparse = lambda r: (np.frombuffer(r.at, dtype=np.int32), np.frombuffer(r.x, dtype=np.float32))
    examples = [(*sparse(r), number[r.lang]) for r in learn.itertuples(index=False)]
    for _ in range(EPOCHS):
        for at, x, y in examples:
            model.learn(at, x, y)
    w = model.weights(slice(None)).astype(np.float32)
    unseen = [(*sparse(r), number[r.lang]) for r in rest.itertuples(index=False) if r.lang in number]
    z = np.array([x @ w[at] for at, x, _ in unseen]).reshape(-1, len(langs))
    return langs, w, temperature(z, np.array([y for *_, y in unseen], dtype=np.int64))


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, w, heat, idf = model.value
        for batch in batches:
            said, score = [], []
            for text in batch.column("text"):
                body = text.as_py()
                if not langs or not any(map(str.isalpha, body.decode("utf-8", "replace"))):
                    said.append(UNKNOWN)
                    score.append(0.0)
                    continue
                at, x = vector(body, idf)
                p = _softmax((x @ w[at]).astype(np.float64) / heat)
                said.append(langs[int(np.argmax(p))])
                score.append(float(min(1.0, p.max())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(said, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return run


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per input row.

    Learns from rows that are not held out (crc32 of the id, modulo 3, is 1) and have a
    language and a text with a letter. Null text and text without a letter are ``und`` with
    score 0, as is every text if there is nothing to learn from. Repeated rows each count.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    lang = F.col(lang_col).cast("string")
    learn = docs.filter(lang.isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    body = F.col(text_col).cast("string").cast("binary")
    learn = learn.select(F.col(id_col).alias("doc_id"), body.alias("text"), lang.alias("lang"))
    learn = learn.filter(~held_out("doc_id", 3, 1))
    found = map_batches(learn.select("text"), _frequencies, "feature int, n bigint").groupBy("feature").agg(
        F.sum("n").alias("n")
    ).toPandas()  # at most one row per feature
    df, n = np.zeros(FEATURES), 0
    for feature, times in zip(found["feature"], found["n"]):
        if feature < 0:
            n = times
        else:
            df[feature] = times
    idf = np.log((n + 1) / (df + 1)) + 1.0
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    model = ([], np.zeros((FEATURES, 0), np.float32), 1.0, idf)
    if sizes:
        sizes_df = F.broadcast(spark.createDataFrame(list(sizes.items()), "lang string, size bigint"))  # a row per language
        order = F.xxhash64("doc_id", F.lit(SEED))
        chosen = learn.withColumn("order", order).join(sizes_df, "lang").filter(
            as_fraction(F.col("order")) <= F.lit(float(per_language)) / F.col("size")
        )
        sent = spark.sparkContext.broadcast(idf)
        rows = map_batches(
            chosen.select("lang", held_out("doc_id", 5, 0).alias("calibrate"), "order", "text"),
            _vectors(sent),
            "lang string, calibrate boolean, order bigint, at binary, x binary",
        ).limit(3 * per_language * len(sizes))
        rows = rows.toPandas()
        if len(rows) and not rows["calibrate"].all():
            model = (*fit(rows), idf)
    texts = id_text(docs, id_col, text_col)
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    said = map_batches(texts, _predict(spark.sparkContext.broadcast(model)), schema)
    return said.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
