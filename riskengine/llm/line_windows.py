"""Repeated passages of lines: overlapping windows of three lines, in DataFrame functions only.

Every run of three consecutive lines is a window, keyed by the 64-bit hashes of its three
lines. A window's first place is the smallest (document, line) it stands at; at every later
place its three lines are covered. Covered lines go, and overlapping windows merge by their
lines, so a longer repeated passage goes as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskengine.llm.frames import row_key, stored

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _flags() -> Column:
    """For each line up to the last covered one, from the column ``covered``, whether it is covered."""
    covered = F.col("covered")
    others = F.array_except(F.sequence(F.lit(0), F.array_max(covered)), covered)
    return F.sort_array(F.concat(
        F.transform(covered, lambda i: F.struct(i.alias("line"), F.lit(True).alias("gone"))),
        F.transform(others, lambda i: F.struct(i.alias("line"), F.lit(False).alias("gone"))),
    ))["gone"]


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, n_removed, gone) for texts that have lines to remove: their number, and a flag per line up to the last.

    ``k`` is ``row_key`` of the row. Rows equal in id and text count as one text.
    """
    text = F.col(text_col)
    hashes = F.transform(_lines(text), lambda x: F.xxhash64(x))
    long = docs.filter(text.isNotNull()).select(
        F.col(id_col).alias("d"), row_key(id_col, text_col).alias("k"), hashes.alias("h")
    )
    long = long.filter(F.size("h") >= WINDOW)
    parts = [F.slice("h", i + 1, F.size("h") - (WINDOW - 1)) for i in range(WINDOW)]
    windows = long.select("d", "k", F.posexplode(F.arrays_zip(*parts)).alias("pos", "w")).select(
        "d", "k", "pos", *[F.col(f"w.{i}").alias(f"w{i}") for i in range(WINDOW)]
    )
    names = [f"w{i}" for i in range(WINDOW)]
    # Counted per place first, so that a row given twice is not a repeat of itself.
    windows = stored(windows, "windows")
    place = F.struct("d", "k", "pos")
    repeated = (
        windows.groupBy(*names)
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(*names, "first")
    )
    later = windows.join(repeated, names).filter(place > F.col("first"))
    span = F.explode(F.sequence(F.col("pos"), F.col("pos") + (WINDOW - 1)))
    covered = later.select("k", span.alias("line")).groupBy("k").agg(F.collect_set("line").alias("covered"))
    return covered.select("k", F.size("covered").cast("bigint").alias("n_removed"), _flags().alias("gone"))


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with their repeated passages removed, as (row, kept_text, n_lines, n_removed).

    ``row`` is the input row as a struct, so columns of any name pass through. Null text
    stays null with 0 lines; empty text is one empty line; texts of fewer than three lines
    are unchanged; a text whose lines all go is left empty. A window that repeats within one
    text loses its later places too. Nulls sort first among ids when the first place is chosen.
    """
    # The text travels in the row only: a second copy beside it would be shuffled and sorted too.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("k"))
    joined = rows.join(covered_lines(docs, id_col, text_col), "k", "left")
    body = F.col(f"row.{text_col}")
    lines = _lines(body)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False))), "\n")
    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), body).otherwise(kept).alias("kept_text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
    )
