"""Line dedup over overlapping three-line windows, in DataFrame functions only.

Every three consecutive lines of a text are a window, known by the 128-bit digest of the lines
with their breaks. A window that occurs again, anywhere, is repeated: its first occurrence in the order
of ids and lines stays, the lines that later ones cover are removed. Positions covered by
overlapping windows are merged, and the other lines are put together again.

First occurrences are found by an aggregation (partial before its shuffle), and are joined to
the windows as a table, so that the windows of a very common passage can be split.

Defined results: a NULL text stays NULL and has no lines; a text of fewer than three lines has
no windows. Windows of three empty lines don't count. Rows with a NULL id come last in
the order, rows with the same id in the order of the input files. All columns are kept, whatever their names, but for
``n_lines`` and ``n_removed_lines``, which are replaced; rows are neither dropped nor merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.tables import FILE, PLACE, ROW, Scratch, apart

WINDOW_LINES = 3
_BREAK = "\n"
_LINES, _GONE = "_lines", "_gone"


def _split(text: str) -> Column:
    return F.split(F.col(text).cast("string"), _BREAK, -1)


def line_windows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per window of the placed rows: their place, ``_id``, ``line`` (from 0) and ``digest``."""
    lines = df.select(*PLACE, F.col(key).cast("long").alias("_id"), _split(text).alias(_LINES))
    n = F.size(_LINES)
    shifted = [F.slice(_LINES, 1 + i, F.greatest(n - i, F.lit(0))).alias(f"l{i}") for i in range(WINDOW_LINES)]
    rows = lines.where(n >= WINDOW_LINES).select(*PLACE, "_id", F.posexplode(F.arrays_zip(*shifted)).alias("line", "w"))
    window = F.concat_ws(_BREAK, *[F.col(f"w.l{i}") for i in range(WINDOW_LINES)])
    whole = F.col(f"w.l{WINDOW_LINES - 1}").isNotNull() & (window != _BREAK * (WINDOW_LINES - 1))
    return rows.where(whole).select(*PLACE, "_id", "line", F.unhex(F.md5(window)).alias("digest"))


def repeated_lines(windows: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per place with the lines that later occurrences cover, each line once."""
    at = F.struct(F.col("_id").isNull().alias("n"), F.col("_id"), *PLACE, F.col("line"))
    firsts = windows.groupBy("digest").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = scratch.write(firsts.select("digest", "first"), "firsts")
    here = [F.col(f"first.{name}") == F.col(name) for name in (FILE, ROW, "line")]
    later = windows.join(firsts, "digest").where(~(here[0] & here[1] & here[2]))
    starts = later.groupBy(*PLACE).agg(F.collect_list("line").alias("starts"))
    covered = F.flatten(F.transform("starts", lambda line: F.sequence(line, line + WINDOW_LINES - 1)))
    return starts.select(*PLACE, F.array_distinct(covered).alias(_GONE))


def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """``df`` without the repeated lines, and with ``n_lines`` and ``n_removed_lines``."""
    scratch = scratch or Scratch(df.sparkSession, "lines")
    inner, names = apart(df)
    placed, body = scratch.placed(inner), names[text]
    windows = scratch.write(line_windows(placed, names[key], body), "windows")
    # The list grows with the corpus, so it is shuffled like the rows, whatever its size here.
    gone = scratch.write(repeated_lines(windows, scratch), "gone").hint("merge")
    scratch.drop(windows)
    joined = placed.join(gone, list(PLACE), "left").withColumn(_LINES, _split(body))
    left = F.array_except(F.sequence(F.lit(0), F.size(_LINES) - 1), F.col(_GONE))
    put_together = F.concat_ws(_BREAK, F.transform(left, lambda line: F.get(_LINES, line)))
    return joined.select(
        *[
            (F.when(F.col(_GONE).isNull(), F.col(own)).otherwise(put_together) if own == body else F.col(own)).alias(c)
            for c, own in zip(df.columns, inner.columns, strict=True)
            if c not in ("n_lines", "n_removed_lines")
        ],
        F.greatest(F.size(_LINES), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(_GONE), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
