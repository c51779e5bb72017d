"""Log parsing and the three alarms. All work on tables and on streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.functions.json_text import as_string, child, strict_json
from docvault.operators.once import compute_once
from docvault.operators.percentiles import counted_percentiles

# The alarm windows and quantile.
ERROR_WINDOW = "60 seconds"
SLOW_WINDOW = "5 minutes"
SLOW_QUANTILE = 0.99

WINDOW = ["window_start", "window_end"]


def parse_logs(lines: DataFrame, line: str = "line") -> DataFrame:
    """JSON log lines as (level, timestamp, message, ctx); lines that are not JSON give nulls."""
    carried = [c for c in lines.columns if c != line]
    parsed = compute_once(lines, {"ctx": strict_json(F.col(line))})
    ctx = F.col("ctx")
    return parsed.select(
        *carried,
        as_string(child(ctx, "$.level")).alias("level"),
        F.try_to_timestamp(as_string(child(ctx, "$.timestamp"))).alias("timestamp"),
        as_string(child(ctx, "$.message")).alias("message"),
        "ctx",
    )


def error_alarm(logs: DataFrame, watermark: str = "5 minutes") -> DataFrame:
    """One-minute windows with at least one error.

    The watermark only matters on streams, where rows that come later are left out; see
    `corrections` and `newest_windows`.
    """
    windows = (
        logs.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", ERROR_WINDOW))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("level") == "ERROR").alias("errors"),
        )
    )
    return windows.filter("errors > 0").select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "events",
        "errors",
    )


def dlq_alarm(dead: DataFrame) -> DataFrame:
    depth = dead.agg(F.count(F.lit(1)).alias("depth"))
    return depth.withColumn("alarm", F.col("depth") > 0)


def duration_counts(durations: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """How often each duration occurs in each five-minute window of (timestamp, duration_ms).

    On streams this is all the state there is, dealt out by window and duration: a window that
    holds most of the rows is spread over all tasks.
    """
    counted = (
        durations.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", SLOW_WINDOW), "duration_ms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "duration_ms", "n"
    )


def windows_of_counts(counts: DataFrame) -> DataFrame:
    """P99 duration per window, exact, from the counts of finished windows.

    A window of any number of distinct durations is narrowed down to those near the percentile
    before any task orders them (see operators.percentiles).
    """
    return counted_percentiles(counts, WINDOW, "duration_ms", "n", {"p99_ms": SLOW_QUANTILE}, total="events")


def duration_windows(durations: DataFrame) -> DataFrame:
    """P99 duration per five-minute window over a table of (timestamp, duration_ms)."""
    return windows_of_counts(duration_counts(durations))


def corrections(written: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Entries to append for windows that late rows have changed or made.

    `written` is the table of windows so far, with `revision`; `recomputed` comes from the same
    operator over the table of all rows. A window that comes out as its newest entry says gives
    nothing, so appending twice adds nothing the second time.
    """
    newest = newest_windows(written)
    values = [c for c in recomputed.columns if c not in WINDOW]
    known = newest.select(*[F.col(c).alias(f"_{c}") for c in WINDOW], F.col("revision").alias("_revision"), F.struct(*values).alias("_values"))
    joined = recomputed.join(known, [F.col(c) == F.col(f"_{c}") for c in WINDOW], "left")
    changed = joined.filter(F.col("_revision").isNull() | ~F.struct(*values).eqNullSafe(F.col("_values")))
    revision = F.coalesce(F.col("_revision") + 1, F.lit(0))
    return changed.select(*recomputed.columns, revision.cast("int").alias("revision"))


def newest_windows(written: DataFrame) -> DataFrame:
    """Each window once, as its entry of the highest `revision` says."""
    rest = [c for c in written.columns if c not in (*WINDOW, "revision")]
    newest = written.groupBy(*WINDOW).agg(F.max(F.struct("revision", *rest)).alias("_newest"))
    return newest.select(*WINDOW, *[F.col("_newest")[c].alias(c) for c in (*rest, "revision")])


def slow_alarm(windows: DataFrame, slow_ms: float = 108_000) -> DataFrame:
    """Pairs of adjacent windows whose P99 is over the threshold, named by the second one.

    Every breach is noted under its own start and under the start of the window after it;
    a start with both notes closes a pair. This reads the windows once, where a join of the
    breaches with themselves would compute them twice.
    """
    breach = F.struct("window_end", "events", "p99_ms")
    notes = F.array(
        F.struct(F.col("window_start"), breach.alias("_own"), F.lit(None).cast("double").alias("_before")),
        F.struct(
            F.col("window_end").alias("window_start"),
            F.lit(None).alias("_own"),
            F.col("p99_ms").alias("_before"),
        ),
    )
    noted = windows.filter(F.col("p99_ms") > slow_ms).select(F.inline(notes))
    pairs = noted.groupBy("window_start").agg(
        F.max("_own").alias("_own"), F.max("_before").alias("previous_p99_ms")
    )
    both = pairs.filter("_own IS NOT NULL AND previous_p99_ms IS NOT NULL")
    return both.select(
        "window_start", "_own.window_end", "_own.events", "previous_p99_ms", "_own.p99_ms"
    )
