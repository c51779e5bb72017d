"""Helpers shared by the operators: column picking, scratch tables, global positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docvault.session import work_dir

#: Stands for a null document id where an order or a key is needed.
NO_ID = -(2**63)


def pick(rows: DataFrame, *names: str) -> DataFrame:
    """The named columns only, whatever other columns there are.

    Names match exactly, so a further column `TEXT` or one with an internal name does no harm.
    """
    at = {name: i for i, name in enumerate(rows.columns)}
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.select(*[F.col(f"c{at[name]}").alias(name) for name in names])


def boxed(rows: DataFrame, box: str, *names: str) -> DataFrame:
    """The named columns, and all columns as they are in one struct column `box`."""
    inner = [f"c{i}" for i in range(len(rows.columns))]
    plain = rows.toDF(*inner)
    at = {name: i for i, name in enumerate(rows.columns)}
    return plain.select(
        *[F.col(f"c{at[name]}").alias(name) for name in names],
        F.struct(*[F.col(c) for c in inner]).alias(box),
    )


def unboxed(rows: DataFrame, box: str, names: Sequence[str], **changed: Column) -> DataFrame:
    """The columns that `boxed` put away, some of them changed or added."""
    kept = [changed.pop(n).alias(n) if n in changed else F.col(f"{box}.c{i}").alias(n) for i, n in enumerate(names)]
    return rows.select(*kept, *[c.alias(n) for n, c in changed.items()])


def stored(rows: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Rows written once to the shared scratch folder and read back, which cuts the lineage.

    With `tasks` the last step runs in so many tasks, where it would have more, and makes as many files.
    """
    spark = rows.sparkSession
    path = work_dir(spark, name)
    rows = rows.coalesce(tasks) if tasks else rows
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """Tasks for so many rows, about `each` in one, so that a small table is no crowd of tiny tasks and files.

    Never fewer than run at once.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_points(rows: DataFrame, column: str, pieces: int) -> list[int]:
    """At most pieces - 1 values of a bigint column that cut its rows into runs of like size.

    Equal values stay in one run. Approximate quantiles over all rows; only the cuts reach
    the driver.
    """
    at = [i / pieces for i in range(1, pieces)]
    found = rows.approxQuantile(column, at, 0.25 / pieces) if at else []
    return sorted({min(int(x), 2**63 - 1) for x in found})


def run_of(column: Column, cuts: Sequence[int]) -> Column:
    """The number of cuts that are at most the value; null counts as below all."""
    if not cuts:
        return F.lit(0)
    points = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    return F.coalesce(F.size(F.filter(points, lambda p: p <= column)), F.lit(0))


def with_position(rows: DataFrame, by: str, ties: Sequence[Column], name: str = "position") -> DataFrame:
    """Add each row's place (from 0) in the order of a bigint column without nulls, then `ties`.

    The rows are cut into value runs, four per shuffle partition; a run is numbered in one task
    and starts after the sizes of the runs before it. A value held by very many rows is one
    run, so `by` should end in hash bits where values repeat.
    """
    cuts = split_points(rows, by, 4 * partitions(rows.sparkSession))
    runs = rows.withColumn("run__", run_of(F.col(by), cuts))
    sizes = runs.groupBy("run__").count().collect()  # as many rows as there are runs
    start, starts = 0, {}
    for run, size in sorted((r["run__"], r["count"]) for r in sizes):
        starts[run] = start
        start += size
    if not starts:
        return rows.withColumn(name, F.lit(None).cast("bigint"))
    first = F.element_at(
        F.array(*[F.lit(starts.get(i, 0)).cast("bigint") for i in range(len(cuts) + 1)]), F.col("run__") + 1
    )
    order = Window.partitionBy("run__").orderBy(F.col(by), *ties)
    return runs.withColumn(name, first + F.row_number().over(order) - 1).drop("run__")


def numbered(rows: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "position", total: str = "total") -> DataFrame:
    """Add each row's place (from 0) in its group by the order columns, nulls first, and the group's rows.

    `rows` should be a stored table, as it is sampled first; group columns must not be null.
    The rows are dealt out by ranges of (groups, order), so a large group lies in many ranges;
    each range numbers its own rows and starts after those of the group in the ranges before.
    """
    ranged = rows.repartitionByRange(*groups, *order).withColumn("run__", F.spark_partition_id())
    ranged = stored(ranged, "ranges")  # the number of a range holds from here on
    group = Window.partitionBy(*groups)
    sizes = ranged.groupBy(*groups, "run__").agg(F.count(F.lit(1)).alias("size__"))  # ranges a group, at most
    starts = sizes.select(
        *groups,
        "run__",
        (F.sum("size__").over(group.orderBy("run__")) - F.col("size__")).alias("start__"),
        F.sum("size__").over(group).alias(total),
    )
    inside = Window.partitionBy(*groups, "run__").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = ranged.withColumn("row__", F.row_number().over(inside)).join(starts, [*groups, "run__"])
    return placed.withColumn(name, F.col("start__") + F.col("row__") - 1).drop("run__", "row__", "start__")
