"""Helpers that keep joins and groups bounded when keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pagequarry.session import cut_lineage

# A side is broadcast only after its rows and bytes were counted below these.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows and bytes of a DataFrame.
Size = tuple[int, int]

# Values of a key's sorted list in each of its parts, unless asked otherwise.
LIST_ROWS = 100_000


def size_metrics(df: DataFrame) -> list[Column]:
    """Rows of ``df`` and an upper estimate of their bytes, as aggregates."""
    width = F.lit(0)
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        size = F.octet_length(field.name) if kind in ("string", "binary") else F.lit(8)
        if kind == "array<bigint>":
            size = F.size(field.name) * F.lit(8)
        if kind == "array<string>":
            add = lambda total, value: total + F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(16)
            size = F.aggregate(field.name, F.lit(0), add)
        width = width + F.coalesce(size, F.lit(0)) + F.lit(16)
    return [F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")]


def measure(df: DataFrame) -> Size:
    row = df.agg(*size_metrics(df)).first()
    return row["n"], row["b"] or 0


def materialise(df: DataFrame) -> tuple[DataFrame, Size]:
    """``df`` written to the shared folder, and its size, seen while writing."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, *size_metrics(df)))
    return stored, (seen.get["n"], seen.get["b"] or 0)


def fits_broadcast(size: Size) -> bool:
    rows, width = size
    return rows <= BROADCAST_ROWS and width <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, size: Size | None = None) -> DataFrame:
    """Broadcast ``df`` when its measured size allows it.

    Otherwise ``df`` is returned as it is: the join is then a shuffled one and
    the adaptive skew join splits its hot keys.
    """
    return F.broadcast(df) if fits_broadcast(size or measure(df)) else df


def dealt_out(df: DataFrame) -> DataFrame:
    """The rows of a scan, dealt to a partition per core by a running number.

    ``repartition(n)`` alone sorts whole rows first, to deal them alike when a
    task is run again, and spills where a file is one split. A scan numbers its
    rows alike each time, so nothing is sorted here.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, F.monotonically_increasing_id())


def spread(df: DataFrame) -> DataFrame:
    """Give the work behind a plain scan at least one partition per core.

    ``df`` may only scan and project: counting the partitions of a plan with a
    shuffle would run it. A scan of many splits is left alone; one of few (an
    input that cannot be split) is redistributed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return dealt_out(df) if df.rdd.getNumPartitions() < cores else df


def sorted_lists(df: DataFrame, key: str, value: str, alias: str, part_rows: int = LIST_ROWS) -> DataFrame:
    """``(key, part, alias)``: the distinct values of each key, sorted.

    One rule for all keys: a value's part is its rank in the key's sorted order,
    counted from 0, divided by ``part_rows``. The parts of a key in order are its
    sorted list, whatever the number of rows. The rank comes from a range sort
    over keys and values, so a hot key is several ranges, counted apart and
    added up, and no task holds it.
    """
    pairs = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    dealt = cut_lineage(pairs.repartitionByRange(key, value).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col(key).alias("_key"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(value))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    ranked = dealt.withColumn("_rank", inside).join(before, same)
    part = F.floor((F.col("_before") + F.col("_rank") - 1) / F.lit(part_rows)).cast("int")
    return ranked.groupBy(key, part.alias("part")).agg(F.array_sort(F.collect_list(value)).alias(alias))


def literals(spark: SparkSession, values: list, name: str) -> DataFrame:
    """A few values given by the caller, one row each, without a Python task."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))
