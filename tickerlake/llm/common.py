"""Shared Spark helpers of the corpus operators: inputs, stored intermediates, gapless ranks, running totals."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlake.session import shared_dir

#: Rows that one task ranks; groups above it are split into several parts.
ROWS_PER_RANK_PART = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that no other column of the input can clash; null text counts as empty."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back.

    Cuts the lineage: later stages and lost executors read the files instead of
    computing the frame again, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with one call per input batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def giving_back(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` for mapInArrow, after which the worker returns the Arrow memory that its batches have left free.

    A reused worker would otherwise keep the most that any of its tasks held, beside the JVM's share of the executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def gapless_rank(df: DataFrame, group: list[str], order: list, out: str, rows: int | None = None) -> DataFrame:
    """0, 1, 2, ... within each group as column ``out``, without bringing a large group into one task.

    Rows are dealt into parts by a hash of the order columns; the parts' row
    counts (one small row each) give every part its start. The result follows
    ``order`` only inside a part. Give a stored or otherwise repeatable frame: it is read twice.
    """
    rows = df.count() if rows is None else rows
    parts = max(1, math.ceil(rows / ROWS_PER_RANK_PART))
    key = [*group, "__part"]
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"__k_{c}") for c in key],
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)
    same = [ranked[c].eqNullSafe(starts[f"__k_{c}"]) for c in key]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return (ranked.join(starts, cond).withColumn(out, (F.col("__r") + F.col("__start")).cast("long"))
            .drop("__r", "__start", "__part", *[f"__k_{c}" for c in key]))


def range_dealt(df: DataFrame, order: list, rows: int, per_part: int, name: str) -> DataFrame:
    """``df`` stored in ranges of ``order`` with their number as ``__part``.

    End ``order`` with a column that tells equal rows apart, so that a group of any size is split.
    """
    parts = max(1, math.ceil(rows / per_part))
    return stored(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), name)


def running_before(df: DataFrame, group: list[str], order: list, values: dict[str, str | None], *, how: str = "sum",
                   total: str | None = None, rows: int | None = None, per_part: int = ROWS_PER_RANK_PART) -> DataFrame:
    """For each row the total over the rows before it, in the exact order of its group.

    ``values`` maps each new column to the column summed (None counts rows); ``how`` is ``sum`` or ``xor``.
    ``total`` adds the group's whole total of the first value. The rows are dealt by ranges of (group, order), each
    range is summed on its own, and one small row per (group, range) gives every range its start: no group
    comes into one task. End ``order`` with a column that tells equal rows apart.
    """
    rows = df.count() if rows is None else rows
    dealt = range_dealt(df, [*group, *order], rows, per_part, "ranges")
    key = [*group, "__part"]
    fold = F.sum if how == "sum" else F.bit_xor
    join = (lambda a, b: a + b) if how == "sum" else (lambda a, b: a.bitwiseXOR(b))
    ones = {out: F.lit(1).cast("long") if c is None else F.col(c) for out, c in values.items()}
    sums = dealt.groupBy(*key).agg(*[fold(v).alias(f"__s_{out}") for out, v in ones.items()])
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = sums.select(*[F.col(c).alias(f"__k_{c}") for c in key],
                         *[F.coalesce(fold(f"__s_{out}").over(before), zero).alias(f"__b_{out}") for out in values],
                         *([fold(f"__s_{next(iter(values))}").over(whole).alias(f"__t_{total}")] if total else []))
    if not total:  # only a group that goes on over a range's edge has a start
        some = F.lit(False)
        for out in values:
            some = some | (F.col(f"__b_{out}") != 0)
        starts = starts.where(some)
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumns({f"__r_{out}": F.coalesce(fold(v).over(inside), zero) for out, v in ones.items()})
    cond = F.lit(True)
    for c in key:
        cond = cond & ranked[c].eqNullSafe(starts[f"__k_{c}"])
    out = ranked.join(starts, cond, "left").withColumns({o: join(F.col(f"__r_{o}"), F.coalesce(F.col(f"__b_{o}"), zero)) for o in values})
    if total:
        out = out.withColumn(total, F.col(f"__t_{total}"))
    return out.select(*[c for c in df.columns if c not in values], *values, *([total] if total else []))
