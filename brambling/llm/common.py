"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brambling.operators.joins import join_small, measure
from brambling.session import store


#: Texts go to Python in batches of so many bytes, where the session does not say otherwise.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; the queries' way to it, so it also bounds what a worker holds of a batch."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(key: str | Column, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts``; a null id is in fold 0."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % parts, F.lit(0))


def key_of(column: str | Column) -> Column:
    """A text that is equal for equal values, nulls included, and never null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the 0-based rank of each row under ``order``, without one task that sorts all.

    Rows are dealt out by range and stored; a task numbers its own range, and what the ranges
    before it hold (one number per partition) is added.
    """
    dealt = store(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition: a bounded table.
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = dealt.join(F.broadcast(offsets), "_part").withColumn(name, own + F.col("_before"))
    return numbered.drop("_part", "_before")


def join_measured(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Inner join on a key; ``small`` is broadcast only if its measured size is within the bound."""
    return join_small(large, small, on, measure(small)[1])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows whose texts, as UTF-8, have about ``most`` bytes together, so that work arrays stay small.

    A single longer text is a run of its own; a null is the empty text. Only the texts of the run at
    hand become Python objects. At the end of the task, memory that Arrow has freed goes back to the
    system: a worker process outlives its tasks, and later stages would have it besides their own.
    """
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)))
        first = 0
        while first < len(texts):
            base = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(first, last - first), [x or b"" for x in texts.slice(first, last - first).to_pylist()]
            first = last
    pa.default_memory_pool().release_unused()


def batch_of(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


HOT_SHARE = 1024


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key and the number of its rows.

    Keys with more than 1/1024 of all ``total`` rows are at most 1024; their entries are broadcast
    and their rows stay where they are. All others meet in a shuffle, none of them large.
    """
    hot = table.where(F.col(count) * HOT_SHARE > total)
    cold = table.where(F.col(count) * HOT_SHARE <= total)
    here = rows.join(F.broadcast(hot.drop(count)), keys)
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return here.unionByName(rest.join(cold.drop(count), keys))


def sorted_runs(batches: Iterator[dict[str, np.ndarray]], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """From chunks of a stream sorted by ``keys``, the rows of each key together."""
    held: dict[str, np.ndarray] | None = None
    for chunk in batches:
        if held is not None:
            chunk = {k: np.concatenate([held[k], v]) for k, v in chunk.items()}
        n = len(chunk[keys[0]])
        if not n:
            continue
        change = np.zeros(n, bool)
        for key in keys:
            change[1:] |= chunk[key][1:] != chunk[key][:-1]
        starts = np.concatenate([[0], np.flatnonzero(change)])
        for a, b in zip(starts[:-1], starts[1:]):
            yield {k: v[a:b] for k, v in chunk.items()}
        held = {k: v[starts[-1] :] for k, v in chunk.items()}
    if held is not None:
        yield held


def star(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For ``n`` nodes and pairs of them, the smallest node that each is connected with."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low < high).any():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root
