"""Helpers shared by the operators: written intermediate tables, groups from sorted batches, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import work_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: cuts lineage and outlives executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key() -> list:
    """128 bits that name a text: two hashes with different seeds."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2")]


def give_back() -> None:
    """Returns freed memory of a Python worker, which serves many tasks, to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, which gives its memory back when its task ends: the worker
    stays for other tasks, and while tasks of the JVM use the executor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the rows of an Arrow batch to ``rows`` for the session, if it has more. A batch of whole texts is held
    by the task, by the thread that feeds its worker and by the worker, and what held it is seldom given back.
    Results don't depend on it: texts are scored 1000 at a time in any case."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def set_aside(docs: DataFrame, *core: str) -> DataFrame:
    """Only the ``core`` columns, and all others as one struct that no operator's names can clash with."""
    others = [F.col(c) for c in docs.columns if c not in core]
    return docs.select(*[c for c in docs.columns if c in core], F.struct(*others, F.lit(0).alias("__")).alias("__others"))


def brought_back(df: DataFrame, columns: list[str], *core: str) -> DataFrame:
    """The ``columns`` again, after ``set_aside``."""
    return df.select(*[F.col(c) if c in core else F.col("__others")[c].alias(c) for c in columns])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows from batches that are sorted by ``keys``; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols))
        start = 0
        for i, key in enumerate(rows):
            if key != now:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield now, pa.Table.from_batches(held)
                held, start, now = [], i, key
        held.append(batch.slice(start))
    if held:
        yield now, pa.Table.from_batches(held)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each node of the undirected edges can reach.

    Every node takes the smallest label among its neighbours and then the label of that
    label, until nothing changes; paths halve each round. Each round is written to the
    shared folder. A node with a large share of the edges is the hot side of a join that
    adaptive execution can split, and the minimum is taken map-side first.
    """
    one = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b")
    both = saved(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "c"), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("m"))
        new = labels.join(near, "id").select("id", "c", F.least("c", "m").alias("n"))
        over = labels.select(F.col("id").alias("n"), F.col("c").alias("up"))
        new = saved(new.join(over, "n").select("id", F.least("n", "up").alias("c"), (F.least("n", "up") != F.col("c")).alias("moved")), "labels")
        if new.where("moved").isEmpty():
            return new.select("id", F.col("c").alias("component"))
        labels = new.select("id", "c")
