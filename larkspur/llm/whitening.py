"""Whitening of embeddings with Spark MLlib's BlockMatrix: scatter, eigenvectors, projection."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import saved
from larkspur.operators.joins import sliced_join

OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def finite(v: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & fine, F.lit(False))


def whole(v: Column, scale: int = 256) -> Column:
    """Components as whole numbers, rounded down."""
    return F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` written with ``index`` 0, 1, ... without a gap: places inside the written partitions plus
    the lengths of the partitions before, of which there are as many as partitions."""
    rows = saved(rows.withColumn("at", F.monotonically_increasing_id()), "whitening-rows")
    rows = rows.withColumns({"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND((1 << 33) - 1)})
    before = F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ends = rows.groupBy("part").agg(F.count("*").alias("m")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(ends), "part").withColumn("index", F.col("before") + F.col("place")).drop("part", "before", "at", "place")


def _times(a: BlockMatrix, b: BlockMatrix, middle: int) -> BlockMatrix:
    """a x b with the summed dimension dealt over ``middle`` tasks; by default all blocks
    of a small result would meet in one task. The Python class lacks this argument."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, middle)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def _blocks(spark, w: np.ndarray, rows_each: int) -> BlockMatrix:
    """A small local matrix as a block column."""
    cut = [((i, 0), w[at : at + rows_each]) for i, at in enumerate(range(0, len(w), rows_each))]
    parts = [(key, DenseMatrix(*p.shape, p.ravel(order="F"))) for key, p in cut]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows_each, w.shape[1], len(w), w.shape[1])


def whiten(vectors: DataFrame, top: int = 4, scale: int = 256, rows_each: int = 1024, blocks_each: int = 64) -> DataFrame:
    """One row per row of (vec_id, embedding) and component: ``vec_id``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Components become whole numbers x = floor(scale * c). The distinct x vectors are the fit list: centred on their
    exact mean, indexed and dealt into blocks of ``rows_each`` rows; the transposed matrix times the matrix gives the
    scatter, summed over ``blocks_each`` blocks a task, of which the driver holds dimension squared numbers. Its
    eigenvectors over the root of their eigenvalues are the whitening matrix, and a second block multiplication
    projects the list. Rows take the result of their x vector; a vector in very many rows is dealt over slices.

    Rows with a null or empty vector, or one with null or non-finite components, are left out, and so are vectors of another
    length than the most frequent one (ties: the longer). Repeated rows and rows without vec_id are rows like others.
    Components whose eigenvalue is not above rounding error cannot be scaled and are not returned: a table
    of equal vectors, and an empty one, give no rows. Other columns are ignored. Sums beyond 64 bits raise.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(finite(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], f"vec_id long, {OUT}")
    if common is None:
        return empty
    d = common["d"]
    rows = rows.where(F.size("v") == d).select("vec_id", whole(F.col("v"), scale).alias("x"))
    fit = indexed(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"))
    about = fit.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    n, sums = about["n"], list(about)[1:]
    mean = F.array(*[F.lit(s / n) for s in sums])
    centred = fit.select("index", array_to_vector(F.zip_with(F.transform("x", lambda x: x.cast("double")), mean, lambda x, m: x - m)).alias("vector"))
    cols = min(d, rows_each)
    a = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, d).toBlockMatrix(rows_each, cols)
    a.persist(StorageLevel.MEMORY_AND_DISK)  # read three times; a lost block is made again
    middle = -(-n // (rows_each * blocks_each))
    scatter = _times(a.transpose(), a, middle).toLocalMatrix().toArray()
    v = (scatter + scatter.T) / (2 * n)
    values, parts = np.linalg.eigh(v)
    order = [i for i in np.argsort(values)[::-1][:top] if values[i] > d * np.finfo(float).eps * max(values[-1], 0)]
    if not order:
        return empty
    project = parts[:, order] / np.sqrt(values[order])
    share = values[order] / np.trace(v)
    made = a.multiply(_blocks(spark, project, cols)).blocks

    def lines(block):
        (i, _), m = block
        return [(i * rows_each + k, row) for k, row in enumerate(m.toArray().tolist())]

    white = saved(spark.createDataFrame(made.flatMap(lines), "index long, w array<double>"), "whitened")
    a._java_matrix_wrapper._java_model.blocks().unpersist(False)
    pairs = [(i, j) for i in range(len(order)) for j in range(i + 1)]
    cov = white.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    deviation = F.aggregate(F.zip_with("x", total, lambda x, s: F.lit(n) * x - s), F.lit(0).cast("long"), lambda t, y: t + y * y)
    key = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), F.col("x")).alias("h2")]
    known = fit.select("index", *key, deviation.alias("deviation")).join(white, "index").drop("index")
    out = sliced_join(rows.select("vec_id", *key), known, ["h1", "h2"], F.xxhash64("vec_id", F.monotonically_increasing_id()))
    told = [F.struct(F.lit(k + 1).alias("component"), F.col("w")[k].alias("whitened"), F.lit(float(share[k])).alias("explained")) for k in range(len(order))]
    out = out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.explode(F.array(*told)).alias("c"), F.lit(float(error)).alias("identity_error"))
    return out.select("vec_id", "c.component", "n", "deviation", "c.whitened", "c.explained", "identity_error")
