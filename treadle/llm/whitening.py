"""Whitening of embeddings by distributed block matrices.

Vectors are centred, given consecutive row numbers and cut into blocks of rows (MLlib's
``BlockMatrix``).  The transposed matrix times the matrix is the scatter, summed in as many parts as
there are tasks; only that, a square of the vectors' width, comes to the driver, where its eigenvectors
are found.  The matrix times the whitening matrix gives the projected rows.

Row numbers come from the written rows: the place in its partition and the row counts of the partitions
before it, so a task that runs again gives the same numbers.

Defined results: a null vector, an empty one, one with a null or non-finite entry, or one whose length is
not the most frequent (of equally frequent ones the largest) has no rows in the result; repeated rows and
null ids stay, each with results of its own; a component without variance has null in ``whitened`` and is
left out of ``identity_error``; an empty table, or one without a usable vector, gives no rows; other
columns of the table are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.session import run_folder

#: Bytes of a block of rows, and the most columns of a block.
BLOCK_BYTES, BLOCK_COLUMNS = 1 << 20, 1024
#: Whole numbers up to here are exact as doubles; scaled entries beyond it count as the bound itself.
EXACT = 2 ** 53


def usable(rows: DataFrame, vector_column: str) -> Column:
    """Whether a vector has entries and all of them are finite numbers."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    v = F.col(vector_column)
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(entry(c), F.lit(False))), F.lit(False))


def steps(vector: Column, scale: int, shift: int) -> Column:
    """Entries as whole numbers: ``floor(scale * entry) + shift``."""
    bound = float(EXACT)
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(
        c.cast("double") * float(scale), F.lit(-bound)), F.lit(bound))).cast("long") + F.lit(shift).cast("long"))


@dataclass(frozen=True)
class Numbered:
    """Stored rows ``index``, ``id``, ``x`` (array of long) with their count and sums by dimension."""
    rows: DataFrame
    n: int
    sums: list[int]
    least: list[int]
    largest: list[int]

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self) -> Column:
        means = F.array(*[F.lit(float(Fraction(s, self.n))) for s in self.sums])
        return F.zip_with("x", means, lambda a, m: a.cast("double") - m)

    def deviation(self) -> Column:
        """Sum of ``(n * x - sum)^2``, exact; null where it does not fit a long."""
        far = max(max(self.n * b - s, s - self.n * a) for s, a, b in zip(self.sums, self.least, self.largest))
        kind = "bigint" if far * far * self.width < 1 << 63 else "decimal(38,0)"
        sums = ", ".join(f"cast('{s}' as {kind})" for s in self.sums)
        if kind == "bigint":
            return F.expr(f"aggregate(transform(zip_with(x, array({sums}), (a, s) -> {self.n} * a - s), d -> d * d),"
                          " 0L, (t, d) -> t + d)")
        return F.expr(f"""try_cast(aggregate(transform(zip_with(x, array({sums}),
            (a, s) -> cast(try_subtract(try_multiply(cast({self.n} as decimal(38,0)), cast(a as decimal(38,0))), s) as decimal(38,0))),
            d -> cast(try_multiply(d, d) as decimal(38,0))), cast(0 as decimal(38,0)),
            (t, d) -> cast(try_add(t, d) as decimal(38,0))) as bigint)""")


def numbered(spark: SparkSession, rows: DataFrame) -> Numbered | None:
    """Store ``id`` and ``x``, number the rows and sum their dimensions; None without rows."""
    width = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if width is None:
        return None
    folder = run_folder(spark, "whitening-rows")
    rows.where(F.size("x") == width.width).select("id", "x", F.spark_partition_id().alias("part"),
                                                  F.monotonically_increasing_id().alias("at")).write.parquet(folder)
    stored = spark.read.parquet(folder)
    # one row per partition of the write
    starts, n = [], 0
    for r in stored.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy("part").collect():
        starts.append((r.part, n - r.first))
        n += r.n
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    own = stored.join(starts, "part").select((F.col("at") + F.col("start")).alias("index"), "id", "x")
    dims = range(width.width)
    got = stored.agg(*[F.sum(F.col("x")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in dims],
                     *[F.min(F.col("x")[k]).alias(f"a{k}") for k in dims],
                     *[F.max(F.col("x")[k]).alias(f"b{k}") for k in dims]).first()
    return Numbered(own, n, [int(got[f"s{k}"]) for k in dims], [got[f"a{k}"] for k in dims], [got[f"b{k}"] for k in dims])


def block_matrix(rows: DataFrame, n: int, width: int, per_block: int) -> BlockMatrix:
    """Rows ``index`` and ``v`` (array of double) as a matrix of blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(per_block, min(width, BLOCK_COLUMNS))


def product(spark: SparkSession, left: BlockMatrix, right: BlockMatrix) -> BlockMatrix:
    """The product; what both share is cut into parts, as a single task would add up all blocks else."""
    shared = left.numColBlocks
    parts = max(1, min(shared, max(4 * spark.sparkContext.defaultParallelism, shared // 64)))
    wrapped = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(wrapped, left.rowsPerBlock, right.colsPerBlock)


def components_of(scatter: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Variances and unit directions (columns) of the largest components, and the total variance."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs, float(np.trace(covariance))


def whiten(spark: SparkSession, rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
           count: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``
    of each usable vector and each of its ``count`` largest components."""
    found = numbered(spark, rows.where(usable(rows, vector_column)).select(
        F.col(id_column).alias("id"), steps(F.col(vector_column), scale, shift).alias("x")))
    if found is None:
        kind = rows.schema[id_column].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    per_block = max(64, BLOCK_BYTES // (8 * min(found.width, BLOCK_COLUMNS)))
    centred = block_matrix(found.rows.select("index", found.centred().alias("v")), found.n, found.width, per_block)
    scatter = product(spark, centred.transpose(), centred).toLocalMatrix().toArray()  # width x width
    values, directions, total = components_of(scatter, found.n, min(count, found.width))
    varied = values > found.width * np.finfo(float).eps * max(values[0], 0)
    whitening = directions / np.sqrt(np.where(varied, values, 1.0))

    side = spark.createDataFrame([(k, Vectors.dense(w)) for k, w in enumerate(whitening)], ["index", "v"])
    side = block_matrix(side.select("index", vector_to_array("v").alias("v")), found.width, len(values), min(found.width, BLOCK_COLUMNS))
    projected = callMLlibFunc("getIndexedRows", product(spark, centred, side).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    folder = run_folder(spark, "whitening-projected")
    projected.select("index", vector_to_array("vector").alias("w")).write.parquet(folder)
    projected = spark.read.parquet(folder)

    own = [k for k in range(len(values)) if varied[k]]
    pairs = [(a, b) for a in own for b in own if a <= b]
    error = 0.0
    if pairs:
        got = projected.agg(*[F.covar_pop(F.col("w")[a], F.col("w")[b]) for a, b in pairs]).first()
        error = max(abs(c - (a == b)) for c, (a, b) in zip(got, pairs))
    each = F.array(*[F.struct(F.lit(k + 1).alias("component"),
                              (F.col("w")[k] if varied[k] else F.lit(None).cast("double")).alias("whitened"),
                              F.lit(float(max(values[k], 0.0) / total) if total > 0 else 0.0).alias("explained"))
                     for k in range(len(values))])
    return found.rows.select("index", "id", found.deviation().alias("deviation")).join(projected, "index").select(
        "id", "deviation", F.inline(each)).select(
        "id", "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(float(error)).alias("identity_error"))
