"""Near-duplicate vectors by sorted projection passes.

Each pass hashes a vector to the signs of random projections, concatenated, and orders all vectors of
a label by that key.  Vectors close in angle share long beginnings, so each is compared with a window
of neighbours only.  The order is laid out over blocks by global rank, with the window's overlap, so
one hot key or label never fills one task.  Verified pairs of all passes are united to components.

The longer the order, the more leading bits a pair has to share to stand in one window, so each label
has as many passes as keep the chance to miss an isolated pair at the threshold under ``MISS``.

Windows are bounded, and a dense cluster has more links than windows hold.  So links are counted in a
second step, exactly within each component: its members are compared in chunks.  Members within half
the threshold's angle of the component's pivot are linked to each other without being compared, which
keeps a large tight cluster linear.

Defined results: vectors that are null, empty, zero, or hold null or non-finite entries, and vectors
without a label, link with nothing; vectors of different lengths are never linked; equal vectors of
one label are compared once, and each repeated row counts as a vector; null ids are never the
smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treadle.llm.components import components
from treadle.llm.jaccard import few
from treadle.session import run_folder

#: Least passes, bits per key, neighbours compared, rows of a block, members of a chunk.
PASSES, BITS, WINDOW, BLOCK, CHUNK = 12, 48, 64, 4096, 2048
#: Chance that no pass finds a pair at the threshold that only it links, for evenly spread keys.
MISS = 1e-4
SEED = 20_26


def projections(dimensions: int, number: int, bits: int = BITS) -> np.ndarray:
    """The random directions of one pass; the same on every machine."""
    return np.random.default_rng((SEED, dimensions, number)).standard_normal((dimensions, bits))


def _unit(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimensions)
    return x / np.linalg.norm(x, axis=1)[:, None]


def prepared(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``row``, ``id``, ``label``, ``vector`` and ``content`` (hash of its numbers; null: links with nothing)."""
    kind = vectors.schema[vector_column].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats stay as wide as they are until compared
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                          F.col(label_column).cast("string").alias("label"), F.col(vector_column).cast(kind).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for label, v in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist()):
                ok = label is not None and bool(v) and None not in v and all(map(math.isfinite, v))
                if ok:
                    x = np.array(v) + 0.0
                    norm = np.linalg.norm(x)
                    ok = norm > 0 and math.isfinite(norm)
                found.append(hashlib.md5(x.tobytes()).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())],
                                             names=[*batch.schema.names, "content"])
    return rows.mapInArrow(run, f"row long, id long, label string, vector {kind}, content binary")


def passes_for(bits: int, threshold: float, miss: float) -> int:
    """Passes after which a pair at the threshold has missed ``bits`` equal leading bits in all with chance ``miss``."""
    found = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if found >= 1 else math.ceil(math.log(miss) / math.log1p(-found))


def with_passes(distinct: DataFrame, threshold: float, passes: int, window: int, miss: float) -> DataFrame:
    """``distinct`` with the ``passes`` of its label and length: ``passes``, and more where the order is long.

    A window holds the vectors that share log2(n / window) leading bits.
    """
    needed = F.array(*[F.lit(passes_for(bits, threshold, miss)) for bits in range(BITS + 1)])
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / window)), F.lit(0)), F.lit(BITS)).cast("int")
    large = distinct.groupBy("label", F.size("vector").alias("size")).agg(F.count("*").alias("n")).select(
        "label", "size", F.get(needed, bits).alias("more")).where(F.col("more") > passes)
    return distinct.withColumn("size", F.size("vector")).join(few(large), ["label", "size"], "left").select(
        "node", "label", "vector", F.coalesce("more", F.lit(passes)).alias("passes"))


def keys(distinct: DataFrame) -> DataFrame:
    """``distinct`` (node, label, vector, passes) once per pass, with the pass's ``key``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column("vector")))
            for d in np.unique(sizes):
                own = batch.filter(pa.array(sizes == d))
                x = _unit(own.column("vector"), int(d))
                powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
                passes = own.column("passes").to_numpy()
                for p in range(passes.max()):
                    if (ends := passes <= p).any():
                        own, x, passes = own.filter(pa.array(~ends)), x[~ends], passes[~ends]
                    key = ((x @ projections(int(d), p)) > 0) @ powers
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), p, np.int32)), own.column("label"), pa.array(np.full(len(key), d, np.int32)),
                         pa.array(key.astype(np.int64)), own.column("node"), own.column("vector")],
                        names=["pass", "label", "size", "key", "node", "vector"])
    kind = distinct.schema["vector"].dataType.simpleString()
    return distinct.select("node", "label", "vector", "passes").mapInArrow(
        run, f"pass int, label string, size int, key long, node long, vector {kind}")


def ranked(spark: SparkSession, keyed: DataFrame) -> DataFrame:
    """``keyed`` with its global ``rank`` in the order of pass, label, size and key.

    The sorted parts are stored with each row's place in its part; a row per part gives the offsets.
    """
    order = ["pass", "label", "size", "key", "node"]
    folder = run_folder(spark, "sorted")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder).withColumn("part", F.shiftright("place", 33))
    # one row per sorted part
    offsets = stored.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("offset"))
    return stored.join(offsets, "part").withColumn(
        "rank", F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "offset", "place")


def _roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place each place is linked to, directly or not."""
    root = np.arange(n)

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k
    for a, b in links:
        open_ = root[a] != root[b]
        for i, j in zip(a[open_].tolist(), b[open_].tolist()):
            i, j = find(i), find(j)
            if i != j:
                root[max(i, j)] = min(i, j)
    return np.array([find(k) for k in range(n)], dtype=np.int64)


def window_links(order: DataFrame, threshold: float, window: int, block: int) -> DataFrame:
    """Verified links of each block, reduced to one per node that is not its group's least: a, b."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rank")
        sizes = table.column("size").to_numpy()
        x = np.zeros((len(sizes), sizes.max()))
        vectors = table.column("vector").combine_chunks()
        for d in np.unique(sizes):
            own = sizes == d
            x[own, :d] = _unit(vectors.filter(pa.array(own)), int(d))
        numbers = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("pass", "label", "size")]
        node = table.column("node").to_numpy()

        def links():
            for o in range(1, min(window, len(node) - 1) + 1):
                near = np.logical_and.reduce([k[o:] == k[:-o] for k in numbers])
                near &= np.einsum("ij,ij->i", x[o:], x[:-o]) >= threshold
                a = np.flatnonzero(near)
                yield a, a + o
        root = node[_roots(len(node), links())]
        linked = root != node
        return pa.table({"a": node[linked], "b": root[linked]})

    own = F.floor(F.col("rank") / block)
    before = F.when((F.col("rank") % block < window) & (own > 0), own - 1)
    return order.withColumn("block", F.explode(F.array_compact(F.array(own, before)))).groupBy("block").applyInArrow(
        lambda table: run(table), "a long, b long")


def _chunked(n: Column, chunk: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / chunk)).cast("int")


def count_links(spark: SparkSession, members: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """``node`` and ``weight``: the vectors linked to it within its component, itself included.

    members: node, root, weight (equal vectors), vector, with at least two nodes to a root.  A component is
    one cell if it fits a chunk.  Else each chunk of its shell (outside half the threshold's angle of the
    pivot) meets each of its chunks; its core is counted without comparing.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    wide = members.join(sizes, "root")
    small = wide.where(F.col("n") <= chunk).select("root", F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(True).alias("asks"),
                                                   F.lit(True).alias("answers"), "node", "weight", "vector")
    large = wide.where(F.col("n") > chunk)
    pivots = large.where(F.col("node") == F.col("root")).select("root", F.col("vector").alias("pivot"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                                   F.lit(0.0), lambda s, v: s + v)
    cosine = dot("vector", "pivot") / F.sqrt(dot("vector", "vector") * dot("pivot", "pivot"))
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    placed = large.join(pivots, "root").withColumn("core", cosine >= half).drop("pivot")
    folder = run_folder(spark, "members")
    placed.write.parquet(folder)
    placed = spark.read.parquet(folder)
    totals = placed.groupBy("root").agg(F.count(F.when(~F.col("core"), 1)).alias("shell"),
                                        F.sum(F.when(F.col("core"), F.col("weight"))).alias("core_weight"))
    placed = placed.join(totals, "root").withColumn("all_chunks", _chunked(F.col("n"), chunk)).withColumn(
        "shell_chunks", _chunked(F.col("shell"), chunk)).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("all_chunks")).cast("int")).withColumn(
        "own_shell", F.pmod(F.xxhash64("node"), F.col("shell_chunks")).cast("int"))
    among_core = placed.where("core").select("node", F.col("core_weight").alias("weight"))
    asking = placed.where(~F.col("core")).select(
        "root", F.col("own_shell").alias("left"), F.explode(F.expr("sequence(0, all_chunks - 1)")).alias("right"),
        F.lit(True).alias("asks"), F.lit(False).alias("answers"), "node", "weight", "vector")
    answering = placed.where("shell > 0").select(
        "root", F.explode(F.expr("sequence(0, shell_chunks - 1)")).alias("left"), F.col("own").alias("right"),
        F.lit(False).alias("asks"), F.lit(True).alias("answers"), "node", "weight", "vector", "core")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = table.column("vector").combine_chunks()
        x = _unit(vectors, len(vectors[0])) if len(table) else np.zeros((0, 1))
        asks, answers = (table.column(c).to_numpy() for c in ("asks", "answers"))
        core = table.column("core").to_numpy(zero_copy_only=False)
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        near = x[asks] @ x[answers].T >= threshold
        same = node[asks][:, None] == node[answers][None, :]
        near |= same
        nodes, sums = [node[asks]], [near @ weight[answers]]
        if core.any():  # a core vector has its links to the shell from here
            back = core[answers]
            nodes.append(node[answers][back])
            sums.append(weight[asks] @ near[:, back])
        return pa.table({"node": np.concatenate(nodes), "weight": np.concatenate(sums).astype(np.int64)})

    cells = small.withColumn("core", F.lit(False)).unionByName(asking.withColumn("core", F.lit(False))).unionByName(answering)
    counted = cells.groupBy("root", "left", "right").applyInArrow(lambda table: run(table), "node long, weight long")
    return counted.unionByName(among_core).groupBy("node").agg(F.sum("weight").alias("weight"))


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.93, passes: int = PASSES,
                    window: int = WINDOW, block: int = BLOCK, chunk: int = CHUNK, id_column: str = "vec_id",
                    vector_column: str = "embedding", label_column: str = "label", miss: float = MISS) -> DataFrame:
    """One row per input row: ``id``, ``n_links``, ``component_id`` (least id), ``kept``.

    ``passes`` is the least number; labels of many vectors have as many as ``miss`` needs.
    """
    folder = run_folder(spark, "vectors")
    prepared(vectors, id_column, vector_column, label_column).write.parquet(folder)
    rows = spark.read.parquet(folder)
    valid = rows.where(F.col("content").isNotNull())
    classes = valid.groupBy("label", "content").agg(F.min("row").alias("node"), F.count("*").alias("weight"))
    distinct = valid.select("row", "label", "vector").join(
        classes.select(F.col("node").alias("row"), "weight"), "row").withColumnRenamed("row", "node")
    distinct_folder = run_folder(spark, "distinct")
    distinct.write.parquet(distinct_folder)
    distinct = spark.read.parquet(distinct_folder)
    links = window_links(ranked(spark, keys(with_passes(distinct, threshold, passes, window, miss))), threshold, window, block)
    found = components(spark, links)
    roots = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    counted = count_links(spark, distinct.join(roots, "node"), threshold, chunk)
    nodes = _nodes(classes, roots, counted)
    placed = rows.select("row", "id", "label", "content").join(nodes, ["label", "content"], "left")
    least = placed.groupBy("root").agg(F.min("id").alias("least")).where("root is not null")
    return placed.join(least, "root", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("least", "id"), F.lit(False)).alias("kept"))


def _nodes(classes: DataFrame, roots: DataFrame, counted: DataFrame) -> DataFrame:
    """A row per class of equal vectors: its root and the vectors linked to each of its members."""
    return classes.join(roots, "node", "left").join(counted.withColumnRenamed("weight", "linked"), "node", "left").select(
        "label", "content", F.coalesce("root", "node").alias("root"), (F.coalesce("linked", "weight") - 1).alias("n_links"))


def oracle() -> str:
    """All pairs and their components in DuckDB SQL."""
    return """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select vec_id a, vec_id b from embeddings union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a vec_id, min(b) component_id from reach group by a),
n as (select a vec_id, count(*) n_links from l group by a)
select vec_id, coalesce(n_links, 0) n_links, component_id, vec_id = component_id kept
from c left join n using (vec_id)"""
