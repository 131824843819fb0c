"""Exact n-gram Jaccard join by universe partitions and the pigeonhole principle.

A document is its set of hashed shingles.  Sizes fall into overlapping windows so that any two sets
similar enough share the window in which the smaller lies in the first part; there, at most ``H``
shingles tell them apart.  The universe of hashes is cut into segments, each with an allowance of 1
(the subsets have to be equal) or 2 (they may differ by one shingle, found by the subset itself and
its one-deletion neighbours).  Allowances add up to ``H + 1 + slack``, so similar sets agree on
segments worth at least ``slack + 1``.  A cost model picks the allowances per window: an allowance of 2
gives wider segments, with fewer chance agreements and four times the index entries.  How often sets agree
by chance is measured on a sample of a large table; it decides on volume alone, as any allowances are exact.
The index is shuffled a slice of its keys at a time and goes when its contested entries are stored.

Agreements on empty segments say nothing and are not indexed; a set with fewer non-empty segments
than its window counts on is indexed under the window's common entry.  An entry that one set alone
has is contested by nobody; a set whose contested segments are worth too little has no partner.  The
others form families over shared entries, and within a family sets are compared exactly: in cells
of bounded chunks, so a large family is many cells, not one task.

Defined results: words are split at ASCII white space after ASCII letters are lower-cased; texts with
fewer words than a shingle have their whole sequence as the only one; null texts and texts without words
have no shingles and link with nothing; equal sets are indexed once per task; repeated rows belong
to one component; null ids are never the smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from treadle.llm.components import components
from treadle.operators.sinks import drop_folder
from treadle.session import run_folder

#: Documents in a chunk of a family; growth of the windows.
CHUNK, GROWTH = 256, 1.25
#: Rows of a few numbers that may be broadcast (some 20 MB).
BROADCAST_ROWS = 200_000
#: Chance that two shingles that stand alone in a segment are equal, for the cost model: the most it takes it to be.
CHANCE = 1e-4
#: Texts (expected) that it is measured on, in tables of four times as many.
SAMPLE = 20_000
#: Parts of the index that are shuffled one after the other.
SLICES = 4
#: Sets a task remembers to index equal ones once.
REMEMBERED = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A second hash of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < size:
        return np.array([xxh64_intdigest(b" ".join(words), len(words) + 1)] if words else [], dtype=np.uint64)
    own = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    n = len(own) - size + 1
    total = own[:n].copy()
    for k in range(1, size):
        total = mixed(total * MIX + own[k:k + n])
    return np.unique(mixed(total))


@dataclass(frozen=True)
class Layout:
    """How one window of sizes is indexed."""
    number: int
    least: int
    most: int
    slack: int
    #: Allowance of each segment, and the first hash of each but the first.
    allowances: np.ndarray
    borders: np.ndarray


def allocate(least: int, differing: int, documents: int) -> tuple[int, int, int]:
    """(segments of allowance 2, of allowance 1, slack) of lowest expected cost per set.

    Cost: index entries, and sets met by chance.  Slack makes up for segments expected empty, or for
    those of allowance 2, with one shingle at most.
    """
    best = None
    most = (differing + 1) // 2
    for two in sorted({most * k // 4 for k in range(5)}):
        slack = 1
        for _ in range(12):
            total = max(differing + 1 + slack, 2 * two)
            width = least / total
            weak = (total - 2 * two) * math.exp(-width) + 2 * two * math.exp(-2 * width) * (1 + 2 * width)
            slack, before = 1 + math.ceil(1.5 * weak), slack
            if slack == before or slack > differing + 4:
                break
        total = max(differing + 1 + slack, 2 * two)
        one, width = total - 2 * two, least / total
        met = lambda w: documents * CHANCE * (w * math.exp(-w)) ** 2
        cost = one * (1 + met(width)) + two * (1 + 2 * width) * (1 + met(2 * width))
        if best is None or cost < best[0]:
            best = (cost, two, one, total - differing - 1)
    return best[1:]


@cache
def starts() -> tuple[int, ...]:
    """Where windows begin."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
    return tuple(out)


@cache
def layout(number: int, part: int, whole: int, documents: int) -> Layout | None:
    """Window ``number`` for similarity part / whole; none if its sets can't differ and be similar."""
    least, smaller = starts()[number], starts()[number + 1] - 1
    differing = smaller * (whole - part) // part
    if not differing:
        return None
    two, one, slack = allocate(least, differing, documents)
    allowances = np.array([2] * two + [1] * one)
    ends = np.cumsum(allowances).tolist()
    borders = np.array([(e << 64) // ends[-1] for e in ends[:-1]], dtype=np.uint64)
    return Layout(number, least, smaller * whole // part, slack, allowances, borders)


def windows_of(n: int, part: int, whole: int, documents: int) -> Iterator[Layout]:
    """The windows a set of ``n`` shingles is in."""
    for number in range(bisect_right(starts(), n) - 1, -1, -1):
        if (starts()[number + 1] - 1) * whole // part < n:
            break
        if found := layout(number, part, whole, documents):
            yield found


def entries(found: np.ndarray, windows: Iterator[Layout]) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set, with a tag each: what it counts on << 21 | segment << 2 | worth.

    A segment of allowance 1 has one entry and needs no number, so most tags of a set are the same.
    The only shingle of a segment of allowance 2 is not counted on, but a set with one more counts on
    meeting it.  So it is an entry worth nothing, or enough if the set counts on no segment at all.
    """
    n, keys, tags = len(found), [], []
    value = mixed(found ^ MIX)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    for w in windows:
        edges = np.concatenate([[0], np.searchsorted(found, w.borders), [n]])
        sizes = edges[1:] - edges[:-1]
        strong = sizes >= w.allowances
        counted_on = w.slack + 1 - int(w.allowances[~strong].sum())
        segment = np.flatnonzero(sizes > 0)
        subset = sums[edges[1:]][segment] - sums[edges[:-1]][segment]
        two = strong[segment] & (w.allowances[segment] == 2)
        key, own = [subset], [segment]
        for s, total in zip(segment[two].tolist(), subset[two]):
            key.append(total - value[edges[s]:edges[s + 1]])
            own.append(np.full(sizes[s], s))
        own = np.concatenate(own)
        key = mixed(np.concatenate(key) + own.astype(np.uint64) * MIX)
        worth = np.where(strong[own], w.allowances[own], 0 if counted_on >= 1 else 2)
        if counted_on < 1:  # found through the common entry of such sets
            key, own, counted_on = np.append(key, np.uint64(0)), np.append(own, 0), 1
            worth = np.append(worth, w.allowances[0])
        keys.append((key >> np.uint64(8)) | (np.uint64(w.number) << np.uint64(56)))
        tags.append(counted_on << 21 | np.where(worth == 2, own, 0) << 2 | worth)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(keys).view(np.int64), np.concatenate(tags).astype(np.int32)


def node_of(found: np.ndarray) -> int:
    """The 64-bit name of a set."""
    return int(np.array([xxh64_intdigest(found.tobytes())], np.uint64).view(np.int64)[0])


def indexed(docs: DataFrame, size: int, part: int, whole: int, documents: int, id_column: str, text_column: str) -> DataFrame:
    """One row per document: id, its text's hash, node, n, content (hash of the set), keys and tags by slice of the keys."""
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_key"), F.col(text_column).alias("text"))
    out = StructType.fromDDL(f"id {rows.schema['id'].dataType.simpleString()}, text_key long, node long, n long, content binary, "
                             + ", ".join(f"keys{s} array<long>, tags{s} array<int>" for s in range(SLICES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = to_arrow_schema(out), set()
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                batch = big.slice(at, 2000)
                nodes, sizes, contents, keys, tags, counts = [], [], [], [], [], []
                for text in batch.column("text").to_pylist():
                    found = shingles(text, size)
                    node = node_of(found) if len(found) else None
                    nodes.append(node)
                    sizes.append(len(found))
                    contents.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                    counts.append(0)
                    if node is not None and node not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(node)
                        k, t = entries(found, windows_of(len(found), part, whole, documents))
                        keys.append(k)
                        tags.append(t)
                        counts[-1] = len(k)
                key, tag = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int32), *tags])
                row, lists = np.repeat(np.arange(len(counts)), counts), []
                for s in range(SLICES):
                    own = key % SLICES == s
                    ends = pa.array(np.append(0, np.cumsum(np.bincount(row[own], minlength=len(counts)))), pa.int32())
                    lists += [pa.ListArray.from_arrays(ends, pa.array(a[own])) for a in (key, tag)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(contents, pa.binary()), *lists], names=schema.names)
    return rows.mapInArrow(run, out)


def contested(rows: DataFrame) -> DataFrame:
    """``rows`` (key, node, tag), sorted by key and node, whose key another node of this part has too.

    Parts are ranges of (key, node), so a hot key is spread over parts.  The first node of a part's first and
    last key comes with ``seam``, as the neighbouring part may have the other one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, node, tag, seam):
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(tag), pa.array(np.full(len(key), seam))],
                                              names=["key", "node", "tag", "seam"])
        empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int32))
        held, first = empty, True  # the rows of the last key that may still be alone: its first node's
        open_key = None  # the last key, if it is contested already
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, tag = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns))
            if first:
                own = (key == key[0]) & (node == node[0])
                yield out(key[own], node[own], tag[own], True)
                first = False
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            lengths = np.diff(np.append(starts, len(key)))
            least, most = node[starts], node[starts + lengths - 1]
            several = least != most
            if open_key is not None and key[0] == open_key:
                several[0] = True
            several = np.repeat(several, lengths)
            last = int(starts[-1])
            if several[-1]:
                open_key, held = key[-1], empty
            else:
                open_key, held = None, (key[last:], node[last:], tag[last:])
                several[last:] = False
            if several.any():
                yield out(key[several], node[several], tag[several], False)
            ending = (key[last:], node[last:], tag[last:])
        if not first:
            own = ending[1] == ending[1][0]
            yield out(ending[0][own], ending[1][own], ending[2][own], True)
    return rows.mapInArrow(run, "key long, node long, tag int, seam boolean")


def entries_of(index: DataFrame, part: int) -> DataFrame:
    """One row (key, node, tag) per entry of a slice."""
    return index.where(f"size(keys{part}) > 0").select("node", F.explode(F.arrays_zip(f"keys{part}", f"tags{part}")).alias("e")).select(
        F.col(f"e.keys{part}").alias("key"), "node", F.col(f"e.tags{part}").alias("tag"))


def measured_chance(docs: DataFrame, documents: int, size: int, part: int, whole: int, id_column: str, text_column: str) -> float:
    """The chance that two shingles that stand alone in a segment are equal, from the texts of a sample.

    Sets that agree on a quarter of their segments are left out, as they do so for a likeness.
    """
    some = docs.where(F.pmod(F.xxhash64(F.col(text_column), F.lit(7)), F.lit(max(1, documents // SAMPLE))) == 0)
    index = indexed(some, size, part, whole, 1, id_column, text_column)
    rows = index.select("node", "n", F.explode(F.concat(*[F.col(f"keys{s}") for s in range(SLICES)])).alias("key")).where(
        F.col("key").bitwiseAND(F.lit((1 << 56) - 1)) != 0).distinct()  # without the common entries
    alike = rows.groupBy("key").agg(F.count("*").alias("sets"))
    sets = rows.join(alike, "key").groupBy("node", "n").agg(F.count("*").alias("own"), F.count_if(F.col("sets") > 1).alias("met"))
    by_size = sets.groupBy("n").agg(  # at most a row per text of the sample
        F.count("*").alias("sets"), F.sum(F.when(F.col("met") * 4 < F.col("own"), F.col("met"))).alias("met"),
        F.sum(F.when(F.col("met") * 4 < F.col("own"), F.col("own"))).alias("own")).collect()
    texts, met, expected = sum(r.sets for r in by_size), 0, 0.0
    for r in by_size:
        alone = [(w.least / w.allowances.sum(), len(w.allowances)) for w in windows_of(r.n, part, whole, 1)]
        segments = sum(k for _, k in alone)
        met += r.met or 0
        expected += texts * (r.own or 0) * sum(k * (w * math.exp(-w)) ** 2 for w, k in alone) / max(1, segments)
    return min(CHANCE, met / expected) if expected else CHANCE


def candidates(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Links a, b between sets that may be similar: each to the least node of an entry they share."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = [run_folder(spark, "entries") for _ in range(SLICES)]
    for s, folder in enumerate(folders):  # one after the other: the shuffle of each goes with its job
        rows = entries_of(index, s).repartitionByRange(parts, "key", "node")
        contested(rows.sortWithinPartitions("key", "node")).write.parquet(folder)
    marked = spark.read.parquet(*folders)
    # a few rows per part: the seams whose key has two nodes after all
    seams = marked.where("seam").groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    found = marked.where("not seam").drop("seam").unionByName(
        marked.where("seam").join(seams.select("key"), "key").drop("seam")).distinct()
    found, folders = _stored(spark, found, folders)
    window = F.shiftrightunsigned("key", 56)
    for _ in range(2):  # sets that drop out may leave others alone
        # a segment counts once: one of allowance 2 by its number, the others by their only entry
        allowance = F.col("tag").bitwiseAND(F.lit(3))
        worth = found.select("node", window.alias("window"), "tag", F.when(allowance == 1, F.col("key")).alias("own")).distinct().groupBy(
            "node", "window", F.shiftright("tag", 21).alias("counts_on")).agg(F.sum(allowance).alias("worth"))
        kept = worth.where("worth >= counts_on").select("node", F.col("window").alias("w"))
        found, folders = _stored(spark, found.withColumn("w", window).join(kept, ["node", "w"], "left_semi").drop("w"), folders)
        several = found.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
        found, folders = _stored(spark, found.join(several.select("key", "low"), "key"), folders)
        links = found.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
        found = found.drop("low")
    return _stored(spark, links, folders)[0]


def _stored(spark: SparkSession, rows: DataFrame, used: list[str]) -> tuple[DataFrame, list[str]]:
    """Stored rows and their folder; the folders they were made from go."""
    folder = run_folder(spark, "found")
    rows.write.parquet(folder)
    for old in used:
        drop_folder(spark, old)
    return spark.read.schema(rows.schema).parquet(folder), [folder]


def linked_sets(table: pa.Table, size: int, part: int, whole: int) -> pa.Table:
    """Links of one cell: (node, root) of sets that are exactly similar enough, one per set and cell."""
    left, right, seen = [], [], set()
    for node, text, is_left, is_right in zip(*(table.column(c).to_pylist() for c in ("node", "text", "left_side", "right_side"))):
        found = shingles(text, size)
        if node in seen or not len(found) or node_of(found) != node:
            continue
        seen.add(node)
        (left if is_left else right).append((node, found, is_right))
    everything = left + right
    # sets on both sides (a cell on the diagonal) meet each other; else left meets right
    diagonal = all(both for *_, both in left)
    if not left or len(everything) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    sizes = np.array([len(f) for _, f, _ in everything])
    owner = np.repeat(np.arange(len(everything)), sizes)
    _, term, times = np.unique(np.concatenate([f for _, f, _ in everything]), return_inverse=True, return_counts=True)
    shared = times[term] > 1
    owner, (_, term) = owner[shared], np.unique(term[shared], return_inverse=True)
    order = np.argsort(term, kind="stable")
    owner, term = owner[order], term[order]
    common = np.zeros((len(everything), len(everything)), dtype=np.float64)
    step = 4096
    for at in range(0, int(term[-1]) + 1 if len(term) else 0, step):
        lo, hi = np.searchsorted(term, [at, at + step])
        held = np.zeros((len(everything), step), dtype=np.float32)
        held[owner[lo:hi], term[lo:hi] - at] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    near = whole * common >= part * union
    if not diagonal:
        near[:len(left), :len(left)] = near[len(left):, len(left):] = False
    root = list(range(len(everything)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        i, j = find(int(i)), find(int(j))
        if i != j:
            root[max(i, j)] = min(i, j)
    pa.default_memory_pool().release_unused()
    names = [n for n, *_ in everything]
    pairs = [(names[k], names[find(k)]) for k in range(len(names)) if find(k) != k]
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def few(rows: DataFrame) -> DataFrame:
    """``rows`` of ids and numbers for a join with all texts: counted, and broadcast if there are few.

    Then the texts stay where they are; beyond the bound both sides are shuffled, with the same result.
    """
    folder = run_folder(rows.sparkSession, "wanted")
    rows.write.parquet(folder)
    stored = rows.sparkSession.read.parquet(folder)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def verified(docs: DataFrame, index: DataFrame, families: DataFrame, size: int, part: int, whole: int, chunk: int,
             id_column: str, text_column: str) -> DataFrame:
    """Exact links a, b between the sets of each family; one text of each set is read again."""
    first = index.where("node is not null").groupBy("node").agg(
        F.min(F.struct("text_key", "id")).alias("r")).select("node", "r.text_key", F.col("r.id").alias("id"))
    members = families.join(first, "node")
    sizes = members.groupBy("root").agg(F.count("*").alias("members"))
    chunks = F.ceil(F.col("members") / chunk).cast("int")
    wanted = members.join(sizes, "root").withColumn("chunks", chunks).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    texts = docs.select(F.col(id_column).alias("own_id"), F.xxhash64(text_column).alias("text_key"), F.col(text_column).alias("text"))
    wanted = few(wanted)
    read = texts.join(wanted, (texts["text_key"] == wanted["text_key"]) & texts["own_id"].eqNullSafe(wanted["id"])).select(
        "root", "node", "text", "own", "chunks")
    other = F.explode(F.expr("sequence(0, chunks - 1)"))
    cells = read.withColumn("other", other).select(
        "root", "node", "text", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
        (F.col("own") <= F.col("other")).alias("left_side"), (F.col("own") >= F.col("other")).alias("right_side"))
    return cells.groupBy("root", "left", "right").applyInArrow(
        lambda table: linked_sets(table, size, part, whole), "a long, b long")


def grouped(spark: SparkSession, docs: DataFrame, size: int, part: int, whole: int, chunk: int = CHUNK,
            id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``id``, ``text_key``, ``n`` and ``group`` (a set of its component; null without shingles)."""
    documents = max(1, docs.count())
    if documents > 4 * SAMPLE:  # as many as agree as often at the chance the cost model takes
        chance = measured_chance(docs, documents, size, part, whole, id_column, text_column)
        documents = max(1, round(documents * chance / CHANCE))
    entries, folder = run_folder(spark, "index-entries"), run_folder(spark, "index")
    indexed(docs, size, part, whole, documents, id_column, text_column).write.parquet(entries)
    whole_index = spark.read.parquet(entries)
    whole_index.select("id", "text_key", "node", "n", "content").write.parquet(folder)
    index = spark.read.parquet(folder)
    clash = index.where("node is not null").groupBy("node").agg(F.min("content").alias("x"), F.max("content").alias("y"))
    if not clash.where("x <> y").isEmpty():
        raise ValueError("two sets have one 64-bit name")
    found = candidates(spark, whole_index)
    drop_folder(spark, entries)
    links = components(spark, found)
    families = links.unionByName(links.select(F.col("root").alias("node"), "root").distinct())
    found = components(spark, verified(docs, index, families, size, part, whole, chunk, id_column, text_column))
    return index.select("id", "text_key", "n", "node").join(found, "node", "left").select(
        "id", "text_key", "n", F.coalesce("root", "node").alias("group"))


def similar_documents(spark: SparkSession, docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100,
                      chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id`` (least id reachable by links).

    Documents link if ``whole * common >= part * union`` for their shingles of ``size`` words.
    """
    placed = grouped(spark, docs, size, part, whole, chunk, id_column, text_column)
    least = placed.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    return placed.join(least, "group", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100,
                chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the least id, and all rows without shingles.

    Rows are found again by id and text; of rows with shingles that repeat both, one stays.
    """
    placed = grouped(spark, docs, size, part, whole, chunk, id_column, text_column).where("group is not null")
    best = placed.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("best"))
    going = placed.join(best, "group").where(
        ~(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_key") == F.col("best.text_key")))).select(
        F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    going = few(going)
    again = placed.groupBy("id", "text_key").agg(F.count("*").alias("n")).where("n > 1")
    key = F.xxhash64(text_column)
    kept = docs.join(going, docs[id_column].eqNullSafe(going["gone_id"]) & (key == going["gone_key"]), "left_anti")
    if again.isEmpty():
        return kept
    alone = ~F.coalesce(F.col(text_column).rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))  # no words, so no shingles
    own = kept.withColumn("__own_row", F.when(alone, F.monotonically_increasing_id()))
    return own.dropDuplicates([id_column, text_column, "__own_row"]).drop("__own_row")


def oracle(size: int, part: int, whole: int) -> str:
    """The same rows in DuckDB SQL: shared shingles counted over all pairs that have any."""
    upper = "".join(map(chr, range(65, 91)))
    return f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) end) g from w),
n as (select doc_id, count(*) n from s group by doc_id),
i as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where {whole} * c >= {part} * (x.n + y.n - c)),
r as (select doc_id a, doc_id b from documents union select r.a, l.b from r join l on r.b = l.a),
c as (select a doc_id, min(b) component_id from r group by a)
select doc_id, coalesce(n, 0) n_shingles, component_id from c left join n using (doc_id)"""
