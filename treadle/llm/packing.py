"""Packing of tokenised documents into fixed windows by minimum bin slack.

A document is cut into whole windows and one remainder.  The remainders' lengths form a multiset of
at most ``window - 1`` distinct values, whatever the corpus; only this multiset reaches the driver.
There, each window takes the longest remainder left and the multiset of others that fills it closest
to capacity, found by subset sums held in bitsets, with the counts read back from the bitsets.  Such
a pattern is repeated as often as the counts allow.  Every task then finds the window and the offset
of its pieces from the patterns and each piece's rank among those of its length.

Defined results: a null text counts as empty; an empty text is a piece of the end id alone; repeated
rows are packed as often as they occur; an empty table gives no pieces; null ids stay.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from treadle.llm.batches import id_and_text
from treadle.session import run_folder

#: Words a worker remembers besides those of the slice at hand, which with the slices bounds its memory.
CACHE_ENTRIES = 100_000
#: Forms encoded in one call; bytes of texts whose words are numbered together.
CALL, SLICE_BYTES = 1000, 1 << 21
#: Latin letters whose lower case is one letter, and the marks that may follow a word.
LATIN = [("A", "Z"), ("a", "z"), ("À", "Ö"), ("Ø", "ö"), ("ø", "į"), ("ı", "ɏ")]
LETTERS = "".join(chr(c) for first, last in LATIN for c in range(ord(first), ord(last) + 1))
ONLY_LETTERS = f"^[{''.join(f'{first}-{last}' for first, last in LATIN)}]+$"
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible bytes stand for themselves, the others for letters from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen and b != 32]
    return {b: chr(b) for b in seen} | {b: chr(256 + k + (b > 32)) for k, b in enumerate(hidden)}


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (column 1) have at most ``most`` bytes, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def of_letters(words: pa.Array) -> pa.Array:
    """Which words are Latin letters alone."""
    other = pc.invert(pc.string_is_ascii(words))
    return pc.replace_with_mask(pc.ascii_is_alpha(words), other, pc.match_substring_regex(words.filter(other), ONLY_LETTERS))


def places(mask: pa.Array) -> np.ndarray:
    return np.flatnonzero(mask.to_numpy(zero_copy_only=False))


class Words:
    """Words and the ids of each, little-endian 32-bit."""

    def __init__(self, words: pa.Array | None = None, ids: pa.Array | None = None):
        self.words = pa.array([], pa.large_string()) if words is None else words
        self.ids = pa.array([], pa.large_binary()) if ids is None else ids

    def __len__(self) -> int:
        return len(self.words)

    def __add__(self, more: Words) -> Words:
        return Words(pa.concat_arrays([self.words, more.words]), pa.concat_arrays([self.ids, more.ids]))


def values(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Binary values of the ids up to each end."""
    offsets = np.append(0, ends).astype(np.int64) * 4
    data = pa.py_buffer(ids.astype("<u4", copy=False))
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data])


def opened(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids of each of these values begin and the last one's end, and all ids; not for a slice."""
    data = array.buffers()[2]
    ends = np.append(0, np.cumsum(pc.binary_length(array).to_numpy().astype(np.int64) // 4))
    return ends, np.frombuffer(data, "<u4", ends[-1]) if ends[-1] else np.zeros(0, "<u4")


class WordEncoder:
    """Ids of whole texts from a tokenizer that never looks across blanks or line feeds.

    Words are encoded once and remembered, in Arrow arrays that are looked up and put together as a
    whole: those that occur go over into the new generation, so frequent words stay however many others
    come by.  A word of letters is one unit of the tokenizer whatever marks follow it, so many such
    words go through its merges in one call, without its normaliser.
    Texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        parts |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        suffix = parts["model"]["end_of_word_suffix"]
        vocabulary = self.merges.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.letters = byte_letters()
        self.forget()

    def _encode_forms(self, forms: pa.Array, ascii_only: bool) -> pa.Array:
        """Lower-case words of letters: joined by blanks, and the ids cut behind each word's end."""
        joined = [" ".join(listed(forms[k:k + CALL])) for k in range(0, len(forms), CALL)]
        if not ascii_only:  # ASCII stands for itself
            joined = [t.encode().decode("latin-1").translate(self.letters) for t in joined]
        got = self.merges.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, "<u4"), *(np.array(g.ids, "<u4") for g in got)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(forms):
            raise ValueError("the tokenizer does not end each word once")
        return values(stops, ids)

    def _encode_words(self, words: pa.Array) -> pa.Array:
        """Ids of lower-case words of letters, and of any others that the tokenizer has to split."""
        plain, ascii_only = of_letters(words), pc.string_is_ascii(words)
        masks = [pc.and_(plain, ascii_only), pc.and_not(plain, ascii_only), pc.invert(plain)]
        rest = [g.ids for g in self.tokenizer.encode_batch_fast(listed(words.filter(masks[2])), add_special_tokens=False)]
        parts = [self._encode_forms(words.filter(masks[0]), True), self._encode_forms(words.filter(masks[1]), False),
                 values(np.cumsum([len(ids) for ids in rest]), np.array([i for ids in rest for i in ids], "<u4"))]
        order = np.concatenate([places(m) for m in masks])
        return pa.concat_arrays(parts).take(pa.array(np.argsort(order)))

    def _recalled(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Which of ``words`` either generation has, and the ids of these; they are the new generation."""
        held = self.known + self.older
        at = pc.index_in(words, value_set=held.words)
        found, place = at.is_valid(), at.drop_null()
        left = np.ones(len(held), bool)
        left[place.to_numpy()] = False
        left = pa.array(np.flatnonzero(left)[:CACHE_ENTRIES])
        self.known = Words(words.filter(found), held.ids.take(place))
        self.older = Words(held.words.take(left), held.ids.take(left))
        return found, self.known.ids

    def _learn(self, words: list[str]) -> None:
        """Put words not known yet first in the new generation; a word's marks are encoded apart, as the tokenizer does."""
        array, n = pa.array(words, pa.large_string()), len(words)
        bare = pc.ascii_rtrim(array, MARKS)
        plain = of_letters(bare)
        marked = pc.and_(plain, pc.not_equal(pc.binary_length(bare), pc.binary_length(array)))
        heads = pc.if_else(plain, pc.utf8_lower(bare), array)
        tails = pc.utf8_ltrim(array.filter(marked), LETTERS)
        # the words themselves come first, then the heads and tails that are none of them
        keys = pa.concat_arrays([array, heads, tails, pa.array([""], pa.large_string())]).dictionary_encode()
        codes, parts = keys.indices.to_numpy(), keys.dictionary[n:]
        found, ids = self._recalled(parts)
        whole, missing = pc.equal(heads, array), pc.invert(found)
        new = self._encode_words(pa.concat_arrays([array.filter(whole), parts.filter(missing)]))
        stock, own = pa.concat_arrays([new, ids]), places(whole)
        place = np.zeros(len(keys.dictionary), np.int64)
        place[np.concatenate([own, n + places(missing), n + places(found)])] = np.arange(len(stock))
        pairs = np.full((n, 2), codes[-1])
        pairs[:, 0] = codes[n:2 * n]
        pairs[places(marked), 1] = codes[2 * n:-1]
        ends, both = opened(stock.take(pa.array(place[pairs.ravel()])))
        learned = Words(array, values(ends[2::2], both))
        self.known = learned + Words(parts.filter(missing), new[len(own):]) + self.known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and where each text's begin and the last one's end.

        Arrow splits the texts and numbers the distinct words; only those are looked up.
        """
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        names = words.dictionary.cast(pa.large_string())
        found, ids = self._recalled(names)
        new = names.filter(pc.invert(found))
        if len(new):
            self._learn(listed(new))
            ids = pa.concat_arrays([ids, self.known.ids[:len(new)]])
        place = np.argsort(np.concatenate([places(found), places(pc.invert(found))]))
        (ends, stock), order = opened(ids), place[words.indices.to_numpy()]
        size = np.diff(ends)[order]
        place = np.append(0, np.cumsum(size))
        ids = stock[np.repeat(ends[:-1][order] - place[:-1], size) + np.arange(place[-1])]
        offsets = lists.offsets.to_numpy()
        return ids, place[offsets - offsets[0]]

    def forget(self) -> None:
        """Give memory back: the worker may go on with other work."""
        self.known, self.older = Words(), Words()
        pa.default_memory_pool().release_unused()

    def encode_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; a null text is empty."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        ids, place = self.encode(pc.if_else(pa.array(odd), "", texts))
        for k, by_hand in enumerate(odd):
            if by_hand:
                got = self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False)
                yield np.array(got.ids, dtype="<u4")
            else:
                yield ids[place[k]:place[k + 1]]


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, id_column: str = "doc_id",
        text_column: str = "text") -> DataFrame:
    """Pieces of at most ``window`` tokens: id, start, length, doc_tokens, ids (little-endian 32-bit).

    ``part`` and ``slot`` number the pieces of one length: the task, and the place among that task's.
    """
    rows = id_and_text(docs, id_column, text_column)
    out = StructType.fromDDL(f"id {rows.schema['id'].dataType.simpleString()}, start long, length int, "
                             "doc_tokens long, ids binary, part int, slot long")
    end, step = np.array([end_id], dtype="<u4").tobytes(), window * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen, schema = encoder(tokenizer), TaskContext.get().partitionId(), defaultdict(int), to_arrow_schema(out)
        for whole in batches:
            for batch in slices(whole, SLICE_BYTES):
                found = []
                for i, ids in zip(batch.column(0).to_pylist(), own.encode_texts(batch.column(1))):
                    ids = ids.tobytes() + end
                    for start in range(0, len(ids), step):
                        piece = ids[start:start + step]
                        n = len(piece) // 4
                        found.append((i, start // 4, n, len(ids) // 4, piece, part, seen[n]))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*found), schema)], schema=schema)
        own.forget()

    return rows.mapInArrow(run, out)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset within ``counts`` whose sum comes closest to ``capacity`` from below.

    Bit s of a bitset says that some multiset of the lengths so far sums to s; the bitsets before
    each length are kept, and the counts are read back from the last to the first.
    """
    mask, reach, stack = (1 << capacity + 1) - 1, 1, []
    for length in sorted((k for k in counts if k <= capacity and counts[k]), reverse=True):
        stack.append((length, reach))
        left, step = min(counts[length], capacity // length), 1
        while left:
            step = min(step, left)
            reach |= reach << length * step & mask
            left -= step
            step *= 2
        if reach >> capacity & 1:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(stack):
        taken = 0
        while not before >> target & 1:
            target -= length
            taken += 1
        if taken:
            chosen[length] = taken
    return chosen


def patterns(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """(lengths with their counts in one window, number of such windows) until nothing is left.

    Each step uses up at least one length's count below the pattern's own, so there are at most a
    few times as many patterns as lengths.
    """
    left, out = dict(counts), []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = fill(left, window - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append((pattern, times))
    return out


def layout(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """A row per pattern and length: the ranks it takes, its first window, offset and count per window."""
    used, first, rows = defaultdict(int), 0, []
    for pattern, times in plan:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, used[n], first, offset, pattern[n]))
            used[n] += pattern[n] * times
            offset += n * pattern[n]
        first += times
    return pd.DataFrame(rows, columns=["length", "rank", "window", "offset", "per"]).astype("int64").sort_values(
        ["length", "rank"], ignore_index=True)


def place(pieces: DataFrame, window: int = 2048) -> DataFrame:
    """``pieces`` (length, part, slot and any columns but these) with sequence_id and offset.

    ``pieces`` is read twice, so it must be stored.  The driver gets a row per distinct length.
    """
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = layout(patterns(counts, window))
    # a length has one row per task here
    before = sizes.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select(
        "length", "part", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("slot")).drop(
        "before", "part", "slot")
    out = StructType.fromDDL(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
                             + ", sequence_id long, offset long")
    # one ordered key for (length, rank)
    keys = table["length"].to_numpy() * (1 << 50) + table["rank"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype("int64")
            rank = batch.column("rank").to_numpy()
            row = table.iloc[np.searchsorted(keys, length * (1 << 50) + rank, side="right") - 1]
            turn = rank - row["rank"].to_numpy()
            per = row["per"].to_numpy()
            sequence = row["window"].to_numpy() + turn // per
            offset = row["offset"].to_numpy() + turn % per * length
            kept = [batch.column(n) for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=out.names)

    return ranked.mapInArrow(run, out)


def stored_pieces(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048,
                  **columns: str) -> DataFrame:
    """``cut`` written to the shared folder, as the pieces are read more than once."""
    folder = run_folder(spark, "pieces")
    cut(docs, tokenizer, end_id, window, **columns).write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed windows: sequence_id, ids (little-endian 32-bit) and n_tokens; padding is the reader's."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")).withColumn(
        "n_tokens", F.length("ids") / F.lit(4))
