"""Operators 4, 9 and 10 against the tokenizers' own libraries."""

import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from treadle.llm import packing, queries, sentencepiece_codec, token_counts

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [*" \n\t▁abcthe,.!*'é日本𠀀☃\x00\x01 12345ΣİÉ́ſK", "the", "tion", "   ", "ing", "<s>", "<|endoftext|>", "don't", "THE", "Å"]


def texts(n, seed, most=40):
    own = random.Random(seed)
    return ["".join(own.choice(PARTS) for _ in range(own.randint(0, most))) for _ in range(n)] + [
        "", " ", *(" " * k for k in range(2, 40, 5)), "x" * 300, "word " * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_codec_is_the_library(library):
    codec = sentencepiece_codec.codec(PIECES)
    for t in texts(4000, 1):
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert codec.encode(t).tolist() == ids, repr(t)
        assert codec.decode(ids) == library.decode(ids), repr(t)


def test_round_trip_of_rows(documents, rows):
    docs = documents(["the cat", None, "", "the cat"], [1, 2, None, 1])
    got = rows(sentencepiece_codec.round_trip(docs, PIECES))
    assert len(got) == 4 and [r[1] for r in got] == [4, 4, 2, 2]
    encoded = sentencepiece_codec.encode_texts(docs, PIECES)
    assert rows(sentencepiece_codec.decode_ids(encoded, PIECES)) == [(1, "the cat"), (1, "the cat"), (2, ""), (None, "")]
    assert rows(sentencepiece_codec.round_trip(documents([]), PIECES)) == []


def test_counts_at_every_prefix(library):
    counter = token_counts.counter(PIECES)
    for t in texts(400, 2, 20):
        want = [len(library.encode(t[:k])) for k in range(len(t) + 1)] if len(t) < 100 else None
        assert counter.count(t) == len(library.encode(t)), repr(t)
        if want:
            assert counter.prefixes(t) == want, repr(t)
            for budget in (0, 1, 3, want[-1]):
                end = counter.longest(t, budget)
                assert want[end] <= budget and all(n > budget for n in want[end + 1:])


def test_count_rows(documents, rows):
    docs = documents(["the cat", None, "", "é" * 5000], [1, None, 3, 4])
    got = {r[0]: r[1:] for r in rows(token_counts.count_tokens(docs, PIECES, limit=4096))}
    assert got[1] == (7, 2, False) and got[None] == (0, 0, False) and got[3] == (0, 0, False) and got[4][0] == 10000
    assert rows(token_counts.cut_to_budget(docs, PIECES, 1), "text")[:2] == [("",), ("",)]
    assert token_counts.prefix_counts(docs, PIECES).where("size(counts) = 1").count() == 2
    assert rows(token_counts.count_tokens(documents([]), PIECES, 5)) == []


def test_words_are_encoded_as_whole_texts():
    whole, own = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    given = texts(6000, 3)
    for at in range(0, len(given), 1000):
        for t, ids in zip(given[at:at + 1000], own.encode_texts(pa.array(given[at:at + 1000]))):
            assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
    assert [len(x) for x in own.encode_texts(pa.array([None, "", "a"], pa.string()))] == [0, 0, 1]


def test_frequent_words_are_encoded_once(monkeypatch):
    """A word that comes in every batch outlives the words that come once."""
    own, whole, learned = packing.WordEncoder(WORDS), Tokenizer.from_file(WORDS), []
    learn = own._learn
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(own, "_learn", lambda words: (learned.extend(words), learn(words)))
    for k in range(12):
        text = "Frequent, " + " ".join(f"{c}{chr(97 + k)}x" for c in "bcdfghjk")
        assert next(own.encode_texts(pa.array([text]))).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(own.known) + len(own.older) < 2 * (20 + 20)
    assert learned.count("Frequent,") == 1


def test_words_are_no_python_objects():
    """What a word costs beyond its merges: words are remembered and looked up in Arrow arrays."""
    own, whole = packing.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    words = ["".join(chr(97 + k // 26 ** p % 26) for p in range(4)) for k in range(20_000)]
    text = " ".join(words)
    next(own.encode_texts(pa.array(["first"])))
    before = sys.getallocatedblocks()
    ids = next(own.encode_texts(pa.array([text])))
    assert sys.getallocatedblocks() - before < 1000
    assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(own.known) >= 20_000


def test_remembered_words_are_bounded(monkeypatch):
    """Besides the words at hand at most CACHE_ENTRIES, the latest of them."""
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 20)
    own, whole = packing.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    for k in range(40):
        text = " ".join(f"{c}{chr(97 + k % 13)}x{'.' * (k % 3)}" for c in "bcdfghjk")
        assert next(own.encode_texts(pa.array([text]))).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 8 + 9 + 1 and len(own.older) <= 20


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_whose_lower_case_has_other_bytes(kind):
    """Lower case may take more or fewer bytes or leave the range; marks may stand alone or in front."""
    own, whole = packing.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    given = ["Ⱥ, Ⱥ Ⱥb. ⱥ, ⱦ Ⱦ! K, İ. İa ı, ẞ ß. Ǆ, ǅ ǆ.", "É, é É. É é! ... , . a.b a. .a A.", "", "  ", "\n", "ſ, ſt ŉ, ŉ", "1, a1. a1",
             "日本 日本, a日, Ωa Ω, ω", "e\u0301, E\u0301. \u0301"]
    for _ in range(2):
        for t, ids in zip(given, own.encode_texts(pa.array(given, kind))):
            assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
        for t in given:
            assert next(own.encode_texts(pa.array([t], kind))).tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
    assert list(own.encode_texts(pa.array([], kind))) == []


def test_slices_are_bounded_by_bytes():
    given = [None, "", "a" * 10, "b" * 5, "c" * 100, "é" * 4, None, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(given, pa.string())], names=["id", "text"])
    cut = [s.column(1).to_pylist() for s in packing.slices(batch, 15)]
    assert [t for s in cut for t in s] == given
    assert all(len(s) == 1 or sum(len((t or "").encode()) for t in s) <= 15 for s in cut) and len(cut) == 3
    assert list(packing.slices(batch.slice(0, 0), 15)) == []


def test_fill_is_the_best_subset_sum():
    own = random.Random(5)
    for _ in range(200):
        counts = {own.randint(1, 40): own.randint(1, 3) for _ in range(own.randint(1, 6))}
        capacity = own.randint(1, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        chosen = packing.fill(counts, capacity)
        assert all(k <= counts[n] for n, k in chosen.items())
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= capacity)


def test_patterns_use_every_piece_once():
    own = random.Random(6)
    counts = {own.randint(1, 64): own.randint(1, 500) for _ in range(40)}
    plan, used = packing.patterns(counts, 64), dict.fromkeys(counts, 0)
    for pattern, times in plan:
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] += k * times
    assert used == counts
    # no more windows than first fit takes with the longest first; pieces over half a window each need one
    room = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            k = next((k for k, left in enumerate(room) if left >= n), None)
            if k is None:
                room.append(64 - n)
            else:
                room[k] -= n
    least = max(sum(c for n, c in counts.items() if n > 32), -(-sum(n * c for n, c in counts.items()) // 64))
    assert least <= sum(t for _, t in plan) <= len(room)


@pytest.mark.parametrize("window", [16, 2048])
def test_packed_pieces(spark, documents, window):
    given = [*texts(200, 7), None, "same text", "same text"]
    ids = [None if k == 5 else k for k in range(len(given))]
    got = queries.packed(spark, documents(given, ids), window=window).toPandas()
    whole = Tokenizer.from_file(WORDS)
    want = [np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for t in given]
    for k, (i, own) in enumerate(zip(ids, want)):
        if i is None:
            continue
        mine = got[got.doc_id == i].sort_values("start")
        assert mine.start.tolist() == list(range(0, len(own), window))
        assert mine.length.sum() == len(own) == mine.doc_tokens.iloc[0]
        for r in mine.itertuples():
            assert zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    for _, one in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert one.offset.tolist() == [0, *one.length.cumsum().tolist()[:-1]] and one.length.sum() <= window
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    assert got.sequence_id.nunique() <= -(-got.length.sum() // window) * 1.05 + 1


def test_sequences_hold_the_ids(spark, documents):
    pieces = packing.stored_pieces(spark, documents(["a b c", "d", None]), WORDS, 1, window=8)
    got = packing.sequences(packing.place(pieces, 8)).collect()
    assert sum(r.n_tokens for r in got) == 7 and all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_no_documents(spark, documents):
    assert queries.packed(spark, documents([])).count() == 0
