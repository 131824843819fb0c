"""SentencePiece encoding and decoding of whole texts.

Encoding walks a chunk from the left and takes the longest piece an Aho-Corasick scan found at the
position; a piece that does not fit its left neighbour is replaced by the next shorter one, and a
position where none fits is marked in a bitfield and left backwards, so no position is tried twice.

Defined results: a null text counts as empty; an empty text has the begin and end ids only;
characters without a piece become byte ids; repeated rows give repeated results; null ids stay.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import cache

from pyspark.sql import DataFrame

from treadle.llm.batches import id_and_text, map_texts
from treadle.llm.bpe import BLANK, Remembered, Vocabulary, chunks, vocabulary


def encode_chunk(vocab: Vocabulary, chunk: str) -> list[int]:
    """Ids of one chunk (blanks written as blanks)."""
    text = chunk.replace(" ", BLANK)
    n = len(text)
    longest, length = [-1] * n, vocab.length
    for end, piece in vocab.automaton.iter(text):
        longest[end - length[piece] + 1] = piece
    if n and -1 not in longest:
        return _backtrack(vocab, longest, 0, n)
    out: list[int] = []
    start = 0
    while start < n:
        if longest[start] < 0:
            out += vocab.spelled(text[start])
            start += 1
            continue
        stop = start
        while stop < n and longest[stop] >= 0:
            stop += 1
        out += _backtrack(vocab, longest, start, stop)
        start = stop
    return out


def _backtrack(vocab: Vocabulary, longest: list[int], start: int, stop: int) -> list[int]:
    length, shorter, fits, known = vocab.length, vocab.shorter, vocab.fits, vocab.known_fits.get
    out: list[int] = []
    failed = 0
    at, piece = start, longest[start]
    while at < stop:
        end = at + length[piece]
        if end <= stop and not failed >> end - start & 1 and (
                not out or known(out[-1] << 32 | piece) or fits(out[-1], piece)):
            out.append(piece)
            at = end
            piece = longest[at] if at < stop else -1
            continue
        piece = shorter[piece]
        while piece < 0:
            failed |= 1 << at - start
            last = out.pop()
            at -= length[last]
            piece = shorter[last]
    return out


class Codec:
    """Encode and decode with one vocabulary; keeps a bounded memory of chunks."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self._known = Remembered(self.vocab, lambda c: array("i", encode_chunk(self.vocab, c)).tobytes())

    def encode(self, text: str | None) -> array:
        """All ids of the text, begin and end included."""
        known = self._known
        ids = array("i", [self.vocab.bos])
        ids.frombytes(b"".join([known[c] for c in chunks(text or "")]))
        ids.append(self.vocab.eos)
        return ids

    def decode(self, ids) -> str:
        """The text of the ids; the blank that encoding puts in front goes again."""
        table = self.vocab.bytes_of
        raw = b"".join([table[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_texts(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array<int>, begin and end included) of each row."""
    def make():
        own = codec(model)
        return lambda records: ((i, own.encode(t)) for i, t in records)
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """``id`` and ``text`` of rows with ``id`` and ``ids``; null ids give a null text."""
    def make():
        own = codec(model)
        return lambda records: ((i, None if ids is None else own.decode(ids)) for i, ids in records)
    return map_texts(encoded.select("id", "ids"), make,
                     f"id {encoded.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids and decoded text of each row as counts and hashes, so that neither is moved or kept."""
    def make():
        own = codec(model)

        def run(records):
            for i, text in records:
                ids = own.encode(text)
                yield (i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                       hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return run
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, "
                                 "ids_sha256 string, decoded_sha256 string")
