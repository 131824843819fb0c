"""Exact token counts at every prefix of a text.

Every prefix has one encoding, and its last piece is the only piece ending there that fits the last
piece of the prefix before it.  Going from left to right over the matches of an Aho-Corasick scan
therefore gives the count at each prefix from the counts before it.  With the table, "how many
tokens has this text up to here" and "how much of it fits a budget" need no further encoding.

Defined results: a null text counts as empty; an empty text has no tokens; a prefix that ends in an
unknown character counts all bytes of it; repeated rows give repeated results; null ids stay.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache

from pyspark.sql import DataFrame

from treadle.llm.batches import id_and_text, map_texts
from treadle.llm.bpe import BLANK, Remembered, Vocabulary, chunks, vocabulary


def chunk_counts(vocab: Vocabulary, chunk: str) -> list[int]:
    """Token counts of the prefixes of one chunk, the empty one first."""
    text = chunk.replace(" ", BLANK)
    out = _known_counts(vocab, text)
    if -1 not in out:
        return out
    out, at = [0], 0
    for k, character in enumerate(text):
        if character not in vocab.ids:
            for c in _known_counts(vocab, text[at:k])[1:]:
                out.append(out[at] + c)
            out.append(out[k] + len(character.encode()))
            at = k + 1
    return out + [out[at] + c for c in _known_counts(vocab, text[at:])[1:]]


def _known_counts(vocab: Vocabulary, text: str) -> list[int]:
    """Counts of the prefixes; -1 behind a character that no piece has."""
    counts = [0] + [-1] * len(text)
    last = [-1] * (len(text) + 1)
    fits, length, known = vocab.fits, vocab.length, vocab.known_fits.get
    for end, piece in vocab.automaton.iter(text):
        end += 1
        if counts[end] < 0:
            start = end - length[piece]
            left = last[start]
            if left < 0 or (known(left << 32 | piece) or fits(left, piece)):
                counts[end], last[end] = counts[start] + 1, piece
    return counts


class Counter:
    """Counts with one vocabulary; keeps a bounded memory of chunks."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self._known = Remembered(self.vocab, lambda c: chunk_counts(self.vocab, c)[-1])

    def count(self, text: str | None) -> int:
        """Tokens of the whole text: its chunks' last entries."""
        known = self._known
        return sum([known[c] for c in chunks(text or "")])

    def prefixes(self, text: str | None) -> list[int]:
        """Tokens of text[:k] for each k from 0 to its length."""
        out, total = [0], 0
        for chunk in chunks(text or ""):
            counts = chunk_counts(self.vocab, chunk)
            out += [total + c for c in counts[1:]]
            total += counts[-1]
        return [0, *out[2:]]  # the blank in front is no character of the text

    def longest(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.

        Counts of neighbouring prefixes can fall, so the last place counts, not the first crossing.
        """
        table = self.prefixes(text)
        least = table[:]  # the least count from here on, which only rises
        for k in range(len(least) - 2, -1, -1):
            least[k] = min(least[k], least[k + 1])
        return bisect_right(least, budget) - 1


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, model: str, limit: int, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each row."""
    def make():
        own = counter(model)

        def run(records):
            for i, text in records:
                n = own.count(text)
                yield i, len((text or "").encode()), n, n > limit
        return run
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, "
                                 "n_tokens long, over_limit boolean")


def prefix_counts(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``counts`` (array<int>): at index k the tokens of the first k characters."""
    def make():
        own = counter(model)
        return lambda records: ((i, own.prefixes(t)) for i, t in records)
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, counts array<int>")


def cut_to_budget(docs: DataFrame, model: str, budget: int, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """``id``, ``text`` cut to the longest prefix of at most ``budget`` tokens, and its ``n_tokens``."""
    def make():
        own = counter(model)

        def run(records):
            for i, text in records:
                end = own.longest(text, budget)
                yield i, (text or "")[:end], own.prefixes(text)[end]
        return run
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, text string, n_tokens long")
