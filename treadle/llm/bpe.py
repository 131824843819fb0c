"""Merge-type (BPE) SentencePiece vocabularies: exact encoding without running all merges.

A text falls into chunks no piece can reach across: a run of blanks with the word after it, and
line feeds, where the vocabulary has no piece that holds one behind another character.  Chunks are
encoded on their own and remembered in a bounded cache, as most words repeat.

Two facts make the shortcuts exact.  A row of pieces is the encoding of its text if and only if
every two neighbours re-merge to themselves, and every prefix of a text has exactly one encoding.
"""

from __future__ import annotations

from functools import cache

import ahocorasick
import sentencepiece

BLANK = "▁"
#: A lone surrogate never occurs in a valid text, so it can separate chunks.
CUT = "\ud800"
#: Entries a cache may hold before it starts anew; bounds a worker's memory.
CACHE_ENTRIES = 400_000


class Vocabulary:
    """The pieces of one model file, and the tables both operators read."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = model.bos_id(), model.eos_id()
        size = model.vocab_size()
        self.byte_ids = [0] * 256
        self.piece: list[str | None] = [None] * size
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        #: What an id stands for when decoded, in UTF-8; control ids stand for nothing.
        self.bytes_of = [b""] * size
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(text[3:-1], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:-1], 16)])
            elif model.is_unknown(i):
                self.bytes_of[i] = " ⁇ ".encode()
            elif not (model.is_control(i) or model.is_unused(i)):
                self.piece[i], self.ids[text], self.score[text] = text, i, model.get_score(i)
                self.bytes_of[i] = text.replace(BLANK, " ").encode()
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece continues behind a blank: words can't be encoded on their own")
        missing = {c for p in self.ids for c in p} - self.ids.keys()
        if missing:
            raise ValueError(f"characters without a piece of their own: {sorted(missing)[:5]}")
        if any("\n" in p and p != "\n" for p in self.ids):
            raise ValueError("a piece holds a line feed: lines can't be encoded on their own")
        whole = {i: p for p, i in self.ids.items() if len(p) == 1 or self.merge(p) == [p]}
        self.length = [len(p) if p else 0 for p in self.piece]
        #: For each piece the longest other piece that it starts with, -1 without one.
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        reachable = {p: i for i, p in whole.items()}
        for i, p in whole.items():
            self.automaton.add_word(p, i)
            for k in range(len(p) - 1, 0, -1):
                if p[:k] in reachable:
                    self.shorter[i] = reachable[p[:k]]
                    break
        self.automaton.make_automaton()
        #: Neighbouring characters of some piece: no piece reaches across any other two.
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.known_fits: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces plain merging gives: best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Do the two pieces stay as they are when their joined text is merged again?"""
        key = left << 32 | right
        got = self.known_fits.get(key)
        if got is None:
            if len(self.known_fits) > CACHE_ENTRIES:
                self.known_fits.clear()
            a, b = self.piece[left], self.piece[right]
            got = self.known_fits[key] = a[-1] + b[0] not in self.joined or self.merge(a + b) == [a, b]
        return got

    def spelled(self, character: str) -> list[int]:
        """An unknown character as byte ids."""
        return [self.byte_ids[b] for b in character.encode()]


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


def chunks(text: str) -> list[str]:
    """The text with its leading blank, cut where no piece reaches across."""
    if not text:
        return []
    if "  " in text or BLANK in text or text[0] == " ":
        return _runs(" " + text.replace(BLANK, " "))
    return (" " + text).replace(" ", CUT + " ").replace("\n", f"{CUT}\n{CUT}").split(CUT)


def _runs(text: str) -> list[str]:
    """As the split above, but runs of blanks stay with the word behind them."""
    out, held = [], ""
    for part in text.replace(" ", CUT + " ").replace("\n", f"{CUT}\n{CUT}").split(CUT):
        if part == " ":
            held += part
        else:
            if held and not part.startswith(" "):
                out.append(held)
                held = ""
            out.append(held + part)
            held = ""
    return [*out, held]


#: Characters that often follow a word, to be taken off before the word is looked up.
TAIL = "".join(map(chr, range(33, 65))) + "[]_|{}"


class Remembered(dict):
    """A bounded memory of ``work(chunk)``, whose results for parts add up."""

    def __init__(self, vocab: Vocabulary, work):
        super().__init__()
        self.joined, self.work = vocab.joined, work

    def __missing__(self, chunk: str):
        if len(self) > CACHE_ENTRIES:
            self.clear()
        head = chunk.rstrip(TAIL)
        if head and head != chunk and chunk[len(head) - 1:len(head) + 1].replace(" ", BLANK) not in self.joined:
            got = self[head] + self[chunk[len(head):]]
        else:
            got = self.work(chunk)
        if len(chunk) <= 32:
            self[chunk] = got
        return got
