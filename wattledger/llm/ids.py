"""Token ids of whole texts by the tokenizers library, each distinct word of a slice once.

Both kinds of tokenizer split a text at blanks before they merge anything, so the ids of a text
are the ids of its blank-separated parts in order. The parts of a slice of texts are made
distinct by their hashes, the distinct ones are encoded, and the ids are gathered back. A part
that a worker has met before is not encoded again; that memory has a bound.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from .words import Slice, hashes, mix, words

#: Parts a worker remembers before it starts anew.
MEMORY_PARTS = 800_000

#: A blank or line end at which the byte tokenizer's rule for runs of white space could apply.
_RUN = re.compile(r"[ \n](?:\s|\Z)")
#: A single blank between two visible characters always begins a new word of the byte tokenizer.
_SINGLE = re.compile(r"(?<!\s) (?=\S)")
#: A word of Latin letters, with or without a comma or full stop behind it.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")

#: What parts are split at: the byte tokenizer keeps the blank or line end before a word.
_LEADING, _DROPPED = np.ones(256, dtype=bool), np.ones(256, dtype=bool)
_LEADING[[0x20, 0x0A]] = _DROPPED[[0x20, 0x0A, 0x09, 0x0D]] = False
#: ASCII white space, and the first bytes of characters that may be white space.
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def public_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write for bytes: a visible byte as itself, the others
    as the characters from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class Memory(dict):
    """A dict that works out missing values, in two generations: a key not met for a whole
    generation is forgotten."""

    def __init__(self, work_out, size: int = 100_000):
        super().__init__()
        self.work_out, self.size, self.older = work_out, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work_out(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Known:
    """Numbers 0, 1, .. of the hashes met so far: sorted arrays, a large one and a recent one."""

    def __init__(self):
        self.keys, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.new_keys, self.new_numbers = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys) + len(self.new_keys)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for a new one."""
        out = np.full(len(h), -1, dtype=np.int64)
        for keys, numbers in ((self.keys, self.numbers), (self.new_keys, self.new_numbers)):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                same = keys[at] == h
                out[same] = numbers[at[same]]
        return out

    def add(self, h: np.ndarray) -> np.ndarray:
        """Gives the next numbers to new hashes."""
        numbers = np.arange(len(self), len(self) + len(h))
        self.new_keys, self.new_numbers = self._merged(self.new_keys, self.new_numbers, h, numbers)
        if len(self.new_keys) > 50_000 + len(self.keys) // 8:
            self.keys, self.numbers = self._merged(self.keys, self.numbers, self.new_keys, self.new_numbers)
            self.new_keys, self.new_numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        return numbers

    @staticmethod
    def _merged(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, numbers = np.concatenate([a, b]), np.concatenate([x, y])
        order = np.argsort(keys, kind="stable")
        return keys[order], numbers[order]


class Distinct:
    """Distinct byte ranges of a slice, by hash; ``number[i]`` is that of range i."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, marked: np.ndarray | None = None):
        h = hashes(data, start, end)
        if marked is not None:
            h[marked] = mix(h[marked])
        order = np.argsort(h)
        ordered = h[order]
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        self.number = np.empty(len(h), dtype=np.int64)
        self.number[order] = np.cumsum(fresh) - 1
        self.hash = ordered[fresh]
        self._data, self._start, self._end = data, start[order[fresh]], end[order[fresh]]

    def parts(self, which: np.ndarray) -> list[bytes]:
        raw = self._data.tobytes()
        return [raw[a:b] for a, b in zip(self._start[which].tolist(), self._end[which].tolist())]


class Encoder:
    """Ids of texts.

    ``leading`` tells whether a word is encoded with the blank before it (byte-level tokenizers)
    or blanks are dropped (word tokenizers).
    """

    def __init__(self, path: str, leading: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leading = leading
        self.merge = self.tokenizer.model.tokenize
        self.marks = {m: self.whole(m) for m in ",."}
        self.newline = self.whole("\n")
        self.words = Memory(self._word)
        self.forget()

    def forget(self) -> None:
        """Starts the memory of parts anew."""
        self.known = Known()
        self.ids = np.empty(1 << 16, dtype="<u4")
        self.used = 0
        self.begin, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def whole(self, text: str) -> bytes:
        """Ids of a text encoded at once, as little-endian unsigned 32-bit integers."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a plain word, which no rule splits or changes: straight from the library's merges."""
        letters = word if self.leading else word.lower()
        return array("I", [t.id for t in self.merge(letters.encode().decode("latin-1").translate(BYTE_LETTERS))]).tobytes()

    def _part(self, part: bytes) -> bytes:
        """Ids of a part; a mark behind a plain word and a line end before it are words of their own."""
        text = part.decode()
        lead = text[:1] if self.leading and text[:1] in " \n" else ""
        plain = _PLAIN.fullmatch(text, len(lead))
        if not plain:
            return self.whole(text)
        if lead == "\n":
            return self.newline + self.words[plain[1]] + self.marks.get(plain[2], b"")
        return self.words[lead + plain[1]] + self.marks.get(plain[2], b"")

    def remembered(self, parts: Distinct) -> np.ndarray:
        """The place of each distinct part in ``begin`` and ``length``; new ones are encoded."""
        if len(self.known) > MEMORY_PARTS:
            self.forget()
        number = self.known.find(parts.hash)
        new = np.flatnonzero(number < 0)
        if len(new):
            got = list(map(self._part, parts.parts(new)))
            length = np.fromiter(map(len, got), np.int64, len(got)) // 4
            flat = np.frombuffer(b"".join(got), dtype="<u4")
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used:self.used + len(flat)] = flat
            self.begin = np.concatenate([self.begin, self.used + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.used += len(flat)
            number[new] = self.known.add(parts.hash[new])
        return number

    def one(self, text: str) -> bytes:
        """Ids of one text that may have runs of white space, by the library in the parts between them."""
        parts = _SINGLE.split(text)
        return self.whole(parts[0]) + b"".join([self._part((" " + p).encode()) for p in parts[1:]])

    def texts(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the slice, where those of each text begin and the last end)."""
        data, edges = s.data, s.offsets
        w = words(s, _LEADING if self.leading else _DROPPED, hashed=False)
        start, first = w.start, np.zeros(len(w.start), dtype=bool)
        alone: dict[int, bytes] = {}
        if self.leading:
            first[w.bounds[:-1][np.diff(w.bounds) > 0]] = True
            first &= np.isin(start, edges)
            start = start - ~first
            for row in self._uneven(data, edges):
                alone[row] = self.one(data[edges[row]:edges[row + 1]].tobytes().decode())
        parts = Distinct(data, start, w.end, first)
        number = self.remembered(parts)[parts.number]
        return gathered(self.ids, self.begin[number], self.length[number], w.bounds, alone)

    @staticmethod
    def _uneven(data: np.ndarray, edges: np.ndarray) -> list[int]:
        """Texts with a blank or line end before other white space or at their end."""
        blank = np.flatnonzero(~_LEADING[data])
        last = np.zeros(len(data) + 1, dtype=bool)
        last[edges] = True
        doubtful = blank[last[blank + 1] | _WHITE[data[np.minimum(blank + 1, len(data) - 1)]]]
        rows = np.unique(np.searchsorted(edges, doubtful, "right") - 1).tolist()
        return [r for r in rows if _RUN.search(data[edges[r]:edges[r + 1]].tobytes().decode())]


def gathered(ids: np.ndarray, begin: np.ndarray, each: np.ndarray, bounds: np.ndarray,
             alone: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts from those of their parts; the texts in ``alone`` bring their own."""
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    out = ids[np.arange(total) + np.repeat(begin - ends + each, each)]
    at = np.concatenate([[0], ends])[bounds]
    if alone:
        pieces = [np.frombuffer(alone[r], dtype="<u4") if r in alone else out[at[r]:at[r + 1]] for r in range(len(at) - 1)]
        out = np.concatenate(pieces)
        at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return out, at


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, leading: bool) -> Encoder:
    """The encoder of this worker process for a tokenizer file; it lives as long as the worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, leading) not in _ENCODERS:
        _ENCODERS[path, leading] = Encoder(path, leading)
    return _ENCODERS[path, leading]
