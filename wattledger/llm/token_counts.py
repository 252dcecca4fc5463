"""Token counts by byte-pair merging, without ids.

A word's symbols form a linked list; a heap holds its adjacent pairs by rank and place. The pair of
the lowest rank is merged again and again; each merge takes one symbol away, so the count is the
number of first symbols less the merges. Words of a slice are counted once each.
"""

from __future__ import annotations

import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .ids import BYTE_LETTERS, MEMORY_PARTS, Distinct, Known, Memory, public_path
from .tables import only
from .words import SPACED, slices, sums, words

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: White space of ASCII that the tokenizer drops; what stands between it is counted by itself.
_SOLID = SPACED.copy()
_SOLID[[0x0B, 0x0C]] = True


class Counter:
    """Counts tokens as the tokenizer of a ``tokenizers`` file with end-of-word symbols makes them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"]:
            raise ValueError("needs byte-pair merges with ends of words")
        self.suffix = model["end_of_word_suffix"]
        pairs = (tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.plain = Memory(self._plain)
        self.known, self.counts = Known(), np.empty(0, np.int64)

    def merged(self, letters: str) -> int:
        """Tokens of one word, given as its byte letters."""
        n = len(letters)
        symbols = [*letters[:-1], letters[-1] + self.suffix]
        rank = self.rank
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or rank.get((symbols[i], symbols[j])) != r:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (r := rank.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def _plain(self, word: str) -> int:
        return self.merged(word.lower().encode().decode("latin-1").translate(BYTE_LETTERS))

    def remembered(self, parts: Distinct) -> np.ndarray:
        """The count of each distinct part; new ones are merged."""
        if len(self.known) > MEMORY_PARTS:
            self.known, self.counts = Known(), np.empty(0, np.int64)
        number = self.known.find(parts.hash)
        new = np.flatnonzero(number < 0)
        if len(new):
            self.counts = np.concatenate([self.counts, np.fromiter(map(self.part, parts.parts(new)), np.int64, len(new))])
            number[new] = self.known.add(parts.hash[new])
        return self.counts[number]

    def part(self, part: bytes) -> int:
        """Tokens of a part of a text that holds no ASCII white space."""
        text = part.decode()
        if _PLAIN.fullmatch(text):
            return self.plain[text]
        if text[-1] in ",." and _PLAIN.fullmatch(text, 0, len(text) - 1):
            return self.plain[text[:-1]] + 1
        pieces = self.special.split(text) if self.special else [text]
        return len(pieces) - 1 + sum(self.merged(w) for p in pieces if p for w, _ in self.split(self.normal(p)))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this worker process for a tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
          limit: int = LIMIT) -> DataFrame:
    """n_bytes, n_tokens and over_limit of every row of ``docs``.

    A null text counts as empty: 0 bytes, 0 tokens. A null key stays null, repeated rows are
    counted each, an empty table gives no rows, other columns are not looked at.
    """
    tokenizer = tokenizer or public_path(TOKENIZER)

    def run(batches):
        remembered = counter(tokenizer).remembered
        for batch in batches:
            for s in slices(batch.column(1)):
                w = words(s, _SOLID, hashed=False)
                parts = Distinct(s.data, w.start, w.end)
                n = sums(remembered(parts)[parts.number], w.bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows), pa.array(np.diff(s.offsets)), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return only(docs, key, text).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
