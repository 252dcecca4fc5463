"""License scans with a generalised suffix automaton of license tokens.

The automaton holds every run of words of all templates and phrases. A text is streamed through it
word by word: the state is the longest run that ends here and stands in a template (matching
statistics). Words no template holds reset the state, so only stretches of known words are
streamed. Matches that end are chained in template order into spans, as often as a text holds the template; the part of a
template that a chain covers is the score of its label. Phrases are found at the states their words lead to.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .license_texts import TEXTS
from .tables import only
from .words import ALNUM, Words, slices, words

#: Labels of short phrases; every place where one stands counts.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Bytes of a table of templates; they all go into one automaton, which every task has.
TEMPLATE_BYTES = 16 << 20
#: Shortest match that is chained (a template with fewer words needs all of them), the largest gap
#: in the text within a chain, and the covered part of a template that gives its label.
LONG, GAP, COVER = 5, 20, 0.6
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double, spans array<struct<label:string,first_word:long,end_word:long,cover:double>>")


@dataclass
class Template:
    label: str
    length: int
    phrase: bool


class Automaton:
    """Suffix automaton of several word sequences, with the templates each state stands in."""

    def __init__(self, phrases: tuple, templates: tuple):
        self.templates: list[Template] = []
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]  # by state: template -> ends of its run there, for runs that may be chained
        given = [(label, text, True) for text, label in phrases] + [(label, text, False) for label, text in templates]
        hashes = []
        for s in slices(pa.array([text for _, text, _ in given], pa.string()), lower=True):
            w = words(s, ALNUM)
            hashes += [w.hash[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
        last_states = []
        for (label, _, phrase), own in zip(given, hashes):
            number = len(self.templates)
            self.templates.append(Template(label, len(own), phrase))
            at = 0
            for place, symbol in enumerate(np.searchsorted(self.vocabulary, own).tolist()):
                at = self._extend(at, symbol)
                self.ends[at].setdefault(number, []).append(place + 1)
            last_states.append(at)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            for t, own in self.ends[state].items():
                own.sort()
                # a run too short to be chained needs no ends
                if self.length[self.link[state]] >= min(LONG, self.templates[t].length):
                    self.ends[self.link[state]].setdefault(t, []).extend(own)
        here: dict[int, list[int]] = {}
        for t, state in enumerate(last_states):
            if self.templates[t].phrase and self.templates[t].length:
                here.setdefault(state, []).append(t)
        #: by state: phrases that end where it does, if the match is as long as they are
        self.phrases: list[list[int]] = [[] for _ in self.link]
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.phrases[state] = self.phrases[self.link[state]] + here.get(state, [])
        lengths = [t.length for t in self.templates if t.length]
        self.shortest = min([min(t.length, 1 << 30 if t.phrase else LONG) for t in self.templates if t.length], default=0) if lengths else 0

    def _new(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        """A state for the runs of ``q`` that extend ``p``'s."""
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            q = self.next[last][symbol]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, symbol)
        state = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
        return state

    def stream(self, symbols: list[int], first: int, base: list, matches: list) -> None:
        """Adds the phrases of a stretch (template, first word) to ``base`` and its longest matches
        (first word, length, state) to ``matches``."""
        next_, link, length, phrases = self.next, self.link, self.length, self.phrases
        state = size = 0
        for k, symbol in enumerate(symbols):
            if symbol not in next_[state]:
                if size >= self.shortest:
                    matches.append((first + k - size, size, state))
                while state and symbol not in next_[state]:
                    state = link[state]
                size = length[state]
            state = next_[state][symbol]  # every word of the vocabulary leads somewhere from the root
            size += 1
            for t in phrases[state]:
                if self.templates[t].length <= size:
                    base.append((t, first + k + 1 - self.templates[t].length))
        if size >= self.shortest:
            matches.append((first + len(symbols) - size, size, state))

    def chains(self, matches: list) -> list[tuple[int, int, int, float]]:
        """(template, first word, end word, covered part) of every chain, in order of their first words.

        Matches are taken in text order; one that goes on in its template after a small gap joins the
        chain there, at the nearest place its run has behind the chain; any other ends the chain
        and begins a new one at the first place of its run.
        """
        done: list[tuple[int, int, int, int]] = []
        open_: dict[int, list[int]] = {}  # template -> [first word, end word, end in the template, covered]
        for first, size, state in matches:
            for t, ends in self.ends[state].items():
                template = self.templates[t]
                if template.phrase or size < min(LONG, template.length):
                    continue
                chain = open_.get(t)
                on = bisect_right(ends, chain[2]) if chain and first - chain[1] <= GAP else len(ends)
                if on < len(ends):
                    chain[3] += min(size, ends[on] - chain[2])
                    chain[1], chain[2] = first + size, ends[on]
                else:
                    if chain:
                        done.append((chain[0], t, chain[1], chain[3]))
                    open_[t] = [first, first + size, ends[0], size]
        done += [(c[0], t, c[1], c[3]) for t, c in open_.items()]
        return [(t, a, b, min(1.0, n / self.templates[t].length)) for a, t, b, n in sorted(done)]


def known(w: Words, vocabulary: np.ndarray, shortest: int) -> list[tuple[int, int, list[int]]]:
    """(text, index of its first word in the slice, symbols) of the stretches of known words."""
    if not len(vocabulary) or not len(w.hash):
        return []
    seen = np.zeros(1 << 16, dtype=bool)
    seen[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(w.hash & np.uint64(0xFFFF)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(vocabulary, w.hash[at]), len(vocabulary) - 1)
    real = vocabulary[slot] == w.hash[at]
    at, slot = at[real], slot[real]
    if not len(at):
        return []
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = at[1:] != at[:-1] + 1
    first = np.zeros(len(w.hash) + 1, dtype=bool)
    first[w.bounds[:-1]] = True
    opens |= first[at]
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(at))
    long = end - begin >= shortest
    rows = np.searchsorted(w.bounds, at[begin[long]], "right") - 1
    return [(r, int(at[a]), slot[a:b].tolist()) for r, a, b in zip(rows.tolist(), begin[long].tolist(), end[long].tolist())]


def texts_of(table: DataFrame, label: str = "label", text: str = "text") -> tuple:
    """(label, text) of a table of templates, which may hold ``TEMPLATE_BYTES`` in all. Rows without a label or text drop out."""
    rows = table.select(F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{text}`").cast("string").alias("text")).dropna()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates hold {size} bytes, one automaton takes {TEMPLATE_BYTES}")
    return tuple(sorted(map(tuple, rows.collect())))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: tuple = PHRASES,
         templates: tuple | DataFrame = TEXTS) -> DataFrame:
    """One row per row of ``docs``: places and labels of phrases, labels of covered templates, and spans.

    ``templates`` are (label, text) pairs or a table of them (see :func:`texts_of`). ``score`` is 1 where a phrase
    stands, else the largest covered part of a template, 0 without any. ``spans`` has every place of a phrase
    and every chain that covers ``COVER`` of its template, by first word.
    A null or empty text has no words, no labels and score 0, first and last word null; a null key
    stays null; repeated rows are scanned each; an empty table gives no rows.
    """
    machine = Automaton(phrases, texts_of(templates) if isinstance(templates, DataFrame) else templates)

    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                w = words(s, ALNUM)
                rows: dict[int, tuple[list, list]] = {}
                for row, first, symbols in known(w, machine.vocabulary, machine.shortest):
                    base, matches = rows.setdefault(row, ([], []))
                    machine.stream(symbols, first - int(w.bounds[row]), base, matches)
                out = [verdict(machine, *rows.get(row, ((), ()))) for row in range(s.rows)]
                span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), pa.list_(span))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows), pa.array(np.diff(w.bounds)),
                     *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return only(docs, key, text).mapInArrow(run, SCHEMA)


def verdict(machine: Automaton, base, matches) -> tuple:
    """The columns of a text behind its number of words."""
    chains = machine.chains(matches)
    covered = [c for c in chains if c[3] >= COVER]
    names = {machine.templates[t].label for t, _ in base}
    starts = [p for _, p in base]
    spans = sorted([(p, p + machine.templates[t].length, machine.templates[t].label, 1.0) for t, p in base]
                   + [(a, b, machine.templates[t].label, c) for t, a, b, c in covered])
    return (len(base), min(starts, default=None), max(starts, default=None), sorted(names),
            sorted(names | {machine.templates[c[0]].label for c in covered}), 1.0 if base else max((c[3] for c in chains), default=0.0),
            [{"label": label, "first_word": a, "end_word": b, "cover": c} for a, b, label, c in spans])
