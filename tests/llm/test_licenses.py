import random

import pyarrow as pa
import pytest

from wattledger.llm import licenses as L
from wattledger.llm.words import ALNUM, slices, words

from .conftest import alnum, given


WHOLE = dict(reversed(L.TEXTS))


def places(words_, phrases):
    return sorted((k, a) for k, (p, _) in enumerate(phrases) for a in range(len(words_)) if words_[a:a + len(p.split())] == p.split())


@pytest.mark.parametrize("seed", range(10))
def test_matching_statistics_and_phrases(seed, monkeypatch):
    draw = random.Random(seed)
    monkeypatch.setattr(L, "LONG", draw.choice([2, 3]))
    pool = "a b c d e".split()
    for _ in range(25):
        phrases = tuple((" ".join(draw.choices(pool, k=draw.randrange(1, 5))), f"p{i}") for i in range(3))
        templates = tuple((f"t{i}", " ".join(draw.choices(pool, k=draw.randrange(1, 13)))) for i in range(3))
        machine = L.Automaton(phrases, templates)
        held = [t.split() for t in [*(p for p, _ in phrases), *(t for _, t in templates)]]
        runs = {tuple(v[i:j]) for v in held for i in range(len(v)) for j in range(i + 1, len(v) + 1)}
        texts = [" ".join(draw.choices([*pool, "zz"], k=draw.randrange(30))) for _ in range(5)]
        for s in slices(pa.array(texts), lower=True):
            w, got = words(s, ALNUM), {}
            for row, first, symbols in L.known(w, machine.vocabulary, machine.shortest):
                machine.stream(symbols, first - int(w.bounds[row]), *got.setdefault(row, ([], [])))
            for i, text in enumerate(texts):
                own = text.split()
                base, matches = got.get(i, ([], []))
                assert sorted(base) == places(own, phrases)
                longest = [next(n for n in range(e, -1, -1) if not n or tuple(own[e - n:e]) in runs) for e in range(1, len(own) + 1)]
                ended = [(e + 1 - n, n) for e, n in enumerate(longest)
                         if n >= machine.shortest and (e + 1 == len(own) or longest[e + 1] != n + 1)]
                assert [m[:2] for m in matches] == ended


def test_scan_of_awkward_documents(spark, docs, empty):
    extra = [(900, "x Under the MIT-License. under the mit license"), (901, "CC BY-NC 4.0 and Apache License, Version 2.0"),
             (902, WHOLE["mit"].upper()), (903, "the the the license of the"),
             (904, " ".join(alnum(WHOLE["bsd"])[:12] + ["odd"] * 3 + alnum(WHOLE["bsd"])[12:])),
             (905, " then ".join([WHOLE["isc"], "under the mit license", WHOLE["isc"]]))]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in L.scan(df).collect()}
    for i, t in given(df):
        own = alnum(t)
        at = [a for _, a in places(own, L.PHRASES)]
        labels = sorted({L.PHRASES[k][1] for k, _ in places(own, L.PHRASES)})
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(own), len(at), min(at, default=None), max(at, default=None), labels)
        assert set(labels) <= set(r["labels"]) and 0 <= r["score"] <= 1
    assert got[902]["labels"] == ["mit"] and got[902]["score"] == 1 and got[902]["spans"][0]["first_word"] == 0
    assert got[904]["labels"] == ["bsd"] and got[904]["spans"][0]["end_word"] == len(alnum(extra[4][1]))
    isc = len(alnum(WHOLE["isc"]))
    assert [(x["label"], x["first_word"], x["end_word"]) for x in got[905]["spans"]] == [
        ("isc", 0, isc), ("mit", isc + 1, isc + 5), ("isc", isc + 6, 2 * isc + 6)]
    assert got[903]["labels"] == [] and got[901]["base_labels"] == ["apache-2", "cc-by-nc"]
    assert L.scan(empty).count() == 0


def brute(own, phrases, templates):
    """Labels, score and spans of words, from all runs of all templates."""
    held = [("p", label, p.split()) for p, label in phrases] + [("t", label, t.split()) for label, t in templates]
    shortest = min(len(v) if kind == "p" else min(len(v), L.LONG) for kind, _, v in held)

    def ends(run, v):
        return [j for j in range(len(run), len(v) + 1) if v[j - len(run):j] == run]

    longest = [next(n for n in range(e, -1, -1) if not n or any(ends(own[e - n:e], v) for _, _, v in held)) for e in range(1, len(own) + 1)]
    matches = [(e + 1 - n, n) for e, n in enumerate(longest) if n >= shortest and (e + 1 == len(own) or longest[e + 1] != n + 1)]
    spans = [(a, a + len(p.split()), label, 1.0) for p, label in phrases for a in range(len(own)) if own[a:a + len(p.split())] == p.split()]
    names, best = {s[2] for s in spans}, 0.0
    for label, text in templates:
        v, chains = text.split(), []
        for first, n in matches:
            at = ends(own[first:first + n], v)
            if not at or n < min(L.LONG, len(v)):
                continue
            on = [e for e in at if chains and first - chains[-1][1] <= L.GAP and e > chains[-1][2]]
            if on:
                chains[-1][3] += min(n, on[0] - chains[-1][2])
                chains[-1][1:3] = first + n, on[0]
            else:
                chains.append([first, first + n, at[0], n])
        for first, end, _, n in chains:
            cover = min(1.0, n / len(v))
            best = max(best, cover)
            if cover >= L.COVER:
                spans.append((first, end, label, cover))
    base = {s for s in names}
    return sorted(names | {s[2] for s in spans}), 1.0 if base else best, sorted(spans)


@pytest.mark.parametrize("seed", range(8))
def test_labels_score_and_spans_against_brute_force(seed, monkeypatch):
    draw = random.Random(100 + seed)
    monkeypatch.setattr(L, "LONG", draw.choice([2, 3]))
    monkeypatch.setattr(L, "GAP", draw.choice([0, 2, 6]))
    pool = "a b c d e f".split()
    many = 0
    for _ in range(40):
        phrases = tuple((" ".join(draw.choices(pool, k=draw.randrange(2, 5))), f"p{i}") for i in range(2))
        templates = tuple((f"t{i % 2}", " ".join(draw.choices(pool, k=draw.randrange(2, 12)))) for i in range(3))
        machine = L.Automaton(phrases, templates)
        parts = [t.split() for _, t in templates] + [p.split() for p, _ in phrases] + [["zz"], ["a"]]
        texts = []
        for _ in range(4):
            own = [w for _ in range(draw.randrange(1, 7)) for w in draw.choice(parts)]
            texts.append(" ".join(w if draw.random() > 0.05 else "zz" for w in own))
        for s in slices(pa.array(texts), lower=True):
            w, got = words(s, ALNUM), {}
            for row, first, symbols in L.known(w, machine.vocabulary, machine.shortest):
                machine.stream(symbols, first - int(w.bounds[row]), *got.setdefault(row, ([], [])))
            for i, text in enumerate(texts):
                found = L.verdict(machine, *got.get(i, ([], [])))
                labels, score, spans = brute(text.split(), phrases, templates)
                assert (found[4], found[5]) == (labels, score)
                assert [(x["first_word"], x["end_word"], x["label"], x["cover"]) for x in found[6]] == spans
                many += len(spans) > 2
    assert many > 10


def test_templates_from_a_table(spark, monkeypatch):
    table = spark.createDataFrame([("own", "one two three four five six"), (None, "x"), ("gone", None)], "label string, text string")
    docs = spark.createDataFrame([(1, "One two three four five six. One two three four five six"), (2, WHOLE["mit"])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.scan(docs, templates=table).collect()}
    assert [(s["label"], s["first_word"], s["end_word"]) for s in got[1]["spans"]] == [("own", 0, 6), ("own", 6, 12)] and got[2]["labels"] == []
    monkeypatch.setattr(L, "TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError, match="27 bytes"):
        L.scan(docs, templates=table)


def test_every_text_is_found_in_itself():
    machine = L.Automaton(L.PHRASES, L.TEXTS)
    for label, text in L.TEXTS:
        for s in slices(pa.array([text]), lower=True):
            w, base, matches = words(s, ALNUM), [], []
            for _, first, symbols in L.known(w, machine.vocabulary, machine.shortest):
                machine.stream(symbols, first, base, matches)
            found = L.verdict(machine, base, matches)
            assert label in found[4] and any(x["label"] == label and x["first_word"] == 0 and x["cover"] == 1 for x in found[6])
