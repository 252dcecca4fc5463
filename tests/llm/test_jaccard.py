import random

import numpy as np
import pytest

from wattledger.llm import jaccard

from .conftest import given, lower, same_rows, spaced


def shingles(text, n=5):
    words = spaced(lower(text))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, percent=80):
    """The smallest doc_id reachable by links, for each row."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None) if sets[k] else i))
    return out


@pytest.mark.parametrize("cell", [4_000_000, 300])
def test_chains_hubs_and_blocks(spark, monkeypatch, cell):
    """Copies with random edits: chains of links, groups that share a passage, and components cut into blocks."""
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", cell)
    draw = random.Random(11)
    shared = [f"s{k}" for k in range(12)]
    rows = []
    for g in range(6):
        text = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(5, 90))]
        for _ in range(draw.randrange(1, 14)):
            text = list(text)
            text[draw.randrange(len(text))] = f"e{draw.randrange(400)}"
            rows.append((len(rows) * 3 % 101, " ".join(text + (shared if g % 2 else []))))
    rows += rows[:5] + [(500, " ".join(shared)), (501, " ".join(shared)), (502, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same_rows([tuple(r) for r in jaccard.linked(df).collect()], brute_links(rows))


@pytest.mark.parametrize("stride", [1, 3, 64])
def test_trie_join_against_all_pairs(monkeypatch, stride):
    monkeypatch.setattr(jaccard, "STRIDE", stride)
    draw = random.Random(stride)
    for _ in range(150):
        size, percent = draw.choice([6, 20, 60]), draw.choice([50, 80, 100])
        base = [draw.sample(range(size), draw.randrange(1, size + 1)) for _ in range(3)]
        made = {}
        for _ in range(draw.randrange(1, 25)):
            s = set(draw.choice(base))
            for _ in range(draw.randrange(4)):
                s ^= {draw.randrange(size)}
            if s:
                made[tuple(sorted(s))] = np.array(sorted(s), dtype=np.uint64)
        sets = list(made.values())
        want = {(i, j) for i in range(len(sets)) for j in range(i)
                if 100 * len(set(sets[i].tolist()) & set(sets[j].tolist())) >= percent * len(set(sets[i].tolist()) | set(sets[j].tolist()))}
        got = [(max(i, j), min(i, j)) for i, found in jaccard.linked_sets(sets, percent) for j in found.tolist()]
        assert len(got) == len(want) and set(got) == want


def test_the_order_of_frequent_shingles_changes_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_IN_SLICE", 2)
    same_rows([tuple(r) for r in jaccard.linked(docs).collect()], brute_links(given(docs)))


def test_sets_with_one_digest_are_told_apart_by_the_second(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "DIGEST_BITS", 2)
    same_rows([tuple(r) for r in jaccard.linked(docs).collect()], brute_links(given(docs)))
    members, pairs = jaccard.links(docs)
    sets = {}
    texts = dict(given(docs))
    for r in members.collect():
        sets.setdefault(r["entity"], set()).add(shingles(texts[r["doc_id"]]))
    assert all(len(x) == 1 for x in sets.values()) and pairs.count() >= 1


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id + 1 as low", "id as high")
    assert {tuple(r) for r in jaccard.components(edges).collect()} == {(i, 0) for i in range(201)}


def brute_links(rows, percent=80):
    """The rows of brute() with the number of other rows that link with each."""
    sets = [shingles(t) for _, t in rows]
    link = lambda a, b: bool(a and b) and 100 * len(a & b) >= percent * len(a | b)
    return [(*r, sum(link(sets[k], s) for j, s in enumerate(sets) if j != k)) for k, r in enumerate(brute(rows, percent))]


def test_links_agree_with_brute_force(docs, empty):
    same_rows([tuple(r) for r in jaccard.linked(docs).collect()], brute_links(given(docs)))
    assert jaccard.linked(empty).collect() == []


@pytest.mark.parametrize("cell", [4_000_000, 1000, 300])
def test_no_link_within_a_group_is_lost_or_counted_twice(spark, monkeypatch, cell):
    """Near copies with different texts, all linked with many others, in one cell, two blocks and many blocks."""
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", cell)
    draw = random.Random(21)
    rows = []
    for size in (3, 25):
        base = [f"w{draw.randrange(900)}" for _ in range(70)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randrange(3)):
                text[draw.randrange(len(text))] = f"e{draw.randrange(900)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(90, rows[4][1]), (91, rows[4][1]), (None, rows[5][1]), (92, ""), (93, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_links(rows)
    same_rows([tuple(r) for r in jaccard.linked(df).collect()], want)
    assert sum(r[3] for r in want) > 4 * len(rows)

    members, pairs = jaccard.links(df)
    entity = {r["entity"]: [] for r in members.collect()}
    for r in members.collect():
        entity[r["entity"]].append(r["doc_id"])
    got = [tuple(r) for r in pairs.collect()]
    sets = list({shingles(t) for _, t in rows if t})
    links = sum(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert len(got) == len(set(got)) == links and all(a < b and {a, b} <= set(entity) for a, b in got)


def test_hot_keys_are_joined_apart_from_their_sums(spark):
    """Both sides of the joins on shingle, node and class come straight from shuffles, so adaptive execution can split them."""
    posted = spark.createDataFrame([(-5, i) for i in range(50)] + [(7, i) for i in range(3)], "shingle long, entity long")
    assert {tuple(r) for r in jaccard.stars(posted).collect()} == {(0, i) for i in range(1, 50)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard.stars(posted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(shingle" in line]
    assert sum("_mix" not in x and "_groupingexpression" not in x for x in dealt) >= 2 and any("_groupingexpression" in x or "_mix" in x for x in dealt)
