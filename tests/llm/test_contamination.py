import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattledger.llm import contamination as C
from wattledger.llm.words import ALNUM, slices, words

from .conftest import alnum, given, same_rows


def brute(text, items, size):
    w, hit, found = alnum(text), set(), set()
    for item, body in items:
        own = alnum(body)
        for a in range(max(1, len(own) - size + 1) if own and item is not None else 0):
            p = own[a:a + size]
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit |= set(range(k, k + len(p)))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(12))
def test_hits_against_brute_force(seed):
    draw = random.Random(seed)
    pool, size = "a b c É9 the X".split(), draw.choice([2, 3, 4])
    items = [(draw.choice(["1", "2", "10", None, "é"]), draw.choice([None, "", " ".join(draw.choices(pool, k=draw.randrange(8)))]))
             for _ in range(6)]
    given_ = [draw.choice([None, "", "-", " ".join(draw.choices([*pool, "zz"], k=draw.randrange(60))), "a " * draw.randrange(1, 90)])
              for _ in range(40)]
    blocks = [C.phrases(items[:3], size), C.phrases(items[3:], size)]
    for s in slices(pa.array(given_, pa.string()), lower=True, size=draw.choice([100, 100_000])):
        w, _, found, n_hit = C.hits(s, blocks)
        for i in range(s.rows):
            assert (w.bounds[i + 1] - w.bounds[i], n_hit[i], found[i]) == brute(given_[s.first + i], items, size)


def test_suffix_array_and_ranks():
    draw = random.Random(5)
    for _ in range(30):
        text = np.array([draw.randrange(4) for _ in range(draw.randrange(1, 60))] + [0], dtype=np.int64)
        ends = np.cumsum(text == 0)
        # every 0 is a symbol of its own, smaller than all others and in order of place
        key = [tuple((0, int(ends[j])) if text[j] == 0 else (1, int(text[j])) for j in range(i, len(text))) for i in range(len(text))]
        assert C.suffix_array(text).tolist() == sorted(range(len(text)), key=key.__getitem__)
        tree = C.Wavelet(text, 3)
        at = np.arange(len(text) + 1)
        for c in range(4):
            assert tree.rank(np.full_like(at, c), at).tolist() == np.concatenate([[0], np.cumsum(text == c)]).tolist()


def test_scan_of_a_table(spark, docs, monkeypatch):
    rows = given(docs)
    items = [(3, " ".join(alnum(rows[13][1])[20:60])), (20, "one"), (100, None), (None, "two words"), (7, rows[21][1][200:900])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in rows:
        n, hit, found = brute(t, [(None if a is None else str(a), b) for a, b in items], 13)
        want.append((i, n, hit, found, hit > 0 and 20 * hit >= n))
    dirty = {w[0] for w in want if w[4]}
    spans = []
    # one pass, several, and stretches of a text in different blocks
    for block, size in ((1 << 20, 1 << 14), (60, 1 << 14), (40, 30)):
        monkeypatch.setattr(C, "SEGMENT_WORDS", size)
        parts, blocks = C.blocks_of(bench, "item_id", "text", 13, block)
        assert (blocks == 1) == (block > 1000) and (blocks >= 3) == (block < 1000)
        got = C.scan(docs, bench, block_words=block)
        assert got.columns == ["doc_id", "n_words", "n_hit", "items", "spans", "contaminated"]
        same_rows([tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()], want)
        spans.append(sorted((repr(r["doc_id"]), repr(r["spans"])) for r in got.collect()))
        for r in got.collect():
            assert sum(s["end_word"] - s["first_word"] for s in r["spans"]) == r["n_hit"]
        left = C.clean(docs.withColumn("row", F.lit("mine")), bench, block_words=block)
        assert left.columns == [*docs.columns, "row"]
        same_rows([tuple(r)[:-1] for r in left.collect()], [tuple(r) for r in docs.collect() if r["doc_id"] not in dirty])
    assert spans[0] == spans[1] == spans[2]


def test_the_driver_sees_one_block_at_a_time(spark, docs, monkeypatch):
    """No benchmark text reaches the driver, and of the hashes one block at a time."""
    bench = spark.range(50).selectExpr("id as item_id", "concat_ws(' ', transform(sequence(0, 39), i -> concat('w', (id * 40 + i) % 1500))) as text")
    seen = []
    windows_of = C.windows_of
    monkeypatch.setattr(C, "windows_of", lambda parts, window: (seen.append(sum(len(h) for _, h in parts)), windows_of(parts, window))[1])
    C.scan(docs, bench, block_words=200).collect()
    assert len(seen) >= 3 and max(seen) <= 400 and sum(seen) == 50 * 40


def test_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert C.scan(empty, bench).count() == 0
    assert C.scan(docs, bench).where("n_hit > 0 OR contaminated").count() == 0
