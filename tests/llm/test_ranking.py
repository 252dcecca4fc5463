import math
import random

import duckdb
import numpy as np
import pytest

from wattledger.llm import catalog, ranking

from .conftest import alnum, given, same_rows


def brute(docs, items, top=50):
    """Every document scored for every item by the rule as it stands."""
    texts = [(d, alnum(t)) for d, t in docs]
    texts = [(d, w) for d, w in texts if w]
    n, total = len(texts), sum(len(w) for _, w in texts)
    df, tfs = {}, []
    for _, w in texts:
        tf = {}
        for t in w:
            tf[t] = tf.get(t, 0) + 1
        tfs.append(tf)
        for t in tf:
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(alnum(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for (d, w), tf in zip(texts, tfs):
            m = 50 + 50 * len(w) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if t in tf)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return out


def corpus(spark, n=1500, seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 5, 30, 200]))), "x", 1) for i in range(n)]
    docs += [(i, docs[i % 7][1], "x", 1) for i in range(n, n + 100)]  # equal scores
    docs += [(None, docs[3][1], None, None), (5, docs[5][1], "x", 1), (n + 200, None, "x", 1), (n + 201, " .. ", "x", 1)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 20])))) for i in range(25)]
    items += [(2, "w1 w2 again"), (None, "w1 w3"), (None, "w4"), (90, None), (91, "nowhere to be found"), (92, ""), (93, "W1, w1; W1")]
    return (spark.createDataFrame(docs, "doc_id long, text string, item_id string, score int").repartition(5),
            spark.createDataFrame(items, "item_id long, text string").repartition(2))


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("top", [50, 7])
def test_against_brute_force(spark, top):
    docs, items = corpus(spark)
    want = brute(given(docs), [(r["item_id"], r["text"]) for r in items.collect()], top)
    same_rows(rows(ranking.search(docs, items, top=top)), want)


def test_small_shards_and_blocks(spark, monkeypatch):
    # blocks of few documents are skipped, and shards of few postings carry the least score on
    docs, items = corpus(spark, seed=2)
    want = brute(given(docs), [(r["item_id"], r["text"]) for r in items.collect()], 5)
    got = search_in_small_parts(docs, items, 5)
    same_rows(got, want)


def search_in_small_parts(docs, items, top):
    """The tasks' search over shards of 500 postings and blocks of 16 documents, run here."""
    import pyarrow as pa
    texts = [(d, alnum(t)) for d, t in given(docs)]
    texts = [(d, w) for d, w in texts if w]
    asked = {}
    for r in items.collect():
        asked.setdefault(r["item_id"], set()).update(alnum(r["text"]))
    known = {t: i for i, t in enumerate(sorted({t for terms in asked.values() for t in terms}))}
    n, total = len(texts), sum(len(w) for _, w in texts)
    df = np.zeros(len(known), int)
    forward = []
    for d, w in texts:
        here = sorted({known[t] for t in w if t in known})
        names = {v: k for k, v in known.items()}
        df[here] += 1
        forward.append({"doc_id": d, "n": len(w), "terms": here, "tfs": [w.count(names[t]) for t in here]})
    weights = np.array([ranking.weight(n, int(c)) if c else 0 for c in df])
    lists = [np.array(sorted(known[t] for t in terms), dtype=int) for terms in asked.values()]
    old = ranking.SHARD_POSTINGS, ranking.BLOCK_DOCS, ranking.FEW
    ranking.SHARD_POSTINGS, ranking.BLOCK_DOCS, ranking.FEW = 500, 16, 3
    skipped = []
    try:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
        batches = pa.Table.from_pylist(forward, schema).to_batches(max_chunksize=200)
        best = [ranking.Best() for _ in lists]
        for shard, ids, absent in ranking.shards(batches, weights, n, total):
            for terms, b in zip(lists, best):
                before = shard.block
                shard.block = lambda k, *a, before=before: (skipped.append(k), before(k, *a))[1]
                shard.search(terms, b, top)
                shard.block = before
        blocks = sum(s.blocks for s, _, _ in ranking.shards(batches, weights, n, total)) * len(lists)
    finally:
        ranking.SHARD_POSTINGS, ranking.BLOCK_DOCS, ranking.FEW = old
    assert 0 < len(skipped) < blocks  # not every block is worked through
    return [(i, r, None if gone else int(d), int(s)) for i, b in zip(asked, best) for r, (d, gone, s) in enumerate(zip(b.ids, b.absent, b.scores), 1)]


def test_items_in_several_passes(spark):
    docs, items = corpus(spark, n=200)
    want = brute(given(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    same_rows(rows(ranking.search(docs, items, block_pairs=40)), want)


def test_awkward_texts_and_empty_tables(docs, empty, spark):
    items = docs.select("doc_id", "text", "lang").toDF("item_id", "text", "doc_id")
    listed = given(docs)
    same_rows(rows(ranking.search(docs, items)), brute(listed, listed))
    none = items.limit(0)
    assert ranking.search(docs, none).count() == 0 and ranking.search(empty, items).count() == 0 and ranking.search(empty, none).count() == 0


def test_whole_numbers_beyond_a_long():
    n = np.array([1, 10 ** 9])
    tf = np.array([1, 7])
    got = ranking.parts(tf, n, 10 ** 10, 10 ** 11)
    want = [10 ** 9 * t // (1000 * t + 20 * (50 + 50 * a * 10 ** 10 // 10 ** 11)) for t, a in zip([1, 7], [1, 10 ** 9])]
    assert got.tolist() == want


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    same_rows(rows(catalog.op12_ranking(spark, "/root/testdata/sf0.001").select("item_id", "rank", "doc_id", "score")),
              con.execute(f"SELECT item_id, rank, doc_id, score FROM ({catalog.SQL['op12_ranking']})").fetchall())
