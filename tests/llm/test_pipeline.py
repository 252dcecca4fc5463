import random

from pyspark.sql import functions as F

import corpus_pipeline
from wattledger.llm import quality

from .conftest import alnum, given
from .test_contamination import brute as contaminated
from .test_jaccard import brute as classes
from .test_quality import brute as judged


def corpus(spark, folder):
    draw = random.Random(2)
    pool = ["".join(draw.choices(["an", "th", "er", "in", "on", "re", "ly"], k=draw.randrange(1, 4))) for _ in range(500)]
    rows = [(i, " ".join(draw.choices(pool, k=draw.randrange(30, 300)))) for i in range(40)]
    bench = [(i, " ".join(draw.choices(pool, k=25))) for i in range(3)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200 + i, rows[i][1] + " tail") for i in range(8)]
    rows += [(300 + i, rows[20 + i][1] + " " + bench[i][1]) for i in range(3)] + [(310, bench[0][1])]
    rows += [(400, "again and again " * 60), (401, None), (402, "short"), (None, rows[30][1][::-1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(*r, "en", "src", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return bench


def one_of_each(rows):
    """The rows that stay: of each class of rows that one with the smallest doc_id, rows numbered in the order of their ids."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return [ordered[k] for k, _, c in classes([(k, t) for k, (_, t) in enumerate(ordered)]) if k == c]


def test_near_duplicates_decides_by_row(spark):
    draw = random.Random(4)
    a, b, c = (" ".join(f"w{draw.randrange(500)}" for _ in range(40)) for _ in range(3))
    rows = [(5, a, 77), (5, b, 79), (3, b, 1), (None, c, 2), (None, c, 3), (None, c + " tail", 4), (8, None, 5), (8, "", 6), (9, a + " tail", 7), (5, a, 77)]
    df = spark.createDataFrame([(*r, r[2], "x") for r in rows], "doc_id long, text string, _copy int, row int, class string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert all(r["_copy"] == r["row"] and r["class"] == "x" for r in got.collect())
    assert sorted(kept, key=repr) == sorted(kept_of([(5, a), (3, b), (8, None), (8, "")], [(None, c), (None, c + " tail")], kept), key=repr)


def kept_of(sure, one_of, kept):
    """The rows that must stay, and the one of several that did."""
    return sure + [next(x for x in kept if x in one_of)]


def test_every_stage_against_brute_force(spark, tmp_path):
    bench = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_duplicates", "decontamination", "best_fit_packing"]

    kept = steps["quality_rules"](spark, docs, str(tmp_path))
    rows = [r for r in given(docs) if judged(r[1])[-1]]
    assert sorted(map(repr, given(kept))) == sorted(map(repr, rows)) and kept.columns == docs.columns

    single = steps["near_duplicates"](spark, kept, str(tmp_path))
    want = one_of_each(rows)
    assert sorted(map(repr, given(single))) == sorted(map(repr, want)) and single.columns == docs.columns
    assert single.where("doc_id IS NULL").count() == 1 and len(want) < len(rows) - 1

    clean = steps["decontamination"](spark, single, str(tmp_path))
    items = [(str(i), t) for i, t in bench]
    want = [(i, t) for i, t in given(single) if (h := contaminated(t, items, 13))[1] == 0 or 20 * h[1] < h[0]]
    assert sorted(map(repr, given(clean))) == sorted(map(repr, want)) and clean.columns == docs.columns and 310 not in dict(want)

    packed = steps["best_fit_packing"](spark, clean, str(tmp_path))
    assert {r[0] for r in packed.select("doc_id").collect()} == {i for i, _ in want}


def test_run_is_the_chain_of_its_stages(spark, tmp_path):
    corpus(spark, tmp_path)
    got = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, docs.select(columns).collect()))


def test_empty_corpus(spark, tmp_path):
    corpus(spark, tmp_path / "full")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
