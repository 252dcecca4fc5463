import math
import random
from fractions import Fraction

import numpy as np

from wattledger.llm import catalog, whitening


def brute(vectors, components=32):
    """Covariance, deviations and whitened values in whole numbers and fractions; numpy only decomposes."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    dev = [[n * a - b for a, b in zip(row, s)] for row in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in dev), n ** 3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], vectors[:, ::-1].T[:components]
    centred = np.array([[float(Fraction(a, n)) for a in row] for row in dev])
    return cov, [sum(a * a for a in row) for row in dev], centred @ axes.T / np.sqrt(values), values / np.trace(cov)


def table(spark, vectors, extra=()):
    rows = [(i, v, 0, 1.0) for i, v in enumerate(vectors)] + [(-1 - k, v, 0, 1.0) for k, v in enumerate(extra)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vector double").repartition(5)


def made(n, d, seed=3):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, d)) @ draw.normal(size=(d, d)) * draw.uniform(0.1, 20, d) + draw.normal(size=d) * 500
    return [[float(np.float32(c)) for c in row] for row in base]


def checked(got, vectors, n, components=32):
    cov, deviation, whitened, explained = brute(vectors, components)
    by = {}
    for r in got:
        by[r["vec_id"], r["component"]] = r
        assert r["n"] == n
    assert len(by) == len(got)
    for c in range(whitened.shape[1]):
        mine = np.array([by[i, c + 1]["whitened"] for i in range(len(vectors))])
        sign = 1 if mine @ whitened[:, c] > 0 else -1
        assert np.allclose(sign * mine, whitened[:, c], rtol=1e-6, atol=1e-6)
        assert abs(by[0, c + 1]["explained"] / explained[c] - 1) < 1e-9
    assert [by[i, 1]["deviation"] for i in range(len(vectors))] == deviation
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6


def test_against_whole_numbers(spark):
    vectors = made(300, 40)
    odd = [None, [], [None] * 40, [1.0] * 39 + [float("nan")], [float("inf")] + [0.0] * 39, [1.0, 2.0]]
    got = whitening.whiten(table(spark, vectors, odd)).collect()
    assert len(got) == 300 * 32 and {r["vec_id"] for r in got} == set(range(300))
    checked(got, vectors, 300)


def test_fewer_dimensions_than_components(spark):
    vectors = made(50, 3)
    got = whitening.whiten(table(spark, vectors)).collect()
    assert len(got) == 150
    checked(got, vectors, 50)


def test_small_spread_beside_a_large_offset(spark):
    # the spread is a few units in 64 million: plain sums of squares in doubles would lose it
    draw = random.Random(4)
    vectors = [[1_000_000.0 + draw.randrange(3) / 64 for _ in range(4)] for _ in range(400)]
    rows = [(i, v) for i, v in enumerate(vectors)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    checked(got, vectors, 400)


def test_huge_entries_stay_exact(spark):
    draw = random.Random(9)
    vectors = [[draw.uniform(-1, 1) * 2.0 ** 50, draw.uniform(-1, 1)] for _ in range(40)]
    rows = whitening.usable(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3), "vec_id", "embedding")
    fitted = whitening.fit(rows, 40)
    assert np.allclose(fitted.covariance, brute(vectors, 2)[0], rtol=1e-14)
    x = whitening.whole(__import__("pyarrow").array(vectors))
    assert fitted.deviation(x)[0] is None


def test_covariance_is_exact(spark):
    vectors = made(200, 6, seed=8)
    rows = whitening.usable(table(spark, vectors), "vec_id", "embedding")
    assert (whitening.fit(rows, 200).covariance == brute(vectors)[0]).all()


def test_no_variance_no_rows(spark):
    same = table(spark, [[1.0, 2.0]] * 5)
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(table(spark, [], [None, []])).count() == 0
    # one dimension repeats another: one component less, the others whole
    line = [[float(i), float(i), float(i % 3)] for i in range(30)]
    got = whitening.whiten(table(spark, line)).collect()
    assert len(got) == 60 and got[0]["identity_error"] < 1e-6 and got[0]["deviation"] is not None


def test_repeated_rows_and_null_keys_count(spark):
    vectors = made(20, 2)
    rows = [(None, vectors[0])] + list(enumerate(vectors)) + [(3, vectors[3])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 44 and all(r["n"] == 22 for r in got) and sum(r["vec_id"] == 3 for r in got) == 4


def test_query(spark):
    df = catalog.op13_whitening(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    vectors = [r["embedding"] for r in rows]
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    checked(df.collect(), vectors, len(rows))
