import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.ann import nearest

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("vec_id", T.LongType()), ("embedding", T.ArrayType(T.DoubleType())), ("key", T.StringType()), ("block", T.LongType()))])


def brute(rows, query, k):
    x = {i: np.array(v) for i, v in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all() and np.any(v)}
    if query not in x:
        return []
    return sorted(((-float(v @ x[query]), i) for i, v in x.items() if i != query))[:k]


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # many copies of one vector
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None, *[0.0] * 6]), (404, [float("nan")] + [1.0] * 7), (405, [float("inf")] + [1.0] * 7), (406, [1.0, 2.0])]
    vectors = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows] + [(5, rows[5][1], None, None)], SCHEMA).repartition(3)
    queries = vectors.where("vec_id % 20 = 0").dropDuplicates(["vec_id"])
    got = {}
    for r in nearest(vectors, queries, k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in [i for i, _ in rows if i % 20 == 0]:
        want = brute(rows, q, 20)
        mine = sorted(got.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(want) + 1))
        assert np.allclose([-w[0] for w in want], [m[2] for m in mine])
        assert [w[1] for w in want] == [m[1] for m in mine]


def test_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 24)) * rng.uniform(0.5, 2, (4000, 1))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    hit = 0
    for r in nearest(vectors, vectors.where("vec_id % 100 = 0"), k=20).collect():
        s = x @ x[r["query_id"]]
        s[r["query_id"]] = -np.inf
        hit += r["vec_id"] in np.argsort(-s)[:20]
    assert hit / (40 * 20) >= 0.9


@pytest.mark.parametrize("share", [0.02, 1 / 3])
def test_recall_beside_a_tight_cluster(spark, share):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((10_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tight = int(share * len(x))
    x[:tight] = x[0] + 0.1 * x[:tight]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    order = rng.permutation(len(x))
    inside, x = order < tight, x[order]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    asked = [*np.flatnonzero(inside)[:30].tolist(), *np.flatnonzero(~inside)[:60].tolist()]
    hit = dict.fromkeys(asked, 0)
    for r in nearest(vectors, vectors.where(F.col("vec_id").isin(asked)), k=20).collect():
        s = x @ x[r["query_id"]]
        s[r["query_id"]] = -np.inf
        hit[r["query_id"]] += r["vec_id"] in np.argsort(-s)[:20]
    assert sum(hit[i] for i in asked[:30]) / (30 * 20) >= 0.9
    assert sum(hit[i] for i in asked[30:]) / (60 * 20) >= 0.9


def test_recall_in_64_dimensions(spark):
    """Vectors without any clusters, the worst case: two thirds of them have to be scored."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    found = {}
    for r in nearest(vectors, vectors.where("vec_id % 200 = 0"), k=20).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hit = 0
    for i, mine in found.items():
        s = x @ x[i]
        s[i] = -np.inf
        assert len(mine) == 20
        hit += len(set(mine) & set(np.argsort(-s)[:20].tolist()))
    assert len(found) == 100 and hit / 2000 >= 0.9


def test_few_vectors(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 0.0], None, None), (2, [0.5, 0.5], None, None)], SCHEMA)
    assert [tuple(r) for r in nearest(two, two.where("vec_id = 1")).collect()] == [(1, 1, 2, 0.5)]
    one = two.where("vec_id = 1")
    assert nearest(one, one).collect() == []
