"""Nearest neighbours: exactness of what is returned, recall, edges."""

import random

import numpy as np
from pyspark.sql import functions as F

from tillsight.llm import nearest, registry


def brute(ids, x, query, k):
    q = x[ids == query][0]
    score = np.sqrt(((x - q) ** 2).sum(1))
    near = [i for i in np.lexsort((ids, score)) if ids[i] != query][:k]
    return [(int(ids[i]), float(score[i])) for i in near]


def test_op8_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>")).collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = {}
    for r in registry.op8_nearest(spark, sf).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == [i for i in sorted(ids.tolist()) if i % 100 == 0]
    hits = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11))
        truth = brute(ids, x, q, len(ids))
        assert all(dict(truth)[v] == s for _, v, s in got)
        assert [(s, v) for _, v, s in got] == sorted((s, v) for _, v, s in got)
        hits += len({v for _, v, _ in got} & {v for v, _ in truth[:10]})
    assert hits >= 0.9 * 10 * len(found)


def test_many_copies_and_unusable_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [rng.gauss(0, 1) for _ in range(3)]) for i in range(3000)]
    rows += [(10_000, None), (10_100, [0.0, 0.0, 0.0]), (10_200, [1.0, None, 2.0]), (10_300, [1.0, float("nan"), 0.0]),
             (10_400, [1.0, float("inf"), 0.0]), (10_500, [1.0, 2.0]), (10_600, []), (None, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("clash"))
    got = nearest.nearest(df, F.col("vec_id") % 100 == 0, block_rows=100, block_queries=3, recall=1.0).collect()
    good = [(i, v) for i, v in rows[:3000]]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    assert {r.query_id for r in got} == {i for i in range(0, 3000, 100)}
    for q in range(0, 3000, 100):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [(v, s) for _, v, s in mine] == brute(ids, x, q, 10)


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], schema)
    got = nearest.nearest(three, F.col("vec_id") % 100 == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, 1.0), (2, 2, 3.0)]
    assert nearest.nearest(three.limit(0), F.lit(True)).count() == 0
    assert nearest.nearest(three, F.col("vec_id") > 5).count() == 0
    alone = three.limit(1)
    assert nearest.nearest(alone, F.lit(True)).count() == 0
    twice = three.union(three)
    assert len(nearest.nearest(twice, F.col("vec_id") == 0).collect()) == 4


def test_tree_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(2000, 8))
    tree = nearest.fit_tree(x)
    leaves = tree.assign(x)
    assert tree.leaves > 20 and set(leaves.tolist()) <= set(range(tree.leaves))
    order = list(tree.visit(x[5]))
    assert sorted(order) == list(range(tree.leaves)) and leaves[5] in order[:3]
    same = nearest.fit_tree(np.ones((500, 4)))
    assert same.leaves == 1 and list(same.visit(np.ones(4))) == [0]
