"""Whitening against a dense eigensolver and exact integers."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import registry, whitening

NAN, INF = float("nan"), float("inf")


def expected(rows, wanted=16):
    """(n, S, eigenvalues, directions, trace) from the whole matrix."""
    x = np.array(sorted({tuple(int(np.floor(64.0 * c)) + 1000000 for c in v) for v in rows}), dtype=object)
    n, s = len(x), x.sum(axis=0)
    c = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(r, s, strict=True)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    return n, s, e[::-1][:wanted], u[:, ::-1][:, :wanted], e.sum()


def check(got, rows, wanted=16, tol=1e-9):
    """``got``: collected rows; ``rows``: id -> usable vectors."""
    n, s, e, u, trace = expected([v for _, v in rows], wanted)
    k = min(wanted, int((e > whitening.NO_DIRECTION * e[0]).sum()))
    assert len(got) == k * len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = None
    for vec_id, v in rows:
        x = [int(np.floor(64.0 * c)) + 1000000 for c in v]
        d = [n * a - b for a, b in zip(x, s, strict=True)]
        want = (np.array([float(Fraction(int(q), n)) for q in d]) @ u[:, :k]) / np.sqrt(e[:k])
        mine = by_id[vec_id]
        assert sorted(mine) == list(range(1, k + 1))
        have = np.array([mine[i].whitened for i in range(1, k + 1)])
        if signs is None:
            signs = np.where(np.abs(want) > 1e-6, np.sign(want * have), 0)
        signs = np.where(signs == 0, np.where(np.abs(want) > 1e-6, np.sign(want * have), 0), signs)
        assert np.abs(have - np.where(signs == 0, 1, signs) * want).max() < tol * max(1, np.abs(want).max())
        total = int(sum(q * q for q in d))
        assert all(m.deviation == (total if total < 2 ** 63 else None) and m.n == n for m in mine.values())
        for i in range(k):
            assert abs(mine[i + 1].explained - e[i] / trace) <= 1e-4 * e[i] / trace
            assert mine[i + 1].identity_error <= 1e-4


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_op11_equals_a_dense_solver(spark):
    dir_ = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{dir_}/embeddings.parquet").collect()
            if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(registry.op11_whitening(spark, dir_).collect(), rows)


def test_edge_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.standard_normal(6).astype(np.float32)]) for i in range(40)]
    good.append((40, good[3][1]))  # a repeated vector counts once in the fit and is returned twice
    rows = [*good, (50, None), (51, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (52, [NAN] * 6), (53, [INF, 0.0, 0.0, 0.0, 0.0, 0.0]),
            (54, []), (55, [1.0, 2.0])]
    df = frame(spark, rows).withColumns({c: F.lit(None).cast("string") for c in ("x", "n", "i", "component", "y0")})
    check(whitening.whiten(df).collect(), good)
    for bad in ([], rows[41:45], [(1, [0.5, 0.5])], [(1, None)], [(7, [])]):
        assert whitening.whiten(frame(spark, bad)).collect() == []
    both = whitening.whiten(frame(spark, [(None, [0.0, 1.0]), (None, [1.0, 0.0]), (3, [0.0, 1.0])])).collect()
    assert len(both) == 3 and sorted(abs(r.whitened) for r in both) == pytest.approx([1.0] * 3)


def test_large_and_flat(spark):
    """Entries far from each other, beyond a long when squared, and more dimensions than the block."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in np.float32(1e6) * rng.standard_normal(50).astype(np.float32)]) for i in range(300)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows, tol=1e-7)
    huge = [(i, [float(c) for c in np.float32(1e11) * rng.standard_normal(3).astype(np.float32)]) for i in range(20)]
    got = whitening.whiten(frame(spark, huge)).collect()
    assert any(r.deviation is None for r in got)
    check(got, huge, tol=1e-7)
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [3e38]), (2, [0.0])])).collect()


@pytest.mark.parametrize("name", ["decay", "flat", "repeated", "low rank", "two clusters"])
def test_iteration_finds_the_leading_pairs(name):
    rng = np.random.default_rng(0)
    x = {"decay": lambda: rng.standard_normal((2000, 200)) * 0.9 ** np.arange(200),
         "flat": lambda: rng.standard_normal((20000, 100)),
         "repeated": lambda: np.vstack((np.eye(80), -np.eye(80))),
         "low rank": lambda: rng.standard_normal((2000, 5)) @ rng.standard_normal((5, 90)),
         "two clusters": lambda: rng.standard_normal((5000, 64)) + 9 * rng.integers(0, 2, (5000, 1))}[name]()
    c = x - x.mean(axis=0)
    v = c.T @ c / len(c)
    values, directions, report = whitening.leading_pairs(lambda q: v @ q, len(v), 16)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:16]).max() < 1e-12 * values[0]
    assert np.abs(v @ directions - directions * values).max() < 1e-12 * values[0]
    assert np.abs(directions.T @ directions - np.eye(16)).max() < 1e-13
    assert report["passes"] < 200


def test_a_flat_start_widens_the_block():
    """Eigenvalues that differ in the sixth digit hardly separate: the block grows to all dimensions."""
    v = np.diag(1 + 1e-9 * np.arange(90.0))
    values, _, report = whitening.leading_pairs(lambda q: v @ q, 90, 16)
    assert np.allclose(values, np.diag(v)[::-1][:16], rtol=1e-14) and report["block"] <= 90
