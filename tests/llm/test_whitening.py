"""Whitening against exact integers and a plain eigendecomposition."""

from __future__ import annotations

import math
import os
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientbook.llm import whitening as w

DATA = "/root/testdata/sf0.01"
KIND = "vec_id bigint, embedding array<double>"


def exact(vectors):
    """(x, sums, covariance as fractions) by the definition, in Python integers."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    apart = [[n * row[d] - sums[d] for d in range(dims)] for row in x]
    cov = [[Fraction(sum(a[i] * a[j] for a in apart), n**3) for j in range(dims)] for i in range(dims)]
    return x, sums, cov


@pytest.mark.parametrize("top", [0, 1, 5, 2**11, 2**25, 2**40, 2**61])
@pytest.mark.parametrize("rows", [1, 63, 64, 65, 700])
def test_cross_products_are_exact(top, rows):
    draw = np.random.default_rng(rows)
    block = draw.integers(0, top + 1, (rows, 5))
    plain = block.astype(object)
    assert (w.cross_products(block).astype(object) == plain.T @ plain).all()


@pytest.mark.parametrize("low,high", [(0, 1), (-500, 500), (-(2**40), 2**40), (-(2**62), 2**62), (7, 8)])
def test_scatter_of_blocks_adds_up(low, high):
    draw = np.random.default_rng(3)
    block, total = draw.integers(low, high, (900, 4)), w.Scatter(4)
    for start in range(0, 900, 250):
        total.add(block[start : start + 250])
    plain = block.astype(object)
    assert total.n == 900 and (total.sums == plain.sum(axis=0)).all()
    assert (total.products == plain.T @ plain).all()


def compared(spark, rows, parts=3):
    df = spark.createDataFrame(rows, KIND).repartition(parts)
    return [r.asDict() for r in w.whitened(df, w.fit(df)).collect()]


def test_against_the_definition(spark):
    draw = np.random.default_rng(5)
    mixing = draw.normal(size=(11, 11))
    vectors = (draw.normal(size=(300, 11)) @ mixing * 0.3).tolist()
    rows = compared(spark, list(enumerate(vectors)))
    x, sums, cov = exact(vectors)
    n = len(x)
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(sum(cov[i][i] for i in range(11)))
    assert len(rows) == n * 8
    found = np.empty((n, 8))
    for r in rows:
        i, k = r["vec_id"], r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[i], sums))
        assert int(r["deviation_exact"]) == r["deviation"]
        assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9
        found[i, k] = r["whitened"]
    plain = (np.array(x) - np.array(sums) / n) @ axes[:, :8] / np.sqrt(values[:8])
    for k in range(8):
        sign = np.sign((plain[:, k] * found[:, k]).sum())
        assert np.abs(plain[:, k] * sign - found[:, k]).max() < 1e-8
    assert np.abs(np.cov(found.T, bias=True) - np.eye(8)).max() < 1e-9


def test_partitions_and_order_change_nothing(spark):
    draw = np.random.default_rng(6)
    vectors = [(i, v) for i, v in enumerate(draw.normal(size=(200, 5)).tolist())]
    one, other = (sorted(compared(spark, v, p), key=lambda r: (r["vec_id"], r["component"])) for v, p in ((vectors, 1), (vectors[::-1], 7)))
    assert one == other


def test_awkward_rows(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [0.5, -2.0, 3.0]), (2, [0.5, -2.0, 3.0]), (None, [0.25, 9.0, 3.0]),
        (3, None), (4, [None, 1.0, 2.0]), (5, [float("nan"), 1.0, 2.0]), (6, [float("inf"), 1.0, 2.0]), (7, [1e300, 0.0, 0.0]),
        (8, []), (9, [4.0]), (10, [5.0, 6.0]), (11, [5.0, 7.0]),
    ]
    df = spark.createDataFrame(rows, KIND).withColumns({"n": F.lit("x"), "component": F.lit(1), "dims": F.lit(2), "i": F.lit(3)})
    found = [r for r in w.whitened(df, w.fit(df)).collect()]
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
    assert set(by_id) == {1, 2, None, 9, 10, 11}
    assert len(by_id[2]) == 6 and {r.n for r in by_id[2]} == {4}
    # The third dimension is constant and one rank is missing: no variance, nothing explained.
    last = [r for r in by_id[1] if r.component == 3][0]
    assert last.whitened == 0 and last.explained == 0 and last.identity_error < 1e-9
    alone = by_id[9]
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, 0.0, 0.0, 0.0)]
    assert [r.whitened for r in by_id[10]][0] == pytest.approx(-[r.whitened for r in by_id[11]][0])
    nothing = df.filter("false")
    assert w.whitened(nothing, w.fit(nothing)).collect() == []


def test_deviation_beyond_a_long(spark):
    rows = compared(spark, [(0, [2.0**40, 0.0]), (1, [-(2.0**40), 1.0])])
    x, sums, _ = exact([[2.0**40, 0.0], [-(2.0**40), 1.0]])
    big = sum((2 * c - s) ** 2 for c, s in zip(x[0], sums))
    assert big >= 2**63
    assert {r["deviation"] for r in rows} == {None} and {int(r["deviation_exact"]) for r in rows} == {big}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_the_given_table(spark):
    rows = w.query(spark, DATA).collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors.values()], dtype=object)
    sums, n = x.sum(axis=0), len(x)
    deviation = dict(zip(vectors, ((n * x - sums) ** 2).sum(axis=1)))
    assert len(rows) == 8 * n and all(r.deviation == deviation[r.vec_id] and r.n == n for r in rows)
    assert {r.identity_error for r in rows}.pop() < 1e-9
