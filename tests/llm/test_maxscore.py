"""Exact top-k products against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hemline.llm import maxscore

rng = np.random.default_rng(8)


def brute(rows, k, step):
    one = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        one[i] = min(one.get(i, w), w)
    out = set()
    for q, v in one.items():
        if q % step:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in one.items() if i != q and len(w) == len(v))
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])}
    return out


def vectors():
    out = [(i, rng.standard_normal(8).round(2).tolist()) for i in range(300)]
    same = rng.standard_normal(8).tolist()
    out += [(300 + i, same) for i in range(150)]  # one vector in a third of the rows
    out += [(450, None), (500, [1.0, None] + [0.0] * 6), (501, [math.nan] * 8), (502, [math.inf] * 8), (503, [0.0] * 8),
            (550, [0.5] * 3), (551, [0.25, -0.5, 1.0]), (552, [-1.0] * 3), (600, []), (601, []), (None, [1.0] * 8),
            (50, [9.0] * 8), (50, [-9.0] * 8), (701, [-9.0] * 8), (701, [3.0] * 8), (750, [1.0] * 5)]
    return out


@pytest.mark.parametrize("block,shard", [(2048, 1 << 16), (16, 40)])
def test_top_products(spark, monkeypatch, block, shard):
    monkeypatch.setattr(maxscore, "BLOCK", block)
    monkeypatch.setattr(maxscore, "SHARD", shard)
    monkeypatch.setattr(maxscore, "QUERIES", shard)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).select(
        "*", F.lit(1).alias("width"), F.lit(2).alias("shard"), F.lit(3).alias("vec"), F.lit(4).alias("n"))
    for k in (1, 5):
        got = maxscore.top_products(df, F.col("vec_id") % 50 == 0, k=k).collect()
        assert {tuple(r) for r in got} == brute(rows, k, 50) and len(got) == len(brute(rows, k, 50))
    assert maxscore.top_products(df.filter("vec_id % 50 = 1"), F.col("vec_id") % 50 == 0).collect() == []
    assert maxscore.top_products(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 21 + i), float(2 ** 15 * i), -3.0, float(i % 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in maxscore.top_products(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == brute(rows, 5, 20)


def test_blocks_are_skipped_and_terms_probed():
    """Weak blocks have no essential term; in the others few rows are probed to the end."""
    strong = rng.integers(100, 200, (64, 16)).astype(float)
    weak = rng.integers(-5, 5, (maxscore.BLOCK * 2, 16)).astype(float)
    shard = maxscore.Shard(np.concatenate([strong, rng.integers(-90, 90, (maxscore.BLOCK - 64, 16)), weak]),
                           [[i] for i in range(3 * maxscore.BLOCK)])
    seen = [0, 0, 0]
    found = shard.search(-1, np.ones(16), 5, seen)
    sums = shard.vectors.sum(1)
    assert found == [(int(sums[i]), int(i)) for i in np.lexsort((np.arange(len(sums)), -sums))[:5]]
    assert seen[1] == 2
