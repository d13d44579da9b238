"""Neighbours where rows repeat an id: k different ids, each at the distance of its nearest row."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from hemline.llm import projections


def neighbours(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = defaultdict(list)
    for r in projections.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return out


def test_every_row_twice(spark):
    vectors = np.random.default_rng(4).standard_normal((400, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    once = neighbours(spark, rows)
    assert len(once) == 4 and all(len(r) == 10 for r in once.values())
    assert neighbours(spark, rows + rows) == once


def test_a_much_repeated_id_hides_no_other(spark):
    g = np.random.default_rng(5)
    vectors = g.standard_normal((100, 16))
    near = vectors[0] + 0.01 * g.standard_normal((15, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, v.tolist()) for v in near]
    found = neighbours(spark, rows)[0]
    best = {i: np.sqrt(((v - vectors[0]) ** 2).sum()) for i, v in enumerate(vectors) if i}
    best[7] = np.sqrt(((near - vectors[0]) ** 2).sum(1)).min()
    want = sorted(best, key=lambda i: (best[i], i))[:10]
    assert [i for _, i, _ in found] == want
    assert np.allclose([s for _, _, s in found], [best[i] for i in want])
