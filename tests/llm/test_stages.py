"""Stages of the pipeline decide on rows: null and repeated ids neither lose rows nor keep copies."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hemline.llm import cuckoo, mixing, ngram_join, toxicity
from hemline.llm.common import ROW, chosen, numbered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = " ".join(f"word{i}" for i in range(60))
NEAR = BASE + " more"
OTHER = " ".join(f"other{i}" for i in range(60))
VILE, MILD = "vile awful slur filth here", "mild calm kind plain here"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows], SCHEMA).repartition(3)


def found(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_toxic_rows_take_no_other_rows(spark, monkeypatch):
    model = toxicity.fit([VILE] * 40 + [MILD] * 40, [1] * 40 + [0] * 40, epochs=20)
    monkeypatch.setattr(toxicity, "train", lambda *_: model)
    rows = [(None, VILE, "a"), (None, MILD, "a"), (None, MILD, "b"), (4, VILE, "a"), (4, MILD, "a"), (5, MILD, None)]
    docs = table(spark, rows)
    assert found(toxicity.clean_documents(docs, None)) == Counter(r for r in rows if r[1] == MILD)
    assert toxicity.clean_documents(docs, None).schema == docs.schema


def test_one_row_of_equal_texts_stays(spark):
    rows = [(1, BASE, "a"), (None, BASE, "a"), (None, BASE, "b"),            # the keeper has an id
            (None, OTHER, "a"), (None, OTHER, "a"), (None, OTHER, "a"),      # null ids only
            (7, "twice", "a"), (7, "twice", "a"), (7, "own text", "b"),      # one id for all
            (None, None, "a"), (8, "", "a"), (9, " ", "a")]
    want = Counter([(1, BASE, "a"), (None, OTHER, "a"), (7, "twice", "a"), (7, "own text", "b"), (9, " ", "a")])
    assert found(cuckoo.unique_documents(table(spark, rows))) == want


def test_one_row_of_near_copies_stays(spark):
    rows = [(3, NEAR, "a"), (None, BASE, "a"), (None, "alone but null", "b"),
            (6, OTHER, "a"), (6, OTHER + " end", "a"), (6, "apart under a used id", "a"),
            (None, None, "a"), (8, "", "a"), (8, "", "a")]
    kept = found(ngram_join.one_of_each(table(spark, rows)))
    pair = [(6, OTHER, "a"), (6, OTHER + " end", "a")]
    assert sum(kept[r] for r in pair) == 1
    for r in pair:
        del kept[r]
    assert kept == Counter([(3, NEAR, "a"), (None, "alone but null", "b"), (6, "apart under a used id", "a"),
                            (None, None, "a"), (8, "", "a"), (8, "", "a")])
    nulls = ngram_join.one_of_each(table(spark, [(None, BASE, "a"), (None, NEAR, "a"), (None, BASE, "a")]))
    assert nulls.count() == 1


@pytest.mark.parametrize("ids", ["null", "one"])
def test_each_row_is_taken_by_its_own_number(spark, ids):
    rows = [(None if ids == "null" else 5, " ".join(["w"] * (i % 40 + 1)) + f" x{i}", "abc"[min(i % 7, 2)]) for i in range(120)]
    docs = table(spark, rows)
    plan = mixing.mix_copies(docs).collect()
    mixed = found(mixing.mixture(docs))
    size = {r: len(r[1].split()) for r in rows}
    taken, total = Counter(), Counter()
    for r, n in mixed.items():
        assert r in size and n <= 2
        taken[r[2], size[r]] += n
        total[r[2]] += n * size[r]
    want = Counter()
    for p in plan:
        want[p.source, p.size] += p.copies
    assert +taken == +want
    for p in plan:
        assert abs(total[p.source] - p.target) <= max(size.values())


def test_chosen_rows_are_those_listed(spark):
    rows = numbered(spark.range(100_000, numPartitions=2))
    listed = rows.filter("id % 7 = 3 OR id IN (0, 1, 32767, 32768, 32769, 99999)")
    twice = listed.select(F.col(ROW).alias("n")).unionByName(listed.select(F.col(ROW).alias("n")))
    kept = chosen(rows, twice)
    assert kept.columns == ["id"]
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in listed.collect())
    assert chosen(rows, twice.limit(0)).count() == 0
    assert chosen(rows, rows.select(ROW)).count() == 100_000


@pytest.mark.parametrize("stage", [cuckoo.unique_documents, ngram_join.one_of_each])
def test_kept_rows_are_found_without_an_exchange_of_texts(spark, stage):
    docs = spark.range(3000, numPartitions=3).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") - F.col("id") % 3).alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # a list of the 1,000 rows that stay is larger, their bitmaps are not
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    try:
        kept = stage(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 3000, 3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
