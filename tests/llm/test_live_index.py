"""The stored filters of the digest index, over insertions and deletions."""

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hemline.llm import cuckoo
from hemline.llm.cuckoo import CuckooFilter, LiveIndex


def frame(spark, rows):
    """(doc_id, text) rows as digests."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return cuckoo.digests(docs)


def content(index):
    return Counter((r.digest, r.size, r.length, r.doc_id) for r in index.content.collect())


def filters(index):
    return {r.bucket: CuckooFilter.stored(r.cells, r.slots) for r in index.filters.collect()}


def held(index):
    """Digests in all filters together; every live digest must be found in its bucket's."""
    made = filters(index)
    assert all(bytes(r.digest) in made[r.bucket] for r in index.content.collect())
    return sum(np.count_nonzero(f.slots) for f in made.values())


def want(rows):
    groups = {}
    for d, t in rows:
        key = "".join((t or "").split())
        groups.setdefault(hashlib.sha256(key.encode()).digest(), []).append((-len(t or ""), d is None, d or 0, d))
    return Counter((k, len(v), -min(v)[0], min(v)[3]) for k, v in groups.items())


FIRST = [(i, f"text {i % 90}") for i in range(200)] + [(None, None), (5, ""), (None, "text 3"), (1, "text 1")]
LATER = [(500 + i, f"text  {i}") for i in range(60, 400)] + [(2, "text 3"), (900, " "), (None, "new"), (None, "new")]


def test_insertions_and_deletions_keep_content_and_filters(spark):
    index = LiveIndex.build(frame(spark, FIRST))
    assert content(index) == want(FIRST) and held(index) == len(want(FIRST))
    more = index.insert(frame(spark, LATER))
    assert content(more) == want(FIRST + LATER) and held(more) == len(want(FIRST + LATER))
    gone = frame(spark, [(0, f"text {i}") for i in range(0, 300, 2)] + [(0, "never there"), (0, "text 0")])
    left = more.delete(gone)
    out = {bytes(r.digest) for r in gone.collect()}
    assert content(left) == Counter({k: n for k, n in want(FIRST + LATER).items() if k[0] not in out})
    assert held(left) == len(content(left))
    # what was deleted is new again
    back = left.insert(frame(spark, [(7, "text 0")]))
    assert content(back) - content(left) == want([(7, "text 0")])
    assert content(index) == want(FIRST)


def test_new_digests_are_told_by_the_filter_alone(spark):
    index = LiveIndex.build(frame(spark, FIRST))
    probed = index._probed(cuckoo._combined(frame(spark, [(i, f"unseen {i}") for i in range(400)])))
    # a 16-bit fingerprint in at most eight slots: hits by chance are rare, and the content refutes them
    assert probed.filter("hit").count() < 8
    assert index._verified(probed).filter("live").count() == 0
    known = index._probed(cuckoo._combined(frame(spark, FIRST)))
    assert known.filter("NOT hit").count() == 0


def test_full_filters_are_made_anew_from_the_stored_digests(spark):
    index = LiveIndex.build(frame(spark, FIRST))
    small = index.filters.limit(0)
    tight = index.content.repartition("bucket").sortWithinPartitions("bucket").groupBy("bucket").agg(
        F.collect_list("digest").alias("d")).collect()
    rows = []
    for r in tight:
        made = CuckooFilter.holding([bytes(d) for d in r.d], 4)
        rows.append((r.bucket, made.cells, made.to_bytes()))
    index = LiveIndex(index.content, spark.createDataFrame(rows, small.schema), index.buckets)
    many = [(i, f"row {i}") for i in range(3000)]
    grown = index.insert(frame(spark, many))
    assert max(f.cells for f in filters(grown).values()) > max(f.cells for f in filters(index).values())
    assert content(grown) == want(FIRST + many) and held(grown) == len(want(FIRST + many))


def test_empty_tables(spark):
    none = frame(spark, [])
    index = LiveIndex.build(none)
    assert not content(index) and index.insert(none).content.isEmpty() and index.delete(none).content.isEmpty()
    assert content(index.insert(frame(spark, FIRST))) == want(FIRST)
