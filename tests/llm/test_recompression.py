"""Symbols of recompression against the words they stand for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hemline.llm import recompression, repeats
from hemline.llm.common import mix
from hemline.llm.symbols import Symbols


def sequences(seed, letters, lengths):
    rng = np.random.default_rng(seed)
    words = mix(rng.integers(0, letters, sum(lengths)).astype(np.uint64))
    return words, np.append(0, np.cumsum(lengths))


@pytest.mark.parametrize("letters", [1, 2, 5, 1000])
@pytest.mark.parametrize("width", [1, 2, 7, 20, 45])
def test_names_of_pieces_are_equal_where_words_are(letters, width):
    words, before = sequences(3, letters, [300, 0, 45, 1, 200])
    words = np.concatenate([words, words[37:400]])
    before = np.append(before, len(words))
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    lo = np.concatenate([np.arange(a, max(a, b - width + 1)) for a, b in zip(before[:-1], before[1:])])
    names = Symbols(words, row).names_of(lo, lo + width)
    pieces = [tuple(words[a:a + width]) for a in lo]
    assert len(set(names.tolist())) == len(set(pieces)) == len(set(zip(names.tolist(), pieces)))


def test_pieces_of_different_widths_have_different_names():
    words, _ = sequences(5, 2, [400])
    lo, hi = (a.ravel() for a in np.meshgrid(np.arange(0, 400, 3), np.arange(0, 400, 7)))
    lo, hi = lo[lo < hi], hi[lo < hi]
    names = Symbols(words, np.zeros(400, int)).names_of(lo, hi)
    pieces = [words[a:b].tobytes() for a, b in zip(lo, hi)]
    assert len(set(names.tolist())) == len(set(pieces)) == len(set(zip(names.tolist(), pieces)))


@pytest.mark.parametrize("rounds", [1, 2, 12])
def test_equal_names_hold_equal_words(rounds):
    words, before = sequences(7, 3, [500, 80, 0, 1, 900])
    row = np.repeat(np.arange(5), np.diff(before))
    names, start = Symbols(words, row).after(rounds)
    end = np.append(start[1:], len(words))
    held = {}
    for name, a, b in zip(names.tolist(), start, end):
        assert row[a] == row[b - 1]
        assert held.setdefault(name, words[a:b].tobytes()) == words[a:b].tobytes()


def words_of(seed, n):
    return [f"w{i}" for i in np.random.default_rng(seed).integers(0, 4000, n)]


def texts_of(spark, rows):
    return repeats.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")


def test_shared_symbols_hold_most_of_a_long_repeat_and_nothing_else(spark):
    passage = words_of(1, 900)
    documents = {k: words_of(10 + k, 200) + passage[k:] + words_of(50 + k, 150) for k in range(1, 7)}
    texts = texts_of(spark, [(k, " ".join(w)) for k, w in documents.items()])
    own = repeats.owners(texts.select("doc_id", "key"))
    live = repeats.with_texts(texts, own.select("key", "owner")).select(
        "key", "owner", F.array(F.struct(F.lit(0).alias("start"), F.lit(100).alias("n"))).alias("ranges"))
    # all windows are live: nothing is told from anchors
    live = live.withColumn("ranges", F.expr("transform(ranges, r -> named_struct('start', r.start, 'n', 1000))"))
    key = {r.key: r.doc_id for r in texts.collect()}
    found = {k: set() for k in documents}
    for r in recompression.symbol_rounds(texts, live).collect():
        found[key[r.key]].update(range(r.start, r.start + r.n))
    assert not found[1]
    for k in range(2, 7):
        inside = set(range(200, 200 + len(passage) - k - 19))
        assert found[k] <= inside and 2 * len(found[k]) > len(inside)


def test_small_alphabets_null_ids_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), " ".join(rng.choice(list("ab"), rng.integers(0, 400)))) for i in range(12)]
    rows += [rows[3], (None, "a b " * 60), (None, None), (40, "a " * 300), (41, "b " + "a " * 250), (42, "")]
    seen, want = set(), []
    order = sorted({(d is None, d or 0, t) for d, t in rows if t})
    removed = {}
    for null, d, t in order:
        words = t.split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = True
            seen.add(window)
        removed[None if null else d, t] = int(gone.sum())
    want = sorted((d is None, d or 0, removed.get((d, t), 0)) for d, t in rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = recompression.drop_repeats(frame).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in got) == want
