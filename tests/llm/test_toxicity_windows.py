"""Windows of the toxicity scan: what they cover, and which of them are trained on."""

import numpy as np
import pytest

from hemline.llm import toxicity


@pytest.mark.parametrize("n", [0, 1, 16, 31, 32, 33, 47, 48, 49, 200, 1001])
def test_every_short_passage_stands_whole_in_a_window(n):
    before = np.array([5, 5 + n])
    row, begin, size = toxicity.windows_of(before)
    assert set(row) == {0} and (size <= toxicity.LENGTH).all() and (size >= 0).all()
    covered = np.zeros(n, bool)
    for b, s in zip(begin - 5, size):
        covered[b:b + s] = True
    assert covered.all()
    width = min(n, toxicity.LENGTH - toxicity.STEP + 1)
    for start in range(n - width + 1):
        assert any(b <= start and start + width <= b + s for b, s in zip(begin - 5, size)), start


def test_windows_to_train():
    rng = np.random.default_rng(1)
    row = np.repeat([0, 1, 2], [40, 3, 16])
    odds = rng.random(len(row))
    odds[[7, 21]] = 9.0
    chosen = toxicity.windows_to_train(row, odds, np.random.default_rng(2), 16)
    # the only hot windows of a long document are never missed, short documents keep all of theirs
    assert {7, 21} <= set(chosen) and np.bincount(row[chosen]).tolist() == [16, 3, 16]
    best = set(np.argsort(-odds[:40])[:8])
    assert best <= set(chosen) and len(set(chosen)) == len(chosen)
    ties = toxicity.windows_to_train(row, np.zeros(len(row)), np.random.default_rng(2), 16)
    assert np.bincount(row[ties]).tolist() == [16, 3, 16]


def test_a_planted_passage_in_a_long_text_is_found():
    vile = "you utter worthless idiot go away and never come back"
    mild = "the river runs past old mills and green fields to the sea "
    # passages of ten words in texts of hundreds of windows, of which few are trained on
    texts = [mild * (3 + i) + (vile if i % 2 else "") + " " + mild * 40 for i in range(60)]
    model = toxicity.fit(texts, [i % 2 for i in range(60)], epochs=12)
    import pyarrow as pa

    from hemline.llm.common import blocks

    new = [mild * k + vile + " " + mild * 60 for k in (1, 7, 30, 200)] + [mild * k for k in (1, 9, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(new))), pa.array(new)], ["doc_id", "text"])
    logits = np.concatenate([toxicity.block_logits(model, b) for b in blocks(iter([batch]))])
    assert (logits[:4] > logits[4:].max()).all()
