"""Quality: attention-based multiple-instance learning over passages, in numpy.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded as a vector:
shares of single bytes and byte classes, word lengths, how often its words repeat inside
the passage and in the document before it, and hashed counts of word shapes. A dense layer
maps it to a hidden vector; gated attention (a tanh branch times a sigmoid branch) weighs
the passages of a document, and a linear layer scores their weighted mean. All layers are
learned together from document labels.

Every passage of every whole text is encoded. The model is fitted on the driver from the
passage vectors of at most ``PER_CLASS`` labelled documents a class, ``PASSAGES_EACH``
of each at most, which tasks compute; its size is fixed.

Null or empty text is one passage without words. Null ids get a null ``held_out``;
repeated ids are rows of their own; without usable labels of both classes every score is
that of the untrained bias, 0.5. An empty table gives no rows. Other columns may have any
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import LOWER, Block, blocks, list_array, prefix_hash, ship, span_hash
from hemline.llm.sampling import labelled_sample, remainder

PASSAGE = 64
PER_CLASS = 1500
PASSAGES_EACH = 48
HIDDEN, GATE = 16, 8
EPOCHS = 40
DIVISOR, HELD_OUT = 3, 1

#: Byte classes: 33 single marks and 5 classes of letters, digits and others.
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n"
CLASSES = len(MARKS) + 5
CLASS_OF = np.full(256, len(MARKS) + 3, np.int64)
CLASS_OF[128:] = len(MARKS) + 4
CLASS_OF[97:123] = len(MARKS)
CLASS_OF[65:91] = len(MARKS) + 1
CLASS_OF[48:58] = len(MARKS) + 2
CLASS_OF[list(MARKS)] = np.arange(len(MARKS))
SHAPES = 16
FEATURES = CLASSES + SHAPES + 7


def passages(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and vector of every passage of the block, in order; each row has one at least."""
    start, end, before = block.words()
    n_words = np.diff(before)
    count = np.maximum(1, -(-n_words // PASSAGE))
    row = np.repeat(np.arange(len(n_words)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = before[row] + k * PASSAGE
    n = np.minimum(PASSAGE, before[row + 1] - first)
    out = np.zeros((len(row), FEATURES), np.float32)
    if not len(start):
        return row, out
    of_word = np.repeat(np.arange(len(row)), n)
    length = end - start
    # bytes of words, with their passage
    owner = np.zeros(len(block.data), np.int64)
    owner[start[0]:] = of_word[np.searchsorted(start, np.arange(start[0], len(block.data)), side="right") - 1]
    counts = np.bincount(owner * CLASSES + CLASS_OF[block.data], minlength=len(row) * CLASSES)
    counts = counts[:len(row) * CLASSES].reshape(len(row), CLASSES)
    some = np.maximum(n, 1)[:, None]
    out[:, :CLASSES] = np.log1p(counts / some)
    # a word's shape: case of its first letter, its last byte's class, its length
    shape = (CLASS_OF[block.data[start]] * 7 + CLASS_OF[block.data[end - 1]] * 31
             + np.minimum(length, 12) // 4 * 101) % SHAPES
    shapes = np.bincount(of_word * SHAPES + shape, minlength=len(row) * SHAPES).reshape(len(row), SHAPES)
    out[:, CLASSES:CLASSES + SHAPES] = shapes / some
    # repetition
    words = span_hash(prefix_hash(LOWER[block.data]), start, end)
    code = np.unique(words, return_inverse=True)[1]
    own = np.unique(of_word * len(words) + code)
    distinct = np.bincount(own // len(words), minlength=len(row))
    doc = np.repeat(np.arange(len(n_words)), n_words)
    order = np.lexsort((np.arange(len(code)), code, doc))
    again = np.zeros(len(code), bool)
    again[order[1:]] = (code[order[1:]] == code[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    pair = again.copy()
    pair[1:] &= again[:-1]
    base = CLASSES + SHAPES
    total = np.bincount(of_word, length, len(row))
    out[:, base] = distinct / some[:, 0]
    out[:, base + 1] = np.bincount(of_word, again, len(row)) / some[:, 0]
    out[:, base + 2] = np.bincount(of_word, pair, len(row)) / some[:, 0]
    out[:, base + 3] = total / some[:, 0] / 8
    out[:, base + 4] = np.sqrt(np.maximum(
        np.bincount(of_word, length.astype(float) ** 2, len(row)) / some[:, 0]
        - (total / some[:, 0]) ** 2, 0)) / 8
    out[:, base + 5] = n / PASSAGE
    out[:, base + 6] = np.log1p(n_words[row]) / 8
    return row, out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Attention:
    """Encoder, gated attention and classifier."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return rng.standard_normal(shape) / np.sqrt(shape[0])

        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"enc": draw(FEATURES, HIDDEN), "enc_b": np.zeros(HIDDEN),
                  "tanh": draw(HIDDEN, GATE), "gate": draw(HIDDEN, GATE), "focus": draw(GATE, 1),
                  "out": np.zeros((HIDDEN, 1)), "bias": np.zeros(1)}

    def forward(self, x: np.ndarray, row: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logit of each row; ``row`` is sorted and gapless."""
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        hid = np.tanh(x @ p["enc"] + p["enc_b"])
        t, g = np.tanh(hid @ p["tanh"]), _sigmoid(hid @ p["gate"])
        e = ((t * g) @ p["focus"])[:, 0]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        w = np.exp(e - np.maximum.reduceat(e, first)[row])
        w /= np.add.reduceat(w, first)[row]
        z = np.add.reduceat(w[:, None] * hid, first)
        if keep is not None:
            keep += [x, hid, t, g, w, z, first]
        return (z @ p["out"])[:, 0] + p["bias"][0]

    def gradient(self, row: np.ndarray, keep: list, d: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x, hid, t, g, w, z, first = keep
        dz = d[:, None] * p["out"][:, 0]
        out = {"out": z.T @ d[:, None], "bias": np.array([d.sum()])}
        dw = (hid * dz[row]).sum(1)
        de = w * (dw - np.add.reduceat(w * dw, first)[row])
        out["focus"] = (t * g).T @ de[:, None]
        dtg = de[:, None] * p["focus"][:, 0]
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        out["tanh"], out["gate"] = hid.T @ dt, hid.T @ dg
        dh = w[:, None] * dz[row] + dt @ p["tanh"].T + dg @ p["gate"].T
        dh *= 1 - hid * hid
        return out | {"enc": x.T @ dh, "enc_b": dh.sum(0)}


def fit(x: np.ndarray, row: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Attention:
    """Fit on passage vectors ``x`` of documents ``row`` (sorted, gapless) with labels ``y``."""
    model = Attention(seed)
    if len(set(y.tolist())) < 2:
        return model
    x = x.astype(np.float64)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-2
    rng = np.random.default_rng(seed)
    bounds = np.searchsorted(row, np.arange(len(y) + 1))
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(a) for k, a in model.p.items()}
    t = 0
    for epoch in range(epochs):
        docs = rng.permutation(len(y))
        rate = 0.01 * (1 - 0.95 * epoch / epochs)
        for lo in range(0, len(docs), 64):
            mine = docs[lo:lo + 64]
            pick = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in mine])
            part = np.repeat(np.arange(len(mine)), bounds[mine + 1] - bounds[mine])
            keep: list = []
            d = (_sigmoid(model.forward(x[pick], part, keep)) - y[mine]) / len(mine)
            grads = model.gradient(part, keep, d)
            t += 1
            for k, grad in grads.items():
                grad = grad + 1e-4 * model.p[k]
                m[k] += 0.1 * (grad - m[k])
                v[k] += 0.001 * (grad * grad - v[k])
                model.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return model


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, passage vectors), evenly spread passages of a long document."""
    for block in blocks(batches):
        row, x = passages(block)
        vectors = []
        for i in range(len(block)):
            mine = x[row == i]
            if len(mine) > PASSAGES_EACH:
                mine = mine[np.linspace(0, len(mine) - 1, PASSAGES_EACH).astype(int)]
            vectors.append(mine.ravel())
        at = np.cumsum([0, *map(len, vectors)])
        yield pa.RecordBatch.from_arrays(
            [block.rows.column(0), block.rows.column(1), list_array(np.concatenate(vectors), at)],
            ["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Attention:
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", DIVISOR, HELD_OUT, per_class).select(
        F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    # vectors of a fixed size and a bounded number come to the driver, not the texts
    rows = sample.mapInArrow(_sample_rows, "doc_id long, label int, x array<float>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], len(r["x"]), r["x"]))
    if not rows:
        return Attention()
    x = [np.asarray(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(np.concatenate(x), np.repeat(np.arange(len(x)), [len(a) for a in x]),
               np.asarray([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, model: Attention, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, attention (weight of each passage)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            row, x = passages(block)
            keep: list = []
            logits = shared.value.forward(x, row, keep)
            at = np.searchsorted(row, np.arange(len(block) + 1))
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), pa.array(_sigmoid(logits)),
                 list_array(keep[4].astype(np.float32), at)], ["doc_id", "score", "attention"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, attention array<float>")


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, per_class))
    return scored.select("doc_id", (remainder(F.col("doc_id"), DIVISOR) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
