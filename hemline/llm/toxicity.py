"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A token's input is the sum of a word embedding (words frequent enough in the sample; one
row for all others) and the mean of the embeddings of its character n-grams, of four and
of eight bytes. The first coordinates of the embeddings start as smoothed log-odds of the
word or n-gram in the sample, all others at random. Overlapping
windows of tokens run through two gated recurrent layers, one each way; attention pools
their states, and a linear layer gives the window's logit. A document's logit is that of
its worst window.

Every window of a whole text is scored, in blocks of bounded size. The model is fitted on
the driver from at most ``PER_CLASS`` labelled documents a class and ``WINDOWS_EACH``
windows of each, half of them those with the highest log-odds to begin with, and travels to the tasks with the job: its size is fixed.

Null or empty text, and text without letters or digits, has one window without tokens.
Null ids get a null ``held_out``; repeated ids are rows of their own; a table without
usable labels of both classes gives the score of the untrained bias, 0.1 for all. An
empty table gives no rows. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import LOWER, Block, blocks, prefix_hash, ship, span_hash
from hemline.llm.sampling import labelled_sample, remainder

#: Neighbouring windows share half, so a passage of up to 17 tokens stands whole in one of them.
LENGTH, STEP = 32, 16
HIDDEN, INPUT, ATTENTION = 8, 12, 8
GRAMS = 1 << 16
VOCABULARY = 4096
LEAST_DOCUMENTS = 3
PER_CLASS = 1000
WINDOWS_EACH = 16
EPOCHS = 5
THRESHOLD = 0.3
DIVISOR, HELD_OUT = 4, 2

#: Bytes of words: ASCII letters and digits, and all of multi-byte characters.
INK = np.zeros(256, bool)
INK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Tokens:
    """Distinct tokens of a block: their hashes, n-grams, and which token stands where."""

    hashes: np.ndarray   # distinct
    grams: np.ndarray
    at: np.ndarray       # where each distinct token's grams start
    where: np.ndarray    # distinct token of each occurrence
    before: np.ndarray   # occurrences before each row


def tokens_of(block: Block) -> Tokens:
    data = LOWER[block.data]
    start, end, before = block.words(INK)
    hashes, first, where = np.unique(span_hash(prefix_hash(data), start, end),
                                     return_index=True, return_inverse=True)
    start, n = start[first], (end - start)[first]
    at = np.cumsum(n) - n
    # n-grams end at each byte of a token; before its first byte stand zeros
    place = np.repeat(start - at, n) + np.arange(int(n.sum()))
    depth = np.arange(len(place)) - np.repeat(at, n)
    wide = data.astype(np.uint32)
    code, grams = np.zeros(len(place), np.uint32), []
    for back in range(8):
        byte = np.where(depth >= back, wide[place - back], 0)
        code = code * np.uint32(0x01000193) + byte
        if back in (3, 7):
            grams.append(((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64))
    grams = np.stack(grams, 1).ravel()
    return Tokens(hashes, grams, 2 * at, where, before)


def windows_of(before: np.ndarray, length: int = LENGTH, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first token and number of tokens of every window; each row has one at least."""
    n = np.diff(before)
    count = np.maximum(1, -(-(n - length) // step) + 1)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = before[row] + k * step
    return row, begin, np.minimum(length, before[row + 1] - begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward and backward pass of the network."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, d, a = HIDDEN, INPUT, ATTENTION

        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.vocabulary = vocabulary  # sorted hashes; row 0 of the embedding is for all others
        self.p = {"words": 0.02 * rng.standard_normal((len(vocabulary) + 1, d)).astype(np.float32),
                  "grams": 0.02 * rng.standard_normal((GRAMS, d)).astype(np.float32),
                  "attend": draw(2 * h, a), "focus": draw(a, 1), "out": draw(2 * h, 1),
                  "bias": np.full(1, np.log(0.1 / 0.9), np.float32)}
        for side in "fb":
            self.p |= {f"in_{side}": draw(d, 3 * h), f"rec_{side}": draw(h, 3 * h),
                       f"bias_{side}": np.zeros(3 * h, np.float32)}

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        i = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[i] == hashes, i + 1, 0)

    def inputs(self, words: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Input vectors of distinct tokens, and last a row of zeros for padding."""
        out = np.zeros((len(at) + 1, INPUT), np.float32)
        if len(at):
            n = np.diff(np.append(at, len(grams)))[:, None].astype(np.float32)
            out[:-1] = self.p["words"][words] + np.add.reduceat(self.p["grams"][grams], at) / n
        return out

    def scores(self, table: np.ndarray, grid: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows. ``grid`` (length, windows) holds rows of ``table``, its last for padding.

        With ``keep``, what the backward pass needs is appended to it.
        """
        p, h = self.p, HIDDEN
        steps, n = grid.shape
        pad = len(table) - 1
        live = (grid != pad).astype(np.float32)[:, :, None]
        states = np.zeros((steps, n, 2 * h), np.float32)
        for k, side in enumerate("fb"):
            x = table @ p[f"in_{side}"] + p[f"bias_{side}"]
            s, kept = np.zeros((n, h), np.float32), []
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                g, r = x[grid[t]], s @ p[f"rec_{side}"]
                gates = _sigmoid(g[:, :2 * h] + r[:, :2 * h])
                new = np.tanh(g[:, 2 * h:] + gates[:, :h] * r[:, 2 * h:])
                z = gates[:, h:]
                after = s + live[t] * (1 - z) * (new - s)
                if keep is not None:
                    kept.append((t, s, gates, new, r[:, 2 * h:]))
                s = after
                states[t, :, k * h:(k + 1) * h] = s
            if keep is not None:
                keep.append(kept)
        att = np.tanh(states @ p["attend"])
        e = (att @ p["focus"])[:, :, 0] + (live[:, :, 0] - 1) * 30
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, states)
        if keep is not None:
            keep += [states, att, w, pooled, live]
        return (pooled @ p["out"])[:, 0] + p["bias"][0]

    def gradient(self, table: np.ndarray, grid: np.ndarray, keep: list, d: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters above the inputs, and of the input table, for d(loss)/d(logit)."""
        p, h = self.p, HIDDEN
        kept_f, kept_b, states, att, w, pooled, live = keep
        out = {"out": pooled.T @ d[:, None], "bias": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["out"][:, 0]
        ds = w[:, :, None] * dpool
        dw = np.einsum("tnh,nh->tn", states, dpool)
        de = w * (dw - (w * dw).sum(0))
        out["focus"] = np.einsum("tna,tn->a", att, de)[:, None]
        da = de[:, :, None] * p["focus"][:, 0] * (1 - att * att)
        out["attend"] = np.einsum("tnh,tna->ha", states, da)
        ds += da @ p["attend"].T
        dtable = np.zeros_like(table)
        flat = grid.ravel()
        order = np.argsort(flat, kind="stable")
        firsts = np.searchsorted(flat[order], np.arange(len(table)))
        firsts = np.minimum(firsts, len(flat) - 1)  # padding may be missing; its row is cleared
        for k, (side, kept) in enumerate((("f", kept_f), ("b", kept_b))):
            rec = p[f"rec_{side}"]
            drec, dg_all = np.zeros_like(rec), np.empty((*grid.shape, 3 * h), np.float32)
            carry = np.zeros_like(kept[0][1])
            for t, s, gates, new, rn in reversed(kept):
                dh = carry + ds[t, :, k * h:(k + 1) * h]
                step = live[t] * dh
                z, r = gates[:, h:], gates[:, :h]
                dn = step * (1 - z) * (1 - new * new)
                dz = -step * (new - s) * z * (1 - z)
                dr = dn * rn * r * (1 - r)
                dg = np.concatenate([dr, dz, dn], 1)
                drr = np.concatenate([dr, dz, dn * r], 1)
                drec += s.T @ drr
                carry = dh - step * (1 - z) + drr @ rec.T
                dg_all[t] = dg
            # every row of the table stands in the grid, so the sums by row are gapless
            dx = np.add.reduceat(dg_all.reshape(-1, 3 * h)[order], firsts)
            dx[-1] = 0
            out[f"rec_{side}"], out[f"in_{side}"] = drec, table.T @ dx
            out[f"bias_{side}"] = dx.sum(0)
            dtable += dx @ p[f"in_{side}"].T
        dtable[-1] = 0
        return out, dtable


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def grid_of(where: np.ndarray, begin: np.ndarray, n: np.ndarray, pad: int) -> np.ndarray:
    """(LENGTH, windows) token numbers, ``pad`` beyond a window's end."""
    place = begin[None, :] + np.arange(LENGTH)[:, None]
    inside = np.arange(LENGTH)[:, None] < n[None, :]
    if not len(where):
        return np.full(place.shape, pad)
    return np.where(inside, where[np.minimum(place, len(where) - 1)], pad)


def block_logits(model: Network, block: Block) -> np.ndarray:
    """Logit of each row of the block: that of its worst window."""
    t = tokens_of(block)
    table = model.inputs(model.word_rows(t.hashes), t.grams, t.at)
    row, begin, n = windows_of(t.before)
    logits = np.empty(len(row), np.float32)
    for lo in range(0, len(row), 4096):
        part = slice(lo, lo + 4096)
        logits[part] = model.scores(table, grid_of(t.where, begin[part], n[part], len(t.hashes)))
    return np.maximum.reduceat(logits, np.flatnonzero(np.diff(row, prepend=-1)))


def tokens_of_all(texts: list[str | None]) -> Tokens:
    """The tokens of many documents, gathered block by block."""
    data = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = [tokens_of(block) for block in blocks(iter([data]))]
    hashes, first, code = np.unique(np.concatenate([t.hashes for t in parts]), return_index=True, return_inverse=True)
    at = np.concatenate([t.at for t in parts])
    size = np.concatenate([np.diff(np.append(t.at, len(t.grams))) for t in parts])
    shift = np.repeat(np.cumsum([0] + [len(t.grams) for t in parts[:-1]]), [len(t.at) for t in parts])
    at, size = (at + shift)[first], size[first]
    new_at = np.cumsum(size) - size
    grams = np.concatenate([t.grams for t in parts])[np.repeat(at - new_at, size) + np.arange(int(size.sum()))]
    before = np.cumsum([0] + [len(t.hashes) for t in parts[:-1]])
    where = np.concatenate([code[b + t.where] for b, t in zip(before, parts)])
    seen = np.cumsum([0] + [len(t.where) for t in parts[:-1]])
    starts = np.concatenate([[0]] + [b + t.before[1:] for b, t in zip(seen, parts)])
    return Tokens(hashes, grams, new_at, where, starts.astype(np.int64))


def document_counts(t: Tokens, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of words and of n-gram rows: documents that have them, and those labelled 1."""
    words, grams = np.zeros((2, len(t.hashes))), np.zeros((2, GRAMS))
    size = np.diff(np.append(t.at, len(t.grams)))
    for i, label in enumerate(y):
        own = np.unique(t.where[t.before[i]:t.before[i + 1]])
        n = size[own]
        rows = np.unique(t.grams[np.repeat(t.at[own] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))])
        words[0, own] += 1
        words[1, own] += label
        grams[0, rows] += 1
        grams[1, rows] += label
    return words[0], words[1], grams[0], grams[1]


def window_odds(model: Network, t: Tokens, words: np.ndarray, n_grams: np.ndarray,
                begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean log-odds of each window's tokens as the embeddings start: of words, and of n-grams on average."""
    of_gram = np.append(0, np.cumsum(model.p["grams"][t.grams, 1].astype(np.float64)))
    token = model.p["words"][words, 0] + (of_gram[t.at + n_grams] - of_gram[t.at]) / np.maximum(n_grams, 1)
    total = np.append(0, np.cumsum(token[t.where]))
    return (total[begin + n] - total[begin]) / np.maximum(n, 1)


def windows_to_train(row: np.ndarray, odds: np.ndarray, rng, each: int = WINDOWS_EACH) -> np.ndarray:
    """At most ``each`` windows of each document: half the highest by ``odds``, the others at random."""

    def ranked(key: np.ndarray) -> np.ndarray:
        order = np.lexsort((key, row))
        first = np.flatnonzero(np.diff(row[order], prepend=-1))
        rank = np.empty(len(row), np.int64)
        rank[order] = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        return rank

    high = ranked(-odds) < each // 2
    return np.flatnonzero(ranked(np.where(high, -1.0, rng.random(len(row)))) < each)


def fit(texts: list[str | None], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit on documents: the loss is that of a soft maximum over a document's windows."""
    y = np.asarray(labels, np.float32)
    if not len(y) or len(set(labels)) < 2:
        return Network(np.zeros(0, np.uint64))
    rng = np.random.default_rng(seed)
    t = tokens_of_all(texts)
    # words in enough documents, the most frequent first, ties by hash
    documents, toxic, with_gram, toxic_gram = document_counts(t, y)
    common = np.flatnonzero(documents >= LEAST_DOCUMENTS)
    common = common[np.lexsort((t.hashes[common], -documents[common]))][:VOCABULARY]
    model = Network(np.sort(t.hashes[common]), seed)
    words = model.word_rows(t.hashes)
    share = float(y.mean())

    def odds(bad, all_):
        got = np.log((bad + 4 * share) / (all_ - bad + 4 * (1 - share))) - np.log(share / (1 - share))
        return np.clip(got, -3, 3)

    model.p["words"][words, 0] = odds(toxic, documents)
    model.p["words"][0] = 0
    model.p["grams"][:, 1] = odds(toxic_gram, with_gram)
    n_grams = np.diff(np.append(t.at, len(t.grams)))
    row, begin, n = windows_of(t.before)
    chosen = windows_to_train(row, window_odds(model, t, words, n_grams, begin, n), rng)
    row, begin, n = row[chosen], begin[chosen], n[chosen]
    bounds = np.searchsorted(row, np.arange(len(y) + 1))
    adam = Adam(model.p, 0.01)
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - 0.9 * epoch / epochs)
        docs = rng.permutation(len(y))
        for lo in range(0, len(docs), 32):
            mine = np.sort(docs[lo:lo + 32])
            pick = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in mine])
            part = np.repeat(np.arange(len(mine)), bounds[mine + 1] - bounds[mine])
            grid = grid_of(t.where, begin[pick], n[pick], len(t.hashes))
            live, local = np.unique(grid, return_inverse=True)
            if live[-1] != len(t.hashes):
                live = np.append(live, len(t.hashes))
            local = local.reshape(grid.shape)
            used = live[:-1]
            sizes = n_grams[used]
            at = np.cumsum(sizes) - sizes
            tri = t.grams[np.repeat(t.at[used] - at, sizes) + np.arange(int(sizes.sum()))]
            rows = np.where(rng.random(len(used)) < 0.1, 0, words[used])
            table, keep = model.inputs(rows, tri, at), []
            logits = model.scores(table, local, keep)
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            top = np.maximum.reduceat(logits, starts)
            e = np.exp(logits - top[part])
            total = np.add.reduceat(e, starts)
            count = np.bincount(part)
            doc_logit = top + np.log(total / count) * 0.5
            d_doc = (_sigmoid(doc_logit) - y[mine]) / len(mine)
            # half the maximum, half the soft maximum
            hard = (logits == top[part]).astype(np.float32)
            d = (d_doc[part] * (0.5 * hard + 0.5 * e / total[part])).astype(np.float32)
            grads, d_table = model.gradient(table, local, keep, d)
            d_token = d_table[:-1]
            d_words = np.zeros_like(model.p["words"])
            np.add.at(d_words, rows, d_token)
            d_tri = np.zeros_like(model.p["grams"])
            if len(tri):
                np.add.at(d_tri, tri, np.repeat(d_token / sizes[:, None], sizes, 0))
            adam.step(grads | {"words": d_words, "grams": d_tri})
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    rows = labelled_sample(docs, labels, "toxic", DIVISOR, HELD_OUT, per_class).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            logits = block_logits(shared.value, block).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), pa.array(1 / (1 + np.exp(-logits)))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, per_class))
    return scored.select("doc_id", (remainder(F.col("doc_id"), DIVISOR) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, train_on: DataFrame | None = None,
                    threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with all their columns.

    Each row is judged by its own score and passes by itself, so ids play no part.
    """
    ship(docs.sparkSession)
    model = train(docs if train_on is None else train_on, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            logits = block_logits(shared.value, block).astype(np.float64)
            yield block.rows.filter(pa.array(1 / (1 + np.exp(-logits)) < threshold))

    return docs.mapInArrow(run, docs.schema)
