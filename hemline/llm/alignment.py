"""Alignment of two tokenizers' ids over a corpus.

Tokenizer A (byte-level merges) and B (pieces with byte fallback) encode the same bytes, a
blank and then the text. Byte offsets where tokens of both end cut the text into groups; every
token of A is linked with every token of B of its group. The count of an id pair is the number
of documents that hold it linked.

Neither vocabulary joins bytes over the edge between a visible character and a blank, so the
two tokenizations of a text are those of its pieces in a row, and each different piece of a
block of documents is aligned once.

The identity map gives each id of A the id of B with the same bytes. Links that follow it (all
one-to-one groups, but for ids of equal bytes) are counted in one vector of A's vocabulary a
task, and looked up in vectors of that length. Only other pairs are shuffled: each block of
documents, ``BLOCK`` bytes of text or one longer text, sends a pair once with the number of its
documents that hold it, and gets the corpus-wide count back once.

A text that is null, empty, or that B cannot give back byte for byte (it holds U+2581) has no
tokens: zeros and empty groups. Each row is a document, whatever its id: null and repeated ids
and repeated rows are kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import blocks, ship, stage
from hemline.llm.packing import VOCABULARY, ids_of

PIECES = "piece_bpe_32k.model"
#: Bytes of text whose pairs travel as one block.
BLOCK = 2 << 20
#: Pieces that A encodes at once, and links of a group from which on it goes by distinct ids.
RUN, LARGE = 4096, 256

_BREAK = re.compile(r"(?<=\S) ")
_SPACES = re.compile(r"^ |\s ")


def byte_levels() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def bytes_of_a(vocabulary: dict[str, int]) -> list[bytes]:
    level, out = byte_levels(), [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in level for c in token):
            out[i] = bytes(level[c] for c in token)
    return out


def bytes_of_b(pieces: list[str], is_byte: list[bool]) -> list[bytes]:
    return [bytes([int(p[3:5], 16)]) if raw else p.replace("▁", " ").encode()
            for p, raw in zip(pieces, is_byte)]


class Aligner:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, vocabulary: str, pieces: str):
        import public_tokenizers
        import sentencepiece

        self.a = ids_of(vocabulary)
        path = pieces if "/" in pieces else public_tokenizers.path(pieces)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size_b = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.a_bytes = bytes_of_a(self.a.slow.get_vocab())
        self.b_bytes = bytes_of_b(names, [self.b.is_byte(i) for i in range(self.size_b)])
        self.size_a = len(self.a_bytes)
        self.a_length, self.b_length = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        self.blank = names.index("▁")
        usable = {b: i for i, b in reversed(list(enumerate(self.b_bytes)))
                  if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))}
        #: id of B with the same bytes, -1 for none
        self.identity = np.array([usable.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        #: ids as text, A's before B's, each followed by a comma and then by the other sign
        self.shown = [f"{i}{sign}" for sign in ",|" for i in range(self.size_a)] \
            + [f"{i}{sign}" for sign in ",;" for i in range(self.size_b)]

    def ids_a(self, parts: list[str]) -> list[int]:
        """Ids over each part behind a blank; parts must end visibly but for the last."""
        text = " " + " ".join(parts)
        if self.a.fast is not None and max(text) < "ɐ":
            return self.a.fast.encode_ordinary(text)
        return self.a.slow.encode(text, add_special_tokens=False).ids

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A over a blank and each part, ids of B over each part, all in a row."""
        a, run = [], []
        for part in parts:
            run.append(part)
            if len(run) >= RUN or not part or part[-1].isspace():
                a += self.ids_a(run)
                run = []
        if run:
            a += self.ids_a(run)
        b = [x or [self.blank] for x in self.b.encode(parts, num_threads=1)] if parts else []
        return np.array(a, np.int64), np.fromiter(chain.from_iterable(b), np.int64)


def split(text: str) -> list[str]:
    """The pieces of a text, without the blank that stands before each."""
    return _BREAK.split(text) if _SPACES.search(text) else text.split(" ")


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(vocabulary: str, pieces: str) -> Aligner:
    """The worker's aligner, loaded once a worker."""
    if (vocabulary, pieces) not in _loaded:
        _loaded[vocabulary, pieces] = Aligner(vocabulary, pieces)
    return _loaded[vocabulary, pieces]


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges in a row: which range, and the place."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) + np.repeat(start - _starts(size), size)


def _sums(row: np.ndarray, key: np.ndarray, number: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers summed by (row, key), in that order; ``keys`` is above every key."""
    both = row * keys + key
    order = np.argsort(both, kind="stable")
    both = both[order]
    new = np.flatnonzero(np.diff(both, prepend=-1))
    return both[new] // keys, both[new] % keys, np.add.reduceat(number[order], new) if len(new) else number


@dataclass
class Aligned:
    """Aligned pieces: sizes and text of each, and links (key, number) from each piece's start on."""

    size: dict[str, np.ndarray]
    groups: list[str]
    same: tuple[np.ndarray, np.ndarray, np.ndarray]
    other: tuple[np.ndarray, np.ndarray, np.ndarray]


def align_pieces(tool: Aligner, parts: list[str]) -> tuple[Aligned, np.ndarray]:
    """The aligned parts, and which of them B gives back byte for byte."""
    raw = [(" " + p).encode() for p in parts]
    a, b = tool.encode(parts)
    good = np.ones(len(parts), bool)
    if b"".join([tool.b_bytes[i] for i in b.tolist()]) != b"".join(raw):
        for k, part in enumerate(parts):
            good[k] = b"".join([tool.b_bytes[i] for i in tool.encode([part])[1].tolist()]) == raw[k]
        parts, raw = [p for p, ok in zip(parts, good) if ok], [p for p, ok in zip(raw, good) if ok]
        a, b = tool.encode(parts)
    n = len(parts)
    end = np.cumsum([len(p) for p in raw]).astype(np.int64)
    end_a, end_b = np.cumsum(tool.a_length[a]), np.cumsum(tool.b_length[b])
    cut = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b, piece = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b), np.searchsorted(end, cut)
    n_a, n_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
    from_a, from_b = _starts(n_a), _starts(n_b)

    def by_piece(number: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(number))
        at = np.searchsorted(piece, np.arange(n + 1))
        return total[at[1:]] - total[at[:-1]]

    size = {"n_a": by_piece(n_a), "n_b": by_piece(n_b), "n_groups": by_piece(np.ones_like(n_a)),
            "n_links": by_piece(n_a * n_b)}
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[from_a + n_a - 1], last_b[from_b + n_b - 1] = True, True
    shown = np.empty(len(a) + len(b), np.int64)
    shown[np.arange(len(a)) + from_b[group_a]] = a + last_a * tool.size_a
    shown[np.arange(len(b)) + (from_a + n_a)[group_b]] = 2 * tool.size_a + b + last_b * tool.size_b
    text = [tool.shown[i] for i in shown.tolist()]
    at = np.append(0, np.cumsum(size["n_a"] + size["n_b"])).tolist()
    groups = ["".join(text[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]

    alone = (n_a == 1) & (n_b == 1)
    alone[alone] = tool.identity[a[from_a[alone]]] == b[from_b[alone]]
    # one-to-one groups follow the map; the others give all their pairs, large ones by distinct ids
    large = ~alone & (n_a * n_b > LARGE)
    token = np.flatnonzero(~(alone | large)[group_a])
    which, at_b = _spread(from_b[group_a[token]], n_b[group_a[token]])
    where, first, second = [piece[group_a[token[which]]]], [a[token[which]]], [b[at_b]]
    number = [np.ones(len(which), np.int64)]
    for g in np.flatnonzero(large):
        x, n_x = np.unique(a[from_a[g]:from_a[g] + n_a[g]], return_counts=True)
        y, n_y = np.unique(b[from_b[g]:from_b[g] + n_b[g]], return_counts=True)
        where.append(np.full(len(x) * len(y), piece[g]))
        first.append(np.repeat(x, len(y)))
        second.append(np.tile(y, len(x)))
        number.append(np.repeat(n_x, len(y)) * np.tile(n_y, len(x)))
    where, first, second, number = (np.concatenate(x) for x in (where, first, second, number))
    mapped = tool.identity[first] == second
    same = _sums(np.append(piece[alone], where[mapped]), np.append(a[from_a[alone]], first[mapped]),
                 np.append(np.ones(int(alone.sum()), np.int64), number[mapped]), tool.size_a)
    pair = first[~mapped] * tool.size_b + second[~mapped]
    other = _sums(where[~mapped], pair, number[~mapped], tool.size_a * tool.size_b)
    return Aligned(size, groups, *[(np.searchsorted(x[0], np.arange(n + 1)), x[1], x[2]) for x in (same, other)]), good


def _rows(doc: np.ndarray, values: np.ndarray, n: int) -> list[bytes]:
    at = np.searchsorted(doc, np.arange(n + 1)).tolist()
    return [values[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:])]


#: kind 1: a document of a block; 2: the block's pairs; 3: a task's vector, without its zeros.
_SCHEMA = ("kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "same binary, same_n binary, other binary, other_n binary, key array<long>, docs array<long>")
_ARROW = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in (
    "block", "doc_id", "n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()), *[(c, pa.binary()) for c in (
        "same", "same_n", "other", "other_n")], ("key", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])


def _record(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW],
        schema=_ARROW)


def _aligned_block(tool: Aligner, texts: list[str | None], digest: bool) -> tuple[dict, tuple, np.ndarray]:
    """Columns of the block's documents, its pairs with their documents, and the ids of A that hold the map."""
    known: dict[str, int] = {}
    words = [[known.setdefault(p, len(known)) for p in split(t)] if t else [] for t in texts]
    aligned, good = align_pieces(tool, list(known))
    if not good.all():
        place = np.cumsum(good) - 1
        words = [place[w].tolist() if w and good[w].all() else [] for w in words]
    n = len(texts)
    length = np.array([len(w) for w in words], np.int64)
    piece = np.fromiter(chain.from_iterable(words), np.int64, int(length.sum()))
    columns = {}
    for name, size in aligned.size.items():
        total = np.append(0, np.cumsum(size[piece]))
        columns[name] = total[np.cumsum(length)] - total[_starts(length)]
    shown = ["".join([aligned.groups[k] for k in w])[:-1] for w in words]
    columns["groups"] = [hashlib.sha256(g.encode()).hexdigest() if digest and g else g for g in shown]

    doc, piece, times = _sums(np.repeat(np.arange(n), length), piece, np.ones(len(piece), np.int64), len(known) + 1)

    def links(table: tuple[np.ndarray, np.ndarray, np.ndarray], keys: int):
        at, key, number = table
        which, place = _spread(at[piece], at[piece + 1] - at[piece])
        return _sums(doc[which], key[place], number[place] * times[which], keys)

    same_doc, same, same_n = links(aligned.same, tool.size_a)
    pair, local = np.unique(aligned.other[1], return_inverse=True)
    other_doc, other, other_n = links((aligned.other[0], local, aligned.other[2]), len(pair) + 1)
    columns |= {"same": _rows(same_doc, same.astype(np.int32), n), "same_n": _rows(same_doc, same_n, n),
                "other": _rows(other_doc, other.astype(np.int32), n), "other_n": _rows(other_doc, other_n, n)}
    return columns, (pair, np.bincount(other, minlength=len(pair))), same


def _encoded(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, pieces: str, digest: bool) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = aligner(vocabulary, pieces), TaskContext.get().partitionId() << 33
        vector = np.zeros(tool.size_a, np.int64)
        for block in blocks(batches, limit=BLOCK):
            texts = block.rows.column(1).to_pylist()
            columns, (pair, held), same = _aligned_block(tool, texts, digest)
            vector += np.bincount(same, minlength=tool.size_a)
            n = len(texts)
            yield _record(n, kind=np.full(n, 1), block=np.full(n, number), doc_id=block.rows.column(0), **columns)
            yield _record(1, kind=[2], block=[number], key=[pair], docs=[held])
            number += 1
        held = np.flatnonzero(vector)
        if len(held):
            yield _record(1, kind=[3], block=[number], key=[held], docs=[vector[held]])

    return stage(rows.mapInArrow(run, _SCHEMA), "aligned")


def _listed(encoded: DataFrame, kind: int) -> DataFrame:
    lists = encoded.filter(F.col("kind") == kind)
    return lists.select("block", F.inline(F.arrays_zip("key", "docs")))


def _counts(encoded: DataFrame, kind: int) -> DataFrame:
    return _listed(encoded, kind).groupBy("key").agg(F.sum("docs").alias("documents"))


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str = VOCABULARY, pieces: str = PIECES) -> DataFrame:
    """Every id pair that is linked somewhere: a_id, b_id, documents that hold it."""
    encoded = _encoded(docs, id_col, text_col, vocabulary, pieces, True)
    tool = aligner(vocabulary, pieces)
    # one row per id of A at most
    same = docs.sparkSession.createDataFrame(
        [(i, int(b)) for i, b in enumerate(tool.identity) if b >= 0], "key long, b_id long")
    same = _counts(encoded, 3).join(same, "key").select(F.col("key").alias("a_id"), "b_id", "documents")
    other = _counts(encoded, 2).select(
        F.floor(F.col("key") / tool.size_b).alias("a_id"), (F.col("key") % tool.size_b).alias("b_id"), "documents")
    return same.unionByName(other)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
          pieces: str = PIECES, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    n_best: links whose pair has the highest count of its id of A. count_sum: counts summed
    over links. groups: ``a1,a2|b1;a3|b2,b3``, or its SHA-256 with ``digest``.
    """
    encoded = _encoded(docs, id_col, text_col, vocabulary, pieces, digest)
    tool = aligner(vocabulary, pieces)
    size_a, size_b = tool.size_a, tool.size_b
    counts = stage(_counts(encoded, 2), "pair-counts")
    # both tables have one row per id of A at most
    followed, highest = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    for r in _counts(encoded, 3).collect():
        followed[r["key"]] = r["documents"]
    for r in counts.groupBy(F.floor(F.col("key") / size_b).alias("a")).agg(F.max("documents").alias("n")).collect():
        highest[r["a"]] = r["n"]
    highest = np.maximum(highest, followed)

    answers = _listed(encoded, 2).join(counts, "key").groupBy("block").agg(
        F.collect_list(F.struct("key", "documents")).alias("known"))
    answers = answers.select("block", F.lit(0).alias("kind"), F.col("known.key").alias("key"),
                             F.col("known.documents").alias("docs"))
    rows = encoded.filter("kind = 1").drop("key", "docs").unionByName(answers, allowMissingColumns=True)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, count, best = None, np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            kinds, numbers = batch.column("kind").to_pylist(), batch.column("block").to_pylist()
            same, same_n, other, other_n = (batch.column(c) for c in ("same", "same_n", "other", "other_n"))
            n_best, total = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for i, kind in enumerate(kinds):
                if kind == 0:
                    mine = numbers[i]
                    key = batch.column("key")[i].values.to_numpy(zero_copy_only=False)
                    count = batch.column("docs")[i].values.to_numpy(zero_copy_only=False)
                    order = np.argsort(key)
                    key, count = key[order], count[order]
                    best = count == highest[key // size_b]
                    continue
                a = np.frombuffer(same[i].as_py(), np.int32)
                n = np.frombuffer(same_n[i].as_py(), np.int64)
                n_best[i] = n[followed[a] == highest[a]].sum()
                total[i] = (n * followed[a]).sum()
                pair = np.frombuffer(other[i].as_py(), np.int32)
                if len(pair):
                    if numbers[i] != mine:
                        raise RuntimeError("a block's counts must come before its documents")
                    n = np.frombuffer(other_n[i].as_py(), np.int64)
                    n_best[i] += n[best[pair]].sum()
                    total[i] += (n * count[pair]).sum()
            out = {c: batch.column(c) for c in names if c not in ("n_best", "count_sum")}
            out |= {"n_best": pa.array(n_best), "count_sum": pa.array(total)}
            whole = pa.RecordBatch.from_arrays([out[c] for c in names], names)
            yield whole.filter(pa.array(np.array(kinds) == 1))

    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
