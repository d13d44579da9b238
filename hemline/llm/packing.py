"""Packing into fixed windows: concatenate and cut.

Pass one tokenizes each scan partition and notes every document's place in it. Prefix
sums over the partitions' totals (one small row per partition) turn places into global
offsets. Pass two cuts the endless row of ids at the multiples of the window. A window
that lies in one partition is complete there; one that spans partitions is made of
boundary records, marked as such, which ``sequences`` merges.

Null text counts as empty: its document is the end id alone. Null and repeated ids are
kept, one document per row. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hemline.llm.common import ship, stage

WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
#: Pieces of text whose ids a worker remembers before it starts anew.
REMEMBERED = 400_000
_LONG = 64

#: A blank between two visible characters always starts a new pre-token.
_BREAK = re.compile(r"(?<!\s) (?=\S)")
_SPACES = re.compile(r"\s ")


class Ids(dict):
    """Little-endian 32-bit ids by piece of text, filled on demand.

    The vocabulary never joins text across a blank that stands between two visible
    characters, so pieces can be encoded apart. Pieces of Latin letters go to the fast
    encoder of the same vocabulary where its ranks are at hand.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.fast = None
        ranks = re.sub(r"\.json$", ".tiktoken", path)
        try:
            lines = open(ranks, "rb").read().splitlines()
        except FileNotFoundError:
            return
        import public_tokenizers

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=table, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if self.fast is not None and max(piece, default=" ") < "ɐ":
            ids = self.fast.encode_ordinary(piece)
        else:
            ids = self.slow.encode(piece, add_special_tokens=False).ids
        out = np.asarray(ids, "<u4").tobytes()
        if len(piece) <= _LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        parts = _BREAK.split(text) if _SPACES.search(text) else text.split(" ")
        first = parts[0]
        if len(parts) == 1:
            return self[first]
        if text[0] == " " and not first:  # one leading blank belongs to the first word
            parts = parts[1:]
            first = " " + parts[0]
        return self[first] + b"".join([self[" " + p] for p in parts[1:]])


_loaded: dict[str, Ids] = {}


def ids_of(vocabulary: str) -> Ids:
    """The worker's encoder for a vocabulary file, loaded once a worker."""
    if vocabulary not in _loaded:
        import public_tokenizers

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        _loaded[vocabulary] = Ids(path)
    return _loaded[vocabulary]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per document: its partition, ids before it there, number of ids, the ids."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = ids_of(vocabulary), TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                ids = [encoder.encode(t or "") + end for t in piece.column(1).to_pylist()]
                n = np.asarray([len(x) // 4 for x in ids], np.int64)
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(before), piece.column(0),
                     pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "at", "doc_id", "n", "ids"])

    return rows.mapInArrow(run, "part int, at long, doc_id long, n long, ids binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a window, with its ids.

    Columns: doc_id, start (the document's ids before the piece), length, doc_tokens,
    sequence_id, offset (place in the window), boundary (the window spans partitions),
    ids (little-endian 32-bit).
    """
    tokens = stage(tokenize(docs, id_col, text_col, vocabulary, end_id), "tokens")
    total = tokens.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    # one row per scan partition; staged, so that its real size decides how it is joined
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    starts = stage(total.select("part", "total", before.alias("before")), "token-starts")
    g = F.col("before") + F.col("at")
    placed = tokens.join(starts, "part").select(
        "doc_id", "n", "ids", "before", (F.col("before") + F.col("total")).alias("after"), g.alias("g"))

    def piece(s):
        start = F.greatest(s * window - F.col("g"), F.lit(0).cast("long"))
        stop = F.least((s + 1) * window - F.col("g"), F.col("n"))
        return F.struct(
            start.alias("start"), (stop - start).alias("length"), s.alias("sequence_id"),
            (F.col("g") + start - s * window).alias("offset"),
            ((s * window < F.col("before")) | ((s + 1) * window > F.col("after"))).alias("boundary"),
            F.substring("ids", (4 * start + 1).cast("int"), (4 * (stop - start)).cast("int")).alias("ids"))

    first = F.floor(F.col("g") / window).cast("long")
    last = F.floor((F.col("g") + F.col("n") - 1) / window).cast("long")
    pieces = placed.select("doc_id", F.col("n").alias("doc_tokens"),
                           F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    return pieces.select("doc_id", "p.start", "p.length", "doc_tokens", "p.sequence_id",
                         "p.offset", "p.boundary", "p.ids")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per window: sequence_id, length, ids (array of ints, padded at the end).

    Only the last window can be short. It is padded to ``window`` unless its length is a
    power of two. A group holds at most ``window`` ids.
    """
    ship(pieces.sparkSession)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column(2).to_pylist():
                ids = np.frombuffer(raw, "<u4").astype(np.int32)
                short = len(ids) & (len(ids) - 1)
                out.append(np.pad(ids, (0, window - len(ids)), constant_values=pad_id) if short else ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))],
                ["sequence_id", "length", "ids"])

    return rows.select("sequence_id", "length", "ids").mapInArrow(
        run, "sequence_id long, length long, ids array<int>")
