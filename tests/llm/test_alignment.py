"""Alignment of two tokenizers against whole-text encoding and plain sets of links."""

import bisect
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hemline.llm import alignment
from tests.llm.test_operators import ROWS, SCHEMA, prose

ODD = ["", " ", "  two", "trail ", "a  b   c", "\n\nx \n y\t z\r\n", "▁ held", "a▁b", "<s> <unk> <0x41> <|endoftext|>",
       "日本語 のテキスト 日本語", "näïve — ünïcode 😀😀 text", "é   x  y", "x" * 700, "ab " * 400,
       "don't we'll 12345 6,789.00 $%&/()=", "\x00 \x1c \x85 z", "𝔘𝔫𝔦 👩‍👩‍👧 क्षि ข้อความ"]


@pytest.fixture(scope="module")
def rows():
    texts = [(100 + k, t, "en", "s", 0) for k, t in enumerate(ODD + [ODD[9], prose(2500)])]
    return ROWS + texts


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = [F.lit("x").alias(c) for c in ("key", "kind", "block", "groups", "same", "n_a")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *clash).cache()


def ends(tokens):
    total, out = 0, []
    for t in tokens:
        total += len(t)
        out.append(total)
    return out


def linked(rows):
    """Per row: the number of tokens and groups, each link's number, and the groups as text; None without tokens."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    level = alignment.byte_levels()
    for doc_id, text, *_ in rows:
        if not text:
            yield doc_id, None
            continue
        mine, theirs = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        tokens_a = [bytes(level[c] for c in t) for t in mine.tokens]
        tokens_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                    for i, p in ((i, b.id_to_piece(i)) for i in theirs)]
        if b"".join(tokens_b) != (" " + text).encode():
            yield doc_id, None
            continue
        at_a, at_b = ends(tokens_a), ends(tokens_b)
        cuts = sorted(set(at_a) & set(at_b))
        groups = [([], []) for _ in cuts]
        for side, ids, at in ((0, mine.ids, at_a), (1, theirs, at_b)):
            for i, end in zip(ids, at):
                groups[bisect.bisect_left(cuts, end)][side].append(i)
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        shown = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        yield doc_id, (len(mine.ids), len(theirs), len(groups), links, shown)


def expected(rows):
    found = list(linked(rows))
    counts = Counter(pair for _, f in found if f for pair in f[3])
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = Counter()
    for doc_id, f in found:
        if f is None:
            out[doc_id, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        links = f[3]
        out[doc_id, *f[:3], sum(links.values()), sum(n for p, n in links.items() if counts[p] == highest[p[0]]),
            sum(n * counts[p] for p, n in links.items()), f[4]] += 1
    return out, counts


@pytest.mark.parametrize("block,run,large", [(2 << 20, 4096, 256), (3000, 5, 2)])
def test_alignment(docs, rows, monkeypatch, block, run, large):
    monkeypatch.setattr(alignment, "BLOCK", block)
    want, counts = expected(rows)
    got = Counter(tuple(r) for r in alignment.align(docs).collect())
    assert got == want
    if block < 2 << 20:
        return
    hashed = Counter((r.doc_id, r.groups) for r in alignment.align(docs, digest=True).collect())
    assert hashed == Counter({(k[0], hashlib.sha256(k[-1].encode()).hexdigest() if k[-1] else ""): 0 for k in want}) + \
        sum((Counter({(k[0], hashlib.sha256(k[-1].encode()).hexdigest() if k[-1] else ""): n}) for k, n in want.items()),
            Counter())
    pairs = {(r.a_id, r.b_id): r.documents for r in alignment.pair_counts(docs).collect()}
    assert pairs == counts


def test_pieces_of_a_block(rows, monkeypatch):
    """Small runs and groups that go by distinct ids give the same links."""
    tool = alignment.aligner(alignment.VOCABULARY, alignment.PIECES)
    texts = [t for _, t, *_ in rows]
    plain, (pair, held), same = alignment._aligned_block(tool, texts, False)
    monkeypatch.setattr(alignment, "RUN", 3)
    monkeypatch.setattr(alignment, "LARGE", 1)
    other, (pair2, held2), same2 = alignment._aligned_block(tool, texts, False)
    assert {k: list(v) for k, v in plain.items()} == {k: list(v) for k, v in other.items()}
    assert pair.tolist() == pair2.tolist() and held.tolist() == held2.tolist() and same.tolist() == same2.tolist()


def test_identity_map():
    tool = alignment.aligner(alignment.VOCABULARY, alignment.PIECES)
    for a, b in enumerate(tool.identity.tolist()):
        assert b < 0 or tool.a_bytes[a] == tool.b_bytes[b]
    assert (tool.identity >= 0).sum() > 10_000


def test_empty(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA)).collect() == []
    assert alignment.pair_counts(spark.createDataFrame([], SCHEMA)).collect() == []
