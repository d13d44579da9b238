"""Scans for secrets with SQL functions only: patterns, and entropy of candidate strings.

Three patterns give the base spans. The entropy scan adds spans: a candidate is a run of
at least ``WINDOW`` characters of encoded data with a digit and a letter, not matched by
the allow-list. A window slides over it; each step changes the counts of two characters,
so the window's sum of c * log2(c) is kept by four table reads. A window is hot when its
Shannon entropy reaches the limit of the candidate's character class (hexadecimal, or all
of base64); the span goes from the first hot window to the end of the last.

Places of matches are prefix sums of the lengths of gaps and matches, counted per row and
kind after the text is dropped, so long texts with many matches stay linear.

Null text counts as empty. A row without spans has counts 0, the digest of the empty
string and an empty list. Null and repeated ids are rows of their own, an empty table
gives no rows, and other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from hemline.llm.common import ROW, numbered

#: Kinds in their order, with pattern and group of the value. Fixed values.
ASSIGN = (r"(?:([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
HEX_CLASS = r"^[0-9A-Fa-f]+$"
#: Bits per character from which a window is hot.
HEX_BITS, BASE64_BITS = 3.0, 3.75
#: Candidates that are no secrets: sample values, alphabets, UUIDs, paths of words.
ALLOW = (
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]",
    r"0123456789|abcdefghij|ABCDEFGHIJ",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^[a-z/_-]*/[a-z0-9/_-]*$",
)
#: c * log2(c) in millionths, for c = 0 .. WINDOW.
BITS = [0, 0] + [round(c * math.log2(c) * 1e6) for c in range(2, WINDOW + 1)]


def most_sum(bits: float) -> int:
    """The largest sum of c * log2(c), in millionths, at which a window has ``bits``."""
    return WINDOW * (round(math.log2(WINDOW) * 1e6) - round(bits * 1e6))


#: The characters of a candidate, each with its place in a text of counts.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A count as one character, 0 first.
LEVELS = "ABCDEFGHIJKLMNOPQRSTU"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hot_range(candidate: Column) -> Column:
    """Struct (first, last): places, from 1, of the first and last character in hot windows; 0 if none.

    The window's counts are a text with a character for each of the alphabet. A step lowers the
    count of the character that leaves, raises that of the one that comes, and corrects the sum
    of c * log2(c) by these two, so its cost does not depend on the window.
    """
    table = F.array(*[F.lit(b).cast("long") for b in BITS])
    limit = F.when(candidate.rlike(HEX_CLASS), most_sum(HEX_BITS)).otherwise(most_sum(BASE64_BITS))
    start = F.struct(F.lit(LEVELS[0] * len(ALPHABET)).alias("n"), F.lit(0).cast("long").alias("s"),
                     F.lit("").alias("w"), F.lit(0).alias("i"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def changed(state: Column, character: Column, by: int) -> Column:
        """Struct (n, s) with one character's count changed by 1."""
        def at(place: Column) -> Column:
            def level(count: Column) -> Column:  # from 1
                return F.struct(
                    F.overlay(state["n"], F.substring(F.lit(LEVELS), count + by, 1), place, 1).alias("n"),
                    (state["s"] + F.element_at(table, count + by) - F.element_at(table, count)).alias("s"))

            return _let(F.instr(F.lit(LEVELS), F.substring(state["n"], place, 1)), level)

        return _let(F.instr(F.lit(ALPHABET), character), at)

    def step(acc: Column, c: Column) -> Column:
        place = acc["i"] + 1
        # what leaves goes first, so no count exceeds the window
        full = place > WINDOW
        left = F.when(full, changed(acc, F.substring(acc["w"], 1, 1), -1)).otherwise(
            F.struct(acc["n"].alias("n"), acc["s"].alias("s")))
        window = F.concat(F.when(full, F.substring(acc["w"], 2, WINDOW)).otherwise(acc["w"]), c)

        def moved(now: Column) -> Column:
            hot = (place >= WINDOW) & (now["s"] <= limit)
            return F.struct(
                now["n"].alias("n"), now["s"].alias("s"), window.alias("w"), place.alias("i"),
                F.when(hot & (acc["first"] == 0), place - WINDOW + 1).otherwise(acc["first"]).alias("first"),
                F.when(hot, place).otherwise(acc["last"]).alias("last"))

        return _let(_let(left, lambda state: changed(state, c, 1)), moved)

    return F.aggregate(F.split(candidate, ""), start, step,
                       lambda acc: F.struct(acc["first"], acc["last"]))


def _found(text: Column, kind: int, pattern: str, group: int = 0) -> Column:
    """Array of (kind, gap before the match, match, value) of one pattern.

    The piece after the last match comes as a last entry without a match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"),
                           x["whole"].alias("whole"), x["value"].alias("value")))
    empty = F.array().cast("array<struct<kind:int,gap:int,whole:string,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(empty)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per document: row (its place in the scan), doc_id, spans.

    ``spans`` is an array of (start, kind number, stop) in code points, sorted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    everything = F.concat(_found(text, 0, ASSIGN, 2), _found(text, 1, ACCESS),
                          _found(text, 2, HEX), _found(text, 3, CANDIDATE))
    # numbered before the explode, which would otherwise number its own rows
    numbered = docs.select(F.monotonically_increasing_id().alias("row"),
                           F.col(id_col).alias("doc_id"), everything.alias("found"))
    rows = numbered.select("row", "doc_id", F.posexplode_outer("found").alias("at", "m"))
    value = F.col("m.value")
    candidate = (F.col("m.kind") == 3) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    for pattern in allow:
        candidate = candidate & ~value.rlike(pattern)
    rows = rows.select(
        "row", "doc_id", "at", F.col("m.kind").alias("kind"), F.col("m.gap").alias("gap"),
        F.coalesce(F.length("m.whole"), F.lit(0)).alias("n"),
        ((F.col("m.kind") == 0) & (F.length(value) >= LEAST_VALUE)
         | F.col("m.kind").isin(1, 2) & F.col("m.whole").isNotNull()).alias("base"),
        F.when(candidate, hot_range(value)).alias("hot"))
    running = Window.partitionBy("row", "kind").orderBy("at")
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.col("n")).over(running))
    start = F.col("stop") - F.col("n")
    span = F.when(F.col("base"), F.struct(start.alias("start"), F.col("kind"), F.col("stop"))).when(
        F.col("hot.last") > 0, F.struct((start + F.col("hot.first") - 1).alias("start"), F.col("kind"),
                                        (start + F.col("hot.last")).alias("stop")))
    return rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"),
                                   F.sort_array(F.collect_list(span)).alias("spans"))


def _text_of(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secrets_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans as text."""
    found = scan(docs, **options)
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(_text_of(base), 256).alias("base_sha256"),
                        _text_of(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """The documents with every span replaced by a mark, rows of null or repeated ids each by its own spans."""
    rows = numbered(docs)
    found = scan(rows, ROW, text_col, **options).select(F.col("doc_id").alias(ROW), F.col("spans").alias("__spans"))
    joined = rows.join(found, ROW)
    text = rows[text_col]
    # overlapping spans join: each keeps only what lies beyond the farthest stop so far
    done = F.aggregate(
        "__spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(
                F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.lit(mark))).otherwise(F.lit(""))).alias("out"),
            s["stop"].alias("at"))))
    new = F.when(F.size("__spans") == 0, text).otherwise(
        F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    return joined.select(*[new.alias(c) if c == text_col else rows[c] for c in docs.columns])
