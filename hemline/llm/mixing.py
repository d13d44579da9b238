"""Mixing sources to target weights by systematic sampling, with SQL functions only.

Within a source every document has the same expected number of copies, target / size of
the source, so the prefix sum of expected copies at a document is its place times that
rate. One offset per source is added, and a document is emitted once for every integer
that its step crosses. Places follow document sizes, so that the words taken come as
near the target as one document allows.

Places are counted in two steps: (source, size class, salt) groups are numbered among
their source by their totals, and rows within their group, so a source that holds most
rows is spread over many tasks.

Null text has size 0; a null source is a source of its own, the last; null and repeated
ids are rows like others (equal rows share their copies in any order); an empty table
gives no rows. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hemline.llm.common import ROW, SPACE_CLASS, WORD_CLASS, numbered, stage

#: Weights by rank of the source, repeated. Fixed values.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
SALTS = 256


def word_count(text: Column) -> Column:
    """Number of maximal runs of visible characters, null as none."""
    marks = F.regexp_replace(text, f"{SPACE_CLASS}*{WORD_CLASS}+{SPACE_CLASS}*", "x")
    return F.when(text.rlike(WORD_CLASS), F.length(marks)).otherwise(0).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """Targets by source from (source, source_size), one row per source.

    The share of all words is dealt by weight; what exceeds ``most`` times a source's size
    is dealt anew by weight among the others. That is the level at which sources, taken by
    size per weight, are no longer full.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    need = F.col("source_size") * F.lit(float(most)) / F.col("weight")
    up = Window.orderBy("need", F.col("source").asc_nulls_last())
    below = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    levels = ranked.withColumn("need", need).select(
        "source", "source_size", "weight", "need",
        F.sum("source_size").over(everything).alias("all_size"),
        F.coalesce(F.sum("source_size").over(below), F.lit(0)).alias("full_size"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(below), F.lit(0))).alias("open_weight"))
    level = (F.col("all_size") * F.lit(float(share)) - F.col("full_size") * F.lit(float(most))) \
        / F.col("open_weight")
    # full sources come first in this order; the first that is not full has the level of all
    # others, and those after it, which take it for full, a lower one
    filled = levels.withColumn("level", level).withColumn(
        "at", F.max(F.when(F.col("need") > F.col("level"), F.col("level"))).over(everything))
    target = F.least(F.col("source_size") * F.lit(float(most)),
                     F.coalesce(F.col("weight") * F.col("at"), F.lit(float("inf"))))
    return filled.select("source", "source_size", target.alias("target"))


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
               share: float = SHARE, most: float = MOST_COPIES, salts: int = SALTS,
               row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, and ``row_col`` if given."""
    own = [] if row_col is None else [row_col]
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), *own), "mix-sizes")
    bits = F.length(F.bin("size"))
    # size classes a sixteenth of their octave wide; the salt splits documents of one size
    rows = rows.select(
        "doc_id", "source", "size", *own, bits.alias("bits"),
        F.floor(F.col("size") / F.pow(F.lit(2.0), F.greatest(bits - 5, F.lit(0)))).alias("step"),
        F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.lit(salts)).alias("salt"))
    group = ["source", "bits", "step", "salt"]
    totals = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    totals = stage(totals, "mix-groups")
    by_source = totals.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = stage(source_targets(by_source, weights, share, most), "mix-targets")
    # salts are summed within their size class, and classes (a few hundred) within their source
    classes = totals.groupBy("source", "bits", "step").agg(F.sum("n").alias("n"))
    by_class = Window.partitionBy("source").orderBy("bits", "step")
    classes = classes.select("source", "bits", "step", (F.sum("n").over(by_class) - F.col("n")).alias("lower"))
    by_salt = Window.partitionBy("source", "bits", "step").orderBy("salt")
    inside = totals.select(*group, (F.sum("n").over(by_salt) - F.col("n")).alias("before"))
    starts = inside.join(classes, inside["source"].eqNullSafe(classes["source"])
                         & (inside["bits"] == classes["bits"]) & (inside["step"] == classes["step"])).select(
        *[inside[c] for c in group], (F.col("before") + F.col("lower")).alias("before"))
    same = [rows[c].eqNullSafe(starts[c]) if c == "source" else rows[c] == starts[c] for c in group]
    within = Window.partitionBy("source", "bits", "step", "salt").orderBy("size", "doc_id", *own)
    placed = rows.join(starts, same).select(*[rows[c] for c in rows.columns], "before") \
        .withColumn("place", F.col("before") + F.row_number().over(within))
    out = placed.join(targets, placed["source"].eqNullSafe(targets["source"])).select(
        "doc_id", placed["source"], "size", "source_size", "target", "place", *own)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    digest = F.md5(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))
    # a fraction of 20 bits stays exact when whole numbers are added to it
    offset = F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / F.lit(1048576.0)
    crossed = F.floor(offset + F.col("place") * rate) - F.floor(offset + (F.col("place") - 1) * rate)
    copies = F.least(crossed, F.lit(int(most))).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *own)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each row repeated as often as it is taken."""
    rows = numbered(docs)
    plan = mix_copies(rows, row_col=ROW, **options).filter("copies > 0")
    wanted = plan.select(F.col(ROW).alias("__taken"), F.col("copies").alias("__copies"))
    joined = rows.join(wanted, rows[ROW] == wanted["__taken"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))) \
        .select(*[rows[c] for c in docs.columns])
