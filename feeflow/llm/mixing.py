"""Mixing sources to target weights by Pareto order sampling, in built-in functions only.

Every source gets a target (water-filling of the weights below a cap), hence k = target / size
copies per unit. Whole copies floor(k) of every document are certain. For the remaining fraction f
documents are ranked by the odds of a uniform random number divided by the odds of their
inclusion, and the smallest are taken until the fixed size is met as closely as whole documents
allow: a fixed-size sample with unequal probabilities. Inclusion odds are f / (1 - f) times a
tilt of the document; a factor common to a source does not change its order, so nothing has
to be calibrated.

Ranks are cut in two steps, so that no source is sorted in one task: cells of equal rank ranges,
about sqrt(documents) of them per source, are added up; only the documents of the cell where the
size is met are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeflow.llm.store import saved

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """source, source_size, n, cells, target from rows (source, size).

    Sources in code point order, null last, weigh 1, 2, 3 and so on from 1 again and share the
    total of all sizes by weight; no target exceeds ``cap`` times its source's size, and the
    excess is shared again by weight among the others until none is above. Ranks of sources
    come from a sorted, written table, so any number of sources works.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ordered = saved(per.orderBy(F.asc_nulls_last("source")).withColumn("row", F.monotonically_increasing_id()), "sources")
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    # A row per written part, not per source.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(part.alias("part")).count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    weighed = saved(
        ordered.withColumn("part", part).join(parts, "part").withColumn("weight", (F.col("before") + place) % 3 + 1), "weights"
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while True:  # each round caps at least one source more; a handful of rounds
        w, held, n = weighed.agg(
            F.coalesce(F.sum(F.when(F.expr(f"{cap!r}D * source_size > {share!r}D * weight") | F.lit(full < 0), F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~(F.expr(f"{cap!r}D * source_size > {share!r}D * weight") | F.lit(full < 0)), F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~(F.expr(f"{cap!r}D * source_size > {share!r}D * weight") | F.lit(full < 0)), 1)), F.lit(0)),
        ).first()
        if n == full or not w:
            break
        full = n
        share = (total - cap * held) / w
    target = F.least(F.lit(float(cap)) * F.col("source_size"), F.lit(share) * F.col("weight"))
    cells = F.ceil(F.sqrt("n")).cast("long")
    return weighed.select("source", "source_size", "n", cells.alias("cells"), target.alias("target"))


def uniform(id_col: str, seed: str) -> Column:
    """A number in (0, 1) from the id as text (null: empty) and the seed, the same in every run."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix_to_targets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: float = 3.0, seed: str = "mix"
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken.

    size is the number of words (null text: 0), source_size and target belong to the row's
    source (``source_targets``), copies is how often the mix takes the row (at most ``cap``
    rounded up, never more than ``cap`` copies where it is whole), taken = copies * size.
    The tilt of a document's inclusion odds is sqrt(size / 256) between 1/2 and 2: of two
    documents the longer one is somewhat more likely to be taken once more. Within a source
    the taken words differ from the target by half a document at most, or by half a group of
    repeated ids, which have one rank and are ordered by size. Documents without words count
    nothing and take the whole copies. Null sources are one source, the last; null ids have one rank.
    Reruns agree. Other columns are ignored; an empty table gives no rows.
    """
    n_words = F.coalesce(F.size(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")
    tilt = F.greatest(F.lit(0.5), F.least(F.lit(2.0), F.sqrt(F.col("size") / 256.0)))
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words.alias("size"))
    sized = sized.withColumn("u", uniform("id", seed))
    # Odds of u over odds of inclusion (the source's common factor left out), mapped to (0, 1).
    rank = F.col("u") / (1 - F.col("u")) / tilt
    sized = saved(sized.withColumn("rank", rank).select("id", "source", "size", (F.col("rank") / (1 + F.col("rank"))).alias("rank")), "mix_sizes")
    targets = saved(source_targets(sized, cap).select(F.col("source").alias("t_source"), "source_size", "n", "cells", "target"), "mix_targets")
    k = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(k + 1e-12), F.lit(int(cap))).cast("long")
    targets = targets.withColumn("whole", whole).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).withColumn(
        "cell", F.least(F.floor(F.col("rank") * F.col("cells")), F.col("cells") - 1)
    )
    # Cells up to the one in which the rest is met; a cell per sqrt(n) documents.
    by_rank = Window.partitionBy("t_source").orderBy("cell")
    cells = joined.filter("rest > 0").groupBy("t_source", "cell", "rest").agg(F.sum("size").alias("words"))
    cells = cells.withColumn("upto", F.sum("words").over(by_rank)).filter("upto >= rest")
    meets = cells.groupBy("t_source").agg(F.min(F.struct("cell", "upto", "words", "rest")).alias("m"))
    meets = saved(
        meets.select(F.col("t_source").alias("m_source"), F.col("m.cell").alias("m_cell"), (F.col("m.upto") - F.col("m.words")).alias("before"), F.col("m.rest").alias("m_rest")),
        "mix_cells",
    )
    inside = joined.join(meets, F.col("t_source").eqNullSafe(F.col("m_source")) & (F.col("cell") == F.col("m_cell")))
    inside = inside.groupBy("m_source", "before", "m_rest", "rank", "size").agg(F.count("*").alias("rows"))
    running = Window.partitionBy("m_source").orderBy("rank", "size")
    inside = inside.withColumn("upto", F.col("before") + F.sum(F.col("size") * F.col("rows")).over(running))
    inside = inside.withColumn("start", F.col("upto") - F.col("size") * F.col("rows"))
    # The last (rank, size) taken: as long as taking it brings the sum nearer to the rest.
    near = inside.filter("abs(upto - m_rest) <= abs(start - m_rest)").groupBy("m_source").agg(F.max(F.struct("rank", "size")).alias("last"))
    cut = saved(near.select(F.col("m_source").alias("c_source"), "last"), "mix_cuts")
    cut = meets.join(cut, F.col("m_source").eqNullSafe(F.col("c_source")), "left").select("m_source", "m_cell", "last")
    out = joined.join(cut, F.col("t_source").eqNullSafe(F.col("m_source")), "left")
    more = F.when(F.col("cell") < F.col("m_cell"), 1).when(
        (F.col("cell") == F.col("m_cell")) & (F.struct("rank", "size") <= F.col("last")), 1
    )
    copies = (F.col("whole") + F.coalesce(more, F.lit(0))).cast("long")
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
