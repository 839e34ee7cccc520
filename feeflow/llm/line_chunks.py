"""Line dedup on content-defined chunks of lines, in built-in functions only.

Every line is hashed; a rolling hash over each line and the one before it decides whether a
chunk ends there, so boundaries depend on two lines only and come back at the same places
when lines are inserted or a passage moves. Chunks of two lines or more that occur more than
once anywhere are removed except for their first occurrence. Chunks are matched on a hash
first and then grouped by their bytes, so a hash collision removes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import BROADCAST_ROWS, checked_broadcast, saved

# A chunk ends after a line with probability 1 / DIVISOR.
DIVISOR = 3
# Of the rolling hash: the line before counts BASE times.
BASE = 31
# A byte that is not white space.
_WORDED = r"[^\x20\x09-\x0D]"


def _chunks(lines: Column, divisor: int) -> Column:
    """Chunks (first line, number of lines) of an array of lines, in order."""
    # No lambda refers to an array but its own: Spark would compute that anew for every element.
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long"))
    before = F.concat(F.array(F.lit(0).cast("long")), hashes)
    ends = F.zip_with(hashes, before, lambda h, b: (b * BASE + h) % divisor == 0)
    last = F.filter(F.transform(ends, lambda e, i: F.when(e, i + 1)), lambda i: i.isNotNull())
    last = F.array_distinct(F.concat(last, F.array(F.size(lines))))
    first = F.concat(F.array(F.lit(0)), last)
    return F.zip_with(F.slice(first, 1, F.size(last)), last, lambda a, b: F.struct((a + 1).alias("first"), (b - a).alias("n")))


def _chunk_units(docs: DataFrame, divisor: int) -> DataFrame:
    """Chunks of two lines or more with a byte that is not white space: id, xh, first and last line, bytes."""
    chunk = docs.select("id", "xh", "l", F.explode(_chunks(F.col("l"), divisor)).alias("c")).filter("c.n > 1")
    body = F.array_join(F.slice("l", F.col("c.first"), F.col("c.n")), "\n")
    chunk = chunk.select("id", "xh", F.lit(True).alias("chunk"), F.col("c.first").alias("first"), (F.col("c.first") + F.col("c.n") - 1).alias("last"), body.alias("bytes"))
    return chunk.filter(F.col("bytes").rlike(_WORDED))


def _window_units(docs: DataFrame) -> DataFrame:
    """All windows of two worded lines that follow each other but for lines without a word, which
    are not compared: columns as of _chunk_units."""
    worded = F.filter(F.transform("l", lambda x, i: F.struct((i + 1).alias("at"), x.alias("x"))), lambda s: s["x"].rlike(_WORDED))
    lines = docs.select("id", "xh", worded.alias("w")).filter(F.size("w") > 1)
    window = F.zip_with(
        F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1),
        lambda a, b: F.struct(a["at"].alias("first"), b["at"].alias("last"), F.concat(a["x"], F.lit("\n"), b["x"]).alias("bytes")),
    )
    return lines.select("id", "xh", F.explode(window).alias("u")).select("id", "xh", F.lit(False).alias("chunk"), "u.first", "u.last", "u.bytes")


def dedup_line_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """``dedup_line_chunks`` with every repeated passage of two worded lines or more removed whole.

    Units are the chunks of ``dedup_line_chunks`` and all windows of two worded lines; a copied
    passage consists of such windows wherever chunks end in it, so its edges, one-line chunks and
    passages shorter than a chunk go too. Lines of a unit are removed if the same bytes are a unit
    at an earlier place (as there) that it doesn't overlap; so the first place of every line stays.
    Lines without a word inside a repeated window go with it. n_removed_lines counts all lines
    removed, n_removed_chunks the repeated chunks. The rest is as in ``dedup_line_chunks``.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines", "n_removed_chunks")]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    base = base.select("id", F.xxhash64("text").alias("xh"), F.split("text", "\n", -1).alias("l"))
    here = F.struct("id", "xh", "first")
    unit = _chunk_units(base, divisor).union(_window_units(base))
    hashed = unit.select("id", "xh", "chunk", "first", "last", F.xxhash64("chunk", "bytes").alias("h"), "bytes")
    # Copies within the rows of one (id, text) are the same place, not a repeat.
    places = hashed.groupBy("h").agg(F.min(here).alias("lo"), F.max(here).alias("hi"))
    again = saved(places.filter("lo <> hi").select("h"), "unit_hashes")
    candidates = saved(hashed.join(checked_broadcast(again), "h"), "unit_candidates")
    firsts = candidates.groupBy("h", "chunk", "bytes").agg(F.min(F.struct("id", "xh", "first", "last")).alias("at"), F.max(here).alias("hi"))
    firsts = saved(firsts.filter("struct(at.id, at.xh, at.first) <> hi").select("h", "chunk", "bytes", "at"), "unit_firsts")
    same_text = F.col("id").eqNullSafe(F.col("at.id")) & (F.col("xh") == F.col("at.xh"))
    gone = candidates.join(firsts, ["h", "chunk", "bytes"]).filter(~(same_text & (F.col("first") <= F.col("at.last"))))
    gone = gone.select("id", "xh", "chunk", "first", F.explode(F.sequence("first", "last")).alias("line"))
    gone = saved(
        gone.groupBy(F.col("id").alias("g_id"), F.col("xh").alias("g_xh")).agg(
            F.array_sort(F.collect_set("line")).alias("g_lines"),
            F.size(F.collect_set(F.when(F.col("chunk"), F.col("first")))).cast("long").alias("g_chunks"),
        ),
        "removed_lines",
    )
    # Texts stay where they are while the lines to remove, arrays counted by their elements, are few.
    n_gone = gone.agg(F.sum(F.size("g_lines"))).first()[0] or 0
    gone = F.broadcast(gone) if n_gone <= BROADCAST_ROWS else gone
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    row = row.select("row", F.col("row")[id_col].alias("id"), F.xxhash64(F.col("row")[text_col]).alias("xh"))
    joined = row.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("xh") == F.col("g_xh")), "left")
    loses = F.col("g_lines").isNotNull() & F.col("text").isNotNull()
    cut = joined.select("row", "g_lines", "g_chunks", F.col("row")[text_col].alias("text")).withColumn("l", F.split("text", "\n", -1))
    kept_at = F.array_except(F.sequence(F.lit(1), F.size("l")), "g_lines")
    # The lambda reads l, a column of the projection before (used more than once, so not inlined).
    kept = F.array_join(F.transform(kept_at, lambda i: F.element_at("l", i)), "\n")
    zero = F.lit(0).cast("long")
    return cut.select(
        *[F.when(loses, kept).otherwise(F.col("text")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in own],
        F.when(F.col("text").isNull(), zero).otherwise(F.size("l").cast("long")).alias("n_lines"),
        F.when(loses, F.size("g_lines").cast("long")).otherwise(zero).alias("n_removed_lines"),
        F.when(loses, F.col("g_chunks")).otherwise(zero).alias("n_removed_chunks"),
    )


def dedup_line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with ``text`` replaced by what is kept, plus n_lines, n_removed_lines and
    n_removed_chunks (long); columns of ``docs`` with these three names are replaced.

    Lines are what \\n separates. A chunk is removed if it has two lines or more, one of them
    with a byte other than white space, and the same bytes are a chunk at an earlier place: a
    smaller (id, text hash), nulls first, or earlier in the same text. Kept lines keep their
    order and are joined by \\n again. Rows that agree in id and text count as one document and
    lose the same chunks. A null text stays null with 0 lines; an empty text is one line; an
    empty table gives no rows. Other columns pass through.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines", "n_removed_chunks")]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    chunk = base.select("id", F.xxhash64("text").alias("xh"), F.split("text", "\n", -1).alias("l")).select(
        "id", "xh", "l", F.posexplode(_chunks(F.col("l"), divisor)).alias("no", "c")
    )
    body = F.array_join(F.slice("l", F.col("c.first"), F.col("c.n")), "\n")
    chunk = chunk.filter("c.n > 1").select("id", "xh", "no", body.alias("bytes")).filter(F.col("bytes").rlike(r"[^\x20\x09-\x0D]"))
    hashed = chunk.select("id", "xh", "no", F.xxhash64("bytes").alias("h"), "bytes")
    # Copies within the rows of one (id, text) are the same place, not a repeat.
    places = hashed.groupBy("h").agg(F.min(F.struct("id", "xh", "no")).alias("lo"), F.max(F.struct("id", "xh", "no")).alias("hi"))
    again = saved(places.filter("lo <> hi").select("h"), "chunk_hashes")
    candidates = saved(hashed.join(checked_broadcast(again), "h"), "chunk_candidates")
    first = saved(
        candidates.groupBy("h", "bytes").agg(F.min(F.struct("id", "xh", "no")).alias("at"), F.count("*").alias("m")).filter("m > 1").select("h", "bytes", "at"),
        "chunk_firsts",
    )
    here = F.struct("id", "xh", "no")
    gone = candidates.join(first, ["h", "bytes"]).filter(~here.eqNullSafe(F.col("at"))).select("id", "xh", "no")
    gone = saved(
        gone.groupBy(F.col("id").alias("g_id"), F.col("xh").alias("g_xh")).agg(F.collect_set("no").alias("g_no")), "removed_chunks"
    )
    # Texts stay where they are while the chunks to remove, arrays counted by their elements, are few.
    n_gone = gone.agg(F.sum(F.size("g_no"))).first()[0] or 0
    gone = F.broadcast(gone) if n_gone <= BROADCAST_ROWS else gone
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    row = row.select("row", F.col("row")[id_col].alias("id"), F.xxhash64(F.col("row")[text_col]).alias("xh"))
    joined = row.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("xh") == F.col("g_xh")), "left")
    # One projection: rows that lose nothing skip the chunking.
    loses = F.col("g_no").isNotNull() & F.col("text").isNotNull()
    cut = joined.select("row", "g_no", F.col("row")[text_col].alias("text")).withColumn("l", F.split("text", "\n", -1))
    cut = cut.withColumn("cs", F.when(loses, _chunks(F.col("l"), divisor)))
    kept_chunks = F.filter("cs", lambda c, i: ~F.array_contains(F.col("g_no"), i))
    kept = F.array_join(F.transform(kept_chunks, lambda c: F.array_join(F.slice("l", c["first"], c["n"]), "\n")), "\n")
    removed = F.aggregate(
        F.filter("cs", lambda c, i: F.array_contains(F.col("g_no"), i)), F.lit(0).cast("long"), lambda a, c: a + c["n"]
    )
    zero = F.lit(0).cast("long")
    return cut.select(
        *[F.when(loses, kept).otherwise(F.col("text")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in own],
        F.when(F.col("text").isNull(), zero).otherwise(F.size("l").cast("long")).alias("n_lines"),
        F.when(loses, removed).otherwise(zero).alias("n_removed_lines"),
        F.when(loses, F.size("g_no").cast("long")).otherwise(zero).alias("n_removed_chunks"),
    )
