"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes covering it also starts at another position of
any text. Sorting all suffixes would shuffle several times the input, so buckets are
refined only where they can still matter:

* Initial buckets: q-grams of half the length. Of each window of ``length`` bytes only the
  leftmost smallest of its q-gram hashes counts (its anchor). Equal windows have equal
  anchors at equal places, so windows are kept as runs that share an anchor, about one run
  in 100 bytes, and a bucket (anchor value) with one run is final: nothing in it repeats.
* Refinement: units of a bucket are sorted on an identifier of all the bytes at later (and
  earlier) offsets that their windows reach. Units equal in it are repeated as a whole and
  stand for each other from then on, so each distinct unit is refined once and its count
  reused. The others are split into cells of fewer windows, aligned to the anchor, whose
  buckets are the bytes that all windows of the cell share; in the last round a unit is one
  window, whose bucket is the pair of q-gram identifiers at offsets 0 and q.

Identifiers are 64-bit fingerprints of bytes (two of them side by side where strings are
compared) instead of dense ranks, so no global sort has to number them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import checked_broadcast, saved
from feeflow.llm.text import Texts, mix, powers, texts_of

# Windows per unit in the rounds after the first.
CELLS = (16, 1)


class _Hashes:
    """Fingerprints of any byte range of the texts of a slice."""

    def __init__(self, t: Texts):
        self.s = t.prefix(False)
        self.down = powers(len(t.buf) + 1)[1]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.s[end] - self.s[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, q: int) -> np.ndarray:
        n = len(self.s) - q
        return mix((self.s[q:] - self.s[:n]) * self.down[:n] + np.uint64(q)) if n > 0 else np.zeros(0, np.uint64)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i that has w values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-(-len(x) // w) * w, np.uint64(2**64 - 1))
    pad[: len(x)] = x
    blocks = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def _runs(t: Texts, length: int) -> tuple[np.ndarray, ...]:
    """text, start, windows, anchor - start, anchor value and whole value of each run."""
    q = length // 2
    h = _Hashes(t)
    g = h.grams(q)
    bits = np.uint64(max(1, len(g)).bit_length())
    key = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    low = _sliding_min(key, length - q + 1)
    if not len(low):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    anchor = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    size = np.diff(t.off)
    long = np.flatnonzero(size >= length)
    valid = np.zeros(len(low) + 1, bool)
    for i in long:
        valid[t.off[i] : t.off[i + 1] - length + 1] = True
    valid = valid[: len(low)]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    s, e = np.flatnonzero(first), np.flatnonzero(last)
    doc = np.searchsorted(t.off, s, "right") - 1
    a = anchor[s]
    return doc, s - t.off[doc], e - s + 1, a - s, g[a], h.of(s, e + length)


def _map_runs(it: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for lo, hi, t in texts_of(batch.column("text")):
            doc, s, n, rel, core, full = _runs(t, length)
            at = pa.array(doc + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("xh").take(at), pa.array(s), pa.array(n.astype(np.int32)), pa.array(rel.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(full.view(np.int64))],
                ["id", "xh", "s", "n", "rel", "core", "full"],
            )


def _split(it: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Units of ``width`` windows from the units listed with each text."""
    q = length // 2
    for batch in it:
        units = batch.column("units")
        for lo, hi, t in texts_of(batch.column("text")):
            part = units.slice(lo, hi - lo)
            flat = part.flatten()
            text = np.repeat(np.arange(hi - lo), pa.compute.list_value_length(part).to_numpy(zero_copy_only=False))
            s, n, rel, c = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("s", "n", "rel", "c"))
            h = _Hashes(t)
            row = np.repeat(np.arange(len(s)), n)
            w = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + s[row]  # each window's start in its text
            anchor = (s + rel)[row]
            cell = (w - anchor) // width
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
            f = np.flatnonzero(first)
            row, w, anchor, cell = row[f], w[f], anchor[f], cell[f]
            windows = np.diff(np.concatenate((f, [len(first)])))
            base = t.off[text[row]]
            if width == 1:
                core = h.of(base + w, base + w + q)
                full = h.of(base + w + q, base + w + length)
            else:
                mid, end = base + anchor + (cell + 1) * width - 1, base + anchor + cell * width + length
                inside = (mid >= base) & (end <= t.off[text[row] + 1])  # else the cell is cut by the text's edge
                mid, end = np.where(inside, mid, base + w + windows - 1), np.where(inside, end, base + w + length)
                core = mix(h.of(mid, end) + cell.astype(np.uint64))
                full = mix(h.of(base + w, base + w + windows + length - 1) + (w - anchor).astype(np.uint64))
            at = pa.array(text[row] + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("xh").take(at), pa.array(w), pa.array(windows.astype(np.int32)), pa.array((anchor - w).astype(np.int32)), pa.array(core.view(np.int64)), pa.array(full.view(np.int64)), pa.array(c[row])],
                ["id", "xh", "s", "n", "rel", "core", "full", "c"],
            )


def _cut(it: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out: list[tuple] = []
        runs = batch.column("runs")
        ends = runs.offsets.to_numpy()
        s_all = runs.values.field("s").to_numpy(zero_copy_only=False)
        n_all = runs.values.field("n").to_numpy(zero_copy_only=False)
        null = runs.is_null().to_numpy(zero_copy_only=False)
        for lo, _, t in texts_of(batch.column("text")):
            for i in range(len(t)):
                raw = t.buf[t.off[i] : t.off[i + 1]]
                spans = removed = 0
                if not null[lo + i]:
                    a, b = ends[lo + i], ends[lo + i + 1]
                    order = np.argsort(s_all[a:b], kind="stable")
                    s = s_all[a:b][order]
                    e = s + n_all[a:b][order] + length - 1
                    top = np.maximum.accumulate(e)
                    new = np.ones(len(s), bool)
                    new[1:] = s[1:] > top[:-1]
                    s, e = s[new], top[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(top) - 1]))]
                    spans, removed = len(s), int((e - s).sum())
                    delta = np.zeros(len(raw) + 1, np.int8)
                    delta[s] += 1
                    delta[e] -= 1
                    keep = np.cumsum(delta[:-1]) == 0
                    kept = raw[keep]
                else:
                    kept = raw
                out.append((len(raw), removed, spans, hashlib.sha256(kept.tobytes()).hexdigest()))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _refined(units: DataFrame, length: int, level: int) -> tuple[DataFrame, DataFrame]:
    """Windows found to be repeated (id, xh, s, n) and the units to split next.

    ``units`` (id, xh, s, n, rel, core, full, c): c > 1 marks a unit that stands for c
    equal ones, whose windows are found already.
    """
    blocks = saved(
        units.groupBy("core", "full").agg(F.sum("c").alias("total"), F.max("c").alias("known"), F.min(F.struct("id", "xh", "s", "n", "rel")).alias("at")),
        f"blocks_{level}",
    )
    found = units.join(blocks.filter("total > 1").select("core", "full"), ["core", "full"]).filter("c = 1").select("id", "xh", "s", "n")
    open_ = blocks.groupBy("core").agg(F.sum("total").alias("all"), F.min("total").alias("least")).filter("all > 1 and least = 1")
    rest = blocks.join(saved(open_.select("core"), f"open_{level}"), "core").select("at.*", F.col("total").alias("c"))
    return found, rest


def repeated_spans(keyed: DataFrame, length: int) -> DataFrame:
    """id, xh, runs (array of s, n): starts of windows of ``length`` bytes that repeat, for
    the texts that have any. ``keyed`` has id, xh (a hash of the text) and text."""
    id_type = keyed.schema["id"].dataType.simpleString()
    unit = f"id {id_type}, xh long, s long, n int, rel int, core long, full long"
    runs = saved(keyed.mapInArrow(lambda it: _map_runs(it, length), unit), "runs")
    again = saved(runs.groupBy("core").count().filter("count > 1").select("core"), "buckets")
    units = saved(runs.join(again, "core").withColumn("c", F.lit(1).cast("long")), "units_0")
    found, rest = _refined(units, length, 0)
    for level, width in enumerate(CELLS, 1):
        todo = saved(rest, f"todo_{level}")
        small = todo.groupBy(F.col("id").alias("u_id"), F.col("xh").alias("u_xh")).agg(F.collect_list(F.struct("s", "n", "rel", "c")).alias("units"))
        small = F.broadcast(saved(small, f"lists_{level}")) if todo.count() <= 1_000_000 else small
        with_text = keyed.join(small, F.col("id").eqNullSafe(F.col("u_id")) & (F.col("xh") == F.col("u_xh")))
        split = with_text.select("id", "xh", "text", "units").mapInArrow(lambda it, w=width: _split(it, length, w), unit + ", c long")
        # Repeated rows (same id and text) list their units once each; count them once.
        units = saved(split.dropDuplicates(["id", "xh", "s", "n"]), f"units_{level}")
        more, rest = _refined(units, length, level)
        found = found.union(more)
    # A set: equal rows have the same runs, each of which counts once however many rows there are.
    return found.groupBy("id", "xh").agg(F.collect_set(F.struct("s", "n")).alias("runs"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, n_kept.

    Texts are UTF-8 bytes. Every byte covered by a string of ``length`` bytes that also
    starts at another position of any text, the same one included, is removed; overlaps
    count, and repeats are judged on the input. n_spans counts maximal removed runs,
    n_kept and kept_sha256 are of the bytes left. A null text is empty; texts shorter than ``length``
    lose nothing; repeated rows repeat each other and so lose all their windows. Ids may be
    null or repeated. Other columns are ignored; an empty table gives no rows. ``length``
    must be at least 2.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("xh", F.xxhash64("text"))
    spans = repeated_spans(keyed, length).select(F.col("id").alias("r_id"), F.col("xh").alias("r_xh"), "runs")
    joined = keyed.join(saved(spans, "spans"), F.col("id").eqNullSafe(F.col("r_id")) & (F.col("xh") == F.col("r_xh")), "left")
    id_type = keyed.schema["id"].dataType.simpleString()
    out = joined.select("id", "text", "runs").mapInArrow(
        lambda it: _cut(it, length), f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return out.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed")).withColumnRenamed("id", id_col)
