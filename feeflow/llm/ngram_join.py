"""N-gram Jaccard join: documents linked by the Jaccard distance of their shingle sets.

Jaccard distance d is a metric, which the join uses twice:

1. Documents with the same set are one point. A shingle order (frequent ones last) makes two
   points within the distance r = 1 - threshold share one of the first shingles of both, so
   each such shingle has its points in one place. There the point with most copies is the
   pivot, and all points that meet a pivot form its region.
2. In a small region, points out of everyone's reach by their class counts are dropped
   before any text moves, and the rest is joined directly. In a large one, every point's distances to
   several pivots are taken in slices; a point belongs to the Voronoi cell of the nearest and is copied
   to all cells p with d(x, p) at most 2r above the nearest and r above the cell's radius. Points
   within r of a pivot are linked to it, and inner points too far from every outer one are done.
   Cells that are still too large are cut again around pivots of their own. Where cells would not halve the
   work, the region is cut into rings of distance to one pivot, and only rings that the triangle
   inequality allows, |d(x, p) - d(y, p)| <= r, are joined.

Every link is decided on the exact sets; what is left out is implied by the triangle
inequality or joins points that are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.graph import components
from feeflow.llm.store import checked_broadcast, saved
from feeflow.llm.text import giving_back, mix, shingles, texts_of

# Order hints: shingles met at least twice in one document of HINT_SHARE, at most HINT_ROWS
# of them. They only change the order of shingles, never what is linked.
HINT_SHARE, HINT_ROWS = 32, 200_000
# Class counts of a region of at most so many points and shingles are compared in one task.
PRUNE_POINTS, PRUNE_SHINGLES = 2048, 4_000_000
# A group of more points or shingles than this is cut into cells or rings of about this size.
REGION_POINTS, REGION_SHINGLES = 512, 1_000_000
# Pivots of a large region, how often cells are cut again, and ranges of distance (a power of two).
PIVOTS, LEVELS, RINGS = 8, 4, 64


def _hint_counts(it: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for _, _, t in texts_of(batch.column("text")):
            h, c = np.unique(shingles(t, k)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])


def _order_hints(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and classes (1 to 255, by frequency) of frequent shingles."""
    some = docs.filter(F.pmod(F.xxhash64("id"), F.lit(HINT_SHARE)) == 0).select("text")
    top = (
        some.mapInArrow(lambda it: _hint_counts(it, k), "h long, c long")
        .groupBy("h").agg(F.sum("c").alias("c")).filter("c >= 2")
        .orderBy(F.desc("c"), "h").limit(HINT_ROWS).toArrow()
    )
    h = top.column("h").to_numpy().astype(np.int64).view(np.uint64)
    c = top.column("c").to_numpy().astype(np.float64)
    order = np.argsort(h)
    return h[order], np.minimum(255, 8 * np.log2(np.maximum(c[order], 2))).astype(np.uint64)


def _ordered(h: np.ndarray, hints: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Shingle ids whose numeric order is the shingle order: class, then 56 bits of the hash."""
    known, cls = hints
    out = h >> np.uint64(8)
    if len(known):
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[at] == h
        out[hit] |= cls[at[hit]] << np.uint64(56)
    return out


def _sets(column: pa.Array, k: int, hints) -> Iterator[np.ndarray]:
    for _, _, t in texts_of(column):
        h, begin = shingles(t, k)
        h = _ordered(h, hints)
        for i in range(len(t)):
            yield np.unique(h[begin[i] : begin[i + 1]])


def _fingerprint(s: np.ndarray) -> np.int64:
    """Of a set, whatever its order."""
    total = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))
    return mix(total).view(np.int64)[0]


def _sketch(s: np.ndarray) -> bytes:
    """How many shingles fall into each of a power of two of classes (255: that or more)."""
    classes = max(16, 1 << (len(s) // 4).bit_length())
    return np.minimum(255, np.bincount((mix(s) % np.uint64(classes)).astype(np.int64), minlength=classes)).astype(np.uint8).tobytes()


def _signatures(it: Iterator[pa.RecordBatch], k: int, percent: int, hints) -> Iterator[pa.RecordBatch]:
    for batch in it:
        n, fp, first, sketch = [], [], [], []
        for s in _sets(batch.column("text"), k, hints):
            n.append(len(s))
            sketch.append(_sketch(s))
            fp.append(_fingerprint(s) if len(s) else 0)
            need = -(-percent * len(s) // 100)
            first.append(s[: len(s) - need + 1] if len(s) else s)
        values = np.concatenate(first).view(np.int64) if first else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum([len(x) for x in first]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("xh"), pa.array(np.array(n, np.int64)), pa.array(np.array(fp, np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(sketch, pa.binary())],
            ["id", "xh", "n", "fp", "tokens", "sketch"],
        )


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shingles
    that two or more sets hold."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inv, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[inv] > 1
    col = (np.cumsum(count > 1) - 1)[inv[shared]]
    owner = owner[shared]
    out = np.zeros((m, m), np.float64)
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    width = max(1, (4 << 20) // m)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        block = np.zeros((m, width), np.float32)
        block[owner[a:b], col[a:b] - lo] = 1
        out += block @ block.T
    return out


def _linked(inter, n_a, n_b, percent: int):
    return 100 * inter >= percent * (n_a + n_b - inter)


def _spanning(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that connect exactly what the links between the sets connect."""
    if len(sets) == 2:
        inter = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = _linked(inter, len(sets[0]), len(sets[1]), percent)
        return (np.array([0]), np.array([1])) if hit else (np.zeros(0, int), np.zeros(0, int))
    n = np.array([len(s) for s in sets], np.float64)
    link = _linked(_intersections(sets), n[:, None], n[None, :], percent)
    np.fill_diagonal(link, True)
    label = _least_connected(link)
    i = np.flatnonzero(label != np.arange(len(sets)))
    return i, label[i]


def _grouped(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Tables of equal ``region`` from batches sorted by it."""
    rest: list[pa.Table] = []
    for batch in it:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        region = table.column("region").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(region)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if rest and rest[0].column("region")[0].as_py() != region[a]:
                yield rest[0].column("region")[0].as_py(), pa.concat_tables(rest)
                rest = []
            rest.append(table.slice(a, b - a))
    if rest:
        yield rest[0].column("region")[0].as_py(), pa.concat_tables(rest)


def _points(table: pa.Table, k: int, hints) -> tuple[list[np.ndarray], np.ndarray]:
    """Sets and fingerprints of the rows whose text has the fingerprint that they carry."""
    fp = table.column("fp").to_numpy()
    sets = list(_sets(table.column("text"), k, hints))
    once = set(np.unique(fp, return_index=True)[1].tolist())
    ok = [i for i, s in enumerate(sets) if i in once and len(s) and _fingerprint(s) == fp[i]]
    return [sets[i] for i in ok], fp[ok]


def _pairs(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _join_regions(it: Iterator[pa.RecordBatch], k: int, percent: int, hints) -> Iterator[pa.RecordBatch]:
    for _, table in _grouped(it):
        sets, fp = _points(table, k, hints)
        if len(sets) > 1:
            i, j = _spanning(sets, percent)
            if len(i):
                yield _pairs(fp[i], fp[j])


def _folded(sketch: np.ndarray, classes: int) -> np.ndarray:
    """Class counts for fewer classes (each row's classes modulo ``classes``), saturated anew."""
    parts = sketch.reshape(len(sketch), -1, classes)
    return np.where((parts == 255).any(1), -1, parts.sum(1, dtype=np.int32)).astype(np.int32)


def _in_reach(n: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Which pairs of sets may link: the symmetric difference of two sets is at least the sum
    of the differences of their class counts (saturated ones tell nothing)."""
    classes = np.array([len(x) for x in sketches])
    near = np.eye(len(n), dtype=bool)
    by = {int(c): np.flatnonzero(classes == c) for c in np.unique(classes)}
    raw = {c: np.frombuffer(b"".join(sketches[i] for i in at), np.uint8).reshape(len(at), c) for c, at in by.items()}
    for c, at in by.items():
        for d, other in by.items():
            if d < c or n[at].max() * 100 < percent * n[other].min():
                continue
            x, y = _folded(raw[c], c), _folded(raw[d], c)
            for r, i in enumerate(at):
                fits = np.minimum(n[i], n[other]) * 100 >= percent * np.maximum(n[i], n[other])
                z = y[fits]
                diff = (np.abs(x[r] - z) * ((x[r] >= 0) & (z >= 0))).sum(1)
                hit = other[fits][_linked((n[i] + n[other[fits]] - diff) / 2, n[i], n[other[fits]], percent)]
                near[i, hit] = near[hit, i] = True
    return near


def _least_connected(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix with a true diagonal, the least row connected to it."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(1)
        if (new == label).all():
            return label
        label = new


def _prune(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The groups of a region whose points may link, each under its point with most copies."""
    for _, table in _grouped(it):
        fp, n = table.column("fp").to_numpy(), table.column("n").to_numpy()
        label = _least_connected(_in_reach(n, table.column("sketch").to_pylist(), percent))
        order = np.lexsort((fp, table.column("copies").to_numpy()))  # the last of a group leads it
        lead = np.empty(len(fp), np.int64)
        lead[label[order]] = fp[order]
        kept = np.bincount(label, minlength=len(fp))[label] > 1
        if kept.any():
            yield pa.RecordBatch.from_arrays([pa.array(lead[label][kept]), pa.array(fp[kept])], ["pivot", "fp"])


def _overlaps(pivots: list[np.ndarray], sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set (rows) with every pivot (columns)."""
    union, col = np.unique(np.concatenate(pivots), return_inverse=True)
    has = np.zeros((len(union), len(pivots)), bool)
    has[col, np.repeat(np.arange(len(pivots)), [len(p) for p in pivots])] = True
    out = np.zeros((len(sets), len(pivots)), np.int64)
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(union, s), len(union) - 1)
        out[i] = has[at[union[at] == s]].sum(0)
    return out


def _distances(it: Iterator[pa.RecordBatch], k: int, percent: int, hints) -> Iterator[pa.RecordBatch]:
    """A row for every point and pivot (``cell``) in whose Voronoi cell the point is or may have a partner.

    x in the cell of p and y in that of q link only if d(y, p) <= d(x, p) + r <= d(x, q) + r <= d(y, q) + 2r,
    so y goes to every cell p with d(y, p) - d(y, q) <= 2r. d0 and core0 belong to the first pivot.
    """
    window = 2 * (1 - percent / 100) + 1e-9
    for _, table in _grouped(it):
        role = table.column("role").to_numpy()
        pivots, names = _points(table.filter(pa.array(role > 0)), k, hints)
        sets, fp = _points(table.filter(pa.array(role == 0)), k, hints)
        if not pivots or not sets:
            continue
        order = np.argsort(names)
        pivots, names = [pivots[i] for i in order], names[order]
        first = table.filter(pa.array(role == 2)).column("fp")[0].as_py()
        at0 = int(np.flatnonzero(names == first)[0]) if first in names else 0
        n, m = np.array([len(s) for s in sets]), np.array([len(p) for p in pivots])
        inter = _overlaps(pivots, sets)
        d = 1 - inter / (n[:, None] + m[None, :] - inter)
        core = _linked(inter, n[:, None], m[None, :], percent)
        own = d.argmin(1)
        i, j = np.nonzero(d - d.min(1)[:, None] <= window)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), table.column("group")[0].as_py())), pa.array(names[j]), pa.array(fp[i]), pa.array(n[i]),
             pa.array(d[i, j]), pa.array(core[i, j]), pa.array(own[i] == j), pa.array(d[i, at0]), pa.array(core[i, at0])],
            ["region", "cell", "fp", "n", "d", "core", "owner", "d0", "core0"],
        )


def _rows_by_region(df: DataFrame) -> DataFrame:
    return df.repartition("region").sortWithinPartitions("region")


def _pieces() -> list[Column]:
    """Points of a region, and how many pieces that fit a task it makes."""
    parts = F.greatest(F.ceil(F.count("*") / REGION_POINTS), F.ceil(F.sum("n") / REGION_SHINGLES))
    return [F.count("*").alias("m"), parts.cast("long").alias("parts")]


def _to_pivots(members: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, percent: int, hints) -> DataFrame:
    """Rows of _distances for the regions in ``members``, whose points come in slices that all see the pivots."""
    top = F.max(F.struct("copies", "fp")).alias("top")
    pivots = saved(members.groupBy("region", F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(PIVOTS)).alias("class")).agg(top), "pivots_of_regions")
    first = pivots.groupBy("region").agg(F.max("top").alias("first"))
    pivots = pivots.join(first, "region").join(sizes, "region").select(
        "region", F.col("top.fp").alias("fp"), F.when(F.col("top") == F.col("first"), 2).otherwise(1).alias("role"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("slice"),
    )
    own = members.join(sizes, "region").select("region", "fp", F.lit(0).alias("role"), F.pmod(F.xxhash64("fp"), "parts").alias("slice"))
    rows = own.union(pivots).join(texts, "fp")
    rows = rows.select(F.xxhash64("region", "slice").alias("region"), F.col("region").alias("group"), "fp", "role", "text")
    schema = "region long, cell long, fp long, n long, d double, core boolean, owner boolean, d0 double, core0 boolean"
    return saved(_rows_by_region(rows).mapInArrow(lambda it: giving_back(_distances(it, k, percent, hints)), schema), "distances")


def _within_reach(points: DataFrame, by: list[str], r: float) -> DataFrame:
    """``points`` (d and core to the pivot of ``by``) without those that can't add a link: core points are
    connected through the pivot, so only those in reach of a point that isn't core stay."""
    outer = points.filter("not core").groupBy(*by).agg(F.min("d").alias("least"))
    return points.join(saved(outer, "outer"), by).filter(f"not core or d >= least - {r}").drop("least")


def _ring_rows(points: DataFrame, r: float) -> DataFrame:
    """region, fp: pairs of rings of one pivot that the triangle inequality allows, each pair a region.

    ``points``: region, fp, n, d, core. Rings are ranges of d (quantiles); one of very many points is cut by hash.
    """
    quantiles = F.percentile_approx("d", F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)]), F.lit(10_000))
    tiles = F.greatest(F.ceil(F.count("*") / (REGION_POINTS // 2)), F.ceil(F.sum("n") / (REGION_SHINGLES // 2)))
    sized = saved(points.groupBy("region", "core").agg(quantiles.alias("cuts"), tiles.alias("tiles")), "rings")
    at = F.size(F.filter("cuts", lambda c: c < F.col("d")))
    ring = F.floor(at * F.least("tiles", F.lit(RINGS)) / RINGS)
    within = F.pmod(F.xxhash64("fp", F.lit(7)), F.ceil(F.col("tiles") / RINGS))
    placed = saved(points.join(sized, ["region", "core"]).select("region", "core", "fp", "d", ring.alias("ring"), within.alias("part")), "ring_points")
    placed = placed.withColumn("tile", F.col("part") * RINGS + F.col("ring"))
    tile = saved(placed.groupBy("region", "core", "tile").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "ring_bounds")
    one, two = tile.filter("not core").alias("u"), tile.alias("v")
    pairs = one.join(two, F.expr(f"u.region = v.region and (v.core or v.tile >= u.tile) and u.lo - v.hi <= {r} and v.lo - u.hi <= {r}"))
    sides = F.array_distinct(F.array(F.struct(F.col("u.core").alias("core"), F.col("u.tile").alias("tile")), F.struct(F.col("v.core"), F.col("v.tile"))))
    pairs = pairs.select(F.col("u.region").alias("region"), F.xxhash64("u.region", "u.tile", "v.core", "v.tile").alias("pair"), F.explode(sides).alias("side"))
    pairs = saved(pairs.select("region", "pair", "side.core", "side.tile"), "ring_pairs")
    return placed.join(pairs, ["region", "core", "tile"]).select(F.col("pair").alias("region"), "fp")


def _links_of_large(members: DataFrame, texts: DataFrame, k: int, percent: int, hints) -> DataFrame:
    """a, b for the regions in ``members`` (region, fp, n, copies), too large to join in one task.

    Every region is cut into the Voronoi cells of its pivots, a point being copied to all cells in its window. A cell
    that is still too large is a region of the next level. Where the cells of a region have no less work than
    half of the region's, its distances to one pivot cut it into rings instead.
    """
    r = 1 - percent / 100 + 1e-9
    links, joined = [], []
    for level in range(LEVELS + 1):
        sizes = saved(members.groupBy("region").agg(*_pieces()), "region_sizes")
        dist = _to_pivots(members, sizes, texts, k, percent, hints)
        links.append(dist.filter("core and cell <> fp").select(F.col("cell").alias("a"), F.col("fp").alias("b")))
        radius = saved(dist.filter("owner").groupBy("region", "cell").agg(F.max("d").alias("radius")), "radii")
        cells = saved(_within_reach(dist.join(radius, ["region", "cell"]).filter(f"d <= radius + {r}"), ["region", "cell"], r), "cells")
        work = cells.groupBy("region", "cell").agg(F.count("*").cast("double").alias("c")).groupBy("region").agg(F.sum(F.expr("c * c")).alias("work"))
        work = saved(work.join(sizes, "region").select("region", (F.lit(level < LEVELS) & F.expr("2 * work <= double(m) * m")).alias("smaller")), "region_work")
        rest = dist.filter("owner").join(work.filter("not smaller"), "region").select("region", "fp", "n", F.col("d0").alias("d"), F.col("core0").alias("core"))
        if not work.filter("not smaller").isEmpty():
            joined.append(_ring_rows(_within_reach(rest, ["region"], r), r))
        below = cells.join(work.filter("smaller"), "region").select(F.xxhash64("region", "cell").alias("region"), "fp", "n")
        below = saved(below, "cells_below")
        large = below.groupBy("region").agg(*_pieces()).filter("parts > 1").select("region")
        large = saved(large, "large_cells")
        joined.append(below.join(large, "region", "left_anti").select("region", "fp"))
        if large.isEmpty():
            break
        members = saved(below.join(large, "region", "left_semi").join(members.select("fp", "copies").distinct(), "fp").select("region", "fp", "n", "copies"), "members_below")
    rows = reduce(DataFrame.union, joined).join(texts, "fp").select("region", "fp", "text")
    links.append(_rows_by_region(rows).mapInArrow(lambda it: giving_back(_join_regions(it, k, percent, hints)), "a long, b long"))
    return reduce(DataFrame.union, links)


def _sized(members: DataFrame, point: DataFrame, points: int, shingle_count: int) -> DataFrame:
    """``members`` (pivot, fp) with ``parts``: how many pieces of the given size their region makes."""
    parts = members.join(point.select("fp", "n"), "fp").groupBy("pivot").agg(
        F.greatest(F.ceil(F.count("*") / points), F.ceil(F.sum("n") / shingle_count)).cast("long").alias("parts")
    )
    return saved(members.join(saved(parts, "parts"), "pivot").select("pivot", "fp", "parts"), "sized_members")


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    Words are those of ``text`` with A-Z lower-cased. A document's set holds its distinct
    k-word shingles; with 1 to k-1 words, all of them as one. Two documents link when
    100 * |intersection| >= percent * |union|; ``component_id`` is the smallest id reachable
    by links, the own one included.

    Null or empty texts and texts without words have n_shingles 0 and are a component of
    their own. A null id counts as no id: it never is a component_id unless all ids of the
    component are null. Repeated rows and repeated ids stay separate rows. Other columns
    are ignored. An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = base.withColumn("xh", F.xxhash64("text"))
    id_type = base.schema["id"].dataType.simpleString()
    hints = _order_hints(base, k)
    signed = saved(
        keyed.mapInArrow(lambda it: giving_back(_signatures(it, k, percent, hints)), f"id {id_type}, xh long, n long, fp long, tokens array<long>, sketch binary"),
        "signatures",
    )
    tokens = signed.select("fp", F.explode("tokens").alias("token"))
    repeated = saved(tokens.groupBy("token").count().filter("count > 1").select("token"), "tokens")
    points = saved(
        tokens.join(repeated, "token").groupBy("token", "fp").agg(F.count("*").alias("copies")), "points"
    )
    heads = saved(
        points.groupBy("token")
        .agg(F.count("*").alias("m"), F.max(F.struct("copies", "fp")).alias("top"))
        .filter("m > 1")
        .select("token", F.col("top.fp").alias("pivot")),
        "pivots",
    )
    members = saved(points.join(heads, "token").select("pivot", "fp").distinct(), "members")
    # Each point once: its size, class counts and one row that has it.
    point = signed.filter("n > 0").groupBy("fp").agg(
        F.max("n").alias("n"), F.min(F.struct("id", "xh")).alias("at"), F.max("sketch").alias("sketch"), F.count("*").alias("copies")
    )
    point = saved(point.join(members.select("fp").distinct(), "fp", "left_semi"), "members_once")
    members = _sized(members, point, PRUNE_POINTS, PRUNE_SHINGLES)
    near = members.filter("parts = 1").join(point.select("fp", "n", "copies", "sketch"), "fp")
    near = near.select(F.col("pivot").alias("region"), "fp", "n", "copies", "sketch")
    near = _rows_by_region(near).mapInArrow(lambda it: _prune(it, percent), "pivot long, fp long")
    # The same group comes from every region that holds it; it has the same leader.
    groups = saved(near.union(members.filter("parts > 1").select("pivot", "fp")).distinct(), "groups")
    groups = _sized(groups, point, REGION_POINTS, REGION_SHINGLES)
    small, large = groups.filter("parts = 1"), saved(groups.filter("parts > 1"), "large")
    wanted = small.select("fp").union(large.select("fp")).distinct()
    at = saved(point.join(wanted, "fp", "left_semi").select("fp", F.col("at.id").alias("at_id"), F.col("at.xh").alias("at_xh")), "wanted")
    texts = keyed.join(checked_broadcast(at), F.col("id").eqNullSafe(F.col("at_id")) & (F.col("xh") == F.col("at_xh")))
    texts = texts.groupBy("fp").agg(F.first("text").alias("text"))  # repeated rows count once
    small = small.join(texts, "fp").select(F.col("pivot").alias("region"), "fp", "text")
    edges = _rows_by_region(small).mapInArrow(lambda it: giving_back(_join_regions(it, k, percent, hints)), "a long, b long")
    if not large.isEmpty():
        large_texts = saved(texts.join(large.select("fp").distinct(), "fp", "left_semi"), "large_texts")
        regions = saved(large.join(point.select("fp", "n", "copies"), "fp").select(F.col("pivot").alias("region"), "fp", "n", "copies"), "large_regions")
        edges = edges.union(_links_of_large(regions, large_texts, k, percent, hints))
    comp = components(edges)
    placed = signed.select("id", "n", "fp").join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("id", "n", F.when(F.col("n") > 0, F.coalesce("comp", "fp")).alias("comp"))
    least = placed.filter("comp is not null").groupBy("comp").agg(F.min("id").alias("least"))
    return placed.join(saved(least, "least"), "comp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )
