"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors are one point. Points are scaled to length 1 and turned into the basis of their
second-moment matrix, strongest direction first, which changes no cosine. Sorted by the first
coordinate they form tiles; two tiles meet only if their first coordinates come near enough.
Tiles travel in blocks, one copy per block in reach: the bytes shuffled are those of the vectors times the
number of blocks, a constant until blocks are full, however many pairs of tiles there are.
Within a pair of tiles leading dimensions are multiplied first. What the rest can add is at
most the product of the suffix norms; pairs that cannot reach the threshold stop there, the
others go on with more dimensions and end with the full cosine in double precision.
Tasks return link counts and enough links to connect what is linked, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.graph import components
from feeflow.llm.store import checked_broadcast, saved

TILE = 4096
# Cells of the leading coordinate (within -1 and 1) are at least this wide.
LEAST_CELL = 0.01
BLOCK = 256
# Tiles meet in blocks: at least so many if there are tiles enough, and of at most so many bytes of vectors.
BLOCKS = 11
BLOCK_BYTES = 32 << 20
# Dimensions after which pairs are judged again.
STOPS = (8, 16, 32)


class _Tile(NamedTuple):
    tile: int
    lo: float
    hi: float
    node: np.ndarray
    m: np.ndarray
    y: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _map_moments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in it:
        if batch.num_rows:
            x = _unit(_matrix(batch.column("v")))
            m = x.T @ x
            total = m if total is None else total + m
    if total is not None:
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])


def _basis(points: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second-moment matrix (dim x dim numbers), largest value first."""
    m = np.zeros((dim, dim))
    for i, j, s in points.select("v").mapInArrow(_map_moments, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        m[i, j] = s
    value, vector = np.linalg.eigh((m + m.T) / 2)
    return vector[:, np.argsort(-value, kind="stable")]


def _map_turned(it: Iterator[pa.RecordBatch], basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in it:
        if not batch.num_rows:
            continue
        y = np.ascontiguousarray(_unit(_matrix(batch.column("v"))) @ basis)
        size = np.arange(0, y.size + 1, y.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("m"), pa.array(y[:, 0]), pa.ListArray.from_arrays(pa.array(size), pa.array(y.ravel()))], ["node", "m", "y0", "y"]
        )


def _map_tiles(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tile, from rows sorted by tile."""
    rest: list[pa.RecordBatch] = []

    def tile(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        y0 = t.column("y0").to_numpy()
        blob = lambda a: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([t.column("tile")[0].as_py()], pa.int64()), pa.array([float(y0.min())]), pa.array([float(y0.max())]), blob(t.column("node").to_numpy()), blob(t.column("m").to_numpy()), blob(_matrix(t.column("y").combine_chunks() if isinstance(t.column("y"), pa.ChunkedArray) else t.column("y")))],
            ["tile", "lo", "hi", "node", "m", "y"],
        )

    for batch in it:
        if not batch.num_rows:
            continue
        tiles = batch.column("tile").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(tiles[1:] != tiles[:-1]) + 1, [len(tiles)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if rest and rest[0].column("tile")[0].as_py() != tiles[a]:
                yield tile(rest)
                rest = []
            rest.append(batch.slice(a, b - a))
    if rest:
        yield tile(rest)


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` (unit vectors in the turned basis) with cosine >= threshold."""
    dim = a.shape[1]
    stops = [s for s in STOPS if s < dim]
    if not stops:
        i, j = np.nonzero(a @ b.T >= threshold)
        return i, j
    slack = 1e-9
    rest = lambda x, s: np.sqrt(np.maximum(0, (x[:, s:] ** 2).sum(1)))
    lead = a[:, : stops[0]] @ b[:, : stops[0]].T
    i, j = np.nonzero(lead + np.outer(rest(a, stops[0]), rest(b, stops[0])) >= threshold - slack)
    got = lead[i, j]
    for s, e in zip(stops, [*stops[1:], dim], strict=True):
        if not len(i):
            return i, j
        got = got + np.einsum("ij,ij->i", a[i, s:e], b[j, s:e])
        bound = got if e == dim else got + rest(a, e)[i] * rest(b, e)[j]
        ok = bound >= threshold - (0 if e == dim else slack)
        i, j, got = i[ok], j[ok], got[ok]
    return i, j


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index connected to each of n nodes by the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            return label
        label = new


def _tile_links(a: _Tile, b: _Tile, threshold: float) -> pa.RecordBatch:
    """a, b (a link, or b null), links: counts of links of a; ``a`` and ``b`` may be the same tile."""
    links_a, links_b = np.zeros(len(a.node), np.int64), np.zeros(len(b.node), np.int64)
    same = a.tile == b.tile
    ea, eb = [], []
    for lo in range(0, len(a.node), BLOCK):
        first = lo if same else 0
        i, j = linked_pairs(a.y[lo : lo + BLOCK], b.y[first:], threshold)
        i, j = i + lo, j + first
        if same:
            i, j = i[i < j], j[i < j]
        links_a += np.bincount(i, b.m[j], len(a.node)).astype(np.int64)
        links_b += np.bincount(j, a.m[i], len(b.node)).astype(np.int64)
        if len(i):
            n = len(a.node)
            nodes = a.node if same else np.concatenate((a.node, b.node))
            label = _labels(len(nodes), i, j if same else j + n)
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            ea.append(nodes[moved])
            eb.append(nodes[label[moved]])
    ka, kb = np.flatnonzero(links_a), np.flatnonzero(links_b)
    edges = sum(map(len, ea))
    node = np.concatenate([a.node[ka], b.node[kb], *ea])
    other = pa.array(np.concatenate([np.zeros(len(ka) + len(kb), np.int64), *eb]), mask=np.arange(len(node)) < len(node) - edges)
    links = np.concatenate([links_a[ka], links_b[kb], np.zeros(edges, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(node), other, pa.array(links)], ["a", "b", "links"])


def _block_links(it: Iterator[pa.RecordBatch], threshold: float, reach: float) -> Iterator[pa.RecordBatch]:
    """The links of a pair of blocks, from the tiles of both (``later``: of the second); one block with itself has no later ones."""
    first, second = [], []
    for batch in it:
        for r in range(batch.num_rows):
            get = lambda c, kind: np.frombuffer(batch.column(c)[r].as_buffer(), kind)  # noqa: B023, E731
            value = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
            node = get("node", np.int64)
            tile = _Tile(value("tile"), value("lo"), value("hi"), node, get("m", np.int64), get("y", np.float64).reshape(len(node), -1))
            (second if value("later") else first).append(tile)
    for a in first:
        for b in second or first:
            if a.tile <= b.tile and b.lo - a.hi <= reach:
                yield _tile_links(a, b, threshold)


def _block_size(n_tiles: int, dim: int) -> int:
    """Tiles of a block: few blocks, so that each travels to few others, but ``BLOCKS`` if there are
    tiles enough, for work in many tasks, and none of more than ``BLOCK_BYTES``."""
    return max(1, min(BLOCK_BYTES // (TILE * dim * 8), -(-n_tiles // BLOCKS)))


def _pair_tiles(tiles: DataFrame, reach: float) -> DataFrame:
    """The tiles of each pair of blocks (a <= b) in reach of each other; ``later``: it is one of b, not of a.

    A tile is copied once per block in its reach, not once per tile."""
    # Blocks follow the coordinate: a later one is in reach where its start is in a cell that the earlier one, made longer by the reach, touches.
    rings, width = saved(tiles.groupBy("block").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "blocks"), max(reach, LEAST_CELL)
    cell = lambda c: F.floor(c / width)
    starts = rings.select("block", "lo", cell(F.col("lo")).alias("cell"))
    spans = rings.select("block", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") + reach))).alias("cell"))
    pairs = spans.alias("u").join(starts.alias("v"), "cell").filter(F.expr(f"u.block <= v.block and v.lo - u.hi <= {reach}")).select(
        F.col("u.block").alias("a"), F.col("v.block").alias("b")
    )
    pairs = saved(pairs, "block_pairs")
    few = checked_broadcast(pairs)
    of = lambda side, later: tiles.join(few, F.col("block") == F.col(side)).withColumn("later", F.lit(later)).drop("block")
    both = of("a", False).unionByName(of("b", True).filter("a <> b"))
    # About a pair of blocks per partition.
    return both.repartition(max(1, min(pairs.count(), 20_000)), "a", "b")


def _links_of(points: DataFrame, dim: int, threshold: float) -> DataFrame:
    """a, b, links for points (node, m, v) of one dimension."""
    basis = _basis(points, dim)
    turned = points.select("node", "m", "v").mapInArrow(lambda it: _map_turned(it, basis), "node long, m long, y0 double, y array<double>")
    ordered = saved(turned.orderBy("y0", "node").withColumn("row", F.monotonically_increasing_id()), "ordered_vectors")
    part = F.shiftright("row", 33)
    counts = sorted((r[0], r[1]) for r in ordered.groupBy(part).count().collect())  # a row per written part
    before = np.concatenate(([0], np.cumsum([c for _, c in counts])))
    offsets = points.sparkSession.createDataFrame([(p, int(n)) for (p, _), n in zip(counts, before, strict=False)], "part long, before long")
    number = F.col("before") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    tiled = ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("tile", F.floor(number / TILE))
    tiles = saved(
        tiled.select("tile", "node", "m", "y0", "y").repartition("tile").sortWithinPartitions("tile", "y0")
        .mapInArrow(_map_tiles, "tile long, lo double, hi double, node binary, m binary, y binary"),
        "tiles",
    )
    tiles = tiles.withColumn("block", F.floor(F.col("tile") / _block_size(-(-sum(c for _, c in counts) // TILE), dim)))
    # |x - y|^2 = 2 - 2 cos: first coordinates of linked vectors differ by at most this.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9)

    def links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _block_links(it, threshold, reach)

    return saved(_pair_tiles(tiles, reach).groupBy("a", "b").applyInArrow(links, "a long, b long, links long"), "vector_links")


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Rows link when the cosine of their vectors, in double precision, is at least ``threshold``
    (positive). n_links counts the other rows linked directly, component_id is the smallest id
    reachable (nulls don't count), kept says whether that is the own id. Vectors that are null,
    empty, zero or hold null or non-finite components, and vectors of different length, don't
    link. Equal vectors are compared as one and count as many. Ids may be null or repeated;
    other columns are ignored; an empty table gives no rows.
    """
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    base = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    fine = F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = base.withColumn("v", F.when(fine, F.transform("v", lambda x: x + F.lit(0.0))))
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    points = saved(
        rows.filter("v is not null").groupBy("node", "v").agg(F.count("*").alias("m")).withColumn("dim", F.size("v")), "points"
    )
    found = None
    for (dim,) in points.select("dim").distinct().orderBy("dim").collect():  # the lengths that occur
        links = _links_of(points.filter(F.col("dim") == dim), dim, threshold)
        found = links if found is None else found.union(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a long, b long, links long")
    comp = components(found.filter("b is not null").select("a", "b")).select(F.col("node").alias("c_node"), "comp")
    links = found.filter("b is null").groupBy(F.col("a").alias("l_node")).agg(F.sum("links").alias("links"))
    about = points.select("node", "m").join(links, F.col("node") == F.col("l_node"), "left").join(comp, F.col("node") == F.col("c_node"), "left")
    about = saved(
        about.select(F.col("node").alias("p_node"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("comp", "node").alias("comp")),
        "point_links",
    )
    placed = rows.select("id", "node").join(about, F.col("node") == F.col("p_node"), "left")
    least = saved(placed.filter("comp is not null").groupBy(F.col("comp").alias("least_comp")).agg(F.min("id").alias("least")), "least_ids")
    out = placed.join(least, F.col("comp") == F.col("least_comp"), "left")
    component = F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
