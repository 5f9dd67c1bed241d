"""Embedding near-deduplication by collision counting on sorted projections.

Every table holds one Gaussian projection per vector, sorted, inside a cell of
``bits`` further projection signs.  A vector opens a window of half-width w
around its own projected value (query-centred); another vector of the cell in
that window is one collision of the pair.  Pairs with at least ``needed``
collisions over all tables are verified in double precision.  Cells grow finer
with the number of vectors (bits ~ log2 n), and the number of tables follows
from the collision probability at the threshold angle, so that the recall at
the threshold itself is ``RECALL`` and higher above it.

Equal vectors are one class with a weight.  Vectors within half the threshold
angle of a common pivot are linked with each other for certain (angles obey the
triangle inequality), so such a ball counts its links in closed form and only
pairs across balls are compared.

Pairs become rows only in cells of at most ``CROWD`` vectors, so at most that
many per vector and table.  A fuller cell is compared in blocks of ``BLOCK``
vectors: a task counts the collisions of its pairs over all tables, verifies
them, and returns for each vector the number of its links in the two blocks and
the smallest vector that they join it to.  A pair that shares such cells in
several tables belongs to the first of them.  So a group of m similar vectors
that are no common ball takes m * m dot products, as its exact link counts need,
but writes about m * m / BLOCK rows.
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches
from .graph import connected_components
from .hyperminhash import dealt_blocks

THRESHOLD = 0.95
RECALL = 0.9998
NEEDED = 2
SPREAD = 2.5
PIVOT_TABLES = 12
PIVOT_ROUNDS = 4
CROWD = 64
BLOCK = 512
SEED = 20240229


def collision_probability(threshold: float, bits: int) -> float:
    """Of a pair at the threshold: same cell, and inside the window."""
    same_sign = 1 - math.acos(threshold) / math.pi
    return same_sign ** bits * math.erf(SPREAD / math.sqrt(2))


def tables_for(threshold: float, bits: int, needed: int = NEEDED, recall: float = RECALL) -> int:
    """Fewest tables at which ``needed`` collisions are reached with ``recall``."""
    p, m = collision_probability(threshold, bits), needed
    while sum(math.comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(needed)) > 1 - recall:
        m += 1
    return m


def cosine(x: Column, y: Column) -> Column:
    """Cosine of two unit vectors in double precision."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def unit_classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id, rep), (classes: rep, weight, unit): one class per distinct
    usable vector, named by its smallest id; rows without usable vector have a
    null rep."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    usable = F.coalesce((F.size("x") > 0) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)) & (F.col("norm") > 0)
                        & (F.col("norm") < F.lit(float("inf"))), F.lit(False))
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).withColumn("norm", norm)
    base = base.select("vec_id", F.when(usable & F.col("vec_id").isNotNull(),
                                        F.transform("x", lambda v: v / F.col("norm") + 0.0)).alias("unit"))
    base = cut(base, "op1-unit")
    classes = cut(base.filter("unit is not null").groupBy("unit")
                  .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "op1-classes")
    rows = base.join(classes.select("unit", "rep"), "unit", "left").select("vec_id", "rep")
    return rows, classes


def projections(classes: DataFrame, tables: int, bits: int, width: float) -> DataFrame:
    """rep, ball, dim, t, cell, value, slot: every vector once per table."""
    def run(batches):
        import pyarrow as pa

        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                dims = part.column(2).to_numpy()
                for d in np.unique(dims):
                    some = part.filter(pa.array(dims == d))
                    x = some.column(3).flatten().to_numpy().reshape(-1, d)
                    if d not in planes:
                        planes[d] = np.random.default_rng([SEED, int(d)]).standard_normal((tables, bits + 1, d))
                    y = np.einsum("nd,tbd->ntb", x, planes[d], optimize=True)
                    cell = (y[:, :, :bits] > 0) @ (1 << np.arange(bits))
                    n = len(x)
                    ids, balls = (np.repeat(some.column(c).to_numpy(), tables) for c in (0, 1))
                    value = y[:, :, bits].ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array(balls), pa.array(np.full(n * tables, d, np.int32)),
                         pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(cell.ravel().astype(np.int64)),
                         pa.array(value), pa.array(np.floor(value / width).astype(np.int32))],
                        ["rep", "ball", "dim", "t", "cell", "value", "slot"])

    rows = classes.select("rep", "ball", F.size("unit").cast("int").alias("dim"), "unit")
    return map_batches(rows, run, "rep long, ball long, dim int, t int, cell long, value double, slot int")


def balls(classes: DataFrame, bits: int, threshold: float) -> DataFrame:
    """rep -> ball: a vector (smallest id found) within half the threshold
    angle; the vector's own id if none is found.  All vectors of one ball are
    linked with each other."""
    near = math.cos(math.acos(threshold) / 2) + 1e-9
    cells = projections(classes.withColumn("ball", F.col("rep")), PIVOT_TABLES, bits, 1.0)
    low = cells.groupBy("dim", "t", "cell").agg(F.min("rep").alias("ball"))
    pairs = cells.join(low, ["dim", "t", "cell"]).filter(cells["rep"] != low["ball"]).select(
        cells["rep"].alias("rep"), low["ball"].alias("ball")).distinct()
    unit = classes.select("rep", "unit")
    pivot = unit.select(F.col("rep").alias("ball"), F.col("unit").alias("pivot"))

    def settled(candidates: DataFrame) -> DataFrame:
        return (candidates.join(unit, "rep").join(pivot, "ball").filter(cosine(F.col("unit"), F.col("pivot")) >= near)
                .groupBy("rep").agg(F.min("ball").alias("ball")))

    own = cut(settled(pairs), "op1-balls")
    for _ in range(PIVOT_ROUNDS - 1):
        step = own.select(F.col("rep").alias("ball"), F.col("ball").alias("next"))
        further = own.join(step, "ball").select("rep", F.col("next").alias("ball")).distinct()
        own = cut(own.unionByName(settled(further)).groupBy("rep").agg(F.min("ball").alias("ball")), "op1-balls")
    return own


def window_collisions(table: DataFrame, width: float) -> DataFrame:
    """a, b, collisions for pairs of different balls, a < b.  Windows become an
    equi-join on slots of the window's half-width: partners lie in the same or
    the next slot."""
    key = ["dim", "t", "cell", "slot"]
    left = table.select(*key, F.col("rep").alias("a"), F.col("ball").alias("ball_a"), F.col("value").alias("value_a"))
    right = (table.select("dim", "t", "cell", F.explode(F.array(F.col("slot"), F.col("slot") - 1)).alias("slot"),
                          F.col("slot").alias("own"), F.col("rep").alias("b"), F.col("ball").alias("ball_b"),
                          F.col("value").alias("value_b")))
    met = left.join(right, key).filter((F.col("ball_a") != F.col("ball_b")) & (F.abs(F.col("value_a") - F.col("value_b")) <= width)
                                       & ((F.col("own") > F.col("slot")) | (F.col("a") < F.col("b"))))
    return met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("collisions"))


def signatures(table: DataFrame, sizes: DataFrame, crowd: int) -> DataFrame:
    """rep, cells, values and full (the cell where more than ``crowd`` vectors
    share it, else -1), one entry per table, for every vector with such a cell."""
    key = ["dim", "t", "cell"]
    full = table.join(sizes.filter(F.col("size") > crowd), key).select("rep", "t", F.col("cell").alias("full"))
    some = table.join(full.select("rep").distinct(), "rep", "left_semi").join(full, ["rep", "t"], "left")
    one = F.sort_array(F.collect_list(F.struct("t", "cell", "value", F.coalesce("full", F.lit(-1).cast("long")).alias("full"))))
    return (some.groupBy("rep").agg(one.alias("s"))
            .select("rep", F.col("s.cell").alias("cells"), F.col("s.value").alias("values"), F.col("s.full").alias("full")))


def block_links(left: dict, right: dict, same: bool, t: int, threshold: float, width: float) -> np.ndarray:
    """Which pairs of two blocks of a full cell of table ``t`` are links that
    belong to this cell (``same``: the blocks are one, each pair is met twice)."""
    cos = left["unit"] @ right["unit"].T
    linked = (cos >= threshold) & (left["ball"][:, None] != right["ball"][None, :])
    # where the order of the sum could decide, the sum is taken in order
    for x, y in zip(*np.nonzero(np.abs(cos - threshold) < 1e-12), strict=True):
        linked[x, y] = linked[x, y] if left["ball"][x] == right["ball"][y] else \
            sum(a * b for a, b in zip(left["unit"][x].tolist(), right["unit"][y].tolist(), strict=True)) >= threshold
    if same:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return linked
    hits = np.zeros(linked.shape, np.int32)
    for k in range(left["cells"].shape[1]):
        cell = left["cells"][:, k][:, None] == right["cells"][:, k][None, :]
        if k < t:
            linked &= ~(cell & (left["full"][:, k] >= 0)[:, None])
        hits += cell & (np.abs(left["values"][:, k][:, None] - right["values"][:, k][None, :]) <= width)
    return linked & (hits >= NEEDED)


def joined(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector of either block the smallest id reachable over ``linked``."""
    big = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        c = np.minimum(a, np.where(linked, b[None, :], big).min(1))
        d = np.minimum(b, np.where(linked, c[:, None], big).min(0))
        if (c == a).all() and (d == b).all():
            return c, d
        a, b = c, d


def crowded_links(placed: DataFrame, table: DataFrame, sizes: DataFrame, sig: DataFrame, *, threshold: float, width: float,
                  crowd: int, block: int) -> DataFrame:
    """rep, n, root: links of vectors in full cells, counted by block pair (n,
    with the weights of the partners), and the smallest vector they lead to."""
    key = ["dim", "t", "cell"]
    members = (table.join(sizes.filter(F.col("size") > crowd), key)
               .select("rep", "ball", "t", "size", F.concat_ws("/", *key).alias("group")))
    rows = members.join(sig, "rep").join(placed.select("rep", "weight", "unit"), "rep")

    def run(batches):
        import pyarrow as pa

        def result(found):
            i, j, t = found[0][1:4]
            if len({m[4] for m in found}) < len({i, j}):
                return None
            sides = [{c: np.array([m[k] for m in found if m[4] == s]) for k, c in
                      enumerate(("rep", "ball", "weight", "unit", "cells", "values", "full"), 5)} for s in sorted({i, j})]
            left, right = (sides[0], sides[0]) if i == j else sides
            linked = block_links(left, right, i == j, t, threshold, width)
            if not linked.any():
                return None
            roots = joined(linked, left["rep"], right["rep"])
            out = [(left["rep"], (linked * right["weight"][None, :]).sum(1), roots[0])]
            if i != j:
                out.append((right["rep"], (linked * left["weight"][:, None]).sum(0), roots[1]))
            rep, n, root = (np.concatenate(c) for c in zip(*out, strict=True))
            some = n > 0
            return pa.RecordBatch.from_arrays([pa.array(x[some].astype(np.int64)) for x in (rep, n, root)], ["rep", "n", "root"])

        held: list = []
        for batch in batches:
            plain = zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j", "t", "own", "rep", "ball", "weight")),
                        strict=True)
            lists = [(batch.column(c).flatten().to_numpy(), np.append(0, np.cumsum(batch.column(c).value_lengths().to_numpy())))
                     for c in ("unit", "cells", "values", "full")]
            for r, row in enumerate(plain):
                if held and held[0][:3] != row[:3]:
                    if len(held) > 1 and (out := result(held)) is not None:
                        yield out
                    held = []
                held.append((*row, *(v[e[r]:e[r + 1]] for v, e in lists)))
        if len(held) > 1 and (out := result(held)) is not None:
            yield out

    return map_batches(dealt_blocks(rows, "group", block), run, "rep long, n long, root long")


def near_vectors(vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vec_col: str = "embedding", crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Two rows are linked if their vectors (of equal length) have a cosine of at
    least ``threshold`` in double precision.  A vector that is null, empty,
    zero or holds null or non-finite components links with nothing, and so does
    a row without id (its component_id is null).  Rows that repeat an id count
    as rows of their class.  Further columns are not read.
    """
    rows, classes = unit_classes(vectors, id_col, vec_col)
    n = classes.count()
    bits = max(2, math.ceil(math.log2(max(n, 4))) - 2)
    width = SPREAD * math.sqrt(2 - 2 * threshold)
    ball = balls(classes, max(2, bits // 2), threshold)
    placed = cut(classes.join(ball, "rep", "left").select(
        "rep", "weight", "unit", F.coalesce("ball", "rep").alias("ball")), "op1-placed")
    table = cut(projections(placed, tables_for(threshold, bits), bits, width), "op1-table")
    key = ["dim", "t", "cell"]
    sizes = cut(table.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "op1-cells")
    sig = cut(signatures(table, sizes, crowd), "op1-signatures")
    blocks = cut(crowded_links(placed, table, sizes, sig, threshold=threshold, width=width, crowd=crowd, block=block),
                 "op1-blocks")
    sparse = table.join(sizes.filter(F.col("size") <= crowd), key, "left_semi")
    pairs = window_collisions(sparse, width).filter(F.col("collisions") >= NEEDED).select("a", "b")
    known = placed.join(sig.select("rep", "full"), "rep", "left")
    side = lambda x: known.select(F.col("rep").alias(x), F.col("unit").alias(f"unit_{x}"), F.col("weight").alias(f"w_{x}"),
                                  F.col("full").alias(f"full_{x}"))
    in_blocks = F.exists(F.zip_with("full_a", "full_b", lambda x, y: (x == y) & (x >= 0)), lambda hit: hit)
    links = cut(pairs.join(side("a"), "a").join(side("b"), "b").filter(~F.coalesce(in_blocks, F.lit(False)))
                .filter(cosine(F.col("unit_a"), F.col("unit_b")) >= threshold).select("a", "b", "w_a", "w_b"), "op1-links")
    across = (links.select(F.col("a").alias("rep"), F.col("w_b").alias("w"))
              .unionByName(links.select(F.col("b").alias("rep"), F.col("w_a").alias("w")))
              .unionByName(blocks.select("rep", F.col("n").alias("w")))
              .groupBy("rep").agg(F.sum("w").alias("across")))
    inside = placed.groupBy("ball").agg(F.sum("weight").alias("inside"))
    star = placed.filter("rep <> ball").select(F.col("rep").alias("a"), F.col("ball").alias("b"))
    star = star.unionByName(blocks.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    comps = cut(connected_components(links.select("a", "b").unionByName(star), name="op1-graph"), "op1-components")
    facts = (placed.select("rep", "ball").join(inside, "ball").join(across, "rep", "left")
             .join(comps, F.col("rep") == F.col("node"), "left")
             .select("rep", (F.col("inside") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(facts, "rep", "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp).alias("kept"))
