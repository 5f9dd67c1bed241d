"""MinHash near-deduplication with HyperMinHash sketches.

1. Sketch (one pass over the texts): the distinct word shingles are hashed to
   64 bits; the top 7 bits choose one of 128 buckets, and of a bucket's smallest
   remainder the number of leading zeros and the next 10 bits (mantissa) are
   kept: 16 bits a register.  A bucket that stays empty takes its register from
   the first re-hash of the set that reaches it, so registers of small sets
   collide with the Jaccard probability too.
2. Equal shingle sets (by a 128-bit digest) become one class at once; only
   class representatives go on.
3. Bands of four registers are exactly one 64-bit integer.  Every member of a
   band bucket is paired with the bucket's most connected member only (a star),
   and the links found are contracted.  Members of one bucket that still lie in
   different components are compared by their sketches, in blocks of ``BLOCK``;
   a task returns the pairs of components that a similar pair joins, at most as
   many as it holds members.  Components joined so, directly or by others, are
   one group, and every pair that a link may join lies in one group.  Then each
   group's members are compared once, again in blocks, by sketches and full
   shingle-hash sets.  So no bucket or group emits its pairs, a full set travels
   once per block of its group and not once per bucket, and a bucket full of
   similar but unlinked texts still loses no link.
4. Pairs must pass the collision-corrected Jaccard estimate of the sketches,
   then the exact test on the full shingle sets of the texts.

At similarity 0.8 a pair shares no band with probability (1 - 0.8**4)**32 =
5e-8; the estimate's margin is over four standard errors.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches
from .graph import connected_components
from .tokens import Splitter, byte_blocks, mix

REGISTERS = 128
BUCKET_BITS = 7
MANTISSA_BITS = 10
ROWS = 4
BANDS = REGISTERS // ROWS
MARGIN = 0.16
BLOCK = 512
SHINGLE = 5
PERCENT = 80
ROUND = 0x9E3779B97F4A7C15
FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
           0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, words divided by space, tab, line feed, \\v, \\f, \\r."""
    return text.encode().lower().split()


def shingle_sets(offsets: np.ndarray, data: np.ndarray, k: int):
    """Per text of a block its sorted distinct 64-bit hashes of the k-word
    shingles; fewer words give one shingle of all of them, no words none."""
    found = Splitter().split(offsets, data)
    bounds = np.searchsorted(found.text, np.arange(len(offsets))).tolist()

    def hashed(w: np.ndarray, size: int) -> np.ndarray:
        n = len(w) - size + 1
        h = np.full(n, size, np.uint64)
        for i in range(size):
            h = mix(h + w[i:i + n]) * np.uint64(FACTORS[i % len(FACTORS)])
        return mix(h)

    windows = hashed(found.hash, k) if len(found.hash) >= k else None
    for a, b in pairwise(bounds):
        if b - a >= k:
            yield np.unique(windows[a:b - k + 1])
        else:
            yield hashed(found.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 128 registers (uint16) of a non-empty set of distinct hashes."""
    low = np.full(REGISTERS, EMPTY)
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    at = np.searchsorted(hashes, edges)
    inside = at < len(hashes)
    first = hashes[np.minimum(at, len(hashes) - 1)]
    hit = inside & (first >> np.uint64(64 - BUCKET_BITS) == np.arange(REGISTERS, dtype=np.uint64))
    low[hit] = first[hit]
    start = 1
    while (empty := low == EMPTY).any():
        many = max(1, min(64, 4096 // len(hashes)))
        turn = np.arange(start, start + many, dtype=np.uint64)[:, None] * np.uint64(ROUND)
        g = mix(hashes[None, :] + turn)
        table = np.full((many, REGISTERS), EMPTY)
        np.minimum.at(table, (np.arange(many)[:, None], (g >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)), g)
        reached = table != EMPTY
        some = empty & reached.any(0)
        low[some] = table[reached.argmax(0)[some], np.flatnonzero(some)]
        start += many
    rest = low << np.uint64(BUCKET_BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.where(rest >> np.uint64(11) == 0, 53, zeros).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    return ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype("<u2")


def random_collision(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of these sizes agrees:
    both minima fall in the same interval of length 2**-(zeros + 1 + mantissa),
    summed over the leading-zero counts."""
    a, b = np.maximum(na / REGISTERS, 1.0), np.maximum(nb / REGISTERS, 1.0)
    e = a + b - 1
    total = np.zeros(np.broadcast(a, b).shape)
    for z in range(40):
        lo, hi = 2.0 ** -(z + 1), 2.0 ** -z
        width = 2.0 ** -(z + 1 + MANTISSA_BITS)
        total += width * a * b / e * ((1 - lo) ** e - (1 - hi) ** e)
    return total


@lru_cache(maxsize=1024)
def own_collision(step: int) -> float:
    """``random_collision`` of two sets of 2**(step / 8) elements.  It is about
    1e-3 and changes little within the sizes that can be similar enough, which is
    nothing beside ``MARGIN``."""
    size = np.array([2.0 ** (step / 8)])
    return float(random_collision(size, size)[0])


def estimated_jaccard(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Collision-corrected estimate from register matrices (pairs x 128)."""
    p = random_collision(na, nb)
    return ((ra == rb).mean(axis=1) - p) / (1 - p)


def sketches(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest (16 bytes of the set), bands (32 longs, the
    128 registers); the last two are null for an empty set."""
    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 1):
                n, digests, bands = [], [], []
                for h in shingle_sets(offsets, data, k):
                    n.append(len(h))
                    digests.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                    bands.append(registers(h).view("<i8") if len(h) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                                  pa.array(bands, pa.list_(pa.int64()))],
                                                 ["doc_id", "n_shingles", "digest", "bands"])

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run,
                       "doc_id long, n_shingles long, digest binary, bands array<long>")


def likely_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches pass the size and the similarity estimate."""
    def side(x):
        return reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("bands").alias(f"bands_{x}"))

    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .select("a", "b", "n_a", "n_b", "bands_a", "bands_b"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            na, nb = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            ra, rb = (batch.column(i).flatten().to_numpy().view("<u2").reshape(-1, REGISTERS) for i in (4, 5))
            ok = estimated_jaccard(ra, rb, na, nb) >= percent / 100 - MARGIN
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], ["a", "b"])

    return map_batches(both, run, "a long, b long")


def verified_pairs(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets meet 100 |A & B| >= percent |A | B|.
    ``docs`` (doc_id, text) needs only the texts of these pairs."""
    def side(x):
        return docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))

    def shingles(text):
        w = words_of(text)
        size = min(k, len(w))
        return {b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()

    def run(batches):
        import pyarrow as pa

        last, known = None, set()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                keep = []
                for a, ta, tb in zip(*(part.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                    if last != (a, ta):
                        last, known = (a, ta), shingles(ta or "")
                    other = shingles(tb or "")
                    both = len(known & other)
                    keep.append(both > 0 and 100 * both >= percent * (len(known) + len(other) - both))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep, pa.bool_())) for c in (0, 1)],
                                                 ["a", "b"])

    return map_batches(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b"), run,
                       "a long, b long")


def dealt_blocks(rows: DataFrame, key: str, block: int) -> DataFrame:
    """``rows`` (key, size, rep, comp and payload; size: rows of the key), dealt
    and sorted so that each pair (i, j) of a key's blocks meets in one task."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    keys = [key, "i", "j"]
    # a number of its own, since few bytes here mean much work: the partitions must not be merged by size
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.drop("size", "blocks", "other").repartition(n, *map(F.col, keys)).sortWithinPartitions(*keys, "rep"))


def block_groups(batches, key: str, arrays: list[str]):
    """Per (key, i, j): i, j and the members (own, rep, comp, one array each)."""
    held, at = [], None
    for batch in batches:
        plain = list(zip(*(batch.column(c).to_pylist() for c in (key, "i", "j", "own", "rep", "comp")), strict=True))
        flat = [batch.column(c).flatten().to_numpy().view(np.uint64) for c in arrays]
        ends = [np.append(0, np.cumsum(batch.column(c).value_lengths().to_numpy())) for c in arrays]
        for r, row in enumerate(plain):
            if row[:3] != at:
                if len(held) > 1:
                    yield *at[1:], held
                held, at = [], row[:3]
            held.append((*row[3:], *(f[e[r]:e[r + 1]] for f, e in zip(flat, ends, strict=True))))
    if len(held) > 1:
        yield *at[1:], held


def joining_pairs(i: int, j: int, members: list, size_of: Callable, percent: int, exact: bool):
    """Pairs (x, y, label of x, label of y) of the members of two blocks whose
    sketches (and sets, if ``exact``) are similar enough and which join two
    components; components joined here count as one from then on.

    Of two members with different labels one at least has not the commonest
    label, so only those are compared with the others, each pair once."""
    left = [m for m in members if m[0] == i]
    right = [m for m in members if m[0] == j] if i != j else []
    both = left + right
    label = np.array([m[2] for m in both])
    if not left or (i != j and not right) or (label == label[0]).all():
        return
    values, times = np.unique(label, return_counts=True)
    n = np.array([size_of(m) for m in both], float)
    sketch = np.array([m[3].view("<u2") for m in both])
    of_right = np.arange(len(both)) >= len(left)
    done = np.zeros(len(both), bool)
    for x in np.flatnonzero(label != values[times.argmax()]).tolist():
        done[x] = True
        open_ = (label != label[x]) & ~done & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
        if i != j:
            open_ &= of_right != of_right[x]
        near = np.flatnonzero(open_)
        if not len(near):
            continue
        p = own_collision(int(np.log2(n[x]) * 8))
        agree = (sketch[near] == sketch[x]).mean(1)
        near = near[(agree - p) / (1 - p) >= percent / 100 - MARGIN]
        for part in np.split(near, range(64, len(near), 64)):
            part = part[label[part] != label[x]]
            if exact and len(part):
                common = common_counts(both[x][4], [both[y][4] for y in part])
                part = part[100 * common >= percent * (n[x] + n[part] - common)]
            for y in part:
                a, b = label[x], label[y]
                if a != b:
                    yield both[x], both[y], int(a), int(b)
                    label[label == max(a, b)] = min(a, b)


def common_counts(mine: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with other, non-empty ones."""
    flat = np.concatenate(others)
    hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
    starts = np.append(0, np.cumsum([len(o) for o in others]))[:-1]
    return np.add.reduceat(hit.astype(np.int64), starts)


def similar_components(mixed: DataFrame, reps: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs (a, b) of components that share a bucket and hold there a pair of
    members with similar sketches, up to those that follow from other pairs.
    ``mixed``: bucket, rep, comp, size; ``reps``: rep, n, bands."""
    rows = mixed.join(reps.select("rep", F.concat(F.array("n"), "bands").alias("sketch")), "rep")

    def run(batches):
        import pyarrow as pa

        for i, j, members in block_groups(batches, "bucket", ["sketch"]):
            cut_up = [(*m[:3], m[3][1:], int(m[3][0])) for m in members]
            found = [(min(a, b), max(a, b)) for *_, a, b in joining_pairs(i, j, cut_up, lambda m: m[4], percent, False)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return map_batches(dealt_blocks(rows, "bucket", block), run, "a long, b long")


def group_links(members: DataFrame, texts: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) that join components of one group, by full sets.
    ``members``: group, rep, comp, size; ``texts``: doc_id, text."""
    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 4):
                sets = list(shingle_sets(offsets, data, k))
                some = [s for s, h in enumerate(sets) if len(h)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(some, pa.int64())) for c in range(4)),
                     pa.array([registers(sets[s]).view("<i8") for s in some], pa.list_(pa.int64())),
                     pa.array([sets[s].view("<i8") for s in some], pa.list_(pa.int64()))],
                    ["group", "rep", "comp", "size", "bands", "hashes"])

    plain = members.join(texts, F.col("rep") == F.col("doc_id")).select("group", "rep", "comp", "size", "text")
    sets = map_batches(plain, hashed, "group long, rep long, comp long, size long, bands array<long>, hashes array<long>")

    def run(batches):
        import pyarrow as pa

        for i, j, found in block_groups(batches, "group", ["bands", "hashes"]):
            links = [(min(x[1], y[1]), max(x[1], y[1]))
                     for x, y, *_ in joining_pairs(i, j, found, lambda m: len(m[4]), percent, True)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

    return map_batches(dealt_blocks(sets, "group", block), run, "a long, b long")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id
    reachable over links), kept (doc_id = component_id).

    Two documents are linked if their sets of ``shingle``-word shingles have a
    Jaccard similarity of ``percent`` / 100 or more.  A null or blank text has
    an empty set and links with nothing.  A row without id links with nothing
    and has a null component_id (kept).  Rows that repeat an id are one node.
    Further columns are not read.
    """
    plain = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    sk = cut(sketches(plain, shingle), "op8-sketches")
    linked = sk.filter("digest is not null and doc_id is not null")
    classes = cut(linked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                                               F.first("bands").alias("bands")), "op8-classes")
    members = (classes.select("rep", F.posexplode("bands").alias("band", "value"))
               .select("rep", F.xxhash64("band", "value").alias("bucket")))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut(members.join(shared, "bucket"), "op8-members")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    reps = cut(classes.select("rep", "n", "bands").join(weight, "rep"), "op8-reps")
    texts = cut(plain.join(reps.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi").distinct(), "op8-texts")
    # the member that shares most buckets with others is likeliest to be linked with them
    pivots = (members.join(reps.select("rep", "weight"), "rep").groupBy("bucket")
              .agg(F.max(F.struct("weight", (-F.col("rep")).alias("back"))).alias("_p"))
              .select("bucket", (-F.col("_p.back")).alias("pivot")))
    pairs = (members.join(pivots, "bucket").filter("rep <> pivot")
             .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct())
    likely = cut(likely_pairs(pairs, reps, percent), "op8-likely")
    star = cut(verified_pairs(likely, texts, shingle, percent).distinct(), "op8-star")
    found = cut(connected_components(star, name="op8-graph"), "op8-found")
    placed = (members.join(found, F.col("rep") == F.col("node"), "left")
              .select("bucket", "rep", "size", F.coalesce("component", "rep").alias("comp")))
    mixed = (placed.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
             .filter("_lo < _hi").select("bucket"))
    placed = cut(placed.join(mixed, "bucket"), "op8-mixed")
    near = cut(similar_components(placed, reps, percent, block).distinct(), "op8-near")
    groups = cut(connected_components(near, name="op8-near-graph"), "op8-groups")
    grouped = (placed.select("rep", "comp").distinct().join(groups, F.col("comp") == F.col("node"))
               .select("rep", "comp", F.col("component").alias("group")))
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    grouped = cut(grouped.join(sizes, "group").select("group", "rep", "comp", "size"), "op8-grouped")
    rest = cut(group_links(grouped, texts, shingle, percent, block).distinct(), "op8-rest")
    links = star.unionByName(verified_pairs(rest, texts, shingle, percent))
    comps = cut(connected_components(links, name="op8-all"), "op8-components")
    by_digest = classes.join(comps, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("_comp"))
    out = sk.join(by_digest, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("_comp", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))
