"""Sequence packing by non-negative least squares over the length histogram.

1. Tokenise: every document becomes ids plus an end id and is cut into pieces
   of ``window`` ids; only its last piece is shorter.  The narrow piece table is
   cut, so no text is tokenised twice.
2. Histogram: piece lengths, rounded up to a grid of ``grid`` ids, give at most
   window / grid classes; the histogram is all the driver ever sees.
3. Combinations: every way to fill the window with at most ``depth`` classes is
   a column; NNLS solves for repeat counts against the histogram, they are
   rounded within what is there, and the residual classes are packed greedily,
   largest first.
4. Assign: pieces are numbered within their class by a two-level rank (buckets of
   bounded size by a hash of the row number stored with the piece, so rows that
   share an id are spread too; then bucket totals), a rank selects a combination,
   its repeat and its slot through a join with the (bounded) plan, and a window
   over each sequence gives the gapless offset.
"""
from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_batches
from .heap_bpe import Generations, byte_symbols
from .tokens import byte_blocks, text_bytes

WINDOW = 2048
GRID = 16
DEPTH = 4
END_ID = 1
BUCKET_ROWS = 20_000
SLICE = 4 << 20  # bytes of text taken together
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class ChunkTokenizer:
    """``tokenizers`` ids of whole texts, a slice of a column at a time.

    The vocabulary's pre-tokenizer never joins across a space or line feed, so
    the ids of a text are those of its chunks in order: Arrow splits the texts,
    numbers the distinct chunks and gathers their ids, Python sees a chunk once
    a slice.  Chunks of printable ASCII and precomposed Latin-1 letters are cut
    into words by the same pattern here and the words, remembered from slice to
    slice, go to the BPE model alone; all others take the library's full path.
    """
    LATIN = r"\A[!-~À-ÖØ-öø-ÿ]*\z"
    WORDS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+").findall
    BYTES = byte_symbols()

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.words = Generations(self._word)
        self.others = Generations(self._full)

    def _full(self, chunk: str) -> bytes:
        return array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if word == "\n":
            return b""
        if not word.isascii():
            word = "".join(map(self.BYTES.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _latin(self, chunks: list[str]):
        """Ids of Latin chunks; line feeds, which have no ids, stand between them."""
        import pyarrow as pa

        words = pa.array(self.WORDS("\n".join(chunks).lower()), pa.large_string()).dictionary_encode()
        names = strings(words.dictionary)
        ids = pa.array(list(map(self.words.__getitem__, names)), pa.large_binary()).take(words.indices)
        offsets, data = text_bytes(ids)
        feeds = words.indices.to_numpy() == (names.index("\n") if "\n" in names else -1)
        bounds = np.concatenate([offsets[:1], offsets[:-1][feeds], offsets[-1:]])
        return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(bounds), pa.py_buffer(data)])

    def _chunks(self, chunks):
        """Ids of an Arrow array of distinct chunks."""
        import pyarrow as pa
        import pyarrow.compute as pc

        latin = pc.and_not(pc.match_substring_regex(chunks, self.LATIN), pc.match_substring(chunks, "<|"))
        rest = strings(chunks.filter(pc.invert(latin)))
        if len(rest) == len(chunks):
            return pa.array(list(map(self.others.__getitem__, rest)), pa.large_binary())
        own = self._latin(strings(chunks.filter(latin)))
        if not rest:
            return own
        place = np.argsort(np.argsort(~latin.to_numpy(zero_copy_only=False), kind="stable"))
        other = pa.array(list(map(self.others.__getitem__, rest)), pa.large_binary())
        return pa.concat_arrays([own, other]).take(pa.array(place))

    def encode_texts(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and bytes of the ids of an Arrow string array, as
        little-endian unsigned 32-bit integers (null: none)."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        free = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, "<|"))  # control strings heed case
        low = pc.if_else(free, pc.ascii_lower(texts), texts)
        split = pc.split_pattern(pc.replace_substring(low, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        offsets, data = text_bytes(self._chunks(coded.dictionary).take(coded.indices))
        return offsets[split.offsets.to_numpy()], data

    def encode(self, text: str) -> bytes:
        import pyarrow as pa

        return self.encode_texts(pa.array([text], pa.string()))[1].tobytes()


def strings(column) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


@lru_cache(maxsize=2)
def load(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = END_ID,
                     with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens (and the
    ids themselves on request).  A null or empty text is the end id alone."""
    end = np.uint32(end_id).tobytes()

    def run(batches):
        import pyarrow as pa

        tok = load(tokenizer_path)
        for batch in batches:
            for part, _, _ in byte_blocks(batch, 1, SLICE):
                at, data = tok.encode_texts(part.column(1))
                rows, ids_out = [], []
                for doc, (a, b) in zip(part.column(0).to_pylist(), pairwise(at.tolist()), strict=True):
                    ids = data[a:b].tobytes() + end
                    n = len(ids) // 4
                    for s in range(0, n, window):
                        piece = ids[4 * s: 4 * (s + window)]
                        rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
                        if with_ids:
                            ids_out.append(np.frombuffer(piece, "<u4").astype(np.int64))
                cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids_out, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run,
                       PIECES + (", ids array<long>" if with_ids else ""))


def fillings(units: int, depth: int) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` classes that add up to ``units``."""
    out: list[tuple[int, ...]] = []

    def extend(rest: int, most: int, parts: tuple[int, ...]) -> None:
        if rest == 0:
            out.append(parts)
        elif len(parts) < depth and most * (depth - len(parts)) >= rest:
            for c in range(min(rest, most), 0, -1):
                extend(rest - c, c, (*parts, c))

    extend(units, units, ())
    return out


def nnls(a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """x >= 0 minimising |a x - h| by the active-set method; at most
    len(h) entries are non-zero, so rounding costs at most one repeat each."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    tol = 1e-9 * max(1.0, float(h.max(initial=0.0)))
    for _ in range(6 * len(h)):
        gain = a.T @ (h - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tol:
            break
        active[best] = True
        while True:
            idx = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, idx], h, rcond=None)[0]
            if z.min(initial=1.0) > 0:
                x[:] = 0
                x[idx] = z
                break
            low = z <= 0
            step = np.min(x[idx][low] / np.maximum(x[idx][low] - z[low], 1e-300))
            x[idx] += step * (z - x[idx])
            drop = idx[low & (x[idx] <= tol)]
            if not len(drop):
                drop = idx[[int(np.argmin(z))]]
            x[drop] = 0
            active[drop] = False
            if not active.any():
                break
    return x


def packing_plan(histogram: dict[int, int], units: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(classes of one sequence, repeats) so that all pieces are placed once."""
    left = np.zeros(units + 1, np.int64)
    for c, n in histogram.items():
        left[c] = n
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(parts: tuple[int, ...], most: int) -> None:
        need = np.bincount(parts, minlength=units + 1)
        used = need > 0
        n = int(min(most, (left[used] // need[used]).min()))
        if n > 0:
            left[:] -= n * need
            plan.append((parts, n))

    take((units,), int(left[units]))
    present = set(np.flatnonzero(left).tolist())
    combos = [f for f in fillings(units, depth) if present.issuperset(f)]
    if combos:
        a = np.zeros((units, len(combos)))
        for j, parts in enumerate(combos):
            for c in parts:
                a[c - 1, j] += 1
        x = nnls(a, left[1:].astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            take(combos[j], int(round(x[j])))
    while left.any():
        rest, room, parts = left.copy(), units, []
        while room and (fit := np.flatnonzero(rest[: room + 1])).size:
            c = int(fit[-1])
            parts.append(c)
            rest[c] -= 1
            room -= c
        take(tuple(parts), int(left.max()))
    return plan


def plan_rows(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, end rank, first sequence, repeats, first slot)."""
    rows, used, seq = [], {}, 0
    for parts, n in plan:
        for slot, c in enumerate(parts):
            lo = used.get(c, 0)
            rows.append((c, lo, lo + n, seq, n, slot))
            used[c] = lo + n
        seq += n
    return rows


def pack(pieces: DataFrame, *, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH,
         bucket_rows: int = BUCKET_ROWS, deal_by: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """Add sequence_id and offset to every row of ``pieces`` (doc_id, start,
    length in 1..window, further columns pass through).

    ``pieces`` should be a stored table: it is read three times.  Equal rows
    are placed one by one; an empty table stays empty.  Rows are dealt over
    buckets by the columns ``deal_by``: name a row number stored with the
    pieces where many rows may share an id or have none.
    """
    spark, units = pieces.sparkSession, -(-window // grid)
    carried = pieces.columns
    marked = pieces.withColumn("_class", F.ceil(F.col("length") / grid).cast("int"))
    histogram = {r["_class"]: r["count"] for r in marked.groupBy("_class").count().collect()}  # at most `units` rows
    rows = plan_rows(packing_plan(histogram, units, depth))
    buckets = max(1, -(-sum(histogram.values()) // bucket_rows))
    marked = marked.withColumn("_bucket", F.pmod(F.xxhash64(*deal_by), F.lit(buckets)))
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (marked.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
            .select("_class", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("_class", "_bucket").orderBy("doc_id", "start", *[c for c in ("ids_crc32",) if c in carried])
    ranked = (marked.withColumn("_in", F.row_number().over(inside) - 1).join(base, ["_class", "_bucket"])
              .withColumn("_rank", F.col("_base") + F.col("_in")))
    plan = spark.createDataFrame(rows, "c int, lo long, hi long, seq long, n long, slot int")
    placed = ranked.join(F.broadcast(plan), (F.col("_class") == F.col("c")) & (F.col("_rank") >= F.col("lo"))
                         & (F.col("_rank") < F.col("hi")))
    placed = placed.select(*carried, "_class", (F.col("seq") + F.col("_rank") - F.col("lo")).alias("sequence_id"), "slot")
    whole = placed.filter(F.col("_class") == units).withColumn("offset", F.lit(0).cast("long"))
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    shared = (placed.filter(F.col("_class") < units)
              .withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))))
    return whole.unionByName(shared).select(*carried, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack every whole text: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    Null texts count as empty, null ids and repeated rows are packed like any
    other row, further columns of ``docs`` are not read.
    """
    pieces = tokenised_pieces(docs, tokenizer_path, window=window, end_id=end_id, id_col=id_col, text_col=text_col)
    numbered = cut(pieces.withColumn("_row", F.monotonically_increasing_id()), "op9-pieces")
    return pack(numbered, window=window, deal_by=("_row",)).drop("_row")
