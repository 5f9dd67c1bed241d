"""Interpolated modified Kneser-Ney language model on memory-mapped hash arrays.

1. Count.  Every task cuts its training texts into words (hashes), pads them
   with marks for beginning and end, combines equal n-grams and sends them on in
   packed arrays, one row per shard of n-gram keys; no n-gram is a hot key, since
   a shard is a range of hashes and its rows are combined before the shuffle.
2. Merge, from the highest order down.  A shard's task adds up its n-grams,
   writes them as sorted hash arrays and sends on, combined, the statistics of
   their histories and the n-grams one word shorter with their number of left
   neighbours (the continuation counts of the next lower order; raw counts where
   the text's beginning stands first, which has no left neighbour).
3. Score.  Workers map the arrays; a text's probabilities are interpolated from
   the unigrams up: max(c - D(c), 0) / total(h) + gamma(h) * lower.  D1, D2, D3+
   come from each order's counts of counts; below the unigrams all known words
   and one unknown word are equally likely.

All tables grow with the corpus and stay in the shared folder; the driver sees
the sums of ten numbers per order.  The registered query takes bigrams; the
order is a parameter.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold_of, map_batches
from .hash_store import HashArrays, shard_count, shard_of, store_folder, write_shard
from .tokens import Splitter, byte_blocks, chain, mix

BEGIN, END = np.uint64(0), np.uint64(1)
ORDER = 2
FLUSH = 2_000_000  # distinct n-grams that a counting task holds at most
GRAMS, HISTORIES, SUMS = 0, 1, 2
PACKED = "kind int, shard int, words array<long>, nums array<long>"
# Discounts where an order has no n-gram that occurs once, twice or three times.
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)


def gram_keys(words: list[np.ndarray]) -> np.ndarray:
    """Keys of n-grams given as one array per word."""
    key = mix(words[0] + np.uint64(len(words)))
    for w in words[1:]:
        key = chain(key, w)
    return key


def padded(hashes: np.ndarray, text: np.ndarray, texts: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each after order - 1 begin marks and with its end
    mark; the places of words and end marks, and where each text's first is."""
    words = np.bincount(text, minlength=texts)
    bases = np.concatenate([[0], np.cumsum(words + order)])[:-1]
    seq = np.full(len(hashes) + texts * order, BEGIN)
    seq[np.arange(len(hashes)) + (text + 1) * order - 1] = hashes
    seq[bases + order - 1 + words] = END
    own = np.ones(len(seq), bool)
    for i in range(order - 1):
        own[bases + i] = False
    return seq, np.flatnonzero(own), np.cumsum(words + 1) - words - 1


def grams_at(seq: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """The words of the n-grams that end at the places ``at``."""
    return [seq[at - i] for i in range(order - 1, -1, -1)]


def combined(words: list[np.ndarray], nums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Sorted keys, words and summed numbers of the distinct n-grams."""
    keys = gram_keys(words)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    first = order[starts]
    return keys[starts], [w[first] for w in words], [np.add.reduceat(n[order], starts) if len(n) else n for n in nums]


def packed_rows(kind: int, shards: int, words: list[np.ndarray], nums: list[np.ndarray], keys: np.ndarray):
    """One row per shard: the words (column after column) and the numbers."""
    import pyarrow as pa

    of = shard_of(keys, shards)
    order = np.lexsort((words[0], of))  # equal first words side by side compress well
    ends = np.searchsorted(of[order], np.arange(shards + 1))
    some = np.flatnonzero(np.diff(ends))

    def lists(columns):
        cells = [np.concatenate([c[order[ends[s]:ends[s + 1]]] for c in columns]) for s in some]
        at = np.cumsum([0, *map(len, cells)])
        flat = np.concatenate(cells).view(np.int64) if cells else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64()))

    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind), pa.int32()), pa.array(some, pa.int32()),
                                          lists(words), lists(nums)], ["kind", "shard", "words", "nums"])


def count_grams(texts: DataFrame, order: int, shards: int, flush: int = FLUSH) -> DataFrame:
    """Packed n-grams of highest order with their counts, combined per task."""
    def run(batches):
        splitter, parts = Splitter(), []

        def fold():
            found = combined([np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)],
                             [np.concatenate([p[1] for p in parts])])
            parts[:] = [(found[1], found[2][0])]
            return found

        held = 0
        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 0):
                found = splitter.split(offsets, data)
                seq, at, _ = padded(found.hash, found.text, part.num_rows, order)
                _, words, (n,) = combined(grams_at(seq, at, order), [np.ones(len(at), np.int64)])
                parts.append((words, n))
                held += len(n)
                if held > flush:
                    keys, words, nums = fold()
                    held = len(keys)
                    if held > flush // 2:
                        yield from packed_rows(GRAMS, shards, words, nums, keys)
                        parts.clear()
                        held = 0
        if parts:
            keys, words, nums = fold()
            yield from packed_rows(GRAMS, shards, words, nums, keys)

    return map_batches(texts.select("text"), run, PACKED)


def shard_groups(batches, width: int, fold_at: int = FLUSH):
    """Per shard of packed rows (a task's rows are of one shard): shard, keys,
    words, summed numbers."""
    held: list = []
    shard, rows = None, 0

    def fold():
        return combined(*([np.concatenate(c) for c in zip(*(h[i] for h in held), strict=True)] for i in (0, 1)))

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cells = [(batch.column(c).flatten().to_numpy(), np.append(0, np.cumsum(batch.column(c).value_lengths().to_numpy())))
                 for c in ("words", "nums")]
        for r, s in enumerate(shards.tolist()):
            if held and s != shard:
                yield (shard, *fold())
                held, rows = [], 0
            shard = s
            (words, ends), (nums, to) = cells
            m = int(ends[r + 1] - ends[r]) // width
            columns = list(words[ends[r]:ends[r + 1]].view(np.uint64).reshape(width, m))
            held.append((columns, list(nums[to[r]:to[r + 1]].reshape(-1, m))))
            rows += m
            if rows > 2 * fold_at and len(held) > 1:
                _, columns, sums = fold()
                held, rows = [(columns, sums)], 0
    if held:
        yield (shard, *fold())


def dealt(rows: DataFrame, kind: int, shards: int) -> DataFrame:
    return rows.filter(F.col("kind") == kind).select("shard", "words", "nums").repartitionById(shards, F.col("shard"))


def merge_order(rows: DataFrame, k: int, top: bool, folder: str, shards: int) -> DataFrame:
    """Write the k-grams of packed rows; return packed rows of their histories,
    of the (k-1)-grams, and per shard the sums: number of k-grams, of raw counts,
    of counts, and how many counts are 1, 2, 3 and 4 and above 2."""
    def run(batches):
        import pyarrow as pa

        for shard, keys, words, nums in shard_groups(batches, k):
            raw = nums[0]
            n = raw if top else np.where((words[0] == BEGIN) & (k > 1), raw, nums[1])
            small = np.uint32 if n.max() < 2**32 else np.int64
            write_shard(folder, shard, key=keys, n=n.astype(small), **({"raw": raw} if k == 1 else {}))
            sums = [len(n), raw.sum(), n.sum(), *(np.count_nonzero(n == c) for c in (1, 2, 3, 4)), np.count_nonzero(n > 2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([SUMS], pa.int32()), pa.array([shard], pa.int32()), pa.array([[]], pa.list_(pa.int64())),
                 pa.array([[int(x) for x in sums]], pa.list_(pa.int64()))], ["kind", "shard", "words", "nums"])
            if k > 1:
                key, past, stats = combined(words[:-1], [n, *((n == c).astype(np.int64) for c in (1, 2)),
                                                         (n > 2).astype(np.int64)])
                yield from packed_rows(HISTORIES, shards, past, stats, key)
                key, shorter, stats = combined(words[1:], [raw, np.ones(len(n), np.int64)])
                yield from packed_rows(GRAMS, shards, shorter, stats, key)

    return map_batches(dealt(rows, GRAMS, shards), run, PACKED)


def write_histories(rows: DataFrame, k: int, discounts: tuple, folder: str, shards: int) -> DataFrame:
    """Write total and back-off weight of the histories of the k-grams."""
    def run(batches):
        import pyarrow as pa

        for shard, keys, _, (total, one, two, more) in shard_groups(batches, k - 1):
            gamma = (discounts[0] * one + discounts[1] * two + discounts[2] * more) / total
            write_shard(folder, shard, key=keys, total=total, gamma=gamma)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], ["shard"])

    return map_batches(dealt(rows, HISTORIES, shards), run, "shard int")


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; ``PLAIN_DISCOUNTS`` where a count of counts
    is missing or a formula leaves its range (tiny corpora)."""
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d < i + 1 for i, d in enumerate(found)):
            return found
    return PLAIN_DISCOUNTS


@dataclass(frozen=True)
class KneserNey:
    """A trained model: stores per order (from 1) and of histories (from 2)."""

    order: int
    grams: tuple[HashArrays, ...]
    histories: tuple[HashArrays, ...]
    discounts: tuple[tuple[float, float, float], ...]
    total: int  # of unigram continuation counts
    gamma: float  # weight of the uniform level
    tokens: int
    types: int

    def discounted(self, n: np.ndarray, k: int) -> np.ndarray:
        d = np.array((0.0, *self.discounts[k - 1]))
        return n - d[np.minimum(n, 3).astype(np.int64)]

    def token_scores(self, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability and training count of the words at ``at``."""
        n, raw = self.grams[0].find(gram_keys([seq[at]]), "n", "raw")
        p = self.discounted(n, 1) / max(self.total, 1) + self.gamma / (self.types + 1)
        for k in range(2, self.order + 1):
            words = grams_at(seq, at, k)
            total, gamma = self.histories[k - 2].find(gram_keys(words[:-1]), "total", "gamma")
            n = self.grams[k - 1].find(gram_keys(words), "n")[0]
            p = np.where(total > 0, self.discounted(n, k) / np.maximum(total, 1) + gamma * p, p)
        return np.log10(p), raw


def train_model(texts: DataFrame, order: int = ORDER) -> KneserNey:
    """A model of the column ``text`` (null: empty) of all rows."""
    spark = texts.sparkSession
    shards = shard_count(spark)
    rows = count_grams(texts, order, shards)
    grams, histories, discounts, first = [], [], [], None
    for k in range(order, 0, -1):
        folder = store_folder(spark, f"op12-grams{k}")
        rows = cut(merge_order(rows, k, k == order, folder, shards), f"op12-order{k}")
        found = rows.filter(F.col("kind") == SUMS).select("shard", "nums")
        filled = frozenset(r["shard"] for r in found.select("shard").collect())  # at most one row per shard
        sums = [x or 0 for x in found.agg(*(F.sum(F.col("nums")[i]) for i in range(8))).first()]
        grams.append(HashArrays(folder, shards, filled))
        discounts.append(discounts_of(*sums[3:7]))
        if k > 1:
            folder = store_folder(spark, f"op12-histories{k}")
            written = write_histories(rows, k, discounts[-1], folder, shards).collect()  # at most one row per shard
            histories.append(HashArrays(folder, shards, frozenset(r["shard"] for r in written)))
        else:
            first = sums
    types, tokens, total, one, two = first[:5]
    d = discounts[-1]
    gamma = (d[0] * one + d[1] * two + d[2] * first[7]) / total if total else 1.0
    return KneserNey(order, tuple(grams[::-1]), tuple(histories[::-1]), tuple(discounts[::-1]), total, gamma, tokens, types)


def score_texts(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of (doc_id,
    text): log10 probabilities under add-half unigrams and under the model."""
    def run(batches):
        import pyarrow as pa

        splitter = Splitter()
        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 1):
                found = splitter.split(offsets, data)
                seq, at, first = padded(found.hash, found.text, part.num_rows, model.order)
                score, raw = model.token_scores(seq, at)
                base = np.log10((raw + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
                n = np.diff(np.append(first, len(at)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(np.add.reduceat((raw > 0).astype(np.int64), first)),
                     pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(score, first))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return map_batches(docs.select("doc_id", "text"), run,
                       "doc_id long, n_tokens long, n_known long, base_score double, score double")


def language_model_scores(docs: DataFrame, *, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text",
                          folds: int = 5, held_fold: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for
    every row; ``score`` / ``n_tokens`` gives the perplexity.

    The model learns from the rows whose crc32 of the id (as text) modulo
    ``folds`` is not ``held_fold``.  A null text is empty (only its end mark is
    scored); a row without id is learned from and not held out; repeated rows
    count as often as they occur; with no training row every text has the score
    of one unknown word per token.  Further columns are not read.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    model = train_model(plain.filter(~held), order)
    return score_texts(plain, model).select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                                            F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
