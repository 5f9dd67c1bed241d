"""Class-conditional models of word pairs: the part of the toxicity models whose
histories reach over the previous word.

A word is a stretch of case-folded letters, digits and non-ASCII bytes; what
stands between words is not read, so an expression is known whatever its
punctuation.  Per class, P(word | previous word) is interpolated by absolute
discounting with one shared distribution, the words' counts over every document
of the corpus; so an expression of ordinary words is known by their order.

Pairs are counted in the labelled rows only, which ``labelled_within`` bounds by
their bytes of text; this bounds what a worker holds.  The ratios are built by
tasks, all pairs of a previous word in one of them, and read from the shared
folder by the workers that score; the driver holds none.  Words and pairs are
64-bit hashes (unlike ones meet with a probability of 2^-64 a pair).
One pass over the texts, one shuffle of partial counts.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, text_slices
from .hash_store import shard_count, write_shards
from .tokens import Splitter, chain

DISCOUNT = 0.75
WINDOWS = (1, 4)
FEATURES = 1 + len(WINDOWS)
BEGIN = np.uint64(1)  # what stands before a text's first word
WORDS = 0  # in place of the previous word in rows that count single words
SPLITTER = Splitter(spaces=bytes(b for b in range(128) if not chr(b).isalnum()))
SLICE_BYTES = 1 << 19  # of text whose work arrays a worker holds at once
HELD_ROWS = 1 << 20  # of counts in a task before equal ones are added up; half of it stays
COUNTS = ("n_toxic", "n_ordinary", "n")


def word_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous word, word and text number of every word of the texts."""
    raw = [t.casefold().encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words = SPLITTER.split(offsets, np.frombuffer(b"".join(raw), np.uint8))
    past = np.full(len(words.hash), BEGIN)
    same = words.text[1:] == words.text[:-1]
    past[1:][same] = words.hash[:-1][same]
    return past, words.hash, words.text


def pair_keys(past: np.ndarray, word: np.ndarray) -> np.ndarray:
    return chain(past, word)


def labelled_within(train: DataFrame, texts: DataFrame, most_bytes: int) -> DataFrame:
    """Rows of ``train`` (_id, ...; a bounded table) in the order of a hash of the
    id, as long as the texts of the ids so far have at most ``most_bytes`` bytes
    together; an id with more than a sixteenth of it is left out."""
    sizes = (texts.join(F.broadcast(train), F.col("doc_id") == F.col("_id")).groupBy("_id")
             .agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("_bytes")))
    so_far = F.sum("_bytes").over(Window.orderBy(F.xxhash64("_id"), "_id"))  # no more rows than ``train``
    some = sizes.filter(F.col("_bytes") <= most_bytes // 16).withColumn("_so_far", so_far)
    return train.join(F.broadcast(some.filter(F.col("_so_far") <= most_bytes).select("_id")), "_id", "left_semi")


def pair_counts(docs: DataFrame) -> DataFrame:
    """past, word, n_toxic, n_ordinary, n from rows (text, _class): the pairs of
    the rows with a class (1 or 0), and per word of all rows a row with past 0."""
    def fold(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        past, word, *counts = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((past, word))
        past, word = past[order], word[order]
        first = np.ones(len(past), bool)
        first[1:] = (past[1:] != past[:-1]) | (word[1:] != word[:-1])
        new = np.flatnonzero(first)
        return [past[new], word[new], *(np.add.reduceat(c[order], new) for c in counts)]

    def run(batches):
        import pyarrow as pa

        def out(part):
            cols = [pa.array(part[0].view(np.int64)), pa.array(part[1].view(np.int64)), *(pa.array(c, pa.int64()) for c in part[2:])]
            return pa.RecordBatch.from_arrays(cols, ["past", "word", *COUNTS])

        parts: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            for part, texts in text_slices(batch, 512, 0, SLICE_BYTES):
                past, word, text = word_pairs(texts)
                keys, n = np.unique(word, return_counts=True)
                none = np.zeros(len(keys), np.int32)
                parts.append([np.full(len(keys), WORDS, np.uint64), keys, none, none, n.astype(np.int32)])
                label = part.column(1).to_numpy(zero_copy_only=False).astype(float)[text]
                own = np.flatnonzero((label == 1) | (label == 0))
                toxic = (label[own] == 1).astype(np.int32)
                parts.append([past[own], word[own], toxic, 1 - toxic, np.zeros(len(own), np.int32)])
                held += len(keys) + len(own)
                if held >= HELD_ROWS:
                    parts = [fold(parts)]
                    if len(parts[0][0]) > HELD_ROWS // 2:
                        yield out(parts.pop())
                    held = sum(len(p[0]) for p in parts)
        if parts:
            yield out(fold(parts))

    partial = map_batches(docs.select("text", "_class"), run, "past long, word long, n_toxic long, n_ordinary long, n long")
    return partial.groupBy("past", "word").agg(*[F.sum(c).alias(c) for c in COUNTS])


class PairRatio:
    """log P(word | previous word, toxic) - log P(word | previous word, ordinary)."""

    ARRAYS = {"pairs": np.uint64, "pair_ratio": np.float32, "pasts": np.uint64, "past_ratio": np.float32}

    def __init__(self, past: np.ndarray, word: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, shared: np.ndarray):
        """Distinct pairs of the labelled rows: hashes, counts and the shared
        probability of the word."""
        pasts, h = np.unique(past, return_inverse=True)
        log_p, lam = [], []
        for count in (toxic.astype(float), ordinary.astype(float)):
            total = np.bincount(h, count, len(pasts))
            kinds = np.bincount(h, count > 0, len(pasts))
            back = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            log_p.append(np.log(np.maximum(count - DISCOUNT, 0) / np.maximum(total[h], 1) + back[h] * shared))
            lam.append(np.log(back))
        order = np.argsort(keys := pair_keys(past, word))
        self.pairs, self.pasts = keys[order], pasts
        self.pair_ratio = (log_p[0] - log_p[1])[order].astype(np.float32)
        self.past_ratio = (lam[0] - lam[1]).astype(np.float32)
        self._store = None

    @classmethod
    def stored(cls, rows: DataFrame, total: int) -> PairRatio:
        """The same of rows (past, word, n_toxic, n_ordinary, n) with the word's
        count n of ``total``, built by tasks and read from the shared folder on
        first use."""
        shard = F.pmod(F.xxhash64("past"), F.lit(shard_count(rows.sparkSession))).cast("int").alias("shard")

        def build(past, word, toxic, ordinary, n):
            return cls(past.view(np.uint64), word.view(np.uint64), toxic, ordinary, n / total).arrays()

        model = cls.__new__(cls)
        model._store = write_shards(rows.select(shard, "past", "word", *COUNTS), "op5-pair-ratios", build)
        model.pairs = None
        return model

    def arrays(self) -> dict[str, np.ndarray]:
        return {c: getattr(self, c) for c in self.ARRAYS}

    def _load(self) -> None:
        """Shards one after the other, ordered anew for the lookup."""
        found = dict(zip(self.ARRAYS, self._store.whole(**self.ARRAYS), strict=True))
        for key, ratio in (("pairs", "pair_ratio"), ("pasts", "past_ratio")):
            order = np.argsort(found[key])
            setattr(self, ratio, found[ratio][order])
            setattr(self, key, found[key][order])

    def __getstate__(self):
        return self.__dict__ if self._store is None else {"_store": self._store, "pairs": None}

    def ratios(self, past: np.ndarray, word: np.ndarray) -> np.ndarray:
        if self.pairs is None:
            self._load()
        keys = pair_keys(past, word)
        out = np.zeros(len(keys), np.float32)
        if not len(self.pairs):
            return out
        place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        found = self.pairs[place] == keys
        out[found] = self.pair_ratio[place[found]]
        left = np.flatnonzero(~found)
        place = np.minimum(np.searchsorted(self.pasts, past[left]), len(self.pasts) - 1)
        known = self.pasts[place] == past[left]
        out[left[known]] = self.past_ratio[place[known]]
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: the mean log ratio of its words, then the largest mean of a
        window of each size in WINDOWS (a shorter text counts as padded)."""
        past, word, text = word_pairs(texts)
        sums = np.concatenate([[0.0], np.cumsum(self.ratios(past, word), dtype=np.float64)])
        starts = np.searchsorted(text, np.arange(len(texts) + 1))
        out = np.zeros((len(texts), FEATURES))
        for i in range(len(texts)):
            s, e = starts[i], starts[i + 1]
            if s == e:
                continue
            out[i, 0] = (sums[e] - sums[s]) / (e - s)
            for k, w in enumerate(WINDOWS):
                out[i, 1 + k] = ((sums[s + w:e + 1] - sums[s:e - w + 1]).max() if e - s > w else sums[e] - sums[s]) / w
        return out


def fit_pairs(texts: DataFrame, known: DataFrame) -> PairRatio:
    """The model of ``texts`` (doc_id, text) with the classes ``known`` (_id,
    _class; bounded by ``labelled_within``); without any it gives 0 everywhere."""
    rows = texts.join(F.broadcast(known), F.col("doc_id") == F.col("_id"), "left")
    table = cut(pair_counts(rows), "op5-pairs")
    words = table.filter(F.col("past") == WORDS)
    total = words.agg(F.sum("n")).first()[0] or 1
    pairs = table.filter(F.col("past") != WORDS).drop("n").join(words.select("word", "n"), "word")
    return PairRatio.stored(pairs, total)
