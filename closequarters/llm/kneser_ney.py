"""Toxicity by class-conditional Kneser-Ney models.

Two models predict every symbol from its word's beginning, at most the 7 symbols
before it, so an expression is known by its first letters and its endings share
them.  Symbols are the bytes of the case-folded text, so no two letters of any
script are one.  A gram (history and predicted symbol) is kept exactly in one 64-bit code,
8 bits a symbol, 0 before the word's beginning; the table of distinct grams lives
in the shared folder and grows with the corpus.  The highest order is
class-conditional with absolute discounting; all lower orders are one shared
Kneser-Ney chain of continuation counts over every document of the corpus, so an
expression that is rare in a class falls back on how the corpus as a whole
continues.

Where a gram occurs in no labelled row, the shared chain cancels out of the log
ratio, so scoring needs the exact grams and histories of the bounded labelled
sample and the chain's counts at their endings, which are joined from the
corpus's table.  Tasks turn them into log ratios, all grams of a history in one
of them, and leave these in the shared folder, where the workers that score read
them; the driver holds neither grams nor models.

A text is scored by comparing length-normalised log-likelihoods: the mean log
ratio of the whole text and of its most toxic windows (a long text is not
excused by its length).  A logistic curve, fitted on labelled rows whose
counts were left out of the models, turns them into a probability.

Those histories end at the word's beginning; models of the same kind over word
pairs (``word_pairs``) give three more features of the text, so an expression of
ordinary words is known by their order.

Four passes over the texts (sizes of the labelled ones, grams, words, scores), two
shuffles of partial counts.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .code_table import CodeTable
from .common import cut, held_out, map_batches, text_slices, training_labels
from .hash_store import open_shard, shard_count, write_shards
from .word_pairs import FEATURES, SLICE_BYTES, fit_pairs, labelled_within

REACH = 8  # symbols of a gram: up to 7 of history and the predicted one
TOP = 4  # order of the shared chain below the class-conditional level
BITS = 8
DEAL = 1_000_003  # histories are dealt to shards by their remainder
DISCOUNT = 0.75
WINDOWS = (12, 24)
MAX_LABELLED = 200_000
PAIR_BYTES = 16 << 20
CALIBRATION_FOLD = 4
HELD_ROWS = 1 << 20  # of counts in a task before equal ones are added up, or twice what is left of them
DENSE = 2  # orders of the shared chain that are small enough for a full table
HISTORIES = 1 << (BITS * DENSE)
GAP = b" " * (REACH - 1)
OWN = np.array([2 ** (BITS * (k + 1)) - 1 for k in range(REACH)], np.uint64)


def symbol_table() -> bytes:
    """Byte -> symbol (never 0): every byte is its own symbol, in any script,
    but all ASCII white space is a blank and byte 0 is 254, which no UTF-8 has."""
    table = bytearray(range(256))
    for b in b"\t\n\r\x0b\x0c":
        table[b] = 32
    table[0] = 254
    return bytes(table)


TABLE = symbol_table()
SPACE = TABLE[32]


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all grams of the texts, one after the other, and where each
    text starts (one entry more than texts); a case-folded text of n bytes has
    n + 1.

    A code is the history and the symbol, 8 bits each; its low bytes are the
    gram's endings, the code without its last byte is the history's key.
    """
    raw = [t.casefold().encode() for t in texts]
    joined = (GAP + (b" " + GAP).join(raw) + b" " + GAP).translate(TABLE)
    s = np.frombuffer(joined, np.uint8)
    n = len(s) - REACH + 1
    at = np.arange(len(s), dtype=np.int64 if len(s) >> 31 else np.int32)
    since = at - np.maximum.accumulate(np.where(s == SPACE, at, 0))  # symbols since the last white space
    # a history reaches back to its word's beginning; that of a white space is the word before it
    codes = np.ndarray(n, ">u8", joined, strides=(1,)).astype(np.uint64)
    codes &= OWN[np.minimum(since[REACH - 2:-1], REACH - 1)]
    starts = np.concatenate([[0], np.cumsum([len(r) + REACH for r in raw])])
    return codes, starts


def text_grams(texts: list[str]) -> np.ndarray:
    """Codes of the texts' own grams, without those across the gaps."""
    codes, starts = gram_codes(texts)
    own = np.ones(len(codes) + REACH, bool)
    for s in starts[1:]:
        own[s - REACH + 1:s] = False
    return codes[own[:len(codes)]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """code, n_toxic, n_ordinary from rows (text, _class) with _class 1, 0 or
    null (not a training row): one row per distinct gram of all rows."""
    def run(batches):
        import pyarrow as pa

        parts: list[list[np.ndarray]] = []
        held, most = 0, HELD_ROWS

        def fold():
            codes = np.concatenate([p[0] for p in parts])
            keys, at = np.unique(codes, return_inverse=True)
            sums = [np.bincount(at, np.concatenate([p[i] for p in parts]), len(keys)).astype(np.int64)
                    for i in (1, 2)]
            parts[:] = [[keys, *sums]]

        for batch in batches:
            for part, texts in text_slices(batch, 512, 0, SLICE_BYTES):
                label = part.column(1).to_pylist()
                keys = np.unique(text_grams(texts))
                split = []
                for c in (1, 0):
                    some = [t for t, x in zip(texts, label, strict=True) if x == c]
                    count = np.zeros(len(keys), np.int64)
                    if some:
                        k, m = np.unique(text_grams(some), return_counts=True)
                        count[np.searchsorted(keys, k)] = m
                    split.append(count)
                parts.append([keys, *split])
                held += len(keys)
                if held >= most:
                    fold()
                    held = len(parts[0][0])
                    most = max(HELD_ROWS, 2 * held)
        if parts:
            fold()
            yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), *map(pa.array, parts[0][1:])],
                                             ["code", "n_toxic", "n_ordinary"])

    partial = map_batches(docs.select("text", "_class"), run, "code long, n_toxic long, n_ordinary long")
    return partial.groupBy("code").agg(*[F.sum(c).alias(c) for c in ("n_toxic", "n_ordinary")])


def endings(codes: Column, order: int) -> Column:
    return codes.bitwiseAND(2 ** (BITS * order) - 1)


def chain_counts(table: DataFrame, needed: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The shared chain at the endings that ``needed`` (column code) has, from
    the distinct grams ``table`` (column code): per ending of TOP symbols,
    count, total and kinds of its history at every order above DENSE, and the
    counts of all endings of DENSE symbols (at most HISTORIES).

    A count is the number of distinct longer grams with that ending, total and
    kinds its sum and the number of endings over one history (at most 256 rows).
    """
    longer, levels = table, {}
    for k in range(TOP, DENSE - 1, -1):
        longer = levels[k] = longer.groupBy(endings(F.col("code"), k).alias("code")).agg(F.count(F.lit(1)).alias(f"n{k}"))
    out = needed.select(endings(F.col("code"), TOP).alias("code")).distinct()
    for k in range(TOP, DENSE, -1):
        one = Window.partitionBy(F.shiftrightunsigned("code", BITS))
        level = levels[k].withColumns({f"total{k}": F.sum(f"n{k}").over(one), f"kinds{k}": F.count(F.lit(1)).over(one)})
        level = level.withColumnRenamed("code", "_e")
        out = out.join(level, endings(F.col("code"), k) == F.col("_e")).drop("_e")
    low = levels[DENSE].toArrow()
    dense = np.zeros(HISTORIES, np.int64)
    dense[low.column(0).to_numpy()] = low.column(1).to_numpy()
    return out, dense


class LogRatio:
    """log P(symbol | history, toxic) - log P(symbol | history, ordinary)."""

    def __init__(self, codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, shared: np.ndarray):
        """Distinct grams of the labelled rows: code, counts and the shared
        chain's probability of their last symbol."""
        past, h = np.unique(codes & ~np.uint64(2**BITS - 1), return_inverse=True)
        log_p, lam = [], []
        for count in (toxic.astype(float), ordinary.astype(float)):
            total = np.bincount(h, count, len(past))
            types = np.bincount(h, count > 0, len(past))
            back = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
            p = np.maximum(count - DISCOUNT, 0) / np.maximum(total[h], 1) + back[h] * shared
            log_p.append(np.log(p))
            lam.append(np.log(back))
        # a history's key ends in symbol 0, which no gram does; -1 finds the last value
        self.codes = np.concatenate([codes, past])
        self.ratio = np.concatenate([log_p[0] - log_p[1], lam[0] - lam[1], [0.0]]).astype(np.float32)
        self._table = self._store = None

    @classmethod
    def stored(cls, grams: DataFrame, chain: DataFrame, dense: np.ndarray) -> LogRatio:
        """The same of rows (code, n_toxic, n_ordinary) and what ``chain_counts``
        gives for them, built by tasks and mapped from the shared folder."""
        spark = grams.sparkSession
        orders = range(DENSE + 1, TOP + 1)
        names = [f"{c}{k}" for k in orders for c in ("n", "total", "kinds")]
        shards = shard_count(spark)
        rows = grams.join(chain.withColumnRenamed("code", "_e"), endings(F.col("code"), TOP) == F.col("_e")).select(
            (F.shiftrightunsigned("code", BITS) % DEAL % shards).cast("int").alias("shard"),
            "code", "n_toxic", "n_ordinary", *names)
        low = spark.sparkContext.broadcast(dense)

        def build(code, toxic, ordinary, *counts):
            at = {k: list(counts[3 * i:3 * i + 3]) for i, k in enumerate(orders)}
            shared = cls.chain(code & (2 ** (BITS * TOP) - 1), at, low.value)
            part = cls(code.view(np.uint64), toxic, ordinary, shared)
            table = CodeTable(part.codes)
            return {"slot": table.keys, "ratio": part.ratio[table.places]}

        model = cls.__new__(cls)
        model._store, model._table = write_shards(rows, "op5-ratios", build), None
        return model

    def _stored_ratios(self, codes: np.ndarray) -> np.ndarray:
        """Shard by shard of the histories, whose tables are mapped and so not the worker's own memory."""
        store, out = self._store, np.zeros(len(codes), np.float32)
        of = ((codes >> np.uint64(BITS)) % np.uint64(DEAL) % np.uint64(store.shards)).astype(np.min_scalar_type(store.shards))
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(store.shards + 1))
        for s in store.filled:
            at = order[cuts[s]:cuts[s + 1]]
            slots, ratio = open_shard(store.folder, s, ("slot", "ratio"))
            table = CodeTable.of(slots)
            place = table.find_slots(some := codes[at])
            left = np.flatnonzero(place < 0)
            place[left] = table.find_slots(some[left] & ~np.uint64(2**BITS - 1))
            out[at] = np.where(place >= 0, ratio[place], np.float32(0))
        return out

    @staticmethod
    def _shared(types: np.ndarray) -> np.ndarray:
        """P(last symbol | the one before it) by interpolated Kneser-Ney;
        ``types`` has the number of distinct longer grams per ending, so
        counts are continuation counts at every order."""
        levels = [types]
        while len(levels) < DENSE:
            size = len(levels[-1]) >> BITS
            levels.append(np.bincount(np.flatnonzero(levels[-1]) & (size - 1), minlength=size))
        p = np.full(1 << BITS, 2.0 ** -BITS)
        for count in reversed(levels):
            m = count.reshape(-1, 1 << BITS).astype(float)
            total = m.sum(1, keepdims=True)
            back = np.where(total > 0, DISCOUNT * (m > 0).sum(1, keepdims=True) / np.maximum(total, 1), 1.0)
            lower = np.resize(p, m.size).reshape(m.shape)
            p = (np.maximum(m - DISCOUNT, 0) / np.maximum(total, 1) + back * lower).ravel()
        return p

    @staticmethod
    def chain(ends: np.ndarray, counts: dict[int, list[np.ndarray]], dense: np.ndarray) -> np.ndarray:
        """P(last symbol | the three before it) at the endings ``ends``, from
        count, total and kinds per order and the counts of the dense orders."""
        p = LogRatio._shared(dense)[ends & (HISTORIES - 1)]
        for k in sorted(counts):
            n, total, kinds = counts[k]
            p = (n - DISCOUNT + DISCOUNT * kinds * p) / total
        return p

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        if self._store is not None:
            return self._stored_ratios(codes)
        if self._table is None:
            self._table = CodeTable(self.codes)
        place = self._table.find(codes)
        left = np.flatnonzero(place < 0)
        place[left] = self._table.find(codes[left] & ~np.uint64(2**BITS - 1))
        return self.ratio[place]

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: the mean log ratio, then the largest mean of a window of
        each size in WINDOWS (a shorter text counts as padded to the window)."""
        codes, starts = gram_codes(texts)
        sums = np.concatenate([[0.0], np.cumsum(self.ratios(codes), dtype=np.float64)])
        out = np.empty((len(texts), 1 + len(WINDOWS)))
        for i in range(len(texts)):
            s, n = starts[i], starts[i + 1] - starts[i] - REACH + 1
            out[i, 0] = (sums[s + n] - sums[s]) / n
            for k, w in enumerate(WINDOWS):
                if n <= w:
                    out[i, 1 + k] = (sums[s + n] - sums[s]) / w
                else:
                    out[i, 1 + k] = (sums[s + w:s + n + 1] - sums[s:s + n - w + 1]).max() / w
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression by Newton steps;
    with one class only the intercept is set, with no rows all are 0."""
    w = np.zeros(x.shape[1] + 1)
    if not len(y) or y.min() == y.max():
        if len(y):
            w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return w
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (y - p) - ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale * mean).sum())


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_labelled: int = MAX_LABELLED,
                    pair_bytes: int = PAIR_BYTES) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= 0.5) for every row.

    Labels are learned from at most ``max_labelled`` rows outside the held-out
    fold (a documented bound that makes them safe to broadcast), the word pairs
    of the classes from those with the first ``pair_bytes`` bytes of text; the
    shared counts cover every document.  Null texts count as empty; null ids are
    scored, never held out and never learned from; repeated rows count as often
    as they occur.  Without any label of one class the score is constant.
    Further columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    train = cut(training_labels(labels, id_col, label_col, max_labelled), "op5-labels")
    known = (train.filter(F.col("_fold") != CALIBRATION_FOLD)
             .select("_id", F.col("_label").alias("_class")))
    counts = gram_counts(texts.join(F.broadcast(known), F.col("doc_id") == F.col("_id"), "left"))
    pairs = fit_pairs(texts, labelled_within(known, texts, pair_bytes))
    table = cut(counts, "op5-grams")
    # no more than the bounded labelled sample holds
    grams = table.filter(F.col("n_toxic") + F.col("n_ordinary") > 0)
    model = spark.sparkContext.broadcast((LogRatio.stored(grams, *chain_counts(table.select("code"), grams)), pairs))
    names = [f"f{k}" for k in range(1 + len(WINDOWS) + FEATURES)]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, some in text_slices(batch, size=SLICE_BYTES):
                f = np.hstack([m.features(some) for m in model.value])
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(f[:, k]) for k in range(f.shape[1]))],
                                                 ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in names)
    raw = cut(map_batches(texts, run, schema), "op5-features")
    fit = raw.join(F.broadcast(train), F.col("doc_id") == F.col("_id")).select(*names, "_label", "_fold").toArrow()
    *x, y, fold = (c.to_numpy() for c in fit.columns)
    x, y = np.stack(x, axis=1), y.astype(float)
    own = fold == CALIBRATION_FOLD
    if len(np.unique(y[own])) < 2:
        own = np.ones(len(y), bool)
    *w, level = fit_logistic(x[own], y[own]).tolist()
    z = F.lit(level) + sum(F.col(c) * v for c, v in zip(names, w, strict=True))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), z))))
    return raw.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                      (score >= 0.5).cast("int").alias("predicted"))
