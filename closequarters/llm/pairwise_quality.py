"""Quality by Bradley-Terry pairwise ranking.

Labelled rows give preference pairs (a kept text is preferred to a rejected
one).  The model learns a linear document score by logistic loss on the
difference of the two feature vectors, so only the order of scores matters and
no intercept exists; the threshold comes afterwards, as the score quantile at
the share of rejected labels.  Features are language-neutral surface statistics
of the whole text (character classes, word shape, repetition, compressibility).

One pass over the texts; the labelled sample that reaches the driver is bounded.
"""
from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out, map_batches, text_slices, training_labels

MAX_LABELLED = 50_000
PAIRS_PER_ROW = 4
KEEP_SCORE = 0.3
FEATURES = ("log_chars", "log_words", "upper", "digit", "punct", "symbol", "space", "non_ascii", "distinct_bytes",
            "mean_word", "longest_word", "distinct_words", "distinct_lines", "punct_ends", "bare_symbols",
            "caps_words", "ratio", "log_lines")


def _masks() -> np.ndarray:
    b = np.arange(256)
    upper, digit = (b >= 65) & (b <= 90), (b >= 48) & (b <= 57)
    punct = np.isin(b, list(b".,;:!?'\"()-"))
    space = np.isin(b, list(b" \t\n\r\x0b\x0c"))
    letter = upper | ((b >= 97) & (b <= 122))
    symbol = (b < 128) & ~(letter | digit | punct | space)
    return np.stack([upper, digit, punct, symbol, space, b >= 128], axis=1).astype(float)


MASKS = _masks()
BARE = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def text_features(text: str) -> list[float]:
    """FEATURES of one text; an empty text gives zeros and full distinctness."""
    raw = text.encode()
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, words = max(len(raw), 1), text.split()
    w, lines = max(len(words), 1), text.split("\n")
    distinct = set(words)
    ends = sum(text.count(a + b) for a in ".,;!?" for b in " \n")
    caps = sum(x.isupper() for x in distinct) / max(len(distinct), 1)
    bare = sum(not BARE.isdisjoint(x[-1:]) and x[-1:] not in ".,;:!?" for x in distinct) / max(len(distinct), 1)
    return [np.log1p(len(raw)), np.log1p(len(words)), *(hist @ MASKS / n), np.count_nonzero(hist) / 64,
            len(raw) / w / 8, np.log1p(max(map(len, distinct), default=0)), len(distinct) / w, len(set(lines)) / len(lines),
            ends / w, bare, caps, len(zlib.compress(raw, 1)) / (n + 64), np.log1p(len(lines))]


def expand(x: np.ndarray) -> np.ndarray:
    """Features and their squares, so that a score may prefer middling values."""
    return np.concatenate([x, x * x], axis=1)


class BradleyTerry:
    """Linear score; ``cutoff`` is the raw score at the rejected quantile."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40):
        z = expand(x)
        self.mean, self.scale = (z.mean(0), np.maximum(z.std(0), 1e-6)) if len(z) else (0.0, 1.0)
        self.w = np.zeros(2 * len(FEATURES))
        self.cutoff = 0.0
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            self.cutoff = -50.0 if len(good) or not len(bad) else 50.0
            return
        z = (z - self.mean) / self.scale
        step = np.arange(PAIRS_PER_ROW)
        more, less = (good, bad) if len(good) >= len(bad) else (bad, good)
        left = np.repeat(more, PAIRS_PER_ROW)
        right = less[(np.repeat(np.arange(len(more)), PAIRS_PER_ROW) * 7 + np.tile(step, len(more)) * 9973) % len(less)]
        d = (z[left] - z[right]) * (1 if more is good else -1)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(np.clip(d @ self.w, -35, 35)))  # probability of the wrong order
            hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(d.shape[1])
            move = np.linalg.solve(hess, d.T @ p - ridge * self.w)
            self.w = self.w + np.clip(move, -2, 2)
            if np.abs(move).max() < 1e-7:
                break
        s = np.sort(z @ self.w)
        k = len(bad)
        self.cutoff = float(s[k - 1] + s[min(k, len(s) - 1)]) / 2

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = ((expand(x) - self.mean) / self.scale) @ self.w - self.cutoff
        return 1 / (1 + np.exp(-np.clip(s + np.log(KEEP_SCORE / (1 - KEEP_SCORE)), -50, 50)))


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1, 0.3 is the quantile threshold),
    predicted (score >= 0.3) for every row.

    The preference pairs come from at most ``max_labelled`` labelled rows
    outside the held-out fold (the documented bound of the fit); every row is
    scored.  Null texts count as empty; null ids are scored and never learned
    from; repeated rows are scored one by one.  If only one class is labelled,
    every row gets that class; without labels every row is kept.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = [f"f{i}" for i in range(len(FEATURES))]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, some in text_slices(batch):
                f = np.array([text_features(t) for t in some]).reshape(len(some), len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(f[:, k]) for k in range(f.shape[1]))],
                                                 ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in names)
    raw = cut(map_batches(texts, run, schema), "op6-features")
    train = training_labels(labels, id_col, label_col, max_labelled)
    fit = raw.join(F.broadcast(train), F.col("doc_id") == F.col("_id")).select(*names, "_label").toArrow()
    x = np.stack([fit.column(i).to_numpy() for i in range(len(names))], axis=1)
    model = spark.sparkContext.broadcast(BradleyTerry(x, fit.column(len(names)).to_numpy()))

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.stack([batch.column(1 + k).to_numpy() for k in range(len(names))], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.scores(x))], ["doc_id", "score"])

    scored = map_batches(raw, score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))
