"""Periodic runs of words by a dictionary of basic factors.

For every power of two L, each place of a text gets the name of the L words that
start there: equal names, equal words (Karp, Miller and Rosenberg's naming; the
names of 2 L come from pairs of names of L).  If a factor's next occurrence
starts at most L words later, both lie within twice that length, so they overlap
or touch and the distance p is the smallest period of the stretch they cover.
The places whose successors have one distance p form arithmetic progressions; a
maximal stretch of neighbouring places covers exactly the words that continue the
period, so its first place and its last successor's end are the run's bounds.
A run of period p and 2 p + L words or more is found at every L >= p that it is
long enough for; levels find runs again, which are then dropped.

Names of factors that occur once in their text are left out at the next level,
so a text without long repeats costs little more than its sorted words.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .tokens import ASCII_SPACE, Splitter, byte_blocks

MIN_LENGTH = 6
MIN_EXPONENT = 4
RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"
# \x20\x09-\x0D as a Java pattern
SPACES = r"[ \t\n\x0B\f\r]+"


def names_of(pairs: np.ndarray) -> np.ndarray:
    """Dense names of the rows of ``pairs`` (two columns), equal rows alike."""
    order = np.lexsort((pairs[1], pairs[0]))
    a, b = pairs[0][order], pairs[1][order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def word_runs(words: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Runs of the words (any equal-or-not codes) of several texts, one after the
    other: rows (first word, word after the last, period), sorted."""
    found = [np.zeros((0, 3), np.int64)]
    at = np.arange(len(words))  # places whose factor occurs elsewhere in its text
    name = names_of(np.stack([text, words.view(np.int64)])) if len(words) else at
    size = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        gap = np.zeros(len(at), np.int64)  # to the successor, 0 if there is none
        gap[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
        close = np.flatnonzero((gap > 0) & (gap <= size))
        first = np.ones(len(close), bool)
        first[1:] = (gap[close[1:]] != gap[close[:-1]]) | (at[close[1:]] != at[close[:-1]] + 1)
        starts = np.flatnonzero(first)
        last = np.append(starts[1:], len(close))[:len(starts)] - 1
        period = gap[close[starts]]
        begin, end = at[close[starts]], at[close[last]] + period + size
        often = end - begin >= np.maximum(min_length, min_exponent * period)
        found.append(np.stack([begin, end, period], 1)[often])
        # factors of twice the length from pairs of factors that occur more than once
        repeated = np.zeros(len(at), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        at, name = at[repeated], name[repeated]
        right = np.searchsorted(at, at + size)
        pair = np.flatnonzero(right < len(at))
        pair = pair[(at[right[pair]] == at[pair] + size)]
        pair = pair[text[at[pair]] == text[at[right[pair]]]]
        name = names_of(np.stack([name[pair], name[right[pair]]]))
        at = at[pair]
        size *= 2
    return np.unique(np.concatenate(found), axis=0)


def dropped_words(runs: np.ndarray, size: int) -> np.ndarray:
    """Words that some run holds after its first period."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def periodic_runs(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period; words from 0) and collapsed
    text of every row.

    A run is a stretch of words with smallest period p and at least
    max(``min_length``, ``min_exponent`` * p) words that no neighbour continues;
    ``min_exponent`` is 3 at least, so that the naming finds every one.  The
    collapsed text keeps a run's first period, words joined by one space.  Null
    and blank texts have no words, no runs and an empty collapsed text; null ids
    and repeated rows pass through one by one.  Further columns are not read.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not searched")

    def run(batches):
        import pyarrow as pa

        splitter = Splitter(ASCII_SPACE, lower=False)
        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 1):
                words = splitter.split(offsets, data)
                bounds = np.searchsorted(words.text, np.arange(part.num_rows + 1))
                runs = word_runs(words.hash, words.text, min_length, min_exponent)
                of = np.searchsorted(runs[:, 0], bounds)
                gone = dropped_words(runs, len(words.text))
                texts = []
                for i in range(part.num_rows):
                    said = data[offsets[i]:offsets[i + 1]].tobytes().split()
                    if of[i] < of[i + 1]:
                        said = [w for w, g in zip(said, gone[bounds[i]:bounds[i + 1]].tolist(), strict=True) if not g]
                    texts.append(b" ".join(said))
                start = runs[:, 0] - bounds[words.text[runs[:, 0]]] if len(runs) else runs[:, 0]
                cells = pa.StructArray.from_arrays([pa.array(start), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                                   ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(of, pa.int32()), cells),
                     pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, SCHEMA)


def planted_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The registered query's texts: where h = crc32(id as text) is divisible by
    10, words from a on repeat with period p (g = floor(h / 10), a = g % n, p = 1
    + floor((n - a) / (3 + g % 8))); other texts and rows without id stay."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))))

    # the word list is bound once, as the only element of an array
    words = F.array(F.filter(F.split(F.col(text_col), SPACES), lambda w: w != ""))
    text = F.when((h % 10 == 0) & F.col(text_col).isNotNull(), F.transform(
        words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]).otherwise(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def run_report(runs: DataFrame) -> DataFrame:
    """Digests of ``periodic_runs`` rows: number of runs, the run of the greatest
    exponent (ties: smallest start, then period) and checksums."""
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda b, x: F.when(
        x["length"].cast("decimal(19,0)") * b["period"] > b["length"].cast("decimal(19,0)") * x["period"], x).otherwise(b))
    lines = F.concat_ws("", F.transform("runs", lambda x: F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"),
                                                                      F.concat(x["period"].cast("string"), F.lit("\n")))))
    out = runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_b"), F.sha2(lines, 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "_b.start", "_b.length", "_b.period",
                      F.expr("(1000 * _b.length) div _b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
