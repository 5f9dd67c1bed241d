"""Collocations by stripes: every prefix keys an associative next-word counter.

Level k counts the phrases of k words.  A task walks its texts and keeps, for
every frequent prefix of k - 1 words, a stripe: how often each next word follows
it.  Next words that cannot make a frequent phrase (their own k - 1 last words
are not frequent) or that do not exist (the piece ends) share the entry OTHER, so
a stripe's sum is its prefix's count.  Stripes of one prefix are merged element
by element after the shuffle; a prefix with many occurrences is dealt over
several stripes by its next words, so no stripe is unbounded.  The first level's
prefix is empty: its stripes count the words of a language.

A merged stripe gives everything of its prefix: the extensions (entries of
``min_count`` or more), the prefix total (its sum) and the largest extension,
which tells whether a longer phrase subsumes the prefix.

Frequent phrases of one level filter the next: workers map their keys as sorted
hash arrays from the shared folder.  Words are 64-bit hashes salted with the
language; a phrase is known by its prefix's key and its last word.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_batches
from .hash_store import HashArrays, shard_count, shard_of, write_store
from .tokens import Splitter, byte_blocks, chain, mix

SPACES = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
NO_LANG = "und"
OTHER = np.uint64(0)
STRIPE = 1 << 20  # occurrences of a prefix per stripe
FLUSH = 1 << 20  # entries that a counting task holds at most


def language_words(part, found) -> np.ndarray:
    """Word hashes salted with the text's language (column 1 of ``part``)."""
    import xxhash

    langs = part.column(1).to_pylist()
    salt = {x: xxhash.xxh3_64_intdigest((x or NO_LANG).encode()) for x in set(langs)}
    return np.maximum(mix(found.hash ^ np.array([salt[x] for x in langs], np.uint64)[found.text]), np.uint64(1))


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of one entry per distinct key, in key order, and the sums of n."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    return order[starts], np.add.reduceat(n[order], starts) if len(n) else n


def word_stripes(texts: DataFrame, shards: int, flush: int = FLUSH) -> DataFrame:
    """Stripes of the empty prefix, combined per task: lang, shard of the words,
    key, word and count of each."""
    def run(batches):
        import pyarrow as pa

        splitter = Splitter(SPACES, BREAKS)
        parts, held = [], 0

        def fold():
            lang, key, n, word = (np.concatenate(c) for c in zip(*parts, strict=True))
            one, n = summed(key, n)
            parts[:] = [(lang[one], key[one], n, word[one])]
            return parts[0]

        def stripes():
            lang, key, n, word = fold()
            parts.clear()
            shard = (key >> np.uint64(32)) % np.uint64(shards)
            _, code = np.unique(lang.astype(str), return_inverse=True)
            order = np.lexsort((shard, code))
            changed = (np.diff(code[order]) != 0) | (np.diff(shard[order].astype(np.int64)) != 0)
            at = np.concatenate([[0], np.flatnonzero(changed) + 1, [len(order)]])

            def lists(values):
                return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)

            first = order[at[:-1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(lang[first].tolist(), pa.string()), pa.array(shard[first].astype(np.int32)),
                 lists(pa.array(key[order].view(np.int64))), lists(pa.array(n[order])),
                 lists(pa.array(word[order].tolist(), pa.binary()).cast(pa.string()))], ["lang", "shard", "key", "n", "word"])

        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 0):
                found = splitter.split(offsets, data)
                if not len(found.hash):
                    continue
                key = language_words(part, found)
                one, n = summed(key, np.ones(len(key), np.int64))
                langs = np.array([x or NO_LANG for x in part.column(1).to_pylist()], object)
                word = np.empty(len(one), object)
                word[:] = [splitter.word(data, a, b) for a, b in zip(found.start[one].tolist(), found.end[one].tolist(), strict=True)]
                parts.append((langs[found.text[one]], key[one], n, word))
                held += len(one)
                if held > flush:
                    held = len(fold()[1])
                    if held > flush // 2:
                        yield stripes()
                        held = 0
        if parts:
            yield stripes()

    return map_batches(texts, run, "lang string, shard int, key array<long>, n array<long>, word array<string>")


def merged_words(stripes: DataFrame, shards: int, min_count: int) -> DataFrame:
    """lang, key, phrase, f of the frequent words, and per stripe one row without
    key whose f is the stripe's sum."""
    dealt = stripes.repartitionById(shards, F.col("shard")).sortWithinPartitions("lang")

    def run(batches):
        import pyarrow as pa

        held, at = [], None

        def done():
            key, n, word = (np.concatenate(c) for c in zip(*held, strict=True))
            one, n = summed(key, n)
            often = n >= min_count
            keys = [*key[one][often].view(np.int64).tolist(), None]
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(keys), pa.string()), pa.array(keys, pa.int64()),
                 pa.array([*word[one][often].tolist(), None], pa.string()),
                 pa.array([*n[often].tolist(), int(n.sum())], pa.int64())], ["lang", "key", "phrase", "f"])

        for batch in batches:
            for r, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if held and group != at:
                    yield done()
                    held = []
                at = group
                word = np.empty(len(batch.column(4)[r].values), object)
                word[:] = batch.column(4)[r].values.to_pylist()
                held.append((batch.column(2)[r].values.to_numpy().view(np.uint64), batch.column(3)[r].values.to_numpy(), word))
                if sum(len(h[0]) for h in held) > 2 * FLUSH and len(held) > 1:
                    key, n, word = (np.concatenate(c) for c in zip(*held, strict=True))
                    one, n = summed(key, n)
                    held = [(key[one], n, word[one])]
        if held:
            yield done()

    return map_batches(dealt, run, "lang string, key long, phrase string, f long")


def prefix_stripes(texts: DataFrame, k: int, frequent: HashArrays, shards: int, flush: int = FLUSH,
                   stripe: int = STRIPE) -> DataFrame:
    """Stripes of the frequent prefixes of k - 1 words, combined per task and
    packed by shard: keys of the prefixes, next words and counts, entry by entry.
    A prefix of more than ``stripe`` occurrences has several stripes, each with a
    part of the next words, on shards of their own."""
    def run(batches):
        import pyarrow as pa

        splitter = Splitter(SPACES, BREAKS)
        parts, held = [], 0

        def fold():
            prefix, shard, word, n = (np.concatenate(c) for c in zip(*parts, strict=True))
            one, n = summed(chain(prefix, word), n)
            parts[:] = [(prefix[one], shard[one], word[one], n)]
            return parts[0]

        def packed():
            prefix, shard, word, n = fold()
            parts.clear()
            order = np.lexsort((prefix, shard))
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            some = np.flatnonzero(np.diff(ends))
            at = pa.array(np.append(ends[some], len(order)), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *(pa.ListArray.from_arrays(at, pa.array(c[order].view(np.int64)))
                                               for c in (prefix, word, n))], ["shard", "prefix", "next", "n"])

        for batch in batches:
            for part, offsets, data in byte_blocks(batch, 0):
                found = splitter.split(offsets, data)
                size = len(found.hash) - k + 2  # places where a prefix of k - 1 words may start
                if size <= 0:
                    continue
                word = language_words(part, found)
                key = word[:size]
                for i in range(1, k - 1):
                    key = chain(key, word[i:size + i])
                at = np.flatnonzero(found.piece[:size] == found.piece[k - 2:size + k - 2])
                f = np.zeros(size)
                f[at] = frequent.find(key[at], "f")[0]
                at = np.flatnonzero(f)
                if not len(at):
                    continue
                # what follows counts by name if the last k - 1 words are frequent too, in the same piece
                named = np.zeros(len(at), bool)
                inner = at < size - 1
                named[inner] = (f[at[inner] + 1] > 0) & (found.piece[at[inner]] == found.piece[at[inner] + k - 1])
                word = np.where(named, word[np.minimum(at + k - 1, len(word) - 1)], OTHER)
                one, n = summed(chain(key[at], word), np.ones(len(at), np.int64))
                at, word = at[one], word[one]
                number = mix(word) % (1 + (f[at] // stripe).astype(np.uint64))
                parts.append((key[at], shard_of(mix(key[at] + number), shards), word, n))
                held += len(one)
                if held > flush:
                    held = len(fold()[0])
                    if held > flush // 2:
                        yield packed()
                        held = 0
        if parts:
            yield packed()

    return map_batches(texts, run, "shard int, prefix array<long>, next array<long>, n array<long>")


def merged_stripes(stripes: DataFrame, shards: int, min_count: int) -> DataFrame:
    """Stripes merged element by element: prefix, total (sum of the stripe), next,
    key and n of the extensions that occur ``min_count`` times or more."""
    def run(batches):
        import pyarrow as pa

        def merge():
            prefix, word, n = (np.concatenate(c) for c in zip(*held, strict=True))
            one, n = summed(chain(prefix, word), n)
            return prefix[one], word[one], n

        held, rows = [], 0
        for batch in batches:
            held.append(tuple(batch.column(c).flatten().to_numpy().view(kind) for c, kind in (
                ("prefix", np.uint64), ("next", np.uint64), ("n", np.int64))))
            rows += len(held[-1][0])
            if rows > 2 * FLUSH and len(held) > 1:
                held = [merge()]
                rows = len(held[0][0])
        if not rows:
            return
        prefix, word, n = merge()
        order = np.argsort(prefix, kind="stable")
        prefix, word, n = prefix[order], word[order], n[order]
        first = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        often = (n >= min_count) & (word != OTHER)
        at = pa.array(np.append(0, np.cumsum(np.add.reduceat(often.astype(np.int64), first))), pa.int32())
        key = chain(prefix, word)
        yield pa.RecordBatch.from_arrays(
            [pa.array(prefix[first].view(np.int64)), pa.array(np.add.reduceat(n, first)),
             *(pa.ListArray.from_arrays(at, pa.array(c[often])) for c in (word.view(np.int64), key.view(np.int64), n))],
            ["prefix", "total", "next", "key", "n"])

    return map_batches(stripes.repartitionById(shards, F.col("shard")).select("prefix", "next", "n"), run,
                       "prefix long, total long, next array<long>, key array<long>, n array<long>")


def frequent_phrases(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Words per language (lang, n), the frequent phrases of every length (lang,
    key, phrase, words, keys, f; ``keys``: of its first 1, 2, ... words) and the
    stripes of every prefix length from 1."""
    shards = shard_count(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counted = cut(merged_words(word_stripes(texts, shards), shards, min_count), "op13-words")
    sizes = counted.filter("key is null").groupBy("lang").agg(F.sum("f").alias("n"))
    words = counted.filter("key is not null").select("lang", "key", "phrase", F.array("key").alias("words"),
                                                     F.array("key").alias("keys"), "f")
    levels, stripes = [words], []
    for k in range(2, max_words + 1):
        known = write_store(levels[-1].select("key", "f"), f"op13-keys{k - 1}")
        merged = cut(merged_stripes(prefix_stripes(texts, k, known, shards), shards, min_count), f"op13-stripes{k}")
        grown = (merged.select("prefix", F.explode(F.arrays_zip("next", "key", "n")).alias("_x"))
                 .select("prefix", F.col("_x.next").alias("next"), F.col("_x.key").alias("_key"), F.col("_x.n").alias("_f")))
        last = words.select(F.col("key").alias("next"), F.col("phrase").alias("_word"))
        phrases = (grown.join(levels[-1], F.col("prefix") == F.col("key")).join(last, "next")
                   .select("lang", F.col("_key").alias("key"), F.concat_ws(" ", "phrase", "_word").alias("phrase"),
                           F.concat("words", F.array("next")).alias("words"), F.concat("keys", F.array("_key")).alias("keys"),
                           F.col("_f").alias("f")))
        levels.append(cut(phrases, f"op13-phrases{k}"))
        stripes.append(merged)
    return sizes, levels, stripes


def collocations(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int | None = TOP,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of 2 to ``max_words``
    words that occur ``min_count`` times or more, no longer phrase as often, the
    first ``top`` of every language (None: all).

    ``a``, ``l`` and ``r`` are the counts of the phrase and of the two parts of
    its lowest-scoring cut, ``n`` all words of the language, ``score`` floor(1000
    a n / (l r)), exact.  Null texts are empty, a null language is ``und``;
    repeated rows count as often as they occur.  Further columns are not read.
    """
    sizes, levels, stripes = frequent_phrases(docs, min_count=min_count, max_words=max_words, text_col=text_col,
                                              lang_col=lang_col)
    sums = stripes[0]
    phrases = levels[1]
    for more in stripes[1:]:
        sums = sums.unionByName(more)
    for more in levels[2:]:
        phrases = phrases.unionByName(more)
    totals = sums.groupBy("prefix").agg(F.sum("total").alias("l"), F.max(F.array_max("n")).alias("_right"))
    right = totals.select(F.col("prefix").alias("key"), "_right")
    left = (phrases.filter(F.size("words") > 2)
            .groupBy(F.expr("slice(words, 2, size(words) - 1)").alias("words")).agg(F.max("f").alias("_left")))
    longest = F.greatest(F.coalesce("_right", F.lit(0)), F.coalesce("_left", F.lit(0)))
    kept = (phrases.join(right, "key", "left").join(left, "words", "left").filter(longest < F.col("f"))
            .select("lang", "key", "phrase", "words", "keys", "f"))
    cuts = kept.select("lang", "key", "phrase", F.col("f").alias("a"), F.explode(F.expr(
        "transform(sequence(1, size(words) - 1), k -> struct(k as cut, keys[k - 1] as first, "
        "slice(words, k + 1, size(words) - k) as rest))")).alias("_c")).select("lang", "key", "phrase", "a", "_c.*")
    tails = phrases.unionByName(levels[0]).select(F.col("words").alias("rest"), F.col("f").alias("r"))
    scored = (cuts.join(totals.select(F.col("prefix").alias("first"), "l"), "first").join(tails, "rest").join(sizes, "lang")
              .withColumns({f"_{c}": F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r", "n")})
              .withColumn("score", F.expr("(cast(1000 as decimal(38,0)) * _a * _n) div (_l * _r)")))
    # a phrase's lowest-scoring cut, ties to the first
    best = (scored.groupBy("lang", "key", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_b"))
            .select("lang", "phrase", "a", "_b.l", "_b.r", "n", "_b.score"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = best.withColumn("rank", place.cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
