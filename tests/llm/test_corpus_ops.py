"""op11, op12, op13: runs, language model and collocations against brute force."""
from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from closequarters.llm import hash_store, ngram_lm, phrase_stripes, tokens
from closequarters.llm import periodic_runs as pr

SPACE = r"[^ \t\n\x0b\x0c\r]+"


# ---- words -----------------------------------------------------------------------------------------------------


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["Ab  cd\tab", None, "", " ", "ab", "x" * 200 + " AB", "cd", "\x0bcd\n", "é É x", "ab."] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(["zz zz", *texts], pa.string())], ["text"]).slice(1)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    got, base = [], 0
    for part, offsets, data in tokens.byte_blocks(batch, 0, 64):
        found = tokens.Splitter().split(offsets, data)
        got += [(base + t, h) for t, h in zip(found.text.tolist(), found.hash.tolist(), strict=True)]
        base += part.num_rows
    assert base == len(texts) and [t for t, _ in got] == [t for t, _ in want]
    by_word = dict(zip((w for _, w in want), (h for _, h in got), strict=True))
    assert [by_word[w] for _, w in want] == [h for _, h in got]
    assert len(set(by_word.values())) == len(by_word) and min(by_word.values()) > 1


# ---- op11 ------------------------------------------------------------------------------------------------------


def brute_runs(w, least=6, times=4):
    n, out = len(w), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p) and not any(
                    all(w[x] == w[x + d] for x in range(i, j + p - d)) for d in range(1, p)):
                out.append((i, j + p - i, p))
            i = j + 1 if j == i else j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text):
    w = re.findall(SPACE, text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {x for s, length, p in runs for x in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


REPORT = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_search_matches_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
            w = [rng.randint(0, letters) for _ in range(n)]
            if rng.random() < 0.6 and n:
                p, s = rng.randint(1, 12), rng.randint(0, n - 1)
                for i in range(s + p, rng.randint(s, n)):
                    w[i] = w[i - p]
            texts.append(w)
        flat, text = np.array(sum(texts, []), np.uint64), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = [tuple(r) for r in pr.word_runs(flat, text).tolist()]
        bases = np.cumsum([0, *map(len, texts)]).tolist()
        assert got == sorted((b + s, b + s + n, p) for b, w in zip(bases, texts, strict=False) for s, n, p in brute_runs(w))


def test_periodic_runs_match_brute_force(docs, rows):
    rng = random.Random(2)
    items = [(None, "a b " * 9), (None, None), (0, None), (1, ""), (2, " \t\n"), (3, "word " * 20_000), (4, "a b c d e f g h " * 500),
             (4, "x"), (4, "x"), (5, "Ab ab " * 8), (6, "é é é é é é")]
    for i in range(10, 400):
        w = [rng.choice("abcd") for _ in range(rng.randint(0, 80))]
        items.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    out = pr.run_report(pr.periodic_runs(pr.planted_repeats(docs(items))))
    assert sorted(rows(out, *REPORT), key=str) == sorted((brute_report(i, t) for i, t, *_ in items), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in items if i is not None) > 10


def test_periodic_runs_keep_spans_and_text(docs, rows):
    out = pr.periodic_runs(docs([(1, "so  go on go on go on go on go end"), (2, None)]), min_exponent=3)
    got = {r["doc_id"]: r for r in out.collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 9, 2)] and got[1]["collapsed"] == "so go on end"
    assert (got[2]["n_words"], got[2]["runs"], got[2]["collapsed"]) == (0, [], "")
    assert pr.periodic_runs(docs([]).limit(0)).count() == 0
    with pytest.raises(ValueError, match="three"):
        pr.periodic_runs(docs([]), min_exponent=2)


def test_run_report_of_the_given_documents(spark, rows):
    from closequarters.llm.queries import queries

    d = "/root/testdata/sf0.001"
    out = rows(queries()["op11_factor_runs"](spark, d), *REPORT)
    texts = rows(spark.read.parquet(f"{d}/documents.parquet"), "doc_id", "text")
    short = {i for i, t in texts if len(t or "") < 6000}  # the brute force is quadratic
    assert len(out) == len(texts) and len(short) > len(texts) / 2
    assert sorted(r for r in out if r[0] in short) == sorted(brute_report(i, t) for i, t in texts if i in short)


# ---- op12 ------------------------------------------------------------------------------------------------------


class BruteModel:
    """Modified Kneser-Ney with dictionaries over whole words."""

    def __init__(self, texts, order):
        self.order, self.n = order, [None] * (order + 1)
        raw = Counter()
        for w in texts:
            seq = ["<"] * (order - 1) + w + [">"]
            raw.update(tuple(seq[i - order + 1:i + 1]) for i in range(order - 1, len(seq)))
        self.n[order] = dict(raw)
        for k in range(order - 1, 0, -1):
            shorter, kinds = Counter(), Counter()
            for g, c in raw.items():
                shorter[g[1:]] += c
                kinds[g[1:]] += 1
            self.n[k] = {g: shorter[g] if g[0] == "<" and k > 1 else kinds[g] for g in shorter}
            raw = shorter
        self.raw = {g[0]: c for g, c in raw.items()}
        self.d, self.past = [None] * (order + 1), [None] * (order + 1)
        for k in range(1, order + 1):
            counts = Counter(self.n[k].values())
            d = ngram_lm.discounts_of(*(counts[c] for c in (1, 2, 3, 4)))
            self.d[k] = lambda c, d=d: 0.0 if c == 0 else d[min(c, 3) - 1]
            self.past[k] = defaultdict(lambda: [0, 0.0])
            for g, c in self.n[k].items():
                self.past[k][g[:-1]][0] += c
                self.past[k][g[:-1]][1] += self.d[k](c)
        self.tokens, self.types = sum(self.raw.values()), len(self.raw)

    def p(self, gram):
        p = 1 / (self.types + 1)
        for k in range(1, self.order + 1):
            g = gram[-k:]
            if g[:-1] in self.past[k]:
                total, mass = self.past[k][g[:-1]]
                c = self.n[k].get(g, 0)
                p = (c - self.d[k](c)) / total + mass / total * p
        return p

    def score(self, w):
        seq = ["<"] * (self.order - 1) + w + [">"]
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(seq)))

    def base(self, w):
        return sum(math.log10((self.raw.get(x, 0) + 0.5) / (self.tokens + 0.5 * (self.types + 1))) for x in [*w, ">"])


def lowered(text):
    return re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        w = [words[min(int(rng.expovariate(0.08)), 59)] for _ in range(rng.randint(0, 40))]
        out.append((i, " ".join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return [*out, *out[:5], (None, "w1 w2 w3"), (n, None), (n + 1, ""), (n + 2, "unseen words only"), (n + 3, "w1 " * 3000)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_matches_brute_force(docs, rows, order):
    items = corpus(order, 200)
    held = {i for i, _ in items if i is not None and zlib.crc32(str(i).encode()) % 5 == 1}
    model = BruteModel([lowered(t) for i, t in items if i not in held], order)
    out = rows(ngram_lm.language_model_scores(docs(items), order=order), "doc_id", "held_out", "n_tokens", "n_known",
               "train_tokens", "base_score", "score")
    want = []
    for i, t in items:
        w = lowered(t)
        want.append((i, i in held, len(w) + 1, sum(x in model.raw for x in [*w, ">"]), model.tokens, model.base(w), model.score(w)))
    assert held and len(out) == len(want)
    for a, b in zip(sorted(out, key=str), sorted(want, key=str), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_of_a_history_sum_to_one(docs):
    items = corpus(7, 60)
    texts = docs(items).select("text")
    model = ngram_lm.train_model(texts, 2)
    brute = BruteModel([lowered(t) for _, t in items], 2)
    splitter = tokens.Splitter()
    said = " ".join(w for w in brute.raw if w != ">").encode()
    known = splitter.split(np.array([0, len(said)]), np.frombuffer(said, np.uint8)).hash
    every = np.concatenate([known, [ngram_lm.END, np.uint64(12345)]])  # and one unknown word
    for past in (known[0], known[3], ngram_lm.BEGIN, np.uint64(99)):
        seq = np.stack([np.full(len(every), past), every], 1).ravel()
        log_p, _ = model.token_scores(seq, np.arange(1, len(seq), 2))
        assert (10 ** log_p).sum() == pytest.approx(1)


def test_language_model_without_training_rows(docs, rows):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    out = ngram_lm.language_model_scores(docs([(held, "a b"), (held, None)]))
    assert sorted(rows(out, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) == [
        (True, 1, 0, 0, 0.0, 0.0), (True, 3, 0, 0, 0.0, 0.0)]
    assert ngram_lm.language_model_scores(docs([]).limit(0)).count() == 0


def test_counting_tasks_send_what_they_hold_too_many(docs, rows):
    texts = docs(corpus(3, 50)).select("text").coalesce(1)
    for flush in (10, 10**6):
        packed = ngram_lm.count_grams(texts, 2, 4, flush).collect()
        total = sum(sum(r["nums"]) for r in packed)
        assert total == sum(len(lowered(t)) + 1 for _, t in corpus(3, 50))


def test_model_beats_unigrams_on_held_out_documents(spark):
    from closequarters.llm.queries import queries

    out = queries()["op12_mapped_lm"](spark, "/root/testdata/sf0.001").filter("held_out").selectExpr(
        "sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b").first()
    assert out["s"] > out["b"]


def test_stores_live_in_the_shared_folder(spark):
    from pyspark.sql import functions as F

    from closequarters.session import shared_base

    rows = spark.range(5000).select(F.xxhash64("id").alias("key"), F.col("id").alias("f"))
    store = hash_store.write_store(rows, "test-store")
    assert os.path.realpath(store.folder).startswith(os.path.realpath(shared_base(spark).removeprefix("file:")))
    got = rows.collect()
    keys = np.array([r["key"] for r in got] + [1, 2, 3], np.int64).view(np.uint64)
    assert store.find(keys, "f")[0].tolist() == [float(r["f"]) for r in got] + [0.0] * 3
    assert isinstance(hash_store.open_shard(store.folder, min(store.filled), ("key",))[0], np.memmap)
    assert hash_store.write_store(rows.limit(0), "test-empty").find(keys, "f")[0].sum() == 0


# ---- op13 ------------------------------------------------------------------------------------------------------


def brute_collocations(items, least, longest=5, top=2000):
    counts, size = defaultdict(Counter), Counter()
    for text, lang in items:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            size[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q[i:i + k] for q in often for k in range(2, len(q)) for i in range(len(q) - k + 1) if f[q] >= f[q[i:i + k]]}
        scored = []
        for p in often - gone:
            score, cut = min((1000 * f[p] * size[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, size[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrases(seed, n):
    rng = random.Random(seed)
    fixed = ["New York City", "kick the bucket now", "of the", "a b a b a", "o o o o", "é à", "x" * 80 + " long"]
    out = []
    for _ in range(n):
        said = []
        for _ in range(rng.randint(0, 30)):
            said.append(rng.choice(fixed) if rng.random() < 0.4 else rng.choice("the of a b c d e".split()))
            if rng.random() < 0.2:
                said.append(rng.choice([".", ",", "\n", ";", "!"]))
        out.append((rng.choice([" ", "  ", "\t"]).join(said), rng.choice(["en", "en", "fr", None])))
    return [*out, (None, "en"), ("", None), (" \t", "de"), ("only de", "de")]


@pytest.fixture
def texts(spark):
    def make(items):
        items = [(i, t, x, "clash", 1, "clash", 2) for i, (t, x) in enumerate(items)]
        return spark.createDataFrame(items, "doc_id long, text string, lang string, phrase string, n long, key string, f int")

    return make


@pytest.mark.parametrize("top", [2000, 7])
def test_collocations_match_brute_force(texts, rows, top):
    items = phrases(1, 300)
    out = phrase_stripes.collocations(texts(items).repartition(5), min_count=20, top=top)
    want = brute_collocations(items, 20, top=top)
    assert len(want) >= 14 and sorted(rows(out, *COLUMNS)) == want


def test_split_and_flushed_stripes_add_up(spark, texts, rows):
    items = phrases(2, 200)
    df = texts(items).repartition(3)
    sizes, levels, _ = phrase_stripes.frequent_phrases(df, min_count=10, max_words=2)
    known = hash_store.write_store(levels[0].select("key", "f"), "test-words")
    plain = df.select("text", "lang")

    def sums(**how):
        merged = phrase_stripes.merged_stripes(phrase_stripes.prefix_stripes(plain, 2, known, 8, **how), 8, 10)
        total, more = Counter(), Counter()
        for r in merged.collect():
            total[r["prefix"]] += r["total"]
            more.update({(r["prefix"], x): n for x, n in zip(r["next"], r["n"], strict=True)})
        return total, more

    want = sums()
    assert want == sums(stripe=16) == sums(flush=5) and len(want[1]) > 10
    # a stripe's sum is its prefix's count
    assert want[0] == {r["key"]: r["f"] for r in levels[0].collect()}
    assert sum(r["n"] for r in sizes.collect()) == sum(len(re.findall(r"[^ \t.,;:!?\n]+", t or "")) for t, _ in items)


def test_collocations_of_odd_tables(texts, rows):
    assert phrase_stripes.collocations(texts([]).limit(0)).count() == 0
    assert phrase_stripes.collocations(texts([(None, None), ("", "en")])).count() == 0
    out = phrase_stripes.collocations(texts([("to be " * 5000, None)] * 2), min_count=100)
    assert sorted(rows(out, *COLUMNS)) == brute_collocations([("to be " * 5000, None)] * 2, 100)
