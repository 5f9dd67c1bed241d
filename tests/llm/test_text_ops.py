"""op2, op5, op6, op7, op9, op10: round trips, brute force and held-out accuracy."""
from __future__ import annotations

import hashlib
import pickle
import random
import re
import textwrap
import zlib
from collections import Counter
from itertools import pairwise
from sys import getsizeof

import numpy as np
import pytest
from pyspark import SparkContext

from closequarters.llm import chat_prefix as cp
from closequarters.llm import kneser_ney as kn
from closequarters.llm import nnls_pack as pack
from closequarters.llm import queries
from closequarters.llm import template_join as tj
from closequarters.llm import word_pairs as wp
from closequarters.llm.code_table import CodeTable
from closequarters.llm.common import text_slices
from closequarters.llm.heap_bpe import Generations, HeapBpe, bpe_decode, bpe_encode, bpe_round_trip
from closequarters.llm.pairwise_quality import quality_scores
from closequarters.llm.queries import tokenizer_file

TEXTS = ["", None, " ", "  two  spaces ", "plain words here", "I'll they've 'tis 123 45a", "tab\tand\nlines\n\n  x",
         "Éa é ß Σ ΑΣ İ J̌ é", "日本語 テキスト", "a b c\u0085d", "x\x1cy\x00z", "!!??--__..", "<|endoftext|>",
         "a <|endoftext|>b<|startoftext|> c", "emoji 👩‍👩‍👧 ok", "word " * 3000, "a" * 20_000, "ab" * 5000, "\n\n\n", "don't stop",
         "The cat SAT. on, the (mat)", "naïve café—dash", " lead", "trail "]


def library(name):
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_file(name))


def random_texts(n=300, seed=11):
    rng = random.Random(seed)
    alphabet = "abcdeEZ  \n\t'’.,!0189éÉßñ́ ​日Σ<|>_-"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


# ---- op10 ------------------------------------------------------------------------------------------------------


def test_heap_bpe_equals_the_library():
    path = tokenizer_file("byte_bpe_50k.json")
    lib, own = library("byte_bpe_50k.json"), HeapBpe(path, memory_words=50)
    for text in [t or "" for t in TEXTS] + random_texts():
        ids = lib.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, repr(text)
        assert own.decode(got) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip_rows(docs, rows):
    path, lib = tokenizer_file("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    items = [*enumerate(TEXTS), (None, "null id"), (0, "again")]
    want = []
    for i, t in items:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    out = bpe_round_trip(docs(items), path)
    assert sorted(rows(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), key=str) == sorted(want, key=str)
    back = bpe_decode(bpe_encode(docs(items[:-2]), path), path)
    assert dict(rows(back, "doc_id", "text")) == {i: t or "" for i, t in items[:-2]}
    assert bpe_round_trip(docs([]).limit(0), path).count() == 0


# ---- op9 -------------------------------------------------------------------------------------------------------


def test_word_memory_is_bounded_in_bytes():
    long = Generations(lambda w: w.encode())
    assert all(long[f"{i:06}" * 16_667] == f"{i:06}".encode() * 16_667 for i in range(300))
    assert not long and not long.old
    asked = []
    short = Generations(lambda w: (asked.append(w), w.encode() * 4)[1], most_bytes=50_000)
    for i in range(10_000):
        word = f"{i % 3_000:060}"
        assert short[word] == word.encode() * 4
        assert max(sum(getsizeof(k) + getsizeof(v) for k, v in held.items()) for held in (short, short.old)) < 51_000
        assert short[f"{0:060}"] == b"0" * 240
    assert asked.count(f"{0:060}") == 1  # what is in use stays


def test_chunk_tokenizer_equals_the_library():
    lib, own = library("word_bpe_49k.json"), pack.ChunkTokenizer(tokenizer_file("word_bpe_49k.json"))
    for text in [t or "" for t in TEXTS] + random_texts(seed=12):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_chunk_tokenizer_takes_a_slice_and_each_distinct_chunk_once():
    import pyarrow as pa

    lib, own = library("word_bpe_49k.json"), pack.ChunkTokenizer(tokenizer_file("word_bpe_49k.json"))
    texts = [*TEXTS, *random_texts(seed=14)] * 3
    seen, made, latin, word = [], [], own._latin, own.words.make
    own._latin = lambda chunks: (seen.append(chunks), latin(chunks))[1]
    own.words.make = lambda w: (made.append(w), word(w))[1]
    column = pa.array(["left out", *texts, "left out"], pa.string()).slice(1, len(texts))
    for _ in range(2):
        at, data = own.encode_texts(column)
        got = [np.frombuffer(data[a:b], "<u4").tolist() for a, b in pairwise(at.tolist())]
        assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(seen) == 2 and all(len(set(chunks)) == len(chunks) for chunks in seen)
    short = [w for w in made if len(w) <= 128]
    assert len(set(short)) == len(short)  # remembered from slice to slice
    for few in ([], [""], [None, ""], ["\n"], ["日本"], [" "]):
        at, data = own.encode_texts(pa.array(few, pa.string()))
        assert len(at) == len(few) + 1 and data.tobytes() == own.encode("日本") * ("日本" in few)


def test_control_strings_heed_case():
    lib, own = library("word_bpe_49k.json"), pack.ChunkTokenizer(tokenizer_file("word_bpe_49k.json"))
    for text in ("<|ENDOFTEXT|>", "A <|EndOfText|> B <|endoftext|>", "É <|ENDOFTEXT|>", "<|STARTOFTEXT|><|startoftext|>"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_pieces_of_several_slices(docs, rows):
    lib, items, want = library("word_bpe_49k.json"), [], []
    for i in range(10):
        unit, n = f"Word{i} été, 日本 ", 60_000 + i
        ids = np.array([*lib.encode(unit, add_special_tokens=False).ids * n, 1], "<u4")
        items.append((i, unit * n))
        want += [(i, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
    assert sum(len(t.encode()) for _, t in items) > pack.SLICE
    out = pack.tokenised_pieces(docs(items).coalesce(1), tokenizer_file("word_bpe_49k.json"))
    assert sorted(rows(out, "doc_id", "start", "length", "ids_crc32", "doc_tokens")) == want


def test_packing_places_every_id_once(docs, rows):
    lib = library("word_bpe_49k.json")
    items = [*enumerate(TEXTS), (None, "null id"), (0, "again"), (1, "again"), (1, "again")]
    out = pack.pack_documents(docs(items), tokenizer_file("word_bpe_49k.json")).collect()
    pieces = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out
                    if r["doc_id"] is not None and r["doc_id"] > 1)
    want = []
    for i, t in items:
        if i is not None and i > 1:
            ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
            want += [(i, s, len(ids[s:s + 2048]), zlib.crc32(np.array(ids[s:s + 2048], "<u4").tobytes()), len(ids))
                     for s in range(0, len(ids), 2048)]
    assert pieces == sorted(want)
    assert sum(r["doc_id"] == 1 for r in out) == 3
    fill: dict[int, list] = {}
    for r in out:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack.pack_documents(docs([]).limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_pieces_without_ids_are_dealt_by_their_row(spark):
    pieces = spark.range(900).selectExpr("cast(null as long) doc_id", "0L start", "1 + id % 7 * 300 length", "id _row")
    out = pack.pack(pieces, bucket_rows=16, deal_by=("_row",)).collect()
    assert sorted(r["_row"] for r in out) == list(range(900))
    ends: dict[int, int] = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and sorted(ends) == list(range(len(ends)))


def test_packing_plan_uses_the_histogram_exactly_and_pads_little():
    rng = np.random.default_rng(13)
    for size in (0, 3, 500, 40_000):
        lengths = np.minimum(128, np.ceil(rng.lognormal(3.2, 0.9, size)).astype(int))
        histogram = dict(zip(*np.unique(lengths, return_counts=True), strict=True))
        used: dict[int, int] = {}
        plan = pack.packing_plan({int(k): int(v) for k, v in histogram.items()}, 128, 4)
        for parts, n in plan:
            assert sum(parts) <= 128
            for c in parts:
                used[c] = used.get(c, 0) + n
        assert used == histogram
        if size >= 500:
            sequences = sum(n for _, n in plan)
            assert lengths.sum() / (128 * sequences) > 0.97


def test_nnls_solves_small_systems():
    a = np.array([[1.0, 0, 1, 2], [0, 1, 1, 0], [0, 0, 1, 1]])
    x = np.array([2.0, 0, 3, 0])
    got = pack.nnls(a, a @ x)
    assert (got >= 0).all() and np.allclose(a @ got, a @ x)


# ---- op2 -------------------------------------------------------------------------------------------------------

NASTY = ["</s>", "<s>", "<\\/s>", "<\\\\s>", "[INST]", "[/INST] x", "[\\INST]", "a\nb", "", None, "\\", "<\\", "[[INST]]",
         "$1 \\1", "é日👩"]


def chat_rows(spark, items):
    return spark.createDataFrame([(*r, "x") for r in items], "conv_id long, turn long, role string, text string, pos string")


def test_escape_is_reversible_and_hides_controls(spark, rows):
    from pyspark.sql import functions as F

    texts = [t for t in NASTY if t] + ["".join(random.Random(i).choice(["<", "\\", "/", "s>", "[", "INST]", "x"])
                                                for _ in range(12)) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select("t", cp.escape(F.col("t")).alias("e"), cp.unescape(cp.escape(F.col("t"))).alias("u"))
    for t, e, u in rows(df, "t", "e", "u"):
        assert u == t and not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_conversations_read_back(spark, rows):
    rng = random.Random(14)
    items = [(c, t, rng.choice(["user", "assistant", "system", "assistant", None, "[INST]"]), rng.choice(NASTY))
             for c in [*range(12), None] for t in range(rng.randint(1, 9))]
    items += [(50, 1, "user", "tie b"), (50, 1, "assistant", "tie a"), (50, None, "user", "first"), (50, 1, "user", "tie b")]
    items += [(60, 5000 * t, "assistant", f"far {t}") for t in range(5)]
    turns = cp.format_turns(chat_rows(spark, items))
    got = rows(cp.conversation_digests(turns), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c in {r[0] for r in items}:
        own = sorted((r for r in items if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        want.append((c, len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)), len(loss), sha(loss)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_any_role_reads_back(spark, rows):
    rng = random.Random(15)
    roles = ["us\ner", "\n", "\\", "\\n", "\\\n", "\n\\", "<\\/s>\n", "assistant\n", "[INST]\\\n", "", None, "assistant"]
    roles += ["".join(rng.choice(["\n", "\\", "n", "<", "/s>", "[", "INST]"]) for _ in range(9)) for _ in range(200)]
    items = [(7, t, r, rng.choice(NASTY)) for t, r in enumerate(roles)]
    turns = cp.format_turns(chat_rows(spark, items))
    back = cp.read_back(turns, cp.prefix_target_examples(turns))
    assert sorted(rows(back, "pos", "role", "text")) == [(t, r or "", x or "") for _, t, r, x in items]


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    items = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </s>"), (1, 2, "user", "more"), (1, 3, "assistant", "end"),
             (2, 0, "user", "alone")]
    turns = cp.format_turns(chat_rows(spark, items))
    whole = "".join(r["segment"] for r in sorted((r for r in turns.collect() if r["conv_id"] == 1), key=lambda r: r["pos"]))
    examples = cp.prefix_target_examples(turns)
    spans = sorted((r["target_pos"], r["context_end"], whole[r["loss_start"]:r["loss_end"]]) for r in examples.collect())
    assert [(p, t) for p, _, t in spans] == [(1, "yo <\\/s>"), (3, "end")]
    full = {r["target_pos"]: r for r in cp.render_examples(turns, examples).collect()}
    for p, end, _ in spans:
        assert full[p]["context"] == whole[:end]
        assert whole.startswith(full[p]["context"] + full[p]["target"])
    assert cp.conversation_digests(cp.format_turns(chat_rows(spark, items).limit(0))).count() == 0


@pytest.mark.parametrize("broken", [{"context_end": -1}, {"context_end": 1}, {"loss_start": 1}, {"loss_end": -1},
                                    {"context_end": -1, "loss_start": -1, "loss_end": -1}])
def test_query_reads_its_rows_from_the_examples(spark, monkeypatch, broken):
    items = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </s>"), (1, 2, "user", "more"), (1, 3, "assistant", "end"),
             (1, 4, "user", "after"), (2, 0, "user", "alone"), (3, 0, "system", "s"), (3, 1, "assistant", "é日")]
    monkeypatch.setattr(queries, "read_table", lambda *_: chat_rows(spark, items))
    digests = lambda: {r["conv_id"]: r for r in queries.QUERIES["op2_chat_prefix"](spark, "").collect()}
    want, right = digests(), cp.prefix_target_examples
    assert want[1]["n_turns"] == 5 and want[1]["loss_chars"] == len("yo </s>end")
    monkeypatch.setattr(cp, "prefix_target_examples", lambda turns: right(turns).selectExpr(
        "conv_id", "target_pos", *(f"{c} + {broken.get(c, 0)} AS {c}" for c in ("context_end", "loss_start", "loss_end"))))
    got = digests()
    assert got[2] == want[2] and all(got[c] != want[c] for c in (1, 3, -7))


# ---- op7 -------------------------------------------------------------------------------------------------------


def test_license_scan_matches_brute_force(docs, rows):
    rng = random.Random(15)
    notices = [t for _, t in tj.TEMPLATES]
    items = []
    for i in range(120):
        words = [rng.choice(["under", "the", "MIT", "license", "cc", "by", "nc", "é", "version", "2", "apache", "of", "x1"])
                 for _ in range(rng.randint(0, 30))]
        text = " ".join(words)
        if i % 3 == 0:
            parts = rng.choice(notices).split()
            for _ in range(rng.randint(0, 3)):
                parts[rng.randrange(len(parts))] = "zzz"
            text += "\n" + "-".join(parts)
        items.append((i, text))
    items += [(500, None), (501, ""), (502, "w " * 5000 + "Under the MIT\nlicense"), (None, "cc by-nc"), (0, "Cc By Nc cc by nc")]
    sets = [(label, set(tj.words_of(t.encode()))) for label, t in tj.TEMPLATES]
    want = []
    for i, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, label) for p, label in tj.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        found = [(label, len(s & set(b)) / len(s)) for b in tj.text_blocks((t or "").encode()) for label, s in sets
                 if len(s & set(b)) >= tj.THRESHOLD * len(s) - 1e-9]
        pos = [k for k, _ in at]
        want.append((i, len(w), len(at), min(pos, default=None), max(pos, default=None), ",".join(sorted({x for _, x in at})),
                     ",".join(sorted({x for _, x in at} | {x for x, _ in found})),
                     1.0 if at else max((c for _, c in found), default=0.0)))
    out = tj.license_scan(docs(items))
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted(rows(out, *cols), key=str) == sorted(want, key=str)
    assert tj.license_scan(docs([]).limit(0)).count() == 0


def wrapped(text, width):
    return textwrap.fill(text, width, break_long_words=False)


@pytest.mark.parametrize("width", [5, 30, 72, 80])
def test_wrapped_notices_are_found(docs, rows, width):
    items = [(k, f"Some words first.\n\n{wrapped(t, width)}\n\n" + "tail zzz " * (70 * (k % 3))) for k, (_, t) in enumerate(tj.TEMPLATES)]
    items += [(100 + k, "front " * n + "\n" + wrapped(tj.TEMPLATES[0][1], width)) for k, n in enumerate(range(0, 200, 9))]
    found = dict(rows(tj.license_scan(docs(items)), "doc_id", "labels"))
    for i, _ in items:
        label = tj.TEMPLATES[i][0] if i < 100 else "mit"
        assert label in found[i].split(","), (i, label, found[i])


OTHER_LICENCES = ["Licensed under the Mozilla Public License, Version 2.0", "Released under the BSD License",
                  "Licensed under CC BY 4.0", "This work is licensed under the GNU General Public License, version 2",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License",
                  "This work is licensed under the GNU Lesser General Public License, version 3",
                  "The mit word, then a license that was sent to all of us and released by the firm under a name"]


def test_query_labels_need_the_naming_tokens(docs, rows, monkeypatch):
    rng = random.Random(22)
    items = [*enumerate(OTHER_LICENCES)]
    items += [(100 + k, wrapped("before it " + t + " after it", 40)) for k, (_, t) in enumerate(tj.TEMPLATES)]
    for i in range(150):
        parts = rng.choice(tj.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(["zzz", "\n", "mit", "lesser", "cc"]))
        if i % 2:
            del parts[rng.randrange(len(parts))]
        items.append((200 + i, "w " * rng.choice([0, 60, 120, 190]) + " ".join(parts) + "\n" + "of the license " * rng.choice([0, 30])))
    monkeypatch.setattr(queries, "read_table", lambda *_: docs(items))
    found = {r["doc_id"]: r for r in queries.QUERIES["op7_template_join"](docs([]).sparkSession, "").collect()}
    assert not any(found[k]["labels"] for k in range(len(OTHER_LICENCES)))
    assert all(tj.TEMPLATES[k][0] in found[100 + k]["labels"].split(",") for k in range(len(tj.TEMPLATES)))
    for i, text in items:
        best: dict[str, float] = {}
        for (label, notice), (must, never) in zip(tj.TEMPLATES, tj.NAMING, strict=True):
            own = tj.words_of(notice.encode())
            width = -(-len(own) * 5 // 4)
            for line in [*text.split("\n"), text]:
                words = tj.words_of(line.encode())
                for s in range(max(1, len(words) - width + 1)):
                    some = set(words[s:s + width])
                    share = len(some & set(own)) / len(set(own))
                    if share >= 0.8 and set(must.encode().split()) <= some and not set(never.encode().split()) & some:
                        best[label] = max(best.get(label, 0), share)
        base = {label for p, label in tj.PHRASES.items() if f" {p} " in " " + b" ".join(tj.words_of(text.encode())).decode() + " "}
        assert found[i]["labels"] == ",".join(sorted(base | set(best))), text
        assert found[i]["score"] == (1.0 if base else max(best.values(), default=0.0))


# ---- op5, op6 --------------------------------------------------------------------------------------------------


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def labelled_corpus(n=700, seed=16):
    rng = random.Random(seed)
    syllables = ["the", "on", "er", "ti", "an", "re", "sh", "ble", "ing", "ou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    items, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([5, 30, 200]))]
        toxic, good = rng.random() < 0.2, rng.random() > 0.3
        if not good and i % 2 == 0:
            words = words[:3] * 40
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["vexgrum", "quazk"]))
        items.append((i, " ".join(words) if good or i % 2 == 0 else " ### ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return items, labels


@pytest.mark.parametrize("score,column", [(kn.toxicity_scores, 2), (quality_scores, 1)])
def test_held_out_accuracy(docs, labels, score, column):
    items, marks = labelled_corpus()
    truth = {m[0]: m[column] for m in marks}
    out = score(docs(items), labels(marks)).collect()
    assert len(out) == len(items)
    assert all(r["held_out"] == (fold(r["doc_id"]) == 0) and 0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    # held-out labels are never looked at: turning them round changes nothing
    turned = [(i, 1 - q, 1 - t) if fold(i) == 0 else (i, q, t) for i, q, t in marks]
    again = {r["doc_id"]: r["score"] for r in score(docs(items), labels(turned)).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-9) for r in out)


@pytest.mark.parametrize("score", [kn.toxicity_scores, quality_scores])
def test_classifier_edge_rows(docs, labels, score):
    items = [(None, "x"), (1, None), (1, None), (2, ""), (3, "w " * 40_000), (6, "a b")]
    for marks in ([], [(1, 1, 1), (None, 0, 0), (2, None, None), (3, 7, 7)], [(1, 1, 1), (1, 0, 0), (6, 0, 0), (7, 1, 1)]):
        out = score(docs(items), labels(marks)).collect()
        assert len(out) == len(items) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out)
    assert score(docs([]).limit(0), labels([])).count() == 0


def test_shared_backoff_is_a_distribution():
    codes = np.unique(kn.text_grams(["the thin then", "one on none é 12!"]))
    types = np.bincount((codes % kn.HISTORIES).astype(np.int64), minlength=kn.HISTORIES)
    p = kn.LogRatio._shared(types).reshape(-1, 1 << kn.BITS)
    assert np.allclose(p.sum(1), 1.0) and (p > 0).all()


def test_gram_codes_do_not_cross_texts():
    one = np.concatenate([kn.text_grams([t]) for t in ("abc", "", "xyz 12")])
    assert sorted(one.tolist()) == sorted(kn.text_grams(["abc", "", "xyz 12"]).tolist())


def exact_grams(text):
    """(history, symbol) at every place of a text, read off the string."""
    line, found = " " + text + " ", []
    for i in range(1, len(line)):
        word = line[:i].rpartition(" ")[2]
        found.append((word[-7:], line[i]))
    return found


def test_gram_codes_are_exact():
    rng = random.Random(17)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 12))) for _ in range(400))
             for _ in range(20)]
    by_code: dict[int, set] = {}
    for text in texts:
        grams = exact_grams(text)
        codes = kn.gram_codes([text])[0][:len(grams)].tolist()
        for c, g in zip(codes, grams, strict=True):
            by_code.setdefault(c, set()).add(g)
    assert all(len(g) == 1 for g in by_code.values())
    assert len(by_code) == len({g for text in texts for g in exact_grams(text)}) > 20_000


def test_shared_chain_matches_brute_force(spark):
    rng = random.Random(18)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(60)) for _ in range(5)]
    codes = np.unique(kn.text_grams(texts))
    table = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    chain, dense = kn.chain_counts(table, table.filter("code % 3 = 0"))
    found = sorted(chain.collect(), key=lambda r: r["code"])
    ends = np.array([r["code"] for r in found], np.int64)
    got = kn.LogRatio.chain(ends, {k: [np.array([r[f"{c}{k}"] for r in found]) for c in ("n", "total", "kinds")]
                                   for k in range(kn.DENSE + 1, kn.TOP + 1)}, dense)
    longer, levels = [int(c) for c in codes], {}
    for k in range(kn.TOP, 0, -1):
        level: dict[int, int] = {}
        for c in longer:
            level[c % 256**k] = level.get(c % 256**k, 0) + 1
        longer = levels[k] = level
    def p(code, k):
        if k == 0:
            return 1 / 256
        level, code = levels[k], code % 256**k
        own = [n for c, n in level.items() if c // 256 == code // 256]
        return (max(level[code] - 0.75, 0) + 0.75 * len(own) * p(code, k - 1)) / sum(own)
    assert len(ends) == len({int(c) % 256**4 for c in codes.view(np.int64) if c % 3 == 0}) > 50
    assert np.allclose(got, [p(int(c), kn.TOP) for c in ends])


def test_code_table_finds_exactly_its_codes():
    rng = np.random.default_rng(19)
    codes = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) << np.uint64(rng.integers(0, 2)))
    table = CodeTable(codes)
    assert (table.find(codes) == np.arange(len(codes))).all()
    other = np.setdiff1d(rng.integers(0, 2**63, 5000).astype(np.uint64), codes)
    assert (table.find(other) == -1).all() and len(CodeTable(codes[:0]).find(other)) == len(other)


def test_letters_of_every_script_are_kept_apart():
    code = lambda t: kn.text_grams([t]).tolist()
    words = ["агжй", "гажй", "αδηκ", "δαηκ", "日本語", "本日語", "كتب", "تكب", "é", "ë", "a\x00", "a\x01", "a1", "a2", "a!"]
    assert len({tuple(code(w)) for w in words}) == len(words)
    for upper, lower in (("ГАЖЙ", "гажй"), ("ΑΔΗΚ", "αδηκ"), ("É", "é"), ("A\tB", "a b")):
        assert code(upper) == code(lower)


@pytest.mark.parametrize("letters", ["агжй", "αδηκ", "あうえお", "kmnp"])
def test_toxic_words_of_every_script_are_found(docs, labels, letters):
    rng = random.Random(20)
    words = sorted({"".join(rng.choice(letters) for _ in range(6)) for _ in range(60)})
    bad, fine = words[:2], words[2:]
    items, marks = [], []
    for i in range(400):
        toxic = i % 3 == 0
        text = [rng.choice(fine) for _ in range(20)]
        if toxic:
            text[rng.randrange(20)] = rng.choice(bad)
            text[rng.randrange(20)] = rng.choice(bad)
        items.append((i, " ".join(text)))
        marks.append((i, 1, int(toxic)))
    out = [r for r in kn.toxicity_scores(docs(items), labels(marks)).collect() if r["held_out"]]
    assert len(out) > 50 and np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in out]) > 0.9


def test_windows_start_everywhere():
    rng = np.random.default_rng(21)
    grams = np.unique(kn.text_grams(["the thin then vexgrum one on none"]))
    model = kn.LogRatio(grams, rng.integers(0, 5, len(grams)), rng.integers(1, 5, len(grams)), np.full(len(grams), 0.01))
    texts = [" " * k + "the thin vexgrum none then one on the thin then" for k in range(7)]
    for text, got in zip(texts, model.features(texts), strict=True):
        r = model.ratios(kn.text_grams([text]))
        for k, w in enumerate(kn.WINDOWS):
            assert got[1 + k] == pytest.approx(max(r[i:i + w].astype(float).sum() for i in range(len(r) - w + 1)) / w)


def test_toxic_phrases_of_ordinary_words_are_found(docs, labels):
    rng = random.Random(22)
    common = ["stone", "river", "hill", "walks", "green", "quiet", "house", "over", "bright", "under", "field", "rain"]
    items, marks = [], []
    for i in range(540):
        words = [rng.choice(common[2:]) for _ in range(rng.randint(12, 40))]
        a, b = sorted(rng.sample(range(1, len(words) - 1), 2))
        toxic = i % 2 == 0
        words[a:a] = ["River,", "stone"] if toxic and i % 4 else ["river", "stone"] if toxic else ["river"]
        if not toxic:
            words[b + 2:b + 2] = ["stone"]
        items.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    out = [r for r in kn.toxicity_scores(docs(items), labels(marks)).collect() if r["held_out"]]
    assert len(out) > 80 and np.mean([r["predicted"] == (r["doc_id"] % 2 == 0) for r in out]) > 0.9


def test_pair_scores_match_brute_force(docs, labels):
    """Features of whole texts from counts and probabilities made without the module's arrays."""
    texts = ["The cat sat, the cat ran", "a cat sat on the mat", "", "the mat! The mat? the", "dog ran on", "the unseen cat sat"]
    known = [(0, 1), (1, 0), (2, 1), (3, 0), (4, 1)]
    frame = docs(list(enumerate(texts))).select("doc_id", "text")
    model = wp.fit_pairs(frame, frame.sparkSession.createDataFrame(known, "_id long, _class int"))
    split = [re.findall("[a-z]+", t.lower()) for t in texts]
    seen = Counter(w for t in split for w in t)
    pairs = {c: Counter(p for i, x in known if x == c for p in zip([None, *split[i]], split[i], strict=False)) for c in (0, 1)}

    def p(c, past, word):
        total = sum(n for (a, _), n in pairs[c].items() if a == past)
        kinds = sum(1 for a, _ in pairs[c] if a == past)
        lower = seen[word] / sum(seen.values())
        return max(pairs[c][past, word] - 0.75, 0) / total + 0.75 * kinds / total * lower if total else lower

    for past in (None, "the", "cat", "nowhere"):
        assert sum(p(1, past, w) for w in seen) == pytest.approx(1)
    for words, got in zip(split, model.features(texts), strict=True):
        r = [np.log(p(1, a, w) / p(0, a, w)) for a, w in zip([None, *words], words, strict=False)]
        want = [np.mean(r) if r else 0.0]
        for size in wp.WINDOWS:
            padded = r + [0.0] * (size - len(r))
            want.append(max(sum(padded[i:i + size]) / size for i in range(len(padded) - size + 1)))
        assert got == pytest.approx(want, abs=1e-5)


def test_labelled_sample_is_bounded_in_bytes(docs, labels):
    frame = docs([(i, "é" * 8) for i in range(100)] + [(5, "é" * 200), (6, None)]).select("doc_id", "text")
    train = frame.sparkSession.createDataFrame([(i, i % 2) for i in range(120)], "_id long, _class int")
    some = [r["_id"] for r in wp.labelled_within(train, frame, 400).collect()]
    assert len(some) == len(set(some)) == 25 and 5 not in some


def test_stored_ratios_are_those_of_all_grams_at_once(spark):
    rng = random.Random(23)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(200)) for _ in range(6)]
    codes, n = np.unique(kn.text_grams(texts), return_counts=True)
    rows = [(int(c), int(k) % 3, int(k) % 2 + 1) for c, k in zip(codes.view(np.int64), n, strict=True)]
    table = spark.createDataFrame(rows, "code long, n_toxic long, n_ordinary long")
    chain, dense = kn.chain_counts(table.select("code"), table)
    found = sorted(chain.collect(), key=lambda r: r["code"])
    ends = np.array([r["code"] for r in found], np.int64)
    p = kn.LogRatio.chain(ends, {k: [np.array([r[f"{c}{k}"] for r in found]) for c in ("n", "total", "kinds")]
                                 for k in range(kn.DENSE + 1, kn.TOP + 1)}, dense)
    at = np.searchsorted(ends, codes.view(np.int64) & (256**kn.TOP - 1))
    whole = kn.LogRatio(codes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), p[at])
    stored = pickle.loads(pickle.dumps(kn.LogRatio.stored(table, chain, dense)))
    seen = kn.gram_codes([*texts, "unseen words zzz abcx", ""])[0]
    assert len(codes) > 2000 and (stored.ratios(seen) == whole.ratios(seen)).all()


def test_toxicity_models_stay_off_the_driver(docs, labels, monkeypatch):
    """Neither grams nor pairs are collected or broadcast, whatever the labelled texts hold."""
    rng = random.Random(24)
    items = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))) for i in range(200)]
    frame, marks = docs(items), labels([(i, 1, i % 2) for i in range(200)])
    grams = len(np.unique(kn.text_grams([t for _, t in items])))
    taken, sent = [], []
    to_arrow, collect, broadcast = type(frame).toArrow, type(frame).collect, SparkContext.broadcast

    def keep(method):
        def run(self, *args):
            out = method(self, *args)
            taken.append(len(out))
            return out
        return run

    monkeypatch.setattr(type(frame), "toArrow", keep(to_arrow))
    monkeypatch.setattr(type(frame), "collect", keep(collect))
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, x: (sent.append(x), broadcast(self, x))[1])
    assert kn.toxicity_scores(frame, marks).count() == 200
    assert grams > 10_000 and taken and max(taken) <= 400
    large = [x for x in sent if len(pickle.dumps(x)) > 10_000]
    assert sent and all(isinstance(x, np.ndarray) and len(x) == kn.HISTORIES for x in large)


def test_text_slices_are_bounded_in_bytes():
    import pyarrow as pa

    texts = ["é" * 40, None, "", "x" * 500, *["ab" * 20] * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    found = list(text_slices(batch, 8, 1, 200))
    assert [t for _, some in found for t in some] == [t or "" for t in texts]
    assert [i for part, _ in found for i in part.column(0).to_pylist()] == list(range(len(texts)))
    assert all(len(some) <= 8 and (len(some) == 1 or len("".join(some).encode()) <= 200) for _, some in found)
