"""op1, op3, op4, op8: links, components and lines against brute force."""
from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from closequarters.llm import collision_join as cj
from closequarters.llm import hyperminhash as hm
from closequarters.llm.exact_split import exact_dedup, frequent_digests, text_digests
from closequarters.llm.graph import connected_components
from closequarters.llm.line_spread import dedup_lines, line_report


def components(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if (low[a], low[b]) != (m, m):
                low[a] = low[b] = m
                changed = True
    return low


# ---- op4 -------------------------------------------------------------------------------------------------------


def test_exact_dedup_matches_brute_force_with_and_without_heavy_groups(docs, rows):
    rng = random.Random(1)
    items = [(i, rng.choice(["a", "b", "", None, "x" * 5000, f"own {i}", "Ab", "ab", "ab "])) for i in range(400)]
    by: dict[str, list[int]] = {}
    for i, t in items:
        by.setdefault(t or "", []).append(i)
    want = sorted((i, max(by[t or ""]), len(by[t or ""]), i == max(by[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in items)
    for heavy in (1, 20, 10_000):
        out = exact_dedup(docs(items), min_heavy=heavy, max_tracked=16)
        assert sorted(rows(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256")) == want


def test_frequent_digests_never_miss_a_heavy_text(docs, rows):
    items = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(700)]
    random.Random(2).shuffle(items)
    df = text_digests(docs(items).repartition(7))
    found = {r[0] for r in rows(frequent_digests(df, 8), "text_sha256")}
    assert hashlib.sha256(b"hot").hexdigest() in found
    assert len(found) <= 8


def test_exact_dedup_edge_rows(docs, rows):
    out = exact_dedup(docs([(None, "a"), (3, "a"), (3, "a"), (None, "b")]))
    got = sorted(rows(out, "doc_id", "keep_id", "group_size", "kept"), key=str)
    assert got == sorted([(None, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (None, None, 1, True)], key=str)
    assert exact_dedup(docs([]).limit(0)).count() == 0


# ---- op8 -------------------------------------------------------------------------------------------------------


def shingle_set(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_corpus(seed=3, bases=25):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    hot = [word() for _ in range(30)]
    items, n = [(900001, None), (900002, ""), (900003, " \n\t "), (900004, "One two"), (900005, "one TWO\n")], 0
    for b in range(bases):
        base = [word() for _ in range(rng.choice([3, 5, 9, 40, 120, 400]))]
        if b % 4 == 0:
            base += hot
        for _ in range(rng.choice([1, 2, 6])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = word()
            items.append((n, " ".join(text)))
            n += 1
    items += [(50_000, "long " * 3 + " ".join(f"w{i}" for i in range(30_000)))]
    rng.shuffle(items)
    return items


@pytest.mark.parametrize("k,block", [(4, 512), (5, 2)])
def test_near_duplicates_match_brute_force(docs, rows, k, block):
    items = near_corpus(3 + k)
    sets = {i: shingle_set(t, k) for i, t in items}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = components(ids, links)
    assert len(set(low.values())) < len(ids) - 10
    out = hm.near_duplicates(docs(items), shingle=k, block=block)
    assert sorted(rows(out, "doc_id", "n_shingles", "component_id", "kept")) == [
        (i, len(sets[i]), low[i], low[i] == i) for i in ids]


def test_near_duplicates_edge_rows(docs, rows):
    out = hm.near_duplicates(docs([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, "A B c d e  f")]))
    got = sorted(rows(out, "doc_id", "n_shingles", "component_id", "kept"), key=str)
    assert got == sorted([(None, 2, None, True), (7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)], key=str)
    assert hm.near_duplicates(docs([]).limit(0)).count() == 0


def test_registers_estimate_jaccard_for_small_and_large_sets():
    rng = np.random.default_rng(5)
    for size in (6, 40, 300, 5000):
        errors = []
        for _ in range(30):
            both = rng.integers(0, 2**63, size * 8 // 10, dtype=np.uint64)
            own = [rng.integers(0, 2**63, size - len(both), dtype=np.uint64) for _ in (0, 1)]
            a, b = (np.unique(hm.mix(np.concatenate([both, o]))) for o in own)
            true = len(both) / (2 * size - len(both))
            est = hm.estimated_jaccard(hm.registers(a)[None], hm.registers(b)[None], np.array([size]), np.array([size]))
            errors.append(est[0] - true)
        assert abs(np.mean(errors)) < 0.03
        assert max(map(abs, errors)) < 0.2


def test_random_collision_correction_is_close_to_simulation():
    rng = np.random.default_rng(6)
    hits = [np.mean(hm.registers(np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64)))
                    == hm.registers(np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64)))) for _ in range(400)]
    assert float(hm.random_collision(np.array([2000.0]), np.array([2000.0]))[0]) == pytest.approx(np.mean(hits), rel=0.5)


def test_components_of_a_long_chain_and_a_star(spark, rows):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    random.Random(4).shuffle(links)
    low = components({n for e in links for n in e}, links)
    out = connected_components(spark.createDataFrame(links, "a long, b long"), local_links=0)
    local = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, local.collect())) == sorted(map(tuple, out.collect()))
    assert sorted(rows(out, "node", "component")) == sorted(low.items())


# ---- op1 -------------------------------------------------------------------------------------------------------


def vector_table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in vectors],
                                 "vec_id long, embedding array<float>, label int, n_links string")


def brute_links(vectors, threshold=0.95):
    usable = {}
    for i, v in vectors:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            usable[i] = x / np.linalg.norm(x)
    ids = sorted(usable)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
            if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= threshold]


@pytest.mark.parametrize("sizes", [{}, {"crowd": 1, "block": 8}, {"crowd": 3, "block": 2}])
def test_near_vectors_match_brute_force(spark, rows, sizes):
    rng = np.random.default_rng(7)
    vectors, n = [], 0
    for _ in range(120):
        base = rng.standard_normal(32)
        for _ in range(rng.choice([1, 1, 2, 8])):
            noise = rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.2, 0.32]) * np.linalg.norm(base) / math.sqrt(32)
            vectors.append((n, [float(x) for x in base + noise]))
            n += 1
    nan, inf = float("nan"), float("inf")
    vectors += [(n, None), (n + 1, []), (n + 2, [0.0] * 32), (n + 3, [1.0, None]), (n + 4, [nan] * 32), (n + 5, [inf, 1.0]),
                (n + 6, [1.0, 0.0]), (n + 7, [2.0, 0.1])]
    rng.shuffle(vectors)
    vectors = [(int(i), v) for i, v in vectors]
    links = brute_links(vectors)
    low = components([i for i, _ in vectors], links)
    degree = {i: sum(i in e for e in links) for i, _ in vectors}
    out = cj.near_vectors(vector_table(spark, vectors), **sizes)
    assert sorted(rows(out, "vec_id", "n_links", "component_id", "kept")) == sorted(
        (i, degree[i], low[i], low[i] == i) for i, _ in vectors)


def test_a_group_of_near_copies_writes_no_pairs(spark, rows, monkeypatch):
    # jittered vectors, nearly all pairs of them linked, no common ball
    written, cut = {}, cj.cut

    def counting(df, name):
        out = cut(df, name)
        if name in ("op1-links", "op1-blocks"):
            written[name] = out.count()
        return out

    monkeypatch.setattr(cj, "cut", counting)
    per_row = []
    for m in (300, 1200):
        rng = np.random.default_rng(m)
        base = rng.standard_normal(32)
        group = base + rng.standard_normal((m, 32)) * 0.2 * np.linalg.norm(base) / math.sqrt(32)
        group = np.vstack([group, rng.standard_normal((m // 4, 32))]).astype(np.float32).astype(float)
        vectors = [(i, [float(x) for x in v]) for i, v in enumerate(group)]
        unit = group / np.linalg.norm(group, axis=1)[:, None]
        linked = unit @ unit.T >= 0.95
        np.fill_diagonal(linked, False)
        assert linked.sum() > 0.5 * m * m
        out = rows(cj.near_vectors(vector_table(spark, vectors)), "vec_id", "n_links", "component_id")
        low = components(range(len(vectors)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked), strict=True) if a < b])
        assert [(i, c) for i, _, c in sorted(out)] == [(i, low[i]) for i in range(len(vectors))]
        # at the threshold itself a pair is met with a probability of RECALL
        degree = dict((i, n) for i, n, _ in out)
        assert all(degree[i] <= linked[i].sum() for i in degree)
        assert sum(degree.values()) >= 0.9995 * linked.sum()
        per_row.append(sum(written.values()) / m)
        assert sum(written.values()) < 0.02 * linked.sum()
    assert per_row[1] < math.ceil(1200 / cj.BLOCK) * per_row[0]  # a row per vector and block of its cell


def test_near_vectors_edge_rows(spark, rows):
    out = cj.near_vectors(vector_table(spark, [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [3.0, 0.0])]))
    got = sorted(rows(out, "vec_id", "n_links", "component_id"), key=str)
    assert got == sorted([(None, 0, None), (4, 2, 4), (4, 2, 4), (5, 2, 4)], key=str)
    assert cj.near_vectors(vector_table(spark, [(1, None)]).limit(0)).count() == 0


def test_collision_tables_reach_the_recall():
    for bits in (4, 10, 16):
        m, p = cj.tables_for(0.95, bits), cj.collision_probability(0.95, bits)
        missed = sum(math.comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(cj.NEEDED))
        assert missed <= 1 - cj.RECALL


# ---- op3 -------------------------------------------------------------------------------------------------------


def test_line_dedup_matches_brute_force(docs, rows):
    rng = random.Random(8)
    lines = [f"line {i}" for i in range(60)] + ["", "  "]
    items = [(i, "\n".join(rng.choice(lines[: 10 if rng.random() < 0.4 else 62]) for _ in range(rng.randint(0, 9))),
              f"s{rng.randint(0, 11)}") for i in range(150)] + [(999, None, "s1"), (1000, "line 1", None)]
    limit = 9
    sites: dict[str, set] = {}
    for _, t, s in items:
        for x in (t or "").split("\n"):
            sites.setdefault(x, set()).update({s} - {None})
    first: dict[str, tuple[int, int]] = {}
    for i, t, _ in sorted(items):
        for p, x in enumerate((t or "").split("\n")):
            first.setdefault(x, (i, p))
    want = {}
    for i, t, _ in items:
        keep = [x for p, x in enumerate((t or "").split("\n"))
                if not x.strip(" ") or len(sites[x]) < limit or first[x] == (i, p)]
        want[i] = "\n".join(keep)
    out = dedup_lines(docs(items), min_sites=limit)
    assert {i: t or "" for i, t in rows(out, "doc_id", "text")} == want
    assert any(want[i] != (t or "") for i, t, _ in items)
    assert dict(rows(out, "doc_id", "text"))[999] is None


def test_line_dedup_edge_rows(docs, rows):
    items = [(None, "a\nb", "s1"), (2, "a", "s1"), (2, "a", "s1"), (3, "a\nc", "s2"), (4, "a", "s3")]
    out = dedup_lines(docs(items), min_sites=3)
    assert sorted(rows(out, "doc_id", "text"), key=str) == sorted(
        [(None, "a\nb"), (2, "a"), (2, "a"), (3, "c"), (4, "")], key=str)
    assert line_report(docs([]).limit(0)).count() == 0


def test_joining_pairs_lose_no_component_and_emit_no_more_links_than_members():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(400) < 0.93], rng.integers(0, 2**63, 12, dtype=np.uint64)]))
            for _ in range(150)]
    members = [(x % 2, x, x, hm.registers(s).view(np.uint64), s) for x, s in enumerate(sets)]
    for a, b in zip(sets, sets[1:], strict=False):
        assert hm.common_counts(a, [b, a]).tolist() == [len(np.intersect1d(a, b)), len(a)]

    def components(pairs):
        low = list(range(len(sets)))
        for a, b in pairs:
            a, b = min(low[a], low[b]), max(low[a], low[b])
            low = [a if c == b else c for c in low]
        return low

    def linked(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= 80 * (len(a) + len(b) - both)

    found = []
    for i, j in ((0, 0), (0, 1), (1, 1)):
        part = [(x[1], y[1]) for x, y, *_ in hm.joining_pairs(i, j, members, lambda m: len(m[4]), 80, True)]
        assert len(part) < len(members)
        found += part
    assert all(linked(sets[a], sets[b]) for a, b in found)
    brute = [(a, b) for a in range(len(sets)) for b in range(a) if linked(sets[a], sets[b])]
    assert brute and components(found) == components(brute)
