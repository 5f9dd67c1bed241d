"""Byte-level BPE with a priority queue of merge ranks.

``HeapBpe`` holds one vocabulary file.  A text is cut into pieces as the
vocabulary's pre-tokenizer does; the symbols of a piece form a doubly linked
list, a heap holds (rank, position) of every mergeable neighbour pair, and an
entry whose pair has changed since is stale and skipped.  A piece of n symbols
costs O(n log n), so a very long word is no special case.  Decoding joins the
vocabulary's byte strings.

Space-delimited chunks cut at the same places as whole texts (a single space
before a non-space always starts a piece), so results are remembered per chunk
in a two-generation memory bounded in words and bytes; it changes speed only.
"""
from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from functools import lru_cache
from sys import getsizeof

import numpy as np
from pyspark.sql import DataFrame

from .common import map_batches, text_slices

MEMORY_WORDS = 300_000
MEMORY_BYTES = 64 << 20
ENTRY_BYTES = 100  # an entry's share of the table itself
LONGEST = 128
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Generations(dict):
    """word -> packed ids; computes missing words and keeps the two latest
    generations, each of at most ``limit`` words and about ``most_bytes`` bytes.
    Words of more than LONGEST characters are computed anew every time."""

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMORY_WORDS, most_bytes: int = MEMORY_BYTES):
        super().__init__()
        self.make, self.limit, self.most_bytes, self.bytes, self.old = make, limit, most_bytes, 0, {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST:
            return self.make(word)
        ids = self.old.pop(word, None)
        if ids is None:
            ids = self.make(word)
        if len(self) >= self.limit or self.bytes >= self.most_bytes:
            self.old = dict(self)
            self.clear()
            self.bytes = 0
        self[word] = ids
        self.bytes += getsizeof(word) + getsizeof(ids) + ENTRY_BYTES
        return ids


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class HeapBpe:
    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                 "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or any(model.get(k, v) != v for k, v in plain.items()):
            raise ValueError("only plain byte-level BPE files are supported")
        symbols = byte_symbols()
        as_byte = {c: b for b, c in enumerate(symbols)}
        vocab = model["vocab"]
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("only plain added tokens are supported")
        self.strings = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in added)]))
        for word, i in vocab.items():
            self.strings[i] = bytes(as_byte[c] for c in word) if all(c in as_byte for c in word) else word.encode()
        for t in added:
            self.strings[t["id"]] = t["content"].encode()
        self.byte_ids = [vocab.get(c) for c in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.pieces = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.added = {t["content"]: np.uint32(t["id"]).tobytes() for t in added}
        marks = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.split_added = regex.compile(f"({marks})").split if marks else None
        self.by_piece = Generations(self._piece, memory_words)
        self.first = Generations(self._chunk, memory_words)
        self.spaced = Generations(lambda w: self._chunk(" " + w), memory_words)

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to one piece's symbols, lowest rank first, leftmost first among equals."""
        merges, n = self.merges, len(ids)
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        if not heap:
            return ids
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: a neighbour has merged meanwhile
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(heap, (m[0], i, new, ids[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(heap, (m[0], h, ids[h], new, m[1]))
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> bytes:
        known = self.byte_ids
        return np.array(self.merge([known[b] for b in piece.encode()]), np.uint32).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.by_piece.__getitem__, self.pieces(chunk)))

    def _plain(self, text: str) -> bytes:
        if "  " in text or text.endswith(" "):  # runs of spaces: cut the whole text
            return self._chunk(text)
        words = text.split(" ")
        return self.first[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:]))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.split_added and any(t in text for t in self.added):
            parts = self.split_added(text)
            return b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts) if p)
        return self._plain(text) if text else b""

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.strings.__getitem__, numbers)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def load(path: str) -> HeapBpe:
    return HeapBpe(path)


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256 (over
    little-endian unsigned 32-bit ids) and decoded_sha256.

    Null texts count as empty (no ids, digest of nothing); null ids and
    repeated rows pass through one by one; further columns are not read.
    ``tokenizer_path`` must exist on every executor.
    """
    def run(batches):
        import pyarrow as pa

        bpe = load(tokenizer_path)
        for batch in batches:
            for part, texts in text_slices(batch):
                n, a, b = [], [], []
                for text in texts:
                    ids = bpe.encode(text)
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, SCHEMA)


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids themselves: doc_id, ids array<long> (null text: empty array)."""
    def run(batches):
        import pyarrow as pa

        bpe = load(tokenizer_path)
        for batch in batches:
            for part, texts in text_slices(batch, 64):
                ids = [np.frombuffer(bpe.encode(t), "<u4").astype(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int64()))],
                                                 ["doc_id", "ids"])

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run,
                       "doc_id long, ids array<long>")


def bpe_decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, text from rows of ``bpe_encode`` (null ids: empty text)."""
    def run(batches):
        import pyarrow as pa

        bpe = load(tokenizer_path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
