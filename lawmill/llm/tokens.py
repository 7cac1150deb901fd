"""Encoding of a corpus with a public byte-level BPE tokenizer.

Method: two tiers. A minimal perfect hash over the vocabulary resolves a pre-token that is itself
a token; a miss is merged byte by byte with a heap of candidate pairs over a doubly linked list,
O(n log n) however long the pre-token. Texts are cut at blanks into chunks whose encoding
depends on nothing outside them, and every chunk's encoding is remembered while its task runs,
so that the tiers are asked once per distinct chunk; ids are then gathered as arrays.

No special tokens are added, and the name of one inside a text is ordinary text. An empty and
a null text both give an empty list. Ids keep the order of the text, which decoding restores
byte for byte.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the vocabulary's pre-token pattern.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The blanks of that pattern.
_W = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
PRETOKEN = regex.compile(PATTERN.replace(r"[^\s", f"[^{_W}").replace(r"\s", f"[{_W}]").replace(r"\S", f"[^{_W}]"))
#: Distinct chunks a task remembers at once, and texts it encodes at once.
MEMO, SLICE = 300_000, 500


class PerfectHash:
    """A minimal perfect hash of byte strings to their position in ``keys``: hash and displace.

    Buckets of several keys look for a displacement that sends all their keys to free slots; buckets
    of one key are told the slot itself.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.shift = np.zeros(max(1, n // 3), dtype=np.int64)
        self.slot = np.zeros(n, dtype=np.int32)
        buckets: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            buckets.setdefault((h >> 96) % len(self.shift), []).append(i)
        taken = np.zeros(n, dtype=bool)
        free = None
        for b, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(members) > 1:
                d = 0
                while True:
                    at = [self._at(hashes[i], d) for i in members]
                    if len(set(at)) == len(at) and not taken[at].any():
                        break
                    d += 1
                self.shift[b] = d
            else:
                free = free if free is not None else iter(np.flatnonzero(~taken).tolist())
                at = [next(free)]
                self.shift[b] = -at[0] - 1
            for i, a in zip(members, at):
                taken[a] = True
                self.slot[a] = i

    def _at(self, h: int, d: int) -> int:
        x = ((h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x >> 24) % self.n

    def place(self, key: bytes) -> int:
        """The position of a key; of a string that is no key, the position of some key."""
        h = xxhash.xxh3_128_intdigest(key)
        d = int(self.shift[(h >> 96) % len(self.shift)])
        return int(self.slot[-d - 1 if d < 0 else self._at(h, d)])


class Vocabulary:
    """The tokens in rank order behind a minimal perfect hash."""

    def __init__(self, tokens: list[bytes], ranks: list[int]):
        self.tokens, self.ranks = tokens, ranks
        self.hash = PerfectHash(tokens)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            rows = [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]
        return cls([a for a, _ in rows], [b for _, b in rows])

    def rank(self, token: bytes) -> int | None:
        i = self.hash.place(token)
        return self.ranks[i] if self.tokens[i] == token else None

    def merge(self, word: bytes) -> list[int]:
        """Byte-pair merges of a pre-token that is no token, lowest rank first, then leftmost."""
        n = len(word)
        parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = self.rank(word[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 1, word[i : i + 2]))
        heapify(heap)
        while heap:
            _, i, j, pair = heappop(heap)
            if parts[i] is None or after[i] != j or j >= n or parts[j] is None or len(parts[i]) + len(parts[j]) != len(pair):
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = pair, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                both = pair + parts[after[i]]
                if (r := self.rank(both)) is not None:
                    heappush(heap, (r, i, after[i], both))
            if before[i] >= 0:
                both = parts[before[i]] + pair
                if (r := self.rank(both)) is not None:
                    heappush(heap, (r, before[i], i, both))
        return [self.rank(p) for p in parts if p is not None]

    def encode_pretoken(self, word: bytes) -> list[int]:
        r = self.rank(word)
        return [r] if r is not None else self.merge(word)

    def encode(self, text: str) -> list[int]:
        return [i for w in PRETOKEN.findall(text) for i in self.encode_pretoken(w.encode("utf-8"))]


class Encoder(dict):
    """Chunks by number, with their encodings one after the other."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.flat, self.start, self.length = array("i"), array("q"), array("i")

    def __missing__(self, chunk: str) -> int:
        ids = self.vocabulary.encode(chunk)
        i = self[chunk] = len(self.length)
        self.start.append(len(self.flat))
        self.length.append(len(ids))
        self.flat.extend(ids)
        return i

    def chunks(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers of all texts, where each text begins in them and the last ends)."""
        if len(self) > MEMO:
            self.clear()
            self.flat, self.start, self.length = array("i"), array("q"), array("i")
        numbers: list[int] = []
        ends = [0]
        get = self.__getitem__
        for t in texts:
            if t:
                numbers.extend(map(get, CHUNK.findall(t)))
            ends.append(len(numbers))
        return np.asarray(numbers, dtype=np.int64), np.asarray(ends, dtype=np.int64)

    def sizes(self, texts: Iterable[str | None]) -> np.ndarray:
        """How many tokens each text has."""
        numbers, ends = self.chunks(texts)
        total = np.concatenate(([0], np.cumsum(np.frombuffer(self.length, dtype=np.int32)[numbers], dtype=np.int64))) if len(numbers) else np.zeros(1, dtype=np.int64)
        return np.diff(total[ends])

    def ids(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text begins in them and the last ends)."""
        numbers, ends = self.chunks(texts)
        if not len(numbers):
            return np.zeros(0, dtype=np.int32), np.zeros(len(ends), dtype=np.int32)
        length = np.frombuffer(self.length, dtype=np.int32)[numbers]
        total = np.concatenate(([0], np.cumsum(length, dtype=np.int64)))
        shift = np.frombuffer(self.start, dtype=np.int64)[numbers] - total[:-1]
        at = np.repeat(shift, length)
        at += np.arange(total[-1])
        return np.frombuffer(self.flat, dtype=np.int32)[at], total[ends].astype(np.int32)


@lru_cache(maxsize=4)
def load_vocabulary(path: str, changed: int) -> Vocabulary:
    """The vocabulary of a file, built once a driver for every state of the file."""
    return Vocabulary.load(path)


def share_vocabulary(spark: SparkSession, tokenizer_dir: str, name: str):
    """The vocabulary, built once and broadcast: its size is the tokenizer's, whatever the corpus."""
    path = f"{tokenizer_dir}/{name}.tiktoken"
    return spark.sparkContext.broadcast(load_vocabulary(path, os.stat(path).st_mtime_ns))


def encode_documents(documents: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of each row of ``documents`` (doc_id, text; other columns are ignored)."""
    shared = share_vocabulary(documents.sparkSession, tokenizer_dir, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(shared.value)
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part = b.slice(k, SLICE)
                ids, ends = e.ids(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, tokens) of each row of ``documents``."""
    shared = share_vocabulary(documents.sparkSession, tokenizer_dir, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(shared.value)
        for b in batches:
            n = np.concatenate([e.sizes(b.slice(k, SLICE).column("text").to_pylist()) for k in range(0, b.num_rows, SLICE)] or [np.zeros(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, tokens bigint")
