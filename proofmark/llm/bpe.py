"""Byte-level BPE encoding and decoding by a rank file: a minimal perfect hash for whole pre-tokens, a heap for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import SPACES, add_fields, keyed_texts, per_batch, safe_pieces

#: Units (white space and the word after it) whose ids a worker remembers, and the longest one.
REMEMBERED = 600_000
LONGEST = 48
_MASK = (1 << 64) - 1
_UNIT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64, space, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: hash to a bucket, displace the bucket until its keys fit.

    n keys fill n slots. A look-up hashes once, reads the bucket's displacement and compares one key.
    """

    def __init__(self, keys: dict[bytes, int]):
        self.n = max(1, len(keys))
        self.buckets = max(1, self.n // 3)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.keys: list[bytes | None] = [None] * self.n
        self.values = [-1] * self.n
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            groups.setdefault(h % self.buckets, []).append((h, key))
        free = np.ones(self.n, dtype=bool)
        for bucket, members in sorted(groups.items(), key=lambda item: (-len(item[1]), item[0])):
            hashes = [h for h, _ in members]
            for shift in range(1, 1 << 30):
                slots = [self._slot(h, shift) for h in hashes]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
            self.shift[bucket] = shift
            for slot, (_, key) in zip(slots, members):
                free[slot] = False
                self.keys[slot], self.values[slot] = key, keys[key]
        self.shift = self.shift.tolist()

    def _slot(self, h: int, shift: int) -> int:
        mixed = ((h ^ (shift * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & _MASK
        return (mixed >> 32) % self.n

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        slot = self._slot(h, self.shift[h % self.buckets])
        return self.values[slot] if self.keys[slot] == key else -1


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.whole = PerfectHash(ranks)
        self.split = regex.compile(pattern)
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self._known: dict[str, list[int]] = {}

    def pretoken(self, token: bytes) -> list[int]:
        found = self.whole.get(token)
        return [found] if found >= 0 else self.merge(token)

    def merge(self, token: bytes) -> list[int]:
        """Join the lowest-ranked neighbours, leftmost first, until none is left.

        Parts are a doubly linked list over byte positions; a heap holds (rank, position, end) of joinable
        neighbours, and an entry counts only while both parts are as they were when it was put in.
        """
        ranks, n = self.ranks, len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(token[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        dead = bytearray(n + 1)
        while heap:
            _, i, end = heapq.heappop(heap)
            if dead[i]:
                continue
            j = after[i]
            if j >= n or after[j] != end:
                continue
            dead[j] = 1
            after[i] = end
            if end < n:
                before[end] = i
                rank = ranks.get(token[i : after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            p = before[i]
            if p >= 0:
                rank = ranks.get(token[p:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, p, end))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[token[i : after[i]]])
            i = after[i]
        return ids

    def encode_unit(self, unit: str) -> list[int]:
        ids: list[int] = []
        for match in self.split.findall(unit):
            ids += self.pretoken(match.encode("utf-8"))
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text. Units begin at white space, where the split pattern always begins anew."""
        units = _UNIT.findall(text)
        known = self._known
        unseen = [unit for unit in set(units) if unit not in known]
        if unseen:
            if len(known) > REMEMBERED:
                known.clear()
                unseen = list(set(units))
            for unit in unseen:
                known[unit] = self.encode_unit(unit)
        ids = list(chain.from_iterable(map(known.__getitem__, units)))
        for unit in unseen:
            if len(unit) > LONGEST:
                del known[unit]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, hash of the ids as decimal text, hash of the decoded bytes; long texts go piece by piece."""
        count, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for piece in safe_pieces(text):
            ids = self.encode(piece)
            if ids:
                shown = " ".join(map(self.text_of.__getitem__, ids))
                of_ids.update(((" " if count else "") + shown).encode())
                of_bytes.update(self.decode(ids))
                count += len(ids)
        return count, of_ids.hexdigest(), of_bytes.hexdigest()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec a worker process, built from the rank file on first use."""
    if (ranks_path, pattern) not in _CODECS:
        _CODECS[ranks_path, pattern] = Codec(read_ranks(ranks_path), pattern)
    return _CODECS[ranks_path, pattern]


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and token_ids (array of int). A null or empty text has no ids."""
    source = keyed_texts(df, id_col, text_col)

    def start():
        own = codec(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [list(chain.from_iterable(map(own.encode, safe_pieces(b.decode("utf-8", "replace"))))) for b in batch.column("body").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "token_ids"])

        return step

    return source.mapInArrow(per_batch(start), add_fields(source, ["id"], "token_ids array<int>")).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Back from `encode`: id and text. Null ids give an empty text; an id outside the vocabulary is an error."""
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def start():
        own = codec(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [own.decode(ids).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

        return step

    return source.mapInArrow(per_batch(start), add_fields(source, ["id"], "text string")).withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text; per input row: id, n_tokens, ids_sha256, decoded_sha256.

    ids_sha256 is over the decimal ids joined by one space, decoded_sha256 over the decoded bytes. A null or empty
    text has no ids and the hash of nothing. Repeated rows stay; an empty table gives none; other columns are not read.
    """
    source = keyed_texts(df, id_col, text_col)

    def start():
        own = codec(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [own.digest(body.decode("utf-8", "replace")) for body in batch.column("body").to_pylist()]
            counts, ids, decoded = zip(*found)
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    out = add_fields(source, ["id"], "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return source.mapInArrow(per_batch(start), out).withColumnRenamed("id", id_col)
