"""Benchmark passages in documents, found with a generalised suffix automaton over the benchmark's words."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm.common import add_fields, col, fresh, keyed_texts, per_batch, split_bytes, written

WINDOW = 13
#: A document is contaminated if its hit words are at least one in so many.
ONE_IN = 20
#: Text of benchmark items that one automaton holds, and so the bound of a broadcast; more items take more passes.
BLOCK_BYTES = 32 << 20

# Words are runs of digits, lower-case ASCII letters and all characters beyond ASCII.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_TABLE).split()


class Automaton:
    """Suffix automaton of many word sequences, with the items of every window.

    ``window_state[s]`` is the suffix state of s that holds the last `window` words of its strings, -1 if they are
    shorter. ``short_state[s]`` is the nearest suffix state (s itself included) at which a short item ends.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                code = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
                coded.append((name, code))
                last = 0
                for c in code:
                    last = self._extend(last, c)
        self._windows(coded)
        self._pairs(coded)

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, c, known)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for the strings that also end where p's do."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _windows(self, coded: list[tuple[str, list[int]]]) -> None:
        by_length = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.window_state = [-1] * len(self.next)
        for s in by_length:
            if self.length[s] >= self.window:
                up = self.link[s]
                self.window_state[s] = self.window_state[up] if self.length[up] >= self.window else s
        self.window_items: dict[int, set[str]] = {}
        self.short_items: dict[int, list[tuple[int, set[str]]]] = {}
        for name, code in coded:
            state = 0
            for at, c in enumerate(code, 1):
                state = self.next[state][c]
                if at >= self.window:
                    self.window_items.setdefault(self.window_state[state], set()).add(name)
            if len(code) < self.window:
                ends = self.short_items.setdefault(state, [])
                same = next((names for n, names in ends if n == len(code)), None)
                if same is None:
                    ends.append((len(code), {name}))
                else:
                    same.add(name)
        self.short_state = [-1] * len(self.next)
        for s in by_length:
            self.short_state[s] = s if s in self.short_items else self.short_state[self.link[s]]

    def _pairs(self, coded: list[tuple[str, list[int]]]) -> None:
        """A table over hashed word pairs: the fewest words a window with such a pair has, 0 where no item has the pair."""
        self.bits = max(12, min(24, sum(len(code) for _, code in coded).bit_length() + 4))
        self.least = np.zeros(1 << self.bits, dtype=np.uint8)
        self.single = np.zeros(len(self.ids) + 1, dtype=bool)
        for _, code in coded:
            if len(code) == 1:
                self.single[code[0]] = True
                continue
            slots = self._slots(np.array(code, dtype=np.uint64))
            size = min(self.window, len(code))
            held = self.least[slots]
            self.least[slots] = np.where(held == 0, size, np.minimum(held, size))

    def _slots(self, code: np.ndarray) -> np.ndarray:
        mixed = (code[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (code[1:] * np.uint64(0xD6E8FEB86659FD93))
        return ((mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def runs(self, code: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of words that may hold a window: all neighbouring words are pairs of items, and there are enough of them."""
        found = []
        if self.single.any():
            found += [(int(i), int(i) + 1) for i in np.flatnonzero(self.single[code.astype(np.int64)])]
        if len(code) < 2:
            return found
        least = self.least[self._slots(code)]
        least[(code[:-1] == 0) | (code[1:] == 0)] = 0
        edge = np.diff(np.concatenate(([0], (least > 0).view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            shortest = np.minimum.reduceat(np.append(least, 255), np.column_stack((first, last)).ravel())[::2]
            for i in np.flatnonzero(last - first + 1 >= shortest):
                found.append((int(first[i]), int(last[i]) + 1))
        return found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of words inside occurrences of windows, and the items that the windows belong to."""
        code = np.fromiter(map(self.ids.get, words, repeat(0)), dtype=np.uint64, count=len(words))
        spans, items = [], set()
        move, link, length = self.next, self.link, self.length
        for start, end in self.runs(code):
            state, matched = 0, 0
            for at, c in enumerate(code[start:end].tolist(), start + 1):
                while state and c not in move[state]:
                    state = link[state]
                    matched = length[state]
                if c in move[state]:
                    state = move[state][c]
                    matched += 1
                if matched >= self.window:
                    spans.append((at - self.window, at))
                    items |= self.window_items[self.window_state[state]]
                s = self.short_state[state]
                while s > 0:
                    for size, names in self.short_items[s]:
                        if size <= matched:
                            spans.append((at - size, at))
                            items |= names
                    s = self.short_state[link[s]]
        return merged(spans), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans united where they touch, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def scan(automaton: Automaton, body: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, spans and items of a whole text; a long text goes through in pieces that overlap by a window less one word."""
    count, spans, items, tail = 0, [], set(), []
    for piece in split_bytes(body.translate(_TABLE)):
        words = tail + piece.split()
        base = count - len(tail)
        found, names = automaton.hits(words)
        spans += [(base + a, base + b) for a, b in found]
        items |= names
        count = base + len(words)
        tail = words[len(words) - automaton.window + 1 :] if len(words) >= automaton.window else words
    return count, merged(spans), items


def automata(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    """Automata of the benchmark as broadcasts, each over a bounded block of items."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(col(text_col), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    built = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        built.append(spark.sparkContext.broadcast(Automaton(((r.item, words_of(r.text.encode())) for r in rows), window)))
    return built


_FOUND = "n_words long, spans array<long>, items array<string>"


def find_hits(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: id, n_words, spans (flat list of starts and ends, in words), items.

    An item of fewer words than the window is one window; an item without words is none. Null texts have no words.
    An empty benchmark gives no hits; repeated items count once.
    """
    state = keyed_texts(df, id_col, text_col).select("id", "body", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks = automata(benchmark, item_col, item_text_col, window)
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        state = state.mapInArrow(per_batch(_scanner(block, not last)), add_fields(state, ["id"] if last else ["id", "body"], _FOUND))
        if not last:
            state = written(state, "hits")
    return state.withColumnRenamed("id", id_col)


def _scanner(block, keep_body: bool):
    def start():
        automaton = block.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, spans, items = [], [], []
            for body, old, names in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                count, found, new = scan(automaton, body)
                counts.append(count)
                both = merged([*zip(old[::2], old[1::2]), *found])
                spans.append([x for span in both for x in span])
                items.append(sorted(new.union(names)))
            columns = {"id": batch.column("id")} | ({"body": batch.column("body")} if keep_body else {})
            columns |= {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return step

    return start


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """Per input row: id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and 20 * n_hit >= n_words)."""
    found = find_hits(df, benchmark, id_col, **names)
    # Over start, end, start, end ...: taking the sum from each next number leaves the ends less the starts.
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: x - total)
    return (
        found.withColumn("n_hit", covered)
        .withColumn("n_items", F.size("items").cast("long"))
        .select(
            col(id_col), "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))).alias("contaminated"),
        )
    )


def excise(text: str, count: int, spans: list[tuple[int, int]], drop_share: float) -> str | None:
    """The text, of `count` words, without hit spans; None if they hold that share of its words or more. Clean texts come back as they are."""
    hit = sum(b - a for a, b in spans)
    if not hit or hit * ONE_IN < count:
        return text
    if hit >= drop_share * count:
        return None
    place = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : place[a][0]])
        at = place[b - 1][1]
    kept.append(text[at:])
    return "\n".join(kept)


def cut(automaton: Automaton, text: str, drop_share: float) -> str | None:
    """The text without its hit spans, until none is left; what a cut brings together may be a passage again."""
    while True:
        count, spans, _ = scan(automaton, text.encode("utf-8", "replace"))
        left = excise(text, count, spans, drop_share)
        if left is None or left == text:
            return left
        text = left


def remove_passages(df: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", drop_share: float = 0.5,
                    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents with benchmark spans cut out where they are contaminated; all columns stay.

    Hit spans of a contaminated document are removed, and its length column is brought up to date. If they hold half of
    its words or more, the document goes. Documents below the contamination limit, and null texts, stay untouched.

    A document is judged by the hits of the whole benchmark. Where that is several blocks, each round gathers the spans of all
    blocks, then cuts; documents that were cut go through another round.
    """
    blocks = automata(benchmark, item_col, item_text_col, window)
    if len(blocks) == 1:
        return df.mapInArrow(per_batch(_cutter(blocks[0], text_col, length_col, drop_share)), T.StructType(df.schema.fields))
    count, spans, going = fresh(df, "n_words"), fresh(df, "spans"), fresh(df, "going")
    state = df.select("*", F.lit(0).cast("long").alias(count), F.array().cast("array<long>").alias(spans), col(text_col).isNotNull().alias(going))
    while True:
        for block in blocks:
            state = written(state.mapInArrow(per_batch(_gatherer(block, text_col, count, spans, going)), state.schema), "spans")
        state = written(state.mapInArrow(per_batch(lambda: _excised(text_col, length_col, drop_share, count, spans, going)), state.schema), "cut")
        if state.where(col(going)).isEmpty():
            return state.drop(count, spans, going)


def _with_columns(batch: pa.RecordBatch, **new) -> pa.RecordBatch:
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([pa.array(new[n], batch.schema.field(n).type) if n in new else c for n, c in zip(names, batch.columns)], names)


def _gatherer(block, text_col: str, count: str, spans: str, going: str):
    """Adds a block's spans to those of the rows that are still going."""
    def start():
        automaton = block.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(*[batch.column(n).to_pylist() for n in (text_col, count, spans, going)])
            counts, found = [], []
            for text, n, old, on in rows:
                if on:
                    n, new, _ = scan(automaton, text.encode("utf-8", "replace"))
                    old = [x for span in merged([*zip(old[::2], old[1::2]), *new]) for x in span]
                counts.append(n)
                found.append(old)
            return _with_columns(batch, **{count: counts, spans: found})

        return step

    return start


def _excised(text_col: str, length_col: str | None, drop_share: float, count: str, spans: str, going: str):
    """Cuts the gathered spans; rows that changed go on."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(text_col).to_pylist()
        rows = zip(old, *[batch.column(n).to_pylist() for n in (count, spans, going)])
        new = [excise(t, n, list(zip(s[::2], s[1::2])), drop_share) if on else t for t, n, s, on in rows]
        changed = [n is not None and n != o for n, o in zip(new, old)]
        more = {text_col: new, going: changed, spans: [[]] * len(new)}
        if length_col in batch.schema.names:
            more[length_col] = [len(n) if c else g for n, c, g in zip(new, changed, batch.column(length_col).to_pylist())]
        return _with_columns(batch, **more).filter(pa.array([n is not None or o is None for n, o in zip(new, old)], pa.bool_()))

    return step


def _cutter(block, text_col: str, length_col: str | None, drop_share: float):
    def start():
        automaton = block.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            names = batch.schema.names
            at = names.index(text_col)
            old = batch.column(at).to_pylist()
            new = [cut(automaton, t, drop_share) if t is not None else None for t in old]
            gone = pa.array([n is not None or o is None for n, o in zip(new, old)], pa.bool_())
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.types[at])
            if length_col in names:
                i = names.index(length_col)
                given = batch.column(i).to_pylist()
                columns[i] = pa.array([len(n) if n is not None and n != o else g for n, o, g in zip(new, old, given)], batch.schema.types[i])
            return pa.RecordBatch.from_arrays(columns, names).filter(gone)

        return step

    return start
