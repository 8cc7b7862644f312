"""Runs of repetition in the words of a text, found through string synchronising sets at dyadic scales.

A run is a stretch of words with smallest period q that is at least MOST_PERIODS periods long and that no neighbouring word
extends. Periods of at least t and less than 2t words are looked for at scale t = 4, 8, 16, ...:

* Every stretch of t words has a hash. A position is synchronising if the least hash among the t + 1 stretches from it on
  is that of its first or its last one, so 2t words decide, and equal contexts of 2t words agree on it. Stretches whose own
  period is at most t / 4 are left out; they lie in runs found at smaller scales, which is how they are known here.
* A run of period q has a synchronising position among its first t words. Its context of 2t words next occurs at a
  synchronising position exactly q words on, as q < 2t. So only neighbours with equal contexts propose a period, their
  distance, and neighbouring proposals of one period are joined.
* A joined stretch ends at most t words from its run's ends, so t words at each side settle the run, and the words themselves
  are compared along it.

Periods below 4 are the highly periodic regions that the sets leave out: words are compared with those q further on.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm.common import col, keyed_texts, per_batch
from proofmark.llm.line_rules import bound, words

MOST_PERIODS = 4  # a run is at least so many periods long
LEAST_WORDS = 6
_FIRST_SCALE = 4
#: Words that are looked at together; a longer text is looked at alone.
_TOGETHER = 1 << 20

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, ends, periods


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pairs(hashes: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of stretches twice as long; the last ones, which would leave the array, are worth nothing."""
    after = np.zeros_like(hashes)
    after[:-apart or None] = hashes[apart:] if apart < len(hashes) else 0
    return _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + _mixed(after))


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i : i + width + 1] for each i, width a power of two; beyond the end counts as largest."""
    top = np.uint64(2**64 - 1)
    least, step = values.copy(), 1
    while step < width:
        least[:-step] = np.minimum(least[:-step], least[step:])
        step *= 2
    last = np.full(len(values), top)
    last[:-width or None] = values[width:]
    return np.minimum(least, last)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _small(words: np.ndarray, ends: np.ndarray) -> Runs:
    """Runs of periods below the first scale, at least MOST_PERIODS periods long whatever their length in words."""
    found = []
    n = len(words)
    for q in range(1, min(_FIRST_SCALE, n)):
        same = (words[:-q] == words[q:]) & (np.arange(q, n) < ends[:-q])
        starts, stops = _stretches(same)
        stops = stops + q
        long = stops - starts >= MOST_PERIODS * q
        starts, stops = starts[long], stops[long]
        if q > 1:  # a smaller period would be 1, as 2 and 3 are prime
            smaller = words[starts] == words[starts + 1]
            if q == 3:
                smaller &= words[starts] == words[starts + 2]
            starts, stops = starts[~smaller], stops[~smaller]
        found.append((starts, stops, np.full(len(starts), q)))
    return _together(found)


def _together(found: list[Runs]) -> Runs:
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(column).astype(np.int64) for column in zip((none, none, none), *found))


def _agreeing(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, room: np.ndarray, most: int) -> np.ndarray:
    """For each pair of positions, how many words agree going by `step`; at most `most`, and at most `room` of the pair."""
    agreed = np.zeros(len(a), dtype=np.int64)
    open_ = np.arange(len(a))
    done, width = 0, 8
    while len(open_) and done < most:
        width = min(width, most - done)
        ahead = done + np.arange(width)
        for part in np.array_split(open_, max(1, len(open_) * width >> 21)):
            inside = ahead[None, :] < room[part, None]
            at = np.where(inside, ahead[None, :] * step, 0)
            same = inside & (words[a[part, None] + at] == words[b[part, None] + at])
            agreed[part] += np.where(same.all(axis=1), width, same.argmin(axis=1))
        done += width
        open_ = open_[agreed[open_] == done]
        width *= 2
    return agreed


def _at_scale(words: np.ndarray, first: np.ndarray, ends: np.ndarray, hashes: np.ndarray, context: np.ndarray, scale: int, periodic: np.ndarray) -> Runs:
    """Runs whose period is at least `scale` and less than twice that."""
    n = len(words)
    place = np.arange(n)
    top = np.uint64(2**64 - 1)
    ids = np.where(periodic | (place + scale > ends), top, hashes)
    least = _least_ahead(ids, scale)
    last = np.full(n, top)
    last[:-scale or None] = ids[scale:]
    chosen = np.flatnonzero((place + 2 * scale <= ends) & (least < top) & ((least == ids) | (least == last)))
    order = chosen[np.argsort(context[chosen], kind="stable")]
    near = (context[order[1:]] == context[order[:-1]]) & (order[1:] - order[:-1] < 2 * scale) & (order[1:] - order[:-1] >= scale)
    near &= ends[order[1:]] == ends[order[:-1]]
    at, period = order[:-1][near], (order[1:] - order[:-1])[near]
    if not len(at):
        return _together([])
    # Proposals of one period whose stretches share a period's words are of one run.
    by = np.lexsort((at, period))
    at, period = at[by], period[by]
    new = np.concatenate(([True], (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * scale)))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    start, period, stop = at[heads], period[heads], at[tails] + 2 * scale + period[heads]
    back = _agreeing(words, start - 1, start - 1 + period, -1, start - first[start], scale)
    on = _agreeing(words, np.minimum(stop, n - 1) - period, np.minimum(stop, n - 1), 1, ends[start] - stop, scale)
    start, stop = start - back, stop + on
    long = stop - start >= MOST_PERIODS * period
    start, stop, period = start[long], stop[long], period[long]
    # Contexts are equal by their hashes so far: the words decide.
    sure = np.fromiter((np.array_equal(words[a : b - q], words[a + q : b]) for a, b, q in zip(start, stop, period)), dtype=bool, count=len(start))
    return start[sure], stop[sure], period[sure]


def _covered(n: int, found: Runs, scale: int) -> np.ndarray:
    """Positions from which a stretch of `scale` words lies in a run of period at most scale / 4."""
    starts, ends, periods = found
    inside = (periods * 4 <= scale) & (ends - starts >= scale)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts[inside], 1)
    np.add.at(change, ends[inside] - scale + 1, -1)
    return np.cumsum(change[:n]) > 0


def runs_of(texts: list[np.ndarray], together: int = _TOGETHER) -> list[np.ndarray]:
    """For each text, given as numbers of its words, its runs as rows (start, length, period) by start, then period."""
    found: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= together):
            size, end = size + len(texts[end]), end + 1
        found += _runs_of_some(texts[at:end])
        at = end
    return found


def _runs_of_some(texts: list[np.ndarray]) -> list[np.ndarray]:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.concatenate(texts).astype(np.int64)
    opens = np.cumsum(sizes) - sizes
    # What is still looked at: positions of the words kept, and where their texts begin and end among them.
    first, ends = np.repeat(opens, sizes), np.repeat(opens + sizes, sizes)
    origin = np.arange(len(words))
    parts = [_small(words, ends)]
    all_runs = parts[0]  # among the words kept
    hashes, scale, kept_words = _mixed(words.astype(np.uint64) + np.uint64(1)), 1, words
    while scale < _FIRST_SCALE:
        hashes, scale = _pairs(hashes, scale), scale * 2
    while True:
        long = ends - first >= MOST_PERIODS * scale
        if not long.any():
            break
        if not long.all():
            moved = np.cumsum(long) - long
            keep_runs = long[all_runs[0]]
            shift = lambda x: moved[x - 1] + 1  # noqa: E731 - ends lie behind a kept word
            all_runs = (moved[all_runs[0][keep_runs]], shift(all_runs[1][keep_runs]), all_runs[2][keep_runs])
            first, ends, origin, hashes, kept_words = moved[first[long]], shift(ends[long]), origin[long], hashes[long], kept_words[long]
        context = _pairs(hashes, scale)
        new = _at_scale(kept_words, first, ends, hashes, context, scale, _covered(len(kept_words), all_runs, scale))
        all_runs = _together([all_runs, new])
        parts.append((origin[new[0]], origin[new[1] - 1] + 1, new[2]))
        hashes, scale = context, scale * 2
    starts, stops, periods = _together(parts)
    enough = stops - starts >= LEAST_WORDS
    starts, stops, periods = starts[enough], stops[enough], periods[enough]
    order = np.lexsort((periods, starts))
    starts, stops, periods = starts[order], stops[order], periods[order]
    cut = np.searchsorted(starts, np.append(opens, len(words)))
    return [np.stack([starts[a:b] - o, (stops - starts)[a:b], periods[a:b]], axis=1) for a, b, o in zip(cut, cut[1:], opens)]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words but for those that some run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    runs is an array of (start, length, period) in words, by start, then period; collapsed is the text without what repeats
    a run's first period, words joined by one space. Words are separated by ASCII white space. A null, empty or blank text
    has no words, no runs and an empty collapsed text. Repeated rows, null ids and an empty table pass through as they are;
    other columns are not read. Each text is one row's own work, whole, in time and memory that follow its length.
    """
    entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [body.as_py().split() for body in batch.column(1)]
            number = defaultdict(count().__next__)
            flat = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), dtype=np.int64)
            sizes = [len(t) for t in texts]
            found = runs_of(np.split(flat, np.cumsum(sizes)[:-1]))
            table = np.concatenate(found)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in found]))), pa.int32())
            structs = pa.StructArray.from_arrays([pa.array(table[:, k], pa.int64()) for k in range(3)], fields=list(entry))
            left = [b" ".join(collapsed(t, f)).decode("utf-8", "replace") for t, f in zip(texts, found)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, structs), pa.array(left, pa.string())],
                ["id", "n_words", "runs", "collapsed"],
            )

        return step

    rows = keyed_texts(df, id_col, text_col)
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string(fields).fields])
    return rows.mapInArrow(per_batch(start), schema).withColumnRenamed("id", id_col)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period."""
    best = F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.get(best, F.lit(0))


def with_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text) where every tenth text, by the hash of its id, goes over into repeating a part of itself.

    h is the CRC-32 of the id's decimal digits and g = h // 10. If h % 10 = 0, words from a = g % n on become a repetition
    of the p = 1 + (n - a) // (3 + g % 8) words from there. A null id or a text without words changes nothing.
    """
    h = F.crc32(col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        a = F.pmod(g, F.greatest(n, F.lit(1)).cast("long")).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        often = F.ceil((n - a) / p).cast("int")
        # Every part is one slice, so the text is gone over a few times however long it is.
        longer = F.concat(F.slice(ws, 1, a), F.flatten(F.array_repeat(F.slice(ws, a + 1, p), often)))
        return F.when(n > 0, F.array_join(F.slice(longer, 1, n), " "))

    planted = bound(words(col(text_col).cast("string")), repeated)
    return df.select(col(id_col).alias(id_col), F.when(F.pmod(h, F.lit(10)) == 0, planted).otherwise(col(text_col).cast("string")).alias(text_col))
