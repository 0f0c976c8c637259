"""Maximal periodic runs of words, by string synchronising sets.

A run is a stretch of words with smallest period q, at least ``REPEATS`` periods
and ``LEAST_WORDS`` words long, that can't be extended. Words become numbers, and
all texts of a chunk one row of numbers, each text followed by a number of its
own that ends every run.

Periods below ``SMALL``: the row is compared with itself, shifted. Longer ones go
by dyadic scales t = 8, 16, ...; the scale t serves periods from t to 2t - 1. Each
position has the hash of its next t words; the synchronising set holds the
positions where the least hash of the t + 1 places from there is the first or
the last of them. Whether a position belongs depends on its next 2t words only,
so a run repeats its synchronising positions each period. Positions with equal
next 2t words that follow one another so propose their distance as a period, and
comparing words to both sides from there gives the run or refutes it.

Windows of t words with a period up to t / 4 would fill the set. They are left
out of it: such windows lie in runs with small periods, which were detected
separately, at lower scales. What is left finds every run:

* a stretch of 3t - 1 words in a run of period q >= t can't have a period up to
  t / 4 (it would be the run's period), so among its first t positions one is in
  the set; a run of 4q words holds such a position, the one q later and the next
  2t words of both;
* no position between the two has the same next 2t words: their distance would
  be a smaller period of the run (Fine and Wilf, as 2t > q).

Hashes have 64 bits. A proposed period is checked word by word, so no run is
wrong, and runs don't depend on which positions the hashes select.

The work is one pass over the texts without a shuffle, for a text of n words
about n log n steps, and chunks bound the memory by the longest text.

Defined results: a null text, and one without words, has no runs and collapses
to the empty string. Repeated rows and rows without an id each get their result;
an empty table gives an empty table; further columns are left out. Whole texts
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import forget_state, renamed, small_batches, text_chunks

REPEATS, LEAST_WORDS = 4, 6
#: Periods below are found by direct comparison; also the first scale. A power of two.
SMALL = 8
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _C
    x ^= x >> np.uint64(29)
    return x


def _doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of 2t words from those of t words."""
    return _mixed(h[:-t] * _A + h[t:] * _B)


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` + 1 places from each one on; ``width`` is a power of two."""
    t = 1
    while t < width:
        x = np.minimum(x[:-t], x[t:])
        t *= 2
    return np.minimum(x[:-1], x[1:])


def _extended(words: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch with period ``q`` around ``i``, as begin and end."""
    end, step = i, 4 * q
    while True:
        a, b = words[end : end + step], words[end + q : end + q + step]
        off = np.flatnonzero(a[: len(b)] != b)
        if len(off):
            end += int(off[0])
            break
        if len(b) < step:
            end += len(b)
            break
        end += step
        step *= 2
    begin, step = i, 4 * q
    while begin:
        low = max(0, begin - step)
        off = np.flatnonzero(words[low:begin] != words[low + q : begin + q])
        if len(off):
            begin = low + int(off[-1]) + 1
            break
        begin, step = low, step * 2
    return begin, end + q


def _small_runs(words: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """begin, end, period of all runs with periods below SMALL."""
    found = []
    for q in range(1, min(SMALL, len(words))):
        edges = np.flatnonzero(np.diff(np.concatenate(([False], words[:-q] == words[q:], [False]))))
        begin, end = edges[::2], edges[1::2] + q
        long = end - begin >= REPEATS * q
        found.append((begin[long], end[long], np.full(int(long.sum()), q)))
    if not found:
        return []
    begin, end, period = map(np.concatenate, zip(*found, strict=True))
    # a stretch with a smaller period too was found with that first: then both have the same ends
    _, first = np.unique(np.stack([begin, end], axis=1), axis=0, return_index=True)
    return [(begin[first], end[first], period[first])]


def _scale_runs(words: np.ndarray, h: np.ndarray, context: np.ndarray, t: int, regions: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """begin, end, period of all runs with periods from ``t`` to 2t - 1; ``regions`` are all runs with smaller ones."""
    begin, end, period = regions
    high = (period * REPEATS <= t) & (end - begin >= t)
    cover = np.zeros(len(h) + 1, dtype=np.int32)
    np.add.at(cover, begin[high], 1)
    np.add.at(cover, end[high] - t + 1, -1)
    ids = np.where(np.cumsum(cover[:-1]) > 0, _NONE, h)
    least = _least_of(ids, t)
    sync = np.flatnonzero(((least == ids[:-t]) | (least == ids[t:])) & (least != _NONE))
    same = context[sync]
    order = np.argsort(same, kind="stable")
    place, same = sync[order], same[order]
    distance = np.diff(place)
    proposed = (same[1:] == same[:-1]) & (distance >= t) & (distance < 2 * t)
    at, q = place[:-1][proposed], distance[proposed]
    by = np.lexsort((at, q))
    found, last, until = [], -1, -1
    for i, p in zip(at[by].tolist(), q[by].tolist(), strict=True):
        if p == last and i + p < until:
            continue  # in the stretch just looked at
        start, until = _extended(words, i, p)
        last = p
        if until - start >= REPEATS * p:
            found.append((start, until, p))
    return tuple(np.array(found, dtype=np.int64).reshape(-1, 3).T)


def find_runs(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, start, length, period of all runs of some texts, by text, start and period.

    ``words`` holds the texts' words as numbers of at least 0, one text after the other.
    """
    texts = np.arange(len(lengths))
    ends = np.cumsum(lengths + 1)
    row = np.empty(len(words) + len(lengths), dtype=np.int64)
    mark = np.ones(len(row), dtype=bool)
    mark[ends - 1] = False
    row[mark] = words
    row[ends - 1] = -1 - texts
    begins = ends - lengths - 1
    small = _small_runs(row)
    # text, start, end, period within the text
    runs = np.concatenate([np.stack([(k := np.searchsorted(begins, b, "right") - 1), b - begins[k], e - begins[k], p]) for b, e, p in small] or [np.empty((4, 0), dtype=np.int64)], axis=1).astype(np.int64)
    with np.errstate(over="ignore"):
        h, t = _mixed((row + (1 << 32)).astype(np.uint64) * _A), 1
        while t < SMALL and len(h) > t:
            h, t = _doubled(h, t), t * 2
        while True:
            alive = lengths >= REPEATS * t  # a shorter text has no room for a run of this scale
            if not alive.any():
                break
            if not alive.all():
                keep = np.repeat(alive, lengths + 1)
                row, h = row[keep], h[keep[: len(h)]]
                texts, lengths = texts[alive], lengths[alive]
            begins = np.cumsum(lengths + 1) - lengths - 1
            context = _doubled(h, t)
            here = np.isin(runs[0], texts)
            base = begins[np.searchsorted(texts, runs[0, here])]
            begin, end, period = _scale_runs(row, h[: len(row) - t + 1], context, t, (base + runs[1, here], base + runs[2, here], runs[3, here]))
            k = np.searchsorted(begins, begin, "right") - 1
            runs = np.concatenate([runs, np.stack([texts[k], begin - begins[k], end - begins[k], period])], axis=1)
            h, t = context, t * 2
    text, start, end, period = runs[:, runs[2] - runs[1] >= LEAST_WORDS]
    order = np.lexsort((period, start, text))
    return text[order], start[order], (end - start)[order], period[order]


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and their number in each; words end at space, tab, line feed, \\x0b, \\x0c and return."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    full = pc.greater(pc.binary_length(lists.flatten()), 0)
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    return lists.flatten().filter(full), np.diff(before[ends])


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(lengths))), type=pa.int32())


def runs_and_rest(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    words, lengths = _split(texts)
    text, start, length, period = find_runs(words.dictionary_encode().indices.to_numpy().astype(np.int64), lengths)
    begins = np.cumsum(lengths) - lengths
    cover = np.zeros(len(words) + 1, dtype=np.int32)  # what comes after the first period of a run goes
    np.add.at(cover, begins[text] + start + period, 1)
    np.add.at(cover, begins[text] + start + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    before = np.concatenate(([0], np.cumsum(kept)))
    left = np.diff(before[np.concatenate(([0], np.cumsum(lengths)))])
    rest = pc.binary_join(pa.ListArray.from_arrays(_offsets(left), words.filter(pa.array(kept))), " ")
    each = pa.StructArray.from_arrays([pa.array(c, type=pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    return lengths, pa.ListArray.from_arrays(_offsets(np.bincount(text, minlength=len(lengths))), each), rest


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row.

    ``collapsed`` is the text's words, joined by one space, without those that a run holds after its first period.
    """
    rows = renamed(docs, doc_id=id_col, text=text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for batch in small_batches(batches):
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in text_chunks([range(n) for n in sizes]):
                part = batch.slice(a, b - a)
                n_words, runs, rest = runs_and_rest(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, type=pa.int64()), runs, rest], names=["doc_id", "n_words", "runs", "collapsed"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(find, f"doc_id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
