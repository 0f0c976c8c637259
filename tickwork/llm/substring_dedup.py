"""Passages that repeat across documents, by compact windows.

A document is a row of five-word shingles. For each hash function, the Cartesian
tree over the shingles' hashes gives its compact windows (l, c, r): all
subsequences within [l, r] of a least length that hold c have their min-hash at
c. They stand for every long enough subsequence of the document, in about twice
as many windows as it has disjoint passages.

Documents meet where the text at a min-hash is equal: each window offers the
``SNIPPET`` shingles that begin at c and those that end there, as far as they
lie in it; a passage that two documents share has one of them inside. The first
document of a group is its representative. Members are paired with it, not with
each other; hits of all windows with the same offset make one
interval of a pair, which is verified once: in some stretch of ``min_words``
words the shingles' similarity must reach ``similarity``, where a shingle may be
displaced by a few words. Members of a group of three and more may share a passage
that the representative lacks: where one of them isn't covered by a span verified with
it, all are compared by keys that need no pairs, of equal words and of words with one
changed, added or left out (see ``tails`` and ``edits``).

Groups therefore cost as many rows as they have members, however many that are.

Defined results: words are separated by ASCII white space, A-Z count as a-z;
null and short texts have no passage; rows with equal doc_id and text are one
document, and a repeat must be in another one; null doc_ids are ids like others;
an empty table gives an empty table; further columns are left out. Whole texts
are read. Repeats within one document aren't looked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.llm.common import batch_of, renamed, written
from tickwork.sinks.scratch import drop_scratch, scratch_mark

WORDS = 5
#: Places from one stretch to the next around a hit that is grouped again.
STEP = 6
#: By how many words a shingle may be displaced in a near-duplicate.
DRIFT = 8
#: Tables that decide what is looked at are broadcast up to this size in memory, else joined by shuffling.
BROADCAST_BYTES = 256 << 20
#: Size of a Bloom filter of keys, at most.
BLOOM_BITS = 1 << 28
#: Windows that are edited at a time.
EDITED = 4096

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, dtype=np.uint64))
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEEDS = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


#: Marks of shingles, and the bits of a hash that aren't used for them.
_MARKS, _MARK_SHIFT = 1 << 18, np.uint64(46)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A signed 32-bit hash of each word of the texts that lie between ``bounds``, and how many words lie before each bound."""
    inside = ~_SPACE[raw]
    fresh = np.ones(len(raw) + 1, dtype=bool)  # where the text before has ended
    fresh[1:-1] = ~inside[:-1]
    fresh[bounds] = True
    begin = np.flatnonzero(inside & fresh[:-1])
    if not len(begin):
        return np.empty(0, dtype=np.int32), np.zeros(len(bounds), dtype=np.int64)
    last = np.ones(len(raw), dtype=bool)
    last[:-1] = ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(raw))]
    last[cut - 1] = True
    size = np.flatnonzero(inside & last) + 1 - begin
    first = np.cumsum(size) - size
    letters = _LOWER[raw[inside]] + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(first, size)
    sums = np.add.reduceat(letters * _POWERS[place & 1023], first)
    return (_mix(sums) >> np.uint64(32)).astype(np.uint32).view(np.int32), np.searchsorted(begin, bounds)


def word_hashes(text: str | None) -> np.ndarray:
    """A signed 32-bit hash of each word."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return _words_of(raw, np.array([0, len(raw)]))[0]


def _hashed_texts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, words and their bounds of as many rows in a row as have about ``limit`` bytes (one at least)."""
    column = column.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    k = 0
    while k < len(column):
        to = max(k + 1, int(np.searchsorted(ends, ends[k] + limit, side="right")) - 1)
        yield k, *_words_of(raw[ends[k] : ends[to]], ends[k : to + 1] - ends[k])
        k = to


def shingles(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``WORDS`` words in a row."""
    n = len(words) - WORDS + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    w = words.view(np.uint32).astype(np.uint64)
    return _mix(sum((w[k + 1 : k + 1 + n] * _POWERS[k + 1] for k in range(WORDS - 1)), w[:n] * _POWERS[0]))


def _reach(hashed: np.ndarray, first: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How far to the left and right each place is the minimum, up to ``most`` places and within [first, last]; of equal minima the left one is."""
    left, right = np.zeros(len(hashed), dtype=np.int64), np.zeros(len(hashed), dtype=np.int64)
    for reach, sign, bound in ((left, -1, first), (right, 1, last)):
        at = np.arange(len(hashed))
        for d in range(1, most + 1):
            at = at[(at - d >= bound[at]) if sign < 0 else (at + d <= bound[at])]
            at = at[(hashed[at - d] > hashed[at]) if sign < 0 else (hashed[at + d] >= hashed[at])]
            if not len(at):
                break
            reach[at] = d
    return left, right


def compact_windows(hashed: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(l, c, r) of the Cartesian tree's nodes that span ``least`` places or more; of equal minima the left one is above."""
    n = len(hashed)
    left, right = _reach(hashed, np.zeros(n, dtype=np.int64), np.full(n, n - 1), n)
    return [(int(c - left[c]), int(c), int(c + right[c])) for c in np.flatnonzero(left + right + 1 >= least)]


def snippets(words: np.ndarray, bounds: np.ndarray, least: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and hash of the text offered by all windows of ``run`` shingles of texts with ``least`` or more.

    Of any ``run`` shingles in a row, the least hash has (run + 1) // 2 beside it: those that begin or those that end there.
    """
    n = (run + 1) // 2
    size = np.diff(bounds) - WORDS + 1
    which = np.flatnonzero(size >= least)
    if not len(which):
        return (np.empty(0, dtype=np.int64),) * 3
    size, s = size[which], shingles(words)
    first = np.cumsum(size) - size
    text = np.repeat(np.arange(len(which)), size)
    own = np.arange(len(text)) - first[text]
    s = s[bounds[which][text] + own]
    left, right = _reach(_mix(s ^ _SEEDS[0]), first[text], (first + size - 1)[text], run - 1)
    node = np.flatnonzero(left + right + 1 >= run)
    at = np.unique(np.concatenate([node[right[node] >= n - 1], node[left[node] >= n - 1] - n + 1]))
    parts = sorted({*range(0, n, WORDS), n - 1})
    key = _mix(sum(s[at + k] * _POWERS[k + 1] for k in parts[1:]) + s[at] * _SEEDS[1])
    return which[text[at]], own[at], key.view(np.int64)


def repeated_stretches(own: tuple, other: tuple, shift: np.ndarray, least: int, enough: int) -> tuple[np.ndarray, ...]:
    """Pair, start, end, start and end in ``other``, in words, of stretches of ``own`` that ``other`` has at ``shift`` places less.

    ``own`` and ``other``: the words of all pairs one after the other, and their bounds.
    """
    (words, bounds), (there_words, there_bounds) = own, other
    size, there_size = (np.maximum(np.diff(x) - WORDS + 1, 0) for x in (bounds, there_bounds))
    size[there_size < least] = 0
    size[size < least] = 0
    pair = np.repeat(np.arange(len(size)), size)
    if not len(pair):
        return (np.empty(0, dtype=np.int64),) * 5
    begin = np.cumsum(size) - size
    place = np.arange(len(pair)) - begin[pair]
    salt = _mix(np.arange(len(size), dtype=np.uint64) * _SEEDS[3])  # a shingle of one pair equals none of another
    a, b = shingles(words)[bounds[:-1][pair] + place] + salt[pair], shingles(there_words)
    of = np.repeat(np.arange(len(size)), np.diff(there_bounds))[: len(b)]
    whole = np.arange(len(b)) - there_bounds[of] < there_size[of]
    b[whole] += salt[of[whole]]
    none = _SEEDS[:1]
    b, there = np.concatenate([none, b, none]), there_bounds[pair] + place - shift[pair] + 1
    equal = b.take(there, mode="clip") == a
    # what the other text has nowhere needn't be looked for at each place
    anywhere = np.zeros(_MARKS, dtype=bool)
    anywhere[b >> _MARK_SHIFT] = True
    todo = np.flatnonzero(~equal)
    todo = todo[anywhere[a[todo] >> _MARK_SHIFT]]
    sought, there, near = a[todo], there[todo], np.zeros(len(todo), dtype=bool)
    for d in (*range(-DRIFT, 0), *range(1, DRIFT + 1)):
        near |= b.take(there + d, mode="clip") == sought
    equal[todo[near]] = True
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[least:] - total[:-least] >= enough)
    good = good[place[good] + least <= size[pair[good]]]
    if not len(good):
        return (np.empty(0, dtype=np.int64),) * 5
    new = np.flatnonzero((np.diff(good) > least) | (np.diff(pair[good]) > 0)) + 1
    first, last = good[np.concatenate([[0], new])], good[np.concatenate([new - 1, [len(good) - 1]])]
    hit, which = np.flatnonzero(equal), pair[first]
    start = hit[np.searchsorted(hit, first)] - begin[which]
    end = hit[np.searchsorted(hit, last + least) - 1] - begin[which] + WORDS
    there_length = np.diff(there_bounds)[which]
    return which, start, end, np.maximum(0, start - shift[which]), np.minimum(there_length, np.maximum(0, end - shift[which]))


def _within(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written table, to be broadcast if its size allows; ``row_bytes`` is what a row takes there as measured."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _key(doc_id: Column, text: Column) -> Column:
    """Identity of a document: its id and text."""
    return F.xxhash64(doc_id, text)


def offer(texts: DataFrame, least: int, run: int) -> DataFrame:
    """snippet, doc, at, again: what all windows of all texts offer; ``again`` if the document has the same before."""
    schema = pa.schema([("snippet", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("again", pa.bool_())])

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for k, words, bounds in _hashed_texts(batch.column(1)):
                text, at, key = snippets(words, bounds, least, run)
                if len(at):
                    again = np.ones(len(at), dtype=bool)
                    again[_first_of(text, key)] = False
                    yield batch_of(schema, key, docs[k + text], at.astype(np.int32), again)

    return texts.select("doc", "text").mapInArrow(offered, "snippet long, doc long, at int, again boolean")


def hashed_words(texts: DataFrame) -> DataFrame:
    """doc, words."""
    schema = pa.schema([("doc", pa.int64()), ("words", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, words, bounds in _hashed_texts(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(words, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[k : k + len(lists)], lists], schema=schema)

    return texts.select("doc", "text").mapInArrow(run, "doc long, words array<int>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists one after the other, and their bounds."""
    values, bounds = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return values.to_numpy(zero_copy_only=False).astype(np.int32, copy=False), bounds.astype(np.int64)


def verify(pairs: DataFrame, least: int, enough: int) -> DataFrame:
    """doc, start, end, source of the verified stretches of pairs, in both documents.

    ``pairs``: doc, source, from, source_from (where their words begin), shift, words, source_words.
    """
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = np.cumsum(whole.column(5).value_lengths().to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(size // 40_000)) + 1
            for k, to in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
                batch = whole.slice(k, to - k)
                doc, source, begin, source_begin, shift = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:5])
                pair, a, b, x, y = repeated_stretches(_lists(batch.column(5)), _lists(batch.column(6)), shift - begin + source_begin, least, enough)
                if len(pair):
                    both = [np.concatenate(c) for c in ((doc[pair], source[pair]), (begin[pair] + a, source_begin[pair] + x), (begin[pair] + b, source_begin[pair] + y), (source[pair], source[pair]))]
                    yield batch_of(schema, *both)

    return pairs.mapInArrow(run, "doc long, start long, end long, source long")


@contextmanager
def _sifted(*groups: DataFrame) -> Iterator[None]:
    """Within, rows that are joined with these keys pass Spark's Bloom filters of them before they are shuffled."""
    conf, n = groups[0].sparkSession.conf, max(g.count() for g in groups)
    bits = min(max(16 * n, 1 << 20), BLOOM_BITS)
    of = "spark.sql.optimizer.runtime.bloomFilter."
    own = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "100g", "expectedNumItems": max(n, 1), "maxNumItems": max(n, 1), "numBits": bits, "maxNumBits": bits}
    before = {k: conf.get(of + k, None) for k in own}
    try:
        for k, v in own.items():
            conf.set(of + k, str(v))
        yield
    finally:
        for k, v in before.items():
            conf.unset(of + k) if v is None else conf.set(of + k, v)


def _joined(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` with what is known of their groups (written; n rows each): large groups by broadcast, the rest by shuffling.

    Groups with more than a millionth of all rows are a million at most; no other one fills a task.
    """
    many = max(1000, rows.count() // 1_000_000)
    large = F.broadcast(groups.where(F.col("n") > many))
    return rows.join(large, key).unionByName(rows.join(groups.where(F.col("n") <= many), key))


def _with_words(pairs: DataFrame, words: DataFrame, margin: int, snippet: int) -> DataFrame:
    """What verify() takes, from doc, source, at, shift: hits with the same shift make one interval of a pair."""
    pairs = pairs.groupBy("doc", "source", "shift").agg(F.greatest(F.min("at") - margin, F.lit(0)).alias("from"), (F.max("at") + margin + snippet).alias("to"))
    pairs = pairs.join(words, "doc").select("doc", "source", "shift", "from", "to", F.slice("words", F.col("from") + 1, F.col("to") - F.col("from")).alias("words"))
    pairs = pairs.withColumn("source_from", F.greatest(F.col("from") - F.col("shift"), F.lit(0))).join(words.select(F.col("doc").alias("source"), F.col("words").alias("all")), "source")
    return pairs.select("doc", "source", "from", "source_from", "shift", "words", F.slice("all", F.col("source_from") + 1, F.greatest(F.col("to") - F.col("shift") - F.col("source_from"), F.lit(0))).alias("source_words"))


class _Pieces:
    """Hashes of pieces of texts that stand one after the other, from sums over all words before a place.

    Read forward (side 0), the k-th word of a piece counts with the k-th power of an odd number, whatever stands before it;
    read backward (side 1), the k-th from its end does. Odd numbers have inverses, so a piece costs two places.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        own = words.view(np.uint32).astype(np.uint64)
        self.up, self.down = (np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(n, x, dtype=np.uint64))]) for x in (_POWERS[0], _INVERSE))
        self.sums = [np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(own * x)]) for x in (self.up[1:], self.down[:-1])]

    def at(self, side: int, place: np.ndarray, length) -> np.ndarray:
        """A 64-bit hash of each piece of ``length`` words that begins at ``place``; side 1: that ends there, in reverse order."""
        a, b, unit = (place - length, place, self.up) if side else (place, place + length, self.down)
        return _mix((self.sums[side][b] - self.sums[side][a]) * unit[place])


def _text_parts(batches: Iterator[pa.RecordBatch], limit: int = 50_000) -> Iterator[tuple[np.ndarray, list, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, the fields of their listed items, the items' rows, words and their bounds of about ``limit`` words (one row at least).

    ``batches``: doc, a list of items (numbers or structs), words.
    """
    for whole in batches:
        size = np.cumsum(whole.column(2).value_lengths().to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(np.diff(size // limit)) + 1
        for k, to in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
            part = whole.slice(k, to - k)
            items = part.column(1).flatten()
            fields = [f.to_numpy(zero_copy_only=False) for f in (items.flatten() if pa.types.is_struct(items.type) else [items])]
            row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
            yield part.column(0).to_numpy(zero_copy_only=False), fields, row, *_lists(part.column(2))


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """The first place of each combination of values."""
    order = np.lexsort(keys[::-1])
    fresh = np.ones(len(order), dtype=bool)
    if len(order):
        fresh[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    return order[fresh]


def stretches(rows: DataFrame, half: int, snippet: int, around: int) -> DataFrame:
    """stretch, doc, start, covered, own: text around the hits of each document, at every ``STEP``-th place from them.

    Any ``half`` words around a snippet of ``snippet`` words hold one of its stretches, with fewer than ``STEP`` words
    before it. A stretch counts for the source that its hit was found with. One is covered where such words, with
    ``around`` more before and after them, lie in a span that was verified with this source; the source's own is.
    ``rows``: doc, hits (at, start and end of the span, source, shift), words.
    """
    schema = pa.schema([("stretch", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("covered", pa.bool_()), ("own", pa.bool_())])
    length = half - STEP + 1
    before = np.arange(0, half - snippet + 1, STEP, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, hits, row, words, bounds in _text_parts(batches):
            start = (hits[0][:, None] - before).ravel()
            row, begin, end, source, shift = (np.repeat(f, len(before)) for f in (row, *hits[1:]))
            size = np.diff(bounds)[row]
            own = (source == doc[row]) & (shift == 0)
            covered = own | ((begin <= np.maximum(start - STEP + 1 - around, 0)) & (end >= np.minimum(start + half + around, size)))
            fits = (start >= 0) & (start + length <= size)
            start, row, covered, own = start[fits], row[fits], covered[fits], own[fits]
            key = _mix(_Pieces(words).at(0, bounds[row] + start, length) + source[fits].view(np.uint64) * _SEEDS[2]).view(np.int64)
            order = np.lexsort((own, covered))  # of equal ones the least covered
            first = order[_first_of(row[order], start[order], key[order])]
            yield batch_of(schema, key[first], doc[row[first]], start[first], covered[first], own[first])

    return rows.mapInArrow(run, "stretch long, doc long, start int, covered boolean, own boolean")


def halves(rows: DataFrame, half: int, whole: int, rest: int) -> DataFrame:
    """window, doc, start, end, side, again: all ``half`` words that hold one of a document's stretches, with up to
    ``rest + 1`` words that follow them (side 0) or go before them (side 1, in reverse order); ``again`` if the document
    has the same ones before. ``rows``: doc, starts, words.
    """
    schema = pa.schema([("window", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("side", pa.int8()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, (starts,), row, words, bounds in _text_parts(batches):
            own = (starts[:, None] - np.arange(STEP, dtype=np.int32)).ravel()
            row = np.repeat(row, STEP)
            fits = (own >= 0) & (own + half <= np.diff(bounds)[row])
            place = np.unique(bounds[row[fits]] + own[fits])
            row = np.searchsorted(bounds, place, side="right") - 1
            pieces = _Pieces(words)
            for side in (0, 1):
                more = np.minimum(place - bounds[row] if side else bounds[row + 1] - half - place, rest + 1)
                fits = more >= (rest if side else min(rest, whole - half))
                at, more, k = place[fits], more[fits], row[fits]
                begin, inner = (at + half, at) if side else (at, at + half)
                key = pieces.at(side, begin, half) ^ _SEEDS[side]
                window = _mix(key * _SEEDS[3] + pieces.at(side, inner, more) + more.view(np.uint64))
                start = at - bounds[k] - (more if side else 0)
                again = np.ones(len(at), dtype=bool)
                again[_first_of(k, window)] = False
                yield batch_of(schema, window.view(np.int64), doc[k], start, start + half + more, np.full(len(at), side), again)

    return rows.mapInArrow(run, "window long, doc long, start int, end int, side tinyint, again boolean")


def tails(rows: DataFrame, half: int, whole: int, rest: int) -> DataFrame:
    """key, kind, doc, start, end, side: what documents with nearly equal windows have in common.

    Of kind 0 the first ``whole`` words (side 0 only); of kind 1 the half and the last ``WORDS`` of all ``rest + 1`` words
    after it, of kind 2 the half and those of ``rest`` words, if there are as many. ``rows``: doc, at (start, end, side),
    words.
    """
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int8()), ("doc", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("side", pa.int8())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, (starts, ends, sides), row, words, bounds in _text_parts(batches):
            pieces = _Pieces(words)
            for side, sign in ((0, 1), (1, -1)):
                mine = np.flatnonzero(sides == side)
                start, end, k = starts[mine], ends[mine], row[mine]
                place = bounds[k] + (end if side else start)
                key = pieces.at(side, place, half) ^ _SEEDS[side]

                def made(kind, which, found, k=k, start=start, end=end, side=side):
                    return batch_of(schema, found.view(np.int64), np.full(len(found), kind), doc[k[which]], start[which], end[which], np.full(len(found), side))

                if side == 0:
                    yield made(0, slice(None), _mix(key * _SEEDS[2] + pieces.at(0, place + half, whole - half)))
                for kind, m in ((1, rest + 1), (2, rest)) if rest >= WORDS else ():
                    which = end - start - half >= m
                    yield made(kind, which, _mix(key[which] + pieces.at(side, place[which] + sign * (half + m - WORDS), WORDS)))

    return rows.mapInArrow(run, "key long, kind tinyint, doc long, start int, end int, side tinyint")


def edits(rows: DataFrame, half: int, rest: int) -> DataFrame:
    """key, doc, start, end: ``half`` words and ``rest`` more, and with one more less one word at each place in turn.

    Documents with a key in common have equal words but for one that one of them has more, or that is another one.
    ``rows``: doc, at (start, end, side, whether less one word, whether as they are), words.
    """
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, (starts, ends, sides, less, plain), row, words, bounds in _text_parts(batches):
            pieces = _Pieces(words)
            for side, sign in ((0, 1), (1, -1)):

                def made(which, length, key, side=side):
                    times = len(key) // max(1, len(which))
                    start = ends[which] - length if side else starts[which]
                    return batch_of(schema, key.view(np.int64), *(np.repeat(x, times) for x in (doc[row[which]], start, start + length)))

                of = lambda which, side=side: bounds[row[which]] + (ends if side else starts)[which]
                which = np.flatnonzero((sides == side) & plain)
                place = of(which)
                yield made(which, half + rest, _mix((pieces.at(side, place, half) ^ _SEEDS[side]) + pieces.at(side, place + sign * half, rest)))
                for which in np.array_split(np.flatnonzero((sides == side) & less), 1 + len(starts) // EDITED):
                    place = of(which)
                    key = pieces.at(side, place, half) ^ _SEEDS[side]
                    own = words.view(np.uint32)[place[:, None] + sign * (half + np.arange(rest + 1)) - side].astype(np.uint64)
                    head = np.cumsum(own * _POWERS[: rest + 1], axis=1)
                    tail = np.cumsum((own[:, 1:] * _POWERS[:rest])[:, ::-1], axis=1)[:, ::-1]
                    tail[:, 1:] += head[:, : rest - 1]
                    yield made(which, half + rest + 1, _mix(key[:, None] + _mix(tail[:, : rest - WORDS + 1])).ravel())

    return rows.mapInArrow(run, "key long, doc long, start int, end int")


def everywhere(rows: DataFrame) -> DataFrame:
    """doc, source, start, end: all places of a document where the words of one of its spans are. ``rows``: doc, spans (start, end, source), words."""
    schema = pa.schema([("doc", pa.int64()), ("source", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, (start, end, source), row, words, bounds in _text_parts(batches):
            pieces = _Pieces(words)
            text = np.repeat(np.arange(len(doc)), np.diff(bounds))
            for length in np.unique(end - start):
                own = np.flatnonzero(end - start == length)
                place = np.flatnonzero(np.arange(len(words)) + length <= bounds[text + 1])
                k = text[place]
                key = _mix(pieces.at(0, place, int(length)) + k.view(np.uint64) * _SEEDS[2])  # within its document
                sought, which = np.unique(key[np.searchsorted(place, bounds[row[own]] + start[own])], return_inverse=True)
                to = np.searchsorted(sought, key)
                there = np.flatnonzero(sought[np.minimum(to, len(sought) - 1)] == key)
                there = there[np.argsort(to[there], kind="stable")]
                n = np.bincount(to[there], minlength=len(sought))
                first, n = (np.cumsum(n) - n)[which], n[which]
                hit = there[np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                begin = place[hit] - bounds[k[hit]]
                yield batch_of(schema, doc[k[hit]], np.repeat(source[own], n), begin, begin + length)

    return rows.mapInArrow(run, "doc long, source long, start long, end long")


def merged(spans: DataFrame) -> DataFrame:
    """doc, source, start, end: overlapping and touching spans of a document and source as one."""
    by = Window.partitionBy("doc", "source").orderBy("start", "end")
    open_until = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0))
    islands = spans.withColumn("fresh", F.coalesce((F.col("start") > open_until).cast("int"), F.lit(1))).withColumn("island", island)
    return islands.groupBy("doc", "source", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def _spans(rows: DataFrame, length: int) -> DataFrame:
    """doc, source, start, end: spans of ``length`` words or more, those that overlap by their start as one."""
    return rows.groupBy("doc", "source", F.expr(f"start div {length}")).agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end")).select("doc", "source", "start", "end")


def _groups(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key, source, n: the keys that two documents or more have, written."""
    groups = rows.groupBy(key).agg(F.min("doc").alias("source"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    return written(groups.where("last > source").select(key, "source", "n"), name)


def repeated_passages(docs: DataFrame, min_words: int = 50, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, end (words, exclusive), source_id of each passage that another document has too.

    ``source_id`` is the doc_id of the representative that it was found with; the representative has a row of its own.
    """
    least = min_words - WORDS + 1
    enough = math.ceil(least * 2 * similarity / (1 + similarity) - 1e-9)
    run = -(-enough // ((least - enough) // (WORDS - 1) + 1))  # an edit inside costs as many shingles at least
    snippet = (run + 1) // 2 + WORDS - 1
    texts = renamed(docs, doc_id=id_col, text=text_col).select(_key(F.col("doc_id"), F.col("text")).alias("doc"), "doc_id", "text")
    begun = scratch_mark()
    offered = written(offer(texts, least, run), "offered")
    first = lambda c: F.min_by(c, F.when(~F.col("again"), F.col("doc")))
    met = offered.groupBy("snippet").agg(F.min("doc").alias("source"), first("at").alias("source_at"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n")).where("last > source").drop("last")
    met = _within(written(met, "met"), 112)
    unused = scratch_mark()
    hits = written(offered.join(met, "snippet").select("doc", "at", "source", "source_at", "n"), "hits")
    drop_scratch(docs.sparkSession, begun, unused)
    involved = _within(written(hits.select("doc").distinct(), "involved"), 48)
    words = written(hashed_words(texts.join(involved, "doc", "left_semi")).dropDuplicates(["doc"]), "words")

    margin = min_words + DRIFT
    pairs = hits.where("doc <> source").select("doc", "source", "at", (F.col("at") - F.col("source_at")).alias("shift"))
    found = written(merged(verify(_with_words(pairs, words, margin, snippet), least, enough).distinct()), "found")

    # a group of two has been compared in full; the members of others may share more with each other than with the first
    half, whole = run + WORDS - 1, enough + WORDS - 1
    rest = enough + 2 * (WORDS - 1) - half if least - enough >= WORDS else whole - half
    at, shift = F.col("at"), (F.col("at") - F.col("source_at")).alias("shift")
    missed = hits.where("n > 2")
    many = missed.join(found, (missed["doc"] == found["doc"]) & (missed["source"] == found["source"]) & (at >= F.col("start")) & (at < F.col("end")), "left")
    near = F.struct("at", F.coalesce("start", F.lit(0)).cast("int").alias("start"), F.coalesce("end", F.lit(0)).cast("int").alias("end"), missed["source"].alias("source"), shift)
    many = many.groupBy(missed["doc"]).agg(F.collect_set(near).alias("hits"))
    begun = scratch_mark()
    laid = written(stretches(many.join(words, "doc").select("doc", "hits", "words"), half, snippet, rest + 1), "stretches")
    shared = laid.groupBy("stretch").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.bool_and("covered").alias("covered"), F.bool_or("own").alias("own"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("last > first AND NOT covered AND NOT (n = 2 AND own)").select("stretch", "n")
    shared = written(shared, "shared")
    again = _joined(laid.select("stretch", "doc", "start"), shared, "stretch").groupBy("doc").agg(F.collect_set("start").alias("starts"))
    with _sifted(shared):
        held = written(halves(again.join(words, "doc").select("doc", "starts", "words"), half, whole, rest), "halves")
    classes = held.groupBy("window").agg(F.min("doc").alias("source"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"), first("start").alias("start"), first("end").alias("end"), F.min("side").alias("side"))
    classes = written(classes, "classes")
    same = _joined(held.select("window", "doc", "start", "end"), classes.where("last > source").select("window", "source", "n"), "window")
    same = written(_spans(same, whole), "same")
    # of equal windows the first document's is compared further: the others are linked to it
    firsts = classes.groupBy(F.col("source").alias("doc")).agg(F.collect_list(F.struct("start", "end", "side")).alias("at"))
    ends = written(tails(firsts.join(words, "doc").select("doc", "at", "words"), half, whole, rest), "tails")
    runs, edges = ends.where("kind = 0").withColumn("end", F.col("start") + whole), ends.where("kind > 0")
    alike, edged = _groups(runs, "key", "alike"), _groups(edges, "key", "edged")
    runs = _joined(runs, alike, "key").select("doc", "start", "end", "source")
    places = _joined(edges, edged, "key").groupBy("doc", "start", "end", "side").agg(F.bool_or(F.col("kind") == 1).alias("less"), F.bool_or(F.col("kind") == 2).alias("plain"))
    places = places.groupBy("doc").agg(F.collect_list(F.struct("start", "end", "side", "less", "plain")).alias("at"))
    with _sifted(edged):
        edited = written(edits(places.join(words, "doc").select("doc", "at", "words"), half, rest), "edits")
    meant = _groups(edited, "key", "edited")
    edited = _joined(edited, meant, "key").select("doc", "start", "end", "source")
    near = runs.unionByName(edited).groupBy("doc").agg(F.collect_set(F.struct("start", "end", "source")).alias("spans"))
    with _sifted(alike, meant):
        near = written(_spans(everywhere(near.join(words, "doc").select("doc", "spans", "words")), whole), "near")

    spans = written(merged(found.unionByName(same).unionByName(near)), "spans")
    drop_scratch(docs.sparkSession, begun, scratch_mark() - 1)
    ids = written(texts.select("doc", "doc_id").join(involved, "doc", "left_semi").distinct(), "ids")
    return spans.join(ids, "doc").join(ids.select(F.col("doc").alias("source"), F.col("doc_id").alias("source_id")), "source").select("doc_id", "start", "end", "source_id")
