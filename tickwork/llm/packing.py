"""Documents as token pieces, packed into as few sequences as possible by a grouping genetic algorithm.

Pieces that fill a sequence stand alone. The others are dealt into blocks of
about ``block`` pieces by a hash of their row number, so a hot source or a
group of copies spreads over all blocks and no task grows with the input. Each
block is evolved by several islands: a row of the table is one island with its
population, tasks evolve rows, and between epochs the best solution of each
island moves to the next one (a join on block and island). A solution is a list
of bins. A crossover injects well-filled bins of one parent into the other,
removes the bins that hold the same documents, opens the emptiest ones, lets what
this displaces take the places of shorter documents where it fits, and best-fits
what is left then: bins fill up, and the rest gets shorter. An island stops when its best solution reaches the lower bound.

Tiny pieces are first tied into bundles, which are packed like pieces, so every
block has many bins, however short the texts.

The least filled bins of every block are opened again and their pieces packed
together on the next level, until one block holds them all; each level has about
a hundredth of the pieces of the one before, and half the blocks at most.

Defined results: a null text counts as empty (one piece, the end token); rows
are independent, so repeated ids give pieces of their own; an empty table gives
an empty table; further columns are left out. Texts are never cut short.
"""

from __future__ import annotations

import os
import random
import string
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.llm.common import batch_of, renamed, small_batches, text_chunks, worker_state, written

#: Words whose ids a worker keeps (about 200 bytes each), twice: those used since the last turn, and before.
WORDS_KEPT = 150_000

#: New words that are encoded together: the library's results take many times the space of the ids.
AT_ONCE = 8192

#: Pieces shorter than this part of the capacity are bundled.
TINY = 128

#: A crossover opens one in so many of the bins that it keeps.
OPENED = 8

#: ASCII marks other than the apostrophe, with which contractions begin.
MARKS = string.punctuation.replace("'", "")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of texts by a vocabulary whose words never hold white space: each distinct word is encoded once.

    Lower-case words of letters make exactly one word of the vocabulary's pattern, so all new ones of a batch are
    encoded together and their ids are cut where a word ends; others are encoded one by one.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.merger = Tokenizer.from_file(path)  # lower-case words need no normalisation, and white space is all that splits them
        self.merger.normalizer = None
        self.merger.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words_kept = words_kept
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode_letters(self, words: list[str]) -> list[bytes]:
        lines = [" ".join(words[k : k + 200]) for k in range(0, len(words), 200)]
        ids = np.array([i for e in self.merger.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], dtype="<u4")
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    @staticmethod
    def split(word: str) -> tuple[str, str]:
        """A word of letters, in lower case if that is plain, and the marks after it, which the pattern splits off together."""
        core = word.rstrip(MARKS)
        low = core.lower() if core.isascii() else core
        return (low, word[len(core) :]) if core and WordEncoder.plain(low) else (word, "")

    @staticmethod
    def plain(word: str) -> bool:
        """Lower-case letters of the Latin script: normalisation leaves them as they are."""
        return word.isalpha() and word.islower() and max(word) < "\u0250"

    def learn(self, words: set[str]) -> None:
        """Have the ids of ``words`` in ``seen``."""
        seen, older = self.seen, self.older
        letters, parts = set(), {}
        for w in words:
            known = older.get(w)
            if known is not None:
                seen[w] = known
            elif w.isascii() and w.isalpha() and w.islower():
                letters.add(w)
            else:
                parts[w] = self.split(w)
        other = set()
        for core, end in parts.values():
            (letters if self.plain(core) else other).add(core)
            if end:
                other.add(end)
        new, rest = [c for c in letters if c not in seen], [c for c in other if c not in seen]
        for k in range(0, len(new), AT_ONCE):
            seen.update(zip(new[k : k + AT_ONCE], self.encode_letters(new[k : k + AT_ONCE]), strict=True))
        seen.update(zip(rest, self.encode(rest), strict=True))
        for w, (core, end) in parts.items():
            seen[w] = seen[core] + seen[end] if end else seen[core]

    @staticmethod
    def words(text: str) -> list[str] | None:
        """Parts of a text that are encoded apart; None where only the whole text will do.

        str.split() also splits at four control characters that aren't white space to the library. In Latin-1 text
        without other marks, single full stops and commas are words of their own, and case doesn't matter.
        """
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return None
        bare = text.replace(".", "").replace(",", "").replace(" ", "").replace("\n", "")
        if bare.isalnum() and is_latin(bare) and not any(pair in text for pair in ("..", ".,", ",.", ",,")):
            text = text.lower().replace(".", " . ").replace(",", " , ")
        return text.split()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.seen) > self.words_kept:
            self.seen, self.older = {}, self.seen
        words = list(map(self.words, texts))
        new = set().union(*filter(None, words)).difference(self.seen)
        self.learn(new)
        known = self.seen.__getitem__
        return [self.encode([t])[0] if line is None else b"".join(map(known, line)) for t, line in zip(texts, words, strict=True)]


def encoder(path: str, words_kept: int) -> WordEncoder:
    """One for each worker process and vocabulary; it stays in the task's own thread, others would each keep freed memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_state(f"{words_kept} words of {path}", lambda: WordEncoder(path, words_kept))


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", words_kept: int = WORDS_KEPT) -> DataFrame:
    """Each document's ids and the end id, cut after every ``capacity`` ids: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary, words_kept), np.array([end_id], dtype="<u4").tobytes()
        for part in small_batches(batches, 512):
            ids, texts = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
            for a, b in text_chunks(texts, 1 << 20):
                rows: list[tuple] = []
                for doc, raw in zip(ids[a:b], enc.ids(texts[a:b]), strict=True):
                    raw += end
                    for k in range(0, len(raw), 4 * capacity):
                        piece = raw[k : k + 4 * capacity]
                        rows.append((doc, k // (4 * capacity), k // 4, len(piece) // 4, zlib.crc32(piece)))
                yield batch_of(_PIECES, *zip(*rows, strict=True))

    rows = renamed(docs, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(bins: list[list[int]], rooms: list[int], items: list[int], length: list[int], capacity: int) -> None:
    """Put the items, longest first, each into the fullest bin that still takes it."""
    free = sorted((room, k) for k, room in enumerate(rooms))
    for i in sorted(items, key=lambda i: -length[i]):
        n = length[i]
        at = bisect_left(free, (n, -1))
        if at < len(free):
            room, k = free.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
            rooms.append(capacity)
        rooms[k] = room - n
        if rooms[k]:
            insort(free, (rooms[k], k))


def take_places(bins: list[list[int]], rooms: list[int], displaced: list[int], length: list[int]) -> list[int]:
    """Swap documents in bins for the longest displaced ones that fit in their place; returns what is displaced then."""
    pool = sorted((length[i], i) for i in displaced)
    for k, members in enumerate(bins):
        for j, held in enumerate(members):
            if not rooms[k]:
                break
            at = bisect_right(pool, (length[held] + rooms[k], len(length))) - 1
            if at >= 0 and pool[at][0] > length[held]:
                n, i = pool.pop(at)
                insort(pool, (length[held], held))
                members[j] = i
                rooms[k] -= n - length[held]
    return [i for _, i in pool]


def crossover(into: list[list[int]], source: list[list[int]], length: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """``into`` with well-filled bins of ``source``; bins that hold their documents go, displaced documents are best-fitted."""
    fill = [sum(length[i] for i in b) for b in source]
    order = sorted(range(len(source)), key=lambda k: -fill[k])
    good = order[: max(1, len(order) // 2)]
    injected = [list(source[k]) for k in rng.sample(good, max(1, len(good) // 2))]
    held = {i for b in injected for i in b}
    bins, displaced = injected, []
    for b in into:
        if held.isdisjoint(b):
            bins.append(list(b))
        else:
            displaced += [i for i in b if i not in held]
    kept = sorted(range(len(injected), len(bins)), key=lambda k: sum(length[i] for i in bins[k]))
    for k in kept[: max(2, len(kept) // OPENED)]:  # mutation: the emptiest bins open too
        displaced += bins[k]
        bins[k] = []
    bins = [b for b in bins if b]
    rooms = [capacity - sum(length[i] for i in b) for b in bins]
    best_fit(bins, rooms, take_places(bins, rooms, displaced, length), length, capacity)
    return bins


def fitness(bins: list[list[int]], length: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then more uneven ones."""
    return len(bins), -sum((sum(length[i] for i in b) / capacity) ** 2 for b in bins)


def evolve(length: list[int], population: list[list[int]], capacity: int, seed: int, size: int, births: int) -> list[list[int]]:
    """A population (the bin of each item) after ``births`` crossovers, best first."""
    rng = random.Random(seed)
    least = -(-sum(length) // capacity)
    people = []
    for solution in population:
        bins: list[list[int]] = [[] for _ in range(max(solution) + 1)]
        for i, b in enumerate(solution):
            bins[b].append(i)
        people.append(bins)
    while len(people) < size:
        bins = []
        if people and (len(people) + seed) % 2 or seed % 7 == 3:  # another start: items of mixed lengths first
            first = rng.sample(range(len(length)), len(length) // 3)
            best_fit(bins, rooms := [], first, length, capacity)
            best_fit(bins, rooms, list(set(range(len(length))) - set(first)), length, capacity)
        else:
            best_fit(bins, [], list(range(len(length))), length, capacity)
        people.append(bins)
        if len(bins) == least:
            break
    rank = lambda bins: fitness(bins, length, capacity)
    people.sort(key=rank)
    for _ in range(births):
        if len(people[0]) == least or len(people) < 2:
            break
        a, b = rng.sample(range(len(people)), 2)
        people.append(crossover(people[a], people[b], length, capacity, rng))
        people.sort(key=rank)
        del people[size:]
    out = []
    for bins in people:
        of = [0] * len(length)
        for k, b in enumerate(bins):
            for i in b:
                of[i] = k
        out.append(of)
    return out


ISLAND = "block long, island int, ids array<long>, lengths array<int>, people array<array<int>>"


def _evolve_rows(capacity: int, size: int, births: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                row["people"] = evolve(row["lengths"], row["people"], capacity, row["block"] * 1_000_003 + row["island"], size, births)
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return run


def _place_rows(capacity: int, level: int, reopen: int):
    schema = pa.schema([("row", pa.int64()), ("length", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fill: dict[int, int] = {}
                offsets = []
                for n, b in zip(row["lengths"], row["solution"], strict=True):
                    offsets.append(fill.get(b, 0))
                    fill[b] = offsets[-1] + n
                emptiest = set(sorted((b for b in fill if fill[b] < capacity), key=lambda b: fill[b])[:reopen])
                base = (level + 1 << 56) + (row["block"] << 20)
                yield batch_of(schema, row["ids"], row["lengths"], [base + b for b in row["solution"]], offsets, [b in emptiest for b in row["solution"]])

    return run


def bundles(tiny: DataFrame, share: int, group: int = 4096) -> DataFrame:
    """row, length, item, inner: pieces of less than ``share`` tokens, tied into items of about ``share`` and under twice that.

    Groups of about ``group`` pieces are dealt by a hash; an item is named after its first row.
    """
    groups = max(1, -(-tiny.count() // group))
    by = Window.partitionBy("group").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("group", "part")
    ordered = tiny.withColumn("group", F.pmod(F.xxhash64(F.col("row"), F.lit(-1)), F.lit(groups))).withColumn("before", F.coalesce(F.sum("length").over(by), F.lit(0)))
    parts = ordered.withColumn("part", F.floor(F.col("before") / share))
    return parts.select("row", "length", F.min("row").over(inside).alias("item"), (F.col("before") - F.min("before").over(inside)).alias("inner"))


def pack(pieces: DataFrame, capacity: int = 4096, block: int = 2048, islands: int = 3, epochs: int = 2, size: int = 4, births: int = 8, reopen: int = 2) -> DataFrame:
    """``pieces`` (row long, length) of fewer than ``capacity`` tokens with sequence_id and offset, by row."""
    level, placed, blocks, share = 0, None, None, capacity // TINY
    rest = pieces.select("row", F.col("length").cast("int").alias("length"))
    tied = written(bundles(rest.where(F.col("length") < share), share), "bundles")
    rest = rest.where(F.col("length") >= share).unionByName(tied.groupBy("item").agg(F.sum("length").cast("int").alias("length")).withColumnRenamed("item", "row"))
    while True:
        needed = -(-rest.count() // block)
        blocks = needed if blocks is None else min(needed, blocks // 2 or 1)
        if not blocks:
            break
        dealt = rest.groupBy(F.pmod(F.xxhash64(F.col("row"), F.lit(level)), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("items"))
        people = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("items.row").alias("ids"), F.col("items.length").alias("lengths"), F.array().cast("array<array<int>>").alias("people")).repartition(F.col("block"), F.col("island"))
        for epoch in range(epochs):
            people = written(people.mapInArrow(_evolve_rows(capacity, size, births), ISLAND), f"islands-{level}-{epoch}")
            if epoch + 1 < epochs:
                moved = people.select("block", ((F.col("island") + 1) % islands).alias("island"), F.slice("people", 1, 1).alias("elite"))
                people = people.join(moved, ["block", "island"]).select("block", "island", "ids", "lengths", F.concat("people", "elite").alias("people"))
        best = people.groupBy("block").agg(F.min_by(F.struct("ids", "lengths", F.col("people")[0].alias("solution")), F.struct(F.array_max(F.col("people")[0]), "island")).alias("b")).select("block", "b.*")
        last = blocks == 1
        done = written(best.mapInArrow(_place_rows(capacity, level, 0 if last else reopen), "row long, length int, sequence_id long, offset long, open boolean"), f"placed-{level}")
        closed = done.where(~F.col("open")).select("row", "sequence_id", "offset")
        placed = closed if placed is None else placed.unionByName(closed)
        if last:
            break
        rest, level = done.where("open").select("row", "length"), level + 1
    if placed is None:
        return pieces.sparkSession.createDataFrame([], "row long, sequence_id long, offset long")
    members = tied.select(F.col("row").alias("member"), "item", "inner")
    return placed.join(members, F.col("row") == F.col("item"), "left").select(F.coalesce("member", "row").alias("row"), "sequence_id", (F.col("offset") + F.coalesce("inner", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", words_kept: int = WORDS_KEPT, **evolution) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    ``words_kept`` trades a worker's memory for time; results don't depend on it.
    """
    pieces = written(token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, words_kept).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select(*_PIECES.names, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    return full.unionByName(part.join(pack(part, capacity, **evolution), "row").select(*full.columns))
