"""Benchmark passages in documents by spaced-seed hashing; DataFrame functions only.

Texts become lower-case words of letters and digits. A seed is a fixed mask over
``SPAN`` words: the hash covers the words it marks and ignores the others, so a
changed word breaks only the seeds that mark it. Every position of a document
meets the benchmark's positions by seed hash. Around a hit both word rows are
laid over each other: the document holds the passage if in one of the windows of
``window`` words that cover the seed at least ``similarity`` of the words are
equal in place. An item shorter than a window must be equal in all its words; one
shorter than a seed has a single seed, the hash of all its words.

The benchmark's seeds are grouped by hash and the words around them, with the
smallest item that has them, so a passage that many items share meets a document
once. They are broadcast, so documents are never shuffled: a larger benchmark is
cut into blocks of ``BROADCAST_BYTES`` by hash, and the documents are read once
for each. A document's words stay in its row, within one stage from the scan to
the counts of its passages, and only what is around a hit is looked at.

A seed with more than ``HOT`` different surroundings (a phrase that many items
begin with) would meet each of its places in documents with all of them. Such a
seed is refined: of a window that is similar enough, all words but the few that
may differ are equal, so each way to leave that many unmarked words out gives a
longer key, and documents meet the benchmark by those keys, shuffled. Windows
with equal words are one row, with the smallest item. So work follows what is
found, not the pairs that share a phrase.

Defined results: null and empty texts hold nothing, and items without words are
found nowhere; repeated items count as the smallest of
them; rows with the same doc_id (also null) count as one document; empty tables
give an empty table; further columns are left out. Whole texts are read.
"""

from __future__ import annotations

import json
import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import renamed, written

SPAN = 8
#: Marked words of each seed. Two changed words in a window of thirteen leave at least one of them whole at one of its
#: places (masks_survive), so with the standard window and similarity no passage is lost.
MASKS = ((0, 2, 5, 6, 7), (0, 3, 4, 5, 7))
BROADCAST_BYTES = 64 << 20
#: Surroundings from which a seed is refined.
HOT = 256
#: Ways to leave words out of a window; if there are more, keys hold one of as many parts of the window as can't all be changed.
MOST_WAYS = 64


def _words(text: Column) -> Column:
    """Lower-case words of letters and digits; the first or last is empty where the text begins or ends otherwise."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: str, at: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), *(F.get(F.col(words), at + i) for i in mask)) for k, mask in enumerate(MASKS)]


def _run(words: str, at: Column, length: int) -> Column:
    """The seed of an item of so few words."""
    return F.xxhash64(F.lit(-length), *(F.get(F.col(words), at + i) for i in range(length)))


def _places(words: str, length: int = SPAN) -> Column:
    """Where so many words may start: nowhere in shorter texts."""
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _around(words: str, at: Column, window: int) -> Column:
    """The words of all windows that cover the seed at ``at``; null outside of the text."""
    before = window - SPAN
    return F.array(*(F.get(F.col(words), at + k) for k in range(-before, window)))


def benchmark_seeds(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """kind, hash, around, whole (words of a full window), item_id; the same around a hash once, with its smallest item.

    ``kind`` is the number of the mask, or the number of words, negative, of an item shorter than a seed.
    """
    items = renamed(benchmark, item_id=id_col, text=text_col).select("item_id", _hashes(F.filter(_words(F.col("text")), lambda w: w != "")).alias("words"))
    at = items.select("item_id", "words", F.explode(_places("words")).alias("at"))
    rows = at.select("item_id", F.posexplode(F.array(*_seeds("words", F.col("at")))).alias("kind", "hash"), _around("words", F.col("at"), window).alias("around"), F.least(F.size("words"), F.lit(window)).alias("whole"))
    zero, size = F.lit(0), F.size("words")
    short = reduce(lambda c, n: c.when(size == n, _run("words", zero, n)), range(2, SPAN), F.when(size == 1, _run("words", zero, 1)))
    few = items.where(size.between(1, SPAN - 1)).select("item_id", (-size).alias("kind"), short.alias("hash"), _around("words", zero, window).alias("around"), size.alias("whole"))
    return rows.unionByName(few).groupBy("kind", "hash", "around", "whole").agg(F.min("item_id").alias("item_id"))


def _most_equal(window: int, similarity: float) -> Column:
    """Most words equal in place in a window that is whole and similar enough; null if there is none.

    Written with higher-order functions, which are evaluated outside of the generated code: spelled out, the windows
    would make the code of the scan and join, which they would share a stage with, too long for the JVM to compile.
    """
    least = math.ceil(window * similarity - 1e-9)
    equal = F.zip_with("around", "own", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    places = F.sequence(F.lit(1), F.lit(window - SPAN + 1))
    count = lambda e: F.transform(places, lambda k: F.aggregate(F.slice(e, k, F.lit(window)), F.lit(0), lambda n, x: n + x))
    most = F.array_max(F.flatten(F.transform(F.array(equal), count)))  # the one-element array holds what is equal, computed once
    return F.when(most >= F.when(F.col("whole") < window, F.col("whole")).otherwise(least), most)


def _ways(window: int, least: int, mask: tuple[int, ...]) -> list[dict]:
    """Where in what is around a seed the words of a key are: o (the window's begin), whole, kept."""
    before, out = window - SPAN, []
    for o in range(before + 1):
        marked = [before + m for m in mask]
        free, parts = [i for i in range(o, o + window) if i not in marked], window - least + 1
        if math.comb(len(free), window - least) <= MOST_WAYS:
            kept = [sorted({*marked, *free} - {*gone}) for gone in combinations(free, window - least)]
        else:  # one of so many parts has no changed word
            kept = [sorted([*marked, *free[p::parts]]) for p in range(parts)]
        out += [{"o": o, "whole": window, "kept": k} for k in kept]
    return out + [{"o": before - s, "whole": n, "kept": list(range(before - s, before - s + n))} for n in range(SPAN, window) for s in range(n - SPAN + 1)]


def _keys(around: str, window: int, least: int, own: bool) -> Column:
    """key, whole and window of each way that fits what is around a seed: all ways in a document, in the benchmark those of the item's length."""
    by_mask = [json.dumps(_ways(window, least, mask)) for mask in MASKS]
    ways = F.from_json(F.element_at(F.array(*map(F.lit, by_mask)), F.col("kind") + 1), "array<struct<o: int, whole: int, kept: array<int>>>")
    if own:
        begins = lambda v: F.get(around, v.o).isNotNull() & ((v.o == 0) | F.get(around, v.o - 1).isNull())
        ways = F.filter(ways, lambda v: (v.whole == F.col("whole")) & ((v.whole == window) | begins(v)))
    key = lambda v, words: F.when(~F.exists(words, lambda w: w.isNull()), F.xxhash64("hash", v.o, v.whole, words))  # what lies outside of a text equals nothing
    keys = F.transform(ways, lambda v: F.struct(key(v, F.transform(v.kept, lambda i: F.get(around, i))).alias("key"), v.whole.alias("whole"), F.slice(F.col(around), v.o + 1, F.lit(window)).alias("words")))
    return F.explode(F.filter(keys, lambda k: k.key.isNotNull()))


def _refined(met: DataFrame, hot: DataFrame, window: int, least: int) -> DataFrame:
    """doc_id, item_id, n_equal of places (doc_id, kind, hash, own) that meet the benchmark's hot seeds, by longer keys."""
    tasks = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    theirs = hot.repartition(tasks).select("item_id", _keys("around", window, least, True).alias("k")).groupBy("k.key", "k.whole", "k.words").agg(F.min("item_id").alias("item_id"))
    ours = met.select("doc_id", _keys("own", window, least, False).alias("k")).select("doc_id", "k.key", F.col("k.words").alias("own"))
    both = ours.join(theirs.hint("merge"), "key")  # the planner doesn't see how many keys a row has
    equal = F.size(F.filter(F.zip_with("words", "own", lambda a, b: F.coalesce(a == b, F.lit(False))), lambda e: e))
    counted = both.select("doc_id", "item_id", "whole", equal.alias("n_equal"))
    return counted.where(F.col("n_equal") >= F.when(F.col("whole") < window, F.col("whole")).otherwise(least)).select("doc_id", "item_id", "n_equal")


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_equal: each benchmark passage in each document, by the smallest item that has it.

    A passage is what is around a seed, of a refined seed the window.
    """
    if window < SPAN or not 0 < similarity <= 1:
        raise ValueError(f"windows have {SPAN} words or more, the similarity is over 0 and at most 1")
    least = math.ceil(window * similarity - 1e-9)
    seeds = written(benchmark_seeds(benchmark, window, item_col, item_text_col), "seeds")
    lengths = sorted(-r[0] for r in seeds.where("kind < 0").select("kind").distinct().collect())  # SPAN - 1 numbers at most
    hot = written(seeds.groupBy("kind", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("kind", "hash"), "hot")
    hot_rows = hot.count()
    if hot_rows:
        refined, seeds = seeds.join(hot, ["kind", "hash"], "left_semi"), written(seeds.join(hot, ["kind", "hash"], "left_anti"), "seeds")
    # an empty word at either end of a document equals none of the benchmark's, which has none
    words = renamed(docs, doc_id=id_col, text=text_col).select("doc_id", _hashes(_words(F.col("text"))).alias("words"))
    at = words.select("doc_id", "words", F.explode(_places("words", min([SPAN, *lengths]))).alias("at"))
    fits = F.col("at") + SPAN <= F.size("words")
    masked = [F.when(fits, seed) if lengths else seed for seed in _seeds("words", F.col("at"))]
    asked = at.select("doc_id", "words", "at", F.posexplode(F.array(*masked, *(_run("words", F.col("at"), n) for n in lengths))).alias("kind", "hash"))

    def found(block: DataFrame) -> DataFrame:
        met = asked.join(F.broadcast(block.drop("kind")), "hash").select("doc_id", "item_id", "around", "whole", _around("words", F.col("at"), window).alias("own"))
        # hits that aren't passages go after the aggregate: a filter would become a condition of the join, which
        # takes the join out of the compiled stage, and then every row before it is copied with its words
        most = met.select("doc_id", "item_id", _most_equal(window, similarity).alias("n_equal"))
        return most.groupBy("doc_id", "item_id").agg(F.max("n_equal").alias("n_equal")).where(F.col("n_equal").isNotNull())

    def cut(rows: DataFrame, n: int, row_bytes: int) -> list[DataFrame]:
        blocks = max(1, -(-n * row_bytes // BROADCAST_BYTES))
        return [rows.where(F.pmod("hash", F.lit(blocks)) == k) for k in range(blocks)] if blocks > 1 else [rows]

    parts = [found(block) for block in cut(seeds, seeds.count(), 8 * (2 * window - SPAN) + 64)]
    for block in cut(hot, hot_rows, 64) if hot_rows else []:
        places = asked.join(F.broadcast(block.withColumnRenamed("kind", "mask")), "hash").where(F.col("kind") == F.col("mask"))
        met = places.select("doc_id", "kind", "hash", _around("words", F.col("at"), window).alias("own"))
        parts.append(_refined(met, refined, window, least))
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, (written(part, "passages") for part in parts)).groupBy("doc_id", "item_id").agg(F.max("n_equal").alias("n_equal"))


def masks_survive(window: int, changed: int) -> float:
    """Share of ways to change ``changed`` words of a window that leave a seed whole."""
    ways = list(combinations(range(window), changed))
    seeds = [{k + i for i in mask} for mask in MASKS for k in range(window - SPAN + 1)]
    return sum(any(s.isdisjoint(way) for s in seeds) for way in ways) / math.comb(window, changed)
