"""Audit of a chain of filters: what every order of them keeps, removes and hides, by contingency tensor contractions.

Each document becomes a pattern of failures, one bit a filter. Patterns are
counted by part (all documents, good ones, toxic ones), so the shuffle holds at
most parts x 2^5 rows a task whatever the number of documents. A part's counts
are reshaped to a 2x2x2x2x2 tensor, pass or fail along each axis. Every figure
of every step of every order is a contraction of that tensor: along an axis a
vector selects pass, fail or all, and one einsum does all orders and steps.

The filters, over a document's whole text:

* A: fewer than ``LEAST_WORDS`` words; B: fewer than half of the words are distinct;
* C: more than 3 of 100 code points are capital letters A-Z; D: holds a symbol of ``#$%&*|``;
* E: the same text as a document with a smaller id, anywhere in the table.

E needs the smallest id of each text. Rows that agree in all that counts are
counted before they meet, the smallest ids are an aggregate by digest, and rows
join them by digest and id: many copies of one text have different ids, so no
group of copies comes together in one task.

Defined results: a null text is empty, and equal to other empty ones. A null id
is larger than all ids: its row fails E if the text has an id, and is no one's
label. Repeated rows are documents of their own; those with the smallest id of a
text all pass E. A label holds if any row of ``labels`` with that id says so; no
label is neither good nor toxic. A null part is the empty string. Parts are those
of ``docs``: an empty table gives an empty result. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import batch_of, renamed, written

FILTERS = "ABCDE"
LEAST_WORDS = 200
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


# ---------------------------------------------------------------- failures and their counts
def text_failures(text: Column, words: Column) -> Column:
    """Filters A to D that a text with these words fails, as bits 0 to 3."""
    short = F.size(words) < LEAST_WORDS
    repetitive = F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * F.lit(50).cast("long")
    loud = F.length(F.regexp_replace(text, "[^A-Z]+", "")) * F.lit(100).cast("long") > F.length(text) * F.lit(3).cast("long")
    fails = [short, repetitive, loud, text.rlike(r"[#$%&*|]")]
    return sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))


def label_flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, good, toxic: 0 or 1, once for each id."""
    rows = renamed(labels, doc_id=id_col, quality="quality", toxic="toxic").where("doc_id IS NOT NULL")
    flag = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int"))
    return rows.groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, failed (bits), n, good, toxic: the number of documents of each part and pattern, and of labelled ones."""
    rows = renamed(docs, doc_id=id_col, text=text_col, part=part_col)
    texts = rows.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = texts.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    alike = split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_failures(F.col("text"), F.col("words")).alias("failed"))
    alike = written(alike.groupBy("digest", "doc_id", "part", "failed").agg(F.count(F.lit(1)).alias("n")), "patterns")
    first = alike.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select(F.col("digest").alias("d"), F.col("doc_id").alias("least"))
    copies = alike.join(first, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("least")), "left")
    marked = copies.select("doc_id", "part", (F.col("failed") + F.col("d").isNull().cast("int") * 16).alias("failed"), "n")
    known = marked.where("doc_id IS NOT NULL").join(label_flags(labels), "doc_id", "left")
    known = known.select("part", "failed", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = marked.where("doc_id IS NULL").select("part", "failed", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    of = lambda c: F.sum(F.col("n") * F.col(c)).alias(c)
    return known.unionByName(nameless).groupBy("part", "failed").agg(of("good"), of("toxic"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- contractions
@lru_cache
def _steps(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All orders of ``k`` filters, and for each order and step which filters ran before it and which runs in it."""
    orders = np.array(list(permutations(range(k))))
    place = np.argsort(orders, axis=1)[:, None, :]
    step = np.arange(k)[None, :, None]
    return orders, place < step, place == step


def contract(tensor: np.ndarray, passing: np.ndarray, failing: np.ndarray) -> np.ndarray:
    """``tensor`` [measure, 2, 2, ...] summed over what the axes select: [measure, ...selections].

    ``passing`` and ``failing`` [..., axis] tell along which axes only pass or only fail counts; elsewhere all does.
    """
    k = tensor.ndim - 1
    select = np.stack([~failing, ~passing], axis=-1).astype(np.int64).reshape(-1, k, 2)
    operands = [tensor, [k + 1, *range(k)]]
    for axis in range(k):
        operands += [select[:, axis], [k, axis]]
    return np.einsum(*operands, [k + 1, k]).reshape(len(tensor), *passing.shape[:-1])


def audit_tensor(tensor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orders and figures [order, step, FIGURES] of one part from its counts [all, good and toxic, 2, 2, ...]."""
    orders, before, here = _steps(tensor.ndim - 1)
    none = np.zeros_like(here)
    removed, good, toxic = contract(tensor, before, here)
    documents = tensor[:1]
    kept = contract(documents, before | here, none)[0]
    failing = contract(documents, none, here)[0]
    alone = contract(documents, ~here, here)[0]
    shapley = np.zeros(orders.shape[1], dtype=np.int64)
    np.add.at(shapley, orders, removed)
    return orders, np.stack([kept, removed, failing - removed, alone, good, toxic, shapley[orders]], axis=-1)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The figures of each part, order and step, from part, failed, n, good, toxic; rows may repeat a pattern."""
    k = len(filters)
    out = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((f, pa.int64()) for f in FIGURES)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tensor = np.zeros((3, 1 << k), dtype=np.int64)
                for cell in cells:
                    tensor[:, cell["failed"]] += (cell["n"], cell["good"], cell["toxic"])
                # bit 0 is the first filter, and so the last axis of the reshaped counts
                orders, figures = audit_tensor(tensor.reshape(3, *[2] * k).transpose(0, *range(k, 0, -1)))
                names = ["".join(filters[f] for f in order) for order in orders for _ in range(k)]
                steps = np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))
                yield batch_of(out, [part] * len(names), names, steps, *figures.reshape(-1, len(FIGURES)).T)

    cells = counts.groupBy("part", "failed").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))  # 2^k at most
    return parts.mapInArrow(each, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step and figures of the five filters over ``docs``."""
    return audit(failure_counts(docs, labels, id_col, text_col, part_col))
