"""Quality of documents by weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

One pass over the texts measures each document and turns the measures into
votes. Documents with the same votes are alike to the model, so it is fitted on
the number of documents of each pattern of votes: at most three to the number of
rules rows, however many documents there are, and all documents count. EM finds
each rule's rate of right votes and the share of good documents; a document's
posterior decides, in place of a rule that all checks must pass.

Defined results: a null text counts as an empty one (no word; it fails the base
rule, so it isn't kept); rows are independent; an empty table gives an empty
table and fits nothing; further columns are left out. Words are separated by the
six ASCII white-space characters; whole texts are read. A posterior of exactly
the threshold is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import batch_of, renamed, small_batches, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_other", "n_symbol_runs")
SYMBOLS = "#*$%&|<>"
#: Documents of fewer words, or with more than this share of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 50, 50

_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]+")
_BLANKS = " \t\n\r\x0b\x0c"
#: Bytes that aren't ASCII marks or digits.
_PLAIN = bytes([*range(65, 91), *range(97, 123), *range(128, 256)]) + _BLANKS.encode()


def repeated_words(words: list[bytes], ids: dict[bytes, int]) -> int:
    """Words that lie in a three-word window which occurs twice or more in the text; numbers the words in ``ids``."""
    w = np.array([ids.setdefault(x, len(ids)) for x in words], dtype=np.int64)
    if len(words) < 4:
        return 0
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) > 1_000_000:  # products of three would overflow
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * len(ids) + w[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(key), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def measure(text: str) -> tuple[int, ...]:
    """The values of MEASURES: besides the contract's, distinct words, ASCII characters other than letters and blanks, runs of symbols."""
    raw = text.encode("utf-8", "surrogatepass")
    words, ids = raw.split(), {}  # bytes split at exactly the six ASCII white-space characters
    runs = _SYMBOL.findall(text)
    repeated = repeated_words(words, ids)
    return len(words), len(text) - sum(map(text.count, _BLANKS)), sum(map(len, runs)), duplicate_lines(text), repeated, len(ids), len(raw.translate(None, _PLAIN)), len(runs)


def rules() -> dict[str, tuple[Column, Column]]:
    """For each rule, when it votes against and when for a document; else it abstains."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    length, distinct, repeats, other = F.col("word_chars") / n, F.col("n_distinct") / n, F.col("n_repeat_words") / n, F.col("n_other") / chars
    return {
        "length": (F.col("n_words") < LEAST_WORDS, F.col("n_words") >= 2 * LEAST_WORDS),
        "word_length": ((length < 2.5) | (length > 12), length.between(3, 10)),
        "symbols": (F.col("n_symbols") * 10 > n, F.col("n_symbols") * 50 <= n),
        "symbol_runs": (F.col("n_symbol_runs") * 12 > n, F.col("n_symbol_runs") * 50 <= n),
        "letters": (other > 0.2, other < 0.1),
        "repeats": (repeats > 0.3, repeats < 0.15),
        "distinct": ((F.col("n_words") >= LEAST_WORDS) & (distinct < 0.25 - 0.05 * F.log10(n / LEAST_WORDS)), distinct > 0.4 - 0.08 * F.log10(n / LEAST_WORDS)),
        "lines": (F.col("n_dup_lines") * 25 > n, F.col("n_dup_lines") * 100 <= n),
    }


def measure_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measures of every row."""
    schema = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [measure(t or "") for t in batch.column(1).to_pylist()]
            yield batch_of(schema, batch.column(0), *(zip(*found, strict=True) if found else [[]] * len(MEASURES)))

    rows = renamed(docs, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def vote_column() -> Column:
    """One letter for each rule: + for, - against, 0 abstains."""
    return F.concat(*(F.when(bad, "-").when(good, "+").otherwise("0") for bad, good in rules().values()))


def fit(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Posterior probability of quality of each pattern of votes, by EM over all documents (``patterns`` counts them).

    A rule has two rates, of votes for good and against bad documents among those it votes on; both start at 0.8,
    which says which of the two classes is the good one, and are held at 0.55 or more, so that they can't swap.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], dtype=float)
    votes = np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in p] for p in names])
    plus, minus = votes > 0, votes < 0
    good, bad, share = np.full(votes.shape[1], 0.8), np.full(votes.shape[1], 0.8), 0.7
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + plus @ np.log(good / (1 - bad)) + minus @ np.log((1 - good) / bad)
        p = 1 / (1 + np.exp(-odds))
        g, b = weight * p, weight * (1 - p)
        new = np.clip((g @ plus + 8) / (g @ (plus | minus) + 10), 0.55, 0.995), np.clip((b @ minus + 8) / (b @ (plus | minus) + 10), 0.55, 0.995), float(np.clip(g.sum() / weight.sum(), 0.05, 0.95))
        moved = max(np.abs(new[0] - good).max(), np.abs(new[1] - bad).max(), abs(new[2] - share))
        good, bad, share = new
        if moved < 1e-9:
            break
    odds = np.log(share / (1 - share)) + plus @ np.log(good / (1 - bad)) + minus @ np.log((1 - good) / bad)
    return dict(zip(names, (1 / (1 + np.exp(-odds))).tolist(), strict=True))


def rate_quality(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measures, votes, base_failed, posterior and kept of every row."""
    spark = docs.sparkSession
    measured = written(measure_documents(docs, id_col, text_col).withColumn("votes", vote_column()), "measures")
    posterior = fit({r.votes: r.n for r in measured.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()})  # 3 ** 8 rows at most
    known = spark.createDataFrame(pd.DataFrame({"votes": list(posterior), "posterior": list(posterior.values())}, columns=["votes", "posterior"]).astype({"posterior": float}), "votes string, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rated = measured.join(F.broadcast(known), "votes")
    return rated.select("doc_id", *MEASURES, "votes", failed.alias("base_failed"), "posterior", (~failed & (F.col("posterior") >= threshold)).alias("kept"))
