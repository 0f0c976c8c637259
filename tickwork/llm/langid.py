"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams by language: tasks add up dense count matrices
and send one row per language and bucket, so the shuffle is bounded by the model
and not by the text. A language's log-probabilities become one row of a written
table, the rows of the matrix. The matrix is broadcast in blocks of languages of
at most ``MODEL_BYTES``; the number of buckets is the same for any number of
languages. Batches are scored in numpy: the rows of the matrix that the n-grams
of a batch hit are gathered and added up document by document.

With one block (a thousand languages) a document's best language and its share
come from one pass. With more, each block's pass gives a document's best
language in it and the logarithm of the block's summed probabilities; the best
of the blocks' best is kept, and the sums make its share. Both ways give the same.

Training reads all labelled rows it is given, whole texts; there is no sample.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text when there is nothing to learn from. Rows with a null label, or
without a letter, are not learned from. Equal scores go to the language
that sorts first. Repeated rows each get their result; an empty table gives an
empty table; further columns are left out.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import batch_of, forget_state, renamed, small_batches, text_chunks, written

#: Buckets of hashed n-grams (a power of two), and the bound of a broadcast block of the matrix.
BUCKETS, MODEL_BYTES = 1 << 14, 64 << 20
#: Additive smoothing of counts.
ALPHA = 0.5
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(0x9E3779B1)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def ngram_buckets(texts: list[str], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of each 1-, 2- and 3-gram of the lower-cased texts by the n-gram's first character, and where texts start.

    n-grams that would reach into the next text have the bucket ``1 << bits``.
    """
    lowered = [t.lower() for t in texts]
    starts = np.cumsum([0, *map(len, lowered)])
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    grams, out = code, []
    for n in (1, 2, 3):
        if n > 1:
            grams = grams[: max(0, len(code) - n + 1)] * _MIX + code[n - 1 :]
        h = (grams ^ (grams >> np.uint32(15))) * _MIX >> np.uint32(32 - bits)
        b = np.full(len(code), 1 << bits, dtype=np.int32)
        b[: len(h)] = h
        for k in range(1, n):  # the last n - 1 characters of each text start no n-gram
            last = starts[1:] - k
            b[last[last >= starts[:-1]]] = 1 << bits
        out.append(b)
    return out, starts


def count_grams(train: DataFrame, bits: int) -> DataFrame:
    """lang, bucket, n over ``train`` (text, lang); bucket -1 counts documents."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        sums: dict[str, np.ndarray] = {}
        size = (1 << bits) + 1
        for batch in small_batches(batches):
            by: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang is not None and has_letter(text):
                    by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                total = sums.setdefault(lang, np.zeros(size + 1, dtype=np.int64))
                total[-1] += len(texts)
                for a, b in text_chunks(texts):
                    for grams in ngram_buckets(texts[a:b], bits)[0]:
                        total[:-1] += np.bincount(grams, minlength=size)
        for lang, total in sums.items():
            total[size - 1] = 0
            hit = np.flatnonzero(total)
            yield batch_of(schema, [lang] * len(hit), np.where(hit == size, -1, hit).astype(np.int32), total[hit])

    return train.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Block:
    """Some languages, in order, with log-priors and log-probabilities [language, bucket]; the last bucket counts nothing."""

    def __init__(self, langs: list[str], prior: np.ndarray, weights: np.ndarray, bits: int):
        self.langs, self.prior, self.weights, self.bits = langs, prior, weights, bits

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-joint of each text and language."""
        grams, starts = ngram_buckets(texts, self.bits)
        out = np.empty((len(texts), len(self.langs)))
        for k, row in enumerate(self.weights):
            each = row[grams[0]]
            for g in grams[1:]:
                each += row[g]
            out[:, k] = self.prior[k] + np.add.reduceat(each, starts[:-1], dtype=np.float64)
        return out

    def best(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Best language of each text, its log-joint, and the logarithm of all languages' sum; None for a text without a letter."""
        langs: list[str | None] = [None] * len(texts)
        joint, mass = np.full(len(texts), np.nan), np.full(len(texts), np.nan)
        rows = [k for k, t in enumerate(texts) if has_letter(t)] if self.langs else []
        known = [texts[k] for k in rows]
        for a, b in text_chunks(known):
            scores = self.scores(known[a:b])
            at = scores.argmax(axis=1)
            top = scores[np.arange(b - a), at]
            joint[rows[a:b]] = top
            mass[rows[a:b]] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
            for k, lang in zip(rows[a:b], at, strict=True):
                langs[k] = self.langs[lang]
        return langs, joint, mass

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and share of each text, if these are all languages."""
        langs, joint, mass = self.best(texts)
        return [UNKNOWN if lang is None else lang for lang in langs], np.nan_to_num(np.exp(joint - mass), nan=0.0)


class Model:
    """A table of languages: block, lang, prior, weights (float32, one for each bucket)."""

    def __init__(self, rows: DataFrame, blocks: int, bits: int):
        self.rows, self.blocks, self.bits = rows, blocks, bits

    def block(self, k: int) -> Block:
        rows = sorted(self.rows.where(F.col("block") == k).select("lang", "prior", "weights").collect())  # MODEL_BYTES at most
        weights = np.zeros((len(rows), (1 << self.bits) + 1), dtype=np.float32)
        for row, (_, _, values) in zip(weights, rows, strict=True):
            row[:-1] = np.frombuffer(values, dtype="<f4")
        return Block([r[0] for r in rows], np.array([r[1] for r in rows]), weights, self.bits)


def train_model(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows of ``train``."""
    labelled = renamed(train, text=text_col, lang=lang_col).where("lang IS NOT NULL")
    bits = BUCKETS.bit_length() - 1

    def language(counts: pd.DataFrame) -> pd.DataFrame:
        """One language: at most a row for each bucket, and its number of documents."""
        n, weights = counts.n.to_numpy(dtype=np.float64), np.full(1 << bits, ALPHA)
        grams = counts.bucket.to_numpy() >= 0
        weights[counts.bucket.to_numpy()[grams]] += n[grams]
        values = np.log(weights / weights.sum()).astype("<f4").tobytes()
        return pd.DataFrame({"lang": counts.lang.iloc[:1], "docs": n[~grams].sum(), "weights": [values]})

    langs = written(count_grams(labelled, bits).groupBy("lang").applyInPandas(language, "lang string, docs double, weights binary"), "languages")
    n, docs = langs.agg(F.count(F.lit(1)), F.sum("docs")).first()
    most = max(2, MODEL_BYTES // (4 << bits))
    # blocks are dealt by hash: half full on average, so that none is over the bound
    blocks = 1 if n <= most else -(-2 * n // most)
    rows = langs.select(F.pmod(F.xxhash64("lang"), F.lit(blocks)).cast("int").alias("block"), "lang", F.log(F.col("docs") / F.lit(docs or 1.0)).alias("prior"), "weights")
    return Model(rows, blocks, bits)


def _scorer(spark, block: Block, result: str):
    """Pandas UDF over texts: ``predict`` gives struct(lang_pred, score), ``best`` struct(lang, joint, mass)."""
    shared = spark.sparkContext.broadcast((block.langs, block.prior, block.weights, block.bits))  # values that need no package to read
    fields = {"predict": "lang_pred string, score double", "best": "lang string, joint double, mass double"}[result]
    names = [f.split()[0] for f in fields.split(", ")]

    @F.pandas_udf(fields)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget_state()
        here = Block(*shared.value)
        for t in batches:
            yield pd.DataFrame(dict(zip(names, getattr(here, result)(t.tolist()), strict=True)))

    return score


def with_language(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: struct(lang_pred, score) of each text."""
    spark = docs.sparkSession
    if model.blocks == 1:
        return docs.withColumn(name, _scorer(spark, model.block(0), "predict")(F.col(text_col)))
    row = "row"
    while row.lower() in {c.lower() for c in (*docs.columns, name)}:
        row += "_"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    passes = []
    for k in range(model.blocks):
        found = numbered.select(row, _scorer(spark, model.block(k), "best")(F.col(text_col)).alias("f"))
        passes.append(written(found.where("f.lang IS NOT NULL").select(row, "f.*"), "scored"))
    by = reduce(DataFrame.unionByName, passes).groupBy(row).agg(F.min(F.struct((-F.col("joint")).alias("joint"), "lang")).alias("best"), F.collect_list(F.col("mass")).alias("masses"))
    share = 1 / F.aggregate("masses", F.lit(0.0), lambda total, mass: total + F.exp(mass + F.col("best.joint")))  # a number for each block
    shares = by.select(row, F.col("best.lang").alias("lang_pred"), share.alias("score"))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = shares.select(row, F.struct("lang_pred", "score").alias(name))
    return numbered.join(found, row, "left").withColumn(name, F.coalesce(name, none)).drop(row)


def identify_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    found = with_language(renamed(docs, doc_id=id_col, text=text_col), model, "found")
    return found.select("doc_id", "found.lang_pred", "found.score")
