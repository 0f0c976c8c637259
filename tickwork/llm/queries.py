"""The registered queries of this package: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.llm import decontaminate, filter_audit, html_extract, langid, packing, periodic_runs, quality, secret_scan, sharding, simhash, substring_dedup, token_counts, warc
from tickwork.llm.common import held_out, table
from tickwork.sinks.scratch import scratch_path

TOKEN_LIMIT = 512


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train_model(docs.where(~held_out(F.col("doc_id"))))
    found = langid.with_language(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model, "found")
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op2_secret_scans(spark, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality.rate_quality(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), words_kept=500_000)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), folder), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row per document that holds benchmark passages: the smallest item found and the most words equal in place."""
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id").agg(F.min("item_id").alias("item_id"), F.max("n_equal").alias("n_equal"))


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def planted_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text by the checksum of its id repeats a part of itself to its end.

    With h the checksum, g = h / 10 and n words, each word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) / (3 + g % 8). A row without an id keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("planted"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("planted"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n").cast("int")))
    rows = rows.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    part = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.expr("CAST((n - a + p - 1) div p AS INT)")
    repeated = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(F.array_repeat(part, times)), F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_run_detection(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_texts(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, F.concat(r.period.cast("string"), F.lit("\n")))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                       F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op13_filter_interaction_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (op1_language_id, op2_secret_scans, op3_html_extraction, op4_quality_rules, op5_best_fit_packing, op6_warc, op7_token_counts, op8_benchmark_decontamination, op9_simhash_near_dedup, op10_substring_dedup, op11_periodic_run_detection, op12_sharding, op13_filter_interaction_audit)}
#: Windows of thirteen words, eleven of them equal in place: one of three parts of the window is then equal as a whole.
_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
_OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, i, w[i:i + 12] AS win FROM d, range(1, len(w) - 11) t(i)),
bw AS (SELECT item_id, w[i:i + 12] AS win, i FROM b, range(1, len(w) - 11) t(i)),
parts(p, a, z) AS (VALUES (0, 1, 4), (1, 5, 8), (2, 9, 13)),
dp AS (SELECT doc_id, win, p, win[a:z] AS part FROM dw, parts),
bp AS (SELECT item_id, win, p, win[a:z] AS part FROM bw, parts),
hit AS (SELECT doc_id, item_id, list_sum(list_transform(range(1, 14), lambda k: CAST(dp.win[k] = bp.win[k] AS INTEGER))) AS n
        FROM dp JOIN bp USING (p, part)),
few AS (SELECT item_id, w, len(w) AS n FROM b WHERE len(w) BETWEEN 1 AND 12),
run AS (SELECT d.doc_id, s.item_id, s.n FROM d, range(1, len(d.w) + 1) t(i), (SELECT DISTINCT n FROM few) m
        JOIN few s ON s.n = m.n WHERE s.w = d.w[i:i + m.n - 1])
SELECT doc_id, min(item_id) AS item_id, CAST(max(n) AS INTEGER) AS n_equal
FROM (SELECT doc_id, item_id, n FROM hit WHERE n >= 11 UNION ALL SELECT doc_id, item_id, n FROM run) f GROUP BY doc_id"""

#: refers_to is cast because pandas turns Spark's nullable long into a double.
_OP6 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CAST(CASE WHEN n >= 100 AND page_id > first THEN first END AS DOUBLE) AS refers_to
FROM f"""



def _crc_table() -> list[int]:
    """The checksum's step for each byte, by its rule: eight times shift right, with the polynomial if a bit fell out."""
    steps = list(range(256))
    for _ in range(8):
        steps = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in steps]
    return steps


#: Running sums over all rows; the checksum goes byte by byte. grown_shard is cast as refers_to is.
_OP12 = f"""
WITH c AS (SELECT {_crc_table()}::BIGINT[] AS t),
b AS (SELECT doc_id, list_transform(range(1, 2 * octet_length(encode(coalesce(text, ''))), 2),
                                    lambda i: CAST('0x' || substr(hex(encode(coalesce(text, ''))), i, 2) AS BIGINT)) AS bytes FROM documents),
d AS (SELECT doc_id, len(bytes) + 1 AS size,
             xor(list_reduce(bytes, lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM b, c),
s AS (SELECT *, sum(size) OVER () AS total, sum(size) OVER w - size AS before, row_number() OVER w AS place
      FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, (2 * before + size) // ((2 * total + 15) // 16) AS shard FROM s)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS DOUBLE) AS grown_shard FROM p"""

#: A document leaves at the first of its failures in the order; everything else is counting.
_OP13 = """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
f AS (SELECT part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN (min(doc_id) OVER (PARTITION BY text)) < coalesce(doc_id, 9223372036854775807) THEN 'E' ELSE '' END AS failed,
             coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
      FROM t LEFT JOIN g USING (doc_id)),
n AS (SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY 1, 2),
x(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (SELECT *, coalesce(list_min(list_transform(string_split(nullif(failed, ''), ''), lambda y: strpos(filter_order, y))), 6) AS leaves FROM n, o),
s AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS BIGINT), 1) AS filter,
             sum(n * CAST(leaves > step AS INTEGER)) AS kept, sum(n * CAST(leaves = step AS INTEGER)) AS removed,
             sum(n * CAST(leaves < step AND contains(failed, substr(filter_order, CAST(step AS BIGINT), 1)) AS INTEGER)) AS redundant,
             sum(n * CAST(failed = substr(filter_order, CAST(step AS BIGINT), 1) AS INTEGER)) AS unique_fails,
             sum(good * CAST(leaves = step AS INTEGER)) AS good_lost, sum(toxic * CAST(leaves = step AS INTEGER)) AS toxic_lost
      FROM r, range(1, 6) q(step) GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM s"""

ORACLES: dict[str, str] = {"op6_warc": _OP6, "op8_benchmark_decontamination": _OP8, "op12_sharding": _OP12, "op13_filter_interaction_audit": _OP13}
