"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections

import public_tokenizers
import pytest
from llm_tables import documents

from tickwork.llm import decontaminate, html_extract, langid, packing, quality, secret_scan, simhash, substring_dedup, token_counts, warc

LONG = " ".join(f"word{k % 977} x{k % 31}." for k in range(40_000))
ROWS = [(0, None), (1, ""), (2, " \n\t "), (3, "1234 #!"), (4, "a short text"), (4, "a short text"), (5, LONG), (6, LONG), (None, "no id but some words"), (7, "é" * 300), (8, "same same " * 2000)]
BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def model(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")], "text string, lang string")
    return langid.train_model(train)


OPERATORS = {
    "langid": lambda d: langid.identify_languages(d, model(d.sparkSession)),
    "secrets": secret_scan.scan_secrets,
    "quality": quality.rate_quality,
    "packing": lambda d: packing.pack_documents(d, WORD),
    "tokens": lambda d: token_counts.count_tokens(d, BPE),
    "simhash": simhash.near_duplicates,
    "substring": substring_dedup.repeated_passages,
    "decontaminate": lambda d: decontaminate.find_passages(d, d.selectExpr("doc_id AS item_id", "text").where("doc_id IN (0, 1, 4, 5)")),
}
PER_ROW = {"langid", "secrets", "quality", "tokens", "simhash"}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    got = OPERATORS[name](documents(spark, ROWS)).collect()
    if name in PER_ROW:
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    twins = [tuple(r)[1:] for r in got if r.doc_id == 4]
    if name in PER_ROW:
        assert len(twins) == 2 and twins[0] == twins[1]
    if name == "packing":
        by = collections.Counter(r.doc_id for r in got)
        assert [by[k] for k in (0, 1, 2, 3, 4, None, 7)] == [1, 1, 1, 1, 2, 1, 1] and by[5] == by[6] > 1
        assert all(r.length == 1 for r in got if r.doc_id in (0, 1, 2))  # the end token
        assert sorted((r.piece, r.ids_crc32) for r in got if r.doc_id == 5) == sorted((r.piece, r.ids_crc32) for r in got if r.doc_id == 6)
        filled = collections.Counter()
        for r in got:
            filled[r.sequence_id] += r.length
        assert max(filled.values()) <= 4096
    if name == "substring":
        assert sorted(map(tuple, got)) == [(k, 0, len(LONG.split()), got[0].source_id) for k in (5, 6)] and got[0].source_id in (5, 6)
    if name == "decontaminate":
        assert {(r.doc_id, r.item_id) for r in got} == {(4, 4), (5, 5), (6, 5)}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    full, empty = OPERATORS[name](documents(spark, ROWS[3:5])), OPERATORS[name](documents(spark, []))
    assert empty.collect() == []
    assert [f.name for f in empty.schema] == [f.name for f in full.schema]


def test_pages_edge_rows(spark, tmp_path):
    rows = [(1, "u", None, 1), (2, None, "", 2), (2, None, "", 2), (3, "u", "<p>x", 3), (None, "u", "<article><p>some words here.</article>", 4), (4, "u", "<p>" + LONG + "</p>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    texts = {r.page_id: r for r in html_extract.extract_text(pages).collect()}
    assert texts[1].text == texts[2].text == "" and texts[None].text == "some words here."
    assert texts[4].n_chars == len(texts[4].text) == len(LONG)
    manifest = warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.read_archives(manifest, str(tmp_path / "w")).count() == len(rows)
    none = pages.where("page_id < 0")
    assert html_extract.extract_text(none).count() == 0
    assert warc.read_archives(warc.write_archives(none, str(tmp_path / "e")), str(tmp_path / "e")).count() == 0
