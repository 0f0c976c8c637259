"""Periodic runs against a brute-force version that tries every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import SF_SMALL, documents

from tickwork.llm import periodic_runs
from tickwork.llm.periodic_runs import find_runs, runs_and_rest
from tickwork.llm.queries import op11_periodic_run_detection, planted_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """start, length, period of every run: each period's stretches, without those that have a smaller period."""
    words, found = np.array(words), {}
    for q in range(1, len(words) // 4 + 1):
        equal = np.concatenate(([False], words[:-q] == words[q:], [False]))
        edges = np.flatnonzero(np.diff(equal))
        for begin, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            if end - begin >= 4 * q:
                found.setdefault((begin, end), q)  # ascending: the first period of a stretch is its smallest
    return sorted((b, e - b, q) for (b, e), q in found.items() if e - b >= 6)


def found_in(docs):
    text, *run = find_runs(np.array([w for d in docs for w in d], dtype=np.int64), np.array([len(d) for d in docs], dtype=np.int64))
    out = [[] for _ in docs]
    for k, r in zip(text.tolist(), zip(*(c.tolist() for c in run), strict=True), strict=True):
        out[k].append(r)
    return out


def periodic(rng, n, symbols):
    """A text with periodic stretches written over each other, so that runs lie inside of runs."""
    words = [rng.randrange(symbols) for _ in range(n)]
    for _ in range(rng.randrange(6)):
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
        for i in range(a, min(n, a + p * rng.randint(2, 9) + rng.randrange(3))):
            words[i] = words[a + (i - a) % p]
    return words


def test_all_runs_of_random_and_nested_texts():
    rng = random.Random(7)
    docs = [periodic(rng, rng.randint(1, 700), rng.choice([1, 2, 3, 9, 1000])) for _ in range(500)] + [[], [3], [3] * 6, [3] * 5]
    found = found_in(docs)
    assert found == [brute(d) if d else [] for d in docs]
    assert sum(q >= 64 for runs in found for *_, q in runs) > 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4), st.integers(1, 12), st.integers(1, 7))
def test_repeated_parts(docs, times, take):
    docs = [d[:take] * times + d for d in docs]
    assert found_in(docs) == [brute(d) if d else [] for d in docs]


def test_period_words_of_highly_periodic_parts():
    """The period of the outer run is full of windows that the synchronising set leaves out."""
    unit = [1] * 40 + [2, 3] * 20 + [4] * 50 + [5, 6, 7]
    docs = [unit * 4, unit * 5 + [9], ([1] * 64 + [2]) * 9, [1, 2] * 5000]
    assert found_in(docs) == [brute(d) for d in docs]


def test_runs_do_not_depend_on_hashes(monkeypatch):
    rng = random.Random(3)
    docs = [periodic(rng, 300, 2) for _ in range(60)]
    before = found_in(docs)
    monkeypatch.setattr(periodic_runs, "_A", np.uint64(0xA0761D6478BD642F))
    assert found_in(docs) == before


def test_collapsed_text():
    texts = ["a b c a b c a b c a b c d", "\x0b x\tx x x\nx x x y ", None, "", "é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é"]
    lengths, runs, rest = runs_and_rest(pa.array(texts, type=pa.string()))
    assert rest.to_pylist() == ["a b c d", "x y", "", "", "é\xa0é"]
    assert lengths.tolist() == [13, 8, 0, 0, 6]
    assert [[tuple(r.values()) for r in one] for one in runs.to_pylist()] == [[(0, 12, 3)], [(0, 7, 1)], [], [], [(0, 6, 1)]]


def plant(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in op11_periodic_run_detection(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = plant(doc_id, text)
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        runs = brute([numbers[w] for w in words]) if words else []
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = rows[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == digest(" ".join(kept))
        planted += bool(runs)
    assert planted > 5


def test_planted_rows(spark):
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][:12]
    docs = documents(spark, [(k, " ".join(f"w{j}" for j in range(n))) for n, k in enumerate(ids)] + [(1, "a  b"), (None, "c"), (ids[0], None)])
    got = sorted(planted_texts(docs).collect(), key=str)
    assert got == sorted([(k, " ".join(plant(k, " ".join(f"w{j}" for j in range(n)))) if n else "") for n, k in enumerate(ids)] + [(1, "a  b"), (None, "c"), (ids[0], None)], key=str)


def test_edges(spark):
    long = "word " * 300_000 + "x y " * 100_000
    docs = documents(spark, [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (4, "b b b b b b"), (4, "b b b b b b"), (5, long)])
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()), key=lambda r: (r[0] or 0))
    assert got == [(None, 6, [(0, 6, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "b"), (4, 6, [(0, 6, 1)], "b"),
                   (5, 500_000, [(0, 300_000, 1), (300_000, 200_000, 2)], "word x y")]
    empty = periodic_runs.periodic_runs(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "runs", "collapsed"]
