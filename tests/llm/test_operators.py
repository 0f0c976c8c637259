"""Operators against brute force, exact round trips or held-out accuracy."""

import collections
import hashlib
import itertools
import json
import random
import re
import string
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_tables import SF_MID, SF_SMALL, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickwork.llm import decontaminate, graph, html_extract, langid, packing, quality, queries, secret_scan, simhash, substring_dedup, token_counts, warc

BPE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())


# ------------------------------------------------------------------ 1 language ID
def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op1_language_id"](spark, SF_MID).toPandas()
    truth = duckdb.sql(f"SELECT doc_id, lang, crc32 FROM (SELECT doc_id, lang, 0 AS crc32 FROM '{SF_MID}/documents.parquet')").df()
    both = got.merge(truth, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    assert (both.lang_pred == both.lang)[both.held_out].mean() > 0.99
    assert both.score.between(0, 1).all()


def test_naive_bayes_equals_plain_counting(spark):
    train = [("abab", "x"), ("abc", "x"), ("zzz z", "y")]
    model = langid.train_model(spark.createDataFrame(train, "text string, lang string")).block(0)
    bits = model.bits
    counts = {lang: collections.Counter(int(b) for t, la in train if la == lang for g in langid.ngram_buckets([t], bits)[0] for b in g if b < 1 << bits) for lang in "xy"}
    text = "abz"
    joint = []
    for lang, docs in (("x", 2), ("y", 1)):
        total = sum(counts[lang].values()) + langid.ALPHA * (1 << bits)
        joint.append(np.log(docs / 3) + sum(np.log((counts[lang][int(b)] + langid.ALPHA) / total) for g in langid.ngram_buckets([text], bits)[0] for b in g if b < 1 << bits))
    assert np.allclose(model.scores([text])[0], joint, rtol=1e-5)
    assert model.predict(["12 34", None, ""])[0] == ["und"] * 3


def test_many_languages_in_blocks(spark, monkeypatch):
    """3,000 labels: the buckets stay, and blocks of languages give what one block gives."""
    rng = random.Random(2)
    words = {k: [f"{chr(97 + k % 26)}{''.join(rng.choices(string.ascii_lowercase, k=5))}" for _ in range(4)] for k in range(3000)}
    train = spark.createDataFrame([(" ".join(w), f"l{k:04}") for k, w in words.items()], "text string, lang string")
    texts = [(k, " ".join(rng.choices(words[k * 7 % 3000], k=6))) for k in range(120)] + [(200, None), (201, "12"), (None, "word"), (202, "")]
    docs = documents(spark, texts)
    blocked = langid.train_model(train)
    assert blocked.bits == langid.BUCKETS.bit_length() - 1 and blocked.blocks > 1
    assert all(blocked.block(k).weights.nbytes <= langid.MODEL_BYTES for k in range(blocked.blocks))
    monkeypatch.setattr(langid, "MODEL_BYTES", 1 << 30)
    whole = langid.train_model(train)
    assert whole.blocks == 1
    by = lambda m: {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(docs, m).collect()}
    one, many = by(whole), by(blocked)
    assert {i: lang for i, (lang, _) in one.items()} == {i: lang for i, (lang, _) in many.items()}
    assert all(np.isclose(one[i][1], many[i][1], rtol=1e-9) for i in one)
    assert one[200] == one[201] == one[202] == ("und", 0.0)
    assert sum(one[k][0] == f"l{k * 7 % 3000:04}" for k in range(120)) > 110
    named = langid.with_language(docs, blocked, "found")
    assert named.columns == [*docs.columns, "found"] and named.count() == len(texts)


def test_equal_scores_and_empty_labels(spark):
    train = spark.createDataFrame([("abc", "b"), ("abc", "a"), ("xyz", ""), ("abc", None)], "text string, lang string")
    model = langid.train_model(train).block(0)
    assert model.langs == ["", "a", "b"]
    assert model.predict(["abc", "xyz"])[0] == ["a", ""]


# ------------------------------------------------------------------ 2 secrets
def _plain_base(text):
    spans = []
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    for kind, pattern, least, group in (("assign", assign, 6, 1), ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile(r"[0-9a-f]+"), 24, 0)):
        spans += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    order = {"assign": 0, "access": 1, "hex": 2}
    return [(a, k, b) for a, k, b in sorted(spans, key=lambda s: (s[0], order[s[1]]))]


def test_secret_base_spans(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op2_secret_scans"](spark, SF_SMALL).collect()}
    for i, text in texts.items():
        want = _plain_base(text or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        kinds = collections.Counter(k for _, k, _ in want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert {f"{k}:{a}:{b}" for a, k, b in want} <= set(got[i].spans.split(","))


@pytest.mark.parametrize("text", ["passWORD : 'abcdef'", "secret=token=abcdef", "password: token:abcdefgh", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 14, "0" * 23, "a" * 24 + "g" + "1" * 30, "api_key=12345 apikey=123456 TOKEN ſecret=abcdefg"])
def test_secret_base_corner_cases(text):
    assert [(a, k, b) for a, b, k in sorted(secret_scan.base_spans(text), key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))] == _plain_base(text)


def test_novel_secrets_and_masking():
    novelty, rng = secret_scan.Novelty(), random.Random(3)
    key = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(32))
    text = f"Authorization header Bearer {key}, and private static final_configuration_manager1 done"
    spans = secret_scan.find_spans(text, novelty)
    assert [(text[a:b], k) for a, b, k in spans] == [(key, "novel")]
    assert secret_scan.mask(text, spans, "X") == text.replace(key, "X")
    assert secret_scan.find_spans(f"nothing sensitive {key}", novelty) == []
    known = f"{key} is in use. The key {key}"  # explained by the text around it
    assert secret_scan.find_spans(known, novelty) == []


@pytest.mark.parametrize("alphabet", [string.digits, "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/"])
def test_random_secrets_of_any_length(alphabet):
    rng, novelty = random.Random(8), secret_scan.Novelty()
    for n in (16, 40, 63, 64, 65, 128, 500, 2000):
        for _ in range(5):
            secret = "".join(rng.choices(alphabet, k=n - 2)) + alphabet[0] + alphabet[-1]
            text = f"the private key {secret} is kept elsewhere"
            assert [text[a:b] for a, b, _ in secret_scan.find_spans(text, novelty)] == [secret]


def test_time_is_linear_in_texts_full_of_sensitive_words():
    novelty, start = secret_scan.Novelty(), time.monotonic()
    assert secret_scan.find_spans("the key is good and fine today. " * 125_000, novelty) == []
    assert len(secret_scan.find_spans("password=abcdefgh secret key AAAAAAAAAAAAAAAAAAAA1 " * 50_000, novelty)) == 50_000
    assert time.monotonic() - start < 60


def test_candidates_begin_in_reach():
    key = "Zk8vQx2LmN9pR4sT7wYb"
    for gap, found in ((0, 0), (1, 1), (secret_scan.REACH, 1), (secret_scan.REACH + 1, 0)):
        text = "private" + "," * gap + key + ", " + key[::-1]
        assert [text[a:b] for a, b in secret_scan.candidates(text)][:1] == ([key] if found or gap == 0 else [])
    assert list(secret_scan.candidates("token " + "A1" * 5000 + " secret")) == [(6, 10_006)]


def test_letters_without_digits():
    rng, novelty = random.Random(9), secret_scan.Novelty()
    for n in (64, 128, 500, 2000):
        for letters in (string.ascii_letters, string.ascii_lowercase):
            secret = "".join(rng.choices(letters, k=n))
            text = f"authorization: Bearer {secret} was sent"
            assert [text[a:b] for a, b, _ in secret_scan.find_spans(text, novelty)] == [secret]
    for word in ("incomprehensibility", "Bundesverfassungsgericht", "getAuthenticationTokenProvider", "some-words-joined-by-a-hyphen", "xy12" * 100):
        assert secret_scan.find_spans(f"the private key {word} is no secret", novelty) == [], word


# ------------------------------------------------------------------ 3 HTML
def test_articles_of_given_pages(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall())
    for r in queries.QUERIES["op3_html_extraction"](spark, SF_SMALL).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL).group(1)
        blocks = (" ".join(html_extract.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header><a href="/">Site</a></header>
<nav><ul><li><a>Home</a><li><a>About</a></ul></nav><div class="cookie-notice">We use cookies &amp; more to make this site work well.</div>
<div id="content"><h1>A title &lt;b&gt;</h1><p>First one with a <a href="x">link</a> and enough words to be long, really quite long. Yes.
<p>Second&nbsp;one <br>here.<form><label>Your mail</label><button>Go</button></form>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I like this article very much and write a long comment on it.</p></div></section></div>
<aside><h3>Related</h3><ul><li><a>Other story</a></li></ul></aside><div class="ad">Buy now! A long advertisement with a lot of words in it.</div>
<footer>&copy; 2024</footer><script>if (a<b) "</p>"</script><!-- <p>no</p> --></body>"""


def test_page_without_article():
    assert html_extract.extract(PAGE) == "A title <b>\n\nFirst one with a link and enough words to be long, really quite long. Yes.\n\nSecond one here."


@pytest.mark.parametrize("tag", sorted(html_extract.RAW_TAGS))
def test_raw_elements_without_end(tag):
    texts = [b.text for b in html_extract.read_blocks(f"<p>before</p><{tag} x=1><p>behind</p><{tag}><div>and more</div>")]
    assert texts == (["before", "behind", "and more"] if tag in html_extract.MARKUP_TAGS else ["before"])
    assert [b.text for b in html_extract.read_blocks(f"<p>before</p><{tag}>in it</{tag}><p>behind</p>")] == ["before", "behind"]


@pytest.mark.parametrize("mark,bad,good", [("<nav>", True, False), ("<form>", True, False), ("<article>", False, True)])
def test_marks_in_the_middle_of_deep_nesting(mark, bad, good):
    (block,) = html_extract.read_blocks("<span>" * 500 + mark + "<span>" * 500 + "some words")
    assert block.leaf.content == {(True, False): False, (False, True): True}[bad, good]
    assert (block.depth, block.leaf.marked) == (1001, 501)


def test_common_elements_of_deep_blocks():
    """Common depth is that of the whole paths, however deep, and edges follow from it."""
    rng = random.Random(4)
    for _ in range(40):
        html, opened = [], []
        for k in range(120):
            kind = rng.random()
            if kind < 0.5:
                opened.append(rng.choice(["div", "span", "section", "b", "nav", "p", "li", "ul"]))
                html.append(f"<{opened[-1]}>")
            elif kind < 0.7 and opened:
                html.append(f"</{opened.pop(rng.randrange(len(opened)))}>")
            else:
                html.append(f"word{k} ")
        blocks = html_extract.read_blocks("<div>" * 200 + "".join(html))

        def path(block):
            out, e = [], block.leaf
            while e is not None:
                out, e = [e, *out], e.parent
            return out

        weights = dict(((j, k), w) for j, k, w in html_extract.edges(blocks))
        for k in range(1, len(blocks)):
            a, b = path(blocks[k - 1]), path(blocks[k])
            common = sum(1 for _ in itertools.takewhile(lambda xy: xy[0] is xy[1], zip(a, b, strict=False)))
            assert blocks[k].common == common
            apart = any(e.bad or e.good for e in (*a[common:], *b[common:]))
            assert weights[k - 1, k] == round(html_extract.UNIT * 1.5 * (2 * common + 1) / (len(a) + len(b) + 1) * (0.1 if apart else 1.0))


def test_time_is_linear_in_open_elements():
    n, start = 200_000, time.monotonic()
    assert html_extract.extract("<span>" * n + "</b>x" * n) == ""  # one word without an end
    assert html_extract.read_blocks("<b><div>" + "<span>" * n + "</b>x" * n)[0].text == "x" * n
    assert len(html_extract.read_blocks("<div>" * n + "<p>some text</i></td>" * 20_000)) == 20_000
    assert len(html_extract.read_blocks("<article><div>" * 50_000 + "<li>text" * 20_000)) == 20_000
    assert time.monotonic() - start < 60


TABLES = """<html><body><table width=100%><tr><td colspan=2><a href=/>Home</a> | <a href=/news>News</a> | <a href=/about>About</a></td></tr>
<tr><td><a href=1>First</a><br><a href=2>Second</a><br><a href=3>Third</a></td><td>
<h1>Tides of the northern coast</h1><p>The water along the northern coast rises twice a day, and each time it brings sand from the banks further out at sea.</p>
<p>Fishermen have kept tables of it for three hundred years, which are now used to check the models of the institute.</p></td></tr>
<tr><td colspan=2>&copy; 2024 Coast News. All rights reserved.</td></tr></table></body></html>"""
COMMENTS = """<body><div id=nav><ul><li><a href=a>Start</a><li><a href=b>Topics</a></ul></div><div class=wrap><div class=entry-content><h2>A bridge is closed</h2>
<p>The old bridge over the river will be closed for repairs until the end of the year, the town council has decided.</p>
<p>Buses take the road through the village instead, which adds ten minutes to the journey.</p></div>
<div class=comments><h3>2 comments</h3><div class=comment><p>I have waited for this decision for years, the bridge was dangerous for everybody.</p></div>
<div class=comment><p>And who pays for the longer journey that all of us have from now on?</p></div></div></div><div id=footer>Imprint | Privacy</div></body>"""
PLAIN = """<body><p><a href=/>Index</a></p><h1>Notes on grinding</h1>
<p>A burr grinder crushes the beans between two rings, and the distance of the rings decides how fine the powder gets.</p>
<p>Blades chop instead, so that fine and coarse pieces are mixed, whatever one does with the switch of the machine.</p></body>"""


@pytest.mark.parametrize("page, first, last, out", [(TABLES, "Tides of the", "of the institute.", ["Home", "Second", "rights reserved"]), (COMMENTS, "A bridge", "to the journey.", ["Topics", "2 comments", "who pays", "Imprint"]), (PLAIN, "Notes on", "of the machine.", ["Index"])])
def test_other_layouts(page, first, last, out):
    """Tables as layout, no article element, comments outside of it, plain pages."""
    text = html_extract.extract(page)
    assert text.startswith(first) and text.endswith(last)
    assert not any(o in text for o in out)


def test_minimum_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        excess = [rng.randint(-9, 9) for _ in range(n)]
        links = [(a, b, rng.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda side: sum(-x if s and x < 0 else x if not s and x > 0 else 0 for s, x in zip(side, excess, strict=True)) + sum(w for a, b, w in links if side[a] != side[b])  # noqa: B023, E731
        assert cost(html_extract.source_side(excess, links)) == min(map(cost, itertools.product((False, True), repeat=n)))


# ------------------------------------------------------------------ 4 quality
def test_quality_measures_and_verdicts(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_MID}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall())
    right = []
    for r in queries.QUERIES["op4_quality_rules"](spark, SF_MID).collect():
        text = truth[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = collections.Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert r.base_failed == failed and not (failed and r.kept)
        if r.doc_id in labels and not failed:
            right.append(r.kept == bool(labels[r.doc_id]))
    assert np.mean(right) > 0.97


def test_em_finds_rates_of_made_votes():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    rates = [0.9, 0.8, 0.85, 0.75]
    votes = ["".join("+-"[int((rng.random() < r) != g)] for r in rates) for g in good]
    posterior = quality.fit(collections.Counter(votes))
    assert abs(np.mean([posterior[v] > 0.5 for v in votes]) - 0.7) < 0.06
    assert np.mean([(posterior[v] > 0.5) == g for v, g in zip(votes, good, strict=True)]) > 0.9
    assert quality.fit({}) == {}


# ------------------------------------------------------------------ 5 packing
def test_packing_round_trip(spark, texts):
    tokenizer = Tokenizer.from_file(WORD)
    got = queries.QUERIES["op5_best_fit_packing"](spark, SF_SMALL).toPandas()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    assert sorted(set(got.doc_id)) == sorted(texts)
    for r in got.itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 4096 * r.piece and len(part) == r.length and (r.length == 4096 or r.start + r.length == len(ids[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    assert got.length.sum() == sum(map(len, ids.values()))
    in_order = got.sort_values(["sequence_id", "offset"])
    assert (in_order.groupby("sequence_id").length.cumsum() - in_order.length == in_order.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 1


def test_word_encoder_equals_library():
    parts = ["a", "b", " ", "\n", "'", "'re", "É", "é", "23", "!", "\x1c", "\x85", "\xa0", "日", "́", "<|endoftext|>", "don't", "Hello", ",", ".", "***", "²", "😀", "​", "İ", "ſ", "क़", "Å", "ß"]
    rng, enc = random.Random(1), packing.WordEncoder(WORD)
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, raw in zip(made, enc.ids(made), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_evolution_keeps_items_and_never_loses_to_its_start():
    rng = random.Random(2)
    for seed in range(12):
        length = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        first = packing.evolve(length, [], 100, seed, 4, 0)
        people = packing.evolve(length, first, 100, seed, 4, 20)
        for of in people:
            fill = collections.Counter()
            for n, b in zip(length, of, strict=True):
                fill[b] += n
            assert len(of) == len(length) and max(fill.values()) <= 100
        assert max(people[0]) <= max(first[0])


def _bins(solution):
    return max(solution) + 1


def _hard_lengths(kind, seed):
    """Lengths that best fit packs badly: two or three to a bin, or triplets that fill bins exactly."""
    rng = random.Random(seed)
    if kind == "middle":
        return [rng.randint(1100, 1800) for _ in range(600)]
    triplets = []
    for _ in range(200):
        a = rng.randint(1030, 2000)
        b = rng.randint(1030, min(2000, 4096 - a - 1030))
        triplets += [a, b, 4096 - a - b]
    return triplets


def _islands(length, epochs, move):
    people = [[] for _ in range(3)]
    for epoch in range(epochs):
        people = [packing.evolve(length, p, 4096, k, 4, 8) for k, p in enumerate(people)]
        if move and epoch + 1 < epochs:
            people = [p + [people[k - 1][0]] for k, p in enumerate(people)]
    return min(_bins(p[0]) for p in people)


def test_islands_beat_best_fit_and_migration_counts():
    found = []
    for kind, seed in itertools.product(("middle", "triplets"), range(4)):
        length, plain = _hard_lengths(kind, seed), []
        packing.best_fit(plain, [], list(range(len(length))), length, 4096)
        found.append((len(plain), _islands(length, 1, False), _islands(length, 2, True), _islands(length, 4, False), _islands(length, 4, True)))
    for plain, one, two, alone, moved in found:
        assert one <= 0.985 * plain and two <= one
        assert moved <= alone and moved < 0.97 * plain
    assert sum(m < a for *_, a, m in found) >= 6  # islands that get others' elites end lower


def test_packing_beats_best_fit(spark):
    length, plain = _hard_lengths("middle", 1), []
    packing.best_fit(plain, [], list(range(len(length))), length, 4096)
    placed = packing.pack(spark.createDataFrame(list(enumerate(length)), "row long, length long"), 4096).toPandas()
    assert sorted(placed["row"]) == list(range(600)) and placed.sequence_id.nunique() <= 0.98 * len(plain)


def test_displaced_pieces_take_places():
    length = [50, 30, 40, 45, 20]
    bins, rooms = [[0, 1]], [20]
    assert sorted(packing.take_places(bins, rooms, [2, 3, 4], length)) == [0, 1, 4] or sorted(i for b in bins for i in b) != [0, 1]
    assert sum(length[i] for i in bins[0]) + rooms[0] == 100 and rooms[0] < 20


def test_packing_over_levels_places_each_piece_once(spark):
    rng = random.Random(7)
    rows = [(k, rng.randint(1, 45)) for k in range(700)]
    placed = packing.pack(spark.createDataFrame(rows, "row long, length long"), 100, block=50).toPandas()
    assert sorted(placed["row"]) == list(range(700))
    placed["length"] = placed["row"].map(dict(rows))
    assert placed.groupby("sequence_id").length.sum().max() <= 100
    assert placed.sequence_id.nunique() <= sum(n for _, n in rows) / 100 * 1.05 + 1


@pytest.mark.parametrize("capacity,block,most", [(4096, 2048, 1), (4096, 2048, 40), (100, 50, 2)])
def test_packing_of_tiny_pieces_ends(spark, monkeypatch, capacity, block, most):
    tables = []
    real = packing.written
    monkeypatch.setattr(packing, "written", lambda df, name: tables.append(name) or len(tables) < 60 and real(df, name))  # without an end, an error
    rng = random.Random(10)
    rows = [(k, rng.randint(1, most)) for k in range(5000)]
    placed = packing.pack(spark.createDataFrame(rows, "row long, length long"), capacity, block=block).toPandas()
    assert sorted(placed["row"]) == list(range(5000))
    placed["length"] = placed["row"].map(dict(rows))
    in_order = placed.sort_values(["sequence_id", "offset"])
    assert (in_order.groupby("sequence_id").length.cumsum() - in_order.length == in_order.offset).all()
    assert in_order.groupby("sequence_id").length.sum().max() <= capacity
    assert placed.sequence_id.nunique() <= -(-sum(n for _, n in rows) // capacity) + 1


def test_packing_of_null_texts(spark):
    docs = documents(spark, [(k, None if k % 2 else "") for k in range(4500)])
    got = packing.pack_documents(docs, WORD).toPandas()
    assert sorted(got.doc_id) == list(range(4500)) and (got.length == 1).all()
    assert got.sequence_id.nunique() == 2 and not got.duplicated(["sequence_id", "offset"]).any()


# ------------------------------------------------------------------ 6 WARC
def test_warc_round_trip_revisits_and_same_bytes(spark, tmp_path):
    rows = [(1, "u1", "x" * 200), (2, "u\n2", "x" * 200), (2, "u2", "x" * 200), (3, None, None), (4, "u", "y" * 10), (5, "u", "y" * 10), (None, "u", "x" * 200), (None, "q", "z" * 300), (None, "q", "z" * 300), (7, "é", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    first, second = warc.write_archives(pages, a, roll_bytes=600), warc.write_archives(pages.repartition(5), b, roll_bytes=600)
    digests = lambda m: [tuple(r) for r in m.orderBy("file").select("file", "records", "sha256").collect()]
    assert digests(first) == digests(second) and first.count() > 1
    got = warc.read_archives(first, a).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in got) == sorted(
        [("1", "response", "None"), ("2", "revisit", "1"), ("2", "revisit", "1"), ("3", "response", "None"), ("4", "response", "None"), ("5", "response", "None"), ("None", "revisit", "1"), ("None", "response", "None"), ("None", "revisit", "None"), ("7", "response", "None")]
    )
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_temporary")]


# ------------------------------------------------------------------ 7 token counts
def test_every_prefix_equals_library():
    parts = ["a", "b", " ", "  ", "\n", "'", "'re", "'ll", "'v", "é", "1", "23", "!", "?", "\t", "\x1c", "\x85", "\xa0", "日", "́", "<|endoftext|>", "don't", "Hello", "--", "²", "😀", "​", "İ", "'R"]
    rng, c, t = random.Random(1), token_counts.counter(BPE), Tokenizer.from_file(BPE)
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        got = np.cumsum(np.frombuffer(c.deltas(text), dtype=np.int8), dtype=int).tolist()
        assert got == [len(t.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]


def test_token_counts_truncation_and_budget(spark, texts):
    t = Tokenizer.from_file(BPE)
    got = {r.doc_id: r for r in queries.QUERIES["op7_token_counts"](spark, SF_SMALL).collect()}
    for i, text in texts.items():
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 512)
    docs = spark.createDataFrame([(1, "Hello there, how are you doing today?")], "doc_id long, text string")
    counted = token_counts.count_tokens(docs, BPE)
    text = docs.first().text
    r = counted.select(token_counts.tokens_at("prefix_deltas", 9).alias("at"), token_counts.chars_within("prefix_deltas", 4).alias("fit")).first()
    assert r.at == len(t.encode(text[:9]).ids) and len(t.encode(text[: r.fit]).ids) <= 4 < len(t.encode(text[: r.fit + 1]).ids)


# ------------------------------------------------------------------ 8 decontamination
def test_masks_miss_no_two_changes():
    assert decontaminate.masks_survive(13, 2) == 1.0


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 2000])
def test_changed_passages(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    item = [f"w{k}" for k in range(13)]
    docs = []
    for changed in (0, 1, 2, 3):
        for _ in range(6):
            body = list(item)
            for k in rng.sample(range(13), changed):
                body[k] = f"z{rng.getrandbits(40)}"
            docs.append((len(docs), " ".join([f"q{rng.getrandbits(40)}" for _ in range(rng.randint(0, 9))] + body + ["end"] * rng.randint(0, 5)).upper()))
    bench = spark.createDataFrame([(9, " ".join(item)), (8, ", ".join(item)), (7, "one two"), (6, None), (5, "k1 k2 k3 k4 k5 k6 k7 k8 k9")], "item_id long, text string")
    docs += [(100, "so k1 k2 k3 k4 k5 k6 k7 k8 k9 it ends"), (101, "so k1 k2 k3 k4 zz k6 k7 k8 k9 it ends"), (102, "one two")]
    docs += [(103, "two one"), (104, "it has one, Two words"), (105, "one")]
    got = {r.doc_id: (r.item_id, r.n_equal) for r in decontaminate.find_passages(documents(spark, docs), bench).collect()}
    assert got == {k: (8, 13 - k // 6) for k in range(18)} | {100: (5, 9), 102: (7, 2), 104: (7, 2)}


@pytest.mark.parametrize("n", range(1, 8))
def test_items_shorter_than_a_seed(spark, n):
    """Items of 1 to 7 words are found where all their words are, at the ends of a document too."""
    item = [f"k{j}" for j in range(n)]
    bench = spark.createDataFrame([(4, " ".join(item)), (3, "-".join(item)), (9, "!")], "item_id long, text string")
    docs = [(1, " ".join(item)), (2, " ".join(["a", *item])), (3, " ".join([*item, "b"])), (4, " ".join(item[:-1])), (5, " ".join([*item[:-1], "zz"])), (6, "a b c d e f g h i j k l m n " + " ".join(item).upper() + ". x")]
    got = {r.doc_id: (r.item_id, r.n_equal) for r in decontaminate.find_passages(documents(spark, docs), bench).collect()}
    assert got == {k: (3, n) for k in (1, 2, 3, 6)}


def _windows(text):
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    return [words[k : k + 13] for k in range(len(words) - 12)]


@pytest.mark.parametrize("hot", [decontaminate.HOT, 3, 0])
def test_hot_seeds_lose_no_pair(spark, monkeypatch, hot):
    """Items that share a phrase, documents that hold the phrase with words of their own or an item's: against all pairs of windows."""
    monkeypatch.setattr(decontaminate, "HOT", hot)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 200_000)
    rng = random.Random(12)
    phrase = "which of the following is the most likely reason why".split()
    own = lambda: [f"u{rng.getrandbits(30)}" for _ in range(rng.randint(0, 6))]
    items = [own() + phrase + own() for _ in range(60)] + [phrase[:8] + [f"s{k}"] for k in range(5)] + [phrase[:9]]
    docs = []
    for k in range(80):
        body = list(items[rng.randrange(len(items))])
        for _ in range(rng.randint(0, 3)):
            body[rng.randrange(len(body))] = f"z{rng.getrandbits(30)}"
        docs.append(own() + own() + body + own() + (own() + phrase if k % 3 else []))
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_passages(documents(spark, [" ".join(d) for d in docs]), bench)
    got = {r.doc_id: (r[1], r[2]) for r in found.groupBy("doc_id").agg({"item_id": "min", "n_equal": "max"}).select("doc_id", "min(item_id)", "max(n_equal)").collect()}
    want = {}
    for d, words in enumerate(docs):
        hits = []
        for k, item in enumerate(items):
            if len(item) < 13:
                if any(words[a : a + len(item)] == item for a in range(len(words))):
                    hits.append((k, len(item)))
            else:
                best = max((sum(x == y for x, y in zip(a, b, strict=True)) for a in _windows(" ".join(words)) for b in _windows(" ".join(item))), default=0)
                if best >= 11:
                    hits.append((k, best))
        if hits:
            want[d] = (min(k for k, _ in hits), max(n for _, n in hits))
    assert got == want and len(want) > 30


def test_work_follows_matches_in_hot_seeds(spark):
    """20,000 items and documents share nine words and nothing else: no pair of them is compared, the one planted is found."""
    phrase = "which of the following is the most likely reason"
    rows = spark.range(20_000).select("id", F.format_string(f"x%d y%d {phrase} z%d v%d w%d", *[F.abs(F.xxhash64("id", F.lit(k))) for k in range(5)]).alias("text"))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.format_string(f"a%d b%d {phrase} c%d d%d e%d", *[F.abs(F.xxhash64("id", F.lit(9 + k))) for k in range(5)]).alias("text"))
    docs = docs.unionByName(rows.where("id = 777").select((F.col("id") + 100_000).alias("doc_id"), "text"))
    start = time.monotonic()
    found = decontaminate.find_passages(docs, rows.withColumnRenamed("id", "item_id")).collect()
    assert [tuple(r) for r in found] == [(100_777, 777, 13)]
    assert time.monotonic() - start < 120


# ------------------------------------------------------------------ 7 vocabularies of other kinds
def test_counter_refuses_options_that_it_lacks(tmp_path):
    with open(BPE, encoding="utf-8") as f:
        plain = json.load(f)
    token_counts.refuse_other_options(plain, BPE)
    with pytest.raises(ValueError, match="normalizer, model.end_of_word_suffix, pre_tokenizer"):
        token_counts.PrefixCounter(WORD)
    for change in ({"model": plain["model"] | {"ignore_merges": True}}, {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": plain["pre_tokenizer"] | {"add_prefix_space": True}}, {"added_tokens": [{"content": "x", "lstrip": True}]}):
        with pytest.raises(ValueError, match="plain byte-level"):
            token_counts.refuse_other_options(plain | change, "other.json")


# ------------------------------------------------------------------ 9 SimHash
def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_simhash_equals_brute_force(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op9_simhash_near_dedup"](spark, SF_SMALL).collect()}
    want = {i: _fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in want.items()}
    root = {i: i for i in want}
    while True:
        new = {i: min(root[j] for j in want if bin(want[i] ^ want[j]).count("1") <= 3) for i in want}
        if new == root:
            break
        root = new
    assert {i: r.component_id for i, r in got.items()} == root


@pytest.mark.parametrize("hot,block", [(64, 4096), (2, 16)])
def test_links_find_all_near_fingerprints(spark, monkeypatch, hot, block):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK_TABLE", block)
    monkeypatch.setattr(simhash, "BLOCK_ASK", block)
    rng = random.Random(8)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = graph.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    root = {x: x for x in signed}
    while True:
        new = {x: min(root[y] for y in signed if bin((x ^ y) & (1 << 64) - 1).count("1") <= 3) for x in signed}
        if new == root:
            break
        root = new
    lone = {x for x in signed if list(root.values()).count(root[x]) == 1}
    assert {r.node: r.root for r in found} == {x: r for x, r in root.items() if x not in lone}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (500, 500)], "a long, b long")
    assert {r.node: r.root for r in graph.components(edges).collect()} == {k: 0 for k in range(201)} | {500: 500, 501: 500}


# ------------------------------------------------------------------ 10 passages
def _words(rng, n):
    return [f"w{rng.getrandbits(40):x}" for _ in range(n)]


def test_compact_windows_hold_every_stretch_once():
    rng = np.random.default_rng(3)
    for n, least in ((40, 7), (25, 25), (10, 11)):
        h = rng.integers(0, 30, n)
        windows = substring_dedup.compact_windows(h, least)
        for i in range(n):
            for j in range(i + least - 1, n):
                held = [c for a, c, b in windows if a <= i <= c <= j <= b]
                assert held == [i + int(h[i : j + 1].argmin())]


def test_shared_passages_are_found_and_others_left_alone(spark):
    rng = random.Random(6)
    passage, line = _words(rng, 52), _words(rng, 18)
    docs, want = [], set()
    for k in range(30):
        a, b = _words(rng, rng.randint(0, 90)), _words(rng, rng.randint(0, 90))
        if k % 3 == 0:  # the passage, at times with a word changed
            body = list(passage)
            if k % 2:
                body[25] = "changed"
            docs.append(" ".join(a + body + b))
            want.add(k)
        elif k % 3 == 1:  # a common line is too short to be a passage
            docs.append(" ".join(a + line + b))
        else:
            docs.append(" ".join(a + b))
    near = _words(rng, 60)  # only these two share a passage around the common line
    docs += [" ".join(_words(rng, 30) + near[:25] + line + near[25:] + _words(rng, 30)) for _ in range(2)]
    want |= {30, 31}
    docs += [docs[2]]
    want |= {2, 32} if len(docs[2].split()) >= 50 else set()
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    assert set(got.doc_id) == want
    for r in got[got.doc_id.isin([k for k in want if k < 30 and k % 3 == 0])].itertuples():
        words = docs[r.doc_id].split()[r.start : r.end]
        assert len(set(words) & set(passage)) >= 50 and len(words) <= 54


def test_shuffled_joins_change_nothing(spark, monkeypatch):
    """Joins without a broadcast give the same spans."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    spans = lambda: sorted(tuple(r) for r in substring_dedup.repeated_passages(docs).collect())
    before = spans()
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    assert spans() == before and len(before) > 50


def test_recall_of_changed_passages(spark):
    """Pairs share 60 words of which one is changed, so some 50 of them are similar enough, without or with a third document that only has their common line."""
    rng, docs, pairs = random.Random(21), [], []
    for k in range(60):
        passage, line = _words(rng, 60), _words(rng, 20)
        for j in range(2):
            body = list(passage)
            if j:
                body[rng.randrange(60)] = f"changed{k}"
            if k >= 30:  # a group whose first document lacks the passage
                body = body[:30] + line + body[30:]
            docs.append(" ".join(_words(rng, 40) + body + _words(rng, 40)))
        pairs.append((len(docs) - 2, len(docs) - 1))
        docs += [" ".join(_words(rng, 50) + line + _words(rng, 50)) for _ in range(3)] if k >= 30 else [" ".join(_words(rng, 120))]
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    spans = {i: [(r.start, r.end) for r in g.itertuples()] for i, g in got.groupby("doc_id")}
    near = lambda i: any(min(b, 100) - max(a, 40) >= 45 for a, b in spans.get(i, []))
    for part in (pairs[:30], pairs[30:]):
        assert sum(near(i) and near(j) for i, j in part) >= 0.9 * len(part)
    assert set(spans) <= {i for p in pairs for i in p}  # a line of 20 words is no passage


def test_given_exact_passages_are_found(spark, texts):
    got = substring_dedup.repeated_passages(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).toPandas()
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    holders = collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    spans = got.groupby("doc_id").apply(lambda g: list(zip(g.start, g.end, strict=True)), include_groups=False).to_dict() if len(got) else {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            if len(holders[tuple(w[k : k + 50])]) > 1:
                assert any(a <= k and k + 50 <= b for a, b in spans[i])


def test_passages_of_members_that_the_first_document_lacks(spark):
    rng, docs = random.Random(11), []
    for k in range(16):  # many hold a clause, one more words after it, one only its end and those words
        clause, after = _words(rng, 60), _words(rng, 10 + k % 3)
        docs += [" ".join(_words(rng, 20) + clause + _words(rng, 20)) for _ in range(4)]
        docs.append(" ".join(_words(rng, 20) + clause + after + _words(rng, 20)))
        docs.append(" ".join(_words(rng, 20) + clause[-40:] + after + _words(rng, 20)))
        docs.append(" ".join(_words(rng, 20) + clause[:30] + ["changed"] + clause[31:] + after + _words(rng, 20)))
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    spans = {i: list(zip(g.start, g.end, strict=True)) for i, g in got.groupby("doc_id")}
    words, holders = [d.split() for d in docs], collections.defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    for i, w in enumerate(words):
        for k in range(len(w) - 49):
            if len(holders[tuple(w[k : k + 50])]) > 1:
                assert any(a <= k and k + 50 <= b for a, b in spans.get(i, [])), (i, k)


def test_common_lines_under_the_least_length_are_no_passage(spark):
    rng, docs = random.Random(12), []
    for n in (42, 43, 44):  # 45 words hold enough equal shingles
        for _ in range(4):
            line = _words(rng, n)
            docs += [" ".join(_words(rng, 30) + line + _words(rng, 30)) for _ in range(5)]
    clean = len(docs)
    line, passage = _words(rng, 20), _words(rng, 40)
    docs += [" ".join(_words(rng, 30) + line + _words(rng, 30)) for _ in range(30)]
    docs += [" ".join(_words(rng, 30) + passage[:20] + line + passage[20:] + _words(rng, 30)) for _ in range(2)]
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    assert got.doc_id.min() >= clean and set(got.doc_id) == {len(docs) - 2, len(docs) - 1}
    assert all(docs[r.doc_id].split()[r.start : r.end] == passage[:20] + line + passage[20:] for r in got.itertuples())


def _linked(a, b, n=50, enough=41):
    """Whether some n words of each have so many five-word shingles in common."""
    x, y = ([hash(tuple(w[k : k + 5])) for k in range(len(w) - 4)] for w in (a, b))
    common = set(x) & set(y)
    marks = [k for k, h in enumerate(x) if h in common]
    there = {h: k for k, h in enumerate(y)}
    for i in range(len(x) - n + 5):
        inside = sorted(there[x[k]] for k in marks if i <= k < i + n - 4)
        if any(inside[k + enough - 1] - inside[k] < n - 4 for k in range(len(inside) - enough + 1)):
            return True
    return False


def _chained(got, docs):
    """Components of documents by the rows (doc_id, source_id)."""
    root = list(range(docs))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in got.itertuples():
        root[top(r.doc_id)] = top(r.source_id)
    return [top(k) for k in range(docs)]


def test_members_that_only_resemble_each_other(spark):
    """Two members of a large group share 50 words with one word changed, added or left out; the other members only have a line of theirs."""
    rng, docs, pairs = random.Random(31), [], []
    for k in range(24):
        line = _words(rng, 20)
        passage = _words(rng, k % 4) + line + _words(rng, 30 - k % 4)
        passage = passage[::-1] if k % 2 else passage
        line = line[::-1] if k % 2 else line
        at = 24 - k % 3 if k % 2 else 25 + k % 3
        edited = passage[:at] + ([], ["new"], ["new", passage[at]])[k % 3] + passage[at + 1 :]
        pairs.append((len(docs), len(docs) + 1))
        docs += [" ".join(_words(rng, 40) + x + _words(rng, 40)) for x in (passage, edited)]
        docs += [" ".join(_words(rng, 50) + line + _words(rng, 50)) for _ in range(12)]
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    assert all(_linked(docs[i].split(), docs[j].split()) for i, j in pairs)
    assert set(got.doc_id) == {i for p in pairs for i in p}
    tops = _chained(got, len(docs))
    for i in (i for p in pairs for i in p):
        assert any(a <= 42 and b >= 88 and a >= 39 and b <= 92 for a, b in zip(got.start[got.doc_id == i], got.end[got.doc_id == i], strict=True))
    assert all(tops[i] == tops[j] for i, j in pairs)


def test_links_of_many_variants_by_brute_force(spark):
    """Variants of passages, each with words changed, added and left out of its own: whichever two are similar enough are linked, and have a span there."""
    rng, docs = random.Random(32), []
    for _ in range(12):
        base = _words(rng, 90)
        for _ in range(12):
            new = lambda w: rng.choice([[], _words(rng, 1), [w, *_words(rng, 1)]])
            body = [x for w in base for x in (new(w) if rng.random() < 0.03 else [w])]
            docs.append(" ".join(_words(rng, 10) + body + _words(rng, 10)))
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    tops, held = _chained(got, len(docs)), set(got.doc_id)
    links = [(i, j) for g in range(0, len(docs), 12) for i in range(g, g + 12) for j in range(i + 1, g + 12) if _linked(docs[i].split(), docs[j].split())]
    assert len(links) > 100
    assert [p for p in links if p[0] not in held or p[1] not in held or tops[p[0]] != tops[p[1]]] == []


def test_each_source_has_its_row(spark):
    """Passages of two documents that touch in a third one are two rows: neither link is lost."""
    rng = random.Random(33)
    a, b = _words(rng, 60), _words(rng, 60)
    docs = [" ".join(x) for x in (_words(rng, 30) + a + _words(rng, 30), _words(rng, 30) + b + _words(rng, 30), _words(rng, 9) + a + b + _words(rng, 9))]
    got = substring_dedup.repeated_passages(documents(spark, docs)).toPandas()
    assert len(set(_chained(got, 3))) == 1


def test_displaced_shingles_that_come_twice():
    """A shingle that the other text also has far before counts by its nearest place."""
    words = lambda x: np.array(x, dtype=np.int32)
    rng = np.random.default_rng(5)
    own = rng.integers(1, 1 << 30, 60)
    other = np.concatenate([own[30:42], rng.integers(1, 1 << 30, 40), own[:28], own[29:]])
    pair, start, end, *_ = substring_dedup.repeated_stretches((words(own), np.array([0, 60])), (words(other), np.array([0, len(other)])), np.array([-52]), 46, 41)
    assert (list(pair), list(start), list(end)) == ([0], [0], [60])


def test_anchor_in_every_run_of_shingles():
    """Each 25 words of a text, in whatever text they stand, offer the same snippet."""
    rng = np.random.default_rng(8)
    for spread in (1, 3, 1 << 30):
        part = rng.integers(0, spread, 25)
        texts = [np.concatenate([rng.integers(0, 1 << 30, k), part, rng.integers(0, 1 << 30, 60 - k)]).astype(np.int32) for k in (7, 31)]
        found = []
        for k, t in zip((7, 31), texts, strict=True):
            _, at, key = substring_dedup.snippets(t, np.array([0, len(t)]), 46, 21)
            found.append({(int(a) - k, int(h)) for a, h in zip(at, key, strict=True) if k <= a and a + 15 <= k + 25})
        assert found[0] & found[1]


def test_pieces_hash_alike_wherever_they_stand():
    """A piece read forward, and one read backward, has the hash of its words in that order, whatever stands around it."""
    rng = np.random.default_rng(9)
    words = rng.integers(-(1 << 31), 1 << 31, 3000).astype(np.int32)
    alone = lambda x: substring_dedup._Pieces(x).at(0, np.array([0]), len(x))[0]
    pieces = substring_dedup._Pieces(words)
    for place, length in ((0, 1), (7, 25), (2975, 25), (100, 1500)):
        part = words[place : place + length]
        assert pieces.at(0, np.array([place]), length)[0] == alone(part)
        assert pieces.at(1, np.array([place + length]), np.array([length]))[0] == alone(np.ascontiguousarray(part[::-1]))


def test_snippets_meet_without_sorting_and_edited_keys_are_sifted(spark, monkeypatch):
    """First places are aggregated by hash, keys that no other document has aren't shuffled for joins, settings stay."""
    plans, kept = {}, substring_dedup.written

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(substring_dedup, "written", written)
    settings = lambda: {k: v for k, v in spark.conf.getAll.items() if "bloomFilter" in k}
    before, threshold = settings(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be broadcast
    try:
        assert substring_dedup.repeated_passages(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "HashAggregate" in plans["met"] and "SortAggregate" not in plans["met"]
    assert all("might_contain" in plans[name] for name in ("halves", "edits", "near"))
    assert settings() == before


def test_batches_are_cut_without_change(spark, monkeypatch):
    """Documents worked through one at a time, or all in one part, give the same spans."""
    rng, docs = random.Random(34), []
    for _ in range(6):
        base = _words(rng, 90)
        for _ in range(5):
            at = rng.randrange(30, 60)
            docs.append(" ".join(_words(rng, 10) + base[:at] + _words(rng, 1) + base[at + 1 :] + _words(rng, 10)))
    docs += ["", " ".join(_words(rng, 3)), " ".join(_words(rng, 900) + base)]
    spans = lambda: sorted(tuple(r) for r in substring_dedup.repeated_passages(documents(spark, docs)).collect())
    before, parts = spans(), substring_dedup._text_parts
    monkeypatch.setattr(substring_dedup, "_text_parts", lambda batches: parts(batches, 1))
    assert spans() == before and len({r[0] for r in before}) == 31


# ------------------------------------------------------------------ helpers
def test_worker_keeps_one_state():
    from tickwork.llm.common import forget_state, worker_state

    made = []
    make = lambda name: (lambda: made.append(name) or name)
    assert [worker_state("a", make("a")), worker_state("a", make("a")), worker_state("b", make("b")), worker_state("a", make("a"))] == ["a", "a", "b", "a"]
    forget_state()
    worker_state("a", make("a"))
    assert made == ["a", "b", "a", "a"]


def test_words_kept_do_not_change_ids(texts):
    small, large = packing.WordEncoder(WORD, words_kept=50), packing.WordEncoder(WORD)
    some = [t or "" for t in texts.values()][:60]
    assert [small.ids([t])[0] for t in some] == large.ids(some)
