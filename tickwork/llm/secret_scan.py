"""Secret spans of texts: fixed patterns, and strings that zstandard can't explain from their surroundings.

The patterns give the base spans. Further candidates are long strings of key
characters near a sensitive word. Each is measured by what it adds to the
compressed size of the text around it, by a compressor primed with a dictionary
of identifiers: names, paths and words that occur nearby cost few bytes, random
strings cost nearly all of theirs. A candidate is measured in pieces, each after
the ones before it: zstandard would code the letters of longer strings by their
frequency, and a random string of few different characters would look explained.
A candidate whose novelty, added bytes per character, reaches ``NOVELTY`` is
reported as kind ``novel``, unless a base span covers part of it.

Candidates mix letters and digits, or are all digits, or letters whose case
changes often or that are longer than words get; shorter letters of one case
can't be told from a rare word by what they add.

Defined results: a null text counts as an empty one (no span, the digest of an
empty list); rows are independent; an empty table gives an empty table; further
columns are left out. Spans are code points with an exclusive end, sorted by
start, then by the order of ``KINDS``. Texts are read whole, however long.
"""

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import batch_of, forget_state, renamed, small_batches

KINDS = ("assign", "access", "hex", "novel")

#: Fixed values of the contract: patterns, the group measured and its least length.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more is the run of one or more that isn't dropped
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Sensitive words, and how far after one (in characters) a candidate may start.
SENSITIVE = re.compile(r"password|passwd|pwd|passphrase|secret|token|credential|private|bearer|authorization|auth|api[_-]?key|access[_-]?key|client[_-]?id|signature|webhook|\bkey\b", re.IGNORECASE | re.ASCII)
_SENSITIVE_STEMS = ("pass", "pwd", "secret", "token", "credential", "private", "bearer", "auth", "key", "client", "signature", "webhook")
REACH = 48
LEAST = 16
_CHARACTERS = "[A-Za-z0-9+/_=-]"
CANDIDATE_START, CANDIDATE = re.compile(f"{_CHARACTERS}{{{LEAST}}}"), re.compile(f"{_CHARACTERS}+")
#: Added bytes per character from which a candidate is reported; text around it that primes the compressor.
NOVELTY, CONTEXT = 0.85, 1024
#: Characters of a piece; zstandard codes literals by frequency from 64 bytes.
PIECE = 32
#: Letters from which a string without digits can't be a word.
LONGEST_WORD = 40

#: Identifiers and phrases that code and configuration use often; the compressor knows them beforehand.
IDENTIFIERS = """abstract access_key access_token account address api_key application argument array async authorization
await base64 bearer boolean bucket buffer build callback catch certificate class client_id client_secret config
configuration connection const constructor container content-type context controller cookie credential customer
database default delete deploy description destination development directory document domain element encoding
encryption endpoint environment exception export expires_in extends false filename final finally float for frame
function generate get handler hash header host html http https identifier implements import index init input instance
integer interface internal iterator javascript json key label lambda language latest length library listener localhost
location logger login long manager message metadata method model module name namespace native network new node null
number object operation option order output override package parameter parent password path pattern payload permission
pipeline placeholder platform plugin port position prefix private private_key process production project property
protected protocol provider proxy public public_key python query queue random read record redirect refresh_token region
register release remote render repository request require reset resource response result return role router runtime
sample schema scope script secret secret_key security select sequence serialize server service session set settings
signature source staging static status storage stream string struct subscription super switch system table target task
template test this throw timestamp token transaction transform true type undefined update upload url user user_id
username utf-8 uuid validate value variable vector version void webhook while window worker write xml yaml
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX 0000000000000000
example changeme placeholder your_api_key your-secret-here ---------------- ================ ________________"""


class Novelty:
    """Marginal compressed size of a string, piece by piece, given the text around it and the identifier dictionary."""

    def __init__(self):
        self.prime = IDENTIFIERS.encode()
        # short matches count too: identifiers share parts of three letters and more
        self.parameters = zstandard.ZstdCompressionParameters(window_log=17, hash_log=12, chain_log=12, search_log=6, min_match=3, target_length=64, strategy=zstandard.STRATEGY_LAZY2, write_checksum=False, write_content_size=False, write_dict_id=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        after, added = text[end : end + CONTEXT], 0
        for a in range(start, end, PIECE):
            around = (text[max(0, a - CONTEXT) : a] + " " + after).encode("utf-8", "surrogatepass")
            known = zstandard.ZstdCompressionDict(self.prime + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            compress = zstandard.ZstdCompressor(dict_data=known, compression_params=self.parameters).compress
            added += len(compress(text[a : min(end, a + PIECE)].encode())) - len(compress(b""))
        return added / (end - start)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and without overlap for each kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def may_be_random(s: str) -> bool:
    """Whether what a string adds can tell it from words."""
    digits, letters = any(c.isdigit() for c in s), sum(c.isalpha() for c in s)
    if digits:
        return letters > 0 or s.isdigit()
    changes = sum(a.isalpha() and b.isalpha() and a.isupper() != b.isupper() for a, b in zip(s, s[1:], strict=False))
    return 4 * changes > len(s) or s.isalpha() and len(s) >= LONGEST_WORD


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Long strings that may be random and start at most REACH characters after a sensitive word.

    After each word only what is in reach is searched, and no string is read twice: the time is linear in the text.
    """
    low = text.lower() if text.isascii() else None
    if low is not None and not any(s in low for s in _SENSITIVE_STEMS):
        return
    done = 0
    for word in SENSITIVE.finditer(text):
        until = word.end() + REACH + LEAST  # where a string that begins in reach has its least length
        while m := CANDIDATE_START.search(text, max(done, word.end()), until):
            done = CANDIDATE.match(text, m.start()).end()
            if may_be_random(text[m.start() : done]):
                yield m.start(), done


def find_spans(text: str, novelty: Novelty) -> list[tuple[int, int, str]]:
    """All spans by start, then kind."""
    spans = base_spans(text)
    covered: list[list[int]] = []  # base spans, those that overlap as one, in order
    for a, b, _ in sorted(spans):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    k = 0
    for start, end in candidates(text):
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if (k == len(covered) or end <= covered[k][0]) and novelty(text, start, end) >= NOVELTY:
            spans.append((start, end, "novel"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_novel", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the number of spans of each kind, base_sha256 and spans of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in small_batches(batches):
            columns: list[list] = [[] for _ in range(len(SCHEMA) - 1)]
            for text in batch.column(1).to_pylist():
                spans = find_spans(text or "", novelty)
                base = [s for s in spans if s[2] != "novel"]
                row = [sum(s[2] == kind for s in spans) for kind in KINDS]
                for column, value in zip(columns, [*row, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)], strict=True):
                    column.append(value)
            yield batch_of(SCHEMA, batch.column(0), *columns)

    rows = renamed(docs, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[int, int, str]], by: str) -> str:
    """``text`` with each run of overlapping spans replaced."""
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], by]
        at = max(at, b)
    return "".join(out) + text[at:] if spans else text


def redacted(text: Column, by: str = "[SECRET]") -> Column:
    """The text with its secrets masked; null stays null."""

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget_state()
        novelty = Novelty()
        for texts in batches:
            for k in range(0, len(texts), 256):
                yield pd.Series([t if t is None else mask(t, find_spans(t, novelty), by) for t in texts.iloc[k : k + 256].tolist()], dtype=object)

    return redact(text)
