"""Token counts at every prefix of a text, for a byte-level BPE vocabulary.

The tokens of a prefix are its last token after the tokens of a shorter
prefix, so one pass over a text, keeping the last token of each prefix, gives
the exact count of all prefixes. A token may follow another if no merge crosses
their border; that is read off the order in which the two were merged.

The pass runs on the words between which no merge is possible. What a word adds
doesn't depend on its text, so a worker keeps the result of words it has seen,
up to ``CACHE`` of them; the others are computed each time. Runs of white space
are taken with the word after them: where they split depends on it.

Defined results: a null text counts as an empty one (no token, no prefix);
rows are independent, so repeated ids or texts give one row each; an empty
table gives an empty table; further columns are left out. Texts are never cut.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tickwork.llm.common import batch_of, renamed, small_batches, worker_state

#: Pieces whose result a worker keeps (about 200 bytes each).
CACHE = 1_000_000

#: Fixed values of the vocabulary's format: the pattern that splits a text before the merges.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
PATTERN = regex.compile(WORDS.pattern + r"|\s+(?!\S)|\s+")
RUN = regex.compile(r"\s\s")
PIECES = regex.compile(r"\s*\S+|\s+")
SPACE = regex.compile(r"\s*")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabulary files write bytes: printable ones stand for themselves, others for 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def refuse_other_options(spec: dict, path: str) -> None:
    """``ValueError`` for a vocabulary whose options the counter doesn't implement: its counts would be wrong without a word."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [name for name in ("normalizer", "post_processor", "truncation", "padding") if spec.get(name)]
    wrong += [f"model.{name}" for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(name)]
    wrong += ["model.type"] * (model.get("type", "BPE") != "BPE")
    wrong += ["pre_tokenizer"] * (split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True))
    wrong += [f"added token {t['content']!r}" for t in spec["added_tokens"] if any(t.get(o) for o in ("single_word", "lstrip", "rstrip", "normalized"))]
    if wrong:
        raise ValueError(f"{path} isn't plain byte-level BPE: {', '.join(wrong)}")


class PrefixCounter:
    """Deltas of the token count, one for each code point of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_other_options(spec, path)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ids: dict[bytes, int] = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        size = max(self.ids.values()) + 1
        self.made, self.left, self.right = [-1] * size, [0] * size, [0] * size  # the merge that makes a token, and its parts
        self.rank: dict[tuple[int, int], int] = {}
        for k, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b = raw(a), raw(b)
            token, pair = self.ids[a + b], (self.ids[a], self.ids[b])
            self.rank[pair] = k
            self.made[token], self.left[token], self.right[token] = k, *pair
        self.longest = max(map(len, self.ids))
        self.follows: dict[int, bool] = {}
        self.seen: dict[str, bytes] = {}

    def may_follow(self, a: int, b: int) -> bool:
        """No merge joins the end of ``a`` with the start of ``b`` before both are complete."""
        key = a << 32 | b
        known = self.follows.get(key)
        if known is not None:
            return known
        until, made, rank, x, y = float("inf"), self.made, self.rank, a, b
        while True:
            if rank.get((x, y), until) < until:
                ok = False
                break
            if made[x] > made[y]:  # undo the later of the two merges
                until, x = made[x], self.right[x]
            elif made[y] >= 0:
                until, y = made[y] + 0.5, self.left[y]  # of equal merges the left one comes first
            else:
                ok = True
                break
        if len(self.follows) < CACHE:
            self.follows[key] = ok
        return ok

    def counts(self, word: str) -> list[int]:
        """Tokens of the prefixes of one word (no border inside), by code points, from the first."""
        b = word.encode("utf-8", "surrogatepass")
        last, count, ids = [0] * (len(b) + 1), [0] * (len(b) + 1), self.ids
        for end in range(1, len(b) + 1):
            for start in range(max(0, end - self.longest), end):
                token = ids.get(b[start:end])
                if token is not None and (not start or self.may_follow(last[start], token)):
                    last[end], count[end] = token, count[start] + 1
                    break
        if len(b) == len(word):
            return count[1:]
        return [count[k] for k in range(1, len(b) + 1) if k == len(b) or b[k] & 0xC0 != 0x80]

    def word(self, word: str) -> bytes:
        """The deltas of one word."""
        d = self.seen.get(word)
        if d is None:
            c = self.counts(word)
            if word in CONTRACTIONS:  # shorter prefixes split after the quote
                c[:-1] = [c[0], *(c[0] + x for x in self.counts(word[1:])[:-1])]
            d = bytes([(x - y) & 255 for x, y in zip(c, [0, *c], strict=False)])
            if len(self.seen) < CACHE and len(word) < 64:
                self.seen[word] = d
        return d

    def piece(self, piece: str) -> bytes:
        """The deltas of white space and the words after it: all white space of a prefix that ends in it is one word."""
        n = SPACE.match(piece).end()
        run = self.counts(piece[:n])
        out = [bytes([(x - y) & 255 for x, y in zip(run, [0, *run], strict=False)])]
        if n < len(piece):
            at = n - (n > 0 and piece[n - 1] == " ")  # one space belongs to the word after it
            before = run[n - 2] if n > 1 else 0  # else the last character of several is a word of its own
            if at == n and n:
                before += self.counts(piece[n - 1])[-1]
            for k, word in enumerate(WORDS.findall(piece, at)):
                d = self.word(word)
                if not k and n:  # the first character, and with it what the run counts as
                    took = n - at + 1
                    first = before + sum(x - 256 * (x > 127) for x in d[:took]) - run[-1]
                    d = bytes([first & 255]) + d[took:]
                out.append(d)
        return b"".join(out)

    def plain(self, text: str, out: list[bytes]) -> None:
        seen = self.seen
        if not RUN.search(text):
            for word in PATTERN.findall(text):
                d = seen.get(word)
                out.append(self.word(word) if d is None else d)
            return
        for piece in PIECES.findall(text):
            d = seen.get(piece)
            if d is None:
                d = self.piece(piece)
                if len(seen) < CACHE and len(piece) < 64:
                    seen[piece] = d
            out.append(d)

    def deltas(self, text: str) -> bytes:
        """int8 for each code point: by how much the count of the prefix that ends there differs from the one before."""
        out: list[bytes] = []
        if not self.special or not any(s in text for s in self.special):
            self.plain(text, out)
        else:
            parts = self.split_special.split(text)
            for k, part in enumerate(parts):
                if k % 2:
                    out.append(self.special_deltas((PIECES.findall(parts[k - 1]) or [""])[-1], part))
                else:
                    self.plain(part, out)
        return b"".join(out)

    def special_deltas(self, before: str, special: str) -> bytes:
        """While it is incomplete, a special string is ordinary text after the piece ``before`` it; then it is one token."""
        own: list[bytes] = []
        self.plain(before, own)
        alone = np.frombuffer(b"".join(own), dtype=np.int8).sum(dtype=np.int64)
        own = []
        self.plain(before + special, own)
        counts = np.cumsum(np.frombuffer(b"".join(own), dtype=np.int8), dtype=np.int64)[len(before) :] - alone
        counts[-1] = 1
        return np.diff(counts, prepend=0).astype(np.int8).tobytes()


def counter(path: str) -> PrefixCounter:
    """One for each worker process and vocabulary."""
    return worker_state(f"prefixes of {path}", lambda: PrefixCounter(path))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("prefix_deltas", pa.binary())])


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, prefix_deltas of every row; :func:`tokens_at` and :func:`chars_within` read the last one.

    ``vocabulary`` is the path of a byte-level BPE file that every worker can open.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            deltas = [c.deltas(t) for t in texts]
            yield batch_of(SCHEMA, batch.column(0), [len(t.encode("utf-8", "surrogatepass")) for t in texts], [int(np.frombuffer(d, dtype=np.int8).sum(dtype=np.int64)) for d in deltas], deltas)

    rows = renamed(docs, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, prefix_deltas binary")


@F.pandas_udf(IntegerType())
def _tokens_at(deltas, n_chars):
    return deltas.combine(n_chars, lambda d, n: int(np.frombuffer(d, dtype=np.int8, count=min(max(n, 0), len(d))).sum(dtype=np.int64)))


@F.pandas_udf(IntegerType())
def _chars_within(deltas, budget):
    def longest(d: bytes, most: int) -> int:
        fits = np.flatnonzero(np.cumsum(np.frombuffer(d, dtype=np.int8), dtype=np.int64) <= most)
        return int(fits[-1]) + 1 if len(fits) else 0

    return deltas.combine(budget, longest)


def tokens_at(deltas: Column, n_chars: Column | int) -> Column:
    """Exact tokens of the first ``n_chars`` code points, without encoding them again."""
    return _tokens_at(deltas, F.lit(n_chars) if isinstance(n_chars, int) else n_chars)


def chars_within(deltas: Column, budget: Column | int) -> Column:
    """Length of the longest prefix of at most ``budget`` tokens."""
    return _chars_within(deltas, F.lit(budget) if isinstance(budget, int) else budget)
