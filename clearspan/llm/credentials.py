"""Secrets in texts by patterns and by password guess cost (operator 11).

Patterns find assignments to credential names, access key ids and long hexadecimal runs.
Beyond them, every value in a credential context (a password or token that is set, quoted,
sent as a bearer token or written into an address) is cut into dictionary words, dates,
repeats, keyboard walks, sequences and brute-force spans so that the logarithm of the number
of guesses becomes smallest; a value that still needs many guesses is a secret.

Dictionary ranks are the order of the words in a public tokenizer's vocabulary, so the
dictionary is as large as that file, whatever the corpus. Values are cut whole, whatever their
length: each place of a value starts a bounded number of segments.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.llm.common import need
from clearspan.llm.spans import blocks, words_of
from clearspan.llm.tokens import tokenizer_file

VOCABULARY = "byte_bpe_50k.json"
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "guess")
#: Base-10 logarithm of the guesses from which a value in a credential context is a secret.
LEAST_GUESSES = 10.0

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Where a credential's value may stand; the group that matched is the value.
_CONTEXTS = (
    re.compile(
        r"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?|auth(?:orization)?)"
        r"[\"']?[ \t]*(?::=|=>|[:=]|(?<=[ \t])is(?=[ \t]))[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'<>]+))",
        re.I | re.A,
    ),
    re.compile(r"(?<![A-Za-z0-9])bearer[ \t]+([A-Za-z0-9+/_.=~-]+)", re.I | re.A),
    re.compile(r"://[^\s:@/]+:([^\s@/]+)@"),
    re.compile(r"<(?:password|passwd|secret|token)>([^<>\n]+)</", re.I | re.A),
)
#: Texts without any of these (in small letters) hold no context and no assignment.
_HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "://")

_NOT_HEX = np.ones(256, bool)
_NOT_HEX[48:58] = _NOT_HEX[97:103] = False
_HEX_LENGTH = 32

#: Rows of a keyboard, each shifted by about half a key against the one above.
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: Letters that other characters often stand for.
_LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}


def _neighbours() -> dict[str, dict[str, int]]:
    """For each key its neighbours, with the direction in which they lie."""
    place = {c: (r, k) for r, row in enumerate(_ROWS) for k, c in enumerate(row)}
    steps = ((0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0))
    at = {p: c for c, p in place.items()}
    return {c: {at[r + a, k + b]: d for d, (a, b) in enumerate(steps) if (r + a, k + b) in at} for c, (r, k) in place.items()}


class Guesser:
    """Smallest logarithm of guesses over all cuts of a value."""

    #: Longest dictionary word and longest repeated unit that are tried; a cut may hold any number of them.
    WORD, UNIT = 24, 8
    #: Cost of one more segment.
    SEGMENT = math.log10(2)

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.near = _neighbours()

    def brute(self, c: str) -> float:
        """Cost of one character that nothing explains."""
        if "0" <= c <= "9":
            return 1.0
        if c.isascii():
            return math.log10(26 if c.isalpha() else 33)
        return 2.0

    def words(self, value: str, plain: str, leet: str, i: int) -> Iterator[tuple[int, float]]:
        for j in range(i + 3, min(len(value), i + self.WORD) + 1):
            for text, extra in ((plain[i:j], 0), (leet[i:j], sum(a != b for a, b in zip(plain[i:j], leet[i:j], strict=True)))):
                rank = self.ranks.get(text)
                if rank:
                    upper = sum(c.isupper() for c in value[i:j])
                    cases = 0 if not upper else 1 if upper == j - i or (upper == 1 and value[i].isupper()) else min(upper, j - i - upper) + 1
                    yield j, math.log10(rank) + (cases + extra) * math.log10(2)
                if not extra and text == leet[i:j]:
                    break

    def dates(self, value: str, i: int) -> Iterator[tuple[int, float]]:
        """Years and days, with and without separators; both orders of day and month."""
        head = value[i : i + 10]
        if not head[:1].isdigit():
            return
        if re.match(r"(19|20)\d\d", head, re.A):
            yield i + 4, math.log10(max(20, abs(int(head[:4]) - 2000)))
        for pattern, order in (
            (r"(\d{4})([-/._]?)(\d\d)\2(\d\d)", "ymd"), (r"(\d\d)([-/._]?)(\d\d)\2(\d{4})", "dmy"), (r"(\d\d)([-/._]?)(\d\d)\2(\d\d)", "dmy"),
        ):
            m = re.match(pattern, head, re.A)
            if not m:
                continue
            a, b, c = int(m[1]), int(m[3]), int(m[4])
            year, days = (a, (b, c)) if order == "ymd" else (c, (a, b))
            year += 1900 if len(m[4]) == 2 and order == "dmy" and year >= 30 else 2000 if len(m[4]) == 2 and order == "dmy" else 0
            if 1900 <= year <= 2099 and min(days) in range(1, 13) and max(days) in range(1, 32):
                yield i + m.end(), math.log10(365 * max(20, abs(year - 2000)) * (4 if m[2] else 1))

    def walks(self, plain: str, i: int) -> Iterator[tuple[int, float]]:
        """Runs of neighbouring keys, and of characters one apart, of three or more."""
        turns, last, j = 0, None, i + 1
        while j < len(plain) and (way := self.near.get(plain[j - 1], {}).get(plain[j])) is not None:
            turns += way != last
            last, j = way, j + 1
            if j - i >= 3:
                yield j, math.log10(47 * (j - i)) + turns * math.log10(4)
        step, j = None, i + 1
        while j < len(plain) and plain[j].isalnum() and plain[j].isascii() and plain[j - 1].isalnum():
            d = ord(plain[j]) - ord(plain[j - 1])
            if abs(d) != 1 or (step is not None and d != step):
                break
            step, j = d, j + 1
            if j - i >= 3:
                yield j, math.log10(36 * (j - i))

    def runs(self, value: str) -> list[list[int]]:
        """For each unit length, how far the text repeats itself at that distance from each place on."""
        n, out = len(value), []
        for p in range(1, self.UNIT + 1):
            far = [0] * (n + 1)
            for i in range(n - p - 1, -1, -1):
                far[i] = far[i + 1] + 1 if value[i] == value[i + p] else 0
            out.append(far)
        return out

    def cost(self, value: str, repeats: bool = True) -> float:
        """Base-10 logarithm of the guesses that the cheapest cut of the whole value needs."""
        n = len(value)
        plain = "".join(c.lower() if c.isascii() else c for c in value)
        leet = "".join(_LEET.get(c, c) for c in plain)
        runs = self.runs(value) if repeats else []
        units: dict[str, float] = {}
        # closed: a segment ends here; brute: a brute-force span is still open here
        closed, brute = [math.inf] * (n + 1), [math.inf] * (n + 1)
        closed[0] = 0.0
        for i in range(n):
            here = min(closed[i], brute[i])
            start = here + self.SEGMENT
            brute[i + 1] = min(brute[i + 1], min(brute[i], closed[i] + self.SEGMENT) + self.brute(value[i]))
            for j, cost in (*self.words(value, plain, leet, i), *self.dates(value, i), *self.walks(plain, i)):
                closed[j] = min(closed[j], start + cost)
            for p, far in enumerate(runs, 1):
                times = far[i] // p + 1
                if times >= 2 and times * p >= 3:
                    unit = value[i : i + p]
                    if unit not in units:
                        units[unit] = self.cost(unit, repeats=False)
                    j = i + times * p
                    closed[j] = min(closed[j], start + units[unit] + math.log10(times))
        return min(closed[n], brute[n]) if n else 0.0


@lru_cache(maxsize=4)
def guesser(vocabulary: str) -> Guesser:
    """The worker's guesser with the words of a vocabulary file: letters only, three or more, in small letters."""
    with open(tokenizer_file(vocabulary), encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    ranks: dict[str, int] = {}
    for token in sorted(ids, key=ids.get):
        word = token.removeprefix("Ġ").removesuffix("</w>").lower()
        if len(word) >= 3 and word.isascii() and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return Guesser(ranks)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that are long enough, in code points."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def context_values(text: str) -> list[tuple[int, int]]:
    """Start and end of the values in credential contexts, each place once, in order."""
    found = set()
    for pattern in _CONTEXTS:
        for m in pattern.finditer(text):
            found.add(m.span(m.lastindex))
    return sorted(found)


def _guessed(text: str, base: list[tuple[int, int, int]], guess: Guesser, least: float) -> list[tuple[int, int, int, float]]:
    """Values that need many guesses and don't overlap a pattern match or an earlier value."""
    taken = sorted((a, b) for a, _, b in base)
    out: list[tuple[int, int, int, float]] = []
    k, edge = 0, 0  # edge: the furthest end of the matches that start before the value
    last = 0
    for a, b in context_values(text):
        while k < len(taken) and taken[k][0] < b:
            edge, k = max(edge, taken[k][1]), k + 1
        if edge > a or last > a:
            continue
        cost = guess.cost(text[a:b])
        if cost >= least:
            out.append((a, 3, b, cost))
            last = b
    return out


SPAN = "array<struct<start:bigint,kind:string,end:bigint,guesses:double>>"


def with_secrets(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, least: float = LEAST_GUESSES) -> DataFrame:
    """``docs`` with the column ``secrets``: kind, start, end (code points, end exclusive) of every secret.

    Spans are in order of start, then of ``KINDS``. ``guesses`` is the base-10 logarithm of the guesses
    of a value in a credential context and null for pattern matches; such a value is left out if it
    overlaps a pattern match or a value before it. A null or empty text has none. Rows stay as they are, equal rows
    too; a column named ``secrets`` is replaced. Texts and values are read whole, one pass, no shuffle.
    """
    need(docs, text)
    docs = docs.drop("secrets")
    kind = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("guesses", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, text):
            guess = guesser(vocabulary)
            starts, ends, before = words_of(data, offsets, _NOT_HEX)
            long = np.concatenate([[0], np.cumsum(ends - starts >= _HEX_LENGTH)])[before]
            has_hex = np.diff(long) > 0
            column = batch.column(batch.schema.get_field_index(text)).to_pylist()
            rows = []
            for k, value in enumerate(column):
                small = (value or "").lower()
                hinted = any(h in small for h in _HINTS)
                if not (hinted or has_hex[k] or "akia" in small):
                    rows.append([])
                    continue
                base = base_spans(value)
                more = _guessed(value, base, guess, least) if hinted else []
                rows.append([{"start": s[0], "kind": KINDS[s[1]], "end": s[2], "guesses": s[3] if len(s) > 3 else None} for s in sorted([*base, *more], key=lambda s: s[:3])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(kind))], names=[*batch.schema.names, "secrets"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("secrets", T._parse_datatype_string(SPAN))]))


def _joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_secret_spans(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the pattern matches, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_secrets(docs)
    spans = F.col("secrets")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )
