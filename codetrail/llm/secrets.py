"""Secret scan: fixed patterns, and random strings found by their token efficiency.

A byte-pair vocabulary spells ordinary text with several characters a token and random strings
with hardly more than one. Every run of key characters of at least ``MIN_LENGTH`` with a letter
is encoded with a tiktoken vocabulary; a ratio of characters to tokens below ``max_ratio`` exposes
it, unless it is a known kind of digest or an identifier made of words and numbers (a word's own
ratio is at least ``max_ratio``). Where a run as a whole is not exposed, the parts between its
signs and their joined neighbours are, so that a path or a query string hides no key. Pattern spans always stay; a random string that overlaps one is not reported twice.

Runs are found by array operations on the bytes of a batch; only documents with a keyword or a
long run are looked at one by one. The vocabulary is read by the driver from the given path and
broadcast (one file of about a megabyte).
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a byte-level vocabulary of this kind cuts text before merging (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MIN_LENGTH, MAX_RATIO = 20, 2.0
KINDS = ("assign", "access", "hex", "random")

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")  # on lower-cased bytes
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
RUN = re.compile(rb"[A-Za-z0-9+/_=-]+")
# Digests by their length in hexadecimal digits, and UUIDs (fixed values).
DIGESTS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(rb"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Parts of a run between '/', '=', '_' and '-'; a UUID is one part.
BETWEEN = re.compile(rb"(?<![A-Za-z0-9+])" + UUID.pattern + rb"(?![A-Za-z0-9+])|[A-Za-z0-9+]+")
#: Parts of an identifier: a word (it must also have a word's ratio), or a number of up to eight digits.
PART = re.compile(rb"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])|[0-9]{1,8}(?![0-9])|[_/+=-]+")


def _class(pattern: bytes) -> np.ndarray:
    one = re.compile(pattern)
    return np.array([one.fullmatch(bytes([b])) is not None for b in range(256)])


IN_RUN, IN_HEX = _class(rb"[A-Za-z0-9+/_=-]"), _class(rb"[0-9a-f]")


def long_runs(inside: np.ndarray, length: int) -> np.ndarray:
    """Places inside every run of at least ``length`` marked bytes (one or more for each; shorter runs may appear)."""
    block = max(1, (length + 1) // 2)  # a run that long covers an aligned block of half its size
    n = len(inside) // block * block
    return np.flatnonzero(inside[:n].reshape(-1, block).all(axis=1)) * block


def is_digest(s: bytes) -> bool:
    if UUID.fullmatch(s):
        return True
    return len(s) in DIGESTS and (re.fullmatch(rb"[0-9a-f]+", s) or re.fullmatch(rb"[0-9A-F]+", s)) is not None


def outside(a: int, b: int, base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pieces of ``a..b`` that no span of ``base`` (sorted) covers."""
    out = []
    for x, y in base:
        if y > a and x < b:
            out.append((a, x))
            a = max(a, y)
    return [(x, y) for x, y in [*out, (a, b)] if x < y]


class Scanner:
    """Spans of one text at a time; the encoder is made when the first candidate needs it."""

    def __init__(self, vocabulary: bytes, max_ratio: float):
        self.vocabulary, self.max_ratio, self.encoder, self.known = vocabulary, max_ratio, None, {}

    def ratio(self, s: bytes) -> float:
        """Characters a token."""
        if self.encoder is None:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.vocabulary.splitlines()) if a}
            self.encoder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if s not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[s] = len(s) / max(1, len(self.encoder.encode_ordinary(s.decode())))
        return self.known[s]

    def is_identifier(self, s: bytes) -> bool:
        """Words and numbers, joined by signs, cases or nothing; at most one number for two words. A word is spelled with as few tokens as words are."""
        parts, at = [], 0
        while at < len(s):
            m = PART.match(s, at)
            if not m:
                return False
            parts.append(m[0])
            at = m.end()
        words = [p for p in parts if p[:1].isalpha()]
        numbers = [p for p in parts if p[:1].isdigit()]
        if len(numbers) > max(1, len(words)) or sum(map(len, words)) < sum(map(len, numbers)):
            return False
        return all(self.ratio(p) >= self.max_ratio for p in words)

    def random(self, s: bytes) -> bool:
        core = s.strip(b"=-_/+")
        if len(core) < MIN_LENGTH or not re.search(rb"[A-Za-z]", core):
            return False
        return not is_digest(core) and self.ratio(core) < self.max_ratio and not self.is_identifier(core)

    def plain(self, s: bytes) -> bool:
        """A part that by itself is words and numbers."""
        return s.isdigit() or self.is_identifier(s)

    def exposed(self, s: bytes) -> list[tuple[int, int]]:
        """Random stretches of a run: the run, or parts between signs and joined neighbours of ``MIN_LENGTH`` or more."""
        if self.random(s):
            return [(0, len(s))]
        out: list[list[int]] = []
        parts = [m.span() for m in BETWEEN.finditer(s)]
        blocked = [is_digest(s[a:b]) for a, b in parts]
        n, j, wall = len(parts), 0, 0
        for i in range(n):
            if blocked[i]:
                continue
            j, wall = max(j, i), max(wall, i)
            while wall < n and not blocked[wall]:  # parts are joined up to the next digest
                wall += 1
            while j < n and parts[j][1] - parts[i][0] < MIN_LENGTH:
                j += 1
            if j >= wall:
                continue
            first, last = i, j
            if not self.random(s[parts[first][0]:parts[last][1]]):
                continue
            while first < last and self.plain(s[slice(*parts[first])]):
                first += 1
            while first < last and self.plain(s[slice(*parts[last])]):
                last -= 1
            if self.random(s[parts[first][0]:parts[last][1]]):
                if out and first <= out[-1][1]:
                    out[-1][1] = max(last, out[-1][1])
                else:
                    out.append([first, last])
        for k, (first, last) in enumerate(out):  # short ends of a key
            while first > (out[k - 1][1] + 1 if k else 0) and self._joins(s, parts, blocked, first - 1, first):
                first -= 1
            while last + 1 < (out[k + 1][0] if k + 1 < len(out) else n) and self._joins(s, parts, blocked, last + 1, last):
                last += 1
            out[k] = [first, last]
        return [(parts[first][0], parts[last][1]) for first, last in out]

    def _joins(self, s: bytes, parts: list[tuple[int, int]], blocked: list[bool], new: int, end: int) -> bool:
        """Does the part ``new`` carry on the random stretch that ends with its neighbour ``end``?"""
        if blocked[new] or self.plain(s[slice(*parts[new])]):
            return False
        joined = s[min(parts[new][0], parts[end][0]):max(parts[new][1], parts[end][1])]
        return self.ratio(joined) < self.max_ratio

    def spans(self, text: bytes, candidate: bool, hexed: bool) -> list[tuple[int, int, int]]:
        """(start, kind, end) in bytes; ``candidate``, ``hexed``: the text may have a random string, a run of hex digits."""
        out = []
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= 8]
        if b"AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        if hexed:
            out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
        if candidate:
            base = sorted((x, y) for x, _, y in out)
            for m in RUN.finditer(text):
                a, b = m.span()
                if b - a < MIN_LENGTH:
                    continue
                for x, y in outside(a, b, base):
                    if y - x >= MIN_LENGTH:
                        out += [(x + f, 3, x + g) for f, g in self.exposed(text[x:y])]
        return sorted(out)


ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _scan(shared, text_at: int, max_ratio: float):
    def run(batches):
        scanner = Scanner(shared.value, max_ratio)
        for batch in batches:
            raw, offs = common.utf8(batch.column(text_at))
            found = []
            for i, j in common.slices(offs):
                part, at = raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
                marks = []
                for table, length in ((IN_RUN, MIN_LENGTH), (IN_HEX, 32)):
                    mark = np.zeros(j - i, bool)
                    mark[np.searchsorted(at, long_runs(table[part], length), "right") - 1] = True
                    marks.append(mark)
                data = part.tobytes()
                for d in range(j - i):
                    a, b = int(at[d]), int(at[d + 1])
                    spans = scanner.spans(data[a:b], bool(marks[0][d]), bool(marks[1][d]))
                    if spans:  # bytes to code points
                        points = np.concatenate([[0], np.cumsum((part[a:b] & 0xC0) != 0x80)])
                        spans = [{"kind": KINDS[k], "start": int(points[s]), "end": int(points[e])} for s, k, e in spans]
                    found.append(spans)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, ARROW_SPANS)], names=[*batch.schema.names, "__spans"])

    return run


def find(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` with ``__spans``: kind, start and end (code points, end exclusive), by start, then kind.

    Null and empty texts have no spans. Repeated rows are scanned alike; an empty table gives
    none; any further columns pass through.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*docs.schema.fields, T.StructField("__spans", SPANS)])
    return docs.mapInArrow(_scan(shared, docs.columns.index(text_col), max_ratio), schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """Per document: ``<id_col>, n_assign, n_access, n_hex, base_sha256, spans, n_random``."""
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    found = find(two, "__text", vocabulary, max_ratio)
    count = lambda kind: F.size(F.filter("__spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("__spans", lambda x: x["kind"] != "random")
    out = found.select(id_col, count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                       joined(F.col("__spans")).alias("spans"), count("random"))
    return common.written(out, "secrets")
