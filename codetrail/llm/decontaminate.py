"""Benchmark decontamination with suffix arrays over the training texts.

The documents of one Arrow batch form a shard. Its words become numbers of the benchmark's
vocabulary (0: a word that no item has, or the end of a document), and the shard's suffixes are
sorted into a suffix array by their first ``window`` words. The array leaves out suffixes that
cannot start a match, because an unknown word comes too early or no window starts with their
first two words; both tests are lossless. Every test suffix (each window of ``window`` words, or the whole item if it
is shorter) is then binary-searched in the array, which gives all its places. Neighbouring hits
join to the longest verbatim matches: on one diagonal, or by a suffix automaton over the window
numbers of an item that repeats a window, so repeated words never pair all places with all places.
Every covered word is compared once, byte by byte.

The benchmark is the query set: it is cut into blocks of about ``block_bytes`` of text, and every
block is run against all documents; one block at a time is held by a task. Nothing is shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common

WINDOW = 13
BLOCK_BYTES = 4 << 20


def _inside() -> np.ndarray:
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


LOWER, INSIDE = common.lower_table(), _inside()


class Words:
    """Words of a run of documents: lower-cased bytes, spans, words per document, hashes."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        self.raw = LOWER[raw]
        self.starts, self.ends, self.counts = common.spans(INSIDE[self.raw], offs)
        self.hashes = common.span_hashes(self.raw, self.starts, self.ends)

    def text(self, i: int, j: int) -> list[bytes]:
        return [self.raw[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j])]


class Repeats:
    """Suffix automaton of the window numbers of an item in which a window occurs more than once."""

    def __init__(self, numbers: list[int]):
        self.next, self.link, self.size, self.end = [{}], [-1], [0], [-1]
        last = 0
        for at, c in enumerate(numbers):
            new = self._state({}, 0, self.size[last] + 1, at)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.size[q] == self.size[p] + 1:
                    self.link[new] = q
                else:
                    copy = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1, self.end[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = self.link[p]
                    self.link[q] = self.link[new] = copy
            last = new

    def _state(self, follow: dict, link: int, size: int, end: int) -> int:
        for values, v in ((self.next, follow), (self.link, link), (self.size, size), (self.end, end)):
            values.append(v)
        return len(self.size) - 1

    def longest(self, run: list[int]):
        """(place in the run, place in the item, windows) of every match that no other one of the run contains."""
        state, n = 0, 0
        for j, c in enumerate(run):
            if c not in self.next[state] and n:
                yield j - n, self.end[state] - n + 1, n
            while c not in self.next[state]:
                state = self.link[state]
                n = self.size[state]
            state, n = self.next[state][c], n + 1
        if n:
            yield len(run) - n, self.end[state] - n + 1, n


class BenchmarkBlock:
    """Vocabulary and sorted test suffixes of some items ``(item_id, text)``.

    It travels as word numbers and places; the sort keys are built where it is used.
    """

    def __init__(self, items: list[tuple], window: int):
        raw = [(t or "").encode() for _, t in items]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        words = Words(np.frombuffer(b"".join(raw), np.uint8), offs)
        self.window = window
        self.names = ["" if i is None else str(i) for i, _ in items]
        self.vocabulary, one = np.unique(words.hashes, return_index=True)
        self.ids = self.number(words.hashes)
        spelled = words.text(0, len(self.ids))
        self.words = [spelled[i] for i in one]
        if any(w != self.words[n - 1] for w, n in zip(spelled, self.ids.tolist())):
            raise ValueError("decontamination: two different words share a hash")
        first = np.concatenate([[0], np.cumsum(words.counts)]).astype(np.int64)
        size = np.minimum(window, words.counts).astype(np.int64)      # of each item's windows
        n = np.where(size > 0, words.counts - size + 1, 0)
        item = np.repeat(np.arange(len(n)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        place, sizes = first[item] + inner, size[item]
        keys = self.keys(self.ids, place, sizes)
        order = np.argsort(keys, kind="stable")
        keys, sorted_sizes = keys[order], sizes[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sorted_sizes[1:] != sorted_sizes[:-1])
        at = order[np.flatnonzero(new)]
        self.place, self.length = place[at], sizes[at]                # one place of each distinct window
        rank = np.cumsum(new) - 1
        window_of = np.empty(len(order), np.int64)
        window_of[order] = rank
        # each (window, item) once, with its first place in the item
        pairs, start = np.unique(rank * max(1, len(n)) + item[order], return_index=True)
        self.edge = np.searchsorted(pairs, np.arange(len(at) + 1) * max(1, len(n)))
        self.item, self.item_word = item[order][start], inner[order][start]
        many = np.bincount(item, minlength=len(n)) > np.bincount(self.item, minlength=len(n))
        begin = np.concatenate([[0], np.cumsum(n)])
        self.repeated = {int(k): window_of[begin[k]: begin[k + 1]] for k in np.flatnonzero(many)}
        self._build()

    def __getstate__(self):
        held = ("window", "names", "vocabulary", "ids", "words", "place", "length", "edge", "item", "item_word", "repeated")
        return {k: self.__dict__[k] for k in held}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def _build(self) -> None:
        self.low = self.keys(self.ids, self.place, self.length)
        short = np.flatnonzero(self.length < self.window)             # their hits are ranges of suffixes
        high = self.low[short].view(">u4").reshape(len(short), self.window).copy()
        high[np.arange(self.window) >= self.length[short, None]] = 0xFFFFFFFF
        self.short, self.high = short, high.view(f"S{4 * self.window}").ravel()
        self.shortest = int(self.length.min()) if len(self.length) else self.window
        # leading pairs (one word for windows of one word), as a hashed bit table
        lead = self.ids[self.place]
        second = np.where(self.length > 1, self.ids[np.minimum(self.place + 1, len(self.ids) - 1)], 0) if len(self.ids) else lead
        self.pairs = np.zeros(1 << 20, bool)
        self.pairs[self.pair(lead, second)] = True
        self.single = bool((self.length == 1).any())
        self.automata: dict[int, Repeats] = {}

    def repeats(self, item: int) -> Repeats:
        if item not in self.automata:
            self.automata[item] = Repeats(self.repeated[item].tolist())
        return self.automata[item]

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * 1_000_003 + b.astype(np.int64)) & ((1 << 20) - 1)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary, or 0."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)

    def keys(self, ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first ``size`` word numbers of each suffix as one sortable string."""
        out = np.zeros((len(at), self.window), ">u4")
        for j in range(self.window):
            more = size > j
            out[more, j] = ids[at[more] + j]
        return out.view(f"S{4 * self.window}").ravel()

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids``: a shard, ended by 0. All (distinct window, place in the shard) hits."""
        zeros = np.flatnonzero(ids == 0)
        known = np.flatnonzero(ids)
        if not len(self.low) or not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        run = zeros[np.searchsorted(zeros, known)] - known
        keep = run >= self.shortest
        known, run = known[keep], run[keep]
        if not self.single:
            keep = self.pairs[self.pair(ids[known], ids[known + 1])]
            known, run = known[keep], run[keep]
        keys = self.keys(ids, known, run)
        order = np.argsort(keys, kind="stable")  # the suffix array: known[order]
        keys = keys[order]
        a, b = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.low, "right")
        b[self.short] = np.searchsorted(keys, self.high, "right")
        found = np.flatnonzero(b > a)
        n = (b - a)[found]
        suffix = np.repeat(found, n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return suffix, known[order[np.repeat(a[found], n) + inner]]


class _Found:
    """What one document has gathered over the blocks."""

    __slots__ = ("covered", "items", "matches")

    def __init__(self):
        self.covered, self.items, self.matches = [], set(), []


def _shard(raw, offs, block: BenchmarkBlock, found: dict[int, _Found]) -> np.ndarray:
    """Adds the hits of a shard; returns the number of words of each document."""
    parts, ids, counts = [], [], []
    for i, j in common.slices(offs):
        w = Words(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
        parts.append((w.starts + offs[i], w.ends + offs[i]))
        counts.append(w.counts)
        # a 0 after each document keeps matches inside it
        numbers = block.number(w.hashes)
        ids.append(np.insert(numbers, np.cumsum(w.counts), 0) if len(w.counts) else numbers)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    if not len(counts):
        return counts
    ids = np.concatenate(ids)
    base = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]  # place in ids of each document's first word
    window, at = block.search(ids)
    if not len(at):
        return counts
    doc = np.searchsorted(base, at, "right") - 1
    order = np.argsort(at, kind="stable")
    window, at, doc = window[order], at[order], doc[order]
    starts, ends = (np.concatenate(x) for x in zip(*parts))
    first = np.concatenate([[0], np.cumsum(counts)])
    spans: dict[int, list] = {}
    for d, k, word, item_word, length in _matches(block, window, at, doc):
        f = found.setdefault(d, _Found())
        f.items.add(block.names[k])
        f.matches.append({"item_id": block.names[k], "doc_word": word - int(base[d]), "item_word": item_word, "n_words": length})
        spans.setdefault(d, []).append((word - int(base[d]), word - int(base[d]) + length))
    for d, some in spans.items():
        merged = _merged(some)
        found[d].covered.extend(merged)
        for lo, hi in merged:  # every covered word is compared once, byte by byte
            w = int(first[d]) + lo
            for s, e, n in zip(starts[w: w + hi - lo], ends[w: w + hi - lo], ids[int(base[d]) + lo: int(base[d]) + hi]):
                if LOWER[raw[s:e]].tobytes() != block.words[n - 1]:
                    raise ValueError("decontamination: two different words share a hash")
    return counts


#: (hit, item) pairs that one vectorised step holds.
PAIRS = 1 << 20


def _matches(block: BenchmarkBlock, window: np.ndarray, at: np.ndarray, doc: np.ndarray):
    """(document, item, place in the shard, word of the item, words) of the longest matches.

    Hits come ordered by place. A hit meets each item of its window once, never each of the item's
    places, and at most about ``PAIRS`` meetings (or one item's share of one document) are held.
    """
    cost = np.cumsum(np.diff(block.edge)[window])
    heads = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))    # first hit of each document
    i = 0
    while i < len(heads) - 1:
        before = int(cost[heads[i] - 1]) if heads[i] else 0
        j = max(i + 1, int(np.searchsorted(cost[heads[1:] - 1], before + PAIRS, "right")))
        some = slice(heads[i], heads[j])
        groups = -(-(int(cost[heads[j] - 1]) - before) // PAIRS)
        for g in range(groups):
            yield from _some_matches(block, window[some], at[some], doc[some], groups, g)
        i = j


def _some_matches(block: BenchmarkBlock, window: np.ndarray, at: np.ndarray, doc: np.ndarray, groups: int, group: int):
    edge, items, words = block.edge, block.item, block.item_word
    if groups > 1:
        keep = items % groups == group
        edge, items, words = np.concatenate([[0], np.cumsum(keep)])[edge], items[keep], words[keep]
    n = np.diff(edge)[window]
    which = np.repeat(edge[window], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    window, at, doc, item, word = np.repeat(window, n), np.repeat(at, n), np.repeat(doc, n), items[which], words[which]
    again = np.isin(item, np.fromiter(block.repeated, np.int64, len(block.repeated)))
    # A run: one document, one item, neighbouring places; where the item repeats no window, one diagonal too.
    lane = np.where(again, 0, at - word)
    order = np.lexsort((at, lane, item, doc))
    window, at, doc, item, word, again, lane = (x[order] for x in (window, at, doc, item, word, again, lane))
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (lane[1:] != lane[:-1]) | (np.diff(at) != 1)
    head = np.flatnonzero(new)
    for h, t in zip(head.tolist(), np.append(head[1:], len(at)).tolist()):
        d, k, size = int(doc[h]), int(item[h]), int(block.length[window[h]])
        if again[h]:
            for x, y, m in block.repeats(k).longest(window[h:t].tolist()):
                yield d, k, int(at[h]) + x, y, m + size - 1
        else:
            yield d, k, int(at[h]), int(word[h]), t - h + size - 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.LongType()),
    T.StructField("item_word", T.LongType()), T.StructField("n_words", T.LongType())]))
ARROW_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))


def _covered(spans: list[tuple[int, int]]) -> int:
    return sum(b - a for a, b in _merged(spans))


def _scan(blocks, text_at: int):
    def run(batches):
        for batch in batches:
            raw, offs = common.utf8(batch.column(text_at))
            found: dict[int, _Found] = {}
            n_words = np.zeros(batch.num_rows, np.int64)
            for b in blocks:
                n_words = _shard(raw, offs, b.value, found)
                if len(blocks) > 1:  # hold one block at a time
                    vars(b).pop("_value", None)
            hit = np.zeros(batch.num_rows, np.int64)
            items, matches = [[]] * batch.num_rows, [[]] * batch.num_rows
            for d, f in found.items():
                hit[d], items[d], matches[d] = _covered(f.covered), sorted(f.items), f.matches
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words), pa.array(hit), pa.array(items, pa.list_(pa.string())),
                 pa.array(matches, ARROW_MATCHES)],
                names=[*batch.schema.names, "__words", "__hit", "__items", "__matches"])

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list:
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return [common.Shared(benchmark.sparkSession, BenchmarkBlock([tuple(r) for r in (items if n == 1 else items.where(part == k)).collect()], window))
            for k in range(n)]


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__words`` (its number of words), ``__hit`` (words inside occurrences of a
    window), ``__items`` (items with occurring windows, sorted as strings) and ``__matches``
    (longest verbatim matches: item, place in the document and in the item, length, in words; those
    that no other match with the item contains, each with its first place in the item).

    Words are runs of characters other than ASCII punctuation, white space and control
    characters, after lower-casing A-Z. Null texts have no words; items without words match
    nothing; a null item id counts as the empty string, and rows sharing an id are one item.
    Empty tables, repeated rows and any further columns are allowed.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_bytes)
    schema = T.StructType([*docs.schema.fields, T.StructField("__words", T.LongType()), T.StructField("__hit", T.LongType()),
                           T.StructField("__items", T.ArrayType(T.StringType())), T.StructField("__matches", MATCHES)])
    return docs.mapInArrow(_scan(blocks, docs.columns.index(text_col)), schema)


def contaminated() -> F.Column:
    """The contamination rule: a hit, and hits are at least a twentieth of the words."""
    return (F.col("__hit") > 0) & (20 * F.col("__hit") >= F.col("__words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    plain, names = common.positional(docs, text=text_col)
    return find_matches(plain, benchmark, "text", **params).where(~contaminated()).select(*names).toDF(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Per document: ``<id_col>, n_words, n_hit, n_items, items_sha256, contaminated``."""
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = find_matches(two, benchmark, text_col="__text", **params)
    return out.select(
        id_col, F.col("__words").alias("n_words"), F.col("__hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
