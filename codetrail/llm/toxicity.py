"""Toxicity by noisy-channel deobfuscation.

1. A character language model is counted over all documents (:mod:`charlm`).
2. Spans whose spelling leaves a choice become character lattices: digits and symbols that stand
   for letters, single characters set apart by separators, words cut into pieces by a separator where
   the model has the letters on both sides together (:func:`cuts`), and repeated letters (two or more).
   Viterbi decoding finds the reading with the best language-model and channel score. A span that
   ends in symbols is decoded up to its last letter and as a whole; symbols alone are decoded when
   they are long enough for a word to cost less (:func:`least_symbols`). Any other span has one
   reading, itself, and is not decoded.
3. Words and word beginnings of the plain and the restored text are looked up in a sparse
   logistic model, fitted on at most ``sample_rows`` labelled documents of each class.

Spans, words and look-ups are array operations over an Arrow batch. The fitted model has at most
``max_features`` weights; with the language model it is the only thing broadcast.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import charlm, common

SAMPLE_ROWS = 10_000
MAX_FEATURES = 8192
MIN_SUPPORT = 3
THRESHOLD = 0.3

# Letters that a character may stand for (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
SEPARATORS = " .-_*,/"
# Channel costs (negative log-probabilities): a substitution, a symbol meant as itself, a dropped
# separator, a run of letters shortened.
SUBSTITUTE, LITERAL, JOIN, SHORTEN, SHORTEN_TWO = 1.5, 2.0, 0.5, 1.0, 6.0
# A symbol meant as itself between letters, or after the last letter of a span that has symbols between letters.
INSIDE = 6.0
# A separator dropped between pieces of words: a space, any other.
SPACE_CUT, SIGN_CUT = 4.0, 1.5
#: Word beginnings that are features beside the whole word, in bytes.
BEGINNINGS = (4, 5, 6)


def _mask(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


LOWER = common.lower_table()
LETTER = _mask("abcdefghijklmnopqrstuvwxyz")
SYMBOL = _mask("".join(LEET))
SEPARATOR = _mask(SEPARATORS + "\n\t")
CUT = _mask(SEPARATORS)
# Letters, and the first letter that a digit, @ or $ stands for, as symbols of the language model.
READ = np.zeros(256, np.uint8)
READ[97:123] = np.arange(1, 27)
for _c, _x in LEET.items():
    if _c.isdigit() or _c in "@$":
        READ[ord(_c)] = ord(_x[0]) - 96
WORD = LETTER.copy()
WORD[0x80:] = True


# ---------------------------------------------------------------- the lattice

def decode(span: str, logp: list[float]) -> str:
    """Most probable reading of a lower-case span under ``logp`` (28**4 log-probabilities)."""
    units: list[list[tuple[tuple, float]]] = []
    spaced = len(span) > 2 and all(c in SEPARATORS for c in span[1::2])
    literal = literal_prices(span, spaced)
    i = 0
    while i < len(span):
        c = span[i]
        if "a" <= c <= "z":
            j = i
            while j < len(span) and span[j] == c:
                j += 1
            s, n = ord(c) - 96, j - i
            if n == 1:
                units.append([((s,), 0.0)])
            elif n == 2:
                units.append([((s, s), 0.0), ((s,), SHORTEN_TWO)])
            else:
                units.append([((s,) * n, 0.0), ((s, s), SHORTEN), ((s,), SHORTEN)])
            i = j
            continue
        if spaced and i % 2:
            units.append([((), JOIN), ((0,), 0.0)])
        elif c in LEET:
            units.append([((ord(x) - 96,), SUBSTITUTE) for x in LEET[c]] + [((0,), literal[i])] + [((), JOIN if spaced else SIGN_CUT)] * (c == "*" and (spaced or literal[i] == INSIDE)))
        elif c in SEPARATORS and 0 < i < len(span) - 1 and span[i - 1] not in SEPARATORS and span[i + 1] not in SEPARATORS:
            units.append([((), SPACE_CUT if c == " " else SIGN_CUT), ((0,), 0.0)])
        else:
            units.append([((27,) if ord(c) > 127 else (0,), 0.0)])
        i += 1
    units.append([((0,), 0.0)])
    # state: the last three symbols; value: (cost, readings so far as a linked list)
    states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    n, n2 = charlm.SYMBOLS, charlm.SYMBOLS ** 2
    for unit in units:
        after: dict[int, tuple[float, tuple]] = {}
        for state, (cost, path) in states.items():
            for emitted, price in unit:
                s, total, trace = state, cost + price, path
                for x in emitted:
                    if x == 0 and s % n == 0:
                        continue  # boundaries meet
                    total -= logp[s * n + x]
                    s = (s % n2) * n + x
                    trace = (x, trace)
                old = after.get(s)
                if old is None or total < old[0]:
                    after[s] = (total, trace)
        states = after
    path = min(states.items(), key=lambda kv: (kv[1][0], kv[0]))[1][1]
    out = []
    while path:
        x, path = path
        out.append(" " if x == 0 else "?" if x == 27 else chr(96 + x))
    return "".join(reversed(out)).strip()


def literal_prices(span: str, spaced: bool = False) -> list[float]:
    """What each character costs as itself: ``INSIDE`` for a symbol between letters (of one word, or of a
    ``spaced`` chain), and for the symbols after a word's last letter where there is such a symbol; otherwise ``LITERAL``."""
    prices = [LITERAL] * len(span)
    if spaced:
        letters = [i for i, c in enumerate(span) if "a" <= c <= "z"] or [0]
        prices[letters[0]: letters[-1]] = [INSIDE] * (letters[-1] - letters[0])
        return prices
    for run in re.finditer(r"[^ .\-_,/]+", span):
        letters = [i for i in range(run.start(), run.end()) if "a" <= span[i] <= "z"]
        if letters:
            inside = [i for i in range(letters[0], letters[-1]) if span[i] in LEET]
            for i in inside + list(range(letters[-1] + 1, run.end())) * bool(inside):
                prices[i] = INSIDE
    return prices


def cuts(raw: np.ndarray, offs: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of lower-cased bytes that hold a separator between two letters which the model would rather have without it.

    The price of the letters about each single separator is compared with and without a word end
    there, also with the letter before a one- or two-letter piece; pieces of up to four letters
    beside such a place that are set apart by the same separator belong to the span.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < 3:
        return none, none
    pure, letter = LETTER[raw], READ[raw] > 0
    g = np.flatnonzero(CUT[raw[1:-1]] & letter[:-2] & letter[2:] & (pure[:-2] | pure[2:])) + 1
    doc = np.searchsorted(offs, g, "right") - 1
    lo, hi = offs[doc], offs[doc + 1]
    keep = (g > lo) & (g + 1 < hi)
    g, lo, hi = g[keep], lo[keep], hi[keep]
    if not len(g):
        return none, none
    sym = np.where(letter, READ[raw], charlm.TABLE[raw]).astype(np.int32)

    def at(pos):
        return np.where((pos >= lo) & (pos < hi), sym[np.clip(pos, 0, len(raw) - 1)], 0)

    def back(pos, through):
        """Symbol before ``pos`` and its place; ``through``: a single separator is passed over."""
        x = at(pos - 1)
        if through:
            skip = (x == 0) & (at(pos - 2) > 0) & CUT[raw[np.clip(pos - 1, 0, len(raw) - 1)]]
            pos = np.where(skip, pos - 1, pos)
            x = at(pos - 1)
        return x, pos - 1

    def price(a, b, c, d):
        return logp[((a * charlm.SYMBOLS + b) * charlm.SYMBOLS + c) * charlm.SYMBOLS + d]

    b1, b2 = at(g + 1), at(g + 2)
    b3 = np.where(b2 > 0, at(g + 3), 0)
    a3, two = at(g - 1), b2 > 0
    p2, p1 = at(g - 2), at(g - 3)
    p1 = np.where(p2 > 0, p1, 0)
    split = price(p1, p2, a3, 0) + price(p2, a3, 0, b1) + price(a3, 0, b1, b2) + np.where(two, price(0, b1, b2, b3), 0)
    t2, pos = back(g - 1, True)
    t1 = np.where(t2 > 0, back(pos, True)[0], 0)
    gain = -np.inf
    for a1, a2 in ((p1, p2), (t1, t2)):
        gain = np.maximum(gain, price(a1, a2, a3, b1) + price(a2, a3, b1, b2) + np.where(two, price(a3, b1, b2, b3), 0) - split)
    linked = gain > np.where(raw[g] == 32, SPACE_CUT, SIGN_CUT)
    count = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(letter, out=count[1:])
    piece = g[1:] - g[:-1] - 1
    # neighbouring gaps about one piece, all letters
    beside = (count[g[1:]] - count[g[:-1]] == piece) & (lo[1:] == lo[:-1]) & (raw[g[1:]] == raw[g[:-1]])
    short = beside & (piece <= 4)
    for _ in range(3):
        wide = linked.copy()
        wide[1:] |= linked[:-1] & short
        wide[:-1] |= linked[1:] & short
        linked = wide
    if not linked.any():
        return none, none
    at_gap = np.flatnonzero(linked)
    new = np.ones(len(at_gap), bool)
    new[1:] = ~((np.diff(at_gap) == 1) & beside[at_gap[:-1]])
    head = np.flatnonzero(new)
    first, last = g[at_gap[head]], g[at_gap[np.append(head[1:], len(at_gap)) - 1]]
    starts, ends, _ = common.spans(pure | SYMBOL[raw], offs)
    return starts[np.searchsorted(starts, first - 1, "right") - 1], ends[np.searchsorted(starts, last + 1, "right") - 1]


def suspicious(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of lower-cased bytes whose lattice has more than one reading worth scoring."""
    letter, symbol = LETTER[raw], SYMBOL[raw]
    starts, ends, _ = common.spans(letter | symbol, offs)
    if not len(starts):
        return starts, ends
    n = len(raw)
    letters = np.zeros(n + 1, np.int32)
    np.cumsum(letter, out=letters[1:])
    # single characters, letters or not, set apart by separators; also a span's only letter, with symbols about it,
    # and the outer characters of a span of symbols (several stars are a separator)
    lone = letters[ends] - letters[starts] == 1
    other = np.zeros(n + 1, np.int32)
    np.cumsum(~SEPARATOR[raw], out=other[1:])
    signs = (letters[ends] == letters[starts]) & (other[ends] > other[starts])
    p = np.unique(np.concatenate([starts[ends - starts == 1], np.flatnonzero(letter)[letters[ends[lone]] - 1], starts[signs], ends[signs] - 1]))
    near = (np.diff(p) > 1) & (other[p[1:]] == other[p[:-1] + 1])
    doc = np.searchsorted(offs, p, "right")
    near &= doc[1:] == doc[:-1]
    head = np.flatnonzero(np.concatenate([[True], ~near])) if len(p) else np.zeros(0, np.int64)
    tailp = np.append(head[1:], len(p))[:len(head)] - 1
    long = (tailp - head >= 2) & (letters[p[tailp] + 1] > letters[p[head]])
    out = [(p[head[long]], p[tailp[long]] + 1)]
    has = letters[ends] > letters[starts]
    starts, ends = starts[has], ends[has]
    last = np.flatnonzero(letter)[letters[ends] - 1] + 1          # after the span's last letter
    symbols = np.zeros(n + 1, np.int32)
    np.cumsum(symbol, out=symbols[1:])
    odd = symbols[last] > symbols[starts]                           # a symbol before it
    tail = (last < ends) & (raw[np.minimum(last, n - 1)] >= 48) & (raw[np.minimum(last, n - 1)] <= 57) & (ends - last == 1)
    run = np.zeros(n + 1, np.int32)
    np.cumsum(np.concatenate([(raw[1:] == raw[:-1]) & letter[1:], [False]]), out=run[1:])
    run2 = run[ends - 1] > run[starts]
    pick = odd | tail | run2
    out.append((starts[pick], np.where(tail, ends, last)[pick]))
    s, e = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((e, s))
    return s[order], e[order]


# ---------------------------------------------------------------- features

def word_features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word and word beginning of lower-cased bytes."""
    starts, ends, counts = common.spans(WORD[raw], offs)
    doc = np.repeat(np.arange(len(offs) - 1), counts)
    docs, feats = [doc], [common.span_hashes(raw, starts, ends)]
    for n in BEGINNINGS:
        long = ends - starts > n
        docs.append(doc[long])
        feats.append(common.span_hashes(raw, starts[long], starts[long] + n) ^ np.uint64(0x5BD1E995 + n))
    return np.concatenate(docs), np.concatenate(feats)


CHAIN_STAR = re.compile(rb"(?<=[ .\-_,/\n\t])\*(?=[ .\-_,/\n\t])")
CHAIN_GAP = re.compile(rb"[ .\-_*,/\n\t]+")

#: Symbols at the end of a span, and what stands between the words of a span read as it is.
SIGNS, PLAIN = re.compile(rb"[^a-z]$"), re.compile(r"[^a-z]+")


def flat(seen: bytes) -> str:
    """A span as :func:`decode` takes it: between single characters any run of separators is one; a star by itself stays a character."""
    one = CHAIN_GAP.sub(b" ", CHAIN_STAR.sub(b"\0", seen)).replace(b"\0", b"*")
    if len(one) > 2 and not one[1::2].strip(b" "):
        return one.decode()
    return seen.replace(b"\n", b" ").replace(b"\t", b" ").decode()


def endings(raw: np.ndarray, offs: np.ndarray, longer: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Whole spans of lower-cased bytes that end in symbols: punctuation, or letters by other signs. Of symbols alone: those longer than ``longer``."""
    starts, ends, _ = common.spans(LETTER[raw] | SYMBOL[raw], offs)
    letters = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(LETTER[raw], out=letters[1:])
    pick = np.where(letters[ends] > letters[starts], ~LETTER[raw[ends - 1]], ends - starts > longer) if len(starts) else np.zeros(0, bool)
    return starts[pick], ends[pick]


def least_symbols(logp: np.ndarray, limit: int = 64) -> int:
    """Symbols alone, up to this many, read best as themselves under ``logp``: no letters that symbols stand for cost less."""
    n = charlm.SYMBOLS
    cost = -logp.astype(float).reshape((n,) * 4)
    letters = sorted({ord(x) - 96 for xs in LEET.values() for x in xs})
    best = np.full((n, n, n), np.inf)  # above the price of all symbols as themselves, by the last three characters
    best[0, 0, 0] = 0.0
    for k in range(limit):
        after = np.full((n, n, n), np.inf)
        after[:, :, 0] = best[:, :, 0]  # boundaries meet
        after[:, 1:, 0] = np.minimum(after[:, 1:, 0], (best + cost[..., 0])[:, :, 1:].min(axis=0))
        for x in letters:
            after[:, :, x] = (best + cost[..., x]).min(axis=0) + SUBSTITUTE - LITERAL
        best = after
        if min((best + cost[..., 0])[:, :, 1:].min(), best[1:, :, 0].min(), best[0, 1:, 0].min()) <= 1e-6:
            return k
    return limit


def words_of(span: bytes) -> str:
    """The reading of a span whose symbols all mean themselves."""
    return " ".join(PLAIN.split(span.decode())).strip()


class Restorer:
    """Decodes the spans of a run of documents that leave a choice; equal spans are decoded once."""

    def __init__(self, logp: np.ndarray):
        self.table, self.logp, self.known, self.least = logp, logp.tolist(), {}, least_symbols(logp)

    def __call__(self, raw: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, bytes, bytes]]:
        """(document, place, seen, restored) of the spans that change."""
        out = []
        starts, ends = (np.concatenate(x) for x in zip(suspicious(raw, offs), endings(raw, offs, self.least), cuts(raw, offs, self.table)))
        starts, ends = np.unique(np.stack([starts, ends]), axis=1) if len(starts) else (starts, ends)
        docs = np.searchsorted(offs, starts, "right") - 1
        for d, s, e in zip(docs.tolist(), starts.tolist(), ends.tolist()):
            seen = raw[s:e].tobytes()
            text = self.known.get(seen)
            if text is None:
                if len(self.known) > 200_000:
                    self.known.clear()
                text = self.known[seen] = decode(flat(seen), self.logp).encode()
            if text != seen and not (SIGNS.search(seen) and text.decode() == words_of(seen)):
                if out and out[-1][:2] == (d, s - int(offs[d])) and out[-1][3] == text:
                    continue  # the span without its last symbols reads the same
                out.append((d, s - int(offs[d]), seen, text))
        return out


def features(raw: np.ndarray, offs: np.ndarray, restorer: Restorer):
    """Features of the plain text and of the restored spans, and those spans."""
    raw = LOWER[raw]
    doc, feat = word_features(raw, offs)
    spans = restorer(raw, offs)
    if spans:
        lengths = np.array([len(t) for *_, t in spans])
        more, extra = word_features(np.frombuffer(b"".join(t for *_, t in spans), np.uint8), np.concatenate([[0], np.cumsum(lengths)]))
        doc = np.concatenate([doc, np.array([d for d, *_ in spans])[more]])
        feat = np.concatenate([feat, extra])
    return doc, feat, spans


# ---------------------------------------------------------------- model

class Lexicon:
    """Weights of the known features, found through a bit table and a binary search."""

    BITS = 20

    def __init__(self, feats: np.ndarray, weights: np.ndarray, bias: float):
        order = np.argsort(feats)
        self.feats, self.weights, self.bias = feats[order], weights[order], bias
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(feats & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def find(self, doc: np.ndarray, feat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, place of the feature) among the known ones."""
        hit = self.bits[(feat & np.uint64((1 << self.BITS) - 1)).astype(np.int64)]
        doc, feat = doc[hit], feat[hit]
        if not len(self.feats) or not len(feat):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.feats, feat), len(self.feats) - 1)
        ok = self.feats[at] == feat
        pairs = np.unique(doc[ok] * len(self.feats) + at[ok])
        return pairs // len(self.feats), pairs % len(self.feats)

    def scores(self, n: int, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = self.bias + np.bincount(doc, self.weights[at], minlength=n)[:n]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(doc: np.ndarray, at: np.ndarray, labels: np.ndarray, n_features: int, l2: float = 0.1, rounds: int = 400):
    """Sparse logistic regression on presence features (accelerated gradient descent, penalty l2)."""
    n = len(labels)
    w, b = np.zeros(n_features), np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5))
    wide = np.bincount(doc, minlength=n).max(initial=0) + 1.0
    frequent = np.bincount(at, minlength=n_features) + 1.0
    step = 1.0 / (0.25 * frequent * min(wide, 30.0) + l2)  # one step length for each weight
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        z = vb + np.bincount(doc, vw[at], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels
        new_w = vw - step * (np.bincount(at, error[doc], minlength=n_features) + l2 * vw)
        new_b = vb - error.sum() / (0.25 * n * 4 + 1)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.dot(vw - new_w, new_w - w) > 0:  # restart the momentum
            t2 = 1.0
        vw, vb = new_w + (t - 1) / t2 * (new_w - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new_w, new_b, t2
    return w, float(b)


def training_side(id_col: Column, mod: int = 4, held: int = 2) -> Column:
    """Rows that labels may be learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % mod != held, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, mod: int, held: int, rows: int):
    """(texts of at most ``rows`` training documents of each class with column ``y``, share of class 1).

    Labels of one id are merged (the larger counts); the ids with the least hashes are taken, and of
    rows that share an id the least text.
    """
    one = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(training_side(F.col(id_col), mod, held))
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    one = common.written(one, "labels")
    share = one.agg(F.avg("y")).first()[0]
    picked = [one.where(F.col("y") == y).orderBy(F.xxhash64("__id"), "__id").limit(rows) for y in (0, 1)]
    picked = common.written(picked[0].union(picked[1]), "labels-sample")  # at most 2 * rows rows: small enough to broadcast
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    # one text of each id, so the sample stays bounded when ids repeat
    one_each = texts.join(F.broadcast(picked), "__id").groupBy("__id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("y").alias("y"))
    return one_each.select("text", "y"), share


def _count_features(logp):
    def run(batches):
        restorer = Restorer(logp.value)
        for batch in batches:
            raw, offs = common.utf8(batch.column(0))
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j in common.slices(offs):
                doc, feat, _ = features(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i], restorer)
                order = np.lexsort((doc, feat))
                doc, feat = doc[order], feat[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (feat[1:] != feat[:-1])
                kinds, at = np.unique(feat[new], return_inverse=True)
                ones = np.bincount(at, label[i:j][doc[new]], minlength=len(kinds)).astype(np.int64)
                every = np.bincount(at, minlength=len(kinds))
                yield pa.record_batch({"f": pa.array(kinds.view(np.int64)), "ones": pa.array(ones), "n": pa.array(every, pa.int64())})

    return run


def _known_features(logp, lexicon):
    def run(batches):
        restorer = Restorer(logp.value)
        for batch in batches:
            raw, offs = common.utf8(batch.column(0))
            for i, j in common.slices(offs):
                doc, feat, _ = features(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i], restorer)
                doc, at = lexicon.value.find(doc, feat)
                edge = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                yield pa.record_batch({"y": batch.column(1).slice(i, j - i), "at": pa.ListArray.from_arrays(pa.array(edge), pa.array(at, pa.int64()))})

    return run


class Model:
    """Language model and lexicon, both broadcast."""

    def __init__(self, logp, lexicon):
        self.logp, self.lexicon = logp, lexicon


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", mod: int = 4, held: int = 2,
        sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Language model over all of ``docs``; lexicon from labelled rows whose crc32(id) mod ``mod`` is not ``held``."""
    sc = docs.sparkSession.sparkContext
    logp = sc.broadcast(charlm.log_probabilities(charlm.counts(docs, text_col)).astype(np.float32))
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_col, mod, held, sample_rows)
    sample = common.written(sample, "toxic-sample")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:  # nothing to learn from
        return Model(logp, common.Shared(docs.sparkSession, Lexicon(np.zeros(0, np.uint64), np.zeros(0), -20.0 if not n1 else 20.0)))
    kinds = sample.mapInArrow(_count_features(logp), "f long, ones long, n long").groupBy("f").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    p, q = (F.col("ones") + 0.1) / (n1 + 0.2), (F.col("n") - F.col("ones") + 0.1) / (n0 + 0.2)
    kinds = kinds.where(F.col("ones") >= MIN_SUPPORT).withColumn("gain", F.col("ones") * F.log(p / q)).where(p > 2 * q)
    with common.small_batches(docs.sparkSession):
        best = kinds.orderBy(F.desc("gain"), "f").limit(max_features).select("f").toArrow()["f"].to_numpy().view(np.uint64)
        empty = common.Shared(docs.sparkSession, Lexicon(best, np.zeros(len(best)), 0.0))
        rows = sample.mapInArrow(_known_features(logp, empty), "y int, at array<long>").toArrow()
    at = rows["at"].combine_chunks()
    doc = np.repeat(np.arange(len(rows)), np.diff(at.offsets.to_numpy()))
    y = rows["y"].to_numpy().astype(float)
    w, b = fit_logistic(doc, at.values.to_numpy()[at.offsets[0].as_py():], y, len(best))
    # the sample's classes need not have the labels' shares
    b += np.log(share / (1 - share)) - np.log(n1 / n0) if 0 < share < 1 else 0.0
    return Model(logp, common.Shared(docs.sparkSession, Lexicon(empty.value.feats, w, b)))


RESTORED = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("seen", T.StringType()), T.StructField("text", T.StringType())]))
ARROW_RESTORED = pa.list_(pa.struct([("at", pa.int64()), ("seen", pa.string()), ("text", pa.string())]))


def _score(model: Model, text_at: int):
    def run(batches):
        restorer, lexicon = Restorer(model.logp.value), model.lexicon.value
        for batch in batches:
            raw, offs = common.utf8(batch.column(text_at))
            scores, restored = [], []
            for i, j in common.slices(offs):
                doc, feat, spans = features(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i], restorer)
                scores.append(lexicon.scores(j - i, *lexicon.find(doc, feat)))
                lists = [[] for _ in range(j - i)]
                for d, at, seen, text in spans:
                    lists[d].append({"at": at, "seen": seen.decode(errors="replace"), "text": text.decode()})
                restored += lists
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array(restored, ARROW_RESTORED)],
                                             names=[*batch.schema.names, "__score", "__restored"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score`` (0 to 1) and ``__restored`` (byte place, spelling and reading of every span that was decoded to something else).

    Null and empty texts have the score of a text without features. Repeated rows score alike;
    an empty table gives none; any further columns pass through.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType()), T.StructField("__restored", RESTORED)])
    return docs.mapInArrow(_score(model, docs.columns.index(text_col)), schema)


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **params) -> DataFrame:
    """Per document: ``<id_col>, held_out, score, predicted, n_restored``."""
    model = fit(docs, labels, id_col, text_col, **params)
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = score(two, model, "__text").select(
        id_col, (~training_side(F.col(id_col), params.get("mod", 4), params.get("held", 2))).alias("held_out"),
        F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"),
        F.size("__restored").cast("long").alias("n_restored"))
    return common.written(out, "toxicity")


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **params) -> DataFrame:
    """The documents whose score stays below the threshold, with all their columns."""
    model = fit(docs, labels, text_col=text_col, **params)
    plain, names = common.positional(docs, text=text_col)
    return score(plain, model, "text").where(F.col("__score") < threshold).select(*names).toDF(*docs.columns)
