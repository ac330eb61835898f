"""Language identification of mixed texts: script ranges, per-word scores, Viterbi with a switching penalty.

Training counts, over all labelled training documents, the byte trigrams of each language's words
(hashed to a table of fixed size) and the scripts they are written in. A word's score for a
language is the log-probability of its trigrams; languages that do not use the word's script are
out. The best sequence of languages under a penalty for each switch labels every word; the
document's language is the one that labels most of its letters.

Scores are array operations, and the Viterbi recursion runs over the words of many documents at
once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common
from .toxicity import training_side

TABLE_BITS = 17
SWITCH = 6.0
#: One word says at most this much for or against a language.
CLIP = 8.0
#: A language uses a script if at least this share of its words is in it.
SCRIPT_SHARE = 0.001
UNKNOWN = "und"
#: Words times languages that one recursion holds.
CELLS = 1 << 22

# Scripts by their first code points (fixed values); a range ends where the next one starts.
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
           (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Other"),
           (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
           (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"),
           (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"),
           (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han")]
NAMES = sorted({n for _, n in SCRIPTS}, key=lambda n: (n != "Latin", n))
EDGES = np.array([e for e, _ in SCRIPTS])
OF_EDGE = np.array([NAMES.index(n) for _, n in SCRIPTS])

LOWER = common.lower_table()
WORD = np.zeros(256, bool)
WORD[97:123] = WORD[0x80:] = True


class Words:
    """Words of a run of documents: spans, trigram codes by byte, scripts."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        raw = LOWER[raw]
        inside = WORD[raw]
        self.starts, self.ends, self.counts = common.spans(inside, offs)
        # a trigram for every byte of a word; what lies outside its word is a blank
        n = len(raw)
        pad = np.full(n + 2, 32, np.uint32)
        pad[1:-1] = np.where(inside, raw, 32)
        left, right = pad[:-2].copy(), pad[2:].copy()
        left[self.starts] = 32
        right[self.ends - 1] = 32
        code = (left << np.uint32(16)) | (pad[1:-1] << np.uint32(8)) | right
        self.codes = (code * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)
        self.inside = inside
        self.scripts = np.zeros(len(self.starts), np.int64)
        lead = np.flatnonzero(raw >= 0xC2)
        if len(lead):
            b = raw.astype(np.int64)
            at = lambda k: b[np.minimum(lead + k, n - 1)] & 0x3F
            first = b[lead]
            point = np.where(first < 0xE0, (first & 0x1F) << 6 | at(1), np.where(
                first < 0xF0, (first & 0x0F) << 12 | at(1) << 6 | at(2), (first & 0x07) << 18 | at(1) << 12 | at(2) << 6 | at(3)))
            script = OF_EDGE[np.searchsorted(EDGES, point, "right") - 1]
            word = np.searchsorted(self.starts, lead, "right") - 1
            np.maximum.at(self.scripts, word, script)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


# ---------------------------------------------------------------- training

def _count(langs: list[str]):
    def run(batches):
        place = {x: i for i, x in enumerate(langs)}
        grams = np.zeros((len(langs), 1 << TABLE_BITS), np.int64)
        scripts = np.zeros((len(langs), len(NAMES)), np.int64)
        for batch in batches:
            raw, offs = common.utf8(batch.column(0))
            lang = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for i, j in common.slices(offs, common.COUNT_SLICE):
                w = Words(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                byte_lang = np.repeat(lang[i:j], np.diff(offs[i: j + 1]))[w.inside]
                cells = byte_lang << TABLE_BITS | w.codes[w.inside].astype(np.int64)
                grams += np.bincount(cells, minlength=grams.size).reshape(grams.shape)
                word_lang = np.repeat(lang[i:j], w.counts)
                scripts += np.bincount(word_lang * len(NAMES) + w.scripts, minlength=scripts.size).reshape(scripts.shape)
        for kind, table in (("gram", grams), ("script", scripts)):
            a, b = np.nonzero(table)
            yield pa.record_batch({"kind": pa.array([kind] * len(a)), "lang": pa.array(a, pa.int64()), "code": pa.array(b, pa.int64()), "n": pa.array(table[a, b])})

    return run


class Model:
    """Languages, trigram scores (table x languages) and the scripts that each language uses."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        p = (grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * grams.shape[1])
        p = np.log(p)
        self.scores = np.ascontiguousarray((p - (p.mean(axis=0) if len(p) else 0)).T.astype(np.float32))
        uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        uses &= scripts > 0
        uses[:, ~uses.any(axis=0)] = True  # a script that no language uses excludes none
        self.excluded = ~uses.T

    def word_scores(self, w: Words) -> np.ndarray:
        """(words x languages), the best language of each word at 0."""
        at = np.flatnonzero(w.inside)
        lengths = w.ends - w.starts
        first = np.cumsum(lengths) - lengths
        s = np.add.reduceat(self.scores[w.codes[at]], first, axis=0) if len(at) else np.zeros((0, len(self.langs)), np.float32)
        s[self.excluded[w.scripts]] = -np.inf
        s -= s.max(axis=1, keepdims=True)
        return np.maximum(s, np.where(self.excluded[w.scripts], -4 * CLIP, -CLIP).astype(np.float32))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", mod: int = 4, held: int = 2) -> Model:
    """Counts over every labelled document whose crc32(id) mod ``mod`` is not ``held``."""
    rows = docs.where(F.col(lang_col).isNotNull() & training_side(F.col(id_col), mod, held)).select(
        F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l"))
    with common.small_batches(docs.sparkSession):
        langs = sorted(r.l for r in rows.select("l").distinct().collect())  # the label set
        counted = common.for_counting(rows).mapInArrow(_count(langs), "kind string, lang long, code long, n long")
        sums = counted.groupBy("kind", "lang", "code").agg(F.sum("n").alias("n")).toArrow()  # at most languages x table
    grams, scripts = np.zeros((len(langs), 1 << TABLE_BITS), np.int64), np.zeros((len(langs), len(NAMES)), np.int64)
    kind = np.array(sums["kind"].to_pylist(), dtype=object)
    lang, code, n = (sums[c].to_numpy() for c in ("lang", "code", "n"))
    g = kind == "gram"
    grams[lang[g], code[g]] = n[g]
    scripts[lang[~g], code[~g]] = n[~g]
    return Model(langs, grams, scripts)


# ---------------------------------------------------------------- Viterbi

def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; ``scores``: all documents' words one after the other, ``counts``: words per document.

    Of equal paths the one that stays wins, then the lower language.
    """
    n, k = scores.shape
    out = np.zeros(n, np.int64)
    if k < 2 or n == 0:
        return out
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    first, counts = first[order], counts[order]
    active = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # documents with more than t words
    came = np.zeros((n, k), bool)     # came from another language
    best = np.zeros(n, np.uint16)     # the best language one word before
    v = scores[first].astype(np.float64)
    rows = np.arange(len(first))
    final = np.zeros(len(first), np.int64)
    for t in range(1, int(counts[0])):
        m = int(active[t])
        if m < len(v):
            final[m:len(v)] = v[m:].argmax(axis=1)
            v = v[:m]
        at = first[:m] + t
        b = v.argmax(axis=1)
        moved = v[rows[:m], b][:, None] - penalty
        switch = moved > v
        came[at], best[at] = switch, b
        v = np.where(switch, moved, v) + scores[at]
        v -= v.max(axis=1, keepdims=True)
    final[:len(v)] = v.argmax(axis=1)
    state = final
    for t in range(int(counts[0]) - 1, -1, -1):
        m = int(active[t])
        at = first[:m] + t
        out[at] = state[:m]
        if t:
            state[:m] = np.where(came[at, state[:m]], best[at], state[:m])
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("words", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))


def _groups(offs: np.ndarray, langs: int):
    """Runs of documents that one recursion takes (a word has two bytes at least, with its end)."""
    return common.slices(offs, max(1, 2 * CELLS // max(1, langs)))


def _label(shared, text_at: int, penalty: float, want_spans: bool):
    def run(batches):
        model = shared.value
        k = len(model.langs)
        for batch in batches:
            raw, offs = common.utf8(batch.column(text_at))
            names, scores, spans = [], [], []
            for i, j in _groups(offs, k):
                part, at = raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
                w = Words(part, at)
                lettered = w.counts > 0
                for d in np.flatnonzero(lettered):  # words without ASCII letters may have no letter at all
                    text = part[at[d]: at[d + 1]]
                    if not WORD[LOWER[text[text < 0x80]]].any():
                        lettered[d] = has_letter(text.tobytes())
                if not k:
                    lettered[:] = False
                path = viterbi(model.word_scores(w), w.counts, penalty) if k else np.zeros(len(w.starts), np.int64)
                doc = np.repeat(np.arange(j - i), w.counts)
                share = np.bincount(doc * max(k, 1) + path, w.ends - w.starts, minlength=(j - i) * max(k, 1)).reshape(j - i, max(k, 1))
                top = share.argmax(axis=1)
                total = np.maximum(share.sum(axis=1), 1)
                names += [model.langs[t] if ok else UNKNOWN for t, ok in zip(top, lettered)]
                scores.append(np.where(lettered, share[np.arange(j - i), top] / total, 0.0))
                if want_spans:
                    lists = [[] for _ in range(j - i)]
                    new = np.ones(len(path), bool)
                    new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
                    head = np.flatnonzero(new)
                    tail = np.append(head[1:], len(path)) - 1
                    for h, t in zip(head, tail):
                        d = int(doc[h])
                        if lettered[d]:
                            lists[d].append({"lang": model.langs[path[h]], "start": int(w.starts[h] - at[d]), "end": int(w.ends[t] - at[d]), "words": int(t - h + 1)})
                    spans += lists
            scores = np.concatenate(scores) if scores else np.zeros(0)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            columns += [pa.array(spans, ARROW_SPANS)] if want_spans else []
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__lang", "__score"] + ["__spans"] * want_spans)

    return run


def label(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH, spans: bool = True) -> DataFrame:
    """``docs`` with ``__lang``, ``__score`` (its share of the letters) and ``__spans`` (language, byte range, words).

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows are labelled
    alike; an empty table gives none; any further columns pass through.
    """
    shared = common.Shared(docs.sparkSession, model)
    fields = [*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    fields += [T.StructField("__spans", SPANS)] if spans else []
    return docs.mapInArrow(_label(shared, docs.columns.index(text_col), penalty, spans), T.StructType(fields))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", mod: int = 4, held: int = 2, penalty: float = SWITCH) -> DataFrame:
    """Per document: ``<id_col>, held_out, lang_pred, score``."""
    model = fit(docs, id_col, text_col, lang_col, mod, held)
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = label(two, model, "__text", penalty, spans=False).select(
        id_col, (~training_side(F.col(id_col), mod, held)).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
    return common.written(out, "langid")
