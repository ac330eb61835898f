"""Token counts under a unigram vocabulary by a count-only Viterbi recursion.

An Aho-Corasick automaton lists all vocabulary pieces that end at each character; the recursion
keeps for each place only the best score and the number of pieces of its best path, no path.

Tie rules of the unigram tokenizers: a later candidate replaces the best one only if its score is
strictly higher, and candidates come by ascending start, so of equal paths the one whose last
piece is longest wins; a character without a piece of its own may be unknown, at ten below the
lowest score of the vocabulary; with byte fallback an unknown character counts as its UTF-8 bytes,
else neighbouring unknown characters count as one piece.

Spaces become the word mark, and one is put before a text that does not start with it. If no piece
goes across the start of a word and all scores are whole numbers (so sums are exact in any order),
words are counted apart and remembered; otherwise a text is one run. Either way the counts are
those of the whole text.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from . import common

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_BELOW = 10.0
REMEMBER, REMEMBER_LENGTH = 400_000, 48


class Vocabulary:
    """Pieces with scores, in the order of their ids; ``unk``: id of the unknown piece.

    ``hidden``: ids of control, unknown, unused and byte pieces, which never match text that spells them.
    """

    def __init__(self, pieces: list[tuple[str, float]], unk: int, byte_fallback: bool, hidden=()):
        self.pieces, self.unk, self.byte_fallback, self.hidden = pieces, unk, byte_fallback, frozenset(hidden)

    def matching(self) -> list[tuple[str, float]]:
        return [x for i, x in enumerate(self.pieces) if i not in self.hidden]


def load(path: str = VOCABULARY) -> Vocabulary:
    """Reads the pieces and scores of a SentencePiece file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    return Vocabulary([(sp.id_to_piece(i), sp.get_score(i)) for i in range(n)], sp.unk_id(), any(sp.is_byte(i) for i in range(n)),
                      [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)])


class Counter:
    """Counts pieces of texts; made once in each task from the broadcast vocabulary."""

    def __init__(self, v: Vocabulary):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        matching = v.matching()
        scores = [s for _, s in matching]
        for p, s in dict(matching).items():
            if p:
                self.auto.add_word(p, (len(p), s))
        if len(self.auto):
            self.auto.make_automaton()
        self.bytes = v.byte_fallback and {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _ in v.pieces}
        have = {p for p, _ in matching}
        self.unknown = min(scores, default=0.0) - UNKNOWN_BELOW
        crosses = any(MARK in p.lstrip(MARK) for p in have)
        self.apart = MARK in have and not crosses and all(float(s).is_integer() for s in scores)
        self.single = {p for p in have if len(p) == 1}
        self.known: dict[str, int] = {}  # word -> pieces + unknown characters << 32

    def run(self, text: str) -> tuple[int, int]:
        """(pieces, unknown characters) of the best path through ``text`` as it is."""
        n = len(text)
        if not n:
            return 0, 0
        if self.single.issuperset(text):  # no character can be unknown
            score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for e, (length, s) in self.auto.iter(text):  # by end, the longest piece first
                e += 1
                s += score[e - length]
                if s > score[e]:
                    score[e], count[e] = s, count[e - length] + 1
            return count[n], 0
        score, count, odd, last = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.auto.iter(text) if len(self.auto) else iter(())
        at, found = next(matches, (n, None))
        for e in range(n):
            best, start, single = None, 0, False
            while at == e:  # pieces that end here, the longest first
                length, s = found
                s += score[e + 1 - length]
                if best is None or s > best:
                    best, start = s, e + 1 - length
                single = single or length == 1
                at, found = next(matches, (n, None))
            if best is not None:
                score[e + 1], count[e + 1], odd[e + 1] = best, count[start] + 1, odd[start]
            if not single:
                s = score[e] + self.unknown
                if best is None or s > best:
                    size = len(text[e].encode()) if self.bytes else 0 if last[e] else 1
                    score[e + 1], count[e + 1], odd[e + 1], last[e + 1] = s, count[e] + size, odd[e] + 1, True
        return count[n], odd[n]

    def word(self, word: str) -> int:
        pieces, unknown = self.run(MARK + word)
        if len(word) <= REMEMBER_LENGTH:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            self.known[word] = pieces + (unknown << 32)
        return pieces + (unknown << 32)

    def __call__(self, text: str) -> tuple[int, int]:
        """(pieces, unknown characters) of a whole text."""
        if not text:
            return 0, 0
        if not self.apart:
            text = text.replace(" ", MARK)
            return self.run(text if text.startswith(MARK) else MARK + text)
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            text = text.replace(" ", MARK)
            text = text if text.startswith(MARK) else MARK + text
            words = [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", text)]
        else:
            words = text.split(" ")
        known = self.known.get
        total = sum(known(w) or self.word(w) for w in words)
        return total & 0xFFFFFFFF, total >> 32


def _count(shared, text_at: int):
    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            out = [counter(t.decode("utf-8", "replace")) for t in common.texts(batch.column(text_at))]
            tokens, unknown = (pa.array([x[i] for x in out], pa.int64()) for i in (0, 1))
            chars = pc.fill_null(pc.utf8_length(batch.column(text_at)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, chars, tokens, unknown], names=[*batch.schema.names, "__chars", "__tokens", "__unknown"])

    return run


def count(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__chars``, ``__tokens`` and ``__unknown`` (characters that no piece covers).

    Null and empty texts have no tokens. Repeated rows count alike; an empty table gives none;
    any further columns pass through.
    """
    shared = common.Shared(docs.sparkSession, vocabulary)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in ("__chars", "__tokens", "__unknown")]])
    return docs.mapInArrow(_count(shared, docs.columns.index(text_col)), schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: ``<id_col>, n_chars, n_tokens, n_unknown``."""
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = count(two, load(vocabulary), "__text").select(
        id_col, F.col("__chars").alias("n_chars"), F.col("__tokens").alias("n_tokens"), F.col("__unknown").alias("n_unknown"))
    return common.written(out, "token-count")
