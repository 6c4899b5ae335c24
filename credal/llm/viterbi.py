"""Token counts of a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists, for every end position, the vocabulary
pieces that end there, longest first. A dynamic program keeps the best score
and the number of pieces up to each position; only these two.

Tie rule of unigram tokenizers: a later candidate replaces an earlier one only
with a strictly larger score, and candidates come by rising start, so that of
equal scores the longest piece wins. A character that no single-character
piece covers may be taken as unknown, at the lowest score minus 10; neighbouring
unknowns are one unknown token, or, with byte pieces, one token per UTF-8 byte.

The counts are those of a unigram model over the given pieces and scores. Of a
file that holds a BPE model the scores are the ranks of its merges, so the best
path may differ from what its merges build: such counts are an estimate of the
BPE's own.

A text is counted word by word when no piece crosses a word start: the best
path then has a cut there, and scores add up. Counts of words already met are
kept in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000


class UnigramCounter:
    """Piece counts under ``pieces``: (piece, score) in id order.

    White space is marked as in the vocabulary: a mark is put before the text and
    every space becomes one. An empty text has no pieces. Scores are added in
    double precision; with whole-number scores sums are exact, so counting by
    words gives what counting the whole text gives.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool = False):
        self.automaton = ahocorasick.Automaton()
        scores = {}
        for piece, score in pieces:
            if piece:
                scores[piece] = float(score)
        self.longest = max(map(len, scores), default=1)
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = byte_fallback
        #: a piece crosses a word start when it has a mark after another character
        self.by_word = not any(MARK in p.lstrip(MARK) for p in scores) \
            and all(float(s).is_integer() for s in scores.values())
        #: a line feed is in no piece and is one byte: every path is cut there
        self.by_line = self.bytes and not any("\n" in p for p in scores)
        self.cache: dict[str, int] = {}

    def path(self, text: str) -> int:
        """Number of tokens on the best path of ``text`` (marked already)."""
        n, ring = len(text), self.longest + 1                     # places a piece can reach back
        found_at = self.automaton.iter(text)
        nearest = next(found_at, None)
        none = float("-inf")
        best, count, open_unknown = [none] * ring, [0] * ring, [False] * ring
        best[0] = 0.0
        for end in range(n):
            found = []
            while nearest is not None and nearest[0] == end:
                found.append(nearest[1])
                nearest = next(found_at, None)
            found.sort(reverse=True)                               # rising start
            ch, here, there = text[end], end % ring, (end + 1) % ring
            top, pieces, unknown = none, 0, False
            for length, score in found:
                start = (end + 1 - length) % ring
                if best[start] + score > top:
                    top, pieces, unknown = best[start] + score, count[start] + 1, False
            if ch not in self.single and best[here] + self.unknown > top:
                top, unknown = best[here] + self.unknown, True
                if self.bytes:
                    pieces = count[here] + len(ch.encode("utf-8", "surrogatepass"))
                else:
                    pieces = count[here] + (not open_unknown[here])
            best[there], count[there], open_unknown[there] = top, pieces, unknown
        return count[n % ring]

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty count 0."""
        if not text:
            return 0
        if not self.by_word or MARK in text:
            return self.path(MARK + text.replace(" ", MARK))
        total, cache = 0, self.cache
        lines = text.split("\n") if self.by_line else [text]
        for i, line in enumerate(lines):
            lead = 0 if i else 1
            total += bool(i)                       # the line feed, one byte
            for j, word in enumerate(line.split(" ")):
                lead += bool(j)
                if not word:
                    continue
                key = MARK * lead + word
                got = cache.get(key)
                if got is None:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    got = cache[key] = self.path(key)
                total += got
                lead = 0
            if lead:
                total += self.path(MARK * lead)
        return total


def read_pieces(model: str) -> tuple[list[tuple[str, float]], bool]:
    """The pieces of plain text of a sentencepiece model file and their scores, and
    whether it falls back to bytes. Control, unknown, unused and byte pieces match
    no text: their strings in a text are ordinary characters."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in plain], sum(sp.is_byte(i) for i in range(n)) == 256


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """``docs(doc_id, text)`` → ``doc_id, n_tokens``, one row per row. Null and
    empty texts count 0; whole texts count, however long."""
    small_batches(docs.sparkSession)

    def count(batches):
        counter = UnigramCounter(*read_pieces(model))
        for batch in batches:
            n = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(count, "doc_id long, n_tokens long")
