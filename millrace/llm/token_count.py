"""Token counts without tokens: a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates, for every end position, all vocabulary
pieces that end there; dynamic programming carries the best score and the piece
count of the best path to each position, nothing else. Ties go the way of the
tokenizers library's unigram model: among equal scores the piece that starts
first (the longest) stays, a character that no piece covers costs the lowest
score less 10, and a run of such characters is one piece.

Blanks become U+2581 and one is put in front. Where no piece has U+2581 after
another character (checked), words from one U+2581 to the next are counted one
by one and kept in a bounded store. That is exact while sums of scores are, so
it needs scores that are whole numbers; otherwise whole texts are walked.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

MARK = "▁"
PENALTY = 10.0


#: Offset of the rank law below: with it counts come nearest to those of the file's own encoder.
RANK_OFFSET = 300


def piece_vocabulary(path: str, offset: int = RANK_OFFSET) -> list[tuple[str, float]]:
    """The normal pieces of a sentencepiece file, in id order, with unigram scores.

    The public files hold merges, whose scores are ranks. Ranks fall with
    frequency, so a piece of rank r gets the log-probability of the rank law,
    log(1 / (r + offset)), in whole hundredths: nothing is trained.
    """
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    keep = [i for i in range(m.vocab_size()) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]
    return [(m.id_to_piece(i), -float(round(100 * math.log(offset - m.get_score(i))))) for i in keep]


class Counter:
    """Best score and piece count of texts under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unk_score: float = 0.0, bound: int = 300_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min([unk_score, *(s for _, s in vocabulary)]) - PENALTY
        self.by_word = all(MARK not in p.lstrip(MARK) for p, _ in vocabulary) and all(
            float(s).is_integer() for _, s in vocabulary
        )
        self.seen: dict[str, tuple[float, int]] = {}
        self.bound = bound

    def walk(self, text: str) -> tuple[float, int]:
        n = len(text)
        score, count, unk = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: dict[int, list] = {}
        for end, found in self.automaton.iter(text):
            ends.setdefault(end + 1, []).append(found)
        for end in range(1, n + 1):
            best, single = None, False
            for length, s in sorted(ends.get(end, ()), reverse=True):
                start = end - length
                total = s + score[start]
                if best is None or total > best[0]:
                    best = (total, count[start] + 1, False)
                single |= length == 1
            if not single:
                total = self.unknown + score[end - 1]
                if best is None or total > best[0]:
                    best = (total, count[end - 1] + (not unk[end - 1]), True)
            score[end], count[end], unk[end] = best
        return score[n], count[n]

    def text(self, text: str | None) -> tuple[float, int]:
        """An empty text has no pieces and score 0."""
        if not text:
            return 0.0, 0
        text = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.walk(text)
        total, pieces, blanks = 0.0, 0, ""
        seen = self.seen
        for part in text.split(MARK)[1:]:
            if not part:
                blanks += MARK
                continue
            word = f"{blanks}{MARK}{part}" if blanks else MARK + part
            blanks = ""
            got = seen.get(word)
            if got is None:
                got = self.walk(word)
                if len(word) <= 64:
                    if len(seen) >= self.bound:
                        seen.clear()
                    seen[word] = got
            total += got[0]
            pieces += got[1]
        if blanks:
            got = self.walk(blanks)
            total += got[0]
            pieces += got[1]
        return total, pieces


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, best_score.

    ``model`` is a sentencepiece file whose pieces are taken as the unigram
    vocabulary (``piece_vocabulary``). Null counts as empty (0 tokens); repeated
    rows are counted each; a null identifier is one like any other; no rows give
    no rows; other columns are not looked at. A long text is walked word by word;
    one word without a blank is held whole, some 200 bytes a character.
    """

    def run(batches):
        if model not in _counters:
            _counters[model] = Counter(piece_vocabulary(model))
        counter = _counters[model]
        for batch in slices(batches):
            got = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for _, c in got], pa.int64()), pa.array([s for s, _ in got], pa.float64())],
                names=["doc_id", "n_tokens", "best_score"],
            )

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, n_tokens bigint, best_score double")
