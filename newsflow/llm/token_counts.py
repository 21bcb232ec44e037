"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at a character; one pass
over the characters keeps, per position, the best score and how many pieces it took. No
segmentation is built. Blanks become the word mark, one mark goes in front. No piece of
the vocabulary may run over into the next mark, so the text falls into units (marks, then
other characters) that can be solved one by one; what a unit costs is remembered.

Tie rule of the tokenizer: candidates for a position are tried from the earliest start on
and only a strictly better score replaces one, so among equals the longest last piece
wins. A character without a piece of its own costs the lowest score less ten and counts
as one piece per byte.

Defined results: missing and empty texts have no pieces and score 0; repeated rows are
counted each; other columns are not looked at.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.tasks import map_texts, texts_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Units whose result a task remembers.
REMEMBERED = 300_000
_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Viterbi:
    """Best score and piece count of a text under ``{piece: score}``."""

    def __init__(self, scores: dict[str, float]):
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.matches = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        #: Whether a mark can only be the beginning of a piece, or within a run of marks.
        self.by_unit = not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in scores)
        self.empty = not scores
        self.known: dict[str, tuple[float, int]] = {}

    def solve(self, unit: str) -> tuple[float, int]:
        size = len(unit)
        score: list[float] = [0.0] * (size + 1)
        count = [0] * (size + 1)
        reached = 0
        single = False

        def close(end: int) -> None:
            """All pieces that end here were seen; the lone character comes last."""
            if not single:
                other = score[end - 1] + self.unknown
                if not found or other > score[end]:
                    score[end] = other
                    count[end] = count[end - 1] + len(unit[end - 1].encode("utf-8", "surrogatepass"))

        found = False
        for last, (length, weight) in () if self.empty else self.matches.iter(unit):
            end = last + 1
            while reached < end:
                if reached:
                    close(reached)
                reached, found, single = reached + 1, False, False
            other = score[end - length] + weight
            single = single or length == 1
            if not found or other > score[end]:
                score[end], count[end], found = other, count[end - length] + 1, True
        while reached < size:
            if reached:
                close(reached)
            reached, found, single = reached + 1, False, False
        if size:
            close(size)
        return score[size], count[size]

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        total, pieces, known = 0.0, 0, self.known
        for unit in _UNITS.findall(marked) if self.by_unit else [marked]:
            hit = known.get(unit)
            if hit is None:
                hit = self.solve(unit)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(unit) < 64:
                    known[unit] = hit
            total += hit[0]
            pieces += hit[1]
        return total, pieces


@lru_cache(maxsize=2)
def load(model_file: str) -> Viterbi:
    """The ordinary pieces of a sentencepiece file with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = (model.is_unknown, model.is_control, model.is_unused, model.is_byte)
    return Viterbi({model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not any(test(i) for test in special)})


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, score`` of every whole text."""

    def make():
        viterbi = load(model_file)

        def apply(batch):
            solved = [viterbi.text(t) for t in texts_of(batch)]
            return {"n_tokens": pa.array([n for _, n in solved], pa.int64()), "score": pa.array([s for s, _ in solved], pa.float64())}

        return apply

    return map_texts(docs, id_col, text_col, "n_tokens long, score double", make)
