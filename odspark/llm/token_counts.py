"""Token counts (op 7): count-only Viterbi over a unigram vocabulary, in Arrow batches without a shuffle.

An Aho-Corasick automaton enumerates the vocabulary's matches in a text; for every end of a match dynamic programming keeps the best score and the number of
pieces on that path, nothing else. Tie rules are those of the tokenizers library's unigram model: at an end, candidates come by
ascending start, and a later one replaces an earlier one only with a higher score; a character that no single-character piece
covers is also offered as unknown, at the least score of the vocabulary minus 10, after the pieces of the same start. Unknown characters count their UTF-8
bytes where the model has byte pieces; otherwise neighbouring ones count as one. Scores are added as 64-bit floats.

The vocabulary is that of a SentencePiece model file, its scores taken as unigram scores; a text is prepared as that model does (a space before it,
spaces as a mark). No piece holds the mark after another character, so each best path passes the ends of words, and the
best path of a text is made of those of its stretches; a worker remembers short stretches (bounded in bytes).

Defined cases: a null or empty text has 0 tokens and score 0; documents without id or with equal ids are counted row by row; extra columns pass through `count`,
whose added columns replace columns of the same names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from odspark.llm.common import Memo, add_columns, held, table
from odspark.llm.piece_model import SPACE, Pieces, default_path, load

MODEL = "piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0


class Viterbi:
    """Best score and piece count of texts under a unigram vocabulary."""

    def __init__(self, scores: dict[str, float], byte_pieces: bool):
        import ahocorasick

        if any(SPACE in p.lstrip(SPACE) for p in scores):
            raise ValueError("pieces with a word start inside are not supported")
        self.machine = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.bytes = byte_pieces
        line_ends = any("\n" in p for p in scores)
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if line_ends else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.memo = Memo(self.stretch)

    def stretch(self, text: str) -> tuple[int, float, bool, bool]:
        """Pieces, score, and whether the best path begins and ends with an unknown character."""
        n = len(text)
        best, count, open_, first = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1), [False] * (n + 1)
        matches = iter(self.machine.iter(text))
        end, match = next(matches, (n, None))
        for i in range(n):
            top, single, to = None, False, None
            while end == i:                            # longest first: ascending starts
                size, score = match
                at = i + 1 - size
                score += best[at]
                if top is None or score > top:
                    top, to = score, (count[at] + 1, False, first[at] if at else False)
                single = single or size == 1
                end, match = next(matches, (n, None))
            if not single:
                score = best[i] + self.unknown
                if top is None or score > top:
                    more = len(text[i].encode()) if self.bytes else 0 if open_[i] else 1
                    top, to = score, (count[i] + more, True, first[i] if i else True)
            best[i + 1] = top
            count[i + 1], open_[i + 1], first[i + 1] = to
        return count[n], best[n], first[n], open_[n]

    def count(self, text: str) -> tuple[int, float]:
        """Number of tokens and score of the best path of a text."""
        if not text:
            return 0, 0.0
        found = list(map(self.memo.__getitem__, self.pattern.findall(SPACE + text.replace(" ", SPACE))))
        tokens = sum([f[0] for f in found])
        if not self.bytes:                             # unknown characters that meet at the ends of stretches are one
            tokens -= sum(a[3] and b[2] for a, b in zip(found, found[1:]))
        return tokens, sum([f[1] for f in found])


def viterbi(pieces: Pieces) -> Viterbi:
    return Viterbi(pieces.scores, bool(pieces.byte_ids))


def count(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with n_tokens and score."""
    path = path or default_path(MODEL)

    def per_text(texts):
        v = held("token_counts", path, lambda: viterbi(load(path)))
        found = [v.count(t.decode() if t else "") for t in texts]
        return [f[0] for f in found], [f[1] for f in found]

    return add_columns(docs, text_col, "n_tokens long, score double", per_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: number of tokens and score of the best path of every document."""
    return count(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "score")
