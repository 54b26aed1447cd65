"""Operator 1: token counts by a count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.llm.common import query, table, text_map

#: A public vocabulary file with piece scores; the path is a parameter.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: How far below the lowest score an unknown character lies.
UNKNOWN_PENALTY = 10.0
#: Most chunks whose result a task remembers.
REMEMBERED = 400_000
_SPACE = "▁"


@dataclass
class Counter:
    """Counts the pieces of texts under one vocabulary, remembering chunks.

    No piece spans a chunk boundary (read off the vocabulary), so the best path
    of a text is the best paths of its chunks, and a chunk seen before is looked
    up. Scores are single-precision numbers added in double precision, as exact
    as the tokenizer's.
    """

    model: bytes
    pieces: ahocorasick.Automaton = field(init=False)
    chunks: re.Pattern | None = field(init=False)
    memory: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        sp = self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        ids = range(sp.get_piece_size())
        self.bytes_for_unknown = any(map(sp.is_byte, ids))
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.lowest = min((sp.get_score(i) for i in normal), default=0.0) - UNKNOWN_PENALTY
        self.pieces = ahocorasick.Automaton()
        together = set()
        for i in normal:
            piece = sp.id_to_piece(i)
            self.pieces.add_word(piece, (len(piece), sp.get_score(i)))
            together.update(zip(piece, piece[1:], strict=False))
        self.pieces.make_automaton()
        self.chunks = self._boundaries(together)

    def _boundaries(self, together: set[tuple[str, str]]) -> re.Pattern | None:
        """Chunks: space marks, then a run of letters and digits or a run of other characters.

        Where some piece holds a letter beside another character (the few such
        pairs are listed), the two runs stay one chunk.
        """
        if any(b == _SPACE and a != _SPACE for a, b in together) or not self.bytes_for_unknown:
            return None
        runs = f"(?:[^\\W_]+|(?:[^\\w{_SPACE}]|_)+)"
        plain = re.compile("[^\\W_]")
        pairs = sorted(
            (a, b) for a, b in together if _SPACE not in (a, b) and bool(plain.match(a)) != bool(plain.match(b))
        )
        if len(pairs) > 200:
            return re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
        glue = "|".join(f"(?<={re.escape(a)})(?={re.escape(b)})" for a, b in pairs)
        more = f"(?:(?:{glue}){runs})*" if pairs else ""
        return re.compile(f"{_SPACE}*{runs}{more}|{_SPACE}+")

    def viterbi(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of the best path through ``text``.

        The pieces that end at a place come from the automaton longest first, so
        the one that starts first is kept unless a later one scores higher.
        """
        n = len(text)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        matches = self.pieces.iter(text)
        at, match = next(matches, (n, None))
        lowest, merges = self.lowest, not self.bytes_for_unknown
        unknown = -1  # where the best path last ended in an unknown character
        for last in range(n):
            top, pieces, length = None, 0, 0
            while at == last:
                length, score = match
                value = best[last + 1 - length] + score
                if top is None or value > top:
                    top, pieces = value, count[last + 1 - length] + 1
                at, match = next(matches, (n, None))
            if length != 1:  # no piece is this one character: it may be unknown
                value = best[last] + lowest
                if top is None or value > top:
                    own = int(unknown != last) if merges else len(text[last].encode())
                    top, pieces, unknown = value, count[last] + own, last + 1
            best[last + 1], count[last + 1] = top, pieces
        return count[n], best[n]

    def count(self, text: str | None) -> int:
        """The number of pieces of a whole text; none for null."""
        text = self.tokenizer.normalize(text) if text else ""
        if not text:
            return 0
        if self.chunks is None:
            return self.viterbi(text)[0]
        total, memory = 0, self.memory
        for chunk in self.chunks.findall(text):
            pieces = memory.get(chunk)
            if pieces is None:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                pieces = memory[chunk] = self.viterbi(chunk)[0]
            total += pieces
        return total


@lru_cache(maxsize=2)
def counter(model: bytes) -> Counter:
    """One counter a process: its memory serves all batches of a worker."""
    return Counter(model)


def token_counts(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id and ``n_tokens`` of every row of ``docs`` (doc_id, text), whole texts.

    The vocabulary and scores of ``model_path`` are read as a unigram model:
    Aho-Corasick finds the pieces at every position, dynamic programming keeps
    the best score and its number of pieces. Normalisation is the file's own.
    Ties go to the piece that starts first; unknown characters count their UTF-8
    bytes where the vocabulary has byte pieces, else a run of them counts once.
    A null or empty text has no tokens; repeated rows are all returned; an empty
    table gives an empty result; other columns are not read. Only the file (half
    a megabyte) is broadcast; rows stay where they are.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def work(column: pa.Array) -> list[pa.Array]:
        count = counter(model.value).count
        return [pa.array([count(t) for t in column.to_pylist()], pa.int64())]

    return text_map(docs, "text", ["doc_id"], "n_tokens long", work)


@query("op1_tokens")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token counts."""
    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", F.col("n_tokens"))
