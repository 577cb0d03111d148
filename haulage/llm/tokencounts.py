"""Operator 9: token counts of whole texts by count-only Viterbi over a unigram vocabulary.

The vocabulary is the pieces of a public file with their scores. Spaces are written as ``▁``, one is put in
front, and the text is parted before each. In such a part an Aho-Corasick automaton finds every piece at every
place in one pass; the best score and its number of pieces are carried from place to place, and no
segmentation is ever built. The rules are those of the tokenizers library's unigram model, ties included:

- of equal scores at one place, the one that begins first stands: a later one must be better;
- a character that is no piece itself is an unknown of score (smallest score - 10), and counts as its UTF-8
  bytes (byte fallback);
- scores are added up from the left in 64-bit numbers.

Parts are independent, so each different one is worked out once per task and remembered, up to
``REMEMBERED`` of them; then the memory starts anew.

Defined results: a missing or empty text has no tokens; rows are counted each; an empty table gives an empty one.
Added columns come beside the row in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import tokenizer_file
from .words import pieces

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed by the tokenizer
REMEMBERED = 1_000_000


def vocabulary(file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def part(self, text: str) -> int:
        """Tokens of a text that is not parted any further."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(text)
        end, found = next(matches, (n, None))
        for at in range(n):
            # Matches that end here come longest first, so by rising start; a single character is the last.
            best, tokens, single = None, 0, False
            while end == at:
                length, own = found
                start = at + 1 - length
                if best is None or score[start] + own > best:
                    best, tokens = score[start] + own, count[start] + 1
                single = single or length == 1
                end, found = next(matches, (n, None))
            if not single and (best is None or score[at] + self.unknown > best):
                best, tokens = score[at] + self.unknown, count[at] + len(text[at].encode())
            score[at + 1], count[at + 1] = best, tokens
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ")
        parts = text.split(" ")
        if text[0] == " ":
            parts = parts[1:]
        known = self.known
        try:
            return sum(map(known.__getitem__, parts))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for p in set(parts).difference(known):
                known[p] = self.part(MARK + p)
            return sum(map(known.__getitem__, parts))


def _count(file: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary(file))
        for part in pieces(batches, "text"):
            n = [counter.text(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(n, pa.int64())], ["doc", "n_tokens"])

    return count


def token_counts(docs: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """Every row's ``doc`` (without its text) and ``n_tokens``."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_count(file or tokenizer_file("piece_bpe_32k.model")), f"doc {kind}, n_tokens bigint")


def op9_tokencounts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs).select(F.col("doc.doc_id").alias("doc_id"), "n_tokens")
