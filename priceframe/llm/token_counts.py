"""Operator 9: token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary piece in a word; dynamic
programming over the word's characters carries the best score and its number
of pieces, no back-pointers.  The rules are those of the unigram tokenizer:
blanks become the word mark, each word starts at a mark, a path's score is the
sum of its pieces' scores, of equal scores the one whose last piece starts
first wins, a character that no piece covers costs the least score minus 10
and counts as its UTF-8 bytes (byte fallback).

Scale: a map over the scan, no shuffle; a word seen before is a dictionary
look-up in a cache of bounded size, a long word is linear in its length.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table
from .tokens import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"          #: stands for a blank
UNKNOWN_PENALTY = 10.0   #: below the least score of the vocabulary
CACHE = 1 << 18          #: words remembered by one Python worker


def load_pieces(name: str) -> list[tuple[str, float]]:
    """(piece, score) of the normal pieces of a sentencepiece file, its scores taken as unigram scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
    return [(sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class UnigramCounter:
    """Counts the unigram tokens of texts for one vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]], cache: int = CACHE):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for piece, score in pieces:
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}
        self.limit = cache

    def word(self, word: str) -> int:
        """Pieces on the best path over one word (mark included)."""
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        matches = self.auto.iter(word)
        at, piece = next(matches, (n, None))
        for i in range(n):
            best, pieces, single = None, 0, False
            while at == i:  # longest first: the earliest start comes first and keeps a tie
                length, value = piece
                got = score[i + 1 - length] + value
                if best is None or got > best:
                    best, pieces = got, count[i + 1 - length] + 1
                single = single or length == 1
                at, piece = next(matches, (n, None))
            if not single:
                got = score[i] + self.unknown
                if best is None or got > best:
                    best, pieces = got, count[i] + len(word[i].encode("utf-8", "replace"))
            score[i + 1], count[i + 1] = best, pieces
        return count[n]

    def _words(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        return marked.split(MARK)[1:]

    def text(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty texts have none."""
        if not text:
            return 0
        words = self._words(text)
        counts = list(map(self.cache.get, words))
        if None in counts:
            fresh = {w: self.word(MARK + w) for w in {w for w, c in zip(words, counts, strict=True) if c is None}}
            if len(self.cache) + len(fresh) <= self.limit:
                self.cache.update(fresh)
            counts = [fresh[w] if c is None else c for w, c in zip(words, counts, strict=True)]
        return sum(counts)


@lru_cache(maxsize=4)
def counter(name: str) -> UnigramCounter:
    return UnigramCounter(load_pieces(name))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_chars, n_tokens)`` per input row, n_chars in code points.

    Defined cases: a null text counts as empty, both 0; a null id stays null;
    repeated rows are each counted; an empty table gives no rows; other columns
    are not read.
    """
    def run(batches):
        c = counter(vocabulary)
        for pdf in batches:
            texts = pdf["text"]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_chars": [len(t or "") for t in texts],
                                "n_tokens": [c.text(t) for t in texts]})

    # Ids pass through Python as text: exact also where a batch has nulls.
    rows = docs.select(pick(id_col).cast("long").cast("string").alias("doc_id"),
                       pick(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id string, n_chars long, n_tokens long") \
        .withColumn("doc_id", F.col("doc_id").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the whole ``documents`` table."""
    return token_counts(table(spark, sf_dir, "documents"))
