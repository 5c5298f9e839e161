"""Token counts of a unigram tokenizer, without its tokens.

Aho-Corasick lists all vocabulary pieces in a word with their ends in order,
and dynamic programming carries, for each end, the best score and the number
of pieces of the way there. Ties follow the tokenizer: of equal scores the way
whose last piece begins first stays, and an unknown character (scored ten below
the worst piece) is tried last. Neighbouring unknown characters are one unknown
token or, with byte fallback, as many byte tokens as they have bytes.

The vocabulary is the pieces and scores of a SentencePiece model file (bounded
by ``MAX_MODEL_BYTES``, broadcast). Words are what the Metaspace pre-tokenizer
gives: spaces become U+2581, one is put in front, and each begins a word. A
word's count is remembered.

Cases: null and empty texts have no tokens. Repeated rows and null ids stay as
they are, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of, worker_wide
from precinct.llm.tables import text_of

MAX_MODEL_BYTES = 64 << 20
MAX_WORDS = 500_000
SPACE = "▁"
#: An unknown character scores so much below the worst piece.
UNKNOWN_BELOW = 10.0
#: No further match.
END = (-1, (0, 0.0))


def vocabulary(model: bytes) -> list[tuple[str, float]]:
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [(pieces.id_to_piece(i), pieces.get_score(i)) for i in range(pieces.get_piece_size())]


class Counter(dict):
    """Word -> (tokens, best score)."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_BELOW
        names = {piece for piece, _ in pieces}
        self.fallback = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = out = self.counted(word)
        return out

    def counted(self, word: str) -> tuple[int, float]:
        """(tokens, score) of the best way through ``word``."""
        n, unknown = len(word), self.unknown
        # To each end: best score, pieces so far, whether an unknown character ends there.
        scores, counts, run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found = self.automaton.iter(word)
        last, (size, score) = next(found, END)
        for end in range(1, n + 1):
            top, single = None, False
            while last == end - 1:  # the longest piece, so the first start, comes first
                value = scores[end - size] + score
                if top is None or value > top:
                    top, count = value, counts[end - size] + 1
                single = single or size == 1
                last, (size, score) = next(found, END)
            if not single:
                value = scores[end - 1] + unknown
                if top is None or value > top:
                    more = len(word[end - 1].encode()) if self.fallback else not run[end - 1]
                    top, count, run[end] = value, counts[end - 1] + more, True
            scores[end], counts[end] = top, count
        return counts[n], scores[n]

    def text(self, text: str) -> tuple[int, float]:
        tokens, total = 0, 0.0
        for word in words_of(text):
            n, score = self[word]
            tokens += n
            total += score
        return tokens, total


def counter_of(model: bytes) -> Counter:
    return Counter(vocabulary(model))


def words_of(text: str) -> list[str]:
    """What the Metaspace pre-tokenizer makes of ``text``."""
    if not text:
        return []
    text = text.replace(" ", SPACE)
    if not text.startswith(SPACE):
        text = SPACE + text
    return [SPACE + word for word in text.split(SPACE)[1:]]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, best_score) of each row."""
    with open(path, "rb") as f:
        content = f.read(MAX_MODEL_BYTES + 1)
    if len(content) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    model = docs.sparkSession.sparkContext.broadcast(content)
    schema = f"doc_id {docs.schema[key].dataType.simpleString()}, n_tokens bigint, best_score double"
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, out = worker_wide(counter_of, model.value), Batches(fields)
        for doc_id, t in rows_of(batches):
            yield from out.add((doc_id, *counter.text(t)))
        yield from out.flush()

    return map_arrow(docs.select(F.col(key).alias("doc_id"), text_of(docs, text).alias("text")), run, schema, keeps=True)
