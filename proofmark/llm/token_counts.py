"""Token counts of whole texts by a public tokenizer, encoded in batches that return lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import add_fields, keyed_texts, per_batch, safe_pieces

#: Bytes of pieces handed to the encoder at once.
ENCODE_BYTES = 1 << 18
#: Pieces whose length a worker remembers, and the longest one it remembers.
REMEMBERED = 600_000
LONGEST = 48


def balanced(pieces: Iterable[str], limit: int = ENCODE_BYTES) -> Iterator[list[str]]:
    """Batches of about equal bytes (UTF-8); a piece beyond the limit is a batch of its own."""
    batch, held = [], 0
    for piece in pieces:
        size = len(piece) if piece.isascii() else len(piece.encode("utf-8", "replace"))
        if batch and held + size > limit:
            yield batch
            batch, held = [], 0
        batch.append(piece)
        held += size
    if batch:
        yield batch


class LengthEncoder:
    """Lengths of texts in tokens.

    Texts are cut at spaces and line ends, which no token of this library's white-space-dropping tokenizers
    crosses, so lengths of pieces add up to the length of the text. Each distinct piece is encoded once.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocabulary.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
            self._lengths = lambda batch: [len(x) for x in model.encode(batch, num_threads=1)]
            self._splits = False
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(vocabulary)
            model.no_truncation()
            model.no_padding()
            self._lengths = lambda batch: [len(x) for x in model.encode_batch_fast(batch, add_special_tokens=False)]
            self._splits = _drops_spaces(model)
        self._known: dict[str, int] = {"": 0}

    def length(self, text: str) -> int:
        if not self._splits:
            return self._lengths([text])[0] if text else 0
        return sum(self._piece_sum(part) for part in safe_pieces(text))

    def _piece_sum(self, text: str) -> int:
        pieces = text.replace("\n", " ").split(" ")
        known = self._known
        unseen = [piece for piece in set(pieces) if piece not in known]
        if not unseen:
            return sum(map(known.__getitem__, pieces))
        if len(known) > REMEMBERED:
            known.clear()
            known[""] = 0
            unseen = [piece for piece in set(pieces) if piece not in known]
        for batch in balanced(unseen):
            known.update(zip(batch, self._lengths(batch)))
        total = sum(map(known.__getitem__, pieces))
        for piece in unseen:
            if len(piece) > LONGEST:
                del known[piece]
        return total


def _drops_spaces(model) -> bool:
    """Whether lengths of space-separated pieces add up: white space makes no token, before, between or after words."""
    count = lambda text: len(model.encode(text, add_special_tokens=False).ids)
    one = count("a")
    return count(" ") == count("\n") == 0 and all(count(x) == 2 * one for x in ("a a", " a\na ", "a \n a"))


_ENCODERS: dict[str, LengthEncoder] = {}


def encoder(vocabulary: str) -> LengthEncoder:
    """One encoder a worker process: its memory of pieces lasts over batches and tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = LengthEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def token_counts(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is a tokenizer file (.json or .model) that every worker can read. A null or empty text has no
    bytes and no tokens. Repeated rows stay; an empty table gives none. Other columns are not read.
    """
    source = keyed_texts(df, id_col, text_col)

    def start():
        lengths = encoder(vocabulary)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counted = [lengths.length(body.decode("utf-8", "replace")) for body in batch.column("body").to_pylist()]
            sizes = pc.binary_length(batch.column("body")).cast(pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), sizes, pa.array(counted, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

        return step

    counted = source.mapInArrow(per_batch(start), add_fields(source, ["id"], "n_bytes long, n_tokens long"))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
