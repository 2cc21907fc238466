"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A short text is encoded at once. A longer one is cut into chunks that overlap. Each
chunk is encoded on its own, with the offset at which every token ends. Two
neighbouring encodings are spliced at a place inside their overlap at which

- both have a token boundary, and
- no token can reach across it: the two characters at the place stand side by side
  in no entry of the vocabulary, so no merge of pieces ever joins them.

Left of such a place the tokens depend only on what stands left of it, right of it
only on what stands right. The spliced tokens are therefore those of the whole text.
Where an overlap has no such place, the left chunk is widened to the right, twice as
far each time, until there is one or the text ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.common import bound_batches, named, text_chunks

CHUNK = 32_768
OVERLAP = 512
LIMIT = 4096
_SPACE = "▁"


class PieceCounter:
    """Counts the tokens of a sentencepiece model; ``path`` is the model file on the worker."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        if not 2 <= overlap < chunk:
            raise ValueError("an overlap has at least 2 characters and is shorter than a chunk")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        ordinary = [
            not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
            for i in range(size)
        ]
        #: Pairs of characters that some entry of the vocabulary holds side by side.
        self.pairs = {
            p[i : i + 2] for p, yes in zip(pieces, ordinary) if yes for i in range(len(p) - 1)
        }
        # Characters each token covers. Of a character in byte tokens, the first byte counts.
        lead = [int(not 0x80 <= int(p[3:5], 16) < 0xC0) if self.model.is_byte(i) else 0 for i, p in enumerate(pieces)]
        self.width = np.array(
            [lead[i] if self.model.is_byte(i) else len(p) if yes else 1 for i, (p, yes) in enumerate(zip(pieces, ordinary))]
        )

    def ends(self, text: str, start: int) -> np.ndarray:
        """Offset in the whole text at which each token of a chunk ends."""
        ids = np.array(self.model.encode(text, num_threads=1), np.int64)
        # The library puts one space in front of what it encodes.
        ends = start - 1 + np.cumsum(self.width[ids])
        if len(ends) and ends[-1] != start + len(text):
            raise ValueError("the tokens of a chunk do not cover it")
        return ends

    def stable(self, text: str, place: int) -> bool:
        """True if no token of any encoding reaches across the place."""
        pair = text[place - 1 : place + 1].replace(" ", _SPACE)
        return pair not in self.pairs

    def splice(self, text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
        """A place between low and high at which the two encodings may be joined."""
        both = np.intersect1d(left, right)
        for place in both[(both > low) & (both < high)].tolist():
            # Bytes of one character end at the same place as the character does.
            if self.stable(text, place):
                return place
        return None

    def count_long(self, text: str) -> int:
        # The left chunk is text[first:end]; its tokens count from the last splice on. The token
        # of the space that the library adds ends at 0.
        total, first, cut = 0, 0, -1
        end = min(len(text), self.chunk)
        ends = self.ends(text[:end], 0)
        overlap = self.overlap
        while end < len(text):
            start = max(cut, end - overlap, 0)
            reach = min(len(text), max(start + self.chunk, end + 1))
            following = self.ends(text[start:reach], start)
            place = self.splice(text, ends, following, start, end)
            if place is None:
                # No agreement: the left chunk goes on, twice as far each time.
                overlap *= 2
                end = min(len(text), end + overlap)
                ends = self.ends(text[first:end], first)
                continue
            total += int(np.count_nonzero((ends > cut) & (ends <= place)))
            first, cut, end, ends, overlap = start, place, reach, following, self.overlap
        return total + int(np.count_nonzero(ends > cut))

    def counts(self, texts: list[str]) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        out = [0] * len(texts)
        for i, ids in zip(short, self.model.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i, text in enumerate(texts):
            if len(text) > self.chunk:
                out[i] = self.count_long(text)
        return out


@lru_cache(maxsize=4)
def _counter(path: str, chunk: int, overlap: int) -> PieceCounter:
    return PieceCounter(path, chunk, overlap)


def count_tokens(
    docs: DataFrame,
    model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Per document ``(id, n_bytes, n_tokens, over_limit)``.

    ``model`` is the path of a sentencepiece model with the identity normaliser, readable on every
    worker. A null text counts as empty: 0 bytes, 0 tokens. Each row is counted on
    its own, so repeated rows give repeated results, and rows without an id keep a null id.
    """
    bound_batches(docs.sparkSession)
    texts = named(docs, id=id_column, text=text_column)
    id_type = texts.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model, chunk, overlap)
        for batch in batches:
            for rows, _, bounds in text_chunks(batch, "text"):
                counts = counter.counts([t or "" for t in rows.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(np.diff(bounds)), pa.array(counts, pa.int64())],
                    ["id", "n_bytes", "n_tokens"],
                )

    counted = texts.mapInArrow(count, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
