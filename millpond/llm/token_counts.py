"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millpond.llm.arrowtext import bounds, slices

#: Bytes of text given to the library in one call, and the size from which a text is split.
BATCH_BYTES = 1 << 19
LONG_BYTES = 1 << 15
_BLANK = "▁"


class PieceCounter:
    """Counts for a sentencepiece model, with splits that leave the count unchanged.

    A blank is written as U+2581. If every piece that holds one after its first
    character holds nothing else, no piece reaches from another character into a
    blank, so a text may be cut before a blank that follows another character and is not its last.
    The part then starts with the blank that the library puts before any text,
    in place of its own.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(_BLANK in p[1:] and p.strip(_BLANK) for p in pieces)
        # the model must put one blank before a text and leave the other characters as they are
        plain = "".join(self.model.encode(" a  b ", out_type=str)) == f"{_BLANK * 2}a{_BLANK * 2}b{_BLANK}"
        self.splits = plain and not crossing
        self.cut = re.compile(f"(?<=[^ {_BLANK}]) (?=.)", re.DOTALL)

    def parts(self, text: str) -> list[str]:
        """Consecutive parts of at least LONG_BYTES characters whose counts add up to that of the text."""
        if len(text) <= LONG_BYTES or not self.splits:
            return [text]
        parts, start = [], 0
        while found := self.cut.search(text, start + LONG_BYTES):
            parts.append(text[start : found.start()])
            start = found.end()
        return [*parts, text[start:]]

    def counts(self, texts: list[str]) -> np.ndarray:
        parts = [self.parts(t) for t in texts]
        lengths = [len(ids) for ids in self.model.encode([p for ps in parts for p in ps], num_threads=1)]
        ends = np.cumsum([len(ps) for ps in parts])
        return np.diff(np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], ends))])


class JsonCounter:
    """Counts for a tokenizers file; texts go to the library whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def counts(self, texts: list[str]) -> np.ndarray:
        return np.array([len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)], np.int64)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row, as the library of the file's kind counts, without added tokens.

    Rows are grouped into calls of about BATCH_BYTES bytes, so that one call's
    memory does not depend on how long the texts are; only lengths leave the
    worker. Null counts as empty; repeated rows, null ids and empty tables stay
    as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = (JsonCounter if path.endswith(".json") else PieceCounter)(path)
        for rows, texts in slices(batches, text_col, BATCH_BYTES):
            yield pa.record_batch(
                [
                    rows.column(id_col),
                    pa.array(np.diff(bounds(texts)), pa.int64()),
                    pa.array(counter.counts(texts.to_pylist()), pa.int64()),
                ],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("id", id_col)
