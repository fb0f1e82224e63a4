"""Operator 1: BPE encoding and decoding over tries of distinct words.

Each worker splits its texts in words, inserts the words it hasn't met in a
trie and propagates the last token of every prefix depth first
(``tokenizing.TrieBPE``); texts are then joined from their words' ids.  Nothing
is shuffled, and a worker's memory is bounded by its word cache and one batch.

Cases: a null or empty text has no ids and decodes to the empty text; a null
id stays null; repeated rows each give a row; strings of special tokens in a
text become their ids, as the tokenizers library has it; an empty table gives
an empty result.  Other columns of the input are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from habitra.llm.common import map_batches, strings, text_of
from habitra.llm.tokenizing import TrieBPE, encoder


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (binary: little-endian unsigned 32-bit integers) of every whole text."""

    def make():
        bpe = encoder(TrieBPE, tokenizer)
        return lambda b: {"doc_id": b.column("doc_id"), "ids": bpe.encode_texts(strings(b, "text"))}

    return map_batches(text_of(df, id_col, text_col), make, "doc_id long, ids binary")


def decode(df: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids``, ``text`` from what ``encode`` gives; ids that form no UTF-8 give U+FFFD, null ids the empty text."""

    def make():
        bpe = encoder(TrieBPE, tokenizer)
        texts = lambda b: [bpe.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column("ids").to_pylist()]
        return lambda b: {"doc_id": b.column("doc_id"), "ids": b.column("ids"), "text": texts(b)}

    return map_batches(df.select("doc_id", "ids"), make, "doc_id long, ids binary, text string")
