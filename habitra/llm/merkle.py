"""Operator 2: document fingerprints as Merkle trees.

A text is cut in sections (at blank lines), paragraphs (lines) and leaves
(sentences, or pieces of at most 160 code points); the cuts depend on the text
around them only, so text that moves keeps its hashes.  A node's hash covers its
children's hashes; equal roots mean equal texts.  The fingerprint is the tree
written out: root, then leaf hashes by section and paragraph.  Where two trees
differ, only differing branches are opened: their leaves locate the edits.

Cases: a null or empty text is a tree without leaves; empty texts are alike
(1.0), and unlike any other text (0.0); a null doc_id stays null and sorts
first; rows with the same doc_id follow each other in the order of their texts;
the next document of the only row is itself; a text of any length is read
whole; an empty table gives an empty result.  Other columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habitra.llm.common import input_bytes, map_batches, strings, text_of

SECTION = re.compile(r"(?:[^\n]|\n(?!\n))*\n*")
LINE = re.compile(r"[^\n]*\n|[^\n]+")
LEAF = re.compile(r"[^.!?]{1,160}(?:[.!?]+\s*)?|[.!?]+\s*")


#: Bytes of files behind a range of ids, and the most ranges: the driver holds a number for each.
RANGE_BYTES, MOST_RANGES = 12 << 20, 1 << 17


class Tree:
    """Sections -> paragraphs -> leaf hashes (32 bits each) of a text, with each leaf's place; ``root`` is 128 bits."""

    __slots__ = ("paragraph_hashes", "root", "section_hashes", "sections", "spans")

    def __init__(self, text: str):
        self.sections: list[list[list[int]]] = []
        self.spans: list[list[list[tuple[int, int]]]] = []
        self.section_hashes: list[bytes] = []
        self.paragraph_hashes: list[list[bytes]] = []
        digest, short = xxhash.xxh3_128_digest, xxhash.xxh3_64_digest
        at = 0
        parts = [text] if "\n\n" not in text and text else [s for s in SECTION.findall(text) if s]
        for section in parts:
            paragraphs, spans, hashes = [], [], []
            for line in LINE.findall(section):
                leaves = LEAF.findall(line)
                ends, where = at, []
                for x in leaves:
                    where.append((ends, ends + len(x)))
                    ends += len(x)
                at = ends
                leaf_hashes = [short(x) for x in leaves]
                paragraphs.append([int.from_bytes(x[:4], "big") for x in leaf_hashes])
                spans.append(where)
                hashes.append(digest(b"".join(leaf_hashes)))
            self.sections.append(paragraphs)
            self.spans.append(spans)
            self.paragraph_hashes.append(hashes)
            self.section_hashes.append(digest(b"".join(hashes)))
        self.root = digest(b"".join(self.section_hashes) + len(text).to_bytes(8, "little"))

    def fingerprint(self) -> str:
        """Root, a colon, then 8 hex digits for each leaf; commas between paragraphs, bars between sections."""
        return self.root.hex() + ":" + "|".join(",".join("".join([f"{x:08x}" for x in p]) for p in s) for s in self.sections)

    def size(self) -> int:
        return sum(len(p) for s in self.sections for p in s)

    def open(self, same: Counter[bytes], same_paragraphs: Counter[bytes]) -> tuple[int, Counter[int], list[tuple[int, int, int]]]:
        """Leaves in branches that the other tree has too, and the leaves (hashes, and places) of the others."""
        same, same_paragraphs = same.copy(), same_paragraphs.copy()
        shared, rest, places = 0, Counter(), []
        for section, spans, h, hashes in zip(self.sections, self.spans, self.section_hashes, self.paragraph_hashes):
            if same[h] > 0:
                same[h] -= 1
                shared += sum(map(len, section))
                continue
            for leaves, where, g in zip(section, spans, hashes):
                if same_paragraphs[g] > 0:
                    same_paragraphs[g] -= 1
                    shared += len(leaves)
                else:
                    rest.update(leaves)
                    places += [(x, *w) for x, w in zip(leaves, where)]
        return shared, rest, places


def _branches(a: Tree, b: Tree) -> tuple[Counter[bytes], Counter[bytes]]:
    """Sections that both trees have, and paragraphs that both have elsewhere."""
    sections = Counter(a.section_hashes) & Counter(b.section_hashes)

    def others(t: Tree) -> Counter[bytes]:
        left, out = sections.copy(), Counter()
        for h, hashes in zip(t.section_hashes, t.paragraph_hashes):
            if left[h] > 0:
                left[h] -= 1
            else:
                out.update(hashes)
        return out

    return sections, others(a) & others(b)


def likeness(a: Tree, b: Tree) -> float:
    """Twice the leaves that both trees have over all their leaves; 1 for equal roots."""
    if a.root == b.root:
        return 1.0
    total = a.size() + b.size()
    if not total:
        return 1.0
    same = _branches(a, b)
    shared, mine, _ = a.open(*same)
    _, theirs, _ = b.open(*same)
    return 2.0 * (shared + (mine & theirs).total()) / total


def edits(a: Tree, b: Tree) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Spans of code points of each text that the other one lacks, from the leaves of the branches that differ."""
    if a.root == b.root:
        return [], []
    same = _branches(a, b)
    opened = a.open(*same), b.open(*same)
    both = opened[0][1] & opened[1][1]
    out = []
    for _, _, places in opened:
        left, spans = both.copy(), []
        for h, start, end in places:
            if left[h] > 0:
                left[h] -= 1
            elif spans and spans[-1][1] == start:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
        out.append(spans)
    return out[0], out[1]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``n_leaves`` of every text."""

    def make():
        def rows(b: pa.RecordBatch) -> dict:
            trees = [Tree(t) for t in strings(b, "text")]
            return {"doc_id": b.column("doc_id"), "fingerprint": [t.fingerprint() for t in trees], "n_leaves": [t.size() for t in trees]}

        return rows

    return map_batches(text_of(df, id_col, text_col), make, "doc_id long, fingerprint string, n_leaves int")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``: the text of the next document in ascending doc_id, of the first one after the last.

    The ids are dealt in ranges whose bounds are ids of the table; the document
    at a bound also goes, as a tail, to the range before.  So each range finds
    its next texts alone, and no task sees all rows.  There are as many ranges as
    the table's size asks for; rows of one id, or without one, share a range,
    which is sorted with spilling.
    """
    parts = parts or max(1, min(MOST_RANGES, input_bytes(df) // RANGE_BYTES))
    low = -(1 << 63)
    ids = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(low)).alias("k"))
    found = ids.agg(F.min("k").alias("first"), F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], F.lit(100 * parts)).alias("bounds")).first()
    first, bounds = found["first"], sorted(set(found["bounds"] or []) - {found["first"]})
    keyed = text_of(df, id_col, text_col).withColumn("k", F.coalesce("doc_id", F.lit(low)))
    place = _place(bounds)(F.col("k"))
    part = F.shiftright(place, 1)
    tail = F.when(F.col("k") == F.lit(first), F.lit(len(bounds))).when(place % 2 == 1, part - 1)
    copies = F.explode(F.filter(F.array(F.struct(part.alias("part"), F.lit(0).alias("tail")), F.struct(tail.alias("part"), F.lit(1).alias("tail"))), lambda x: x["part"].isNotNull()))
    rows = keyed.select("k", "doc_id", "text", copies.alias("c")).select("k", "doc_id", "text", "c.part", "c.tail")
    order = Window.partitionBy("part").orderBy("tail", "k", "text")
    return rows.withColumn("next_text", F.lead("text").over(order)).where(F.col("tail") == 0).select("doc_id", "text", "next_text")


def _place(bounds: list[int]):
    """For each key twice the number of bounds that are at most the key, plus 1 if it is a bound."""
    known = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        n = np.searchsorted(known, k.to_numpy(), side="right")
        hit = (n > 0) & (known[np.maximum(n - 1, 0)] == k.to_numpy()) if len(known) else np.zeros(len(k), bool)
        return pd.Series(2 * n + hit)

    return place


def compare_edited(pairs: DataFrame) -> DataFrame:
    """Of ``with_next``: the fingerprints of each text and of its edited text, how alike they and the next text's are, and the edits' spans.

    The edited text is the text with its last half replaced by as much of the next text.
    """

    def make():
        held: dict[str, Tree] = {}

        def tree(text: str) -> Tree:
            return held.get(text) or Tree(text)

        def rows(b: pa.RecordBatch) -> dict:
            names = ("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edit_spans")
            out: dict[str, list] = {x: [] for x in names}
            for doc, text, after in zip(b.column("doc_id").to_pylist(), strings(b, "text"), strings(b, "next_text")):
                half = len(text) // 2
                edited = text[: len(text) - half] + after[:half]
                mine, new, other = tree(text), Tree(edited), tree(after)
                held.clear()
                held[after] = other  # the next row's own text
                spans = [{"start": s, "end": e} for s, e in edits(mine, new)[1]]
                for name, value in zip(names, (doc, len(text), edited, mine.fingerprint(), new.fingerprint(), likeness(mine, new), likeness(mine, other), spans)):
                    out[name].append(value)
            return out

        return rows

    schema = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edit_spans array<struct<start: long, end: long>>"
    return map_batches(pairs, make, schema, rows=500)
