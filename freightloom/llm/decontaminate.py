"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ from a passage by a budget of ``int(RATE * n)`` edits.  It is split into
budget + 1 pieces; a passage within the budget holds one of them unchanged, near its own place.  One automaton
finds all exact pieces in a text; around each hit, Myers' bit-parallel search gives the smallest edit distance
between the item and any part of the text.  Both sides are compared in lower case with runs of white space as
one space.

The items are the stated query set: they go to the tasks in blocks of bounded size, one pass over the documents
for each block, so a large benchmark means more passes and not more memory.  With several blocks each pass is written and
its block given up before the next one is sent.

Nulls, empty texts and ties: a NULL or blank text or item matches nothing; rows with one ``item_id`` are one
item with several texts and the nearest counts; repeated documents each get their rows; NULL ids stay NULL.
Other columns are ignored in results and kept by ``clean``.  Empty tables match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept, map_rows, numbered, workspace

#: Edits allowed per character of an item, and characters of items in a block.
RATE, BLOCK_CHARS = 0.08, 16 << 20


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, count: int) -> Iterator[tuple[int, str]]:
    """(offset, piece) of ``count`` nearly equal parts."""
    edges = [len(item) * i // count for i in range(count + 1)]
    return ((a, item[a:b]) for a, b in zip(edges, edges[1:]))


def search(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any part of ``text`` and the end of the first such part (Myers)."""
    m, full = len(item), (1 << len(item)) - 1
    if masks is None:
        masks = letter_masks(item)
    top, plus, minus, score, best, end = 1 << (m - 1), full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (full & ~(xh | plus)), plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, at
        ph, mh = ph << 1 & full, mh << 1 & full
        plus, minus = mh | (full & ~(xv | ph)), ph & xv
    return best, end


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Items:
    """A block of items ready for search."""

    def __init__(self, rows: list[tuple[int | None, str]], rate: float):
        import ahocorasick

        self.rows = [(i, t, int(rate * len(t)), letter_masks(t)) for i, t in rows if t]
        self.automaton = ahocorasick.Automaton()
        for at, (_, text, k, _) in enumerate(self.rows):
            for offset, piece in pieces(text, k + 1):
                self.automaton.add_word(piece, [*self.automaton.get(piece, []), (at, offset + len(piece))])
        if self.rows:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the parts of the text, merged where they overlap, in which it can lie."""
        found: dict[int, list[list[int]]] = {}
        for last, value in self.automaton.iter(text):
            for at, end in value:  # end of the piece in its item
                _, item, k, _ = self.rows[at]
                start = last + 1 - end - k
                spans = found.setdefault(at, [])
                low, high = max(0, start), start + len(item) + 2 * k
                if spans and low <= spans[-1][1]:
                    spans[-1][0], spans[-1][1] = min(low, spans[-1][0]), max(high, spans[-1][1])
                else:
                    spans.append([low, high])
        return found

    def hits(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end in the compared text) of the items within their budgets."""
        if not self.rows:
            return []
        body, best = plain(text), {}
        for at, spans in self.windows(body).items():
            item_id, item, k, masks = self.rows[at]
            for low, high in spans:
                distance, end = search(item, body[low:high], masks)
                if distance <= k and (distance, low + end) < best.get(item_id, (k + 1, 0)):
                    best[item_id] = (distance, low + end)
        return [(i, *d) for i, d in best.items()]


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Blocks of (item_id, compared text), each of about ``BLOCK_CHARS`` characters or one longer text.

    Texts are dealt by themselves and not by their id, so an id with very many texts spreads over all blocks.
    """
    texts = items.select("item_id", "text").where(F.col("text").isNotNull())
    total = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_CHARS)
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        yield sorted({(r["item_id"], plain(r["text"])) for r in rows}, key=repr)


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance and budgeted end of the match, one row for each document and item that match."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, distance int, match_end long"
    source, folder, passes, row = docs.select(F.col("doc_id").cast("long"), "text"), None, [], None
    ahead = item_blocks(items)
    block = next(ahead, None)
    while block is not None:
        following = next(ahead, None)
        if following is not None and folder is None:
            # the matches of several passes come together by the number of the document's row
            folder = workspace(spark)
            source, row = numbered(source, folder)
        sent = spark.sparkContext.broadcast(block)
        names = [f.split()[0] for f in schema.split(", ")]

        def rows(batches, sent=sent, row=row, names=names):
            mine = Items(sent.value, rate)
            for b in batches:
                lead = zip(b[row], b["doc_id"]) if row else ((d,) for d in b["doc_id"])
                got = [(*d, *h) for d, t in zip(lead, b["text"]) for h in mine.hits(t)]
                listed = [row, *names] if row else names
                yield dict(zip(listed, zip(*got))) if got else {n: [] for n in listed}

        found = map_rows(source, rows, f"{row} long, {schema}" if row else schema)
        if row is None:
            return found
        passes.append(kept(found, folder, f"pass{len(passes)}"))
        sent.unpersist()
        block = following
    if not passes:
        return spark.createDataFrame([], schema)
    every = reduce(DataFrame.unionByName, passes)
    nearest = every.groupBy(row, "doc_id", "item_id").agg(F.min(F.struct("distance", "match_end")).alias("_near"))
    return nearest.select("doc_id", "item_id", "_near.distance", "_near.match_end")


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that match no item, with all their columns."""
    spark, folder, done = docs.sparkSession, None, 0
    ahead = item_blocks(items)
    block = next(ahead, None)
    while block is not None:
        following = next(ahead, None)
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            mine = Items(sent.value, rate)
            for b in batches:
                texts = b.column(b.schema.get_field_index("text")).to_pylist()
                yield b.filter(pa.array(np.array([not mine.hits(t) for t in texts], bool)))

        docs = docs.mapInArrow(run, docs.schema)
        if following is not None:
            folder = folder or workspace(spark)
            docs, done = kept(docs, folder, f"pass{done}"), done + 1
            sent.unpersist()
        block = following
    return docs
