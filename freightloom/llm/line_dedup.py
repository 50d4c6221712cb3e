"""Near-duplicate lines by a segment-partition edit join.

Two lines link when their edit distance is at most the budget of the shorter one: ``EDITS``, less for lines of
under ``PER_EDIT`` characters an edit.  Lines of nearly one length are a class (see ``class_of``), in which a line of
budget k has k + 1 segments of the same sizes, of which one survives k edits unchanged: the first at its start, the last at its
end, the middle one of three moved by one place at most.  A line is indexed by the segments of its class; it looks up the same ones,
the middle one also a place further on, and those of the class of a line shorter by its edits if that is another.  Parities of
letter pairs (64 bits) must nearly agree before a pair counts as found, and a banded bit-parallel edit distance
decides.  Equal lines are one line with many places; links join lines to classes.

Line texts stay where they are read: hashes move, and the texts of found pairs alone.  A line is told by two
64-bit numbers together, a hash and its letter-pair parities.

Nulls, empty texts and ties: a NULL text has no lines; lines are compared without white space at their ends;
empty lines are always kept and belong to no class; of a class the line of the smallest ``doc_id`` (NULL last) and
first place stays; repeated rows are further places.  Other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept, map_rows, place
from freightloom.llm.components import components

EDITS, PER_EDIT = 2, 10
#: An edit changes at most four letter pairs.
PAIRS_PER_EDIT = 4
#: Found lines up to this number are sent to the tasks that hold the texts; more are joined by shuffle.
SMALL = 500_000
#: Bits of the filter of found lines, by which tasks leave out others first, whatever the number of lines.
BITS = 1 << 24
#: Characters numpy works on at a time, and the base of the sums that stand for substrings, with its inverse modulo 2 ** 64.
STEP, BASE = 1 << 18, 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def budget(size: int) -> int:
    return min(EDITS, size // PER_EDIT)


def class_of(size: np.ndarray) -> np.ndarray:
    """Least size of a line's class: 4 sizes, from 64 on an eighth of the size at most; sizes of smaller budgets are their own."""
    width = np.left_shift(4, np.maximum(0, np.floor(np.log2(np.maximum(size, 1) / 32)).astype(np.int64)))
    return np.where(size < EDITS * PER_EDIT, size, np.maximum(EDITS * PER_EDIT, size // width * width))


def lookups(size: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(lines, segment, class, start, end, indexed) of the substrings that lines of ``size`` are indexed by or look up.

    The middle segment is looked up at its own place and one further on, but not one before: of two lines of one length whose
    middles lie a place apart, each can be the one that looks up, and from one of them the other's middle lies further on.
    """
    own = class_of(size)
    lower = np.maximum(size - EDITS, 0)
    for home, some in ((own, size >= PER_EDIT), (class_of(lower), (class_of(lower) != own) & (lower >= PER_EDIT)),
                       (class_of(lower + 1), (class_of(lower + 1) != own) & (class_of(lower + 1) != class_of(lower)) & (lower + 1 >= PER_EDIT))):
        at = np.nonzero(some)[0]
        if not len(at):
            continue
        n, c = size[at], home[at]
        indexed, k = home is own, np.minimum(EDITS, c // PER_EDIT)
        part = c // (k + 1)
        yield at, 0, c, 0 * n, part, indexed
        yield at, 2, c, n - part, n, indexed
        three = k == 2
        at, c, part = at[three], c[three], part[three]
        yield at, 1, c, part, 2 * part, indexed
        yield at, 1, c, part + 1, 2 * part + 1, False


def distance(a: str, b: str, k: int) -> int:
    """Edit distance of two strings if at most ``k``, else k + 1: a band of 2 k + 1 bits down the diagonal."""
    if len(a) < len(b):
        a, b = b, a
    score = len(a) - len(b)
    if score > k:
        return k + 1
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i + k  # k empty rows below the first
    full, here = (1 << 2 * k + 1) - 1, 1 << score + k
    plus, minus = full & ~((1 << k + 1) - 1), 0  # column 0, rows -k to k
    for j, c in enumerate(b, 1):
        plus, minus = plus >> 1 | 1 << 2 * k, minus >> 1  # rows of this column; below the band the cost rises
        same = masks.get(c, 0) >> j - 1 & full
        zero = (((same & plus) + plus) ^ plus | same | minus) & full
        right, left = minus | full & ~(zero | plus), zero & plus
        if not zero & here:
            score += 1
            if score > k:
                return k + 1
        right, left = (right << 1 | 1) & full, left << 1 & full
        plus, minus = left | full & ~(zero | right), zero & right
    return score


def codes(lines: list[str]) -> np.ndarray:
    """Characters of the lines, a line end between two."""
    return np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def parities(lines: list[str], code: np.ndarray | None = None) -> np.ndarray:
    """Per line 64 parities of hashed letter pairs."""
    code = codes(lines) if code is None else code
    if len(code) < 2:
        return np.zeros(len(lines), np.int64)
    pair = (code[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(58)
    bit = np.append(np.uint64(1) << pair, np.uint64(0))
    gap = code == 10
    bit[gap] = 0
    bit[:-1][gap[1:]] = 0
    starts = np.r_[0, np.nonzero(gap)[0] + 1]
    inside = starts < len(bit)
    out = np.zeros(len(lines), np.uint64)
    out[inside] = np.bitwise_xor.reduceat(bit, starts[inside])
    return out.view(np.int64)


def in_steps(lines: list[str], size: int = 0) -> Iterator[list[str]]:
    """The lines, ``size`` or ``STEP`` characters at a time."""
    held, n = [], 0
    for x in lines:
        held.append(x)
        n += len(x) + 1
        if n >= (size or STEP):
            yield held
            held, n = [], 0
    if held:
        yield held


def segment_keys(lines: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all substrings by which lines are indexed or look up, the line of each, and whether it only looks up.

    A substring's key is the sum of its mixed characters times powers of ``BASE`` from its start on, with class and segment.
    """
    mixed = (code + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)

    def powers(base: int) -> np.ndarray:
        out = np.full(len(code) + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    up, down = powers(BASE), powers(INVERSE)
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(mixed * up[:-1], out=total[1:])
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    first = np.cumsum(size + 1) - size - 1
    keys, owners, asks = [], [], []
    for at, part, kind, start, end, indexed in lookups(size):
        s, e = first[at] + start, first[at] + end
        key = (total[e] - total[s]) * down[s] ^ (kind << 3 | part).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key = (key ^ key >> np.uint64(32)) * np.uint64(0x9FB21C651E98DF25)
        keys.append(key ^ key >> np.uint64(28))
        owners.append(at)
        asks.append(np.full(len(at), not indexed))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(keys).view(np.int64), np.concatenate(owners), np.concatenate(asks)


def lines_of(text: str | None) -> list[str]:
    return [] if text is None else [x.strip() for x in text.split("\n")]


def _hashes(lines: list[str]) -> np.ndarray:
    import xxhash
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x.encode("utf-8", "surrogatepass"), 42) for x in lines), np.uint64, len(lines)).view(np.int64)


def places(docs: DataFrame) -> DataFrame:
    """row, doc_id, pos, id, pairs: every line that is not empty, and pos -1 for the document itself."""
    def made(row: list, doc_id: list, pos: list, counts: list, texts: list[str]) -> dict:
        ids, pairs = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        line = np.array(pos) >= 0
        ids[~line], ids[line], pairs[line] = counts, _hashes(texts), parities(texts) if texts else 0
        return {"row": row, "doc_id": doc_id, "pos": pos, "id": ids, "pairs": pairs}

    def rows(batches):
        for b in batches:
            held, n = ([], [], [], [], []), 0
            for row, doc_id, text in zip(b["row"], b["doc_id"], b["text"]):
                lines = lines_of(text)
                full = [i for i, x in enumerate(lines) if x]
                held[0].extend([row] * (len(full) + 1))
                held[1].extend([doc_id] * (len(full) + 1))
                held[2].extend([-1, *full])
                held[3].append(len(lines))
                held[4].extend(lines[i] for i in full)
                n += len(text or "")
                if n >= STEP:
                    yield made(*held)
                    held, n = ([], [], [], [], []), 0
            if held[0]:
                yield made(*held)

    rows_in = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return map_rows(rows_in, rows, "row long, doc_id long, pos long, id long, pairs long")


def _different(texts: list[str | None]) -> list[str]:
    """Lines long enough to have links, each once."""
    return [x for x in dict.fromkeys(y for t in texts for y in lines_of(t)) if len(x) >= PER_EDIT]


def _keys(docs: DataFrame) -> DataFrame:
    """key, id, pairs of the segments by which lines are indexed and (``asks``) of those they only look up."""
    def rows(batches):
        for b in batches:
            for lines in in_steps(_different(b["text"])):
                code = codes(lines)
                key, at, asks = segment_keys(lines, code)
                yield {"key": key, "id": _hashes(lines)[at], "pairs": parities(lines, code)[at], "asks": asks}

    found = map_rows(docs.select("text"), rows, "key long, id long, pairs long, asks boolean")
    # by key, so that dropping repeats and the join need no other shuffle
    return found.repartition("key").dropDuplicates(["key", "id", "pairs", "asks"])


def found_pairs(docs: DataFrame) -> DataFrame:
    """Pairs of lines (id, pairs, id2, pairs2) that share a segment and nearly all letter pairs."""
    homes = _keys(docs)
    asks = homes.select(*[F.col(c).alias(f"{c}2") for c in homes.columns])
    near = F.bit_count(F.col("pairs").bitwiseXOR(F.col("pairs2"))) <= PAIRS_PER_EDIT * EDITS
    less = (F.col("id") < F.col("id2")) | (F.col("id") == F.col("id2")) & (F.col("pairs") < F.col("pairs2"))
    other = (F.col("id") != F.col("id2")) | (F.col("pairs") != F.col("pairs2"))
    # of two lines that are both indexed by a segment one looks up; as one condition on both sides, so that the keys are dealt once for both
    here = F.when(F.col("asks2"), other & ~F.col("asks")).otherwise(less & ~F.col("asks"))
    return homes.join(asks.hint("merge"), (F.col("key") == F.col("key2")) & near & here).select(
        "id", "pairs", "id2", "pairs2").distinct()


def _name(a: str, b: str):
    return F.concat_ws(":", a, b)


def line_links(docs: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) between different lines, named ``id:pairs``, a > b."""
    found = found_pairs(docs)
    pairs = kept(found.select(F.greatest(_name("id", "pairs"), _name("id2", "pairs2")).alias("a"),
                              F.least(_name("id", "pairs"), _name("id2", "pairs2")).alias("b"),
                              ).distinct(), folder, "found")
    names = kept(pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct(), folder, "found_lines")

    # bits of a filter in words of 64, so what comes to the driver is bounded whatever the number of lines
    bit = F.substring_index("name", ":", 1).cast("long").bitwiseAND(F.lit(BITS - 1))
    words = np.zeros(BITS // 64, np.int64)
    for r in names.groupBy(F.shiftright(bit, 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("set")).toLocalIterator():
        words[r["word"]] = r["set"]
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def texts(batches):
        words = sent.value
        for b in batches:
            for lines in in_steps(_different(b["text"])):
                ids = _hashes(lines)
                at = np.nonzero(words[(ids & (BITS - 1)) >> 6] >> (ids & 63) & 1)[0]
                if len(at):
                    some = [lines[i] for i in at]
                    yield {"name": [f"{h}:{p}" for h, p in zip(ids[at].tolist(), parities(some).tolist())], "line": some}

    held = map_rows(docs.select("text"), texts, "name string, line string")
    few = names.count() <= SMALL
    held = held.join(F.broadcast(names) if few else names, "name", "left_semi").dropDuplicates(["name", "line"])

    def verified(batches):
        for b in batches:
            good = [(x, y) for x, y, s, t in zip(b["a"], b["b"], b["s"], b["t"])
                    if distance(s, t, k := budget(min(len(s), len(t)))) <= k]
            yield {"a": [g[0] for g in good], "b": [g[1] for g in good]}

    held = kept(held, folder, "found_texts")
    full = (pairs.join(held.select(F.col("name").alias("a"), F.col("line").alias("s")), "a")
            .join(held.select(F.col("name").alias("b"), F.col("line").alias("t")), "b"))
    return kept(map_rows(full, verified, "a string, b string").distinct(), folder, "line_links")


def line_dedup(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_lines, n_kept, n_links and ``dropped`` (places of dropped lines, comma-joined) per document.

    ``n_links`` counts the links of the document's different lines to other lines of the table.
    """
    placed = kept(places(docs), folder, "places")
    links = line_links(docs, folder)
    stars = components(links, folder)
    degree = links.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(
        F.count(F.lit(1)).alias("links"))
    roles = degree.join(stars, degree.name == stars.u, "left").select(
        "name", "links", F.coalesce("root", "name").alias("root"))
    named = placed.where("pos >= 0").withColumn("name", _name("id", "pairs"))
    classed = named.join(roles, "name", "left").withColumn("root", F.coalesce("root", "name"))
    classed = classed.withColumn("at", place())
    # per class and row the first place, then per class the first row: both minima are fixed-width
    by_row = classed.groupBy("root", "at").agg(F.min("pos").alias("first_pos"))
    by_class = by_row.groupBy("root").agg(F.min("at").alias("first_at"))
    heads = by_row.join(by_class, "root").where("at = first_at").select("root", "first_at", "first_pos")
    flagged = classed.join(heads, "root").withColumn(
        "stays", (F.col("at") == F.col("first_at")) & (F.col("pos") == F.col("first_pos")))
    gone = F.when(~F.col("stays"), F.col("pos"))
    # first per line of a document, whose links count once, then per document
    per_line = flagged.groupBy("row", "name").agg(
        F.max(F.coalesce("links", F.lit(0))).alias("links"), F.collect_list(gone).alias("gone"))
    per_doc = per_line.groupBy("row").agg(
        F.sum("links").alias("n_links"), F.flatten(F.collect_list("gone")).alias("gone")).select(
        "row", "n_links", F.size("gone").alias("n_dropped"), F.array_join(F.array_sort("gone"), ",").alias("dropped"))
    return placed.where("pos < 0").join(per_doc, "row", "left").select(
        "doc_id", F.col("id").alias("n_lines"), (F.col("id") - F.coalesce("n_dropped", F.lit(0))).alias("n_kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("dropped", F.lit("")).alias("dropped"))
