"""Phrase collocations by multikey quicksort of suffix pointers.

Texts are lower-cased (A to Z), cut into pieces at stops and line ends, and each word of a piece starts a suffix of up to
four words.  Per language, a phrase occurs as often as suffixes start with it.

Words are counted first.  A filter of ``BITS`` bits, whatever the vocabulary, tells the words that are frequent enough (and
a few more that share a bit): a suffix ends before any other word, as no candidate holds one.  A task equalises its suffixes:
equal ones become one with a count.  Then suffixes are routed by a hash of language and their two leading words, packed by
target.  A target's suffixes are sorted by multikey three-way quicksort to maximum depth: the pointers whose word
at the present depth equals the pivot form the equal partition, whose summed counts are the number of times the phrase
occurs, and which goes on one word deeper.  A partition (less, equal or greater) that sums to less than ``LEAST`` holds
no candidate and is abandoned.  Partitions of all depths are split in one numpy pass a round.

A task that meets more than ``MOST`` suffixes hands them on, dealt again by another hash of their two leading words, and, if that is
not enough because one pair of words leads so many, by a hash of the whole suffix.  In the last case shorter phrases are
spread over several tasks, so those are not abandoned there and their counts are summed afterwards.

Nulls, empty texts, ties: a NULL text is an empty one; a NULL ``lang`` is ``und``; a text without words adds nothing; repeated
rows count again; equal scores go by the number of occurrences, then by the phrase's bytes; a piece of any length is
split in steps that carry over the last words.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freightloom.llm.common import kept

WORDS, LEAST, TOP, UNKNOWN = 4, 30, 2000, "und"
#: Score of a phrase that never occurs in parts, and the percentage at which a longer phrase stands for a shorter.
SCALE, COVERS = 2_000_000, 80
#: Words a task equalises at a time, bytes of a text it splits at a time; wanted and greatest number of suffixes of a
#: task; targets, and targets that those of a full task are dealt to.
AT_ONCE, STEP, WANTED, MOST, TARGETS, PARTS = 1_200_000, 1 << 20, 1_500_000, 4_000_000, 1 << 15, 64
#: Bits of the filter of frequent words, bits of one of its rows, and different words a task counts at a time.
BITS, ROW_BITS, COUNTED = 1 << 24, 1 << 15, 400_000
#: A to Z in lower case, tabs as spaces, stops and line ends as a byte that UTF-8 does not use.
END = b"\xff"
MAPPED = bytes(b + 32 if 65 <= b <= 90 else END[0] if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))

ROUTED = "target long, n long, body binary"
COUNTS = "target long, body binary, lang string, phrase string, size int, n long"
SHIPPED = pa.schema([("target", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])


def multikey(keys: np.ndarray, times: np.ndarray, least: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, a pointer of each, summed ``times``) of equal partitions that sum to ``least[depth]`` or more.

    ``keys[d][p]`` is the key of pointer p at depth d, 0 where its suffix has ended.  The partitions of a round are
    split together, each at the key of its middle pointer.
    """
    table, depths = np.ascontiguousarray(keys, np.int32), len(keys)
    flat, width = table.ravel(), table.shape[1]
    enough = np.array([min(least[d:]) for d in range(depths)])
    pointers = np.arange(width, dtype=np.int32)
    starts, depth = np.zeros(min(1, width), np.int64), np.zeros(min(1, width), np.int64)
    while len(starts):
        sizes = np.diff(np.append(starts, len(pointers)))
        key = flat[np.repeat(depth * width, sizes) + pointers]
        pivot = key[starts + sizes // 2]
        at = np.repeat(pivot, sizes)
        less, same = key < at, key == at
        # inclusive ranks among the less and the equal pointers of their partition
        ranks, counts = [], []
        for side in (less, same):
            rank = np.cumsum(side, dtype=np.int32)
            ends = rank[starts + sizes - 1]
            begun = np.append(np.int32(0), ends[:-1])
            counts.append(ends - begun)
            ranks.append(rank - np.repeat(begun, sizes))
        first = [starts, starts + counts[0], starts + counts[0] + counts[1]]
        place = np.arange(len(pointers)) - ranks[0] - ranks[1] + np.repeat(counts[0] + counts[1], sizes)
        place[less] = (np.repeat(first[0], sizes) + ranks[0] - 1)[less]
        place[same] = (np.repeat(first[1], sizes) + ranks[1] - 1)[same]
        ordered = np.empty_like(pointers)
        ordered[place] = pointers
        count = np.stack([*counts, sizes - counts[0] - counts[1]], axis=1).ravel()  # less, equal, greater
        first = np.stack(first, axis=1).ravel()
        full = np.flatnonzero(count)
        total = np.add.reduceat(times[ordered], first[full])
        equal, level = full % 3 == 1, depth[full // 3]
        for d in np.unique(level[equal]):
            good = np.flatnonzero(equal & (level == d) & (total >= least[d]))
            heads = ordered[first[full[good]]]
            alive = table[d, heads] > 0
            if alive.any():
                yield int(d), heads[alive], total[good][alive]
        ended = equal & (pivot[full // 3] == 0)
        level = level + equal
        go = ~ended & (level < depths) & (total >= enough[np.minimum(level, depths - 1)])
        sizes = count[full]
        pointers = ordered[np.repeat(go, sizes)]
        sizes, depth = sizes[go], level[go]
        starts = np.cumsum(sizes) - sizes


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """One hash of several arrays of hashes."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([0, *map(xxhash.xxh64_intdigest, words)], np.uint64)  # 0: no word


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in the least width that holds them, led by that width."""
    width = next(w for w in (1, 2, 4, 8) if int(x.max()) < 1 << 8 * w - (w == 8))
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


def pack(names: list[bytes], langs: list[str], suffixes: np.ndarray, times: np.ndarray) -> bytes:
    """Suffixes (language and words by number, from 0 and 1) and their counts, with the words they use."""
    import zstandard

    used, code = np.unique(suffixes[1:], return_inverse=True)
    text = b" ".join(names[u - 1] for u in used.tolist() if u)
    low = 0 if len(used) and used[0] == 0 else 1
    spoken, lang = np.unique(suffixes[0], return_inverse=True)
    parts = ["\n".join(langs[x].encode("utf-8").hex() for x in spoken).encode(), text,
             *(_narrow(x) for x in (lang, code.reshape(WORDS, -1) + low, times))]
    sizes = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))


def unpack(body: bytes) -> tuple[list[bytes], list[str], np.ndarray, np.ndarray]:
    """What ``pack`` was given, renumbered."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(body)
    at, parts = 40, []
    for size in np.frombuffer(data, "<i8", 5).tolist():
        parts.append(data[at:at + size])
        at += size
    lang, code, times = map(_wide, parts[2:])
    suffixes = np.vstack([lang, code.reshape(WORDS, -1)]).astype(np.int32)
    langs = [bytes.fromhex(x).decode("utf-8") for x in parts[0].decode().split("\n")]
    return parts[1].split(b" ") if parts[1] else [], langs, suffixes, times


class _Numbers(dict):
    """Numbers from 0 up in order of first use."""

    def __missing__(self, key):
        value = self[key] = len(self)
        return value


class _Frequent(dict):
    """Numbers from 1 up of the words whose bit is set, 0 for all others; ``names`` has the numbered words."""

    def __init__(self, bits: bytes):
        import xxhash

        super().__init__()
        self.bits, self.names, self.digest = bits, [], xxhash.xxh64_intdigest

    def __missing__(self, key):
        at = self.digest(key, 42) % (8 * len(self.bits))
        if self.bits[at >> 3] >> (at & 7) & 1 and key != END:
            self.names.append(key)
            value = len(self.names)
        else:
            value = 0
        self[key] = value
        return value


def equalised(codes: np.ndarray, starts: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes (language, then words; 0 past a piece's end) from pointers into ``codes``, and their counts."""
    padded = np.append(codes, np.zeros(WORDS, codes.dtype))
    rows = [langs, padded[starts]]
    for i in range(1, WORDS):
        rows.append(np.where(rows[-1] > 0, padded[starts + i], 0).astype(np.int32))
    pairs = [a.astype(np.int64) << 32 | b for a, b in ((rows[1], rows[2]), (rows[3], rows[4]))]
    order = np.lexsort([pairs[1], pairs[0], langs])
    del pairs
    table = np.stack([r[order] for r in rows])
    new = np.append(True, (table[:, 1:] != table[:, :-1]).any(axis=0)) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return table[:, at], np.diff(np.append(at, len(order)))


def _dealt(suffixes: np.ndarray, times: np.ndarray, names: list[bytes], langs: list[str], target: np.ndarray) -> Iterator[dict]:
    """One row per target: its suffixes and their number."""
    order = np.argsort(target, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(target[order]) != 0))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        yield {"target": int(target[order[a]]), "n": int(b - a),
               "body": pack(names, langs, suffixes[:, order[a:b]], times[order[a:b]])}


def split_words(text: bytes, step: int = STEP) -> Iterator[list[bytes]]:
    """Words of a text, END between its pieces, in lists from about ``step`` bytes each."""
    data, left = text.translate(MAPPED), b""
    for at in range(0, len(data), step):
        part = left + data[at:at + step]
        words = part.replace(END, b" \xff ").split()
        more = at + step < len(data)
        left = words.pop() if more and words and part[-1:] not in (b" ", END) else b""
        yield words


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _texts(batches) -> Iterator[tuple[str, bytes]]:
    """(lang, text), few texts at a time in memory."""
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            some = batch.slice(low, 64)
            yield from zip(some.column("lang").to_pylist(), some.column("text").to_pylist())


def word_counts(docs: DataFrame, step: int = STEP, most: int = COUNTED) -> DataFrame:
    """lang, phrase and n of each word of a language; the row without a phrase has the sum of all."""
    def given(counts: dict[str, Counter]) -> Iterator:
        for lang, found in counts.items():
            found.pop(END, None)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(found) + 1), pa.string()),
                "phrase": pa.array([None, *(w.decode("utf-8", "replace") for w in found)], pa.string()),
                "n": pa.array([sum(found.values()), *found.values()], pa.int64())})

    def run(batches):
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, text in _texts(batches):
            for words in split_words(text, step):
                counts[lang].update(words)
            if sum(map(len, counts.values())) > most:
                yield from given(counts)
                counts.clear()
        yield from given(counts)

    return _read(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(
        F.sum("n").alias("n"))


def word_filter(words: DataFrame, bits: int = BITS) -> bytes:
    """Bits of the hashes of all words of ``words``."""
    at = F.pmod(F.xxhash64("phrase"), F.lit(bits)) + 1  # these functions count from 1; the sign of the hash does not matter
    rows = words.groupBy(F.bitmap_bucket_number(at).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()  # at most bits / ROW_BITS rows
    out = bytearray(bits // 8)
    for r in rows:
        low = (r["row"] - 1) * ROW_BITS // 8
        out[low:low + ROW_BITS // 8] = r["bits"]
    return bytes(out[:bits // 8])


def routed(docs: DataFrame, targets: int, bits: bytes, at_once: int = AT_ONCE, step: int = STEP) -> DataFrame:
    """Packed suffixes by target (from 0)."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def flush(names: list[bytes], tongues: list[str], code: np.ndarray, lang: np.ndarray, stop: int) -> Iterator:
        """What the pointers before ``stop`` give."""
        at = np.flatnonzero(code[:stop])
        if not len(at):
            return
        suffixes, times = equalised(code, at, lang[at])
        word, tongue = _hashes(names), _hashes([x.encode() for x in tongues])[1:]
        target = _mixed(tongue[suffixes[0]], word[suffixes[1]], word[suffixes[2]]) % np.uint64(targets)
        for row in _dealt(suffixes, times, names, tongues, target.astype(np.int64)):
            yield pa.RecordBatch.from_pylist([row], schema=SHIPPED)

    def run(batches):
        numbers, spoken, codes, langs, held = _Frequent(sent.value), _Numbers(), [], [], 0

        def gathered():
            return np.concatenate(codes), np.repeat(np.array([x for x, _ in langs], np.int32), [n for _, n in langs])

        for lang, text in _texts(batches):
            for words in split_words(text, step):
                codes.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                langs.append((spoken[lang], len(words)))
                held += len(words)
                if held >= at_once:
                    # the last words may go on in the next list: they stay, and count then
                    code, tongue = gathered()
                    stop, tongues = max(0, len(code) - WORDS + 1), list(spoken)
                    yield from flush(numbers.names, tongues, code, tongue, stop)
                    stay = [numbers.names[x - 1] if x else END for x in code[stop:].tolist()]
                    numbers, spoken = _Frequent(sent.value), _Numbers()
                    codes = [np.array([numbers[w] for w in stay], np.int32)]
                    langs = [(spoken[tongues[x]], 1) for x in tongue[stop:].tolist()]
                    held = len(stay)
            codes.append(np.zeros(1, np.int32))
            langs.append((spoken[lang], 1))
            held += 1
        if held:
            code, tongue = gathered()
            yield from flush(numbers.names, list(spoken), code, tongue, len(code))

    return _read(docs).mapInArrow(run, ROUTED)


def _dealt_again(target: int, body: bytes, words: int, parts: int) -> Iterator[dict]:
    """Packed suffixes by ``parts`` new targets, from a hash of language and ``words`` leading words."""
    names, langs, suffixes, times = unpack(body)
    word, tongue = _hashes(names), _hashes([x.encode() for x in langs])[1:]
    mixed = _mixed(np.full(len(times), 1, np.uint64), tongue[suffixes[0]], *(word[suffixes[1 + i]] for i in range(words)))
    yield from _dealt(suffixes, times, names, langs, target * parts + (mixed % np.uint64(parts)).astype(np.int64))


def counted(packed: DataFrame, least: int, most: int, again: int | None, parts: int = PARTS) -> DataFrame:
    """Rows with lang, phrase, size and n of the phrases of two words or more in each partition of packed suffixes.

    A partition of more than ``most`` gives rows with target, n and body instead: its suffixes, dealt by a hash of ``again``
    words.  Without ``again`` the partitions hold parts of the shorter phrases, whose counts are given however small.
    """
    never = np.iinfo(np.int64).max
    limits = [never, never, least, least, least] if again else [never, never, 1, 1, least]
    schema = pa.schema([("target", pa.int64()), ("body", pa.binary()), ("lang", pa.string()), ("phrase", pa.string()),
                        ("size", pa.int32()), ("n", pa.int64())])

    def phrases(bodies: list[bytes]) -> Iterator:
        names, langs, tables, times = _Numbers(), _Numbers(), [], []
        for body in bodies:
            words, tongues, suffixes, n = unpack(body)
            number = np.array([0, *(names[x] + 1 for x in words)], np.int32)
            spoken = np.array([langs[x] + 1 for x in tongues], np.int32)
            tables.append(np.vstack([spoken[suffixes[0]], number[suffixes[1:]]]))
            times.append(n)
        if not tables:
            return
        table, words, tongues = np.concatenate(tables, axis=1), list(names), list(langs)
        del tables, names
        for depth, heads, total in multikey(table, np.concatenate(times), limits):
            for low in range(0, len(heads), 50_000):
                chosen = table[:, heads[low:low + 50_000]]
                size = chosen.shape[1]
                yield pa.RecordBatch.from_pydict({
                    "target": pa.nulls(size, pa.int64()), "body": pa.nulls(size, pa.binary()),
                    "lang": [tongues[x - 1] for x in chosen[0].tolist()],
                    "phrase": [b" ".join(words[i - 1] for i in p).decode("utf-8", "replace")
                               for p in chosen[1:depth + 1].T.tolist()],
                    "size": np.full(size, depth, np.int32), "n": total[low:low + 50_000]}, schema=schema)

    def run(batches):
        held, size = [], 0  # packed, so that they are small
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                size += row["n"]
                while again and size > most and held:
                    row = held.pop()
                    for new in _dealt_again(row["target"], row["body"], again, parts):
                        yield pa.RecordBatch.from_pylist([new], schema=schema)
        if not again or size <= most:
            yield from phrases([row["body"] for row in held])

    return packed.mapInArrow(run, COUNTS)


def frequent(docs: DataFrame, folder: str, least: int = LEAST, wanted: int = WANTED, most: int = MOST,
             targets: int = TARGETS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of one to four words that occur ``least`` times, and (lang, total) words."""
    least_targets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a word takes six characters or more with its space in most texts; too many targets are harmless
    size = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    count = min(targets, max(least_targets, size // 6 // wanted))
    words = kept(word_counts(docs).where((F.col("n") >= least) | F.col("phrase").isNull()), folder, "words")
    totals, words = words.where("phrase IS NULL").select("lang", F.col("n").alias("total")), words.where("phrase IS NOT NULL")
    packed = routed(docs, count, word_filter(words)).repartitionById(count, F.col("target").cast("int"))
    all_counts = words.select("lang", "phrase", F.lit(1).alias("size"), "n")
    for turn, again in enumerate((2, WORDS, None)):
        rows = kept(counted(packed, least, most, again), folder, f"counts_{turn}")
        all_counts = all_counts.unionByName(rows.where("body IS NULL").select("lang", "phrase", "size", "n"))
        left = rows.where("body IS NOT NULL").select("target", "n", "body")
        number = left.agg(F.sum("n")).first()[0]
        if not number:
            break
        packed = left.repartition(max(least_targets, number // wanted), "target")
    summed = all_counts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return kept(summed, folder, "frequent"), totals


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: each phrase of two words or more at its lowest-scoring cut."""
    split = F.split("phrase", " ")
    cuts = phrases.where("size > 1").select(
        "lang", "phrase", F.col("n").alias("a"), split.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("first"),
                       F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.lit(WORDS))).alias("rest"))
    left = phrases.select(F.col("lang").alias("lang1"), F.col("phrase").alias("first1"), F.col("n").alias("l"))
    right = phrases.select(F.col("lang").alias("lang2"), F.col("phrase").alias("rest2"), F.col("n").alias("r"))
    met = cuts.join(left, (F.col("lang") == F.col("lang1")) & (F.col("first") == F.col("first1"))).join(
        right, (F.col("lang") == F.col("lang2")) & (F.col("rest") == F.col("rest2")))
    score = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {SCALE} div (CAST(l AS DECIMAL(20, 0)) + r)")
    return met.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy(
        "lang", "phrase", "a").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame) -> DataFrame:
    """lang, phrase, most: how often the most frequent longer phrase around a phrase occurs."""
    words = F.split("phrase", " ")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.concat_ws(" ", F.slice(words, i, n)))))
    return phrases.where("size > 2").select("lang", F.explode(inside).alias("phrase"), "n").groupBy("lang", "phrase").agg(
        F.max("n").alias("most"))


def collocations(docs: DataFrame, folder: str, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of each language."""
    phrases, totals = frequent(docs, folder, least, **sizes)
    longer = covered(phrases).withColumnsRenamed({"lang": "lang3", "phrase": "phrase3"})
    rated = scored(phrases)
    left = rated.join(longer, (F.col("lang") == F.col("lang3")) & (F.col("phrase") == F.col("phrase3")), "left").where(
        F.coalesce(F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * COVERS, F.lit(True)))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of slices first: no task sees all phrases of a language
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    some = part.withColumn("place", F.row_number().over(W.partitionBy("lang", "part").orderBy(*best))).where(
        F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("lang", "lang4"), F.col("lang") == F.col("lang4")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
