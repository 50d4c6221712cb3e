"""Language identification by bit-sliced Bloom filters of character n-grams.

Every slot of the filter holds one bit per language.  The slots of an n-gram, ANDed, are the mask of all
languages that contain it.  A text is the sum of the masks of its n-grams: a count per language, corrected for
the false positives that the filling of the language's bits predicts.  The largest corrected share decides, ties
go to the language that sorts first.

An n-gram belongs to a language if at least ``SHARE`` of the sampled documents of the language hold it, so a
foreign passage or a wrong label does not fill the filter; two documents are needed where a language has them.
Documents without a letter do not count here.  The filter learns from at most about ``SAMPLE``
documents per language (a documented bound, by a hash of the id); every whole text is predicted.

Nulls, empty texts and ties: a NULL text, or one without a letter, is ``und`` with score 0; documents without a
language teach nothing; repeated rows each count; without any learned language everything is ``und``.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import held_out, map_rows

#: Documents learned from per language, least share of them that hold an n-gram, sizes, slots and hashes.
SAMPLE, SHARE, GRAMS, SLOTS, HASHES = 2000, 0.01, (1, 2, 3, 4), 1 << 18, 2
UNKNOWN = "und"
STEP = 1 << 18
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of a text's lower-cased words, in arrays of bounded size; none without letters."""
    body = text.lower()
    for at in range(0, len(body), STEP):
        code = np.frombuffer((" " + body[max(0, at - 1):at + STEP] + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        word = letters()[code]
        if not word.any():
            continue
        code = np.where(word, code, 32).astype(np.uint64)
        h = np.zeros(len(code), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            h = h[:len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1:] + np.uint64(n)
            if n in GRAMS:
                inside = word[:len(h)] | word[n - 1:]  # white space at one end at most
                x = h[inside] * np.uint64(0x9E3779B97F4A7C15)
                yield x ^ (x >> np.uint64(29))


def slots(h: np.ndarray) -> np.ndarray:
    return np.stack([(h >> np.uint64(18 * i)) % np.uint64(SLOTS) for i in range(HASHES)])


@dataclass
class Filters:
    """Slots with one bit per language (little-endian bit order) and the false-positive rate of each."""

    languages: list[str]
    table: np.ndarray
    false: np.ndarray

    @classmethod
    def of(cls, languages: list[str], bits: list[tuple[int, int]]) -> "Filters":
        """From (slot, language number) pairs."""
        table = np.zeros((SLOTS, -(-max(1, len(languages)) // 8)), np.uint8)
        for slot, k in bits:
            table[slot, k // 8] |= 1 << k % 8
        full = np.unpackbits(table, axis=1, bitorder="little")[:, :len(languages)].mean(axis=0)
        return cls(languages, table, full ** HASHES)

    def predict(self, text: str | None) -> tuple[str, float]:
        seen, held = 0, np.zeros(len(self.languages))
        for h in grams(text or ""):
            at = slots(h)
            mask = np.bitwise_and.reduce(self.table[at], axis=0)
            if self.table.shape[1] == 1:  # popcounts by language of the one byte
                by_mask = np.bincount(mask[:, 0], minlength=256)
                held += by_mask @ _BYTE_BITS[:, :len(self.languages)]
            else:
                held += np.unpackbits(mask, axis=1, bitorder="little")[:, :len(self.languages)].sum(axis=0)
            seen += len(h)
        if not seen or not self.languages:
            return UNKNOWN, 0.0
        true = np.clip((held - seen * self.false) / np.maximum(1e-9, 1 - self.false) / seen, 0, 1)
        best = int(true.argmax())
        return self.languages[best], float(true[best])


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def learn(docs: DataFrame, sample: int = SAMPLE, share: float = SHARE) -> Filters:
    """Filters from documents that are not held out and have a language."""
    usable = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not known:
        return Filters.of([], [])
    languages = sorted(known)
    limit = F.create_map(*(F.lit(x) for lang in languages for x in (
        lang, int(min(1.0, sample / known[lang]) * (1 << 30)))))
    some = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit[F.col("lang")])

    def held(batches):
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                got = list(grams(text))
                h = np.unique(np.concatenate(got)).view("<i8").tolist() + [None] if got else []
                yield {"lang": [languages.index(lang)] * len(h), "gram": h}

    counted = map_rows(some.select("lang", "text"), held, "lang int, gram long").groupBy("lang", "gram").count()
    sizes = counted.where("gram IS NULL").select("lang", F.col("count").alias("size"))
    common = counted.where("gram IS NOT NULL").join(F.broadcast(sizes), "lang").where(
        F.col("count") >= F.greatest(F.least(F.lit(2), F.col("size")), F.col("size") * share)).select("lang", "gram")

    def places(batches):
        for b in batches:
            at = slots(np.array(b["gram"], "<i8").view("<u8")).astype(np.int64)
            yield {"slot": at.ravel(), "lang": np.tile(np.array(b["lang"], np.int32), HASHES)}

    # as many pairs as slots times languages at most, whatever the corpus
    bits = map_rows(common, places, "slot long, lang int").distinct().collect()
    return Filters.of(languages, [(r["slot"], r["lang"]) for r in bits])


def predict_documents(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def rows(batches):
        mine = sent.value
        for b in batches:
            got = [mine.predict(t) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    found = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows,
                     "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
