"""Subword encoding with a public tokenizer file: memo of encoded pieces, chunk reuse, exact joins.

The tokenizer normalises and splits by rules that never look across ASCII white space, and drops the white
space, so a text's ids are those of its white-space-separated pieces in order.  ``Encoder`` asks the tokenizers
library once for each distinct piece it holds.

``encode_documents`` cuts whole texts where a rolling hash of the last 64 bytes says so.  A chunk met again, in
any document of the task, is not encoded again; documents that share a smallest chunk are brought to the same task
first.  A cut can fall inside a piece, where the ids of the two chunks are wrong.  Each join is repaired by
encoding the text around it again, widened piece by piece until the ids on both sides agree exactly with those
kept for the chunks.

Nulls, empty texts and ties: a NULL or empty text has no ids and decodes to an empty text; repeated rows each
get a row; a NULL ``doc_id`` stays NULL; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import OrderedDict
from collections.abc import Callable
from itertools import batched

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import map_rows
from freightloom.llm.exact_dedup import chunks

#: Pieces one worker remembers while it writes shards, and pieces and bytes of chunks while it codes by chunks, whatever the
#: input's size.
MEMO, CODING_MEMO, REUSE_BYTES = 1_000_000, 200_000, 16 << 20
#: Bytes the rolling hash sees, and chunk lengths in bytes: about one cut in 2,048 positions.
WINDOW, SHORTEST, LONGEST, MASK = 64, 256, 8192, 2047
#: Whole pieces kept on each side of a chunk for repairs; pieces encoded and bytes hashed at a time.
REACH, SLICE, STEP = 4, 100_000, 1 << 22
#: Letters that normalising leaves alone but for case, then signs without an apostrophe; and how bytes are shown to the model: printable
#: ones as they are, the others in order from U+0100.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173))}
SPACES = re.compile(rb"[ \t\n\r\x0b\x0c]")
_ENCODERS: dict[str, "Encoder"] = {}


class Memo(dict):
    """Values by key, made when missing; of a full memo the older half goes unless it was asked for since."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of byte texts as little-endian unsigned integers of the smallest width (2 or 4 bytes) the vocabulary allows."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.code = "H" if len(self.tokens) <= 1 << 16 else "I"
        self.kind, self.width = ("<u2", 2) if self.code == "H" else ("<u4", 4)
        self.model = self.tokenizer.model
        self.simple = self._splits_simply()
        self.memo = Memo(self._piece, MEMO)
        self.chunks: OrderedDict[bytes, tuple] = OrderedDict()
        self.held = 0

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker's encoder of a file; it outlives a task."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def forget(self, most: int) -> None:
        """Empty the memo, which holds ``most`` pieces from now on, and the chunks."""
        self.memo, self.held = Memo(self._piece, most), 0
        self.chunks.clear()

    def _splits_simply(self) -> bool:
        """Whether the tokenizer lower-cases, parts letters from stops and shows bytes as the common alphabet does."""
        probe = "Abc,éß$?\u00c0.|>"
        return self.whole(probe) == b"".join(
            self.word(w) if w.isalpha() else self.whole(w) for w in ("abc", ",", "éß", "$?", "à", ".|>"))

    def _piece(self, piece: bytes) -> bytes:
        if piece.isalpha() and piece.islower() and self.simple:  # ASCII
            return self.word(piece.decode())
        text = piece.decode("utf-8", "replace")
        if self.simple and (m := PLAIN.fullmatch(text)):
            letters = m[1].lower()
            if letters == text:
                return self.word(letters)
            return self.memo[letters.encode()] + (self.memo[m[2].encode()] if m[2] else b"")
        return self.whole(text)

    def pieces(self, pieces: list[bytes]) -> bytes:
        """Ids of pieces without white space, one after another."""
        return b"".join(map(self.memo.__getitem__, pieces))

    def whole(self, text: str) -> bytes:
        """Ids by the library's own normalising and splitting."""
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, letters: str) -> bytes:
        """Ids of lower-case Latin letters, which are one word to the tokenizer: its model alone is asked."""
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(SHOWN)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text."""
        data, out = (text or "").encode("utf-8", "replace"), []
        words = data.split()
        for at in range(0, len(words), SLICE):
            out.append(self.pieces(words[at:at + SLICE]))
        return b"".join(out)

    def chunk(self, data: bytes) -> tuple:
        """(open head, ids between, open tail, first and last whole piece) of a chunk, encoded once while remembered.

        A chunk without white space is all head, marked by a missing tail.
        """
        if (known := self.chunks.get(data)) is not None:
            self.chunks.move_to_end(data)
            return known
        if not (first := SPACES.search(data)):
            made = (data, b"", None, None, None)
        else:
            tail = b"" if data[-1:].isspace() else data.rsplit(None, 1)[-1]
            inner = data[first.start():len(data) - len(tail)].split()
            made = (data[:first.start()], self.pieces(inner), tail, inner[:REACH], inner[-REACH:])
        self.chunks[data] = made
        self.held += 3 * len(data)
        while self.held > REUSE_BYTES:
            self.held -= 3 * len(self.chunks.popitem(last=False)[0])
        return made

    def repaired(self, before: list[bytes], joint: bytes, after: list[bytes]) -> bytes | None:
        """Ids of a piece cut between chunks: encode it with neighbours until their ids agree with the kept ones."""
        wide = 1
        while True:
            left, right = before[max(0, len(before) - wide):], after[:wide]
            window = b" ".join([*left, joint, *right]).decode("utf-8", "replace")
            ids = self.whole(window)
            start, end = self.pieces(left), self.pieces(right)
            if ids.startswith(start) and ids.endswith(end) and len(ids) >= len(start) + len(end):
                return ids[len(start):len(ids) - len(end)]
            if wide >= max(len(before), len(after)):
                return None
            wide += 1

    def encode_by_chunks(self, text: str | None) -> bytes:
        """Ids of a whole text from chunks that may be known already."""
        data = (text or "").encode("utf-8", "replace")
        out, pending, before, last = [], b"", [], 0
        for cut in cuts(data):
            head, ids, tail, firsts, lasts = self.chunk(data[last:cut])
            last = cut
            if tail is None:
                pending += head
                continue
            if pending and head:
                if (mended := self.repaired(before, pending + head, firsts)) is None:
                    return self.encode(text)
                out.append(mended)
            elif pending or head:
                out.append(self.pieces([pending or head]))
            out.append(ids)
            pending, before = tail, lasts or before
        if pending:
            out.append(self.pieces([pending]))
        return b"".join(out)

    def numbers(self, ids: bytes) -> list[int]:
        return np.frombuffer(ids, self.kind).tolist()

    def decode(self, numbers: list[int]) -> str:
        """Text of ids, special tokens kept."""
        if self.tokenizer.decoder is None:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``: where a rolling hash of the last WINDOW bytes ends in zero bits."""
    ends, last, size = [], 0, len(data)
    for at in range(0, size, STEP):  # in steps, so that a very long text needs no large arrays
        low = max(0, at - WINDOW)
        h = np.frombuffer(data, np.uint8, min(size, at + STEP) - low, low).astype(np.uint32) + np.uint32(1)
        width, factor = 1, 0x01000193
        while width < WINDOW:
            h[width:] += h[:-width] * np.uint32(factor)
            width, factor = 2 * width, factor * factor & 0xFFFFFFFF
        mixed = (h * np.uint32(0x9E3779B1)) >> np.uint32(16)
        for end in (np.nonzero((mixed & np.uint32(MASK)) == 0)[0] + low + 1).tolist():
            if end <= at or end - last < SHORTEST:
                continue
            while end - last > LONGEST:
                last += LONGEST
                ends.append(last)
            if end - last >= SHORTEST:
                ends.append(end)
                last = end
    while size - last > LONGEST:
        last += LONGEST
        ends.append(last)
    return [*ends, size] if size > last else ends


def near_each_other(docs: DataFrame) -> DataFrame:
    """Documents dealt by their smallest chunk identifier, so that copies meet; adaptive execution splits hot ones."""
    sketch = F.array_min(F.transform(chunks(F.coalesce("text", F.lit(""))), lambda c: F.xxhash64(c)))
    return docs.select("doc_id", "text", sketch.alias("sketch")).hint("rebalance", "sketch").select("doc_id", "text")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ``ids`` (little-endian unsigned integers, 2 bytes wide for vocabularies to 65,536, else 4)."""
    def rows(batches):
        coder = Encoder.of(path)
        coder.forget(CODING_MEMO)
        for b in batches:
            for part in batched(zip(b["doc_id"], b["text"]), 256):
                ids = [coder.encode_by_chunks(t) for _, t in part]
                yield {"doc_id": [i for i, _ in part], "n_tokens": [len(x) // coder.width for x in ids], "ids": ids}
        coder.forget(MEMO)  # the worker goes on to other tasks and stages

    return map_rows(near_each_other(docs.select(F.col("doc_id").cast("long"), "text")), rows,
                    "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of ``encode_documents``' output."""
    def rows(batches):
        coder = Encoder.of(path)
        for b in batches:
            for part in batched(zip(b["doc_id"], b["ids"]), 256):
                yield {"doc_id": [i for i, _ in part], "text": [coder.decode(coder.numbers(x)) for _, x in part]}

    return map_rows(encoded, rows, "doc_id long, text string")


def coding_digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents."""
    def rows(batches):
        coder = Encoder.of(path)
        decimal = [str(i) for i in range(len(coder.tokens))]
        for b in batches:
            for part in batched(zip(b["doc_id"], b["ids"]), 256):
                out = {"doc_id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
                for i, ids in part:
                    numbers = coder.numbers(ids)
                    out["doc_id"].append(i)
                    out["n_tokens"].append(len(numbers))
                    out["ids_sha256"].append(_digest(" ".join(map(decimal.__getitem__, numbers))))
                    out["decoded_sha256"].append(_digest(coder.decode(numbers)))
                yield out

    return map_rows(encoded, rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
