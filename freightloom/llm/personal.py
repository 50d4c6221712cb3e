"""Personal data: exact base rules, and candidates chosen by boosted trees.

The base rules find emails, addresses of hosts, payment cards and phone numbers; their spans always count.
Generators with high recall propose further, overlapping spans of the same kinds: every run of digit groups, its pieces
without a space, every window of neighbouring groups with 4 to 19 digits, and everything shaped like a spelt-out email (up to 64
characters of a name before a mail sign and 600 after it; these widths bound added spans only, never base spans).  Boosted trees score them by format and context.  The
trees learn from the candidates of all documents, labelled by the base rules; a fifth of the documents, by a hash of
the id, is kept apart and sets a threshold for each kind at the least probability, in steps of 1e-5, that is precise
enough; of equal ones the right count first, since what the base rules miss is counted as wrong.  Equal candidates are counted where they are found; only counts and sums come to the driver.
Chosen spans that touch no stronger one are added.

Nulls, empty texts and ties: a NULL or empty text has no spans; equal scores keep the earlier and longer span;
repeated rows each get a row; a text of any length takes time in proportion to it; a NULL ``doc_id`` stays NULL; other columns are ignored.  Without any candidate
nothing is added.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm import boosting
from freightloom.llm.common import kept, map_rows, rank_of, workspace

KINDS = ("email", "ip", "card", "phone")
PRECISION, FEWEST = 0.98, 20
#: Steps of a threshold, and different candidates that a task counts before it passes them on.
STEPS, HELD = 100_000, 50_000
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: The rules of four numbers and of cards as given, but without second starts in a run of digits and without steps back, so
#: that a run of any length takes linear time; the matches are the same.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Generators: digit groups with light separators, and mail signs in any spelling.
NUMBERS = re.compile(r"\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9])*+")
GROUP = re.compile(r"[0-9]+")
SIGN = re.compile(r"@|[\[(]at[\])]", re.I)
SPELT = re.compile(r"[\w.%+-]{1,64}\s?(?:@|[\[(]at[\])])\s?[\w-]{1,64}(?:\s?(?:\.|[\[(]dot[\])])\s?[\w-]{1,64}){1,8}", re.I)
CUES = ("mail", "phone", "tel", "call", "fax", "card", "visa", "pay", "ip", "host", "server", "version", "licen", "no.")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches of the email rule: each has one ``@``, so it is found from there."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        after = at + 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append(("email", start, m.end()))
            free = after = m.end()
        at = text.find("@", after)
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start and kind."""
    out = emails(text)
    if GROUP.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(_octet(p) for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = "".join(GROUP.findall(m.group()))
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 10 <= sum(map(len, GROUP.findall(m.group()))) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=_order)


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _order(span: Span) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data, without repeats."""
    out: set[Span] = set()
    for sign in SIGN.finditer(text):
        low = max(0, sign.start() - 66)
        for m in SPELT.finditer(text[low:sign.end() + 600]):
            if low + m.start() <= sign.start() < low + m.end():
                out.add(("email", low + m.start(), low + m.end()))
                break
    for m in NUMBERS.finditer(text):
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        parts = {(m.start(), m.end(), sum(b - a for a, b in groups))}
        for run in re.finditer(r"\S+", m.group()):
            a, b = m.start() + run.start(), m.start() + run.end()
            parts.add((a, b, sum(map(len, GROUP.findall(text, a, b)))))
        parts.update(_windows(text, m.start(), groups))
        for a, b, size in parts:
            if 13 <= size <= 19:
                out.add(("card", a, b))
            if 7 <= size <= 15:
                out.add(("phone", a, b))
            if 4 <= size <= 19 and IP.fullmatch(text, a, b):
                out.add(("ip", a, b))
    return sorted(out, key=_order)


def _windows(text: str, low: int, groups: list[tuple[int, int]]) -> set[tuple[int, int, int]]:
    """(start, end, digits) of all runs of neighbouring groups with 4 to 19 digits, also with the ``+`` and ``(`` before them.

    A start has 16 windows of that size at most.
    """
    out = set()
    for i, (a, _) in enumerate(groups):
        sign, size = a, 0
        while sign > low and text[sign - 1] in "+(":
            sign -= 1
        for first, last in groups[i:i + 19]:
            size += last - first
            if size > 19:
                break
            if size >= 4:
                out |= {(a, last, size), (sign, last, size)}
    return out


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, a, b = span
    body, left, right = text[a:b], text[max(0, a - 24):a].lower(), text[b:b + 12]
    groups = GROUP.findall(body)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    return [
        *(float(kind == k) for k in KINDS), len(body), len(digits), len(groups), sizes[0], sizes[-1], max(sizes),
        body.count(" "), body.count("-"), body.count("."), body.count("("), body.count("/"), float(body[:1] == "+"),
        float("@" in body), float(bool(digits) and luhn(digits)), float(all(_octet(g) for g in groups)),
        float(left[-1:].isalnum()), float(left[-1:] in "+-./#="), float(right[:1].isalnum()), float(right[:1] in "-./"),
        float(right[:1] in "-./" and right[1:2].isdigit()), float(left[-1:] in "-./ " and left[-2:-1].isdigit()),
        float(any(c.isdigit() for c in left)), *(float(c in left) for c in CUES),
    ]


@dataclass
class Chooser:
    """Trees and the least probability, by kind, at which a candidate counts."""

    trees: boosting.Trees | None
    least: dict[str, float]

    def more(self, text: str, known: list[Span]) -> list[Span]:
        """Chosen candidates that overlap no base span and no stronger choice."""
        if self.trees is None:
            return []
        found = [c for c in candidates(text) if self.least.get(c[0], 2.0) <= 1 and not _touches(c, known)]
        if not found:
            return []
        p = self.trees.probability(np.array([features(text, c) for c in found]))
        chosen: list[Span] = []
        for q, c in sorted(((-q, c) for q, c in zip(p, found)), key=lambda x: (x[0], x[1][1], -x[1][2], x[1][0])):
            if -q >= self.least[c[0]] and not _touches(c, chosen):
                chosen.append(c)
        return chosen


def _touches(span: Span, others: list[Span]) -> bool:
    return any(span[1] < b and a < span[2] for _, a, b in others)


def counted_candidates(docs: DataFrame) -> DataFrame:
    """Candidates of all documents: kind, whether kept apart, features, their number and how many are base spans."""
    def rows(batches):
        held: dict[tuple[str, bool, bytes], list[int]] = {}

        def out():
            yield {"kind": [k[0] for k in held], "apart": [k[1] for k in held], "x": [k[2] for k in held],
                   "n": [v[0] for v in held.values()], "y": [v[1] for v in held.values()]}
            held.clear()

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                text = text or ""
                base, apart = set(base_spans(text)), rank_of(doc_id) == 0
                for c in candidates(text):
                    count = held.setdefault((c[0], apart, boosting.packed(features(text, c))), [0, 0])
                    count[0] += 1
                    count[1] += c in base
                    if len(held) >= HELD:
                        yield from out()
        yield from out()

    listed = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows,
                      "kind string, apart boolean, x binary, n long, y long")
    return listed.groupBy("kind", "apart", "x").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))


def learn(docs: DataFrame) -> Chooser:
    """Trees from all candidates of four fifths of the documents; thresholds from those of the fifth that is kept apart."""
    folder = workspace(docs.sparkSession)
    seen = kept(counted_candidates(docs), folder, "candidates")
    taught = seen.where("NOT apart")
    if taught.isEmpty():
        return Chooser(None, {})
    trees = boosting.fit_counted(taught, folder)

    def steps(batches):
        for b in batches:
            if b["x"]:
                p = trees.probability(np.stack([np.frombuffer(x, "<i2") for x in b["x"]]))
                yield {"kind": b["kind"], "step": np.floor(p * STEPS).astype(int).tolist(), "n": b["n"], "y": b["y"]}

    stepped = map_rows(seen.where("apart"), steps, "kind string, step int, n long, y long").groupBy("kind", "step").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
    least = {}
    for kind in KINDS:
        mine = np.array(sorted((-r.step, r.n, r.y) for r in stepped if r.kind == kind), np.int64).reshape(-1, 3)
        every, right = np.cumsum(mine[:, 1]), np.cumsum(mine[:, 2])
        # the right ones of a step count before its others, which include what the base rules miss
        good = np.nonzero((mine[:, 2] > 0) & (right >= PRECISION * (every - mine[:, 1] + mine[:, 2])))[0]
        if len(good) and right[good[-1]] >= FEWEST:
            least[kind] = float(max(0.5, -mine[good[-1], 0] / STEPS))
    return Chooser(trees, least)


def find(docs: DataFrame, chooser: Chooser) -> DataFrame:
    """doc_id, base and all spans, as arrays of (kind, start, end) in order; one row per input row."""
    def rows(batches):
        for b in batches:
            out = {"doc_id": b["doc_id"], "base": [], "spans": []}
            for text in b["text"]:
                base = base_spans(text or "")
                every = sorted(base + chooser.more(text or "", base), key=_order)
                for name, spans in (("base", base), ("spans", every)):
                    out[name].append([{"kind": k, "start": a, "end": e} for k, a, e in spans])
            yield out

    kind = "array<struct<kind:string,start:int,end:int>>"
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, f"doc_id long, base {kind}, spans {kind}")


def redacted(docs: DataFrame, chooser: Chooser) -> DataFrame:
    """doc_id and text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    def rows(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "text": [None if t is None else _without(t, chooser) for t in b["text"]]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, text string")


def _without(text: str, chooser: Chooser) -> str:
    base, out, at = base_spans(text), [], 0
    for kind, a, e in sorted(base + chooser.more(text, base), key=_order):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
