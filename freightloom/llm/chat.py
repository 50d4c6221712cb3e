"""Chat formatting by a finite-state machine over roles and a declarative template.

The template names, for each role, the text before and after a turn, whether its text counts for the loss, and
which roles may come next.  Turns become segments in order: markers (no loss) and texts (loss as the role says).
Control strings inside texts are escaped, reversibly, so a reader of the output always finds the turns again.

Turns of a conversation are met in order in one task, as a stream: state is one role per conversation, so a very
long conversation needs no memory, only its task's time.

Nulls, empty texts and ties: a NULL text is an empty one, a NULL role an empty role name; a role the template
does not know is formatted by its fallback marker and makes the conversation invalid; rows with equal turns are
ordered by role and text and each is a turn; a NULL turn comes first and a NULL ``conv_id`` is a conversation of
its own.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import map_rows

START = "start"


@dataclass(frozen=True)
class Turn:
    """How a role is written: marker before, marker after, loss, roles that may follow."""

    before: str
    after: str
    loss: bool
    then: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """Roles, the roles that may start and end, and the marker of unknown roles (its text names the role)."""

    turns: dict[str, Turn]
    first: tuple[str, ...]
    last: tuple[str, ...]
    other: Turn = Turn("[ROLE]", "[/ROLE]", False, ())
    between: str = "[TEXT]"
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = {self.other.before, self.other.after, self.between}
        for t in self.turns.values():
            marks |= {t.before, t.after}
        words = {w for m in marks for w in re.findall(r"<[^>]+>|\[[^\]]+\]", m)}
        object.__setattr__(self, "controls", tuple(sorted(words, key=lambda w: (-len(w), w))))

    def escaped(self, text: str) -> str:
        text = text.replace(self.escape, 2 * self.escape)
        for c in self.controls:
            text = text.replace(c, c[0] + self.escape + c[1:])
        return text

    def unescaped(self, text: str) -> str:
        """Escapes removed: an escape before a letter of a split control string goes, a doubled one is single."""
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def allowed(self, before: str, role: str) -> bool:
        if before == START:
            return role in self.first
        return before in self.turns and role in self.turns[before].then

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) segments of one turn."""
        if role in self.turns:
            t = self.turns[role]
            return [(t.before, False), (self.escaped(text), t.loss), (t.after, False)]
        t = self.other
        return [(t.before + self.escaped(role) + self.between, False), (self.escaped(text), False), (t.after, False)]


#: The template of the registered query.
INSTRUCTIONS = Template(
    turns={"system": Turn("<<SYS>>", "<</SYS>>", False, ("user",)),
           "user": Turn("[INST]", "[/INST]", False, ("assistant",)),
           "assistant": Turn("<s>", "</s>", True, ("user",))},
    first=("system", "user"), last=("assistant",))


def format_chats(chats: DataFrame, template: Template) -> DataFrame:
    """Segments in order: conv_id, seq, text, loss; ``valid``: the turns so far follow the template.

    Segments of a conversation stay together and in order within a partition.  ``last`` marks the closing
    segment, whose ``valid`` tells whether the whole conversation follows the template.
    """
    turns = chats.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role",
                         F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def rows(batches):
        conv, seq, state, valid, started = None, 0, START, True, False
        for b in batches:
            out: list[tuple] = []
            for c, role, text in zip(b["conv_id"], b["role"], b["text"]):
                role = role or ""
                if not started or c != conv:
                    if started:
                        out.append((conv, seq, "", False, valid and state in template.last, True))
                    conv, seq, state, valid, started = c, 0, START, True, True
                valid = valid and template.allowed(state, role)
                for piece, loss in template.segments(role, text):
                    out.append((conv, seq, piece, loss, valid, False))
                    seq += 1
                state = role
            yield _columns(out)
        if started:
            yield _columns([(conv, seq, "", False, valid and state in template.last, True)])

    return map_rows(ordered, rows, "conv_id long, seq long, text string, loss boolean, valid boolean, last boolean")


def _columns(rows: list[tuple]) -> dict[str, list]:
    names = ("conv_id", "seq", "text", "loss", "valid", "last")
    return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}


class _Digest:
    """Running digest of texts, with the number of code points."""

    def __init__(self):
        self.hash, self.chars = hashlib.sha256(), 0

    def add(self, *texts: str) -> None:
        for t in texts:
            self.hash.update(t.encode("utf-8", "surrogatepass"))
            self.chars += len(t)


class Reader:
    """Finds the turns again in the text of one conversation, by its markers, and the text under the loss mask.

    Text comes in pieces that may be cut anywhere; the mask is ranges of offsets into the whole text.  Only escapes keep control
    strings inside a text from being read as markers.  Held back is what may be the start of a marker or of an escape.
    """

    def __init__(self, conv_id, template: Template):
        self.conv_id, self.template = conv_id, template
        self.turns, self.loss = _Digest(), _Digest()
        self.count = self.chars = self.at = 0
        self.buffer, self.state, self.valid = "", "between", False
        self.name, self.closer = "", ""
        self.mask: deque[tuple[int, int]] = deque()
        self.openers = {t.before: (r, t.after) for r, t in template.turns.items()}
        self.marks = sorted({*self.openers, template.other.before}, key=len, reverse=True)

    def take(self, text: str, loss: bool) -> None:
        """The next piece of text; ``loss``: all of it is under the mask."""
        if loss and text:
            # ranges that touch are one, as a piece may end within an escape
            low = self.mask.pop()[0] if self.mask and self.mask[-1][1] == self.chars else self.chars
            self.mask.append((low, self.chars + len(text)))
        self.chars += len(text)
        self.buffer += text
        self._read(False)

    def end(self, valid: bool) -> None:
        self.valid = valid
        self._read(True)
        if self.buffer or self.state != "between":
            raise ValueError(f"conversation {self.conv_id}: ends within a turn")

    def _read(self, done: bool) -> None:
        while self.buffer:
            if self.state == "between":
                if len(self.buffer) < len(self.marks[0]) and not done:
                    return
                mark = next((m for m in self.marks if self.buffer.startswith(m)), None)
                if mark is None:
                    raise ValueError(f"conversation {self.conv_id}: {self.buffer[:20]!r} where a turn was due")
                self._pass(len(mark))
                self.count += 1
                if mark in self.openers:
                    role, self.closer = self.openers[mark]
                    self.turns.add(role, "\n")
                    self.state = "text"
                else:
                    self.closer, self.state = self.template.other.after, "name"
            else:
                closer = self.template.between if self.state == "name" else self.closer
                found = self.buffer.find(closer)
                plain = self._pass(found if found >= 0 else self._sure(closer))
                self.turns.add(plain)
                if found < 0:
                    return
                self.turns.add("\n")
                self._pass(len(closer))
                self.state = "text" if self.state == "name" else "between"

    def _sure(self, closer: str) -> int:
        """Characters at the front that can be neither part of a closing marker nor half an escape."""
        n = max(0, len(self.buffer) - len(closer) + 1)
        escapes = n - len(self.buffer[:n].rstrip(self.template.escape))
        return n - escapes % 2

    def _pass(self, n: int) -> str:
        """Take off ``n`` characters: their plain text, of which what is under the mask is added to the loss."""
        raw, self.buffer = self.buffer[:n], self.buffer[n:]
        while self.mask and self.mask[0][0] < self.at + n:
            low, high = self.mask[0]
            self.loss.add(self.template.unescaped(raw[max(0, low - self.at):high - self.at]))
            if high > self.at + n:
                break
            self.mask.popleft()
        self.at += n
        return self.template.unescaped(raw)

    def row(self) -> tuple:
        return (self.conv_id, self.count, self.turns.hash.hexdigest(), self.loss.chars, self.loss.hash.hexdigest(),
                self.chars, self.valid)


def chat_digests(segments: DataFrame, template: Template) -> DataFrame:
    """One row per conversation, read back from its stored text and loss mask; the bounds of segments are not used."""
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")

    def rows(batches):
        now: Reader | None = None
        for b in batches:
            done = []
            for c, text, loss, valid, last in zip(*(b[n] for n in ("conv_id", "text", "loss", "valid", "last"))):
                if now is None or c != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Reader(c, template)
                if last:
                    now.end(valid)
                else:
                    now.take(text, loss)
            yield dict(zip(names, zip(*done))) if done else {n: [] for n in names}
        if now is not None:
            yield dict(zip(names, ([v] for v in now.row())))

    return map_rows(ordered, rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long, valid boolean")
