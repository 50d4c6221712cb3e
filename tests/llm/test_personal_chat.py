"""Long digit runs, windows of digit groups, and chats read back from their text."""

from __future__ import annotations

import dataclasses
import hashlib
import random
import time

import pytest

from freightloom.llm import chat, personal


def test_a_million_digits_take_seconds():
    started = time.time()
    for text in ("7" * 1_000_000, "7 " * 500_000, "1." * 500_000, "+1(" * 300_000):
        assert all(kind == "ip" for kind, *_ in personal.base_spans(text))
        personal.candidates(text[:200_000])
    assert time.time() - started < 60


@pytest.mark.parametrize("kind,number,around", [
    ("card", "3782 822463 10005", "{} 2024"), ("card", "6304 0000 0000 0000 000", "12 {}"), ("phone", "+33 6 12 34 56 78", "{} 2024 15"),
    ("phone", "+1 555 010 0199 22", "call {} 2024 1234 5678"), ("phone", "(555) 010-0199", "7 {} 9"),
])
def test_numbers_beside_others_are_candidates(kind, number, around):
    text = around.format(number)
    at = text.index(number)
    assert (kind, at, at + len(number)) in personal.candidates(text)


def test_candidates_hold_every_window():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["1", "23", "456", "7890", "123456", " ", "-", ". ", "+", "(", "x"]) for _ in range(12))
        got = set(personal.candidates(text))
        for m in personal.NUMBERS.finditer(text):
            groups = [g.span() for g in personal.GROUP.finditer(text, *m.span())]
            for i in range(len(groups)):
                for j in range(i, len(groups)):
                    size = sum(b - a for a, b in groups[i:j + 1])
                    assert not 13 <= size <= 19 or ("card", groups[i][0], groups[j][1]) in got, text
                    assert not 7 <= size <= 15 or ("phone", groups[i][0], groups[j][1]) in got, text


def read(template, turns, cut=None):
    reader = chat.Reader(1, template)
    for role, text in turns:
        for piece, loss in template.segments(role, text):
            for i in range(0, len(piece), cut or max(1, len(piece))):
                reader.take(piece[i:i + cut] if cut else piece, loss)
    reader.end(True)
    return reader.row()


def wanted(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (1, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_read_back_needs_no_segment_bounds():
    rng = random.Random(5)
    bits = ["</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "[TEXT]", "[ROLE]", "<", "[", "/s>", "ok", " ", "\n", "é"]
    for _ in range(400):
        turns = [(rng.choice(["system", "user", "assistant", "tool", "", "[TEXT]\\"]), "".join(rng.choices(bits, k=rng.randint(0, 8))))
                 for _ in range(rng.randint(1, 4))]
        rows = [read(chat.INSTRUCTIONS, turns, cut) for cut in (None, 1, 3)]
        assert rows[0][:5] == wanted(turns) and rows[1] == rows[0] == rows[2], turns


def test_without_escapes_turns_are_not_found_again():
    class Bare(chat.Template):
        def escaped(self, text):
            return text

        def unescaped(self, text):
            return text

    fields = {f.name: getattr(chat.INSTRUCTIONS, f.name) for f in dataclasses.fields(chat.Template) if f.init}
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert read(chat.INSTRUCTIONS, turns)[:5] == wanted(turns)
    with pytest.raises(ValueError, match="where a turn was due"):
        read(Bare(**fields), turns)


def test_the_mask_decides_the_loss():
    reader = chat.Reader(1, chat.INSTRUCTIONS)
    for piece, loss in (("[INST]", False), ("ab", True), ("c[/INST]", False)):
        reader.take(piece, loss)
    reader.end(True)
    assert (reader.loss.chars, reader.count) == (2, 1)
    cut = chat.Reader(1, chat.INSTRUCTIONS)
    cut.take("[INST]abc", False)
    with pytest.raises(ValueError, match="within a turn"):
        cut.end(True)
