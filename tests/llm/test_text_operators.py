"""Text operators against plain versions on small awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from freightloom.llm import (
    boosting, bpe, chat, decontaminate, exact_dedup, language, line_dedup, personal, quality, simhash, token_shards)
from freightloom.llm.common import workspace
from freightloom.llm.components import components
from freightloom.llm.queries import tokenizer

xxhash = pytest.importorskip("xxhash")
TOKENIZER = tokenizer()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, kept string, fp int"


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


def sentence(rng, n=60, letters="abcdeinorst"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): nulls, blanks, copies, near copies, repeated rows and ids, one long text."""
    rng = random.Random(7)
    base = [sentence(rng) for _ in range(8)]
    long = "\n".join(sentence(rng, 90) for _ in range(120))
    near = base[0].split()
    near[30] = "other"
    return [
        (1, base[0]), (2, base[0].replace(" ", "\t\n", 3)), (3, " ".join(near)), (4, None), (5, ""), (6, " \n "),
        (7, long), (8, long + " end"), (9, base[1]), (9, base[1]), (9, base[2]), (None, base[3]), (None, base[3]),
        (10, "Ünïcode ßtraße 日本語 it's DON'T!! <|endoftext|> 12.5"), (11, "a"), (12, "x" * 30000), (13, base[4] + "\n" + base[5]),
        (14, base[4] + "s\n" + base[5][:-1]), (15, "w1 w2"), (-3, base[6]),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None, None, "x", "y", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((v is None, v) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# ---------------------------------------------------------------- exact copies

def expected_exact(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for body, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        least = ids[0]
        out += [(i, least, len(ids), n == 0, hashlib.sha256(body.encode()).hexdigest()) for n, i in enumerate(ids)]
    return out


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup(spark, docs, texts, clash):
    """With colliding identifiers too, when every chunk has the same one."""
    from pyspark.sql import functions as F
    identify = (lambda c: F.length(c) * 0 + F.lit(1).cast("long")) if clash else F.xxhash64
    got = exact_dedup.exact_dedup(docs, workspace(spark), identify).drop("row", "n_chunks").collect()
    same(got, expected_exact(texts))


def test_exact_dedup_plan_is_native(spark, docs):
    plan = exact_dedup.recipes(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chunks_cover_the_text(spark, docs):
    from pyspark.sql import functions as F
    rows = docs.select("text", F.array_join(exact_dedup.chunks(F.col("text")), "").alias("joined")).where("text IS NOT NULL")
    assert all(r["text"] == r["joined"] for r in rows.collect())


# ---------------------------------------------------------------- SimHash

def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, texts):
    prints = [plain_print(t) for _, t in texts]
    group = list(range(len(texts)))
    for _ in group:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    ids = defaultdict(list)
    for g, (i, _) in zip(group, texts):
        ids[g].append(i)
    want = [(i, f"{p:016x}", min((x for x in ids[g] if x is not None), default=None))
            for g, p, (i, _) in zip(group, prints, texts)]
    got = simhash.simhash_dedup(docs, workspace(spark))
    same(got.drop("row", "kept").collect(), want)
    assert got.where("kept").count() == len(ids)


def test_fingerprint_across_steps(monkeypatch):
    text = sentence(random.Random(3), 500)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 64)
    assert simhash.fingerprint(text) == whole == plain_print(text)


def test_links_are_all_within_three_bits(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(40)})
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    got = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.links(frame).collect()}
    assert got == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r["u"]: r["root"] for r in components(links, workspace(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


# ---------------------------------------------------------------- tokens

def test_token_shards(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(token_shards, "SHARD_IDS", 400)
    path, lib = workspace(spark), library()
    token_shards.write_shards(docs, TOKENIZER, path)
    ordered = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at, copies = [], 0, defaultdict(int)
    for i, t in ordered:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, copies[i], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        copies[i] += 1
        at += len(ids)
    got = token_shards.fetch(spark, path, token_shards.all_keys(docs))
    same([(*r[:5], list(r[5])) for r in got.select("doc_id", "copy", "start", "n_tokens", "ids_crc32", "ids").collect()],
         want)
    strange = spark.createDataFrame([(10**9, 0), (1, 7)], "doc_id long, copy long")
    assert token_shards.fetch(spark, path, strange).count() == 0
    assert token_shards.read_shards(spark, path).count() > 1


@pytest.mark.parametrize("n", [1, 2, 5, 300, 2500])
def test_perfect_hash(n):
    h = token_shards.key_hash(np.arange(n) * 1000 - 5, np.zeros(n, np.int64))
    salt, pilots, slot = token_shards.build_hash(h)
    assert sorted(slot) == list(range(n)) and (token_shards.find_slots(h, n, salt, pilots) == slot).all()


def test_coding(spark, docs, texts):
    lib = library()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(lib.decode(ids, skip_special_tokens=False))))
    encoded = bpe.encode_documents(docs, TOKENIZER)
    same(bpe.coding_digests(encoded, TOKENIZER).collect(), want)
    decoded = {(r["doc_id"], r["text"]) for r in bpe.decode_documents(encoded, TOKENIZER).collect()}
    assert (15, lib.decode(lib.encode("w1 w2", add_special_tokens=False).ids)) in decoded


@pytest.mark.parametrize("text", [
    "it's we're DON'T I'll", "ÀÉ ßs! é,ü", "x²½ 12345 abc123", "<|endoftext|>a <|startoftext|>", "ΣΑΣ İx ǅ",
    "á ëx", "ÅK", "a b c\x1cd\x85e", "\n\n a", "a" * 5000 + " " + "é" * 9000, "!?$...|>", "🙂🙂 b\x00c"])
def test_odd_texts_encode_as_the_library_does(text, monkeypatch):
    monkeypatch.setattr(bpe, "SHORTEST", 8)
    monkeypatch.setattr(bpe, "LONGEST", 40)
    coder = bpe.Encoder(TOKENIZER)
    body = (text + " tail words here ") * 3
    assert coder.encode(body) == coder.encode_by_chunks(body) == coder.whole(body)


def test_cuts_follow_the_content():
    a, b = sentence(random.Random(1), 9000).encode(), sentence(random.Random(2), 400).encode()
    one = {a[x:y] for x, y in zip([0, *bpe.cuts(a)], bpe.cuts(a))}
    two = [(b + a)[x:y] for x, y in zip([0, *bpe.cuts(b + a)], bpe.cuts(b + a))]
    assert b"".join(two) == b + a and sum(c in one for c in two) > len(two) * 0.7


# ---------------------------------------------------------------- lines

def test_banded_distance_and_budget():
    rng = random.Random(2)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(600):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))
        b = "".join(rng.choice("abc") if rng.random() < 0.15 else c for c in a if rng.random() > 0.1)
        for k in range(4):
            assert line_dedup.distance(a, b, k) == min(lev(a, b), k + 1)


def test_lines_of_a_link_share_a_segment():
    """Every pair within the budget meets in an index, with about five keys a line."""
    rng = random.Random(5)

    def edited(x, n):
        for _ in range(n):
            i = rng.choice([0, 1, len(x) // 3, len(x) // 2, len(x) - 1, len(x), rng.randrange(len(x) + 1)])
            x = rng.choice([x[:i] + rng.choice("abz") + x[i:], x[:i] + x[i + 1:], x[:i] + rng.choice("abz") + x[i + 1:]])
        return x

    def met(a, b):
        keys, at, asks = line_dedup.segment_keys([a, b], line_dedup.codes([a, b]))
        index, asked = ({(k, o) for k, o, q in zip(keys.tolist(), at.tolist(), asks.tolist()) if keep(q)}
                        for keep in (lambda q: not q, lambda q: True))
        return any((k, 1 - o) in index for k, o in asked)

    sizes = [*range(10, 45), *range(58, 70), *range(124, 136), 300]
    total = 0
    for n in sizes:
        for _ in range(60):
            a = "".join(rng.choice("ab") for _ in range(n))
            b = edited(a, rng.randint(1, 2))
            k = line_dedup.budget(min(len(a), len(b)))
            if a != b and k and line_dedup.distance(a, b, k) <= k:
                assert met(a, b), (a, b)
                total += 1
    assert total > 2000
    many = [sentence(rng, 30) for _ in range(500)]
    assert len(line_dedup.segment_keys(many, line_dedup.codes(many))[0]) < 7 * len(many)


def test_line_dedup(spark, none):
    rng = random.Random(4)
    lines = [sentence(rng, 8, "abcdefghijklmnopqrstuvwxyz") for _ in range(12)]

    def edited(x, n):
        x = list(x)
        for _ in range(n):
            x[rng.randrange(len(x))] = rng.choice("xyz") if rng.random() < 0.6 else ""
        return "".join(x)

    rows = [(d, "\n".join(edited(rng.choice(lines), rng.randint(0, 3)) for _ in range(6)) + "\nshort\n\n") for d in range(12)]
    rows += [(None, lines[0] + "\n" + lines[0]), (12, None), (13, ""), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = line_dedup.line_dedup(frame, workspace(spark)).collect()
    every = sorted({x for _, t in rows for x in line_dedup.lines_of(t) if x})
    group, degree = {x: x for x in every}, defaultdict(int)
    for x in every:
        for y in every:
            k = line_dedup.budget(min(len(x), len(y)))
            if x < y and k and line_dedup.distance(x, y, k) <= k:
                degree[x], degree[y] = degree[x] + 1, degree[y] + 1
                old, new = group[x], group[y]
                group = {z: new if g == old else g for z, g in group.items()}
    assert sum(degree.values()) > 10
    seen, dropped = set(), 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for x in line_dedup.lines_of(t):
            if x:
                dropped += group[x] in seen
                seen.add(group[x])
    assert sum(r["n_lines"] - r["n_kept"] for r in got) == dropped
    for r in got:
        if r["doc_id"] not in (0, None):
            text = dict(rows)[r["doc_id"]]
            assert r["n_links"] == sum(degree[x] for x in set(line_dedup.lines_of(text)) if x)
    assert line_dedup.line_dedup(none, workspace(spark)).count() == 0


# ---------------------------------------------------------------- decontamination

def test_search_is_the_smallest_distance():
    rng = random.Random(9)
    for _ in range(150):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert decontaminate.search(item, text)[0] == min(row)


def test_contaminated(spark, docs, none, monkeypatch):
    rng = random.Random(6)
    item = sentence(rng, 25)
    changed = item[:20] + "XX" + item[23:60] + item[61:]
    rows = [(1, f"before {item.upper()} after"), (2, f"so {changed.replace(' ', '  ')} on"), (3, item[:60]), (4, None),
            (5, ""), (None, item), (1, f"before {item.upper()} after"), (6, sentence(rng, 3000) + item)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, " "), (10, sentence(rng, 30))], "item_id long, text string")
    for block in (decontaminate.BLOCK_CHARS, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
        got = decontaminate.contaminated(frame, items)
        assert sorted(map(str, ((r["doc_id"], r["item_id"]) for r in got.collect()))) == sorted(
            map(str, [(1, 7), (1, 7), (2, 7), (None, 7), (6, 7)]))
        assert {r["doc_id"] for r in decontaminate.clean(frame, items).collect()} == {3, 4, 5}
    assert decontaminate.contaminated(frame, items.limit(0)).count() == 0
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.clean(docs, items).columns == docs.columns


# ---------------------------------------------------------------- quality and language

def test_quality(spark, docs, none):
    rng = random.Random(8)
    rows = [(i, sentence(rng) if i % 3 else " ".join(w + "$$$" for w in sentence(rng).upper().split())) for i in range(240)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)] + [(5, None, 0), (None, 1, 0)],
                                   "doc_id long, quality long, toxic long")
    model = quality.learn(frame, labels)
    got = quality.score_documents(frame, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    apart = [r for r in got if r["held_out"]]
    assert len(apart) > 20 and sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in apart) >= 0.95 * len(apart)
    assert quality.score_documents(docs, model).count() == docs.count()
    assert quality.keep(frame, model).columns == frame.columns
    assert quality.learn(frame, labels.limit(0)) == 0.5 and quality.score_documents(none, 0.5).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, quality.learn(frame, labels.where("quality = 1"))).collect()} == {1.0}


def test_language(spark, none):
    rng = random.Random(8)
    rows = [(i, sentence(rng, 40, "abcdei" if i % 2 else "norstu"), "xx" if i % 2 else "yy") for i in range(120)]
    rows += [(500, None, "xx"), (501, "12 3!", "yy"), (502, "", None), (None, sentence(rng, 40, "abcdei"), None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.predict_documents(frame, language.learn(frame)).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:120])
    assert {got[i]["lang_pred"] for i in (500, 501, 502)} == {"und"} and got[None]["lang_pred"] == "xx"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.learn(frame.where("lang IS NULL"))
    assert {r["lang_pred"] for r in language.predict_documents(frame, nothing).collect()} == {"und"}
    assert language.predict_documents(none, nothing).count() == 0


def test_grams_do_not_depend_on_steps(monkeypatch):
    text = "one two three " * 40
    whole = language.Filters.of(["a"], [(s, 0) for h in language.grams(text) for s in language.slots(h).ravel().tolist()])
    monkeypatch.setattr(language, "STEP", 64)
    assert whole.predict(text)[0] == "a"


# ---------------------------------------------------------------- personal data

def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


def test_base_spans_are_the_rules():
    rng = random.Random(11)
    bits = ["a.b@c.de", "@", "x@y", "1.2.3.4", "300.1.1.1", "001.2.3.4.5", "4539578763621486", "4539 5787 6362 1486", "+1 (555) 010-0199",
            "+", "-", " ", ".", "é", "12", "0" * 16, "a@b@c.d.e", "%+", "(", "\n"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        assert personal.base_spans(text) == plain_spans(text), text


def test_personal(spark, docs, none):
    rng = random.Random(12)

    def card():
        d = [rng.randrange(10) for _ in range(15)]
        return next("".join(map(str, [*d, c])) for c in range(10) if personal.luhn("".join(map(str, [*d, c]))))

    rows = [(i, f"{sentence(rng, 5)} {card() if i % 2 else rng.randrange(10**15, 10**16)} {sentence(rng, 5)} "
                f"mail u{i}@h{i}.example.org version {i}.{i % 7} +1 (555) 010-{i:04d} end") for i in range(400)]
    rows.append((1000, f"on +1 (555) 555-6633 {card()} und"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    chooser = personal.learn(frame)
    got = {r["doc_id"]: r for r in personal.span_digests(personal.find(frame, chooser)).collect()}
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    for i, text in rows:
        base = plain_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) - {""} <= set(got[i]["spans"].split(","))
        assert got[i]["n_email"] == sum(k == "email" for k, _, _ in base)
    assert "card:21:37" in got[1000]["spans"]  # hidden from the rule by the number before it
    assert "example" not in personal.redacted(frame, chooser).where("doc_id = 3").first()["text"]
    assert personal.find(docs, chooser).count() == docs.count()
    assert personal.find(none, personal.learn(none)).count() == 0


def test_boosting_learns_a_step():
    x = np.random.default_rng(1).random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((boosting.fit(x, y).probability(x) > 0.5) == y).mean() > 0.97
    assert boosting.fit(x, np.zeros(400)).probability(x).max() < 0.1


# ---------------------------------------------------------------- chats

def test_chat(spark, none):
    odd = "</s>[INST] \\ok\\[ [/INST] [\\INST] <<SYS>> \\\\"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd), (2, 0, "assistant", "first"),
            (3, 0, "user", None), (3, 0, "user", "again"), (4, 1, "to[/ROLE]ol", "x"), (4, 0, None, ""), (None, 0, "user", "n"),
            (5, None, "user", "null turn"), (5, 1, "assistant", "")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.format_chats(frame, chat.INSTRUCTIONS), chat.INSTRUCTIONS).collect()}
    convs = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r[:2]) + (r[2] or "", r[3] or "")):
        convs[c].append((role or "", text or ""))
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), hashlib.sha256(want.encode()).hexdigest())
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: got[c]["valid"] for c in convs} == {1: True, 2: False, 3: False, 4: False, None: False, 5: True}
    empty = spark.createDataFrame([], frame.schema)
    assert chat.format_chats(empty, chat.INSTRUCTIONS).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, docs, none, texts, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, texts[-1][1])], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    stages, frame = dict(corpus_pipeline.STAGES), docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    after = {}
    for name in list(stages)[:-1]:
        frame = stages[name](spark, frame, base)
        assert frame.columns == docs.columns
        after[name] = sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)
    assert len(after["quality"]) == len(texts)  # nothing is known against any
    assert len(after["exact_dedup"]) == sum(x[3] for x in expected_exact(texts))
    prints = {plain_print(t) for _, t in after["exact_dedup"]}
    assert len(after["near_dedup"]) <= len(prints) and (1, texts[0][1]) in after["near_dedup"]
    assert -3 in {i for i, _ in after["near_dedup"]} and -3 not in {i for i, _ in after["decontamination"]}
    assert stages["bpe"](spark, frame, base).count() == len(after["decontamination"])
    for name in stages:
        assert stages[name](spark, none, base).count() == 0


def test_near_stage_keeps_one_of_each_group(spark, tmp_path):
    """Groups are those of a plain fingerprint comparison; of each the smallest id stays, the rest of the table is left alone."""
    rng = random.Random(17)
    base = [sentence(rng, 400) for _ in range(6)]
    rows = [(100 * i + j, b + (f" end{j}" if j else "")) for i, b in enumerate(base) for j in range(4)] + [(900, None), (901, "")]
    prints = {i: plain_print(t) for i, t in rows}
    root = {i: i for i, _ in rows}
    for i, _ in rows:
        for j, _ in rows:
            if bin(prints[i] ^ prints[j]).count("1") <= 3 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept_ids = [r["doc_id"] for r in corpus_pipeline.without_near_copies(spark, frame, "").select("doc_id").collect()]
    assert sorted(kept_ids) == sorted(set(root.values())) and len(kept_ids) < len(rows)
