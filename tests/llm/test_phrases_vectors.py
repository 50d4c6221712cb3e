"""Phrase mining, centroid clustering and neighbour search against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from freightloom.llm import centroids, neighbours, phrases

DOCS = "doc_id long, text string, lang string, phrase string, n long"
VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("cluster", T.StringType()), T.StructField("row", T.StringType())])


# -- phrases ----------------------------------------------------------------------------------

def plain_collocations(texts, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for n in range(1, min(4, len(words) - i) + 1):
                    counts[lang, tuple(words[i:i + n])] += 1
    chosen = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    rows = {}
    for (lang, p), a in chosen.items():
        inside = any(100 * b >= 80 * a for (other, q), b in chosen.items() if other == lang and len(q) > len(p)
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]])
                for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        if not inside:
            rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, totals[lang], -score) for lang, found in rows.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def mined(spark, tmp_path, texts, least, top, **sizes):
    docs = spark.createDataFrame([(i, t, lang, "x", 1) for i, (lang, t) in enumerate(texts)], DOCS)
    out = phrases.collocations(docs, str(tmp_path / "work"), least, top, **sizes)
    return sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_texts():
    rng = random.Random(5)
    words = ["a", "B", "cc", "d-d", "é", "Ünï", "x y", "zz", "q"]
    texts = [(rng.choice(["en", "fr", None, "two words"]),
              "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(60))))
             for _ in range(80)]
    hot = [("en", "big lead " + " ".join(rng.choice(words) for _ in range(3))) for _ in range(120)]
    return [*texts, *hot, ("en", None), (None, None), ("fr", ""), ("en", " \t "), ("und", "a b c d a b c d"),
            ("en", "big lead " * 50), ("en", "one two three four " * 40)]


@pytest.mark.parametrize("most", [2_000_000, 40])
def test_phrases_match_counting_everything(spark, tmp_path, monkeypatch, most):
    if most < 100:  # small bounds: several flushes and steps, targets dealt again by lead and by whole suffix
        made, words = phrases.routed, phrases.word_counts
        monkeypatch.setattr(phrases, "word_counts", lambda docs: words(docs, step=37, most=5))
        monkeypatch.setattr(phrases, "routed", lambda docs, targets, bits: made(docs, targets, bits, at_once=300, step=37))
    texts = some_texts()
    assert mined(spark, tmp_path, texts, 4, 25, most=most) == plain_collocations(texts, 4, 25)


def test_words_that_share_a_bit_cost_only_work(spark, tmp_path, monkeypatch):
    made = phrases.word_filter
    monkeypatch.setattr(phrases, "word_filter", lambda words: bytes([255] * len(made(words))))
    assert mined(spark, tmp_path, some_texts(), 4, 25) == plain_collocations(some_texts(), 4, 25)


def test_filter_has_the_bits_of_its_words(spark):
    xxhash = pytest.importorskip("xxhash")
    words = ["a", "é", "zz top"]
    bits = phrases.word_filter(spark.createDataFrame([(w,) for w in words], "phrase string"))
    at = {xxhash.xxh64_intdigest(w.encode(), 42) % phrases.BITS for w in words}
    assert set(np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")).tolist()) == at


def test_phrases_of_nothing(spark, tmp_path):
    assert mined(spark, tmp_path, [], 2, 10) == []
    assert mined(spark, tmp_path / "b", [(None, None), ("en", "once only")], 2, 10) == []


def test_hot_lead_is_dealt_by_whole_suffixes(spark, tmp_path, monkeypatch):
    seen, made = [], phrases.counted
    monkeypatch.setattr(phrases, "counted", lambda packed, least, most, again: seen.append(again) or made(packed, least, most, again))
    texts = [("en", f"hot pair w{i % 20} v{i % 21}") for i in range(400)]
    assert mined(spark, tmp_path, texts, 5, 50, most=60) == plain_collocations(texts, 5, 50)
    assert seen == [2, phrases.WORDS, None]


def test_multikey_counts_are_those_of_a_dictionary():
    rng = np.random.default_rng(3)
    keys = [rng.integers(1, 4, 500), *(rng.integers(0, 5, 500) for _ in range(3))]
    for i in range(1, 4):
        keys[i] = np.where(keys[i - 1] > 0, keys[i], 0)
    times = rng.integers(1, 9, 500)
    expected = Counter()
    for p in range(500):
        for d in range(4):
            if keys[d][p]:
                expected[tuple(int(keys[i][p]) for i in range(d + 1))] += int(times[p])
    for least in (1, 20):
        found = {}
        for depth, heads, total in phrases.multikey(keys, times, [least] * 4):
            for h, n in zip(heads, total):
                assert found.setdefault(tuple(int(keys[i][h]) for i in range(depth + 1)), int(n)) == n
        assert found == {k: n for k, n in expected.items() if n >= least}


# -- centroids --------------------------------------------------------------------------------

def plain_clusters(rows, clusters=8, rounds=10):
    points = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
              if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 131072 for x in v)]
    named = sorted(points, key=lambda p: (hashlib.sha256(f"3:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    means = [v for _, v in named[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(means)) for _, v in points]

    for _ in range(rounds):
        found = assign()
        for k in range(len(means)):
            mine = [v for (_, v), (_, j) in zip(points, found) if j == k]
            if mine:
                means[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    within = Counter()
    for d, k in found:
        within[k] += d
    return sorted(((i, k, d, within[k], sum(within.values()), hashlib.sha256(",".join(map(str, means[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(points, found)), key=repr)


def odd_vectors():
    rng = np.random.default_rng(7)
    near = rng.choice(rng.normal(0, .2, 12), (90, 64)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(near)]
    rows += [(500 + i, near[3]) for i in range(40)] + [(2, near[9]), (None, near[10]), (None, near[10])]
    bad = [None, [], near[0][:63], [*near[0], 1.0], [None, *near[0][1:]], [float("nan"), *near[0][1:]],
           [float("-inf"), *near[0][1:]]]
    return rows, [*rows, *((900 + i, v) for i, v in enumerate(bad)), (990, [131072.0, *near[0][1:]]), (991, [131071.5, *near[0][1:]])]


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)


def clustered(spark, tmp_path, rows):
    out = centroids.cluster(vector_table(spark, rows), str(tmp_path / "work"))
    return sorted((tuple(r) for r in out.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_clusters_match_a_plain_version(spark, tmp_path):
    _, rows = odd_vectors()
    assert clustered(spark, tmp_path, rows) == plain_clusters(rows)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_clusters_of_few_vectors(spark, tmp_path, count):
    rows = odd_vectors()[0][:count]
    assert clustered(spark, tmp_path, rows) == plain_clusters(rows)


def test_blocks_are_lossless_and_merge_where_vectors_repeat():
    rng = np.random.default_rng(1)
    few = rng.integers(-9, 9, (6, 64)).astype(np.int32)
    for rows in (few[rng.integers(0, 6, 200)], rng.integers(-999, 999, (200, 64)).astype(np.int32)):
        found = centroids.blocks(rows)
        assert (np.hstack([d[c] for d, c in found]) == rows).all()
        assert all(len(d) <= centroids.WORTH * len(rows) or d.shape[1] == 1 for d, _ in found)
    assert len(centroids.blocks(few[rng.integers(0, 6, 200)])) == 8


# -- neighbours -------------------------------------------------------------------------------

def plain_nearest(rows, k, every):
    points = [(n, i, [float(x) for x in v]) for n, (i, v) in enumerate(rows)]
    out = []
    for n, i, v in points:
        if i is not None and i % every == 0:
            scored = []
            for m, j, w in points:
                if m != n:
                    total = 0.0
                    for a, b in zip(v, w):
                        total += a * b
                    scored.append((-total, math.inf if j is None else j, m, j))
            out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, tmp_path, rows, k=20, every=20, **options):
    out = neighbours.nearest(vector_table(spark, rows), str(tmp_path / "work"), k, every, **options)
    return sorted((tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_whole_rerank_is_the_exact_search(spark, tmp_path):
    good, rows = odd_vectors()
    rows = [r for r in rows if r[0] is None or r[0] < 990] + [(980, [0.0] * 64)]
    assert searched(spark, tmp_path, rows, 7, 10, share=1.0, at_once=3) == plain_nearest(good, 7, 10)


def test_search_of_nothing_and_of_one(spark, tmp_path):
    assert searched(spark, tmp_path, []) == []
    assert searched(spark, tmp_path / "b", [(20, [1.0, 2.0])]) == []
    assert searched(spark, tmp_path / "c", [(20, [1.0, 2.0]), (3, [0.5, 0.0])]) == [(20, 1, 3, 0.5)]


def test_recall_of_the_index(spark, tmp_path):
    rng = np.random.default_rng(11)
    v = rng.normal(size=(6000, 64))
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    rows = list(enumerate(v.tolist()))
    found = searched(spark, tmp_path, rows, 20, 100)
    best = np.argsort(-(lambda s: np.where(np.eye(6000, dtype=bool)[::100], -9, s))(v[::100] @ v.T), axis=1)[:, :20]
    mine = {}
    for q, _, hit, _ in found:
        mine.setdefault(q, set()).add(hit)
    assert np.mean([len(mine[100 * i] & set(b.tolist())) / 20 for i, b in enumerate(best)]) >= 0.9


def test_footrule_is_the_sum_of_place_differences():
    rng = np.random.default_rng(2)
    prefix = np.stack([rng.permutation(10)[:4] for _ in range(30)])
    starts, posted, weights = neighbours.inverted(prefix, 10)
    block = {"starts": starts.tobytes(), "posted": posted.tobytes(), "weights": weights.tobytes()}
    shared = neighbours.overlap(block, prefix[:5], 30)
    for i in range(5):
        for j in range(30):
            place = [{p: r for r, p in enumerate(prefix[x])} for x in (i, j)]
            footrule = sum(abs(place[0].get(p, 4) - place[1].get(p, 4)) for p in range(10))
            assert footrule == 4 * 5 - 2 * shared[i, j]


def test_rerank_sums_in_order_only_what_may_be_among_the_best():
    rng = np.random.default_rng(5)
    near = rng.normal(size=600)
    kept = neighbours.hopeful(near, 1e-9, 20, -np.inf)
    assert kept.sum() == 20 and set(np.flatnonzero(kept)) == set(np.argsort(-near)[:20])
    assert neighbours.hopeful(near, 1e-9, 20, 9.0).sum() == 0
    tied = np.r_[near, np.full(30, near.max() - 5e-10)]  # within the rounding of the best
    assert neighbours.hopeful(tied, 1e-9, 20, -np.inf)[600:].all()
    assert neighbours.hopeful(np.r_[near, np.inf], 1e-9, 20, -np.inf).all()
    assert neighbours.hopeful(near, np.inf, 20, -np.inf).all()
    assert neighbours.hopeful(near[:5], 1e-9, 20, -np.inf).all()
