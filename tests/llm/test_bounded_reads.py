"""Keyed reads of token shards, blocks of the benchmark and the sample of the classifier stay bounded."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from freightloom.llm import decontaminate, quality, token_shards
from freightloom.llm.common import workspace
from freightloom.llm.queries import tokenizer


def sentence(rng, n=30):
    return " ".join("".join(rng.choices("abcdeinorst", k=rng.randint(2, 8))) for _ in range(n))


def test_fetch_of_few_keys_reads_their_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(token_shards, "SHARD_IDS", 300)
    rng, path = random.Random(1), workspace(spark)
    docs = spark.createDataFrame([(i // 2 if i else None, sentence(rng)) for i in range(120)], "doc_id long, text string")
    token_shards.write_shards(docs, tokenizer(), path)
    keys = token_shards.all_keys(docs)
    direct = sorted(map(repr, token_shards.fetch(spark, path, keys).collect()))
    monkeypatch.setattr(token_shards, "FEW", 0)
    joined = token_shards.fetch(spark, path, keys)
    assert sorted(map(repr, joined.select("doc_id", "copy", "start", "n_tokens", "ids_crc32", "ids").collect())) == direct
    monkeypatch.setattr(token_shards, "FEW", 5)
    one = token_shards.fetch(spark, path, keys.where("doc_id = 30 AND copy = 1"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(part," in plan and "EqualTo(seq," in plan and "Join" not in plan
    assert [repr(r) for r in one.collect()] == [r for r in direct if r.startswith("Row(doc_id=30, copy=1")]


def plain_matches(docs, items, rate):
    """Every item against every text, by the plain table of edit distances."""
    def distance(item, text):
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item, 1):
            last, row[0] = row[0], i
            for j, b in enumerate(text, 1):
                last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
        return min(row)

    out = []
    for doc_id, text in docs:
        best = {}
        for item_id, item in items:
            item = decontaminate.plain(item)
            if item and (d := distance(item, decontaminate.plain(text))) <= int(rate * len(item)):
                best[item_id] = min(d, best.get(item_id, d))
        out += [(doc_id, i, d) for i, d in best.items()]
    return sorted(out, key=repr)


def test_contaminated_is_all_pairs_and_one_id_spreads(spark, monkeypatch):
    rng = random.Random(2)
    # one id, and the missing id, hold most texts
    items = [(7 if i % 3 else None, sentence(rng, 6)) for i in range(12)] + [(9, sentence(rng, 6)), (9, "  "), (10, None)]
    docs = []
    for i in range(40):
        text = items[i % 13][1]
        at = rng.randrange(len(text))
        docs.append((i % 30, sentence(rng, 5) + " " + text[:at] + rng.choice(["", "x", text[at:at + 2]]) + text[at + rng.randint(0, 2):] + " z"))
    docs += [(50, None), (None, items[0][1].upper()), (None, items[0][1].upper())]
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, row string")
    listed = spark.createDataFrame(items, "item_id long, text string")
    want = plain_matches(docs, items, decontaminate.RATE)
    assert len(want) > 20
    for chars in (decontaminate.BLOCK_CHARS, 150):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        got = decontaminate.contaminated(frame, listed).select("doc_id", "item_id", "distance").collect()
        assert sorted(map(tuple, got), key=repr) == want
        clean = decontaminate.clean(frame, listed)
        assert sorted(r.doc_id for r in clean.collect()) == sorted(set(d for d, _ in docs if d is not None) - {w[0] for w in want})
        assert clean.columns == frame.columns
    blocks = list(decontaminate.item_blocks(listed))
    assert len(blocks) > 1 and sum(any(i == 7 for i, _ in b) for b in blocks) > 1


def test_repeated_id_does_not_swell_the_sample(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(1 if i % 3 else i + 10, sentence(rng)) for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id").distinct().withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    seen = []
    original = quality.fit
    try:
        quality.fit = lambda x, y: seen.append(len(x)) or original(x, y)
        quality.learn(docs, labels, sample=1000)
        quality.learn(docs.union(docs), labels, sample=1000)
        quality.learn(docs, labels, sample=20)
    finally:
        quality.fit = original
    assert seen[0] == seen[1] > 200 and all(n <= 20 for n in seen[2:])
