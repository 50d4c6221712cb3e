"""Personal data is learnt from every document, and the counted fit is the fit on arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from freightloom.llm import boosting, personal
from freightloom.llm.common import workspace


def test_candidates_of_every_document_are_counted(spark):
    """More documents than the former sample of 20,000: all candidates count, repeats too."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("mail a@b.com or +1 555 010 "), F.lpad(F.col("id").cast("string"), 4, "0")).alias("text"))
    seen = personal.counted_candidates(docs).groupBy("kind").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    got = {r.kind: (r.n, r.y) for r in seen.collect()}
    assert got["email"] == (30_000, 30_000) and got["phone"][1] == 30_000


def test_counted_fit_is_the_fit_on_arrays(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS", 4)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 60, (3000, 3))
    y = ((x[:, 0] > 20) ^ (x[:, 1] % 7 > 3)).astype(float)
    rows = spark.createDataFrame([(boosting.packed(a), int(b)) for a, b in zip(x, y)], "x binary, y long")
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    got, want = boosting.fit_counted(counted, workspace(spark)), boosting.fit(x.astype(float), y)
    assert all(np.allclose(a, b) for a, b in zip(got.edges, want.edges, strict=True))
    assert np.allclose(got.probability(x), want.probability(x), atol=1e-4)
