"""A language with one document that can be learned from."""

from __future__ import annotations

from freightloom.llm import language
from freightloom.llm.common import rank_of


def test_one_document_teaches_its_language(spark):
    ids = [i for i in range(1, 40) if rank_of(i)]
    rows = [(i, "the house and the garden", "en") for i in ids[:6]]
    rows += [(ids[6], "żółw gęś źdźbło", "pl"), (ids[7], "12 34", "pl")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in
           language.predict_documents(frame, language.learn(frame)).collect()}
    assert got[ids[0]][0] == "en" and got[ids[6]][0] == "pl" and got[ids[6]][1] > 0.5
    assert got[ids[7]] == ("und", 0.0)
