"""Each stage on its own input, and the whole on a small table."""

import collections

import cases
import corpus_pipeline
from llm.jaccard import jaccard_components
from llm.common import Scratch

SHAPE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = [d for d in cases.rows() if d[0] is not None]
    item = cases.prose(4242, 40)
    docs += [(100, cases.prose(1, 50) + " " + item, "en", "s", 1), (101, cases.prose(8, 80) + ' password="abcdef0123456789xyz"', "en", "s", 1)]
    sf = str(tmp_path)
    cases.frame(spark, docs, extra=False).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    now = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == SHAPE
        out.write.parquet(f"{sf}/{name}")
        now = spark.read.parquet(f"{sf}/{name}")
        seen[name] = now.collect()
    before = collections.Counter(d[0] for d in docs)
    language = collections.Counter(r.doc_id for r in seen["language_id"])
    assert language == collections.Counter({i: n for i, n in before.items() if any(c.isalpha() for c in dict((d[0], d[1] or "") for d in docs)[i])})
    found = jaccard_components(spark.createDataFrame(seen["language_id"], cases.SCHEMA), Scratch(spark, "t")).collect()
    roots = {r.doc_id: r.component_id for r in found}
    assert {r.doc_id for r in seen["ngram_jaccard"]} == {i for i in language if roots[i] == i}
    assert {r.doc_id for r in seen["ngram_jaccard"]} - {r.doc_id for r in seen["decontamination"]} == {100}
    texts = {r.doc_id: r for r in seen["secrets"]}
    assert "abcdef0123456789xyz" not in texts[101].text and texts[101].n_chars == len(texts[101].text)
    assert all(texts[r.doc_id].text == r.text for r in seen["decontamination"] if r.doc_id != 101)
    ids = {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()}
    assert ids == set(texts)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == ids


def test_empty_table(spark, tmp_path):
    sf = str(tmp_path)
    cases.frame(spark, [], extra=False).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).collect() == []
