import corpus_pipeline
from corpus_pipeline import DOCUMENT, STAGES, run
from strata.llm.common import components, cut

import __spark_entry__


def test_stages_keep_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf), "test")
        kept[name] = {r.doc_id: r for r in docs.collect()} if name != "pack" else docs.collect()
        if name != "pack":
            assert docs.columns == DOCUMENT
    assert len(kept["language_id"]) == len(text)  # all of these tables' texts have a language
    first = {}
    for doc in sorted(text):
        first.setdefault(text[doc], doc)
    assert all(first[r.text] == d for d, r in kept["near_duplicates"].items())
    clean = {d for d, r in kept["repeated_passages"].items() if not any(i in r.text for i in items)}
    assert set(kept["decontaminate"]) == clean
    assert {r.doc_id for r in kept["pack"]} == clean
    assert sorted(map(tuple, run(spark, sf).select("doc_id", "doc_tokens").distinct().collect())) == sorted({(r.doc_id, r.doc_tokens) for r in kept["pack"]})


def test_edge_rows(spark, sf, documents, none):
    """Texts without a letter go first, then the copies of the smallest id; a null id stays to the end."""
    left = {"language_id": [0, 1, 5, 5]}
    docs, empty = documents, none
    for name, stage in STAGES:
        docs, empty = cut(stage(spark, docs, sf), "test"), cut(stage(spark, empty, sf), "test")
        rows = docs.collect()
        assert sorted({r.doc_id or 0 for r in rows} if name == "pack" else [r.doc_id or 0 for r in rows]) == left.get(name, [0, 1]), name
        assert empty.count() == 0 and empty.columns == docs.columns
    for doc in (None, 1):
        own = [r for r in rows if r.doc_id == doc]
        assert sum(r.length for r in own) == own[0].doc_tokens > 1


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k[: k.index("_") + 1] for k in names if k.startswith("op") and k[2].isdigit()}
    assert names["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 50)] + [(200, 100 + k) for k in range(40)] + [(7, 7), (None, 3), (3, None), (60, 61), (60, 61), (-5, 60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(51)}, **{100 + k: 100 for k in range(40)}, 200: 100, 60: -5, 61: -5, -5: -5}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
