"""The pipeline, stage by stage, against brute force."""

import corpus_pipeline
from test_corpus_operators import SMALL, classes_by_hand, contaminated_by_hand, docs_of

from dwellspan.session import materialise


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = materialise(stage(spark, docs, SMALL), "stage")
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(docs.columns) <= set(out.columns) and (place == 4 or out.columns == docs.columns)
        if place == 0:
            wrong = [r for r in before if labels.get(r["doc_id"]) == 1 and r["doc_id"] not in after]
            assert len(wrong) <= 0.05 * len(before) and len(after) < len(before)
        elif place == 1:
            assert len(after) == len(before) and all(len(r["text"]) == r["n_chars"] for r in after.values())
        elif place == 2:
            classes = classes_by_hand(sorted((r["doc_id"], r["text"]) for r in before))
            assert set(after) == {c for _, c, _ in classes}
        elif place == 3:
            bad = set()
            for r in before:
                n, hit, _ = contaminated_by_hand(r["text"], items)
                if hit and 20 * hit >= n:
                    bad.add(r["doc_id"])
            assert set(after) == {r["doc_id"] for r in before} - bad
        else:
            assert len(after) == len(before) and all(r["n_tokens"] * 4 == len(r["tokens"]) for r in after.values())
        docs = out


def test_stages_on_empty_and_odd_documents(spark):
    for rows in ([], [(1, None), (None, ""), (2, "one two three\nfour"), (2, "one two three\nfour")]):
        docs = docs_of(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SMALL), "stage")
        assert docs.count() <= len(rows) and "n_tokens" in docs.columns


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in __spark_entry__.queries() if q.startswith("op")}
