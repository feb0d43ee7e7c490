from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = corpus_pipeline.read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    sizes = [before]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < before
    texts = [r["text"] for r in docs.collect()]
    assert len({" ".join(t.split()) for t in texts}) == len(texts)
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert coded.count() == len(texts) and coded.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_stages_of_odd_tables(spark):
    """Nulls, repeats, empty and long texts, and columns that bear names the stages use themselves."""
    kind = "doc_id long, text string, lang string, ids string, gone int, row string, own string, c0 string, sha string, keep string, predicted int"
    long = " ".join(f"word{k}" for k in range(3000))
    tail = ("en", "i", 1, "r", "o", "c", "s", "k", 7)
    rows = [(None, None, *tail), (1, None, *tail), (1, None, *tail), (2, "", *tail), (3, " \n ", *tail), (4, long, *tail), (5, long, *tail), (6, long.replace("word7 ", "other "), *tail), (None, long, *tail), (7, "short one", *tail)]
    docs = spark.createDataFrame(rows, kind)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        found = out.collect()
        assert all(tuple(r)[2:] == tail for r in found), name
        kept[name] = sorted(r["doc_id"] or 0 for r in found)
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert kept["toxicity"] == kept["decontamination"] == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7]
    assert kept["exact_dedup"] == [1, 3, 4, 6, 7]  # null texts are empty; rows without a key give way to those with one
    assert kept["near_dedup"] == [0, 0, 1, 1, 2, 3, 4, 7]
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert coded.columns == ["doc_id", "n_tokens", "ids"] and coded.count() == len(rows) and coded.where("doc_id = 1").first()["n_tokens"] == 0


def test_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids"] and 0 < got.count() <= 200


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert set(entry.oracle_sql()) <= set(names)
