"""Stages keep all columns of the caller, also those called like a column of their own."""

import pytest
from fixture_texts import text

from vejrkraft.llm import decontaminate, importance, jaccard_tree, passages
from vejrkraft.llm.names import shield

OWN = ["_key", "_N_grams", "_log_weight", "_node", "_spans", "_row_id", "_row_hash", "_id", "_hash", "_k_doc_id", "set_id", "label"]


def _docs(spark):
    rows = [(i, text(80 + i, i % 9), *[f"{c}{i}" for c in OWN]) for i in range(30)]
    fields = ", ".join(f"`{c}` string" for c in OWN)
    return spark.createDataFrame(rows, f"doc_id long, text string, {fields}")


def _labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")


@pytest.mark.parametrize(
    "stage",
    [
        lambda spark, docs: importance.select_documents(docs, _labels(spark)),
        lambda spark, docs: jaccard_tree.one_per_class(docs),
        lambda spark, docs: passages.cut_passages(docs),
        lambda spark, docs: decontaminate.decontaminate(
            docs, spark.createDataFrame([(1, "no such item anywhere here")], "item_id long, text string")
        ),
    ],
)
def test_clashing_columns_survive(spark, stage):
    docs = _docs(spark)
    before = {r["doc_id"]: [r[c] for c in OWN] for r in docs.collect()}
    out = stage(spark, docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all([r[c] for c in OWN] == before[r["doc_id"]] for r in kept)


def test_shield(spark):
    docs = spark.createDataFrame([(1, 2, 3)], "_A int, _a_ int, b int")
    hidden, now, back = shield(docs, "_a", "c")
    assert now == {"_A": "_A__", "_a_": "_a_", "b": "b"} and hidden.columns == ["_A__", "_a_", "b"]
    assert back(hidden.withColumn("_a", hidden["b"])).columns == ["_A", "_a_", "b", "_a"]
    same, now, back = shield(docs, "z")
    assert same.columns == docs.columns == back(same).columns


def test_covering_chains():
    import numpy as np

    chains = [np.array(c) for c in ([[0, 5, 60]], [[10, 0, 20], [35, 25, 20]], [[40, 9, 40]], [[100, 0, 9]], [[0, 5, 60]])]
    assert passages.covering(chains) == [False, True, False, True, True], "the fourth has fewer words than may be left out"


def test_open_words_of_spans(spark):
    rows = [([], 3, 9), (None, 0, 5), ([(0, 4), (2, 6), (8, 9), (20, 30)], 3, 12), ([(5, 7), (5, 6), (7, 9)], 0, 20), ([(0, 100)], 4, 9)]
    df = spark.createDataFrame(rows, "spans array<struct<start: int, end: int>>, begin int, end int")
    merged = df.withColumn("m", passages._merged(df["spans"]))
    got = merged.select("m", passages._open_words(merged["begin"], merged["end"], merged["m"]).alias("n")).collect()
    assert [r["n"] for r in got] == [6, 5, 5, 16, 0]
    assert [tuple(x) for x in got[2]["m"]] == [(0, 6), (8, 9), (20, 30)] and [tuple(x) for x in got[3]["m"]] == [(5, 9)]
