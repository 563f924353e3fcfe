"""The pipeline from end to end on made rows, with a plain account of what must go and what must stay."""

import random

import pytest
from fixture_texts import edited, words

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, _node string, _row_id long"


@pytest.fixture
def folder_of_tables(spark, tmp_path):
    rng = random.Random(3)
    item = words(30, 900)
    passage = words(70, 901)
    texts, kind = {}, {}
    for i in range(120):
        texts[i] = words(rng.randrange(120, 260), i)
        kind[i] = "clean"
    for i in range(120, 130):  # near copies of documents 0 to 9
        texts[i], kind[i] = edited(texts[i - 120], 0.005, i), "copy"
    for i in (130, 131):
        texts[i], kind[i] = words(150, i) + item + words(20, 500 + i), "leak"
    for i in (132, 133, 134):
        texts[i], kind[i] = words(100, i) + passage + words(60, 600 + i), "passage"
    junk = "### $$$ *** %%% !!! ??? ~~~ ^^^ @@@ ___".split()
    for i in range(135, 175):
        texts[i], kind[i] = [rng.choice(junk) + str(rng.randrange(9)) for _ in range(150)], "junk"
    rows = [
        (i, " ".join(t), "en", "a" if i % 3 else "b", len(" ".join(t)), f"k{i}", f"n{i}", 777) for i, t in texts.items()
    ]
    rows += [(500, None, "en", "a", None, None, None, None), (501, "", None, None, 0, "k", "n", 1), rows[5], rows[5]]
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(kind[i] != "junk"), 0) for i in texts if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, kind, " ".join(passage)


def test_stages_decide_and_keep_columns(spark, folder_of_tables):
    folder, texts, kind, passage = folder_of_tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "mixing sources",
    ]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = f"{folder}/stage-{i}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        seen[name] = docs.collect()
    ids = lambda name: {r["doc_id"] for r in seen[name]}
    clean = {i for i, k in kind.items() if k == "clean"}
    judged = ids("quality classifier")
    assert clean <= judged and not {i for i, k in kind.items() if k == "junk"} & judged
    single = ids("n-gram Jaccard join")
    assert clean <= single and not {i for i, k in kind.items() if k == "copy"} & single
    assert sum(r["doc_id"] == 5 for r in seen["n-gram Jaccard join"]) == 1
    cut = seen["substring dedup"]
    assert sum(passage in r["text"] for r in cut if r["text"]) == 1 and {r["doc_id"] for r in cut} == single
    left = ids("benchmark decontamination")
    assert left == single - {i for i, k in kind.items() if k == "leak"}
    for r in seen["benchmark decontamination"]:
        if r["doc_id"] in kind:
            assert (r["_key"], r["_node"], r["_row_id"]) == (f"k{r['doc_id']}", f"n{r['doc_id']}", 777)
            assert r["n_chars"] == len(r["text"])
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in seen["benchmark decontamination"]}
    assert mixed and all(0 < r["taken"] <= 3 * size[r["doc_id"]] for r in mixed)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in whole) == sorted((r["doc_id"], r["taken"]) for r in mixed)
