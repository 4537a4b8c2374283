import re

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_decide_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "bpe_encoding"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir).cache()
        assert after.columns == docs.columns
        ids, left = {r.doc_id for r in before.collect()}, {r.doc_id for r in after.collect()}
        assert left <= ids and len(left) > 0.7 * len(ids)
        if name == "toxicity":
            assert len([i for i in ids - left if labels.get(i) == 0]) <= 0.05 * len(ids)
        if name == "ngram_jaccard_join":
            assert after.select("text").distinct().count() == after.count()
        if name == "suffix_array_dedup":
            assert left == ids and after.filter(F.length("text") != F.col("n_chars")).count() == 0
        if name == "benchmark_decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            texts = [r.text for r in after.collect()]
            assert not any(i in t for i in items for t in texts)
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir).collect()
    assert {r.doc_id for r in last} == left and all(len(r.ids) == r.n_tokens for r in last)


ROWS = [
    (1, None, 0), (2, "", 0), (3, "a", 1), (None, "b c d e f g", 11), (4, "one two three four five six", 27), (4, "one two three four five six", 27), (5, "one two three four five six", 27),
    (6, "word " * 40_000, 200_000), (7, "What is the boiling point of water at sea level in degrees Celsius, please?", 75), (8, "é\x00 " * 9, 27),
]
KIND = "doc_id long, text string, n_chars long, score double, component_id long, n int, key string, spans string, label int, distance long"


def tables(spark, folder, rows, benchmark, labels):
    docs = spark.createDataFrame([(*r, 0.5, 1, 2, "k", "s", 1, 3) for r in rows], KIND)
    for name, df in (("documents", docs), ("benchmark", spark.createDataFrame(benchmark, "item_id long, text string")), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))):
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path, empty):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns, and tables without rows: each stage has its defined result."""
    items = [] if empty else [(1, "what is the boiling point of water at sea level in degrees celsius, please"), (None, None)]
    folder = tables(spark, tmp_path, [] if empty else ROWS, items, [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        after.write.parquet(path)
        assert name == "bpe_encoding" or after.columns == docs.columns
        docs = spark.read.parquet(path)
        ids.append(sorted(str(r.doc_id) for r in docs.collect()))
    if empty:
        assert ids == [[]] * 5
        return
    every = sorted(str(r[0]) for r in ROWS)
    kept = sorted(["1", "2", "3", "None", "4", "4", "6", "7", "8"])
    assert ids == [every, kept, kept, [i for i in kept if i != "7"], [i for i in kept if i != "7"]]
    told = {str(r.doc_id): r for r in docs.collect()}
    assert told["1"].n_tokens == told["2"].n_tokens == told["6"].n_tokens == 0 and told["4"].n_tokens == 6
    cut = {str(r.doc_id): r for r in spark.read.parquet(f"{folder}/suffix_array_dedup").collect()}
    assert cut["1"].text is None and cut["6"].text == "" and cut["6"].n_chars == 0 and cut["4"].text == ROWS[4][1]


def test_operators_swallow_no_import_errors():
    import inspect
    import pkgutil

    import ledgerlark.llm as llm

    for m in pkgutil.iter_modules(llm.__path__):
        source = inspect.getsource(__import__(f"ledgerlark.llm.{m.name}", fromlist=["x"]))
        assert not re.search(r"except\s*\(?\s*(ImportError|ModuleNotFoundError)", source) and "localCheckpoint" not in source
