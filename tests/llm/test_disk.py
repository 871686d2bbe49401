"""What near-duplicate detection leaves on disk while it runs, and that slices of its indexes change nothing."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import jaccard, store


def near_copies(spark, texts: int, copies: int):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 10))) for _ in range(20_000)]
    rows = []
    for i in range(texts):
        text = " ".join(rng.choice(words, 300))
        rows += [(i * copies + k, f"{text} copy{k}") for k in range(copies)]
    return spark.createDataFrame(rows, "doc_id long, text string"), sum(len(t) for _, t in rows)


def size(folder: str) -> int:
    return sum(os.lstat(f"{d}/{f}").st_size for d, _, files in os.walk(folder) for f in files)


def test_tables_of_near_copies(spark, monkeypatch):
    docs, text_bytes = near_copies(spark, 400, 4)
    folder = store.shared_folder(spark).removeprefix("file://")
    before, held = size(folder), []

    def watched(*given):
        out = store.written(*given)
        held.append(size(folder) - before)
        return out

    monkeypatch.setattr(jaccard, "written", watched)
    kept = jaccard.one_per_group(docs)
    assert max(held) < 2.5 * text_bytes
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [4 * i for i in range(400)]


def test_slices_of_indexes(spark, monkeypatch):
    docs, _ = near_copies(spark, 10, 3)
    docs = docs.unionAll(docs.filter("doc_id % 3 = 0").withColumn("text", F.expr("substring(text, 200)")).withColumn("doc_id", F.expr("doc_id + 100")))
    whole = sorted(jaccard.near_duplicates(docs).collect())
    monkeypatch.setattr(jaccard, "LEAST", 1)
    monkeypatch.setattr(jaccard, "KEYS", 4)
    assert sorted(jaccard.near_duplicates(docs).collect()) == whole


def test_shuffle_files_go_with_the_write(spark):
    def shuffles():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}

    before, setting = shuffles(), spark.conf.get(store._CLEANUP, None)
    table = store.written(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(store._CLEANUP, None) == setting
    path = table.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    store.dropped(table, spark.range(3))
    assert os.path.isdir(os.path.dirname(path)) and not os.path.exists(path)
