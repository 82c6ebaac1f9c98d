"""Buckets of many blocks: rows are joined once for each bucket, and only packed blocks meet in pairs."""

import pyarrow as pa
from pyspark.sql import functions as F

from tremorlake.llm import ngram_join


def bucket(spark, n):
    return spark.range(n).select(F.col("id").alias("s1"), (F.col("id") * 7).alias("s2"), F.lit(7).cast("long").alias("leaf"), F.lit(n).cast("long").alias("size"))


def test_sets_of_a_large_bucket_are_one_row_each(spark):
    once = ngram_join.in_blocks(bucket(spark, 1000), 10)
    assert once.count() == 1000
    pairs = ngram_join.block_pairs(once).collect()
    assert len(pairs) == 100 * 100 and len({(r["bi"], r["bj"]) for r in pairs}) == 100 * 101 // 2


def test_every_pair_of_a_large_bucket_meets_once(spark):
    met = []
    found = ngram_join.block_pairs(ngram_join.in_blocks(bucket(spark, 60), 9)).toPandas()
    for _, pair in found.groupby(["leaf", "bi", "bj"]):
        table = ngram_join._opened(pa.Table.from_pandas(pair, preserve_index=False))
        table = table.append_column("leaves", pa.array([[7]] * table.num_rows, pa.list_(pa.int64())))
        mine, ids = ngram_join._owned(table)
        met += [frozenset((int(ids[i, 0]), int(ids[j, 0]))) for i, j in zip(*mine.nonzero(), strict=True)]
    assert len(met) == len(set(met)) == 60 * 59 // 2


def test_links_of_a_large_group_are_whole(spark):
    """400 texts that differ in one of 80 words each are all linked with each other; one block or many."""
    words = [f"w{i}" for i in range(160)]
    texts = [" ".join(words[:i % 150] + [f"new{i}"] + words[i % 150 + 1:]) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[k:k + 5]) for k in range(156)} for t in texts]
    want = [sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for a in sets]
    for block in (32, 512):
        got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in ngram_join.join(docs, block=block).collect()}
        assert got == {i: (n, 0) for i, n in enumerate(want)}
