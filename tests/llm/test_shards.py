import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tastegraph.llm import shards
from tastegraph.llm.queries import op2_shards


def brute(hashes, limit):
    """Split one bucket at a time: hash and size of each row → bits of its bucket."""
    out, todo = {}, [("", list(hashes))]
    while todo:
        name, rows = todo.pop()
        if sum(b for _, b, _ in rows) <= limit or len(name) == 64:
            for _, _, n in rows:
                out[n] = name or "-"
            continue
        for bit in "01":
            own = [r for r in rows if format(r[0] % (1 << 64), "064b")[len(name)] == bit]
            if own:
                todo.append((name + bit, own))
    return out


@pytest.mark.parametrize("cell_bits", [3, 12, 64])
def test_equals_splitting_one_bucket_at_a_time(spark, cell_bits):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 300), i) for i in range(700)] + [(1000, "y" * 5000, 1), (None, None, 2), (1001, "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long")
    limit = 3000
    hashed = docs.select("doc_id", F.xxhash64("doc_id").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()
    want = brute([(r.h, r.n + shards.ROW_BYTES, r.doc_id) for r in hashed], limit)
    got = shards.shards(docs, F.col("doc_id"), limit=limit, cell_bits=cell_bits).collect()
    assert len(got) == len(rows)
    held = defaultdict(int)
    for r in got:
        name = r.shard.split(".")[0]
        assert name == want[r.row.doc_id] and r.depth == (0 if name == "-" else len(name))
        held[r.shard] += r.row_bytes
    for r in got:
        assert held[r.shard] == r.shard_bytes
        assert r.shard_bytes <= limit or (r.row.doc_id == 1000 and r.row_bytes == r.shard_bytes)


def test_one_key_with_most_rows_is_paged(spark):
    rows = [(i % 7 if i % 3 else 1, "z" * (i % 50)) for i in range(900)] + [(1, "w" * 4000)] * 3
    docs = spark.createDataFrame(rows, "source long, text string")
    got = shards.shards(docs, F.col("source"), limit=2000).collect()
    held = defaultdict(list)
    for r in got:
        held[r.shard].append(r.row_bytes)
    assert len(got) == len(rows)
    assert all(sum(v) <= 2000 or len(v) == 1 for v in held.values())
    assert len(held) < 4 * sum(map(sum, held.values())) / 2000


def test_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * 100, "a") for i in range(60)], "doc_id long, text string, depth string")
    shards.write_shards(docs, f"{tmp_path}/out", F.col("doc_id"), limit=1000)  # 8 rows of 116 bytes
    back = spark.read.schema("row struct<doc_id:long,text:string,depth:string>, shard string").parquet(f"{tmp_path}/out")
    assert sorted(tuple(r) for r in back.select("row.*").collect()) == sorted(tuple(r) for r in docs.collect())
    assert back.groupBy("shard").agg(F.sum(F.length("row.text") + 16).alias("n")).where("n > 1000").count() == 0


def test_small_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.shard, r.depth) for r in shards.shards(docs, F.col("doc_id")).collect()] == [("-", 0)]
    assert shards.shards(docs.limit(0), F.col("doc_id")).count() == 0


def test_query(spark, tmp_path):
    docs = spark.createDataFrame([(i, None if i == 5 else "t" * i) for i in range(100)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_shards(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(100)) and {r.shard for r in got} == {"-"}
