import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import edge
from compare import DATA, connect, difference
from sedimenta.llm import oracle, queries, sharding


def jump(key: int, shards: int) -> int:
    state, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return b


def test_jump_against_the_published_loop(spark):
    draw = random.Random(2)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(draw.getrandbits(64) - 2**63 for _ in range(2000))]
    df = spark.createDataFrame([(key,) for key in keys], "key long")
    sizes = (1, 2, 16, 17, 1000)
    for row in df.select("key", *[sharding.jump(F.col("key"), n).alias(f"n{n}") for n in sizes]).collect():
        assert tuple(row)[1:] == tuple(jump(row.key, n) for n in sizes)


def test_only_the_new_shard_gains(spark):
    df = spark.range(20_000).select(
        sharding.jump(F.col("id"), 16).alias("a"), sharding.jump(F.col("id"), 17).alias("b")
    )
    rows = df.collect()
    assert all(row.a == row.b or row.b == 16 for row in rows)
    assert 900 < sum(row.b == 16 for row in rows) < 1500
    assert max(Counter(row.a for row in rows).values()) < 1.2 * len(rows) / 16


def test_edge_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 3)
    data = edge.rows() + [(5, "same", None, None, None)] * 10
    folder = edge.folder_of(edge.clashing(edge.frame(spark, data), "shard", "slot", "key"), tmp_path / "in")
    slots, seen = defaultdict(list), []
    for row in queries.op1_sharding(spark, folder).collect():
        slots[row.shard].append(row.slot)
        seen.append((row.doc_id, row["size"], row.text_crc32, row.law, row.shard, row.grown_shard))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    want = []
    for doc_id, text, *_ in data:
        raw = (text or "").encode()
        want.append((doc_id, len(raw) + 1, zlib.crc32(raw), "key", jump(doc_id or 0, 16), jump(doc_id or 0, 17)))
    assert sorted(seen, key=str) == sorted(want, key=str)


def test_a_hot_key_is_spread_over_the_cells(spark):
    df = spark.range(2000).select(F.lit(7).cast("long").alias("key"), F.crc32(F.col("id").cast("string")).alias("crc"))
    cells = df.select(sharding.cell(F.col("key"), F.col("crc"), F.lit(5), 4096).alias("cell")).distinct().count()
    assert cells > 1000


def test_empty_table(spark):
    assert sharding.placed(edge.frame(spark, [])).count() == 0
    assert "shard" in sharding.assign(edge.frame(spark, [])).columns


def test_columns_stay(spark):
    df = edge.clashing(edge.frame(spark), "shard")
    assert dict(sharding.assign(df).dtypes)["shard"] == "int" and sharding.assign(df).count() == df.count()


def test_sql(spark):
    folder = f"{DATA}/sf0.001"
    assert difference(queries.op1_sharding(spark, folder), connect(folder), oracle.SHARDS) is None


def test_no_python_in_the_plan(spark):
    plan = queries.op1_sharding(spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
