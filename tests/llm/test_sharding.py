from __future__ import annotations

from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from salesmart.llm import numbering, sharding
from tests.llm.helpers import table


def plain_place(number: int, rows: int, seed: int = sharding.SEED, rounds: int = sharding.ROUNDS) -> int:
    width, height = sharding.sides(rows)
    while True:
        low, high = number % width, number // width
        for k in range(rounds):
            digest = int(sha256(f"{seed}:{k}:{low if k % 2 else high}".encode()).hexdigest()[:15], 16)
            if k % 2:
                high = (high + digest) % height
            else:
                low = (low + digest) % width
        number = high * width + low
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 7, 17, 101, 1000, 1023])
def test_the_permutation_and_its_way_back(spark, rows):
    width, height = sharding.sides(rows)
    assert width * height - rows < width
    moved = sharding.permuted(spark.range(rows).withColumnRenamed("id", "n"), "n", rows, "place")
    back = sharding.permuted(moved, "place", rows, "again", back=True).collect()
    assert {r.n: r.place for r in back} == {n: plain_place(n, rows) for n in range(rows)}
    assert sorted(r.place for r in back) == list(range(rows))
    assert all(r.again == r.n for r in back)


def test_seeds_differ(spark):
    one, two = (
        [r.p for r in sharding.permuted(spark.range(500), "id", 500, "p", seed).orderBy("id").collect()] for seed in (1, 2)
    )
    assert one != two and sum(a == b for a, b in zip(one, two)) < 20


def test_shards_and_slots(spark):
    texts = ["same text", "é中", None, "", "same text"]
    docs = table(spark, [(i % 900, texts[i % 5]) for i in range(1000)] + [(None, "x")])
    found = sharding.assign(docs)
    assert found.columns == ["doc_id", "size", "text_crc32", "number", "shard", "slot"]
    rows = found.collect()
    in_shard = Counter(r.shard for r in rows)
    assert len(rows) == 1001 and set(in_shard) == set(range(8)) and max(in_shard.values()) - min(in_shard.values()) <= 1
    for shard, n in in_shard.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    known = {(len((t or "").encode()) + 1, crc32((t or "").encode())) for t in [*texts, "x"]}
    assert {(r["size"], r.text_crc32) for r in rows} == known
    assert Counter(r.doc_id for r in rows) == Counter(i % 900 for i in range(1000)) + Counter([None])
    by_number = sorted(rows, key=lambda r: r.number)
    assert [r.number for r in by_number] == list(range(1001))
    assert [r.doc_id for r in by_number] == sorted([r.doc_id for r in rows if r.doc_id is not None]) + [None]
    assert all(r.slot * 8 + r.shard == plain_place(r.number, 1001) for r in rows)
    again = sharding.numbers(found.select("shard", "slot", F.col("number").alias("known")), 1001)
    assert again.filter("number <> known").count() == 0
    dealt = sharding.assign(docs.repartition(7)).collect()  # however the rows are dealt out
    key = lambda r: (r.shard, r.slot, r.doc_id, r.text_crc32)
    assert sorted(map(str, map(key, dealt))) == sorted(map(str, map(key, rows)))


def test_more_shards_than_rows_and_no_rows(spark):
    rows = sharding.assign(table(spark, [(1, "a"), (2, "b"), (2, "b")])).collect()
    assert sorted(r.shard for r in rows) == [0, 1, 2] and {r.slot for r in rows} == {0}
    assert sharding.summarise(sharding.assign(table(spark, []))).collect() == []


def test_written_shards_hold_the_shuffle(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", i % 3) for i in range(200)], "doc_id long, text string, extra int")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, shards=4)
    back = spark.read.parquet(path)
    assert back.drop("shard", "slot").exceptAll(docs).isEmpty() and back.count() == 200
    placed = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(docs, shards=4).collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in back.collect()} == placed
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumnRenamed("extra", "slot"), path + "2")


def test_numbers_follow_the_order(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS a", "id AS b").repartition(9)
    found = numbering.numbered(rows, [F.col("a").desc(), F.col("b").asc()]).collect()
    expected = sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.b) for r in sorted(found, key=lambda r: r.number)] == expected
    hot = numbering.numbered(spark.range(3000).selectExpr("0 AS a"), [F.col("a")])
    assert sorted(r.number for r in hot.collect()) == list(range(3000))
    assert numbering.numbered(rows.limit(0), [F.col("a")]).collect() == []


def test_the_plan_has_no_python(spark):
    plan = sharding.summarise(sharding.assign(table(spark, [(1, "a")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
