"""Training order by a keyed permutation: a bijection with an inverse, without sorts, and resumable batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokloom.operators import order as O, pack


def by_hand(x, n, seed, epoch):
    for k, a, b, c, d in O.round_keys(n, seed, epoch):
        y = (k - x) % n
        m = max(x, y)
        h = (m % O.PRIME * c + m // O.PRIME * d + b) % O.PRIME
        if (h * h % O.PRIME * (h * h % O.PRIME) + a) % O.PRIME // 65536 % 2:
            x = y
    return x


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_places_are_a_permutation(spark, n):
    rows = O.place_of(spark.range(n).withColumnRenamed("id", "example_id"), n, 7, 3).collect()
    for epoch in range(3):
        got = {r["example_id"]: r["r"] for r in rows if r["epoch"] == epoch}
        assert got == {x: by_hand(x, n, 7, epoch) for x in range(n)} and sorted(got.values()) == list(range(n))
    ids = O.batch_ids(spark, n, 4, 7, 1).collect()
    places = {r["example_id"]: r["r"] for r in rows if r["epoch"] == 1}
    assert all(places[r["example_id"]] == 4 * r["step"] + r["slot"] for r in ids) and len(ids) == n


def test_large_numbers(spark):
    n = (1 << 49) + 12345
    some = [0, 1, 5, n - 1, n // 2, 1 << 40]
    df = spark.createDataFrame([(x,) for x in some], "example_id long")
    placed = O.place_of(df, n, 3)
    got = {r["example_id"]: r["r"] for r in placed.collect()}
    assert got == {x: by_hand(x, n, 3, 0) for x in some}
    back = O.example_at(placed.select("r"), n, 3)
    assert {r["example_id"] for r in back.collect()} == set(some)


def test_epochs_are_shuffled(spark):
    n = 4000
    rows = O.place_of(spark.range(n).withColumnRenamed("id", "example_id"), n, 7, 2).toPandas()
    a, b = (rows[rows.epoch == e].sort_values("example_id").r.to_numpy() for e in (0, 1))
    for x in (a, b):
        assert abs(((x - x.mean()) * (np.arange(n) - (n - 1) / 2)).mean() / x.var()) < 0.06  # unlike the input
        assert abs((x[1:] == x[:-1] + 1).sum()) < 12
    assert (a == b).sum() < 12


def test_no_shuffle_in_the_plan(spark):
    placed = pack.batches(O.place_of(spark.range(100).withColumnRenamed("id", "example_id"), 100, 7, 5), 8)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_resume_opens_no_earlier_folder(spark):
    n = 200
    rows = pack.batches(O.place_of(spark.range(n).withColumnRenamed("id", "example_id"), n, 7, 3), 8)
    table, _ = O.store_batches(rows.select("epoch", "step", "slot", "example_id"), chunk_steps=4)
    key = lambda r: (r["epoch"], r["step"], r["slot"])
    whole = sorted(map(key, table.collect()))
    assert len(whole) == 3 * n
    for epoch, step in ((0, 0), (0, 7), (1, 24), (2, 25), (3, 0)):
        tail = O.resume(table, epoch, step, chunk_steps=4)
        assert sorted(map(key, tail.collect())) == [k for k in whole if k[:2] >= (epoch, step)]
    tail = O.resume(table, 1, 9, chunk_steps=4)
    read = tail.select(F.input_file_name().alias("f")).distinct().collect()
    assert not any("epoch=0/" in r["f"] or "epoch=1/chunk=0/" in r["f"] or "epoch=1/chunk=1/" in r["f"] for r in read)
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((epoch" in plan or "PartitionFilters: [(" in plan


def test_many_places_take_no_interpreted_rounds(spark):
    n = 40_000
    placed = O.place_of(spark.range(n).withColumnRenamed("id", "example_id"), n, 7, 10)
    assert "aggregate(" not in placed._jdf.queryExecution().executedPlan().toString()
    odd = O.place_of(spark.createDataFrame([(None,), (3,)], "example_id int"), 5, 7, 2)
    rows = {(r["epoch"], r["example_id"]): r["r"] for r in odd.collect()}
    assert rows == {(e, x): None if x is None else by_hand(x, 5, 7, e) for e in (0, 1) for x in (None, 3)}
    assert [f.dataType.simpleString() for f in odd.schema.fields] == ["int", "int", "bigint"]
