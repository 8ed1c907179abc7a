import math

import numpy as np
from pyspark.sql import functions as F

from tokloom.operators import lmstats as M, regress as R, vectors as V


def test_means(spark):
    df = spark.createDataFrame([(0, [10.0, 20.0, 30.0]), (1, [5.0, 10.0, 15.0])],
                               "row int, v array<double>")
    assert V.global_mean(df, "v").first()["mean"] == 15.0
    cols = {r["pos"]: r["mean"] for r in V.column_means(df, "v").collect()}
    assert cols == {0: 7.5, 1: 15.0, 2: 22.5}
    rows = [r["m"] for r in df.orderBy("row").select(V.row_mean(F.col("v")).alias("m")).collect()]
    assert rows == [20.0, 10.0]


def test_standardize_sums_a_vector_a_fixed_number_of_times(spark):
    import time
    rnd = np.random.default_rng(3)
    rows = [[float(x) for x in rnd.normal(size=n)] for n in (1, 2, 7, 300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*rows, [], None, [1.0, None]])], "i int, v array<double>")
    got = {r["i"]: r["z"] for r in df.select("i", V.standardize(F.col("v")).alias("z")).collect()}
    for i, v in enumerate(rows):
        assert np.allclose(got[i], (np.array(v) - np.mean(v)) / np.sqrt(np.var(v) + 1e-5), rtol=1e-12, atol=1e-12)
    assert got[4] == [] and got[5] is None and got[6] == [None, None]
    long = spark.createDataFrame([([float(x) for x in rnd.normal(size=3000)],)], "v array<double>")
    at = time.time()                      # 3,000 sums of 3,000 squares, each with a mean of its own, take minutes
    z, std = long.select(V.standardize(F.col("v")), V.row_std(F.col("v"))).first()
    assert time.time() - at < 20 and abs(np.mean(z)) < 1e-9 and abs(np.std(z) - 1) < 1e-4 and abs(std - 1) < 0.1


def test_argmax_gather_product(spark):
    df = spark.createDataFrame([([10, 0, 5, 20, 1],), ([1, 30, 3, 5, 0],)], "v array<int>")
    assert [r[0] for r in df.select(V.argmax_index(F.col("v"))).collect()] == [3, 1]
    g = spark.createDataFrame([([10, 11, 12, 13], 2), ([20, 21, 22, 23], 0), ([30, 31, 32, 33], 3)],
                              "v array<int>, i int")
    assert [r[0] for r in g.select(V.gather(F.col("v"), F.col("i"))).collect()] == [12, 20, 33]
    e = spark.createDataFrame([([1, 2], [10, 20]), ([3, 4], [30, 40])], "a array<int>, b array<int>")
    assert [r[0] for r in e.select(V.elementwise_product(F.col("a"), F.col("b"))).collect()] == \
        [[10.0, 40.0], [90.0, 160.0]]


def test_matmul(spark):
    a = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [4.0, 5.0, 6.0])], "i int, v array<double>")
    b = spark.createDataFrame([(0, [7.0, 9.0, 11.0]), (1, [8.0, 10.0, 12.0])], "j int, column array<double>")
    wanted = {(0, 0): 58.0, (0, 1): 64.0, (1, 0): 139.0, (1, 1): 154.0}
    got = V.matmul_small(a, b, "i", "v").collect()
    assert {(r["i"], r["j"]): r["score"] for r in got} == wanted
    wide = b.select("j", F.posexplode("column").alias("pos", "w"))
    got = V.matmul(V.coordinates(a, "i", "v"), wide, "i").collect()
    assert {(r["i"], r["j"]): r["score"] for r in got} == wanted


def test_lookup_keeps_and_reports_unknown_ids(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (9,)], "id int")
    table = spark.createDataFrame([(1, [0.5]), (3, [1.0])], "key int, v array<double>")
    out = V.lookup(ids, table, "id", "key")
    assert sorted((r["id"], r["v"]) for r in out.collect() if r["v"]) == [(1, [0.5])] and out.count() == 4
    assert sorted(tuple(r) for r in V.missing_ids(out, "id", "key").collect()) == [(2, 2), (9, 1)]


def test_crop_and_completion(spark):
    df = spark.createDataFrame([([1, 2, 3], [1])], "ids array<int>, p array<int>")
    assert df.select(M.crop(F.col("ids"), 5)).first()[0] == [1, 2, 3]
    assert df.select(M.crop(F.col("ids"), 2)).first()[0] == [2, 3]
    assert df.select(M.completion(F.col("ids"), F.col("p"))).first()[0] == [2, 3]


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "z", 0.5)],
                               "g string, item string, s double")
    w = M.temperature_softmax(df, "s", ["g"], 0.8)
    sums = {r["g"]: r["t"] for r in w.groupBy("g").agg(F.sum("w").alias("t")).collect()}
    assert all(abs(v - 1.0) < 1e-12 for v in sums.values())
    one = M.gumbel_sample(df, "item", "s", ["g"], 0.8, 7).collect()
    assert len(one) == 2


def test_bigram_probabilities_normalise(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (2, 1)], "x int, y int")
    p = M.bigram_probs(M.bigram_counts(pairs), alpha=0.0)
    tot = {r["x"]: r["t"] for r in p.groupBy("x").agg(F.sum("p").alias("t")).collect()}
    assert all(abs(v - 1.0) < 1e-12 for v in tot.values())


def test_linear_fit_recovers_line(spark):
    df = R.synthetic_line(spark, 20000, seed=5)
    r = R.linear_fit(df, "y", "x").first()
    assert math.isclose(r["slope"], 2.0, abs_tol=0.01)
    assert math.isclose(r["intercept"], 1.0, abs_tol=0.01)
    assert R.mse(df, "y", "x").first()["mse"] < 0.02


def test_errors_of_large_values_do_not_cancel(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    y = 3 * x + rng.normal(size=2000) * 0.01
    rows = [(g, float(a) + 1e9, float(b) + 1e9) for g in (None, "g") for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    big_x, big_y = np.array([r[1] for r in rows[:2000]]) - 1e9, np.array([r[2] for r in rows[:2000]]) - 1e9
    slope, cut = np.polyfit(big_x, big_y, 1)
    want = ((slope * big_x + cut - big_y) ** 2).mean()
    got = {r["g"]: r["mse"] for r in R.mse(df, "y", "x", ["g"]).collect()}
    assert set(got) == {None, "g"} and all(abs(v / want - 1) < 1e-4 for v in got.values())
    assert abs(R.mse(df, "y", "x").first()["mse"] / want - 1) < 1e-4
    assert R.mse(df.withColumn("x", F.lit(1.0)), "y", "x").first()["mse"] is None


def test_prediction(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, 1.0), (None, 0.0, 1.0), (None, 1.0, 0.0)],
                               "g string, x double, y double")
    got = R.predict(df, R.linear_fit(df, "y", "x", ["g"]), "x", ["g"]).collect()
    assert {(r["g"], r["x"], r["prediction"]) for r in got} == {
        ("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, None), (None, 0.0, 1.0), (None, 1.0, 0.0)}
    one = df.filter("g = 'a'")
    assert [r["prediction"] for r in R.predict(one, R.linear_fit(one, "y", "x"), "x").orderBy("x").collect()] == [2, 4]


def test_tiled_product(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(23, 57)), rng.normal(size=(57, 11))
    a[rng.random(a.shape) < 0.5] = 0
    cells = lambda m: [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    left = spark.createDataFrame(cells(a), "i long, k long, v double").repartition(5)
    right = spark.createDataFrame(cells(b), "k long, j long, v double").repartition(3)
    for block in (1, 8, 64):
        got = np.zeros((23, 11))
        for r in V.matmul_tiled(left, right, block).collect():
            got[r["i"], r["j"]] = r["score"]
        assert np.allclose(got, a @ b)
    assert V.matmul_tiled(left.limit(0), right).count() == 0


def test_lookup_of_hot_ids(spark):
    table = spark.createDataFrame([(k, [float(k)] * 4) for k in range(50)] + [(7, [0.5] * 4)], "vec_id int, e array<double>")
    ids = [(p, 0 if p % 2 else p % 60) for p in range(3000)] + [(9999, None)]
    rows = spark.createDataFrame(ids, "pos int, id int").repartition(6)
    for hot in (1, 3, 4096):
        got = sorted((r["pos"], r["id"], r["e"][0] if r["e"] else None) for r in
                     V.lookup(rows, table, "id", "vec_id", hot).collect() if r["id"] is not None)
        want = sorted((p, i, v) for p, i in ids if i is not None
                      for v in ([7.0, 0.5] if i == 7 else [float(i)] if i < 50 else [None]))
        assert str(got) == str(want)
        assert V.lookup(rows, table, "id", "vec_id", hot).filter("pos = 9999 and vec_id is null").count() == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = V.lookup(rows, table, "id", "vec_id", 1)
        sizes = [r["count"] for r in big.filter("id <> 0").groupBy(F.spark_partition_id()).count().collect()]
        zero = big.filter("id = 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the hottest id is not in one partition: its rows stay where they are read (small files share a partition)
    assert zero > 1 and sum(sizes) > 1000
