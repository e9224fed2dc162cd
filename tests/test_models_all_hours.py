"""Gram partials, rank-revealing fits and all hours in one pass."""

import numpy as np
from pyspark.sql import functions as F

from hourprofile.operators import model as M
from hourprofile.operators import score as SC


def design(spark, n=4000, parts=3):
    rows = spark.range(n).select(
        F.array((F.col("id") % 3).cast("int"), (F.col("id") % 2 + 3).cast("int")).alias("positions"),
        F.array(*[F.pmod(F.xxhash64("id", F.lit(h)), F.lit(20_000_000)) - 5_000_000 for h in range(24)]).alias("qlogs"))
    return rows.repartition(parts).withColumn("logs", F.transform("qlogs", lambda q: q / F.lit(1e6)))


def entries(df):
    return {(r.i, r.j): r.g for r in df.collect()}


def test_exact_gram_does_not_depend_on_partitions(spark):
    first = entries(M.gram(design(spark, parts=1), 5, exact=True))
    assert first == entries(M.gram(design(spark, parts=13), 5, exact=True))
    rough = entries(M.gram(design(spark, parts=7), 5))
    assert first.keys() == rough.keys() and all(abs(first[k] - rough[k]) <= 1e-6 + 1e-9 * abs(first[k]) for k in first)


def test_one_row_a_task_crosses_the_shuffle(spark):
    for k in (5, 200):  # whatever the width
        partials = M.gram_partials(design(spark, parts=9), k, exact=True)
        assert partials.count() == 9
        assert {r.salt for r in partials.select("salt").collect()} <= set(range(4))


def test_empty_design(spark):
    assert M.gram(design(spark, n=0), 5).count() == 0


def test_limbs_carry():
    big = np.array([[1 << 30], [(1 << 31) - 1]], np.int64)
    total = M._added(iter([big] * 5), exact=True)
    assert (int(total[0, 0]) << 31) + int(total[1, 0]) == 5 * (((1 << 30) << 31) + (1 << 31) - 1) and total[1, 0] < 1 << 31


def test_rank_and_unique_results():
    rng = np.random.default_rng(2)
    onehot = np.eye(4)[rng.integers(0, 4, 300)]
    x = np.hstack([onehot, onehot[:, :1] * 2, rng.normal(size=(300, 3)), np.ones((300, 1)), np.zeros((300, 1))])
    y = rng.normal(size=300)
    w, rank, rss = M.normal_equations(x.T @ x, x.T @ y, y @ y)
    best, _, want, _ = np.linalg.lstsq(x, y, rcond=None)
    assert rank == want == 7
    assert np.allclose(x @ w, x @ best) and np.isclose(rss, ((y - x @ best) ** 2).sum())


def test_all_hours_equal_each_hour(spark):
    d = design(spark, 40).withColumn("id", F.monotonically_increasing_id())
    models = M.rule_models(spark, 5)
    every = M.predict_hours(d, models, 2, back_transform=False)
    assert every.count() == 40 * 24
    for h in (0, 8, 23):
        one = M.predict(d, models, h, n_positions=2, back_transform=False)
        assert sorted(r.predicted for r in every.where(F.col("hour") == h).collect()) == sorted(r.predicted for r in one.collect())


def test_profile_hours_unfold_after_the_lookup(spark):
    live = spark.createDataFrame([("a", list(range(24))), ("z", [1] * 24)], "sid string, volumes array<long>")
    profile = spark.createDataFrame([("a", "l", 1.0, 2.0, lane, "Y", *[float(h * lane) for h in range(24)]) for lane in (1, 2)],
                                    ["id", "location", "latitude", "longitude_w", "lanes", "highway", *[f"avgvolume{h:02d}" for h in range(24)]])
    out = SC.attach_profile_hours(live, profile).collect()
    assert sorted((r.lanes, r.hour, r.volume, r.historical) for r in out) == [(lane, h, h, float(h * lane)) for lane in (1, 2) for h in range(24)]
