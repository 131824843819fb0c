import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from treadle.operators import bands


def brute(numbers, given):
    return sorted(((n, k) for n in numbers for k in ([k for k, lo, hi in given if n is not None and lo is not None and lo <= n and (hi is None or n <= hi)] or [None])),
                  key=str)


@pytest.mark.parametrize("top, node", [(512, 4096), (4, 4), (1, 2)])
def test_bands_of_any_shape(spark, monkeypatch, top, node):
    monkeypatch.setattr(bands, "TOP", top)
    monkeypatch.setattr(bands, "NODE", node)
    own = random.Random(top)
    given = [(k, lo, None if own.random() < 0.1 else lo + own.randint(-1, 12)) for k, lo in enumerate(own.choices(range(60), k=25))] + [(99, None, 5)]
    numbers = [None, -5, 1000, *own.choices(range(-3, 80), k=60)]
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    index = bands.BandIndex(spark, spark.createDataFrame(given, "k int, lo int, hi int"), "lo", "hi")
    got = index.lookup(df, "n", {"band": "k"})
    assert sorted(((r.n, r.band) for r in got.collect()), key=str) == brute(numbers, given)
    assert (len(index.levels) > 1) == (top < 100) and got.columns == ["n", "band"]


def test_fractions_and_no_bands(spark):
    given = spark.createDataFrame([(1, Decimal("0.10"), Decimal("0.20")), (2, Decimal("0.30"), None)], "k int, lo decimal(9,2), hi decimal(9,2)")
    df = spark.createDataFrame([(0.05,), (0.1,), (0.15,), (0.25,), (7.5,)], "v double")
    got = bands.BandIndex(spark, given.selectExpr("k", "cast(lo as double) lo", "cast(hi as double) hi"), "lo", "hi").lookup(df, "v", {"k": "k"})
    assert sorted((r.v, r.k) for r in got.collect() if r.k) == [(0.1, 1), (0.15, 1), (7.5, 2)] and got.count() == 5
    none = bands.BandIndex(spark, given.limit(0), "lo", "hi").lookup(df.selectExpr("cast(v as decimal(9,2)) v"), "v", {"k": "k"})
    assert none.count() == 5 and none.filter("k is not null").count() == 0


def test_a_hundred_thousand_bands_of_one_magnitude(spark):
    n, low = 100_000, 1 << 20
    given = spark.range(n).selectExpr("id as k", f"{low} + id * 8 as lo", f"{low} + id * 8 + 6 as hi")
    numbers = spark.range(4 * n).selectExpr(f"{low} + id * 2 - 3 as v")
    start = time.time()
    got = bands.BandIndex(spark, given, "lo", "hi").lookup(numbers, "v", {"band": "k"})
    wrong = got.filter(f"not (band <=> case when v >= {low} and pmod(v - {low}, 8) <= 6 and (v - {low}) div 8 < {n} then (v - {low}) div 8 end)")
    assert wrong.count() == 0 and time.time() - start < 60


@pytest.mark.parametrize("top, node", [(512, 4096), (4, 4), (1, 2)])
def test_totals_are_those_of_the_pairs(spark, monkeypatch, top, node):
    monkeypatch.setattr(bands, "TOP", top)
    monkeypatch.setattr(bands, "NODE", node)
    own = random.Random(top)
    given = [(k % 20 or None, lo, None if own.random() < 0.1 else lo + own.randint(-1, 12)) for k, lo in enumerate(own.choices(range(60), k=25))] + [(99, None, 5)]
    numbers = [(n, own.choice([None, 1, -7, 1 << 40]), Decimal(own.randint(0, 99)) / 4) for n in [None, -5, 30, 1000, *own.choices(range(-3, 80), k=60)]]
    df = spark.createDataFrame(numbers, "n int, q long, d decimal(9,2)")
    index = bands.BandIndex(spark, spark.createDataFrame(given, "k int, lo int, hi int"), "lo", "hi")
    for rows in (df, df.filter("n = 30"), df.filter("n < -3"), df.limit(0)):
        want = index.lookup(rows, "n", {"band": "k"}).groupBy("band").agg(
            F.count("*").alias("many"), F.sum("q").alias("q"), F.sum("d").alias("d"))
        got = index.totals(rows, "n", {"band": "k"}, "many", {"q": "q", "d": "d"})
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    none = bands.BandIndex(spark, spark.createDataFrame([], "k int, lo int, hi int"), "lo", "hi").totals(df, "n", {"k": "k"}, "many", {})
    assert [tuple(r) for r in none.collect()] == [(None, len(numbers))]
    with pytest.raises(TypeError):
        index.totals(df.selectExpr("n", "cast(q as double) q"), "n", {"band": "k"}, "many", {"q": "q"})


def test_totals_of_bands_that_all_overlap(spark):
    n = 20_000
    index = bands.BandIndex(spark, spark.range(n).selectExpr("id lo", f"id + {n} hi"), "lo", "hi")
    start = time.time()
    got = index.totals(spark.range(2 * n).selectExpr("id v", "1L q"), "v", {"band": "lo"}, "many", {"q": "q"})
    # the pairs are 400 million
    assert [tuple(r) for r in got.groupBy("many", "q").count().collect()] == [(n + 1, n + 1, n)]
    assert time.time() - start < 60
