import datetime as dt
import time

from treadle import session
from treadle.operators import lookup

SHUFFLES = "spark.sql.shuffle.partitions"


def test_shuffles_grow_with_the_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    spark.range(20_000).selectExpr("id", "xxhash64(id) h").repartition(2).write.parquet(f"{path}/t.parquet")
    def settings():
        return {spark.conf.get(session.ADVISORY), spark.conf.get(session.INITIAL, None), spark.conf.get(session.BROADCAST), spark.conf.get(SHUFFLES)}

    before = settings()
    monkeypatch.setattr(session, "SPREAD_BYTES", 4096)
    session.tune(spark, path)
    many = int(spark.conf.get(session.INITIAL))
    assert many > 40 and int(spark.conf.get(session.ADVISORY)) == session.ADVISORY_BYTES
    session.tune(spark, path)  # again: the same
    assert int(spark.conf.get(session.INITIAL)) == many
    monkeypatch.setattr(session, "SPREAD_BYTES", 4 << 20)
    session.tune(spark, path)  # small tables keep what the session has
    assert settings() == before
    session.tune(spark)
    assert settings() == before


def test_broadcasts_are_bounded(spark):
    before = spark.conf.get(session.BROADCAST)
    try:
        for given, bound in (("10485760b", str(2 << 20)), ("256k", "256k"), ("-1", "-1")):
            spark.conf.set(session.BROADCAST, given)
            session._limit(spark, session.BROADCAST, session.BROADCAST_BYTES)
            assert spark.conf.get(session.BROADCAST) == bound
    finally:
        spark.conf.set(session.BROADCAST, before)


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    """They stayed until the driver happened to collect its garbage, so a run of many jobs kept them all."""
    assert session.tune(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {b for b in (str(x) for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.getAllBlocks()))
                    if b.startswith("shuffle_")}
    before = held()
    df = spark.range(1000).selectExpr("id % 10 k").groupBy("k").count()
    df.write.parquet(f"{tmp_path}/t")
    for _ in range(100):  # the files go a moment after the job
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
    assert df.collect() == df.collect() and df.count() == 10  # a frame can be run again


def test_versions_laid_out_over_the_years_are_not_broadcast_by_their_files(spark, tmp_path):
    """A few hundred kilobytes of versions became a broadcast of hundreds of megabytes, built by the driver."""
    D, before = dt.date, spark.conf.get(session.BROADCAST)
    spark.range(400_000).selectExpr("id k", "cast(1 as decimal(18,2)) price", "date'1995-01-01' ValidFromDate", "cast(null as date) ValidToDate").coalesce(
        1).write.parquet(f"{tmp_path}/versions")
    assert (256 << 10) < sum(f.stat().st_size for f in tmp_path.glob("versions/*.parquet")) < 2 << 20
    spark.range(1_000_000).selectExpr("id % 1000 k", "date'1999-05-05' day").write.parquet(f"{tmp_path}/facts")
    try:
        spark.conf.set(session.BROADCAST, "10485760b")
        session._bound_broadcasts(spark)
        assert (spark.conf.get(session.BROADCAST), spark.conf.get(session.MEASURED)) == (str(256 << 10), str(2 << 20))
        session._bound_broadcasts(spark)  # again: the same
        assert (spark.conf.get(session.BROADCAST), spark.conf.get(session.MEASURED)) == (str(256 << 10), str(2 << 20))
        found = lookup.asof_lookup(spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/versions"), {"k": "k"}, "day",
                                   {"price": "price"}, since=D(1995, 1, 1), until=D(2001, 12, 31))
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(session.BROADCAST, before)
        spark.conf.unset(session.MEASURED)
