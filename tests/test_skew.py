"""Skew-safe formulations equal their single-partition definitions."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitelens.operators import requests as Q
from sitelens.operators import skew as K
from sitelens.session import store


def test_pacing_prefix_equals_single_window(spark):
    # one hot site with most rows, spread over many small sequence buckets
    rows = [("hot" if i % 10 else f"s{i % 7}", i * 3 + (i % 5)) for i in range(3000)]
    log = spark.createDataFrame(rows, "site_id string, seq long")
    sites = spark.createDataFrame([("hot", 4, 0), *[(f"s{j}", 0, 100) for j in range(7)]],
                                  "site_id string, rps int, delay_ms bigint")
    got = {(r.site_id, r.seq): (r.slot, r.offset_ms) for r in Q.pacing_plan(log, sites, bucket=64).collect()}
    ref = log.withColumn("rn", F.row_number().over(Window.partitionBy("site_id").orderBy("seq")) - 1).collect()
    for r in ref:
        interval = 250.0 if r.site_id == "hot" else 100.0
        assert got[(r.site_id, r.seq)] == (r.rn, r.rn * interval)


def test_interval_stats_equal_single_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(milliseconds=37 * i + (i % 3) * 5)) for i in range(2000)]
    rows += [("cold", t0 + dt.timedelta(seconds=s)) for s in (0, 5, 6, 60)]
    log = spark.createDataFrame(rows, "site_id string, fetched_at timestamp")
    got = {r.site_id: r for r in Q.request_intervals(log).collect()}
    for site in ("hot", "cold"):
        ts = sorted(t for s, t in rows if s == site)
        gaps = [(b - a).total_seconds() * 1000 for a, b in zip(ts, ts[1:])]
        assert got[site].n == len(ts)
        assert abs(got[site].min_interval_ms - min(gaps)) < 1e-6
        assert abs(got[site].span_ms - (ts[-1] - ts[0]).total_seconds() * 1000) < 1e-6


def test_one_busy_second_is_split(spark, monkeypatch):
    """90 % of all requests in one second of one site: many parts, none with much more than its share, same numbers."""
    from sitelens.operators import requests
    n = 40_000
    t0 = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    micros = F.when(F.col("id") % 10 > 0, F.col("id") * 7 % 999_983).otherwise(F.col("id") * 60_000_000)
    log = spark.range(n).select(F.lit("hot").alias("site_id"), F.timestamp_micros(F.unix_micros(t0) + micros).alias("fetched_at")).unionByName(
        spark.range(1).select(F.lit("one").alias("site_id"), t0.alias("fetched_at")))
    kept = []
    monkeypatch.setattr(requests, "store", lambda df, name: kept.append(store(df, name)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # as if the requests were many; 4 is the session's number
    got = {r.site_id: r for r in Q.request_intervals(log).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 3 * sum(sizes) / len(sizes)
    ref = log.filter("site_id = 'hot'").withColumn("t", F.unix_micros("fetched_at")).withColumn(
        "gap", F.col("t") - F.lag("t").over(Window.orderBy("t"))).agg(F.min("gap").alias("gap"), (F.max("t") - F.min("t")).alias("span")).first()
    assert (got["hot"].n, got["hot"].span_ms) == (n, ref.span / 1000)
    assert abs(got["hot"].min_interval_ms - ref.gap / 1000) < 1e-3      # epoch milliseconds as doubles
    assert (got["one"].n, got["one"].min_interval_ms, got["one"].avg_interval_ms, got["one"].span_ms) == (1, None, None, 0)


def test_a_hot_key_is_split_over_tasks(spark):
    """One link on 90 % of the pages: no task of the join above its share, same rows as the plain join; left rows are kept."""
    n = 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.range(n).select(F.lit("s").alias("site_id"), F.col("id").cast("string").alias("page"),
                                      F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("link"))
        status = links.select(F.col("site_id").alias("_s"), F.col("link").alias("_k")).distinct().filter("_k <> 'k0'") \
            .withColumn("code", F.length("_k"))
        hot = K.hot_keys(links, ["site_id", "link"], least=100)
        assert [r._salts for r in hot.collect()] == [116]      # 18,000 rows, 156.25 a salt
        for how in ("inner", "left"):
            got = K.spread_join(links, status, ["site_id", "link"], ["_s", "_k"], ["page"], hot, how)
            plain = links.join(status, (F.col("site_id") == F.col("_s")) & (F.col("link") == F.col("_k")), how)
            assert got.columns == plain.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 4 and max(sizes) < 1.6 * n / 4
            assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) > 0.85 * n
        none = K.hot_keys(links.filter("link <> 'hot'"), ["site_id", "link"], least=100)
        assert none.isEmpty() and K.hot_keys(links.limit(0), ["site_id", "link"]).isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_site_is_split_over_tasks(spark):
    """One site with 90 % of the rows meets its options in all tasks."""
    n = 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(n).select(F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 70)).alias("site_id"), "id")
        site = rows.select("site_id").distinct().withColumn("limit", F.length("site_id"))
        assert "BroadcastHashJoin" in K.with_site(rows, site, ["id"])._jdf.queryExecution().executedPlan().toString()
        got = K.with_site(rows, site, ["id"], chars=100)
        assert got.columns == ["site_id", "id", "limit"]
        assert got.exceptAll(rows.join(site, "site_id")).isEmpty() and got.count() == n
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1.6 * n / 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
