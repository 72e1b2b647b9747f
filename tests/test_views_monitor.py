"""Serving views, documents, monitoring checks and column helpers."""

import json

from pyspark.sql import functions as F

from tickwise.functions import arrays as A
from tickwise.functions import scalar as fn
from tickwise.operators import documents as DOC
from tickwise.operators import monitor as MON
from tickwise.operators import stats
from tickwise.operators import views as VW


def test_formats_and_dash(spark):
    df = spark.createDataFrame([(1234.5, -1.234, 1704067200), (None, None, 1704070800)], "x double, c double, t long")
    r = df.select(fn.fmt_number("x").alias("a"), fn.fixed(F.abs("c"), 2).alias("b"), fn.direction("c").alias("d"),
                  fn.time_label(F.timestamp_seconds("t")).alias("l"), fn.hour_label(F.hour(F.timestamp_seconds("t"))).alias("h"),
                  fn.iso_utc(F.col("t").cast("double")).alias("i")).collect()
    assert tuple(r[0]) == ("1,234.5", "1.23", "down", "01/01 00:00", "0:00", "2024-01-01T00:00:00+00:00")
    assert tuple(r[1])[:3] == ("—", "—", None)


def test_array_helpers(spark):
    r = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "a array<double>").select(
        A.tail(F.col("a"), 2).alias("t"), A.tail(F.col("a"), 9).alias("t9"), A.arr_mean(F.col("a")).alias("m"),
        A.arr_pop_std(F.col("a")).alias("s"), A.nth_from_end(F.col("a"), 5, F.lit(-1.0)).alias("n5")).first()
    assert r.t == [3.0, 4.0] and r.t9 == [1.0, 2.0, 3.0, 4.0] and r.m == 2.5
    assert abs(r.s - 1.118033988749895) < 1e-12 and r.n5 == -1.0


def _object(doc):
    return json.loads("".join(r.value for r in DOC.document_lines(doc).collect()))


def test_document_of_many_rows_over_many_files_is_one_object(spark, tmp_path):
    """No row limit; repeated rows stay; members are in order across part files."""
    rows = spark.range(120_000).select((F.col("id") % 100_000).alias("k"), F.lit('a "quoted" \n line').alias("t"))
    DOC.write_document(DOC.combined_document({"r": (rows, [-F.col("k")]), "none": rows.limit(0)}), str(tmp_path / "d"))
    parts = sorted((tmp_path / "d").glob("part-*.txt"))
    d = json.loads("".join(p.read_text() for p in parts))
    assert [r["k"] for r in d["r"]] == sorted((i % 100_000 for i in range(120_000)), reverse=True)
    assert d["none"] == [] and d["r"][0]["t"] == 'a "quoted" \n line'


def test_combined_document_is_valid_json_with_nulls(spark):
    ev = spark.createDataFrame([("BTC", 1.0, 0.5, "2026-05-04 07:00:00"), ("ETH", 2.0, -0.5, "2026-05-04 08:00:00"),
                                ("ETH", 4.0, 1.5, "2026-05-04 08:30:00")],
                               "symbol string, price_usd double, change_24h double, event_ts string") \
        .withColumn("event_ts", F.to_timestamp("event_ts"))
    doc = DOC.combined_document({"statistik": (stats.price_stats(ev), [-F.col("rata_rata_usd")]),
                                 "volatilitas": stats.hourly_volatility(ev),
                                 "berita": stats.hourly_news_count(ev.limit(0))})
    d = _object(doc)
    assert [r["symbol"] for r in d["statistik"]] == ["ETH", "BTC"]
    assert d["statistik"][1]["std_deviasi"] is None           # single row: null, not NaN (R10)
    assert d["berita"] == []
    assert {(r["jam"], r["symbol"]) for r in d["volatilitas"]} == {(7, "BTC"), (8, "ETH")}


def test_forecast_views(spark):
    res = spark.createDataFrame(
        [("BTC", [("2026-05-04T07:00:00+00:00", 10.0), ("2026-05-04T07:01:00+00:00", 11.0)],
          [("2026-05-04T07:02:00+00:00", 12.0)], ("LinearRegression", 0.5, 0.1))],
        "symbol string, history array<struct<timestamp:string,price:double>>, "
        "forecast array<struct<timestamp:string,price:double>>, model struct<name:string,r2:double,mae:double>")
    al = {r.position: r for r in VW.series_align(res).collect()}
    assert al[1].forecast_price is None and al[2].forecast_price == 11.0 and al[2].history_price == 11.0
    assert al[3].series == "forecast" and al[3].history_price is None and al[3].label == "05/04 07:02"
    s = VW.forecast_summary(res).first()
    assert (s.delta, s.direction, s.history_points, s.forecast_points, s.r2_text) == (1.0, "up", 2, 1, "0.5000")
    d = _object(DOC.forecast_document(res))
    assert d["BTC"]["model"]["name"] == "LinearRegression" and len(d["BTC"]["history"]) == 2


def test_freshness_and_root_cause(spark):
    lu = spark.createDataFrame([("live_api", "2026-05-04 07:58:00"), ("live_rss", "2026-05-04 07:40:00"),
                                ("spark_results", "2026-05-04 07:00:00")], "name string, last_ts string") \
        .withColumn("last_ts", F.to_timestamp("last_ts"))
    now = F.lit("2026-05-04 08:00:30").cast("timestamp")
    fr = MON.freshness(lu, now, expected=["live_api", "live_rss", "spark_results", "forecast"])
    got = {r.name: (r.age_min, r.status) for r in fr.collect()}
    assert got == {"live_api": (2, "ok"), "live_rss": (20, "warn"), "spark_results": (60, "stale"), "forecast": (None, "fail")}
    vol = spark.createDataFrame([("live_rss", 0), ("spark_results", 5)], "name string, messages long")
    rc = {r.name: r.cause for r in MON.root_cause(fr, vol).collect()}
    assert rc == {"live_api": "healthy", "live_rss": "producer", "spark_results": "consumer", "forecast": "producer"}


def test_error_lines_last_three_of_last_fifty(spark):
    lines = [("c1", i, "all good" if i % 2 else f"Traceback step {i}") for i in range(100)]
    lines += [("c2", 1, "nothing"), ("c3", 1, "FAILED once")]
    df = spark.createDataFrame(lines, "source string, t long, line string")
    out = MON.error_lines(df).collect()
    assert sorted((r.source, r.t) for r in out) == [("c1", 94), ("c1", 96), ("c1", 98), ("c3", 1)]


def test_served_data_merges_documents(spark):
    ev = spark.createDataFrame([("BTC", 1.0, 0.5, "2026-05-04 07:00:00")],
                               "symbol string, price_usd double, change_24h double, event_ts string") \
        .withColumn("event_ts", F.to_timestamp("event_ts"))
    res = {"statistik": stats.price_stats(ev)}
    live = ev.select("symbol", "price_usd")
    news = spark.createDataFrame([("id1", "t")], "article_id string, title string")
    d = _object(DOC.served_data(res, live, news))
    assert d["spark"]["statistik"][0]["symbol"] == "BTC" and d["live"][0]["price_usd"] == 1.0
    assert d["news"] == [{"article_id": "id1", "title": "t"}]
    empty = _object(DOC.served_data(None, live.limit(0), news))
    assert empty["spark"] == [] and empty["live"] == []


def test_freshness_from_output_files(spark, tmp_path):
    import os
    import time
    d = tmp_path / "live_api"
    d.mkdir()
    f = d / "part-0.json"
    f.write_text("{}")
    old = time.time() - 20 * 60
    os.utime(f, (old, old))
    lu = MON.output_last_update(spark, {"live_api": str(d), "live_rss": str(tmp_path / "missing")})
    got = {r.name: r.status for r in MON.freshness(lu, F.current_timestamp(), expected=["live_api", "live_rss"]).collect()}
    assert got == {"live_api": "warn", "live_rss": "fail"}
