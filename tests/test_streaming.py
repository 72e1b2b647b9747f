"""Snapshots and streams: first-wins/latest semantics, news snapshot order, restart safety."""

import json

from pyspark.sql import functions as F

from tests.documents import read_document
from tickwise.operators import snapshot
from tickwise.schemas import NEWS_EVENT, PRICE_EVENT
from tickwise.sources import kafka
from tickwise.streaming import ingest, snapshots


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 3, "y"), ("A", 2, "z"), ("B", 5, "w"), ("B", 5, "v")],
                               "k string, o int, v string")
    assert {(r.k, r.v) for r in snapshot.latest_per_key(df, "k", ["o", "v"]).collect()} == {("A", "y"), ("B", "w")}
    assert {(r.k, r.v) for r in snapshot.first_per_key(df, "k", ["o", "v"]).collect()} == {("A", "x"), ("B", "v")}
    # idempotent: applying first-wins twice changes nothing
    once = snapshot.first_per_key(df, "k", ["o"])
    assert sorted(snapshot.first_per_key(once, "k", ["o"]).collect()) == sorted(once.collect())


def test_news_snapshot_order(spark):
    batch = spark.createDataFrame([("b1", 0), ("a1", 1), ("b1", 2)], "article_id string, pos int")
    prev = spark.createDataFrame([("a1", 0), ("c1", 1)], "article_id string, pos int")
    snap = snapshot.news_snapshot(batch, prev, ["pos"], k=20).collect()
    # newest batch first, oldest-first inside it, unique ids, then the stored rows
    assert [r.article_id for r in snap] == ["b1", "a1", "c1"]
    assert len(snapshot.news_snapshot(batch, prev, ["pos"], k=2).collect()) == 2


def _write_lines(path, rows, name):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_landing_is_exactly_once(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "land"), str(tmp_path / "ck")
    ev = lambda s, p, t: {"symbol": s, "coin_id": s.lower(), "price_usd": p, "price_idr": p * 16500,
                          "change_24h": 0.5, "timestamp": t}
    _write_lines(src, [ev("BTC", 1.0, "2026-05-04T23:59:00+00:00"), ev("ETH", 2.0, "2026-05-05T00:01:00+00:00")], "1.json")
    for _ in range(2):  # a restart on the same checkpoint re-reads nothing
        q = ingest.land(kafka.read_topic(spark, "api", PRICE_EVENT, fmt="json", path=str(src)), out, ck, "availableNow")
        q.awaitTermination(120)
    _write_lines(src, [ev("BTC", 3.0, "2026-05-05T00:02:00+00:00")], "2.json")
    q = ingest.land(kafka.read_topic(spark, "api", PRICE_EVENT, fmt="json", path=str(src)), out, ck, "availableNow")
    q.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 3
    assert {str(r.event_date) for r in landed.select("event_date").distinct().collect()} == {"2026-05-04", "2026-05-05"}


def test_news_snapshot_stream_versions(spark, tmp_path):
    src, out, ck = tmp_path / "news", str(tmp_path / "snap"), str(tmp_path / "ck")
    item = lambda i: {"article_id": f"id{i}", "title": f"t{i}", "link": f"l{i}", "summary": "", "published": "",
                      "source": "f", "timestamp": "2026-05-04T00:00:00+00:00"}
    _write_lines(src, [item(i) for i in range(15)], "a.json")
    writer = snapshots.news_snapshot_writer(out, k=20)
    stream = lambda: kafka.read_topic(spark, "rss", NEWS_EVENT, fmt="json", path=str(src), max_files_per_trigger=1)
    stream().writeStream.foreachBatch(writer).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination(120)
    _write_lines(src, [item(i) for i in range(12, 20)], "b.json")  # 3 repeats, 5 new
    stream().writeStream.foreachBatch(writer).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination(120)
    last = snapshots.latest_version_below(spark, out, 1 << 62)
    got = [r.article_id for r in spark.read.parquet(last).orderBy("_rank").collect()]
    assert got == [f"id{i}" for i in range(12, 20)] + [f"id{i}" for i in range(12)]


def test_dedup_stream_state_survives_restart(spark, tmp_path):
    src, out, ck = tmp_path / "d", str(tmp_path / "o"), str(tmp_path / "ck")
    _write_lines(src, [{"article_id": "x"}, {"article_id": "y"}, {"article_id": "x"}], "1.json")
    run = lambda: (snapshots.dedup_stream(spark.readStream.schema("article_id string").json(str(src)))
                   .writeStream.format("parquet").option("checkpointLocation", ck)
                   .trigger(availableNow=True).start(out).awaitTermination(120))
    run()
    _write_lines(src, [{"article_id": "y"}, {"article_id": "z"}], "2.json")
    run()
    assert sorted(r.article_id for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]


def test_price_snapshot_writer_keeps_batch_scope(spark, tmp_path):
    out = str(tmp_path / "live")
    w = snapshots.price_snapshot_writer(out)
    rows = [("BTC", "bitcoin", 1.0, 1.0, 0.1, "t1"), ("BTC", "bitcoin", 2.0, 2.0, 0.2, "t2"), (None, None, 3.0, 3.0, 0.0, "t3")]
    w(spark.createDataFrame(rows, PRICE_EVENT), 0)
    w(spark.createDataFrame([], PRICE_EVENT), 1)   # empty batch writes nothing
    snap = {r.symbol: r.price_usd for r in spark.read.parquet(snapshots.latest_version_below(spark, out, 99)).collect()}
    assert snap == {"BTC": 2.0, "": 3.0}
    assert snapshots.latest_version_below(spark, out, 99).endswith("v=000000000000")


def test_message_volume_and_poll_counts(spark):
    log = spark.createDataFrame([("a", 0, 0), ("a", 0, 4), ("a", 1, 2), ("b", 0, 0)], "topic string, partition int, offset long")
    assert {r.topic: r.messages for r in kafka.message_volume(log).collect()} == {"a": 8, "b": 1}
    polls = spark.createDataFrame([("t1",), ("t1",), ("t2",)], "timestamp string")
    assert {r.poll: r.rows for r in ingest.poll_counts(polls).collect()} == {"t1": 2, "t2": 1}
    rec = kafka.to_records(spark.createDataFrame([("BTC", 1.0)], "symbol string, p double"), "symbol").first()
    assert rec.key == "BTC" and json.loads(rec.value) == {"symbol": "BTC", "p": 1.0}


def test_analysis_job_end_to_end(spark, tmp_path):
    from tickwise.plans.analysis_job import run_analysis, stamp_poll_time
    root, out = tmp_path / "landing", str(tmp_path / "out")
    api = [{"symbol": "BTC", "coin_id": "bitcoin", "price_usd": 100 + i, "price_idr": 1.0, "change_24h": -i,
            "timestamp": f"2026-05-04T0{i}:00:00+00:00"} for i in range(3)]
    (root / "api").mkdir(parents=True)
    (root / "api" / "prices_2026-05-04_07-00-00.json").write_text(json.dumps(api))
    res = run_analysis(spark, str(root), out)           # no rss directory: empty news (S12)
    from tickwise.plans.analysis_job import sql_results
    by_sql = sql_results(spark)
    assert set(by_sql) == {"statistik", "volatilitas", "berita"}
    for name, df in by_sql.items():
        assert df.columns == res[name].columns and sorted(df.collect()) == sorted(res[name].collect())
    assert {r.dataset: r.rows for r in res["counts"].collect()} == {"api": 3, "rss": 0}
    assert spark.sql("SELECT count(*) FROM price_events").first()[0] == 3
    doc = read_document(f"{out}/spark_results")
    assert doc["statistik"][0]["rata_rata_usd"] == 101.0 and doc["berita"] == []
    assert len({r.timestamp for r in stamp_poll_time(spark.range(5)).collect()}) == 1


def test_snapshot_versions_are_pruned(spark, tmp_path):
    out = str(tmp_path / "live")
    w = snapshots.price_snapshot_writer(out, keep=2)
    for b in range(5):
        w(spark.createDataFrame([("BTC", "bitcoin", float(b), 1.0, 0.1, f"t{b}")], PRICE_EVENT), b)
    import os
    assert sorted(os.listdir(out)) == ["v=000000000003", "v=000000000004"]
    snap = spark.read.parquet(snapshots.latest_version_below(spark, out, 99)).first()
    assert snap.price_usd == 4.0


def test_states_merge_to_the_whole(spark):
    from tickwise.operators.running import RESULTS
    from tickwise.plans.analysis_job import analysis_results
    base = 1e9      # raw sums of squares would cancel
    rows = [(s, base + i % 7 if i % 11 else None, (-1.0) ** i * i, f"2026-05-04 {i % 24:02d}:00:00") for s in ("BTC", None, "ETH") for i in range(60)]
    rows += [("ONE", 5.0, None, None), ("NIL", None, 1.0, "2026-05-04 00:00:00")]
    df = spark.createDataFrame(rows, "symbol string, price_usd double, change_24h double, t string").withColumn("event_ts", F.to_timestamp("t"))
    want = analysis_results(df, df)
    parts = [df.where(F.abs(F.hash("t", "price_usd")) % 3 == k) for k in range(3)]
    for name, result in {**RESULTS["api"], **RESULTS["rss"]}.items():
        states = result.of(df.limit(0))
        for part in parts:
            states = result.merged(states, part)
        got = result.show(states)
        assert got.columns == want[name].columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want[name].collect()))


def test_refresh_follows_the_batches(spark, tmp_path):
    from tickwise.plans.analysis_job import normalize_prices, run_analysis
    from tickwise.plans.forecast_job import build_forecast
    from tickwise.sources.landing import read_landing
    from tickwise.streaming import refresh
    root, states, out = str(tmp_path / "lake"), str(tmp_path / "states"), str(tmp_path / "out")
    run = ingest.router(root, {"api": PRICE_EVENT, "rss": NEWS_EVENT}, {
        "api": refresh.in_turn(refresh.results_refresher(states, "api", out),
                               refresh.forecast_refresher(f"{root}/api", f"{states}/forecast", out, ["LinearRegression"])),
        "rss": refresh.results_refresher(states, "rss", out)})

    def batch(symbols, first, n, news):
        rows = [(json.dumps(_price(s, 100 + (i * 7) % 13 + i / 10, f"2026-05-04T{i // 60:02d}:{i % 60:02d}:00+00:00")), "api", f"f{first}")
                for s in symbols for i in range(first, first + n)]
        rows += [(json.dumps({"article_id": f"a{i}", "timestamp": f"2026-05-04T0{i}:00:00+00:00"}), "rss", "n") for i in range(news)]
        return spark.createDataFrame(rows, "value string, _topic string, _file string").coalesce(1)

    assert all(df.count() == 0 for df in refresh.refreshed_results(spark, states).values()) and refresh.refreshed_forecast(spark, f"{states}/forecast") is None
    run(batch(["BTC"], 0, 10, 2), 0)
    assert refresh.refreshed_forecast(spark, f"{states}/forecast") is None          # below the minimum
    run(batch(["BTC", "ETH"], 10, 60, 3), 1)
    first = {r.symbol: r for r in refresh.refreshed_forecast(spark, f"{states}/forecast").collect()}
    last = batch(["BTC"], 70, 25, 0)
    seen = []
    for _ in range(2):      # the second run is a replay
        run(last, 2)
        seen.append([sorted(map(str, df.collect())) for df in refresh.refreshed_results(spark, states).values()])
    assert seen[0] == seen[1]
    whole = run_analysis(spark, root, str(tmp_path / "rescan"), layout="parquet")
    assert seen[0] == [sorted(map(str, whole[n].collect())) for n in ("statistik", "volatilitas", "berita")]
    assert read_document(f"{out}/spark_results") == read_document(str(tmp_path / "rescan/spark_results"))
    got = {r.symbol: r for r in refresh.refreshed_forecast(spark, f"{states}/forecast").collect()}
    prices = normalize_prices(read_landing(spark, f"{root}/api", PRICE_EVENT, "parquet"))
    want = {r.symbol: r for r in build_forecast(spark, prices, ["LinearRegression"]).collect()}
    assert set(got) == {"BTC", "ETH"} == set(want) and got["ETH"] == first["ETH"] and got["BTC"] != first["BTC"]
    for s in want:
        assert [p.timestamp for p in got[s].forecast] == [p.timestamp for p in want[s].forecast] and got[s].history == want[s].history
        assert all(abs(p.price - q.price) <= 0.011 for p, q in zip(got[s].forecast, want[s].forecast))
    assert len(read_document(f"{out}/forecast")["BTC"]["forecast"]) == 10


def test_states_need_no_landing_table(spark, tmp_path):
    from tickwise.streaming import refresh
    states = str(tmp_path / "states")
    run = refresh.results_refresher(states, "api")
    for b in range(3):
        run(spark.createDataFrame([("BTC", "b", float(b), 1.0, 0.1, "2026-05-04T07:00:00+00:00")], PRICE_EVENT), b)
    row = refresh.refreshed_results(spark, states)["statistik"].first()
    assert (row.jumlah_data, row.rata_rata_usd, row.terendah_usd, row.tertinggi_usd) == (3, 1.0, 0.0, 2.0)


def test_two_topic_pipeline(spark, tmp_path):
    api_src, rss_src, root = tmp_path / "a", tmp_path / "r", str(tmp_path / "lake")
    _write_lines(api_src, [{"symbol": "BTC", "coin_id": "bitcoin", "price_usd": 1.0, "price_idr": 1.0,
                            "change_24h": 0.0, "timestamp": "2026-05-04T07:00:00+00:00"}], "1.json")
    _write_lines(rss_src, [{"article_id": "x", "title": "t", "link": "l", "summary": "", "published": "",
                            "source": "s", "timestamp": "2026-05-04T07:00:00+00:00"}], "1.json")
    stream = kafka.read_topics(spark, {"api": str(api_src), "rss": str(rss_src)}, fmt="json")
    q = ingest.start_pipeline(stream, root, {"api": PRICE_EVENT, "rss": NEWS_EVENT}, trigger="availableNow",
                              snapshot_fns={"api": snapshots.price_snapshot_writer(f"{root}/live_api"),
                                            "rss": snapshots.news_snapshot_writer(f"{root}/live_rss")})
    q.awaitTermination(120)
    assert spark.read.parquet(f"{root}/api").count() == 1 and spark.read.parquet(f"{root}/rss").count() == 1
    assert spark.read.parquet(snapshots.latest_version_below(spark, f"{root}/live_rss", 99)).first().article_id == "x"
    assert spark.read.parquet(snapshots.latest_version_below(spark, f"{root}/live_api", 99)).first().symbol == "BTC"


def test_dedup_stream_with_watermark_bounds_state(spark, tmp_path):
    src, out, ck = tmp_path / "w", str(tmp_path / "wo"), str(tmp_path / "wck")
    _write_lines(src, [{"article_id": "x", "ts": "2026-05-04T07:00:00"}, {"article_id": "x", "ts": "2026-05-04T07:00:30"},
                       {"article_id": "y", "ts": "2026-05-04T07:01:00"}], "1.json")
    st = (spark.readStream.schema("article_id string, ts string").json(str(src))
          .withColumn("ts", F.to_timestamp("ts")))
    q = (snapshots.dedup_stream(st, "article_id", watermark=("ts", "10 minutes")).writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination(120)
    assert sorted(r.article_id for r in spark.read.parquet(out).collect()) == ["x", "y"]


def test_first_sightings_forget_and_survive_restarts(spark, tmp_path):
    src, out, ck = tmp_path / "w", str(tmp_path / "wo"), str(tmp_path / "wck")

    def poll(name, rows):
        _write_lines(src, [{"id": i, "ts": t and f"2026-05-04T{t}", "n": n} for i, t, n in rows], name)
        st = spark.readStream.schema("id string, ts string, n int").json(str(src)).withColumn("ts", F.to_timestamp("ts"))
        q = (snapshots.first_sightings(st, "id", "ts", "10 minutes", "5 minutes").writeStream.format("parquet")
             .option("checkpointLocation", ck).trigger(availableNow=True).start(out))     # each poll is a restart
        q.awaitTermination(120)
        state = q.lastProgress["stateOperators"][0]
        assert any("rocksdb" in m for m in state["customMetrics"])
        return state["numRowsTotal"], sorted((r.id or "", r.n, r.sightings) for r in spark.read.parquet(out).collect())

    held, got = poll("1.json", [("x", "07:04:00", 2), ("x", "07:00:00", 1), ("y", "07:01:00", 3), (None, "07:02:00", 4), ("z", None, 5)])
    assert (held, got) == (3, [])
    # x is seen again (same session, one row late), y is quiet for long; at 07:30 - 5 min all older sessions are closed
    held, got = poll("2.json", [("x", "07:12:00", 6), ("x", "07:09:00", 7), ("y", "07:30:00", 8)])
    assert (held, got) == (1, [("", 4, 1), ("x", 1, 4), ("y", 3, 1)])
    held, got = poll("3.json", [(f"k{i}", f"{8 + i // 60:02d}:{i % 60:02d}:00", i) for i in range(300)])
    assert held <= 16 and len(got) >= 4 + 284      # the state holds a quarter of an hour, not the stream
    assert sum(n for _, _, n in got) == len(got) + 3


def test_cli_land_analysis_forecast(spark, tmp_path):
    from tickwise import cli
    src = tmp_path / "api_src"
    rows = [{"symbol": "BTC", "coin_id": "bitcoin", "price_usd": 100.0 + (i % 5) + i * 0.1, "price_idr": 1.0,
             "change_24h": 0.1, "timestamp": f"2026-05-04T{i // 60:02d}:{i % 60:02d}:00+00:00"} for i in range(60)]
    _write_lines(src, rows, "1.json")
    rss_src = tmp_path / "rss_src"
    _write_lines(rss_src, [{"article_id": "x", "title": "t", "link": "l", "summary": "", "published": "",
                            "source": "s", "timestamp": "2026-05-04T07:00:00+00:00"}], "1.json")
    root, out = str(tmp_path / "lake"), str(tmp_path / "out")
    assert cli.main(["land", "--api-src", str(src), "--rss-src", str(rss_src), "--root", root,
                     "--trigger", "availableNow"], spark=spark) == 0
    assert cli.main(["analysis", "--landing", root, "--out", out], spark=spark) == 0
    assert cli.main(["forecast", "--landing", root, "--out", out, "--models", "LinearRegression"], spark=spark) == 0
    doc = read_document(f"{out}/forecast")
    assert len(doc["BTC"]["forecast"]) == 10
    assert read_document(f"{out}/spark_results")["statistik"][0]["jumlah_data"] == 60
    again = str(tmp_path / "lake2")
    assert cli.main(["land", "--api-src", str(src), "--rss-src", str(rss_src), "--root", again, "--trigger", "availableNow",
                     "--results", f"{again}/out", "--models", "LinearRegression"], spark=spark) == 0
    assert read_document(f"{again}/out/forecast") == doc
    assert read_document(f"{again}/out/spark_results") == read_document(f"{out}/spark_results")


def _price(symbol, price, t="2026-05-04T07:00:00+00:00"):
    return {"symbol": symbol, "coin_id": "c", "price_usd": float(price), "price_idr": 1.0, "change_24h": 0.0, "timestamp": t}


def test_rows_of_one_second_keep_their_arrival_order(spark, tmp_path):
    from tickwise.plans.analysis_job import normalize_prices
    from tickwise.sources.landing import read_landing
    src, ck = tmp_path / "src", str(tmp_path / "ck")
    for b in range(2):
        _write_lines(src, [_price("BTC", 100 * b + i) for i in range(40)], f"{b}.json")
        for fmt in ("parquet", "json"):
            ingest.land(kafka.read_topic(spark, "api", PRICE_EVENT, fmt="json", path=str(src)), str(tmp_path / fmt), f"{ck}-{fmt}", "availableNow", fmt=fmt).awaitTermination(120)
    want = [float(100 * b + i) for b in range(2) for i in range(40)]
    for layout, path in (("parquet", "parquet"), ("lines", "json"), ("lines", "src")):
        rows = normalize_prices(read_landing(spark, str(tmp_path / path), PRICE_EVENT, layout))
        assert rows.select("seq").distinct().count() == 80
        assert [r.price_usd for r in rows.repartition(7).orderBy("seq").collect()] == want
        assert snapshot.latest_per_key(rows.repartition(5), "symbol", ["event_ts", "seq"]).first().price_usd == 139.0


def test_offsets_order_the_rows_of_a_partition(spark, tmp_path):
    rows = [("BTC", "bitcoin", float(o), 1.0, 0.1, "t", "api", p, o) for p in (10, 2) for o in (7, 30, 4)]
    batch = spark.createDataFrame(rows, PRICE_EVENT.fields and ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PRICE_EVENT.fields)
                                  + ", _topic string, _partition int, _offset long").repartition(3)
    snapshots.price_snapshot_writer(str(tmp_path / "s"))(batch, 0)
    assert spark.read.parquet(snapshots.latest_version_below(spark, str(tmp_path / "s"), 1)).first().price_usd == 30.0


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    batch = spark.createDataFrame([(json.dumps(_price("BTC", i)), "api", f"f{i % 2}") for i in range(6)]
                                  + [(json.dumps({"article_id": f"a{i}", "title": "t", "link": "l"}), "rss", "f0") for i in range(3)]
                                  + [("{broken", "api", "f0"), ("{}", "other", "f0")], "value string, _topic string, _file string").coalesce(1)
    run = ingest.router(root, {"api": PRICE_EVENT, "rss": NEWS_EVENT},
                        {"api": snapshots.price_snapshot_writer(f"{root}/live_api"), "rss": snapshots.news_snapshot_writer(f"{root}/live_rss")})
    seen = []
    for _ in range(2):
        run(batch, 3)
        seen.append([sorted(map(str, spark.read.parquet(f"{root}/{t}").collect())) for t in ("api", "rss")]
                    + [spark.read.parquet(snapshots.latest_version_below(spark, f"{root}/live_{t}", 9)).collect() for t in ("api", "rss")])
    assert seen[0] == seen[1]
    assert [len(x) for x in seen[0]] == [6, 3, 1, 3] and seen[0][2][0].price_usd == 5.0
    run(batch.limit(0), 4)
    assert len(spark.read.parquet(f"{root}/api").collect()) == 6


def test_a_lost_checkpoint_does_not_overwrite_landed_batches(spark, tmp_path):
    import pytest
    src, out = tmp_path / "src", str(tmp_path / "land")
    _write_lines(src, [_price("BTC", 1)], "1.json")
    stream = lambda: kafka.read_topic(spark, "api", PRICE_EVENT, fmt="json", path=str(src))
    ingest.land(stream(), out, str(tmp_path / "ck"), "availableNow").awaitTermination(120)
    with pytest.raises(ValueError):
        ingest.land(stream(), out, str(tmp_path / "new"), "availableNow")
    assert spark.read.parquet(out).count() == 1
