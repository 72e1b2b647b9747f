"""Sources: landing JSON layouts, vendor payload normalization and fallback, RSS feeds."""

import json

from pyspark.sql import functions as F

from tickwise.schemas import NEWS_EVENT, PRICE_EVENT
from tickwise.sources import landing, rss, vendor


def _write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def test_array_wrapper_lines_and_bad_files(spark, tmp_path):
    d = tmp_path / "api"
    ev = {"symbol": "BTC", "coin_id": "bitcoin", "price_usd": 95000, "price_idr": 1567500000,
          "timestamp": "2026-05-04T07:18:36.123456+00:00"}
    _write(d, "a.json", json.dumps([ev, dict(ev, symbol="ETH", price_usd=3000.5, change_24h=-1.25)]))
    _write(d, "b.json", json.dumps({"events": [dict(ev, symbol="BNB")], "meta": {"n": 1}}))
    _write(d, "c.json", '[{"symbol": "BTC", "price_usd": 1')  # truncated
    df = landing.read_landing(spark, str(d), PRICE_EVENT, "array")
    rows = {r.symbol: r for r in df.collect()}
    assert set(rows) == {"BTC", "ETH", "BNB"}
    assert rows["BTC"].price_usd == 95000.0          # whole number read as double
    assert rows["BTC"].change_24h is None            # absent field
    assert rows["ETH"]._pos == 1
    assert [r._file.endswith("c.json") for r in landing.bad_files(spark, str(d), PRICE_EVENT).collect()] == [True]
    # the same rows as JSON lines, read without multi-line
    dl = tmp_path / "lines"
    _write(dl, "l.json", "\n".join(json.dumps(dict(ev, symbol=s)) for s in ("BTC", "ETH")) + "\n{bad\n")
    assert landing.read_landing(spark, str(dl), PRICE_EVENT, "lines").count() == 2


def test_load_or_empty_and_inventory(spark, tmp_path):
    empty = landing.load_or_empty(spark, str(tmp_path / "missing"), NEWS_EVENT)
    assert empty.count() == 0 and "article_id" in empty.columns
    d = tmp_path / "inv"
    _write(d, "x.json", "x" * 3000)
    _write(d, "y.json", "y" * 100)
    inv = landing.landing_inventory(spark, str(d)).collect()
    assert len(inv) == 1 and inv[0].files == 2 and inv[0].size_kb == 3


def _polls(spark, rows):
    return spark.createDataFrame(rows, "poll_ts string, payload_a string, payload_b string")


A_OK = json.dumps({"bitcoin": {"usd": 95000.123, "idr": 1567500000.4, "usd_24h_change": 1.23456},
                   "ethereum": {"usd": 3000, "idr": 49500000},
                   "binancecoin": {"usd": 600.5, "idr": 9900000, "usd_24h_change": -0.5}})
B_OK = json.dumps({"RAW": {s: {"USD": {"PRICE": p, "CHANGEPCT24HOUR": 1.23456}} for s, p in
                           (("BTC", 95000.004), ("ETH", 3000.0), ("BNB", 600.0))}})


def test_vendor_a_complete(spark):
    out = {r.symbol: r for r in vendor.normalize_polls(_polls(spark, [("t1", A_OK, B_OK)])).collect()}
    assert set(out) == {"BTC", "ETH", "BNB"} and {r.source for r in out.values()} == {"A"}
    assert out["BTC"].price_usd == 95000.12 and out["BTC"].change_24h == 1.2346
    assert out["ETH"].change_24h == 0.0                   # absent change -> 0
    assert out["BTC"].price_idr == 1567500000.0 and out["BTC"].timestamp == "t1"


def test_vendor_fallback_to_b_whole_poll(spark):
    missing = json.loads(A_OK)
    del missing["ethereum"]
    null_change = json.loads(A_OK)
    null_change["bitcoin"]["usd_24h_change"] = None
    polls = _polls(spark, [("p1", json.dumps(missing), B_OK), ("p2", json.dumps(null_change), B_OK),
                           ("p3", None, None), ("p4", "not json", json.dumps({"RAW": {}}))])
    out = vendor.normalize_polls(polls).collect()
    assert {(r.timestamp, r.source) for r in out} == {("p1", "B"), ("p2", "B")}
    btc = [r for r in out if r.symbol == "BTC" and r.timestamp == "p1"][0]
    assert btc.price_usd == 95000.0 and btc.price_idr == round(95000.0 * 16500)


def test_json_field_default(spark):
    df = spark.createDataFrame([('{"k": 3}',), ('{}',), (None,)], "p string")
    assert [r[0] for r in df.select(vendor.json_field("p", "k", 0.0)).collect()] == [3.0, 0.0, 0.0]


FEED = """<?xml version="1.0"?><rss><channel>
<item><title>T1</title><link>http://a/1</link><description>{desc}</description><pubDate>Mon, 04 May 2026 07:00:00 GMT</pubDate></item>
<item><title>Second</title><description>no link</description></item>
</channel></rss>"""


def test_rss_feeds(spark, tmp_path):
    d = tmp_path / "feeds"
    _write(d, "f1.xml", FEED.format(desc="x" * 501))
    _write(d, "f2.xml", "<rss><channel><item><title>ok</title><link>http://b/1</link></item></channel></rss>")
    _write(d, "f3.xml", "<rss><channel><item><title>broken</title><link>http://c/1</link></item><item><title>x</ti")
    out = rss.read_feeds(spark, str(d), poll_ts=F.lit("2026-05-04T07:18:36+00:00")).collect()
    by_title = {r.title: r for r in out}
    assert "T1" in by_title and "ok" in by_title and "broken" not in by_title
    assert by_title["T1"].title == "T1"                    # explicit schema: not a timestamp
    assert len(by_title["T1"].summary) == 500
    assert by_title["Second"].article_id == "d41d8cd9"     # md5("") prefix
    assert by_title["Second"].published == "2026-05-04T07:18:36+00:00"
    assert by_title["T1"].article_id == __import__("hashlib").md5(b"http://a/1").hexdigest()[:8]


def test_news_defaults(spark):
    items = spark.createDataFrame([(None, None, None, None)], "title string, link string, description string, pubDate string")
    r = rss.normalize_news(items, F.lit("ts"), F.lit("src")).first()
    assert (r.title, r.link, r.summary, r.published, r.article_id) == ("No Title", "", "", "ts", "d41d8cd9")


def test_vendor_b_null_change_fails_poll_absent_change_is_zero(spark):
    a_bad = json.dumps({"bitcoin": {"usd": 1.0}})  # idr missing: A incomplete
    b_null = json.loads(B_OK)
    b_null["RAW"]["ETH"]["USD"]["CHANGEPCT24HOUR"] = None
    b_absent = json.loads(B_OK)
    del b_absent["RAW"]["ETH"]["USD"]["CHANGEPCT24HOUR"]
    out = vendor.normalize_polls(_polls(spark, [("p1", a_bad, json.dumps(b_null)),
                                                ("p2", a_bad, json.dumps(b_absent))])).collect()
    assert {r.timestamp for r in out} == {"p2"}
    assert [r.change_24h for r in out if r.symbol == "ETH"] == [0.0]


def test_rejected_feeds_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    from tickwise.plans import contract
    # no page number that ends the run of well-formed items: every feed still holds a malformed one
    pages = spark.createDataFrame([(50 * i, f"http://p/{i}", f"<title>t{i}</title>") for i in range(60)], "page_id long, url string, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(contract, "_FEED_ITEMS", 10, raising=False)
    monkeypatch.setattr(contract, "scratch_path", lambda *_: str(tmp_path / "feeds"))
    assert sorted(r["link"] for r in contract.q_rss_feeds_rejected(spark, str(tmp_path)).collect()) == sorted(f"http://p/{i}" for i in range(60))
    sizes = [f.read_text().count("<item>") for f in (tmp_path / "feeds" / "good").glob("part-*")]
    assert sum(sizes) == 60 and max(sizes) <= 10
