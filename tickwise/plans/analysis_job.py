"""The batch analysis job (§3.1 re-planned): landing JSON -> three aggregates -> tables + document."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.scalar import parse_ts
from tickwise.operators import documents as DOC
from tickwise.operators import stats
from tickwise.schemas import NEWS_EVENT, PRICE_EVENT
from tickwise.sources.arrival import arrival_order
from tickwise.sources.landing import load_or_empty, write_result


def normalize_prices(raw: DataFrame) -> DataFrame:
    """Landed price_event rows -> typed events with ``event_ts`` and an arrival key ``seq`` that tells
    all rows apart (R8)."""
    return raw.withColumn("event_ts", parse_ts("timestamp")).withColumn("seq", F.struct(*arrival_order(raw)))


def normalize_news(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_ts", parse_ts("timestamp"))


def register_views(prices: DataFrame, news: DataFrame, api_view: str = "price_events",
                   rss_view: str = "news_events") -> None:
    """S3: name the two event tables for SQL users."""
    prices.createOrReplaceTempView(api_view)
    news.createOrReplaceTempView(rss_view)


def stamp_poll_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """P8 + F11: one UTC "now" stamp for every row of a poll/batch (evaluated once per query)."""
    return df.withColumn(col, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def analysis_results(prices: DataFrame, news: DataFrame) -> dict[str, DataFrame]:
    """A1-A3 (+ O1-O3) over normalized events."""
    return {
        "statistik": stats.price_stats(prices),
        "volatilitas": stats.hourly_volatility(prices),
        "berita": stats.hourly_news_count(news),
    }


# A1-A3 as SQL over the views; :digits and :fine are bound, not pasted.
SQL_RESULTS = {
    "statistik": """
        SELECT symbol, round(avg(price_usd), :digits) AS rata_rata_usd, round(max(price_usd), :digits) AS tertinggi_usd,
               round(min(price_usd), :digits) AS terendah_usd, round(stddev_samp(price_usd), :digits) AS std_deviasi, count(*) AS jumlah_data
        FROM IDENTIFIER(:prices) GROUP BY symbol ORDER BY rata_rata_usd DESC""",
    "volatilitas": """
        SELECT hour(event_ts) AS jam, symbol, round(avg(abs(change_24h)), :fine) AS avg_volatilitas, count(*) AS jumlah_data
        FROM IDENTIFIER(:prices) GROUP BY hour(event_ts), symbol ORDER BY avg_volatilitas DESC""",
    "berita": """
        SELECT hour(event_ts) AS jam, count(*) AS jumlah_artikel
        FROM IDENTIFIER(:news) GROUP BY hour(event_ts) ORDER BY jumlah_artikel DESC""",
}


def sql_results(spark: SparkSession, api_view: str = "price_events", rss_view: str = "news_events") -> dict[str, DataFrame]:
    """S3: the three aggregates by SQL over the registered views, with bound arguments."""
    bound = {"prices": api_view, "news": rss_view, "digits": 2, "fine": 4}
    return {name: spark.sql(text, {k: v for k, v in bound.items() if f":{k}" in text}) for name, text in SQL_RESULTS.items()}


def _observed_rows(seen: Observation) -> int:
    """Rows an observation met; none when the optimizer removed an input known to be empty."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:
        if "AssertionError" in str(e.java_exception):
            return 0
        raise


def write_results(spark: SparkSession, res: dict[str, DataFrame], out_root: str, write_document: bool = True) -> None:
    """The three result tables (S9) and, from the written tables, the combined document."""
    for name, df in res.items():
        write_result(df, f"{out_root}/{name}")
    if write_document:
        # read back the written tables: the document does not recompute the aggregates
        back = {n: spark.read.schema(df.schema).json(f"{out_root}/{n}") for n, df in res.items()}
        doc = DOC.combined_document({
            "statistik": (back["statistik"], [-F.col("rata_rata_usd"), F.col("symbol")]),
            "volatilitas": (back["volatilitas"], [-F.col("avg_volatilitas"), F.col("jam"), F.col("symbol")]),
            "berita": (back["berita"], [-F.col("jumlah_artikel"), F.col("jam")]),
        })
        DOC.write_document(doc, f"{out_root}/spark_results")


def run_analysis(spark: SparkSession, landing_root: str, out_root: str, layout: str = "array",
                 write_document: bool = True) -> dict[str, DataFrame]:
    """Read ``{landing_root}/api`` and ``/rss`` (S1/S2, explicit schemas, S12 when absent),
    report counts (S4, observed in the same passes), write the three result tables (S9) and the combined document (S10)."""
    prices = normalize_prices(load_or_empty(spark, f"{landing_root}/api", PRICE_EVENT, layout))
    news = normalize_news(load_or_empty(spark, f"{landing_root}/rss", NEWS_EVENT, layout))
    register_views(prices, news)
    seen = {"api": Observation(), "rss": Observation()}     # S4: counted while the results are written
    rows = F.count(F.lit(1)).alias("rows")
    res = analysis_results(prices, news)
    res["statistik"] = stats.price_stats(prices.observe(seen["api"], rows))
    res["berita"] = stats.hourly_news_count(news.observe(seen["rss"], rows))
    write_results(spark, res, out_root, write_document)
    counts = spark.createDataFrame([(name, _observed_rows(o)) for name, o in seen.items()], "dataset string, rows long")
    res["counts"] = counts
    return res
