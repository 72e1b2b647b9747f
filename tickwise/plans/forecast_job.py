"""The forecast job (M1-M12 end to end, §3.2 re-planned): one keyed plan for all symbols."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.scalar import iso_utc
from tickwise.operators import forecast as FC
from tickwise.operators import models as ML
from tickwise.operators import regression as RG
from tickwise.operators import series as S
from tickwise.operators import trees as TR
from tickwise.operators.lookup import join_small
from tickwise.schemas import FEATURE_COLS, FORECAST_ENTRY
from tickwise.session import materialize


def _empty(spark: SparkSession) -> DataFrame:
    schema = "symbol string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FORECAST_ENTRY.fields)
    return spark.createDataFrame([], schema)


def build_forecast(spark: SparkSession, prices: DataFrame, models: Sequence[str] = tuple(ML.MODEL_ORDER),
                   keys: Sequence[str] | None = None, horizon: int = FC.HORIZON, width: float | None = None,
                   leak_free: bool = False, consistent: bool = False, materialize_features: bool = True,
                   min_rows: int = S.MIN_ROWS_TOTAL) -> DataFrame:
    """Per symbol: history (last 50 points), forecast (``horizon`` points) and the winning
    model (name, R^2, MAE). ``prices`` are normalized price events (symbol, price_usd,
    event_ts, seq). ``keys`` is the optional allow-list (P4), the row filter that stands for the
    original's filter per key (P3). Every model fits, validates and forecasts all keys in one plan."""
    base = S.base_series(prices)
    if keys is not None:
        base = base.where(F.col("symbol").isin(list(keys)))
    if not S.has_rows(base, min_rows):  # P5
        return _empty(spark)
    feats = S.feature_table(spark, base, width=width, leak_free=leak_free,
                            materialize_rows=materialize_features)
    sp = S.chrono_split(feats)
    train, val = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "val")

    metrics = []
    if "LinearRegression" in models:  # M3 keyed: all symbols in one aggregate
        coefs = RG.fit_keyed_ols(train, "symbol", FEATURE_COLS, ML.LABEL)
        pred = RG.predict_keyed(val, coefs, "symbol", FEATURE_COLS)
        metrics.append(RG.regression_metrics(pred, ["symbol"], ML.LABEL)
                       .select("symbol", F.lit("LinearRegression").alias("name"), F.lit(0).alias("order"), "r2", "mae"))
    trees = [m for m in models if m != "LinearRegression"]
    metrics += [ML.tree_metrics(train, val, name) for name in trees]
    allm = metrics[0]
    for m in metrics[1:]:
        allm = allm.unionByName(m)
    best = FC.select_best(ML.round_metrics(allm))
    if trees:
        best = materialize(spark, best, "winners")

    ctx = FC.context(sp)
    outs = []
    if "LinearRegression" in models:
        lr_keys = best.where(F.col("name") == "LinearRegression").select(F.col("symbol").alias("_bk"))
        coefs_all = RG.fit_keyed_ols(sp, "symbol", FEATURE_COLS, ML.LABEL)  # M8 refit on all rows
        ctx_lr = join_small(ctx, lr_keys, F.col("symbol") == F.col("_bk"), "left_semi")
        outs.append(FC.forecast_linear(ctx_lr, coefs_all, horizon=horizon, consistent=consistent))
    for name in trees:  # M8: the winner refits on all rows of its keys
        mine = best.where(F.col("name") == name).select(F.col("symbol").alias("_bk"))
        spec = TR.KINDS[name]
        models_all = TR.fit(join_small(sp, mine, F.col("symbol") == F.col("_bk"), "left_semi"), "symbol", FEATURE_COLS, ML.LABEL, spec)
        steps = TR.forecast(ctx, models_all, "symbol", FEATURE_COLS, spec, horizon, consistent)
        outs.append(steps.select("symbol", "step", "ts", iso_utc(F.col("ts")).alias("timestamp"), "price", "pct"))
    if not outs:
        return _empty(spark)
    fc = outs[0]
    for o in outs[1:]:
        fc = fc.unionByName(o)
    fc_arr = (fc.groupBy("symbol")
              .agg(F.array_sort(F.collect_list(F.struct("step", "timestamp", "price"))).alias("_f"))
              .select(F.col("symbol").alias("_fk"),
                      F.transform("_f", lambda e: F.struct(e["timestamp"].alias("timestamp"),
                                                           e["price"].alias("price"))).alias("forecast")))
    hist = FC.history(sp)
    res = (hist.join(fc_arr, hist["symbol"] == fc_arr["_fk"]).drop("_fk")
           .join(best.select(F.col("symbol").alias("_mk"),
                             F.struct("name", "r2", "mae").alias("model")), F.col("symbol") == F.col("_mk"))
           .drop("_mk"))
    return res.select("symbol", "history", "forecast", "model")


def write_forecast_outputs(spark: SparkSession, result: DataFrame, out_root: str) -> bool:
    """S9 + S11: write the forecast table and the ``{symbol: ...}`` document. A run without any
    forecast (too little data, P5) writes nothing, so the previous outputs stay (R17)."""
    from tickwise.operators import documents as DOC
    if not S.has_rows(result, 1):
        return False
    table_path = f"{out_root}/forecast_table"
    result.write.mode("overwrite").json(table_path)
    back = spark.read.schema(result.schema).json(table_path)
    DOC.write_document(DOC.forecast_document(back), f"{out_root}/forecast")
    return True
