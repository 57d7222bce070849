"""Calls from ranked scores and evidence: buckets, evidence sums, the rule ladder, levels; picks and flags of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import bucket, clip, r6, rank_pct
from tickloom.plans.ledger import TIMEFRAMES, call_kind, levels, timeframes

#: Edges of the six rank buckets.
EDGES = [0.0, 0.2, 0.5, 0.7, 0.85, 0.95, 1.0]
LABELS = ["Bottom 20%", "20-50%", "50-70%", "70-85%", "85-95%", "Top 5%"]


def default_calibration(spark: SparkSession) -> DataFrame:
    """A documented stand-in for the calibration, whose real constants aren't public: a row for each (tf, side, bucket).

    y: hit rate, ret: mean return, edge_ok and abs_ok: whether the bucket beats its base and zero; thr: evidence threshold of the timeframe.
    """
    rows = []
    for i, (tf, thr) in enumerate((("ST", 0.5), ("MT", 1.0), ("LT", 2.0))):
        for side in ("L", "S"):
            for k in range(6):
                rows.append((tf, side, k, LABELS[k], round(0.15 + 0.05 * i + 0.03 * k, 4), round(-0.5 + 0.3 * k, 4), k >= 4, k >= 5 or side == "L", thr))
    return spark.createDataFrame(rows, "tf string, bside string, k int, label string, y double, ret double, edge_ok boolean, abs_ok boolean, thr double")


def evidence(events: DataFrame, proven: DataFrame) -> DataFrame:
    """symbol, tf, net_ret, net_hit, n of the events (symbol, pattern, dir) that proven (tf, pattern, dir, eff, ex, hx) names.

    A pattern counts once a side (its last effect wins), for it if eff > 0 and against it otherwise.
    """
    df = events.select("symbol", "pattern", "dir", "t").join(F.broadcast(proven), ["pattern", "dir"])
    one = df.groupBy("symbol", "tf", (F.col("eff") > 0).alias("pro"), "pattern").agg(F.max_by(F.struct("ex", "hx"), F.struct("t", "dir")).alias("e"))
    sign = F.when(F.col("pro"), 1).otherwise(-1)
    return one.groupBy("symbol", "tf").agg(F.sum(sign * F.col("e.ex")).alias("net_ret"), F.sum(sign * F.col("e.hx")).alias("net_hit"), F.count("*").alias("n"))


def decide(rows: DataFrame, calibration: DataFrame, found: DataFrame) -> DataFrame:
    """A call for each symbol and timeframe: rows (symbol, close, atr, eligible, p_long, p_short) of one session, with tf where the scores differ by timeframe."""
    tf = F.broadcast(timeframes(rows.sparkSession))  # three rows
    df = rows.join(tf, "tf") if "tf" in rows.columns else rows.crossJoin(tf)
    el = F.col("eligible")
    df = df.withColumns({"pct_buy": F.round(rank_pct("p_long", ["tf"], el), 8), "pct_short": F.round(rank_pct("p_short", ["tf"], el), 8)})
    df = df.withColumns({"kl": bucket("pct_buy", EDGES), "ks": bucket("pct_short", EDGES)})
    side = lambda s, c: F.broadcast(calibration.filter(F.col("bside") == s).select("tf", F.col("k").alias(f"k{c}"), *[F.col(x).alias(f"{c}_{x}") for x in ("label", "y", "ret", "edge_ok", "abs_ok")], *([F.col("thr")] if s == "L" else [])))
    df = df.join(side("L", "l"), ["tf", "kl"], "left").join(side("S", "s"), ["tf", "ks"], "left").join(found, ["symbol", "tf"], "left")
    net = F.coalesce(clip("net_ret", -1e9, 1e9), F.lit(0.0))
    df = df.withColumn("net", F.round(F.least(F.greatest(net, -3 * F.col("thr")), 3 * F.col("thr")), 8)).withColumn("hit", clip(F.coalesce("net_hit", F.lit(0.0)), -0.10, 0.10))
    c = F.col
    long_model, avoid = (c("kl") >= 4) & c("l_edge_ok"), (c("ks") >= 4) & c("s_edge_ok")
    pro, con = c("net") >= c("thr"), c("net") <= -c("thr")
    lt = c("tf") == "LT"
    kind = (
        F.when(~el | c("pct_buy").isNull() | c("pct_short").isNull(), "Not rated")
        .when((c("kl") == 5) & c("l_edge_ok") & (c("net") >= 0) & ~avoid, "Strong Buy")
        .when(((long_model & (c("net") >= 0)) | (pro & (c("kl") > 0))) & ~avoid, F.when(lt, "Accumulate (buy on dips)").otherwise("Buy"))
        .when(avoid & c("s_abs_ok") & ~lt & (c("net") <= 0) & ~long_model, F.when(c("ks") == 5, "Strong Short Sell").otherwise("Short Sell"))
        .when((avoid & (c("net") <= 0)) | (con & ~long_model), F.when(lt, "Reduce / Avoid").otherwise("Avoid (likely underperformer)"))
        .when((avoid & pro) | (long_model & con), "Hold (mixed signals)")
        .otherwise("Hold / No fresh trade")
    )
    df = df.withColumn("type", kind)
    df = df.withColumn("side", F.when(c("type").isin("Strong Buy", "Buy", "Accumulate (buy on dips)"), 1).when(c("type").isin("Short Sell", "Strong Short Sell"), -1).otherwise(0))
    df = levels(df)
    return df.select(
        "symbol", "tf", "type", "side", r6("pct_buy").alias("pct_buy"), r6("pct_short").alias("pct_short"), c("l_label").alias("bucket_buy"), c("s_label").alias("bucket_short"),
        r6(clip(c("l_y") + c("hit"), 0.01, 0.99)).alias("conf_buy"), r6(c("l_ret") + c("net")).alias("exp_ret_buy"), r6("net").alias("net_evidence"), "entry_limit", "target", "stop",
    )


def top_picks(calls: DataFrame, k: int = 5) -> DataFrame:
    """The k best buys of each timeframe: strong ones first, then expected return, then rank."""
    order = [F.when(F.col("type") == "Strong Buy", 0).otherwise(1), F.col("exp_ret_buy").desc(), F.col("pct_buy").desc(), F.col("symbol")]
    return calls.filter("side > 0").withColumn("place", F.row_number().over(Window.partitionBy("tf").orderBy(*order))).filter(F.col("place") <= k).select("tf", "place", "symbol", "type", "exp_ret_buy", "pct_buy")


def scored_rows(scores: DataFrame, facts: DataFrame, least_bars: int = 209, least_turnover: float = 10.0) -> DataFrame:
    """A row for each symbol and timeframe of one session, from scores (symbol and a column `tf_side` a tag) and facts (symbol, close, atr, t, turnover).

    Eligible are symbols with enough bars, enough turnover and a known true range; a score's rank counts among them only.
    """
    by_tf = F.explode(F.array(*[F.struct(F.lit(tf).alias("tf"), F.round(f"{tf}_L", 8).alias("p_long"), F.round(f"{tf}_S", 8).alias("p_short")) for tf, *_ in TIMEFRAMES])).alias("e")
    el = (F.col("t") >= least_bars) & F.coalesce(F.col("turnover") >= least_turnover, F.lit(False)) & F.col("atr").isNotNull()
    return facts.join(scores, "symbol").select("symbol", "close", "atr", el.alias("eligible"), by_tf).select("symbol", "close", "atr", "eligible", "e.*")


def top_avoids(calls: DataFrame, k: int = 10, turnover: DataFrame | None = None) -> DataFrame:
    """The k strongest avoid flags of each timeframe; of equal ones those that trade most, where turnover (symbol, turnover) is given."""
    if turnover is not None:
        calls = calls.join(turnover.select("symbol", "turnover"), "symbol", "left")
    w = Window.partitionBy("tf").orderBy(F.col("pct_short").desc(), *([F.col("turnover").desc_nulls_last()] if turnover is not None else []), "symbol")
    return calls.filter(F.col("type").isin("Avoid (likely underperformer)", "Reduce / Avoid")).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("tf", "place", "symbol", "pct_short")


def by_symbol_report(calls: DataFrame) -> DataFrame:
    """A row a symbol: its call at each timeframe and its mean standing, best first by score, then rank."""
    order = {"Strong Buy": 0, "Buy": 1, "Accumulate (buy on dips)": 1, "Hold (mixed signals)": 2, "Hold / No fresh trade": 3, "Avoid (likely underperformer)": 4, "Reduce / Avoid": 4, "Short Sell": 5, "Strong Short Sell": 6}
    score = F.try_element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), F.col("type"))
    pivot = calls.groupBy("symbol").pivot("tf", ["ST", "MT", "LT"]).agg(F.first("type"))
    means = calls.groupBy("symbol").agg(r6(F.avg(score)).alias("score"), F.max("pct_buy").alias("best_rank"))
    return pivot.join(means, "symbol")
