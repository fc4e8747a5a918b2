"""Evaluation metrics as aggregations: regression errors, exact ROC-AUC,
confusion matrix and classification report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridewise.operators.window import prefix_sums


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """MAE, RMSE, R2 = 1 - SSE/SST, MAPE*100 (rows with y = 0 skipped)."""
    err = F.col(y) - F.col(p)
    m = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("__sse"),
        (F.var_pop(y) * F.count(y)).alias("__sst"),
        (F.avg(F.abs(err) / F.abs(F.nullif(F.col(y), F.lit(0.0)))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"))
    return (m.withColumn("r2", F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("__sst")))
             .select("mae", "rmse", "r2", "mape", "n"))


def roc_auc(df: DataFrame, label: str, score: str, distributed: bool = True) -> DataFrame:
    """Exact ROC-AUC with ties (Mann-Whitney).

    Rows are first grouped by distinct score (partial aggregation), so the
    ordered step sees one row per distinct score; with ``distributed`` the
    running count of negatives is a range-partitioned prefix sum.
    AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N).
    """
    g = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
           .groupBy(score)
           .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                F.sum((F.col(label) != 1).cast("long")).alias("neg")))
    if distributed:
        c = prefix_sums(g, [score], {"__cneg": "neg"})
    else:
        w = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, 0)
        c = g.withColumn("__cneg", F.sum("neg").over(w))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")     # products of counts pass a long
    below = F.col("__cneg") - F.col("neg")
    return c.agg(F.try_divide(F.sum(pos * (below + neg * 0.5)), F.sum(pos) * F.sum(neg)).alias("auc"),
                 F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def confusion_matrix(df: DataFrame, y: str, pred: str, classes=(0, 1)) -> DataFrame:
    """Every (actual, predicted) cell present, zero when empty."""
    spark: SparkSession = df.sparkSession
    cells = spark.createDataFrame([(a, b) for a in classes for b in classes], "actual int, predicted int")
    cnt = (df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
             .groupBy(F.col(y).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted"))
             .agg(F.count(F.lit(1)).alias("count")))
    return (cells.join(cnt, ["actual", "predicted"], "left")
                 .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint")))


def classification_report(df: DataFrame, y: str, pred: str, classes=(0, 1)) -> DataFrame:
    """Precision, recall, f1, support per class; accuracy; macro and
    weighted averages. A zero division gives 0."""
    cm = confusion_matrix(df, y, pred, classes)
    per = None
    for c in classes:
        r = cm.agg(
            F.sum(F.when((F.col("actual") == c) & (F.col("predicted") == c), F.col("count"))).alias("tp"),
            F.sum(F.when(F.col("predicted") == c, F.col("count"))).alias("pp"),
            F.sum(F.when(F.col("actual") == c, F.col("count"))).alias("support"),
        ).select(F.lit(str(c)).alias("class"),
                 F.coalesce(F.try_divide("tp", "pp"), F.lit(0.0)).alias("precision"),
                 F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)).alias("recall"),
                 F.col("support").cast("bigint").alias("support"))
        per = r if per is None else per.unionByName(r)
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("n"))
    acc = cm.agg(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count"))).alias("ok"),
                 F.sum("count").alias("n"))
    accuracy = acc.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                          F.lit(None).cast("double").alias("recall"),
                          F.col("n").cast("bigint").alias("support"),
                          F.coalesce(F.try_divide("ok", "n"), F.lit(0.0)).alias("f1"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").cast("bigint").alias("support"),
                    F.avg("f1").alias("f1"))
    wj = per.crossJoin(F.broadcast(tot))
    weighted = wj.agg(F.lit("weighted avg").alias("class"),
                      F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), F.first("n")), F.lit(0.0)).alias("precision"),
                      F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), F.first("n")), F.lit(0.0)).alias("recall"),
                      F.sum("support").cast("bigint").alias("support"),
                      F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.first("n")), F.lit(0.0)).alias("f1"))
    return per.select("class", "precision", "recall", "support", "f1").unionByName(accuracy) \
              .unionByName(macro).unionByName(weighted)
