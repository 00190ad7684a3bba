"""Evaluation of a scored table scored(model, pair_id, label, probability, predicted).

Every metric is grouped by `model`, so many models are evaluated in one pass. ROC-AUC and
average precision are exact (ties get half credit / are stepped together), computed from
per-distinct-score counts with bucketed running totals instead of a global sort.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.functions.scoring import bce
from simpairs.operators.numbering import RANGE, running_totals, with_ranges
from simpairs.sources.shared import checkpointed


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0.0 when b == 0 (undefined metric)."""
    return F.when(b != 0, a.cast("double") / b).otherwise(F.lit(0.0))


def counts(scored: DataFrame) -> DataFrame:
    """Per model: n, tp, fp, fn, tn for the positive class 1."""
    y, p = F.col("label"), F.col("predicted")

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), cnt((y == 1) & (p == 1)).alias("tp"), cnt((y != 1) & (p == 1)).alias("fp"),
        cnt((y == 1) & (p != 1)).alias("fn"), cnt((y != 1) & (p != 1)).alias("tn"),
        cnt(y == p).alias("n_correct"))


def binary_metrics(scored: DataFrame) -> DataFrame:
    c = counts(scored)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "model",
        _div0(F.col("n_correct"), F.col("n")).alias("accuracy"),
        _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """(model, label, predicted, n) for every pair of labels present (in y or in the
    prediction) for that model, zeros included. The scored rows are read once, into a few counts that
    everything else is made of."""
    n = checkpointed(scored.groupBy("model", "label", "predicted").agg(F.count(F.lit(1)).alias("n")))
    labels = n.select("model", F.col("label").alias("c")).union(n.select("model", F.col("predicted").alias("c"))).distinct()
    grid = (labels.withColumnRenamed("c", "label")
            .join(labels.withColumnRenamed("c", "predicted"), "model"))
    return grid.join(n, ["model", "label", "predicted"], "left").select(
        "model", "label", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def score_curve(scored: DataFrame) -> DataFrame:
    """Per model and distinct probability, in descending order: tp, fp at that score and
    the inclusive running totals ctp, cfp. The scored rows are read once, into counts that the ranges, the
    offsets and the windows are made of."""
    d = scored.groupBy("model", "probability").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).cast("long").alias("fp"))
    d = checkpointed(d)
    # descending score order: the bucket must grow along it
    return running_totals(with_ranges(d, F.col("probability")), {"ctp": F.col("tp"), "cfp": F.col("fp")}, [F.col("probability").desc()],
                       -F.col(RANGE), ["model"]).drop(RANGE)


def curve_metrics(scored: DataFrame) -> DataFrame:
    """(model, roc_auc, pr_auc) from one score curve.

    roc_auc: exact (Mann-Whitney with half credit for ties); 0.0 if a class is absent. pr_auc: sum over
    distinct scores of (recall step) x precision, no interpolation; 0.0 without positives."""
    c = score_curve(scored)
    area = F.col("fp").cast("double") * (F.col("ctp").cast("double") - F.col("tp").cast("double") / 2.0)
    step = F.col("tp").cast("double") * F.col("ctp") / (F.col("ctp") + F.col("cfp"))
    g = c.groupBy("model").agg(F.sum(area).alias("a"), F.sum(step).alias("p"), F.sum("tp").alias("pos"), F.sum("fp").alias("neg"))
    pos, neg = F.col("pos"), F.col("neg")
    return g.select("model", F.when((pos > 0) & (neg > 0), F.col("a") / (pos.cast("double") * neg)).otherwise(F.lit(0.0)).alias("roc_auc"),
                    F.when(pos > 0, F.col("p") / pos).otherwise(F.lit(0.0)).alias("pr_auc"))


def roc_auc(scored: DataFrame) -> DataFrame:
    return curve_metrics(scored).select("model", "roc_auc")


def average_precision(scored: DataFrame) -> DataFrame:
    return curve_metrics(scored).select("model", "pr_auc")


def log_loss(scored: DataFrame) -> DataFrame:
    return scored.groupBy("model").agg(F.avg(bce("label", "probability")).alias("log_loss"))


def class_report(scored: DataFrame) -> DataFrame:
    """(model, class, precision, recall, f1, support) per label present, plus rows
    'accuracy' (f1 = accuracy), 'macro avg' and 'weighted avg'; undefined values are 0."""
    cm = confusion_matrix(scored)
    per = cm.groupBy("model", F.col("label").alias("c")).agg(
        F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("support"))
    pred = cm.groupBy("model", F.col("predicted").alias("c")).agg(F.sum("n").alias("n_pred"))
    k = per.join(pred, ["model", "c"])
    k = k.select("model", "c", "support",
                 _div0(F.col("tp"), F.col("n_pred")).alias("precision"),
                 _div0(F.col("tp"), F.col("support")).alias("recall"),
                 _div0(2 * F.col("tp"), F.col("support") + F.col("n_pred")).alias("f1"),
                 F.col("tp"))
    rows = k.select("model", F.col("c").cast("string").alias("class"), "precision", "recall", "f1",
                    F.col("support").cast("long").alias("support"))
    agg = k.groupBy("model").agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum("support").alias("tot"), F.sum("tp").alias("tp"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    tot = F.col("tot").cast("long")
    macro = agg.select("model", F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), tot.alias("support"))
    weighted = agg.select("model", F.lit("weighted avg").alias("class"), _div0(F.col("wp"), F.col("tot")).alias("precision"),
                          _div0(F.col("wr"), F.col("tot")).alias("recall"), _div0(F.col("wf"), F.col("tot")).alias("f1"),
                          tot.alias("support"))
    acc = agg.select("model", F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), _div0(F.col("tp"), F.col("tot")).alias("f1"),
                     tot.alias("support"))
    return rows.unionByName(macro).unionByName(weighted).unionByName(acc)


def evaluate(scored: DataFrame) -> DataFrame:
    """metrics(model, accuracy, precision, recall, f1_score, roc_auc, pr_auc)."""
    return binary_metrics(scored).join(curve_metrics(scored), "model")
