"""Training-history analytics: epoch summaries, running progress, stop rules, LR schedule.

Tables:
  batch_log(run, epoch, batch, batch_loss, correct, n)
  history(run, epoch, loss, accuracy, val_loss, val_accuracy)

Path-dependent rules (plateau stops, LR halving) are folds over a run's epochs in order:
`aggregate` over the epoch-sorted array of each run. A run has as many epochs as training
was configured for, so this group is small by nature; everything that grows with the data
(batches) is reduced by plain grouped aggregation or windows first.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.operators.numbering import number_rows, running_totals

HISTORY_COLS = ["run", "epoch", "loss", "accuracy", "val_loss", "val_accuracy"]


def batch_log_from_events(events: DataFrame, epochs: int = 10) -> DataFrame:
    """Fixture mapping of an event stream onto a training log: run = user_id, steps in ts
    order, each run's steps cut into `epochs` equal epochs (a run trains for a configured
    number of epochs, however much data it has), loss = value, correct = props.k of n = 100.
    Step numbers are bucketed by hour, so a very active user is not one task; epoch and
    batch numbers are plain integer arithmetic on (step, run length)."""
    e = events.select(F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("batch_loss"),
                      F.get_json_object("props", "$.k").cast("int").alias("correct"))
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000)).cast("long")
    n = number_rows(e, [F.col("ts"), F.col("event_id")], hour, ["run"], "step")
    lengths = e.groupBy("run").agg(F.count(F.lit(1)).alias("__len"))
    j = n.join(lengths, "run").withColumn("__s", F.col("step") - 1)
    epoch = F.expr(f"(__s * {epochs}) div __len")
    first = F.expr(f"(__e * __len + {epochs - 1}) div {epochs}")
    j = j.withColumn("__e", epoch)
    return j.select("run", F.col("__e").cast("int").alias("epoch"), (F.col("__s") - first + 1).cast("int").alias("batch"),
                    "batch_loss", "correct", F.lit(100).cast("long").alias("n"))


def epoch_summary(batch_log: DataFrame) -> DataFrame:
    """Epoch loss = mean of batch means (unweighted); accuracy = sum(correct) / sum(n), 0 if empty."""
    return batch_log.groupBy("run", "epoch").agg(
        F.avg("batch_loss").alias("loss"),
        F.when(F.sum("n") > 0, F.sum("correct") / F.sum("n")).otherwise(F.lit(0.0)).alias("accuracy"))


def running_progress(batch_log: DataFrame, every: int = 200) -> DataFrame:
    """Running mean loss and accuracy inside each epoch, reported every `every` batches and
    at the last batch. Running sums are bucketed by batch range, so one huge epoch is
    spread over many tasks."""
    r = running_totals(batch_log, {"__sl": F.col("batch_loss"), "__sc": F.col("correct"), "__sn": F.col("n")},
                       [F.col("batch")], F.floor(F.col("batch") / F.lit(4096)).cast("long"), ["run", "epoch"])
    last = batch_log.groupBy("run", "epoch").agg(F.max("batch").alias("n_batches"))
    r = r.join(last, ["run", "epoch"]).where((F.col("batch") % every == 0) | (F.col("batch") == F.col("n_batches")))
    return r.select("run", "epoch", "batch", (F.col("__sl") / F.col("batch")).alias("avg_loss"),
                    (F.col("__sc") / F.greatest(F.col("__sn"), F.lit(1))).alias("accuracy"), "n_batches")


def history_from_batch_log(batch_log: DataFrame) -> DataFrame:
    """Per epoch: train metrics from all batches (A17/A18 rules); validation metrics from the
    epoch's last batch (the end-of-epoch evaluation in this fixture mapping)."""
    return batch_log.groupBy("run", "epoch").agg(
        F.avg("batch_loss").alias("loss"),
        F.when(F.sum("n") > 0, F.sum("correct") / F.sum("n")).otherwise(F.lit(0.0)).alias("accuracy"),
        F.max_by("batch_loss", "batch").alias("val_loss"),
        (F.max_by("correct", "batch") / F.lit(100.0)).alias("val_accuracy"))


def normalise_history(df: DataFrame) -> DataFrame:
    """Accept either key set (loss/accuracy or train_loss/train_accuracy); missing -> null."""
    def col(name):
        return F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")
    extra = [c for c in ("model",) if c in df.columns]
    return df.select(*extra, "run", "epoch", F.coalesce(col("loss"), col("train_loss")).alias("loss"),
                     F.coalesce(col("accuracy"), col("train_accuracy")).alias("accuracy"),
                     col("val_loss").alias("val_loss"), col("val_accuracy").alias("val_accuracy"))


def union_histories(frames: dict[str, DataFrame]) -> DataFrame:
    """Histories of several models in one long table with a `model` column."""
    out = None
    for name, df in frames.items():
        d = normalise_history(df).withColumn("model", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def _epochs(history: DataFrame, *cols: str) -> DataFrame:
    return history.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("epoch", *cols))).alias("eps"),
                                      F.max("epoch").alias("last_epoch"))


def _state(best: Column, cnt: Column, stop: Column, reason: Column) -> Column:
    return F.struct(best.cast("double").alias("best"), cnt.cast("int").alias("cnt"),
                    stop.cast("int").alias("stop"), reason.cast("string").alias("reason"))


def _finish(g: DataFrame, fold: Column) -> DataFrame:
    r = g.select("run", "last_epoch", fold.alias("s"))
    stop = F.coalesce(F.col("s.stop"), F.col("last_epoch"))
    return r.select("run", stop.alias("stop_epoch"), F.coalesce(F.col("s.reason"), F.lit("completed")).alias("reason"),
                    F.col("s.best").alias("best_accuracy"), (stop + 1).alias("epochs_run"))


def plateau_stop_keras(history: DataFrame, target: float = 0.995, min_delta: float = 0.001,
                       patience: int = 3, min_epoch: int = 2) -> DataFrame:
    """Variant A: monitor val_accuracy (else accuracy, else 0). Target reached -> stop.
    A gain >= min_delta moves best and resets the counter; anything else counts, best stays.
    Stop when counter >= patience and epoch >= min_epoch."""
    g = _epochs(history, "val_accuracy", "accuracy")

    def step(acc, x):
        cur = F.coalesce(x["val_accuracy"], x["accuracy"], F.lit(0.0))
        hit = cur >= F.lit(target)
        ok = (cur - acc["best"]) >= F.lit(min_delta)
        best = F.when(hit, acc["best"]).when(ok, cur).otherwise(acc["best"])
        cnt = F.when(hit, acc["cnt"]).when(ok, F.lit(0)).otherwise(acc["cnt"] + 1)
        plateau = (cnt >= patience) & (x["epoch"] >= min_epoch)
        stop = F.when(hit | plateau, x["epoch"])
        reason = F.when(hit, F.lit("target")).when(plateau, F.lit("plateau"))
        return F.when(acc["stop"].isNotNull(), acc).otherwise(_state(best, cnt, stop, reason))

    init = _state(F.lit(0.0), F.lit(0), F.lit(None), F.lit(None))
    return _finish(g, F.aggregate("eps", init, step))


def plateau_stop_torch(history: DataFrame, target: float = 0.995, min_delta: float = 0.0005,
                       patience: int = 3, min_epoch: int = 1) -> DataFrame:
    """Variant B: monitor val_accuracy. Target reached -> stop (best not updated). A gain
    >= min_delta moves best and resets; a smaller positive gain moves best and leaves the
    counter; otherwise the counter grows. Stop when counter >= patience and epoch >= min_epoch."""
    g = _epochs(history, "val_accuracy")

    def step(acc, x):
        cur = F.coalesce(x["val_accuracy"], F.lit(0.0))
        hit = cur >= F.lit(target)
        imp = cur - acc["best"]
        big, small = imp >= F.lit(min_delta), cur > acc["best"]
        best = F.when(hit, acc["best"]).when(big | small, cur).otherwise(acc["best"])
        cnt = F.when(hit, acc["cnt"]).when(big, F.lit(0)).when(small, acc["cnt"]).otherwise(acc["cnt"] + 1)
        plateau = (cnt >= patience) & (x["epoch"] >= min_epoch)
        stop = F.when(hit | plateau, x["epoch"])
        reason = F.when(hit, F.lit("target")).when(plateau, F.lit("plateau"))
        return F.when(acc["stop"].isNotNull(), acc).otherwise(_state(best, cnt, stop, reason))

    init = _state(F.lit(0.0), F.lit(0), F.lit(None), F.lit(None))
    return _finish(g, F.aggregate("eps", init, step))


def early_stop_loss(history: DataFrame, patience: int = 5) -> DataFrame:
    """Early stopping on val_loss: an epoch improves when its val_loss is strictly below
    every earlier one; stop at the first epoch `patience` epochs after the last
    improvement. best_epoch = the best epoch up to the stop (first on ties)."""
    w = Window.partitionBy("run").orderBy("epoch")
    prev = F.min("val_loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = history.select("run", "epoch", "val_loss",
                       (prev.isNull() | (F.col("val_loss") < prev)).alias("improved"))
    h = h.withColumn("last_imp", F.max(F.when(F.col("improved"), F.col("epoch"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("wait", F.col("epoch") - F.col("last_imp"))
    stops = h.groupBy("run").agg(F.min(F.when(F.col("wait") >= patience, F.col("epoch"))).alias("stop_epoch"),
                                 F.max("epoch").alias("last_epoch"))
    j = h.join(stops, "run").where(F.col("epoch") <= F.coalesce("stop_epoch", "last_epoch"))
    best = j.groupBy("run").agg(F.min_by("epoch", F.struct("val_loss", "epoch")).alias("best_epoch"),
                                F.min("val_loss").alias("best_val_loss"))
    return stops.join(best, "run").select("run", "stop_epoch", "best_epoch", "best_val_loss")


def lr_schedule(history: DataFrame, lr0: float = 0.001, factor: float = 0.5, patience: int = 3,
                min_lr: float = 1e-7, min_delta: float = 1e-4) -> DataFrame:
    """Learning rate in effect during each epoch under halving on a val_loss plateau: an
    improvement must beat best - min_delta; after `patience` epochs without one the rate
    is multiplied by `factor` (not below `min_lr`) and the counter restarts."""
    g = _epochs(history, "val_loss")
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("wait"), F.lit(float(lr0)).alias("lr"),
                    F.array().cast("array<struct<epoch:int,lr:double>>").alias("lrs"))

    def step(acc, x):
        cur = x["val_loss"]
        better = cur < acc["best"] - F.lit(min_delta)
        wait1 = F.when(better, F.lit(0)).otherwise(acc["wait"] + 1)
        cut = (~better) & (wait1 >= patience) & (acc["lr"] > F.lit(min_lr))
        return F.struct(F.when(better, cur).otherwise(acc["best"]).alias("best"),
                        F.when(cut, F.lit(0)).otherwise(wait1).alias("wait"),
                        F.when(cut, F.greatest(acc["lr"] * F.lit(factor), F.lit(min_lr))).otherwise(acc["lr"]).alias("lr"),
                        F.concat(acc["lrs"], F.array(F.struct(x["epoch"].cast("int").alias("epoch"), acc["lr"].alias("lr")))).alias("lrs"))

    s = g.select("run", F.aggregate("eps", init, step)["lrs"].alias("lrs"))
    return s.select("run", F.explode("lrs").alias("x")).select("run", "x.epoch", "x.lr")


def best_epoch(history: DataFrame) -> DataFrame:
    """Best epoch by lowest val_loss and by highest val_accuracy (first epoch on ties)."""
    return history.groupBy("run").agg(
        F.min_by("epoch", F.struct("val_loss", "epoch")).alias("best_loss_epoch"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("epoch", F.struct(F.col("val_accuracy"), -F.col("epoch"))).alias("best_acc_epoch"),
        F.max("val_accuracy").alias("best_val_accuracy"))


def history_columnar(history: DataFrame) -> DataFrame:
    """One row per run with one epoch-ordered list per metric (the JSON history layout), and the epoch numbers.
    A run's epochs, as many as training was configured for, are gathered in one row."""
    g = history.groupBy("run").agg(F.array_sort(F.collect_list(F.struct(*HISTORY_COLS[1:]))).alias("h"))
    return g.select("run", *[F.col("h")[c].alias(c) for c in HISTORY_COLS[1:]])


def history_from_columnar(df: DataFrame) -> DataFrame:
    """Inverse of history_columnar: zip the metric lists, one row per epoch. Either key set is accepted; without
    an `epoch` list epochs are numbered by position from 0."""
    names = [c for c in [*HISTORY_COLS[2:], "train_loss", "train_accuracy"] if c in df.columns]
    lists = (["epoch"] if "epoch" in df.columns else []) + names
    z = df.select("run", F.posexplode(F.arrays_zip(*[F.col(c) for c in lists])).alias("__at", "m"))
    epoch = F.col("m")["epoch"] if "epoch" in df.columns else F.col("__at")
    return normalise_history(z.select("run", epoch.cast("int").alias("epoch"), *[F.col("m")[c].cast("double").alias(c) for c in names]))
