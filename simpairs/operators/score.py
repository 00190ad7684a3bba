"""Scored tables: probability post-processing, a pluggable batch scorer, an MLlib classifier."""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.functions.scoring import clip01, sigmoid, threshold
from simpairs.sources.shared import by_value

#: ids of a padded matrix that a scorer is called with, unless one row is longer
CALL_IDS = 1 << 22
#: a partition of training rows holds about so many
TRAIN_ROWS = 8192
SCORED_COLS = ["model", "pair_id", "label", "probability", "predicted"]


def to_scored(df: DataFrame, model: str, t: float = 0.5, prob_col: str = "probability",
              input_kind: str = "probability") -> DataFrame:
    """(pair_id, label, score) -> scored(model, pair_id, label, probability, predicted).
    `input_kind='logit'` applies a sigmoid first (decided by the caller, not guessed)."""
    p = F.col(prob_col).cast("double")
    if input_kind == "logit":
        p = sigmoid(p)
    elif input_kind != "probability":
        raise ValueError(input_kind)
    return df.select(F.lit(model).alias("model"), "pair_id", F.col("label").cast("int").alias("label"),
                     clip01(p).alias("probability")).withColumn("predicted", threshold("probability", t))


def padded(*columns) -> list:
    """Arrow list columns of ids -> int32 matrices of one width, that of the longest list; null lists count as empty."""
    import numpy as np
    sizes = [np.diff(c.offsets.to_numpy()) for c in columns]
    width = max(int(n.max()) if len(n) else 0 for n in sizes)
    out = []
    for c, n in zip(columns, sizes):
        m = np.zeros((len(n), width), np.int32)
        first = np.cumsum(n) - n
        row = np.repeat(np.arange(len(n)), n)
        m[row, np.arange(int(n.sum())) - np.repeat(first, n)] = c.values.to_numpy(zero_copy_only=False)[c.offsets[0].as_py():c.offsets[-1].as_py()]
        out.append(m)
    return out


def batch_score(pair_seq: DataFrame, factory: Callable[[], Callable], model: str, cfg: PairConfig = PairConfig(),
                input_kind: str = "probability", batch_size: int | None = None) -> DataFrame:
    """Pluggable scorer, for tables and streams alike (it keeps no state). `factory()` runs once per task (load the model
    there) and returns `scorer(seq1: np.ndarray[n, L], seq2: np.ndarray[n, L]) -> np.ndarray[n]`, which is called with at most
    `batch_size` rows (default: the Arrow batch). Sequences may be ragged and whole: a call's rows are padded with PAD to
    the longest of them, so L changes from call to call. Rows of an Arrow batch go to the calls by length, and a call of several
    rows pads them to `CALL_IDS` ids a side at most, so that one long text does not widen short ones. Arrow's nested arrays become matrices by their offsets and
    values, without an object per row. A result of another length raises. It goes through the same
    clip/threshold as every other model."""
    by_value()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        scorer = None
        for batch in batches:
            width = np.max([np.diff(batch.column(c).offsets.to_numpy()) for c in ("seq1", "seq2")], axis=0)
            order, at = np.argsort(width, kind="stable"), 0
            while at < batch.num_rows:
                rows = min(batch_size or batch.num_rows, batch.num_rows - at)
                # widths ascend: the widest row of a call is its last
                while rows > 1 and int(width[order[at + rows - 1]]) * rows > CALL_IDS:
                    rows = max(1, min(rows - 1, CALL_IDS // max(1, int(width[order[at + rows - 1]]))))
                part, at = batch.take(pa.array(order[at:at + rows])), at + rows
                scorer = scorer or factory()
                out = np.asarray(scorer(*padded(part.column("seq1"), part.column("seq2"))), dtype="float64")
                if out.shape not in ((part.num_rows,), (part.num_rows, 1)):
                    raise ValueError(f"scorer returned shape {out.shape} for {part.num_rows} pairs")
                yield pa.RecordBatch.from_arrays([part.column("pair_id"), part.column("label"), pa.array(out.reshape(-1))], ["pair_id", "label", "raw"])

    raw = pair_seq.select(F.col("pair_id").cast("long"), "seq1", "seq2", F.col("label").cast("int")).mapInArrow(
        run, "pair_id long, label int, raw double")
    return to_scored(raw, model, cfg.threshold, "raw", input_kind)


def dealt(rows: DataFrame) -> DataFrame:
    """Training rows over as many partitions as their number asks for: a split leaves a label's rows in a few, and every
    iteration of a fit reads them all."""
    wanted = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / TRAIN_ROWS))
    return rows.repartition(wanted) if wanted > rows.rdd.getNumPartitions() else rows


def train_classifier(train: DataFrame, val: DataFrame, n_features: int, cfg: PairConfig = PairConfig(),
                     epochs: int | None = None, iters_per_epoch: int = 20, hidden=(64, 32), features_col: str = "features",
                     target: float = 0.995, patience: int = 5):
    """MLlib MLP on pair features (dense 64 -> 32 -> 2; L-BFGS, so the learning rate is not used), warm-started
    epoch by epoch. After each epoch the plateau and early-stop rules of `history` are applied to
    the log; training ends when one fires or after `epochs`.
    Returns (best model by validation accuracy, history(run, epoch, loss, accuracy, val_loss, val_accuracy))."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from simpairs.functions.scoring import bce
    from simpairs.operators import history as hi

    def prep(d):
        return d.select(array_to_vector(F.col(features_col).cast("array<double>")).alias("features"),
                        F.col("label").cast("double").alias("label"))

    spark = train.sparkSession
    tr, va = dealt(prep(train)).cache(), dealt(prep(val)).cache()
    rows, weights, best, best_acc = [], None, None, -1.0
    log = None
    for epoch in range(cfg.epochs if epochs is None else epochs):
        mlp = MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], seed=cfg.seed, maxIter=iters_per_epoch, blockSize=128)
        if weights is not None:
            mlp.setInitialWeights(weights)
        model = mlp.fit(tr)
        weights = model.weights
        seen = []
        for d in (tr, va):
            p = model.transform(d).select("label", "prediction", vector_to_array("probability")[1].alias("p"))
            m = p.agg(F.avg(bce("label", "p")).alias("loss"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc")).first()
            seen += [m["loss"], m["acc"] or 0.0]
        rows.append((0, epoch, *seen))
        if seen[3] > best_acc:
            best, best_acc = model, seen[3]
        log = spark.createDataFrame(rows, "run long, epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
        if (hi.plateau_stop_torch(log, target=target).first()["reason"] != "completed"
                or hi.early_stop_loss(log, patience).first()["stop_epoch"] is not None):
            break
    tr.unpersist()
    va.unpersist()
    return best, log


def classifier_scores(model, pairs: DataFrame, name: str, cfg: PairConfig = PairConfig(),
                      features_col: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array
    d = pairs.select("pair_id", "label", array_to_vector(F.col(features_col).cast("array<double>")).alias("features"))
    p = model.transform(d).select("pair_id", "label", vector_to_array("probability")[1].alias("p"))
    return to_scored(p, name, cfg.threshold, "p")


def check_vocab_compatible(model_vocab_size: int, vocab: DataFrame) -> int:
    """Refuse a saved model whose vocabulary size differs from the current vocabulary's
    (ids would point at other words). Returns the current size."""
    current = vocab.count()
    if int(model_vocab_size) != current:
        raise ValueError(f"model vocabulary size {model_vocab_size} != current vocabulary size {current}; "
                         "rebuild the vocabulary the model was trained with")
    return current
