"""Operator 9, quality classifier: naive Bayes support vectors.

Features are indicators of byte trigrams, of trigrams of word shapes (which kinds of bytes a word
has, whether it repeats the word before) and of the length class of the text, hashed into
`FEATURES` buckets. Each indicator is scaled by its class log-count ratio; a linear hinge-loss
model over the scaled indicators is then fitted by dual coordinate descent.

Bound: the model is fitted on at most `sample_rows` labelled documents, those of the smallest
keyed hash of the id, in one task; everything else runs over all rows. Scoring is one pass over the whole texts
without a shuffle; the model (one float per bucket, a fixed size) is sent to every task. Only the
text is an input of the score.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import boxed, whole_text

BITS = 18
FEATURES = 1 << BITS
SAMPLE_ROWS = 8000
PIECE = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)

# byte kinds: 1 lower, 2 upper, 4 digit, 8 other ASCII, 16 beyond ASCII
_KIND = np.full(256, 8, np.uint8)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 4
_KIND[128:] = 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _bucket(codes: np.ndarray, family: int) -> np.ndarray:
    mixed = (codes.astype(np.uint64) + np.uint64(family << 40)) * _MULT
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def _word_shapes(b: np.ndarray, before: np.uint64) -> tuple[np.ndarray, np.uint64]:
    """One 6-bit shape per word of the bytes `b`, and the last word's fingerprint; bit 5: the word equals
    the one before it, for the first one the one of fingerprint `before`."""
    space = _SPACE[b]
    inner = ~space
    starts = np.flatnonzero(inner & np.r_[True, space[:-1]])
    if not len(starts):
        return np.zeros(0, np.int64), before
    kind = np.where(space, np.uint8(0), _KIND[b])
    shape = np.bitwise_or.reduceat(kind, starts).astype(np.int64)
    # a word's fingerprint: its bytes weighted by their place in the word, spaces adding nothing
    place = np.arange(len(b)) - np.repeat(starts, np.diff(np.r_[starts, len(b)])) if starts[0] == 0 else \
        np.arange(len(b)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(b)]))
    weight = (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MULT
    name = np.add.reduceat(np.where(space, np.uint64(0), (b.astype(np.uint64) + np.uint64(1)) * (weight ^ (weight >> np.uint64(29)))), starts)
    shape |= (name == np.r_[before, name[:-1]]).astype(np.int64) << 5
    return shape, name[-1]


def features(text: str, last: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text. `last`: scratch of FEATURES int32, any contents."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    found, at = [], 0
    shapes, before = [np.zeros(0, np.int8)], np.uint64(0)
    while at < len(b):  # pieces of a long text end at white space where they can
        end = min(len(b), at + PIECE)
        if end < len(b):
            gaps = np.flatnonzero(_SPACE[b[at:end]])
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        padded = np.concatenate(([32, 32] if not at else b[at - 2:at], b[at:end], [32] if end == len(b) else [])).astype(np.uint32)
        found.append(_bucket(padded[:-2] << np.uint32(16) | padded[1:-1] << np.uint32(8) | padded[2:], 1))
        own, before = _word_shapes(b[at:end], before)
        shapes.append(own.astype(np.int8))
        at = end
    shapes = np.concatenate(shapes).astype(np.int64)
    if len(shapes):
        s = np.concatenate(([64, 64], shapes, [64]))
        found.append(_bucket(s[:-2] << 14 | s[1:-1] << 7 | s[2:], 2))
    found.append(_bucket(np.array([len(shapes).bit_length()]), 3))
    found.append(_bucket(np.array([0]), 4))  # bias
    codes = np.concatenate(found)
    at = np.arange(len(codes), dtype=np.int32)
    last[codes] = at
    return codes[last[codes] == at]


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, sweeps: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights per bucket, the log-count ratios multiplied in, and the ratios. One class only, or no rows: a
    constant model."""
    if len(set(labels.tolist())) < 2:
        w = np.zeros(FEATURES, np.float32)
        w[_bucket(np.array([0]), 4)] = 1.0 if not len(labels) or labels[0] else -1.0
        return w, np.ones(FEATURES, np.float32)
    counts = []
    for y in (1, 0):
        c = np.ones(FEATURES)
        for r, lab in zip(rows, labels):
            if lab == y:
                c[r] += 1
        counts.append(c)
    n1, n0 = (labels == 1).sum() + 2, (labels == 0).sum() + 2
    ratio = np.log((counts[0] / n1) / (counts[1] / n0))
    ratio[_bucket(np.array([0]), 4)] = 1.0
    y = np.where(labels == 1, 1.0, -1.0)
    values = [ratio[r] for r in rows]
    values = [v / max(np.linalg.norm(v), 1e-9) for v in values]
    w, alpha = np.zeros(FEATURES), np.zeros(len(rows))
    # rows have unit length, so a step along one coordinate of the dual is the margin's shortfall itself
    share = {1.0: 0.5 / (y > 0).mean(), -1.0: 0.5 / (y < 0).mean()}
    rng = np.random.default_rng(seed)
    for _ in range(sweeps):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            top = cost * share[y[i]]
            step = np.clip(alpha[i] + 1.0 - y[i] * (w[rows[i]] @ values[i]), 0.0, top) - alpha[i]
            if step:
                alpha[i] += step
                w[rows[i]] += step * y[i] * values[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return (w * ratio).astype(np.float32), ratio.astype(np.float32)


def _score(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(4.0 * margin, -60, 60))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> tuple[bytes, bytes]:
    """Fit on at most `sample_rows` ids of `labels` (id, 0/1; null labels and ids are no examples) and one row of `docs` for each,
    however many repeat an id (that of the least features)."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.min(F.col(label_col).cast("int")).alias("__y"))
           .orderBy(F.xxhash64(F.col("__id").cast("string"), F.lit(9)), "__id").limit(sample_rows))
    # at most sample_rows ids and labels: a proven bound
    picked = (docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text"))
              .join(F.broadcast(lab), "__id").select("__id", "__y", "__text"))

    def extract(batches):
        last = np.zeros(FEATURES, np.int32)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["__id"].astype(str), "y": pdf["__y"],
                                "f": [features(t, last).tobytes() for t in pdf["__text"]]})

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "f"])
        weights, ratio = fit([np.frombuffer(f, np.int32) for f in pdf["f"]], pdf["y"].to_numpy())
        return pd.DataFrame({"w": [weights.tobytes()], "r": [ratio.tobytes()]})

    examples = picked.mapInPandas(extract, "id string, y int, f binary").groupBy("id").agg(F.min("y").alias("y"), F.min("f").alias("f"))
    model = (examples.groupBy(F.lit(1).alias("one"))
             .applyInPandas(solve, "w binary, r binary").first())
    if model is None:  # no labelled rows at all: every text counts as good
        return tuple(x.tobytes() for x in fit([], np.zeros(0, int)))
    return bytes(model["w"]), bytes(model["r"])


def score(docs: DataFrame, model: tuple[bytes, bytes], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns of docs (all by default) plus `__score`: 0 to 1, higher is better. Null texts count
    as empty; an empty text has the length class and the bias as its features."""
    keep = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(model)
    @F.pandas_udf("double")
    def text_score(texts: pd.Series) -> pd.Series:
        weights, ratio = (np.frombuffer(x, np.float32) for x in sent.value)
        last = np.zeros(FEATURES, np.int32)
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            f = features(t, last)
            out[i] = _score(weights[f].sum() / max(np.sqrt(np.square(ratio[f], dtype=np.float64).sum()), 1e-9))
        return pd.Series(out)

    return docs.select(*keep, text_score(whole_text(text_col)).alias("__score"))


def held_out(id_col: str = "doc_id"):
    """Every third id, by crc32 of its text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, held_out, score, predicted, one row per input row (repeated rows and null ids too). Learns only
    from rows not held out. Other columns of either table are not read; empty tables give no rows."""
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col)
    scored = score(docs, model, text_col, [id_col])
    return scored.select(id_col, held_out(id_col).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` scored 0.5 or more, with its columns, whatever their names. Null texts and ids, repeated rows and empty
    tables as in `classify`."""
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col)
    rows = boxed(docs, text=F.col(text_col))
    return score(rows, model, "text", ["all"]).where(F.col("__score") >= 0.5).select("all.*")
