"""Word vectors by random indexing over PPMI-weighted co-occurrences.

A word's vector is the sum, over the words it stands near, of their index vectors (a few +1 and -1 entries by keyed hash of
the word's id) weighted by positive pointwise mutual information. All sums are grouped aggregates over whole numbers
(information in units of 1/1000, rounded down), so the vectors do not depend on order or partitioning, no model lives on the
driver, and SQL can restate them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.functions.hashing import keyed_hash
from simpairs.functions.text import RESERVED_TOKENS
from simpairs.operators.encode import encode
from simpairs.operators.lookup import lookup
from simpairs.sources.shared import checkpointed

WINDOW, NONZERO, UNITS = 2, 4, 1000
_SHIFT = 31


def cooccurrences(encoded: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a, b, n), a <= b: how often two vocabulary words stand at most `window` places apart. Reserved ids (unknown
    words too) count as places, never as words. One number per place leaves a text, into a partial aggregate."""
    first = len(RESERVED_TOKENS)
    n = F.size("seq")

    def at(d):
        both = lambda x, y: F.when((x >= first) & (y >= first), F.shiftleft(F.least(x, y).cast("long"), _SHIFT) + F.greatest(x, y))
        left = F.greatest(n - d, F.lit(0))
        return F.zip_with(F.slice("seq", F.lit(1), left), F.slice("seq", F.lit(d + 1), left), both)
    key = F.explode(F.concat(*[at(d) for d in range(1, window + 1)])).alias("key")
    pairs = encoded.select(key).where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select(F.shiftright("key", _SHIFT).cast("int").alias("a"),
                        F.col("key").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int").alias("b"), "n")


def index_vectors(words: DataFrame, vector_size: int, seed: int) -> DataFrame:
    """words(id, ..) -> and `ix`: the entries (dim, sign) of the id's index vector; entries of one dimension add up."""
    entry = lambda j: F.struct(
        (keyed_hash(seed, "ri_dim", F.concat_ws(":", "id", F.lit(str(j)))) % vector_size).cast("int").alias("dim"),
        (1 - 2 * (keyed_hash(seed, "ri_sign", F.concat_ws(":", "id", F.lit(str(j)))) % 2)).alias("sign"))
    return words.withColumn("ix", F.array(*[entry(j) for j in range(NONZERO)]))


def word_vectors(clauses: DataFrame, vocab: DataFrame, cfg: PairConfig = PairConfig(), vector_size: int = 32,
                 window: int = WINDOW) -> DataFrame:
    """(idx, word, vector ARRAY<BIGINT>), one row per vocabulary word, in units of 1/1000; zeros for a word that stands near
    none. Both lookups of a pair's words deal frequent words evenly (`lookup`)."""
    pairs = checkpointed(cooccurrences(encode(clauses, vocab), window))
    # a pair counts once for each of its words, twice for a word beside itself
    own = pairs.select(F.col("a").alias("id"), "n").unionByName(pairs.select(F.col("b").alias("id"), "n"))
    words = checkpointed(index_vectors(own.groupBy("id").agg(F.sum("n").alias("n")), vector_size, cfg.seed))
    total = words.select(F.sum("n")).scalar()
    side = [words.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("ix").alias(f"ix_{c}")) for c in "ab"]
    wide = 64 + 48 * NONZERO
    j = lookup(lookup(pairs, "a", side[0], entry_bytes=wide), "b", side[1], entry_bytes=wide)
    c = F.col("n") * F.when(F.col("a") == F.col("b"), 2).otherwise(1)
    ratio = c.cast("double") * total.cast("double") / (F.col("n_a").cast("double") * F.col("n_b").cast("double"))
    v = j.withColumn("v", F.floor(F.lit(float(UNITS)) * F.log(ratio))).where("v > 0")
    to = lambda w, ix: F.transform(ix, lambda e: F.struct(F.col(w).alias("idx"), e["dim"].alias("dim"), (e["sign"] * F.col("v")).alias("v")))
    sent = F.concat(to("a", F.col("ix_b")), F.when(F.col("a") == F.col("b"), F.slice(to("b", F.col("ix_a")), 1, 0)).otherwise(to("b", F.col("ix_a"))))
    sums = v.select(F.explode(sent).alias("e")).groupBy("e.idx", "e.dim").agg(F.sum("e.v").alias("v"))
    found = sums.groupBy("idx").agg(F.map_from_entries(F.collect_list(F.struct("dim", "v"))).alias("m"))
    entries = F.array(*[F.coalesce(F.try_element_at("m", F.lit(d)), F.lit(0).cast("long")) for d in range(vector_size)])
    regular = vocab.where(F.col("idx") >= len(RESERVED_TOKENS))
    return regular.join(found, "idx", "left").select("idx", "word", entries.alias("vector"))
