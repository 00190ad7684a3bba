"""Pair features, similarity scores and vector pooling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.functions.arrays import dot, norm, pair_features
from simpairs.operators.blocks import id_counts, id_sets, pooled_sets, word_sets, words_of
from simpairs.sources.shared import checkpointed, released

#: ids and vectors that the clause encoder broadcasts at most
POOL_BYTES = 32 << 20


def attach_vectors(pairs: DataFrame, items: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """pairs(id1, id2, ...) + items(clause_id, vec) -> pairs with e1, e2."""
    v1 = items.select(F.col("clause_id").alias("id1"), F.col(vec_col).alias("e1"))
    v2 = items.select(F.col("clause_id").alias("id2"), F.col(vec_col).alias("e2"))
    return pairs.join(v1, "id1").join(v2, "id2")


def with_pair_features(df: DataFrame, a: str = "e1", b: str = "e2", out: str = "features") -> DataFrame:
    return df.withColumn(out, pair_features(a, b))


def cosine(a, b, norms: Column | None = None) -> Column:
    """`norms`: the product of the two norms, where it is known."""
    d = norm(a) * norm(b) if norms is None else norms
    return F.when(d > 0, dot(a, b) / d).otherwise(F.lit(0.0))


def cosine_probability(a, b, norms: Column | None = None) -> Column:
    """Cosine mapped to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (cosine(a, b, norms) + F.lit(1.0)) / F.lit(2.0)))


def token_jaccard(t1, t2) -> Column:
    """|t1 & t2| / |t1 | t2| of two sets, given as arrays of distinct tokens; 0 when both are empty. One intersection per pair:
    the union's size follows from it."""
    both = F.size(F.array_intersect(t1, t2))
    return both / F.greatest(F.size(t1) + F.size(t2) - both, F.lit(1))


def jaccard_scores(pairs: DataFrame, clauses: DataFrame) -> DataFrame:
    """pairs(pair_id, id1, id2, label) -> + probability (token-set Jaccard of whole texts).
    Each clause is tokenised where it is read; its set travels as 64-bit names of the words (`blocks.word_sets`), no text is moved."""
    toks = word_sets(clauses, "clause_id", words_of(clauses), "t")
    t1 = toks.select(F.col("clause_id").alias("id1"), F.col("t").alias("t1"))
    t2 = toks.select(F.col("clause_id").alias("id2"), F.col("t").alias("t2"))
    j = pairs.join(t1, "id1").join(t2, "id2")
    return j.withColumn("probability", token_jaccard("t1", "t2").cast("double")).drop("t1", "t2")


def cosine_scores(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """An item's norm is taken once, and travels with its vector."""
    v = items.select("clause_id", F.struct(F.col("embedding").alias("e"), norm("embedding").alias("n")).alias("v"))
    j = attach_vectors(pairs, v, "v")
    p = cosine_probability(F.col("e1.e"), F.col("e2.e"), F.col("e1.n") * F.col("e2.n"))
    return j.withColumn("probability", p).drop("e1", "e2")


def max_pool(df: DataFrame, group_cols: list[str], vec_col: str, out: str = "pooled") -> DataFrame:
    """Element-wise max over the vectors of each group (partial aggregation in the JVM)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = df.select(*group_cols, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    g = v.groupBy(*group_cols).agg(Summarizer.max(F.col("__v")).alias("__m"))
    return g.select(*group_cols, vector_to_array("__m").alias(out))


def init_vectors(vocab: DataFrame, dim: int = 8, seed: int = 42) -> DataFrame:
    """(idx, vector): an untrained embedding table with one vector for every vocabulary id, each entry uniform in
    [-0.05, 0.05) by keyed hash of (id, dimension)."""
    from simpairs.functions.hashing import keyed_hash
    entry = lambda d: (keyed_hash(seed, "emb", F.concat_ws(":", "idx", F.lit(str(d)))) % 100_000 / 100_000.0 - 0.5) / 10.0
    return vocab.select("idx", F.array(*[entry(d) for d in range(dim)]).alias("vector"))


def _hot_vectors(sets: DataFrame, token_vectors: DataFrame):
    """(ids ascending, their vectors as one row per dimension, whether these are all): the ids that most clauses hold, as many as POOL_BYTES take.
    The driver sees these and a table of one row per count."""
    import numpy as np
    known = token_vectors.where(F.col("idx").isNotNull() & F.col("vector").isNotNull()).select(F.col("idx").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    width = (known.select(F.size("vector").alias("w")).first() or [0])["w"] if not known.isEmpty() else 0
    most, hot = POOL_BYTES // (8 * width + 8), known
    whole = known.count() <= most
    if not whole:
        counts = checkpointed(id_counts(sets))
        total, least = 0, 1 << 62
        for r in counts.groupBy("rows").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("rows")).toLocalIterator():
            total += r["n"]
            if total > most:
                break
            least = r["rows"]
        hot = known.join(counts.where(F.col("rows") >= least), "id", "left_semi")
    t = hot.toArrow().combine_chunks()
    vectors = t.column("vector").combine_chunks()
    if t.num_rows and len(vectors.flatten()) != width * t.num_rows or vectors.flatten().null_count:
        raise ValueError("token vectors of different sizes, or with missing entries")
    ids = t.column("id").to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    # what `max_pool` takes for NaN
    values = np.fmax(vectors.flatten().to_numpy().reshape(-1, width), np.finfo(np.float64).min) if width else np.zeros((len(ids), 0))
    return ids[order], np.ascontiguousarray(values[order].T), whole


def clause_encoding(encoded: DataFrame, token_vectors: DataFrame, include_padding: bool = False,
                    id_col: str = "clause_id") -> DataFrame:
    """Token ids -> token vectors (equi lookup) -> max pool per clause, one row per clause; the encoding is null
    for a clause none of whose ids has a vector. token_vectors(idx, vector DOUBLE[]). The maximum does not
    change with repetition, so each clause looks up its distinct ids only.

    `encoded` is evaluated once, into blocks of clauses with their distinct ids. The vectors of the ids that most clauses hold are broadcast, up to
    POOL_BYTES, and pooled where the blocks are; a row per clause and one per other id, of which few clauses hold each, are shuffled."""
    spark, seq = encoded.sparkSession, F.col("seq")
    sets = id_sets(encoded, id_col, seq if include_padding else F.filter(seq, lambda x: x != 0))
    released(spark)
    *hot, whole = _hot_vectors(sets, token_vectors)
    part = checkpointed(pooled_sets(sets, id_col, encoded.schema[id_col].dataType.simpleString(), spark.sparkContext.broadcast(tuple(hot))))
    found = part.select(id_col, "vector").where(F.col("vector").isNotNull())
    if not whole:
        rest = part.select(id_col, F.explode("rest").alias("__id")).join(token_vectors.select(F.col("idx").cast("long").alias("__id"), "vector"), "__id")
        found = found.unionByName(rest.where(F.col("vector").isNotNull()).select(id_col, F.col("vector").cast("array<double>").alias("vector")))
    pooled = max_pool(found, [id_col], "vector", "encoding")
    return part.select(id_col).join(pooled, id_col, "left")
