"""Operator 4, document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each five-word shingle is hashed once. The leading bits of a hash name its bin, and a bin keeps its least hash. An empty bin
probes other bins in an order of its own, a pseudo-random one that is the same for every document, and takes the first
that is filled (optimal densification). What is stored is
the low `BITS` bits of each bin, as hex. Likeness is the share m of equal bins, corrected for chance matches:
(m - 2^-BITS) / (1 - 2^-BITS), not below 0.

Scale: a fingerprint is a row-wise expression. Finding each document's successor takes one shuffle, by ranges of ids
whose number grows with the bytes; each range also receives the first row of the next one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.llm.common import bounded, cut, parts_for, whole_text

BINS, BITS, WORDS = 256, 8, 5
PROBES = 5300  # 256 bins * ln(10^9), shared out by the filled bins
RANGE_BYTES = 32 << 20
TOP_RANGES = 256


def let(value: Column, body) -> Column:
    """body(value), the value computed once per row (inside a lambda a plain expression is computed per element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = WORDS) -> Column:
    """A hash per run of `size` words; fewer words: the whole sequence as one; none: an empty array."""
    def runs(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) >= size, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), runs)


_SHIFT = 64 - (BINS - 1).bit_length()


def _bin(h: Column) -> Column:
    """Bins follow the signed order of the hashes."""
    return F.shiftright(h, _SHIFT).cast("int") + BINS // 2


def _gap(n: Column) -> Column:
    return F.array_repeat(F.lit(None).cast("int"), n)


def _bins(hashes: Column) -> Column:
    """Low bits of the least hash per bin, null where a bin is empty."""
    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(s, i - 1)), _SHIFT) != 0))

    def spread(m: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(m, i - 1)))
        filled = F.flatten(F.transform(m, lambda x, i: F.concat(
            _gap(_bin(x) - before(i) - 1), F.array(x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))))
        return F.concat(filled, _gap(F.lit(BINS - 1) - _bin(F.element_at(m, -1))))
    return let(let(F.sort_array(hashes), firsts), spread)


def _densified(bins: Column) -> Column:
    """Optimal densification: an empty bin probes bins by a hash of (bin, probe) until it meets a filled one. The number of probes
    offered follows the number of filled bins, so that one in 10^9 empty bins at most meets none; it takes the first filled
    bin. What a bin takes depends on which bins are filled and on nothing else, so two texts agree with the
    probability of their similarity, however few bins are filled."""
    def probe(of: Column):
        return lambda now, t: F.when(F.forall(now, lambda v: v.isNotNull()), now).otherwise(F.transform(
            now, lambda v, i: F.coalesce(v, F.get(of, F.pmod(F.xxhash64(i, t), F.lit(BINS)).cast("int")))))

    def run(b: Column, own: Column) -> Column:
        some = F.get(own, F.lit(0))
        offered = F.ceil(F.lit(PROBES) / F.size(own)).cast("int")
        probed = F.aggregate(F.sequence(F.lit(1), offered), b, probe(b))
        return F.when(F.size(own) == 1, F.transform(b, lambda v: some)).otherwise(F.transform(probed, lambda v: F.coalesce(v, some)))
    return let(bins, lambda b: let(F.filter(b, lambda v: v.isNotNull()), lambda own: run(b, own)))


def bins_of(text: Column) -> Column:
    """The fingerprint as an array of BINS small ints; null for a text without words."""
    return let(shingle_hashes(text), lambda h: F.when(F.size(h) > 0, _densified(_bins(h)).cast("array<smallint>")))


def packed(bins: Column) -> Column:
    """Hex, two characters a bin; '' for a text without words."""
    return F.coalesce(F.array_join(F.transform(bins, lambda v: F.lpad(F.hex(v), BITS // 4, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Two texts without words are alike; one of them is like nothing else."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda t: t)) / BINS
    chance = 2.0 ** -BITS
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance))))


def fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with a column `name`. Null texts count as empty."""
    return docs.withColumn(name, packed(bins_of(whole_text(text_col))))


def _ranges(ids: DataFrame, total: int) -> Column:
    """The range of an id, rising with it: quantile ranges, each cut evenly so that their number follows the bytes."""
    n = parts_for(total, RANGE_BYTES)
    top, each = min(n, TOP_RANGES), parts_for(n, TOP_RANGES)
    at = [k / top for k in range(1, top)]
    row = ids.agg(F.min("__id").alias("a"), F.max("__id").alias("z"),
                  *([F.percentile_approx("__id", at, 10_000).alias("q")] if at else [])).first()
    if row["a"] is None:
        return F.lit(-1).cast("long")
    edges = sorted({row["a"], *(row["q"] if at else []), row["z"] + 1})
    low = F.lit(0).cast("long")
    for k, (a, b) in reversed(list(enumerate(zip(edges, edges[1:])))):
        inside = F.least(F.floor((F.col("__id") - F.lit(a)).cast("double") * each / (b - a)).cast("long"), F.lit(each - 1).cast("long"))
        here = F.lit(k * each).cast("long") + (inside if each > 1 else F.lit(0))
        low = here if k == len(edges) - 2 else F.when(F.col("__id") < F.lit(b), here).otherwise(low)
    return F.when(F.col("__id").isNull(), F.lit(-1).cast("long")).otherwise(low)


def with_successor(docs: DataFrame, total_bytes: int) -> DataFrame:
    """docs(__id, __text) -> the same with __bins and the __next_text, __next_bins of the next row by ascending id (nulls first; ties by
    text); after the last row comes the first."""
    ranged = docs.withColumn("__range", _ranges(docs.select("__id"), total_bytes))
    heads = cut(ranged.select("__id", "__range").groupBy("__range").agg(F.min("__id").alias("__head")))
    last = heads.agg(F.max("__range").alias("m")).first()["m"]
    # one row per range: the range before it, and the last one for the first
    order = Window.orderBy("__range")
    heads = heads.select("__head", F.coalesce(F.lag("__range").over(order), F.lit(last)).alias("__to"),
                         F.lag("__range").over(order).isNull().alias("__wraps"))
    n = parts_for(total_bytes, RANGE_BYTES) + TOP_RANGES
    guests = (docs.join(bounded(heads, n, 32), F.col("__id").eqNullSafe(F.col("__head"))).drop("__head")
              .withColumnRenamed("__to", "__range").withColumn("__guest", F.when(F.col("__wraps"), 2).otherwise(1)).drop("__wraps"))
    every = ranged.withColumn("__guest", F.lit(0)).unionByName(guests).withColumn("__bins", bins_of(F.col("__text")))
    w = Window.partitionBy("__range").orderBy("__guest", "__id", "__text")
    return (every.withColumn("__next_text", F.lead("__text").over(w)).withColumn("__next_bins", F.lead("__bins").over(w))
            .where("__guest = 0").drop("__guest", "__range"))


def compare(docs: DataFrame, total_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> per row: `id_col`, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter (rounded down) of its code points replaced by the first as many of
    the next document by id, or all of it. Null texts count as empty; a text without words has fingerprint ''. Null ids
    come first, in one range; rows repeating an id follow each other, ordered by text. An only row is its own
    successor. Empty table: no rows. Other columns are not read."""
    base = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text"))
    n = F.char_length("__text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("__text", F.lit(1), n - quarter), F.substring("__next_text", F.lit(1), quarter))
    pairs = (with_successor(base, total_bytes).withColumn("__edited", edited)
             .withColumn("__edited_bins", bins_of(F.col("__edited"))))
    return pairs.select(
        F.col("__id").alias(id_col), n.cast("long").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
        packed(F.col("__bins")).alias("fingerprint"), packed(F.col("__edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("__bins"), F.col("__edited_bins")).alias("near_edited"),
        likeness(F.col("__bins"), F.col("__next_bins")).alias("near_next"))
