"""Positive pairs within categories, uniform negative pairs across categories, labelling.

Randomness is a keyed hash (simpairs.functions.hashing), so every pair set is reproducible
and independent of partitioning. No operator enumerates all pairs of a category: positives
are drawn as pair ranks over the whole category and unranked, one rank from each of as many
equal strata as pairs are asked for; negatives are independent draws. The output is linear in the
request. `sample_positive_pairs` is the sampler that looks at a bounded sample of each category.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.functions.hashing import bounded_draw, keyed_hash
from simpairs.operators.numbering import hash_bucket, number_rows, row_count
from simpairs.sources.shared import checkpointed, written_table

# draws generated by one row of the intermediate table
DRAW_CHUNK = 10_000


def category_sizes(clauses: DataFrame) -> DataFrame:
    """(category, n) of the non-empty categories. `clauses` may be such a table itself, made once for several steps."""
    if clauses.columns == ["category", "n"]:
        return clauses
    return clauses.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def category_table(clauses: DataFrame) -> DataFrame:
    """Non-empty categories sorted by name: (category, n, cat_rank 0-based). One row per
    category, so the rank window runs over a small table."""
    sizes = category_sizes(clauses)
    return sizes.withColumn("cat_rank", F.row_number().over(Window.orderBy("category")) - 1)


def sample_for_pairs(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """(category, clause_id, spos, m): the clauses that form positive pairs, with their
    0-based position `spos` in pairing order and the category's sample size `m`.

    Categories with more than `sample_threshold` clauses: `sample_size` clauses in hash
    order. Smaller ones: all clauses in file (id) order. One window serves both: its order
    key switches on the category size, and its constant rank limit (every small category
    fits under it) lets Spark run a WindowGroupLimit before the shuffle, so a hot category
    never sends more than `sample_size` rows per map task.
    """
    if cfg.sample_threshold > cfg.sample_size:
        raise ValueError("sample_threshold must not exceed sample_size")
    sizes = clauses.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    base = clauses.select("category", "clause_id").join(sizes, "category")
    large = F.col("n") > cfg.sample_threshold
    order = F.when(large, keyed_hash(cfg.seed, "sample", "clause_id")).otherwise(F.col("clause_id"))
    ranked = (base.withColumn("r", F.row_number().over(Window.partitionBy("category").orderBy(order, "clause_id")))
              .where(F.col("r") <= cfg.sample_size))
    return ranked.select("category", "clause_id", (F.col("r") - 1).alias("spos"),
                         F.when(large, F.least(F.col("n"), F.lit(cfg.sample_size))).otherwise(F.col("n")).alias("m"))


def _partner_positions(i: Column, m: Column, cap: int) -> Column:
    """Positions j > i such that the lexicographic rank of (i, j) among all pairs of m
    items is < cap: rank(i, j) = i*(2m-i-1)/2 + (j-i-1)."""
    tri = (i * (F.lit(2) * m - i - F.lit(1))) / F.lit(2)
    jmax = F.least(m - F.lit(1), (F.lit(cap) + i - tri).cast("long"))
    return F.when(jmax >= i + 1, F.sequence(i + F.lit(1), jmax)).otherwise(F.array().cast("array<long>"))


def sample_positive_pairs(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """(category, id1, id2): the first `sample_pairs` pairs of each category's sample, in
    lexicographic order of positions. A sampler: see `positive_pairs` for whole categories."""
    s = sample_for_pairs(clauses, cfg).select(
        "category", "clause_id", F.col("spos").cast("long").alias("spos"), F.col("m").cast("long").alias("m"))
    anchors = s.select("category", F.col("clause_id").alias("id1"),
                       F.explode(_partner_positions(F.col("spos"), F.col("m"), cfg.sample_pairs)).alias("j"))
    partner = s.select("category", F.col("spos").alias("j"), F.col("clause_id").alias("id2"))
    return anchors.join(partner, ["category", "j"]).select("category", "id1", "id2")


def pair_budget(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """(category, n, total, q): clauses, possible pairs and pairs to draw: `pairs_per_category`, or
    as many as there are clauses when that is None, never more than there are."""
    sizes = category_sizes(clauses)
    want = F.col("n") if cfg.pairs_per_category is None else F.lit(int(cfg.pairs_per_category)).cast("long")
    total = F.expr("n * (n - 1) div 2")
    return sizes.withColumn("total", total).withColumn("q", F.least(want, F.col("total"))).where("q > 0")


def _unranked(r: Column) -> tuple[Column, Column]:
    """(i, j), i < j, of the pair rank r = j * (j - 1) / 2 + i; the square root is corrected by one step."""
    near = F.floor((F.sqrt(r.cast("double") * 8 + 1) + 1) / 2).cast("long")
    below = lambda j: F.call_function("div", j * (j - 1), F.lit(2))
    j = F.when(below(near) > r, near - 1).when(below(near + 1) <= r, near + 1).otherwise(near)
    return r - below(j), j


def positive_draws(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """(category, k, row1, row2): the ranks 0 .. total-1 of a category are cut into q equal strata and a keyed
    hash draws one rank from each."""
    chunks = pair_budget(clauses, cfg).select(
        "category", "total", "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1, F.lit(DRAW_CHUNK).cast("long"))).alias("c"))
    # a large category is many rows here, dealt over the tasks before they expand; their number is given, since adaptive execution
    # would put them into one task, by the few bytes that they have before
    parts = int(clauses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = chunks.repartition(parts, "category", "c").select(
        "category", "total", "q", F.explode(F.sequence(F.col("c"), F.least(F.col("q"), F.col("c") + DRAW_CHUNK) - 1)).alias("k"))
    step, rest = F.expr("total div q"), F.expr("total % q")
    k = k.select("category", "k", (F.col("k") * step + F.least(F.col("k"), rest)).alias("lo"),
                 (step + F.when(F.col("k") < rest, 1).otherwise(0)).alias("size"))
    r = F.col("lo") + bounded_draw(cfg.seed, "pos", F.concat_ws(":", "category", "k"), "size")
    i, j = _unranked(F.col("r"))
    return k.withColumn("r", r).select("category", "k", i.alias("row1"), j.alias("row2"))


def _looked_up(clauses: DataFrame, seed: int, draws: DataFrame, key: list[str]) -> DataFrame:
    """draws(key.., cat1, row1, cat2, row2) -> the same with id1, id2: one pass over the draws and over the numbered clauses for
    both sides; the planner chooses the join by the sizes."""
    ends = F.array(*[F.struct(F.lit(k).alias("side"), F.col(f"cat{k}").alias("category"), F.col(f"row{k}").alias("row")) for k in (1, 2)])
    sides = draws.select(*key, F.explode(ends).alias("e")).select(*key, "e.side", "e.category", "e.row")
    hit = row_numbered(clauses, seed).join(sides, ["category", "row"])
    return hit.groupBy(*key).agg(*[F.max(F.when(F.col("side") == k, F.col("clause_id"))).alias(f"id{k}") for k in (1, 2)],
                                 *[F.max(F.when(F.col("side") == k, F.col("category"))).alias(f"cat{k}") for k in (1, 2)])


def positive_pairs(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """(category, id1, id2), label 1 implied: exactly `q` distinct pairs per category (see `pair_budget`),
    spread over the whole category. Positions are those of `row_numbered`."""
    d = positive_draws(clauses, cfg).select(F.col("category").alias("of"), "k", F.col("category").alias("cat1"), "row1",
                                            F.col("category").alias("cat2"), "row2")
    return _looked_up(clauses, cfg.seed, d, ["of", "k"]).select(F.col("of").alias("category"), "id1", "id2")


def cap_positives(pos: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """Global cap `num_positive` (None or 0 = no cap): a uniform subset of that size."""
    if not cfg.num_positive:
        return pos
    from simpairs.operators.sampling import hash_sample
    keyed = pos.withColumn("__k", F.concat_ws(":", F.lit("1"), "id1", "id2"))
    return hash_sample(keyed, "__k", cfg.num_positive, cfg.seed, "cap").drop("__k")


def unranked_categories(rank: Column, n: Column) -> tuple[Column, Column]:
    """(i, j), 0 <= i < j < n: the pair of that 0-based rank in lexicographic order, in closed form, without a table of pairs."""
    r, n = rank.cast("long"), n.cast("long")
    before = lambda i: F.shiftright(i * (2 * n - i - 1), 1)
    b = (2 * n - 1).cast("double")
    guess = F.floor((b - F.sqrt(b * b - 8.0 * r)) / 2).cast("long")
    # the square root may be off by one either way
    i = F.when(before(guess) > r, guess - 1).when(before(guess + 1) <= r, guess + 1).otherwise(guess)
    return i, r - before(i) + i + 1


def category_pairs(clauses: DataFrame) -> DataFrame:
    """All unordered pairs of non-empty categories (cat1 < cat2): ranks, unranked and joined to the names. A listing; the
    negative draw unranks its own draws and needs no such table."""
    cats = category_table(clauses)
    n = cats.count()
    i, j = unranked_categories(F.col("id"), F.lit(n))
    ranks = clauses.sparkSession.range(n * (n - 1) // 2).select(i.alias("r1"), j.alias("r2"))
    for k in (1, 2):
        ranks = ranks.join(cats.select(F.col("cat_rank").alias(f"r{k}"), F.col("category").alias(f"cat{k}")), f"r{k}")
    return ranks.select("cat1", "cat2")


def positive_count(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> int:
    """Number of positive pairs without generating them: the budget summed over the categories; then the
    global `num_positive`. `clauses` may be `category_sizes`, here and in the draws."""
    n = int(pair_budget(clauses, cfg).agg(F.sum("q").alias("n")).first()["n"] or 0)
    return min(n, cfg.num_positive) if cfg.num_positive else n


def negative_count(clauses: DataFrame, cfg: PairConfig = PairConfig()) -> int:
    """`num_negative` when given, else the number of positives."""
    return int(cfg.num_negative) if cfg.num_negative is not None else positive_count(clauses, cfg)


def row_numbered(clauses: DataFrame, seed: int) -> DataFrame:
    """(category, clause_id, row): a 0-based per-category numbering in hash order, computed
    bucket-wise so a hot category is spread over many tasks."""
    h = keyed_hash(seed, "row", "clause_id")
    d = clauses.select("category", "clause_id").withColumn("__h", h)
    out = number_rows(d, [F.col("__h"), F.col("clause_id")], hash_bucket(F.col("__h"), row_count(clauses)), ["category"], "rn")
    return out.select("category", "clause_id", (F.col("rn") - 1).alias("row"))


def negative_draws(clauses: DataFrame, cfg: PairConfig = PairConfig(), n_neg: int | None = None, draws: DataFrame | None = None) -> DataFrame:
    """(draw_id, cat1, row1, cat2, row2): see `negative_pairs`. `draws`: any rows with a `draw_id`, a stream too, in place of
    the ids 0 .. n_neg - 1; a draw depends on its id alone."""
    cats = category_table(clauses)
    if draws is None:
        n_cats = cats.select(F.count(F.lit(1))).scalar()
        draws = clauses.sparkSession.range(negative_count(clauses, cfg) if n_neg is None else n_neg).withColumnRenamed("id", "draw_id")
    else:
        n_cats = F.lit(cats.count())
    s = cfg.seed
    ci = bounded_draw(s, "neg_c1", "draw_id", n_cats)
    cj0 = bounded_draw(s, "neg_c2", "draw_id", F.greatest(n_cats - 1, F.lit(1)))
    draws = draws.select(
        "draw_id",
        F.when(n_cats < 2, F.raise_error(F.lit("negative pairs need at least 2 non-empty categories")))
        .otherwise(ci).alias("ci"), cj0.alias("cj0"))
    draws = draws.withColumn("cj", F.col("cj0") + F.when(F.col("cj0") >= F.col("ci"), 1).otherwise(0))
    draws = draws.select("draw_id", F.least("ci", "cj").alias("r1"), F.greatest("ci", "cj").alias("r2"))
    c1 = cats.select(F.col("cat_rank").alias("r1"), F.col("category").alias("cat1"), F.col("n").alias("n1"))
    c2 = cats.select(F.col("cat_rank").alias("r2"), F.col("category").alias("cat2"), F.col("n").alias("n2"))
    return draws.join(c1, "r1").join(c2, "r2").select(
        "draw_id", "cat1", bounded_draw(s, "neg_r1", "draw_id", "n1").alias("row1"),
        "cat2", bounded_draw(s, "neg_r2", "draw_id", "n2").alias("row2"))


def negative_pairs(clauses: DataFrame, cfg: PairConfig = PairConfig(), n_neg: int | None = None) -> DataFrame:
    """(draw_id, cat1, cat2, id1, id2): each of `n_neg` draws picks an unordered category pair
    uniformly (not weighted by size), the earlier category by name on side 1, then a
    uniform clause in each, with replacement."""
    return _looked_up(clauses, cfg.seed, negative_draws(clauses, cfg, n_neg), ["draw_id"]).select("draw_id", "cat1", "cat2", "id1", "id2")


def labelled_pairs(clauses: DataFrame, cfg: PairConfig = PairConfig(), materialize: bool = True) -> DataFrame:
    """(pair_id, id1, id2, label): positives + negatives, numbered 0..n-1 in a
    keyed-hash order (the joint shuffle). By default the (small) pair table is
    checkpointed into the shared folder: it is reused by encoding, scoring and examples."""
    sizes = category_sizes(clauses)
    if materialize:
        # every step needs the sizes; as a table of known size they are broadcast to the draws if they are few
        sizes = written_table(sizes, "category-sizes")
    pos = positive_draws(sizes, cfg).select(
        F.lit(1).alias("label"), F.col("category").alias("of"), "k", F.col("category").alias("cat1"), "row1", F.col("category").alias("cat2"), "row2")
    neg = negative_draws(sizes, cfg).select(F.lit(0).alias("label"), F.lit("").alias("of"), F.col("draw_id").alias("k"), "cat1", "row1", "cat2", "row2")
    # positives and negatives are looked up together
    both = _looked_up(clauses, cfg.seed, pos.unionByName(neg), ["label", "of", "k"])
    if cfg.num_positive:
        both = cap_positives(both.where("label = 1"), cfg).unionByName(both.where("label = 0"))
    key = F.when(F.col("label") == 1, F.concat_ws(":", F.lit("1"), "id1", "id2")).otherwise(F.concat_ws(":", F.lit("0"), "k"))
    allp = both.select("id1", "id2", "label", key.alias("__k")).withColumn("__h", keyed_hash(cfg.seed, "shuffle", "__k"))
    if materialize:
        # numbering reads its rows three times
        allp = checkpointed(allp)
    numbered = number_rows(allp, [F.col("__h"), F.col("__k")], hash_bucket(F.col("__h"), row_count(allp)), (), "rn")
    out = numbered.select((F.col("rn") - 1).alias("pair_id"), "id1", "id2", F.col("label").cast("int").alias("label"))
    if not materialize:
        return out
    # few bytes per pair but heavy per-pair work downstream (encoding, scoring): keep the
    # session's shuffle parallelism instead of the byte-coalesced partition count
    parts = int(clauses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(out.repartition(parts, "pair_id"))


def attach_texts(pairs: DataFrame, clauses: DataFrame) -> DataFrame:
    """Add clause1 / clause2 by id (equi joins, not positions)."""
    c1 = clauses.select(F.col("clause_id").alias("id1"), F.col("clause").alias("clause1"))
    c2 = clauses.select(F.col("clause_id").alias("id2"), F.col("clause").alias("clause2"))
    return pairs.join(c1, "id1").join(c2, "id2")


def pair_label_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
