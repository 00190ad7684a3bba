"""Query registry: each entry runs one operator (or a short chain) on the driver's tables.

`QUERIES[name](spark, sf_dir) -> DataFrame` and, where the result is plain-SQL expressible,
`ORACLE[name]` holds the equivalent DuckDB SQL over the same tables. Outputs are
canonicalised for comparison: integers as BIGINT, doubles rounded to 6 digits, int arrays
rendered as space-separated strings.
"""
from __future__ import annotations

import contextvars
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simpairs.config import PairConfig
from simpairs.functions.arrays import render_ids
from simpairs.operators import encode as enc
from simpairs.operators import examples as ex
from simpairs.operators import features as fe
from simpairs.operators import metrics as me
from simpairs.operators import score as sc
from simpairs.operators import pairs as pr
from simpairs.operators import sampling as smp
from simpairs.operators import split as spl
from simpairs.operators import vectors as vec
from simpairs.operators import vocab as voc
from simpairs.plans import sqlfrag as q
from simpairs.sources.shared import checkpointed
from simpairs.sources.tables import clean_clauses, document_clauses, document_drafts, embedding_items, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

CFG = PairConfig()
L = CFG.max_seq_length
SMALL_CATS = "lang || '-' || source"   # 80 categories of 2..38 clauses at sf0.01
CLAMP_VOCAB = 1000                      # vocabulary size of a smaller, older model


# intermediate tables shared by the branches of ONE query call (never across queries)
_MEMO: contextvars.ContextVar[dict | None] = contextvars.ContextVar("simpairs_memo", default=None)


def memo(key, build: Callable[[], DataFrame]) -> DataFrame:
    m = _MEMO.get()
    if m is None:
        return build()
    if key not in m:
        m[key] = build()
    return m[key]


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf):
            token = _MEMO.set({})
            try:
                return fn(spark, sf)
            finally:
                _MEMO.reset(token)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = q.rewrite_round6(sql)
        return fn
    return deco


def r6(c: Column) -> Column:
    """Round to 6 decimals as floor(x * 1e6 + 0.5) / 1e6 - plain IEEE steps that SQL
    engines evaluate identically (decimal-string HALF_UP and binary rounding differ on
    exact ties such as 41/640)."""
    d = c.cast("double")
    return F.when(F.abs(d) < 1e12, F.floor(d * 1e6 + 0.5) / 1e6).otherwise(d)


def canon(df: DataFrame) -> DataFrame:
    """Integers -> BIGINT, floats -> DOUBLE rounded to 6 digits, int arrays -> strings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = r6(c)
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.IntegerType, T.LongType)):
            c = render_ids(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- shared inputs

def doc_clauses(spark, sf, category=SMALL_CATS) -> DataFrame:
    """clauses(category, clause_id, clause) for a category expression over lang / source. Lazy: a query that
    needs no text does not read it."""
    return document_clauses(spark, sf, category, CFG.null_policy)


def doc_drafts(spark, sf, category=SMALL_CATS) -> DataFrame:
    """The same for operators on words: drafts in place of clean clauses (the null policy is that of `doc_clauses`)."""
    return document_drafts(spark, sf, category)


def doc_vocab(spark, sf) -> DataFrame:
    return memo(("vocab", sf), lambda: voc.build_vocabulary(doc_drafts(spark, sf, "lang"), CFG.min_freq))


def conv_texts(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("clause_id"), "text")
    return clean_clauses(c, "text", CFG.null_policy).select("clause_id", "clause")


def doc_pairs(spark, sf) -> DataFrame:
    return memo(("pairs", sf), lambda: pr.labelled_pairs(doc_clauses(spark, sf), CFG))


def emb_pairs(spark, sf) -> DataFrame:
    return memo(("emb_pairs", sf), lambda: pr.labelled_pairs(
        embedding_items(spark, sf).select("category", "clause_id"), CFG))


# SQL counterparts of the shared inputs
C_SMALL = q.clauses_cte(SMALL_CATS, "c")
C_LANG = q.clauses_cte("lang", "c")
C_CONV = ("cv AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS clause_id, "
          f"{q.clean(chr(39).join(['coalesce(text, ', 'nan', ')']))} AS clause FROM conversations)")
VOCAB_LANG = C_LANG + ",\n" + q.vocab_ctes("c", CFG.min_freq)


def sample_positives_sql(src: str = "c", name: str = "pos") -> str:
    return f"""{name}_sz AS (SELECT category, count(*) AS n FROM {src} GROUP BY category),
{name}_s AS (SELECT category, clause_id, r - 1 AS spos, least(n, {CFG.sample_size}) AS m FROM (
  SELECT x.category, x.clause_id, z.n, row_number() OVER (PARTITION BY x.category ORDER BY
    CASE WHEN z.n > {CFG.sample_threshold} THEN {q.h('sample', 'x.clause_id')} ELSE x.clause_id END, x.clause_id) AS r
  FROM {src} x JOIN {name}_sz z USING (category))
  WHERE r <= CASE WHEN n > {CFG.sample_threshold} THEN {CFG.sample_size} ELSE n END),
{name} AS (SELECT a.category, a.clause_id AS id1, b.clause_id AS id2 FROM {name}_s a JOIN {name}_s b
  ON a.category = b.category AND a.spos < b.spos
  WHERE a.spos * (2 * a.m - a.spos - 1) // 2 + (b.spos - a.spos - 1) < {CFG.sample_pairs})"""


def positives_sql(src: str = "c", name: str = "pos", per: int | None = CFG.pairs_per_category) -> str:
    """Ranks drawn over all pairs of each category, unranked, looked up by position."""
    want = "n" if per is None else str(per)
    return f"""{name}_sz AS (SELECT category, n, total, least({want}, total) AS q FROM
  (SELECT category, count(*) AS n, (count(*) * (count(*) - 1)) // 2 AS total FROM {src} GROUP BY category)),
{name}_k AS (SELECT category, total, q, unnest(range(q)) AS k FROM {name}_sz WHERE q > 0),
{name}_r AS (SELECT category, k * (total // q) + least(k, total % q) + {q.h('pos', "(category || ':' || k)")}
  % (total // q + CASE WHEN k < total % q THEN 1 ELSE 0 END) AS r FROM {name}_k),
{name}_g AS (SELECT category, r, CAST(floor((sqrt(CAST(r AS DOUBLE) * 8 + 1) + 1) / 2) AS BIGINT) AS g FROM {name}_r),
{name}_j AS (SELECT category, r, CASE WHEN g * (g - 1) // 2 > r THEN g - 1 WHEN (g + 1) * g // 2 <= r THEN g + 1 ELSE g END AS j
  FROM {name}_g),
{name}_rn AS (SELECT category, clause_id, row_number() OVER (PARTITION BY category
  ORDER BY {q.h('row', 'clause_id')}, clause_id) - 1 AS rw FROM {src}),
{name} AS (SELECT p.category, x.clause_id AS id1, y.clause_id AS id2 FROM {name}_j p
  JOIN {name}_rn x ON x.category = p.category AND x.rw = p.r - p.j * (p.j - 1) // 2
  JOIN {name}_rn y ON y.category = p.category AND y.rw = p.j)"""


def negatives_sql(src: str = "c", pos: str = "pos", name: str = "neg", draws: int | None = None) -> str:
    n = f"(SELECT count(*) FROM {pos})" if draws is None else str(draws)
    return f"""{name}_cats AS (SELECT category, count(*) AS n, row_number() OVER (ORDER BY category) - 1 AS cat_rank
  FROM {src} GROUP BY category),
{name}_d1 AS (SELECT range AS draw_id, {q.h('neg_c1', 'range')} % k.nc AS ci, {q.h('neg_c2', 'range')} % (k.nc - 1) AS cj0
  FROM range({n}),
       (SELECT count(*) AS nc FROM {name}_cats) k),
{name}_d2 AS (SELECT draw_id, least(ci, cj) AS r1, greatest(ci, cj) AS r2 FROM
  (SELECT *, cj0 + CASE WHEN cj0 >= ci THEN 1 ELSE 0 END AS cj FROM {name}_d1)),
{name}_d3 AS (SELECT draw_id, a.category AS cat1, b.category AS cat2, {q.h('neg_r1', 'draw_id')} % a.n AS row1,
  {q.h('neg_r2', 'draw_id')} % b.n AS row2 FROM {name}_d2 JOIN {name}_cats a ON a.cat_rank = r1
  JOIN {name}_cats b ON b.cat_rank = r2),
{name}_rn AS (SELECT category, clause_id, row_number() OVER (PARTITION BY category
  ORDER BY {q.h('row', 'clause_id')}, clause_id) - 1 AS rw FROM {src}),
{name} AS (SELECT draw_id, cat1, cat2, x.clause_id AS id1, y.clause_id AS id2 FROM {name}_d3
  JOIN {name}_rn x ON x.category = cat1 AND x.rw = row1 JOIN {name}_rn y ON y.category = cat2 AND y.rw = row2)"""


def labelled_sql(src: str = "c", name: str = "lp") -> str:
    return (positives_sql(src, f"{name}_pos") + ",\n" + negatives_sql(src, f"{name}_pos", f"{name}_neg") + ",\n" +
            f"""{name}_all AS (SELECT id1, id2, 1 AS label, '1:' || id1 || ':' || id2 AS k FROM {name}_pos
  UNION ALL SELECT id1, id2, 0 AS label, '0:' || draw_id AS k FROM {name}_neg),
{name} AS (SELECT row_number() OVER (ORDER BY {q.h('shuffle', 'k')}, k) - 1 AS pair_id, id1, id2, label FROM {name}_all)""")


def split_sql(src: str, key: str, strata: str, name: str = "sp", test: float = CFG.test_size,
              val: float = CFG.val_size) -> str:
    val_adj = float(val) / (1.0 - float(test))

    def mode(counts, draws, out, frm):
        return (f"SELECT *, fl_{out} + CASE WHEN rk_{out} <= need_{out} THEN 1 ELSE 0 END AS {out} FROM ("
                f"SELECT *, floor(cont_{out}) AS fl_{out}, {draws} - sum(floor(cont_{out})) OVER () AS need_{out}, "
                f"row_number() OVER (ORDER BY cont_{out} - floor(cont_{out}) DESC, st ASC) AS rk_{out} FROM ("
                f"SELECT *, CAST({counts} AS DOUBLE) / sum({counts}) OVER () * {draws} AS cont_{out} FROM {frm}))")
    return f"""{name}_n AS (SELECT {strata} AS st, count(*) AS cnt FROM {src} GROUP BY 1),
{name}_a AS (SELECT *, n - ceil({float(test)!r}::DOUBLE * n) AS n_temp FROM (SELECT *, sum(cnt) OVER () AS n FROM {name}_n)),
{name}_b AS ({mode('cnt', 'n_temp', 'tmp', name + '_a')}),
{name}_c AS (SELECT *, n_temp - ceil({val_adj!r}::DOUBLE * n_temp) AS n_tr FROM {name}_b),
{name}_q AS ({mode('tmp', 'n_tr', 'tr', name + '_c')}),
{name}_r AS (SELECT x.*, row_number() OVER (PARTITION BY {strata} ORDER BY {q.h('split', key)}, {key}) AS r FROM {src} x),
{name} AS (SELECT r.*, CASE WHEN r.r <= qq.tr THEN 'train' WHEN r.r <= qq.tmp THEN 'val' ELSE 'test' END AS split
  FROM {name}_r r JOIN {name}_q qq ON r.{strata} = qq.st)"""


# ---------------------------------------------------------------- text and vocabulary

@register("clean_text", f"WITH {C_SMALL} SELECT clause_id AS doc_id, clause FROM c")
def _clean_text(spark, sf):
    return canon(doc_clauses(spark, sf).select(F.col("clause_id").alias("doc_id"), "clause"))


@register("tokenize", f"WITH {C_SMALL}, {q.tokens_cte('c', 't')} SELECT clause_id AS doc_id, "
          "CAST(pos AS BIGINT) AS pos, word AS token FROM t")
def _tokenize(spark, sf):
    t = voc.tokens(doc_clauses(spark, sf))
    return canon(t.select(F.col("clause_id").alias("doc_id"), "pos", F.col("word").alias("token")))


@register("word_counts", f"""WITH {C_LANG}, {q.tokens_cte('c', 't')},
wc AS (SELECT word, count(*) AS cnt, min({{'category': category, 'clause_id': clause_id, 'pos': pos}}) AS f FROM t GROUP BY word)
SELECT word, cnt, f.category AS first_category, f.clause_id AS first_clause_id, CAST(f.pos AS BIGINT) AS first_pos FROM wc""")
def _word_counts(spark, sf):
    return canon(voc.word_counts(doc_drafts(spark, sf, "lang")))


@register("vocabulary", f"WITH {VOCAB_LANG} SELECT word, CAST(idx AS BIGINT) AS idx FROM vocab")
def _vocabulary(spark, sf):
    return canon(doc_vocab(spark, sf))


@register("vocabulary_by_source", f"WITH {q.clauses_cte('source', 'c')},\n{q.vocab_ctes('c', 3)} "
          "SELECT word, CAST(idx AS BIGINT) AS idx FROM vocab")
def _vocabulary_by_source(spark, sf):
    return canon(voc.build_vocabulary(doc_drafts(spark, sf, "source"), 3))


@register("vocab_stats", f"""WITH {VOCAB_LANG} SELECT count(*) AS total,
CAST(sum(CASE WHEN idx < 4 THEN 1 ELSE 0 END) AS BIGINT) AS special,
CAST(sum(CASE WHEN idx >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS regular FROM vocab""")
def _vocab_stats(spark, sf):
    return canon(voc.vocab_stats(doc_vocab(spark, sf)))


@register("corpus_stats", f"""WITH {C_SMALL}, {q.tokens_cte('c', 't')}
SELECT (SELECT count(DISTINCT category) FROM c) AS n_categories, (SELECT count(*) FROM c) AS n_clauses,
(SELECT count(*) FROM t) AS n_tokens, (SELECT count(DISTINCT word) FROM t) AS n_distinct_words""")
def _corpus_stats(spark, sf):
    return canon(voc.corpus_stats(doc_clauses(spark, sf)))


@register("category_sizes", f"WITH {C_SMALL} SELECT category, count(*) AS n FROM c GROUP BY category")
def _category_sizes(spark, sf):
    return canon(voc.category_sizes(doc_clauses(spark, sf)))


@register("decode_ids", f"""WITH {VOCAB_LANG},
{q.encode_cte('c', 'vocab', 'enc', None)},
d AS (SELECT clause_id, unnest(seq) AS i, generate_subscripts(seq, 1) AS p FROM enc)
SELECT e.clause_id, coalesce((SELECT string_agg(v.word, ' ' ORDER BY d.p) FROM d JOIN vocab v ON v.idx = d.i
  WHERE d.clause_id = e.clause_id AND d.i <> 0), '') AS text FROM enc e""")
def _decode_ids(spark, sf):
    e = enc.encode(doc_drafts(spark, sf, "lang"), doc_vocab(spark, sf))
    return canon(enc.decode(e, doc_vocab(spark, sf)))


# ---------------------------------------------------------------- encoding

@register("encode_padded", f"""WITH {VOCAB_LANG},
{q.encode_cte('c', 'vocab', 'enc', L)}
SELECT clause_id, {q.render('seq')} AS seq FROM enc""")
def _encode_padded(spark, sf):
    return canon(enc.encode(doc_drafts(spark, sf, "lang"), doc_vocab(spark, sf), max_len=L))


@register("encode_ragged", f"""WITH {VOCAB_LANG},
{q.encode_cte('c', 'vocab', 'enc', None)}
SELECT clause_id, CAST(len(seq) AS BIGINT) AS n_ids, CAST(len(list_filter(seq, lambda x: x = 1)) AS BIGINT) AS n_unk,
md5({q.render('seq')}) AS seq_md5 FROM enc""")
def _encode_ragged(spark, sf):
    e = enc.encode(doc_drafts(spark, sf, "lang"), doc_vocab(spark, sf))
    return canon(e.select("clause_id", F.size("seq").alias("n_ids"),
                          F.size(F.filter("seq", lambda x: x == 1)).alias("n_unk"),
                          F.md5(render_ids("seq")).alias("seq_md5")))


@register("encode_conversations", f"""WITH {VOCAB_LANG}, {C_CONV},
{q.encode_cte('cv', 'vocab', 'enc', L)}
SELECT clause_id, {q.render('seq')} AS seq FROM enc""")
def _encode_conversations(spark, sf):
    return canon(enc.encode(conv_texts(spark, sf), doc_vocab(spark, sf), max_len=L))


@register("clamp_ids", f"""WITH {VOCAB_LANG}, {C_CONV},
{q.encode_cte('cv', 'vocab', 'enc', None)}
SELECT clause_id, {q.render(f'list_transform(seq, lambda x: greatest(0, least(x, {CLAMP_VOCAB - 1})))')} AS seq FROM enc""")
def _clamp_ids(spark, sf):
    e = enc.encode(conv_texts(spark, sf), doc_vocab(spark, sf))
    return canon(enc.clamp(e, CLAMP_VOCAB))


@register("oov_guard", f"""WITH {VOCAB_LANG}, {C_CONV},
{q.encode_cte('cv', 'vocab', 'enc', None)}
SELECT CAST(max(list_max(seq)) AS BIGINT) AS max_id, CAST({CLAMP_VOCAB} AS BIGINT) AS vocab_size,
CAST(sum(len(list_filter(seq, lambda x: x >= {CLAMP_VOCAB} OR x < 0))) AS BIGINT) AS n_out_of_range,
max(list_max(seq)) >= {CLAMP_VOCAB} AS needs_clamp FROM enc""")
def _oov_guard(spark, sf):
    e = enc.encode(conv_texts(spark, sf), doc_vocab(spark, sf))
    return canon(enc.oov_guard(e, CLAMP_VOCAB))


# ---------------------------------------------------------------- pairs

@register("positive_pairs_small", f"WITH {C_SMALL},\n{sample_positives_sql('c', 'pos')} SELECT category, id1, id2 FROM pos")
def _positive_pairs_small(spark, sf):
    return canon(pr.sample_positive_pairs(doc_clauses(spark, sf), CFG))


@register("positive_pairs_boundary", f"WITH {q.clauses_cte('source', 'c')},\n{sample_positives_sql('c', 'pos')} "
          "SELECT category, id1, id2 FROM pos")
def _positive_pairs_boundary(spark, sf):
    return canon(pr.sample_positive_pairs(doc_clauses(spark, sf, "source"), CFG))


@register("positive_pairs_large", f"WITH {C_LANG},\n{sample_positives_sql('c', 'pos')} SELECT category, id1, id2 FROM pos")
def _positive_pairs_large(spark, sf):
    return canon(pr.sample_positive_pairs(doc_clauses(spark, sf, "lang"), CFG))


E_ITEMS = "e AS (SELECT CAST(label AS VARCHAR) AS category, vec_id AS clause_id FROM embeddings)"


@register("positive_pairs_embeddings", f"WITH {E_ITEMS},\n{sample_positives_sql('e', 'pos')} SELECT category, id1, id2 FROM pos")
def _positive_pairs_embeddings(spark, sf):
    return canon(pr.sample_positive_pairs(embedding_items(spark, sf).select("category", "clause_id"), CFG))


@register("positive_counts", f"""WITH {C_SMALL},\n{sample_positives_sql('c', 'pos')}
SELECT category, count(*) AS n FROM pos GROUP BY category""")
def _positive_counts(spark, sf):
    return canon(pr.sample_positive_pairs(doc_clauses(spark, sf), CFG).groupBy("category")
                 .agg(F.count(F.lit(1)).alias("n")))


@register("category_pairs", f"""WITH {C_SMALL}, k AS (SELECT DISTINCT category FROM c)
SELECT a.category AS cat1, b.category AS cat2 FROM k a JOIN k b ON a.category < b.category""")
def _category_pairs(spark, sf):
    return canon(pr.category_pairs(doc_clauses(spark, sf)))


@register("negative_pairs", f"""WITH {C_SMALL},\n{positives_sql('c', 'pos')},\n{negatives_sql('c', 'pos', 'neg')}
SELECT draw_id, cat1, cat2, id1, id2 FROM neg""")
def _negative_pairs(spark, sf):
    c = doc_clauses(spark, sf)
    return canon(pr.negative_pairs(c, CFG))


@register("positive_pairs_hash", f"WITH {C_LANG},\n{positives_sql('c', 'pos', 5000)} SELECT category, id1, id2 FROM pos")
def _positive_pairs_hash(spark, sf):
    return canon(pr.positive_pairs(doc_clauses(spark, sf, "lang"), PairConfig(pairs_per_category=5000)))


@register("negative_pairs_many", f"""WITH {C_LANG},\n{negatives_sql('c', 'none', 'neg', 250_000)}
SELECT draw_id, cat1, cat2, id1, id2 FROM neg""")
def _negative_pairs_many(spark, sf):
    return canon(pr.negative_pairs(doc_clauses(spark, sf, "lang"), CFG, 250_000))


@register("labelled_pairs", f"WITH {C_SMALL},\n{labelled_sql('c', 'lp')} SELECT pair_id, id1, id2, CAST(label AS BIGINT) AS label FROM lp")
def _labelled_pairs(spark, sf):
    return canon(doc_pairs(spark, sf))


@register("pair_label_counts", f"WITH {C_SMALL},\n{labelled_sql('c', 'lp')} SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM lp GROUP BY label")
def _pair_label_counts(spark, sf):
    return canon(pr.pair_label_counts(doc_pairs(spark, sf)))


@register("positive_cap", f"""WITH {C_LANG},\n{positives_sql('c', 'pos', 2000)},
k AS (SELECT id1, id2, row_number() OVER (ORDER BY {q.h('cap', "'1:' || id1 || ':' || id2")}, '1:' || id1 || ':' || id2) AS r FROM pos)
SELECT id1, id2 FROM k WHERE r <= 1000""")
def _positive_cap(spark, sf):
    cfg = PairConfig(num_positive=1000, pairs_per_category=2000)
    return canon(pr.cap_positives(pr.positive_pairs(doc_clauses(spark, sf, "lang"), cfg), cfg).select("id1", "id2"))


# ---------------------------------------------------------------- split and subsets

@register("split_labels", f"WITH {split_sql('labels', 'doc_id', 'quality', 'sp')} SELECT doc_id, split FROM sp")
def _split_labels(spark, sf):
    return canon(spl.stratified_split(table(spark, sf, "labels"), "doc_id", "quality", CFG).select("doc_id", "split"))


@register("split_orders", f"WITH {split_sql('orders', 'o_orderkey', 'o_orderstatus', 'sp')} SELECT o_orderkey, split FROM sp")
def _split_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return canon(spl.stratified_split(o, "o_orderkey", "o_orderstatus", CFG).select("o_orderkey", "split"))


@register("split_sizes", f"""WITH {split_sql('orders', 'o_orderkey', 'o_orderpriority', 'sp')}
SELECT split, o_orderpriority, count(*) AS n FROM sp GROUP BY ALL""")
def _split_sizes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    s = spl.stratified_split(o, "o_orderkey", "o_orderpriority", CFG)
    return canon(spl.split_sizes(s, "o_orderpriority"))


@register("split_pairs", f"""WITH {C_SMALL},\n{labelled_sql('c', 'lp')},\n{split_sql('lp', 'pair_id', 'label', 'sp')}
SELECT pair_id, CAST(label AS BIGINT) AS label, split FROM sp""")
def _split_pairs(spark, sf):
    return canon(spl.stratified_split(doc_pairs(spark, sf), "pair_id", "label", CFG).select("pair_id", "label", "split"))


ORDERS_SPLIT = split_sql("orders", "o_orderkey", "o_orderstatus", "sp")


@register("train_subset", f"""WITH {ORDERS_SPLIT},
tr AS (SELECT o_orderkey, row_number() OVER (ORDER BY {q.h('subset', 'o_orderkey')}, o_orderkey) AS r FROM sp WHERE split = 'train')
SELECT o_orderkey FROM tr WHERE r <= (SELECT floor(count(*) * {CFG.train_fraction!r}) FROM tr)""")
def _train_subset(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    # read several times below (count, bucket sizes, rows): the split is made once
    tr = checkpointed(spl.stratified_split(o, "o_orderkey", "o_orderstatus", CFG).where("split = 'train'").select("o_orderkey"))
    return canon(smp.fraction_sample(tr, "o_orderkey", CFG.train_fraction, CFG.seed, "subset").select("o_orderkey"))


def _subset_sql(tag: str, k: int) -> str:
    return f"""WITH {ORDERS_SPLIT},
te AS (SELECT o_orderkey, row_number() OVER (ORDER BY {q.h(tag, 'o_orderkey')}, o_orderkey) AS r FROM sp WHERE split = 'test')
SELECT o_orderkey FROM te WHERE r <= {k}"""


EVAL_ROWS, QUALITATIVE_ROWS = 1_000, 2_000   # the subset operators' argument; both bind at sf0.01


@register("eval_subset", _subset_sql("eval", EVAL_ROWS))
def _eval_subset(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    te = spl.stratified_split(o, "o_orderkey", "o_orderstatus", CFG).where("split = 'test'")
    return canon(smp.hash_sample(te, "o_orderkey", EVAL_ROWS, CFG.seed, "eval").select("o_orderkey"))


@register("qualitative_subset", _subset_sql("qual", QUALITATIVE_ROWS))
def _qualitative_subset(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    te = spl.stratified_split(o, "o_orderkey", "o_orderstatus", CFG).where("split = 'test'")
    return canon(smp.hash_sample(te, "o_orderkey", QUALITATIVE_ROWS, CFG.seed, "qual").select("o_orderkey"))


# ---------------------------------------------------------------- prepared model inputs

@register("prepare_pairs", f"""WITH {C_SMALL},\n{labelled_sql('c', 'lp')},
{q.vocab_ctes('c2', CFG.min_freq).replace('c2', 'cl')},
{q.encode_cte('c', 'vocab', 'enc', L)}
SELECT pair_id, {q.render('a.seq')} AS seq1, {q.render('b.seq')} AS seq2, CAST(label AS BIGINT) AS label
FROM lp JOIN enc a ON a.clause_id = lp.id1 JOIN enc b ON b.clause_id = lp.id2""".replace(
    "WITH " + C_SMALL, "WITH " + C_SMALL + ",\n" + q.clauses_cte("lang", "cl")))
def _prepare_pairs(spark, sf):
    p = enc.prepare_pairs(doc_pairs(spark, sf), doc_drafts(spark, sf), doc_vocab(spark, sf), L)
    return canon(p)


# ---------------------------------------------------------------- features and test scorers

E_VEC = "ev AS (SELECT vec_id AS clause_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
EMB_PAIRS = f"{E_ITEMS},\n{E_VEC},\n{labelled_sql('e', 'ep')}"
DOC_PAIRS = f"{C_SMALL},\n{labelled_sql('c', 'lp')}"


def _seqsum(x: str) -> str:
    return f"list_reduce({x}, lambda acc, v: acc + v, 0.0::DOUBLE)"


def _zip(a: str, b: str, op: str) -> str:
    return f"list_transform(list_zip({a}, {b}), lambda z: {op.replace('X', 'z[1]').replace('Y', 'z[2]')})"


def _cos(a: str, b: str) -> str:
    d = f"(sqrt({_seqsum(_zip(a, a, 'X * Y'))}) * sqrt({_seqsum(_zip(b, b, 'X * Y'))}))"
    return f"CASE WHEN {d} > 0 THEN {_seqsum(_zip(a, b, 'X * Y'))} / {d} ELSE 0.0 END"


COS_SQL = f"""cs AS (SELECT ep.pair_id, ep.label, greatest(0.0, least(1.0, ({_cos('a.v', 'b.v')} + 1.0) / 2.0)) AS probability
  FROM ep JOIN ev a ON a.clause_id = ep.id1 JOIN ev b ON b.clause_id = ep.id2)"""
JAC_SQL = f"""tk AS (SELECT clause_id, list_distinct({q.tokens('clause')}) AS t FROM c),
js AS (SELECT lp.pair_id, lp.label, CASE WHEN len(list_distinct(list_concat(a.t, b.t))) > 0
  THEN len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) ELSE 0.0 END AS probability
  FROM lp JOIN tk a ON a.clause_id = lp.id1 JOIN tk b ON b.clause_id = lp.id2)"""
SCORED_SQL = f"""{DOC_PAIRS},\n{JAC_SQL},\n{EMB_PAIRS},\n{COS_SQL},
sc AS (SELECT model, pair_id, label, probability, CASE WHEN probability >= {CFG.threshold} THEN 1 ELSE 0 END AS predicted
  FROM (SELECT 'jaccard' AS model, pair_id, label, CAST(probability AS DOUBLE) AS probability FROM js
        UNION ALL SELECT 'cosine', pair_id, label, probability FROM cs))"""


def emb_items(spark, sf):
    return embedding_items(spark, sf)


def scored_jaccard(spark, sf):
    return sc.to_scored(fe.jaccard_scores(doc_pairs(spark, sf), doc_drafts(spark, sf)), "jaccard", CFG.threshold)


def scored_cosine(spark, sf):
    return sc.to_scored(fe.cosine_scores(emb_pairs(spark, sf), emb_items(spark, sf)), "cosine", CFG.threshold)


def scored_all(spark, sf):
    """Both test scorers in one scored table, materialised once (scoring is the costly step)."""
    return checkpointed(scored_jaccard(spark, sf).unionByName(scored_cosine(spark, sf)))


@register("pair_features", f"""WITH {EMB_PAIRS},
f AS (SELECT ep.pair_id, list_concat(a.v, b.v, {_zip('a.v', 'b.v', 'abs(X - Y)')}, {_zip('a.v', 'b.v', 'X * Y')}) AS feat
  FROM ep JOIN ev a ON a.clause_id = ep.id1 JOIN ev b ON b.clause_id = ep.id2),
x AS (SELECT pair_id, unnest(feat) AS v, generate_subscripts(feat, 1) - 1 AS pos FROM f)
SELECT pair_id, CAST(pos AS BIGINT) AS pos, round(v, 6) AS value FROM x""")
def _pair_features(spark, sf):
    j = fe.with_pair_features(fe.attach_vectors(emb_pairs(spark, sf), emb_items(spark, sf)))
    return canon(j.select("pair_id", F.posexplode("features").alias("pos", "value")))


@register("max_pool", f"""WITH {E_VEC}, x AS (SELECT e.label, unnest(v.v) AS val, generate_subscripts(v.v, 1) - 1 AS dim
  FROM embeddings e JOIN ev v ON v.clause_id = e.vec_id)
SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim, round(max(val), 6) AS value FROM x GROUP BY ALL""")
def _max_pool(spark, sf):
    e = table(spark, sf, "embeddings")
    p = fe.max_pool(e, ["label"], "embedding")
    return canon(p.select("label", F.posexplode("pooled").alias("dim", "value")))


EMB_DIM = 8


@register("clause_encoding", f"""WITH {VOCAB_LANG},
{q.encode_cte('c', 'vocab', 'enc', None)},
tok AS (SELECT DISTINCT clause_id, unnest(seq) AS idx FROM enc),
vec AS (SELECT idx, dim, ({q.h('emb', "(idx || ':' || dim)")} % 100000 / 100000.0::DOUBLE - 0.5::DOUBLE) / 10.0::DOUBLE AS val
  FROM vocab, (SELECT unnest(range({EMB_DIM})) AS dim)),
x AS (SELECT clause_id, dim, max(val) AS val FROM tok JOIN vec USING (idx) WHERE idx <> 0 GROUP BY ALL)
SELECT c.clause_id, CAST(x.dim AS BIGINT) AS dim, round(x.val, 6) AS value FROM c LEFT JOIN x USING (clause_id)""")
def _clause_encoding(spark, sf):
    e = enc.encode(doc_drafts(spark, sf, "lang"), doc_vocab(spark, sf))
    p = fe.clause_encoding(e, fe.init_vectors(doc_vocab(spark, sf), EMB_DIM, CFG.seed))
    return canon(p.select("clause_id", F.posexplode_outer("encoding").alias("dim", "value")))


@register("cosine_score", f"WITH {EMB_PAIRS},\n{COS_SQL} SELECT pair_id, CAST(label AS BIGINT) AS label, "
          "round(probability, 6) AS probability FROM cs")
def _cosine_score(spark, sf):
    return canon(fe.cosine_scores(emb_pairs(spark, sf), emb_items(spark, sf)).select("pair_id", "label", "probability"))


@register("jaccard_score", f"WITH {DOC_PAIRS},\n{JAC_SQL} SELECT pair_id, CAST(label AS BIGINT) AS label, "
          "round(probability, 6) AS probability FROM js")
def _jaccard_score(spark, sf):
    return canon(fe.jaccard_scores(doc_pairs(spark, sf), doc_drafts(spark, sf)).select("pair_id", "label", "probability"))


# ---------------------------------------------------------------- evaluation

@register("threshold_predict", f"WITH {SCORED_SQL} SELECT model, pair_id, CAST(label AS BIGINT) AS label, "
          "round(probability, 6) AS probability, CAST(predicted AS BIGINT) AS predicted FROM sc")
def _threshold_predict(spark, sf):
    return canon(scored_all(spark, sf))


CONF_SQL = """lab AS (SELECT DISTINCT model, label AS c FROM sc UNION SELECT DISTINCT model, predicted FROM sc),
cnt AS (SELECT model, label, predicted, count(*) AS n FROM sc GROUP BY ALL),
cm AS (SELECT a.model, a.c AS label, b.c AS predicted, coalesce(cnt.n, 0) AS n FROM lab a JOIN lab b ON a.model = b.model
  LEFT JOIN cnt ON cnt.model = a.model AND cnt.label = a.c AND cnt.predicted = b.c)"""


@register("confusion_matrix", f"WITH {SCORED_SQL},\n{CONF_SQL} SELECT model, CAST(label AS BIGINT) AS label, "
          "CAST(predicted AS BIGINT) AS predicted, CAST(n AS BIGINT) AS n FROM cm")
def _confusion_matrix(spark, sf):
    return canon(me.confusion_matrix(scored_all(spark, sf)))


BIN_SQL = """bm AS (SELECT model, count(*) AS n, sum(CASE WHEN label = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN label <> 1 AND predicted = 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN label = 1 AND predicted <> 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN label = predicted THEN 1 ELSE 0 END) AS nc FROM sc GROUP BY model),
bmx AS (SELECT model, nc / n AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score FROM bm)"""
ROC_SQL = """rk AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY probability)
  + (count(*) OVER (PARTITION BY model, probability) - 1) / 2.0 AS r FROM sc),
roc AS (SELECT model, CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN
  (sum(CASE WHEN label = 1 THEN r ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label))
  ELSE 0.0 END AS roc_auc FROM rk GROUP BY model)"""
AP_SQL = """dd AS (SELECT model, probability, sum(label) AS tp, sum(1 - label) AS fp FROM sc GROUP BY ALL),
cc AS (SELECT *, sum(tp) OVER (PARTITION BY model ORDER BY probability DESC) AS ctp,
  sum(fp) OVER (PARTITION BY model ORDER BY probability DESC) AS cfp FROM dd),
ap AS (SELECT model, CASE WHEN sum(tp) > 0 THEN sum(tp * ctp / (ctp + cfp)) / sum(tp) ELSE 0.0 END AS pr_auc
  FROM cc GROUP BY model)"""


@register("binary_metrics", f"WITH {SCORED_SQL},\n{BIN_SQL} SELECT model, round(accuracy, 6) AS accuracy, "
          "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM bmx")
def _binary_metrics(spark, sf):
    return canon(me.binary_metrics(scored_all(spark, sf)))


@register("roc_auc", f"WITH {SCORED_SQL},\n{ROC_SQL} SELECT model, round(roc_auc, 6) AS roc_auc FROM roc")
def _roc_auc(spark, sf):
    return canon(me.roc_auc(scored_all(spark, sf)))


@register("average_precision", f"WITH {SCORED_SQL},\n{AP_SQL} SELECT model, round(pr_auc, 6) AS pr_auc FROM ap")
def _average_precision(spark, sf):
    return canon(me.average_precision(scored_all(spark, sf)))


@register("log_loss", f"""WITH {SCORED_SQL}
SELECT model, round(avg(-(label * (CASE WHEN probability <= 0 THEN -100.0 ELSE greatest(ln(probability), -100.0) END)
  + (1 - label) * (CASE WHEN 1 - probability <= 0 THEN -100.0 ELSE greatest(ln(1 - probability), -100.0) END))), 6)
  AS log_loss FROM sc GROUP BY model""")
def _log_loss(spark, sf):
    return canon(me.log_loss(scored_all(spark, sf)))


EVAL_SQL = f"{SCORED_SQL},\n{BIN_SQL},\n{ROC_SQL},\n{AP_SQL}"
EVAL_SELECT = ("SELECT bmx.model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, "
               "round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc, "
               "round(pr_auc, 6) AS pr_auc FROM bmx JOIN roc USING (model) JOIN ap USING (model)")


@register("evaluate_models", f"WITH {EVAL_SQL} {EVAL_SELECT}")
def _evaluate_models(spark, sf):
    return canon(me.evaluate(scored_all(spark, sf)))


@register("class_report", f"""WITH {SCORED_SQL},\n{CONF_SQL},
per AS (SELECT model, label AS c, sum(CASE WHEN label = predicted THEN n ELSE 0 END) AS tp, sum(n) AS support
  FROM cm GROUP BY ALL),
pr AS (SELECT model, predicted AS c, sum(n) AS n_pred FROM cm GROUP BY ALL),
k AS (SELECT per.model, per.c, support, tp, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
  CASE WHEN support + n_pred > 0 THEN 2 * tp / (support + n_pred) ELSE 0.0 END AS f1
  FROM per JOIN pr ON per.model = pr.model AND per.c = pr.c),
a AS (SELECT model, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, sum(support) AS tot, sum(tp) AS tp,
  sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM k GROUP BY model)
SELECT model, CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM k
UNION ALL SELECT model, 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(tot AS BIGINT) FROM a
UNION ALL SELECT model, 'weighted avg', round(wp / tot, 6), round(wr / tot, 6), round(wf / tot, 6), CAST(tot AS BIGINT) FROM a
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(tp / tot, 6), CAST(tot AS BIGINT) FROM a""")
def _class_report(spark, sf):
    return canon(me.class_report(scored_all(spark, sf)))


def _ell(x: str) -> str:
    return f"CASE WHEN length({x}) > 150 THEN substr({x}, 1, 150) || '...' ELSE {x} END"


def _examples_sql(n: int) -> str:
    return f"""{SCORED_SQL},
top AS (SELECT * FROM (SELECT *, label = predicted AS correct,
  row_number() OVER (PARTITION BY model, label = predicted ORDER BY pair_id) AS r FROM sc WHERE model = 'jaccard') WHERE r <= {n}),
exs AS (SELECT top.model, top.pair_id, {_ell('a.clause')} AS clause1, {_ell('b.clause')} AS clause2,
  CASE WHEN top.label = 1 THEN 'Similar' ELSE 'Different' END AS true_label,
  CASE WHEN top.predicted = 1 THEN 'Similar' ELSE 'Different' END AS predicted_label,
  round(top.probability, 6) AS probability, correct
  FROM top JOIN lp ON lp.pair_id = top.pair_id JOIN c a ON a.clause_id = lp.id1 JOIN c b ON b.clause_id = lp.id2)"""


@register("qualitative_examples", f"WITH {_examples_sql(CFG.num_examples)} SELECT * FROM exs")
def _qualitative_examples(spark, sf):
    return canon(ex.qualitative_examples(scored_jaccard(spark, sf), doc_pairs(spark, sf), doc_clauses(spark, sf), CFG.num_examples))


@register("report_examples", f"WITH {_examples_sql(5)} SELECT model, pair_id, clause1, clause2, true_label, "
          "predicted_label, probability FROM exs")
def _report_examples(spark, sf):
    e = ex.qualitative_examples(scored_jaccard(spark, sf), doc_pairs(spark, sf), doc_clauses(spark, sf), CFG.num_examples)
    return canon(ex.report_examples(e, 5))


# ---------------------------------------------------------------- training-history analytics

from simpairs.operators import history as hi  # noqa: E402

TARGET = 0.95          # stop target used on the synthetic log (k/100 reaches it now and then)
EVERY = 2              # progress report interval for the 5..9-batch epochs of the fixture

BLOG_SQL = """ev AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS s,
  count(*) OVER (PARTITION BY user_id) AS len, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ev2 AS (SELECT *, (s * 10) // len AS e FROM ev),
bl AS (SELECT run, CAST(e AS INTEGER) AS epoch, CAST(s - (e * len + 9) // 10 + 1 AS INTEGER) AS batch,
  value AS batch_loss, k AS correct, 100 AS n FROM ev2)"""
HIST_SQL = BLOG_SQL + """,
hist AS (SELECT run, epoch, avg(batch_loss) AS loss, CAST(sum(correct) AS DOUBLE) / sum(n) AS accuracy,
  arg_max(batch_loss, batch) AS val_loss, arg_max(correct, batch) / 100.0::DOUBLE AS val_accuracy FROM bl GROUP BY ALL)"""
HIST_SELECT = ("SELECT run, CAST(epoch AS BIGINT) AS epoch, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, "
               "round(val_loss, 6) AS val_loss, round(val_accuracy, 6) AS val_accuracy")


def batch_log(spark, sf):
    return hi.batch_log_from_events(table(spark, sf, "events"))


def history(spark, sf):
    return hi.history_from_batch_log(batch_log(spark, sf))


@register("batch_log", f"WITH {BLOG_SQL} SELECT run, CAST(epoch AS BIGINT) AS epoch, CAST(batch AS BIGINT) AS batch, "
          "round(batch_loss, 6) AS batch_loss, CAST(correct AS BIGINT) AS correct, CAST(n AS BIGINT) AS n FROM bl")
def _batch_log(spark, sf):
    return canon(batch_log(spark, sf))


@register("epoch_summary", f"""WITH {BLOG_SQL} SELECT run, CAST(epoch AS BIGINT) AS epoch, round(avg(batch_loss), 6) AS loss,
round(CASE WHEN sum(n) > 0 THEN CAST(sum(correct) AS DOUBLE) / sum(n) ELSE 0.0 END, 6) AS accuracy FROM bl GROUP BY ALL""")
def _epoch_summary(spark, sf):
    return canon(hi.epoch_summary(batch_log(spark, sf)))


@register("running_progress", f"""WITH {BLOG_SQL},
r AS (SELECT run, epoch, batch, sum(batch_loss) OVER w / batch AS avg_loss,
  CAST(sum(correct) OVER w AS DOUBLE) / greatest(sum(n) OVER w, 1) AS accuracy,
  max(batch) OVER (PARTITION BY run, epoch) AS n_batches FROM bl
  WINDOW w AS (PARTITION BY run, epoch ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT run, CAST(epoch AS BIGINT) AS epoch, CAST(batch AS BIGINT) AS batch, round(avg_loss, 6) AS avg_loss,
  round(accuracy, 6) AS accuracy, CAST(n_batches AS BIGINT) AS n_batches FROM r WHERE batch % {EVERY} = 0 OR batch = n_batches""")
def _running_progress(spark, sf):
    return canon(hi.running_progress(batch_log(spark, sf), EVERY))


@register("training_history", f"WITH {HIST_SQL} {HIST_SELECT} FROM hist")
def _training_history(spark, sf):
    return canon(history(spark, sf))


def _fold_sql(variant: str) -> str:
    if variant == "keras":
        cur, d, me = "coalesce(h.val_accuracy, h.accuracy, 0.0::DOUBLE)", "0.001::DOUBLE", 2
        best = f"CASE WHEN hit THEN f.best WHEN {cur} - f.best >= {d} THEN {cur} ELSE f.best END"
        cnt = f"CASE WHEN hit THEN f.cnt WHEN {cur} - f.best >= {d} THEN 0 ELSE f.cnt + 1 END"
    else:
        cur, d, me = "coalesce(h.val_accuracy, 0.0::DOUBLE)", "0.0005::DOUBLE", 1
        best = f"CASE WHEN hit THEN f.best WHEN {cur} - f.best >= {d} OR {cur} > f.best THEN {cur} ELSE f.best END"
        cnt = (f"CASE WHEN hit THEN f.cnt WHEN {cur} - f.best >= {d} THEN 0 WHEN {cur} > f.best THEN f.cnt "
               f"ELSE f.cnt + 1 END")
    hit = f"({cur} >= {TARGET!r}::DOUBLE)"
    best, cnt = best.replace("hit", hit), cnt.replace("hit", hit)
    plateau = f"(({cnt}) >= 3 AND h.epoch >= {me})"
    return f"""WITH RECURSIVE {HIST_SQL},
f(run, epoch, best, cnt, stop, reason) AS (
  SELECT DISTINCT run, -1, 0.0::DOUBLE, 0, NULL::INTEGER, NULL::VARCHAR FROM hist
  UNION ALL
  SELECT f.run, h.epoch, {best}, {cnt},
    CASE WHEN {hit} OR {plateau} THEN h.epoch END,
    CASE WHEN {hit} THEN 'target' WHEN {plateau} THEN 'plateau' END
  FROM f JOIN hist h ON h.run = f.run AND h.epoch = f.epoch + 1 WHERE f.stop IS NULL),
fin AS (SELECT run, arg_max(stop, epoch) AS stop, arg_max(reason, epoch) AS reason, arg_max(best, epoch) AS best FROM f GROUP BY run),
le AS (SELECT run, max(epoch) AS last_epoch FROM hist GROUP BY run)
SELECT fin.run, CAST(coalesce(stop, last_epoch) AS BIGINT) AS stop_epoch, coalesce(reason, 'completed') AS reason,
  round(best, 6) AS best_accuracy, CAST(coalesce(stop, last_epoch) + 1 AS BIGINT) AS epochs_run FROM fin JOIN le USING (run)"""


@register("plateau_keras_rule", _fold_sql("keras"))
def _plateau_keras_rule(spark, sf):
    return canon(hi.plateau_stop_keras(history(spark, sf), target=TARGET))


@register("plateau_torch_rule", _fold_sql("torch"))
def _plateau_torch_rule(spark, sf):
    return canon(hi.plateau_stop_torch(history(spark, sf), target=TARGET))


@register("early_stop_loss", f"""WITH {HIST_SQL},
a AS (SELECT run, epoch, val_loss, min(val_loss) OVER (PARTITION BY run ORDER BY epoch
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM hist),
b AS (SELECT *, epoch - max(CASE WHEN prev IS NULL OR val_loss < prev THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wait FROM a),
s AS (SELECT run, min(CASE WHEN wait >= 5 THEN epoch END) AS stop_epoch, max(epoch) AS last_epoch FROM b GROUP BY run),
bb AS (SELECT b.run, arg_min(b.epoch, (b.val_loss, b.epoch)) AS best_epoch, min(b.val_loss) AS best_val_loss
  FROM b JOIN s USING (run) WHERE b.epoch <= coalesce(s.stop_epoch, s.last_epoch) GROUP BY b.run)
SELECT run, CAST(stop_epoch AS BIGINT) AS stop_epoch, CAST(best_epoch AS BIGINT) AS best_epoch,
  round(best_val_loss, 6) AS best_val_loss FROM s JOIN bb USING (run)""")
def _early_stop_loss(spark, sf):
    return canon(hi.early_stop_loss(history(spark, sf)))


@register("lr_schedule", f"""WITH RECURSIVE {HIST_SQL},
f(run, epoch, best, wait, lr, lr_used) AS (
  SELECT DISTINCT run, -1, 'inf'::DOUBLE, 0, 0.001::DOUBLE, NULL::DOUBLE FROM hist
  UNION ALL
  SELECT f.run, h.epoch,
    CASE WHEN h.val_loss < f.best - 0.0001::DOUBLE THEN h.val_loss ELSE f.best END,
    CASE WHEN h.val_loss < f.best - 0.0001::DOUBLE THEN 0 WHEN f.wait + 1 >= 3 AND f.lr > 1e-7::DOUBLE THEN 0 ELSE f.wait + 1 END,
    CASE WHEN NOT (h.val_loss < f.best - 0.0001::DOUBLE) AND f.wait + 1 >= 3 AND f.lr > 1e-7::DOUBLE
      THEN greatest(f.lr * 0.5::DOUBLE, 1e-7::DOUBLE) ELSE f.lr END,
    f.lr
  FROM f JOIN hist h ON h.run = f.run AND h.epoch = f.epoch + 1)
SELECT run, CAST(epoch AS BIGINT) AS epoch, round(lr_used * 1000000.0::DOUBLE, 6) AS lr_micro FROM f WHERE epoch >= 0""")
def _lr_schedule(spark, sf):
    s = hi.lr_schedule(history(spark, sf))
    return canon(s.select("run", "epoch", (F.col("lr") * 1e6).alias("lr_micro")))


@register("best_epoch", f"""WITH {HIST_SQL}
SELECT run, CAST(arg_min(epoch, (val_loss, epoch)) AS BIGINT) AS best_loss_epoch, round(min(val_loss), 6) AS best_val_loss,
  CAST(arg_max(epoch, (val_accuracy, -epoch)) AS BIGINT) AS best_acc_epoch, round(max(val_accuracy), 6) AS best_val_accuracy
FROM hist GROUP BY run""")
def _best_epoch(spark, sf):
    return canon(hi.best_epoch(history(spark, sf)))


@register("history_union", f"""WITH {HIST_SQL}
SELECT m.model, run, CAST(epoch AS BIGINT) AS epoch, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy,
  round(val_loss, 6) AS val_loss, round(val_accuracy, 6) AS val_accuracy
FROM hist, (VALUES ('keras'), ('torch')) m(model)""")
def _history_union(spark, sf):
    h = history(spark, sf)
    # the same log saved in both history layouts (loss/accuracy and train_loss/train_accuracy)
    keras = h
    torch = h.select(
        "run", "epoch", F.col("loss").alias("train_loss"), F.col("accuracy").alias("train_accuracy"),
        "val_loss", "val_accuracy")
    u = hi.union_histories({"keras": keras, "torch": torch})
    return canon(u.select("model", "run", "epoch", "loss", "accuracy", "val_loss", "val_accuracy"))


@register("history_json_roundtrip", f"WITH {HIST_SQL} {HIST_SELECT} FROM hist")
def _history_json_roundtrip(spark, sf):
    import uuid
    from simpairs.sources import artifacts as art
    from simpairs.sources.shared import shared_dir
    path = f"{shared_dir(spark).rstrip('/')}/simpairs-history-{uuid.uuid4().hex}"
    art.save_history_json(history(spark, sf), path)
    back = art.load_history(spark, json_path=path)
    return canon(back.select(*hi.HISTORY_COLS))


# ---------------------------------------------------------------- reports

from simpairs.operators import report as rp  # noqa: E402

MODELS = ["cosine", "jaccard"]


def _sizes_sql(pairs: str, name: str, model: str) -> str:
    return (split_sql(pairs, "pair_id", "label", name) + ",\n" +
            f"""{name}_sz AS (SELECT '{model}' AS model, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS training_samples,
  sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS validation_samples,
  sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS test_samples FROM {name})""")


@register("model_comparison", f"""WITH {EVAL_SQL},
{q.clauses_cte('lang', 'cl')},\n{q.vocab_ctes('cl', CFG.min_freq)},
{_sizes_sql('lp', 'spj', 'jaccard')},\n{_sizes_sql('ep', 'spc', 'cosine')},
sizes AS (SELECT * FROM spj_sz UNION ALL SELECT * FROM spc_sz),
m AS ({EVAL_SELECT})
SELECT m.*, CAST({CFG.epochs} AS BIGINT) AS epochs, CAST({CFG.batch_size} AS BIGINT) AS batch_size,
  round({CFG.learning_rate!r}::DOUBLE, 6) AS learning_rate, CAST(training_samples AS BIGINT) AS training_samples,
  CAST(validation_samples AS BIGINT) AS validation_samples, CAST(test_samples AS BIGINT) AS test_samples,
  (SELECT count(*) FROM vocab) AS vocabulary_size FROM m LEFT JOIN sizes USING (model)""")
def _model_comparison(spark, sf):
    scored = scored_all(spark, sf)
    sizes = (rp.split_counts(spl.stratified_split(doc_pairs(spark, sf), "pair_id", "label", CFG), "jaccard")
             .unionByName(rp.split_counts(spl.stratified_split(emb_pairs(spark, sf), "pair_id", "label", CFG), "cosine")))
    vsize = doc_vocab(spark, sf).select(F.count(F.lit(1))).scalar()
    return canon(rp.model_comparison(me.evaluate(scored), sizes, CFG, vsize, with_timestamp=False))


def _mm_rows(metric: str) -> str:
    return f"SELECT '{metric}' AS metric, model, {metric} AS value FROM m"


@register("metric_matrix", f"""WITH {EVAL_SQL}, m AS ({EVAL_SELECT}),
l AS ({' UNION ALL '.join(_mm_rows(x) for x in rp.METRIC_COLS)})
SELECT metric, {', '.join(f"round(coalesce(max(CASE WHEN model = '{x}' THEN value END), 0.0), 6) AS {x}" for x in MODELS)}
FROM l GROUP BY metric""")
def _metric_matrix(spark, sf):
    return canon(rp.metric_matrix(me.evaluate(scored_all(spark, sf)), MODELS))


def _f4_sql(x: str) -> str:
    return f"printf('%.4f', floor({x} * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE)"


@register("summary_table", f"""WITH {EVAL_SQL}, m AS (SELECT bmx.model, accuracy, precision, recall, f1_score, roc_auc FROM bmx JOIN roc USING (model)),
o AS (SELECT model, label = predicted AS correct, row_number() OVER (PARTITION BY model, label = predicted ORDER BY pair_id) AS r FROM sc),
x AS (SELECT model, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS BIGINT) AS nc,
  CAST(sum(CASE WHEN correct THEN 0 ELSE 1 END) AS BIGINT) AS ni FROM o WHERE r <= {CFG.num_examples} GROUP BY model)
SELECT m.model AS "Model", {_f4_sql('accuracy')} AS "Accuracy", {_f4_sql('precision')} AS "Precision",
  {_f4_sql('recall')} AS "Recall", {_f4_sql('f1_score')} AS "F1-Score", {_f4_sql('roc_auc')} AS "ROC-AUC",
  coalesce(nc, 0) AS "Correct (Sample)", coalesce(ni, 0) AS "Incorrect (Sample)" FROM m LEFT JOIN x USING (model)""")
def _summary_table(spark, sf):
    s = scored_all(spark, sf)
    return canon(rp.summary_table(me.evaluate(s), s, CFG.num_examples))
FLAGSHIP = "evaluate_models"


# ---------------------------------------------------------------- learned models and the scorer surface
# (no plain-SQL oracle: training is iterative; the driver checks rows only)

def overlap_scorer():
    """Example factory for the batch-scoring surface: share of distinct non-PAD ids common to both padded
    sequences, for all rows of a batch at a time."""
    import numpy as np

    def distinct(x):
        x = np.sort(x, axis=1)
        return np.where((x != 0) & np.c_[np.ones((len(x), min(1, x.shape[1])), bool), x[:, 1:] != x[:, :-1]], x, 0)

    def score(seq1, seq2):
        a, b = distinct(seq1), distinct(seq2)
        # an id of both stands twice in a row of the merged distinct ids
        z = np.sort(np.concatenate([a, b], axis=1), axis=1)
        both = ((z[:, 1:] == z[:, :-1]) & (z[:, 1:] > 0)).sum(axis=1)
        union = (a > 0).sum(axis=1) + (b > 0).sum(axis=1) - both
        return np.where(union > 0, both / np.maximum(union, 1), 0.0)
    return score


@register("word_vectors", f"""WITH {VOCAB_LANG},
{q.encode_cte('c', 'vocab', 'enc', None)},
u AS (SELECT a.idx AS i, b.idx AS j FROM enc_j a CROSS JOIN (SELECT unnest(range(1, {vec.WINDOW + 1})) AS d) o
  JOIN enc_j b ON b.id = a.id AND b.pos = a.pos + o.d WHERE a.idx >= 4 AND b.idx >= 4),
p AS (SELECT w, x, count(*) AS c FROM (SELECT i AS w, j AS x FROM u UNION ALL SELECT j, i FROM u) GROUP BY ALL),
m AS (SELECT w, CAST(sum(c) AS BIGINT) AS n FROM p GROUP BY w), tot AS (SELECT CAST(sum(n) AS DOUBLE) AS n FROM m),
v AS (SELECT p.w, p.x, CAST(floor({vec.UNITS}.0::DOUBLE * ln(CAST(p.c AS DOUBLE) * tot.n / (CAST(a.n AS DOUBLE) * CAST(b.n AS DOUBLE)))) AS BIGINT) AS v
  FROM p JOIN m a ON a.w = p.w JOIN m b ON b.w = p.x CROSS JOIN tot),
r AS (SELECT idx AS x, {q.h('ri_dim', "(idx || ':' || e)")} % 32 AS dim, 1 - 2 * ({q.h('ri_sign', "(idx || ':' || e)")} % 2) AS sgn
  FROM vocab, (SELECT unnest(range({vec.NONZERO})) AS e)),
s AS (SELECT v.w, r.dim, CAST(sum(v.v * r.sgn) AS BIGINT) AS s FROM v JOIN r ON r.x = v.x WHERE v.v > 0 GROUP BY ALL)
SELECT CAST(idx AS BIGINT) AS idx, word, string_agg(CAST(coalesce(s.s, 0) AS VARCHAR), ' ' ORDER BY d.dim) AS vector
FROM vocab CROSS JOIN (SELECT unnest(range(32)) AS dim) d LEFT JOIN s ON s.w = vocab.idx AND s.dim = d.dim
WHERE idx >= 4 GROUP BY idx, word""")
def _word_vectors(spark, sf):
    return canon(vec.word_vectors(doc_clauses(spark, sf, "lang"), doc_vocab(spark, sf), CFG))


@register("train_classifier")
def _train_classifier(spark, sf):
    from simpairs.functions.arrays import pair_features
    items = emb_items(spark, sf)
    feats = fe.attach_vectors(emb_pairs(spark, sf), items).select(
        "pair_id", "label", pair_features("e1", "e2").alias("features"))
    s = checkpointed(spl.stratified_split(feats, "pair_id", "label", CFG))
    model, _ = sc.train_classifier(s.where("split = 'train'"), s.where("split = 'val'"), 256, CFG)
    return canon(sc.classifier_scores(model, s.where("split = 'test'"), "mlp", CFG))


@register("saved_model_scores")
def _saved_model_scores(spark, sf):
    """Pairs of clause encodings -> a classifier, saved, loaded for the same vocabulary, and applied to the test split."""
    import uuid
    from simpairs.functions.arrays import pair_features
    from simpairs.sources import models
    from simpairs.sources.shared import shared_dir
    vocab = doc_vocab(spark, sf)
    encoded = fe.clause_encoding(enc.encode(doc_clauses(spark, sf, "lang"), vocab), fe.init_vectors(vocab, EMB_DIM, CFG.seed))
    items = checkpointed(encoded.select("clause_id", F.coalesce("encoding", F.array_repeat(F.lit(0.0), EMB_DIM)).alias("embedding")))
    feats = fe.attach_vectors(doc_pairs(spark, sf), items).select("pair_id", "label", pair_features("e1", "e2").alias("features"))
    s = checkpointed(spl.stratified_split(feats, "pair_id", "label", CFG))
    model, _ = sc.train_classifier(s.where("split = 'train'"), s.where("split = 'val'"), 4 * EMB_DIM, CFG)
    path = f"{shared_dir(spark).rstrip('/')}/simpairs-model-{uuid.uuid4().hex}"
    models.save_model(model, path, vocab, {"threshold": CFG.threshold, "dimensions": EMB_DIM})
    loaded, _ = models.load_model(spark, path, vocab)
    return canon(sc.classifier_scores(loaded, s.where("split = 'test'"), "mlp", CFG))


@register("batch_score", f"""WITH {C_SMALL},\n{labelled_sql('c', 'lp')},
{q.clauses_cte('lang', 'cl')},\n{q.vocab_ctes('cl', CFG.min_freq)},
{q.encode_cte('c', 'vocab', 'enc', None)},
ids AS (SELECT clause_id, list_distinct(list_filter(seq, lambda x: x <> 0)) AS t FROM enc),
o AS (SELECT lp.pair_id, lp.label, CASE WHEN len(list_distinct(list_concat(a.t, b.t))) > 0
  THEN len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) ELSE 0.0 END AS p
  FROM lp JOIN ids a ON a.clause_id = lp.id1 JOIN ids b ON b.clause_id = lp.id2)
SELECT 'overlap' AS model, pair_id, CAST(label AS BIGINT) AS label, round(p, 6) AS probability,
  CAST(CASE WHEN p >= {CFG.threshold} THEN 1 ELSE 0 END AS BIGINT) AS predicted FROM o""")
def _batch_score(spark, sf):
    seqs = enc.prepare_pairs(doc_pairs(spark, sf), doc_drafts(spark, sf), doc_vocab(spark, sf), None)
    return canon(sc.batch_score(seqs, overlap_scorer, "overlap", CFG, batch_size=256))


@register("logit_score", f"""WITH {EMB_PAIRS},
lg AS (SELECT ep.pair_id, ep.label, {_seqsum(_zip('a.v', 'b.v', 'X * Y'))} AS z
  FROM ep JOIN ev a ON a.clause_id = ep.id1 JOIN ev b ON b.clause_id = ep.id2),
s AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) AS p FROM lg)
SELECT 'dot' AS model, pair_id, CAST(label AS BIGINT) AS label, round(p, 6) AS probability,
  CAST(CASE WHEN p >= {CFG.threshold} THEN 1 ELSE 0 END AS BIGINT) AS predicted FROM s""")
def _logit_score(spark, sf):
    from simpairs.functions.arrays import dot
    j = fe.attach_vectors(emb_pairs(spark, sf), emb_items(spark, sf))
    return canon(sc.to_scored(j.select("pair_id", "label", dot("e1", "e2").alias("z")), "dot", CFG.threshold, "z", "logit"))


@register("batch_numbers", f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, (rn - 1) // {CFG.batch_size} AS batch, CAST(ceil(n / {CFG.batch_size}) AS BIGINT) AS n_batches FROM r""")
def _batch_numbers(spark, sf):
    return canon(smp.batch_numbers(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", CFG.batch_size))


@register("epoch_order", f"SELECT o_orderkey, row_number() OVER (ORDER BY {q.h('epoch3', 'o_orderkey')}, o_orderkey) AS place FROM orders")
def _epoch_order(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return canon(smp.hash_rank(o, "o_orderkey", CFG.seed, "epoch3", (), "place"))


@register("accuracy_time", f"""WITH {EVAL_SQL}, m AS ({EVAL_SELECT.replace('round(', '(').replace(', 6) AS', ') AS')}),
tm AS (SELECT CASE WHEN source < 'src5' THEN 'cosine' ELSE 'other' END AS model, sum(n_chars) / 1000.0::DOUBLE AS eval_s, count(*) AS n
  FROM documents GROUP BY 1)
SELECT m.model, {', '.join(f"{_f4_sql('m.' + c)} AS {c}" for c in ('accuracy', 'f1_score', 'roc_auc', 'pr_auc'))},
  printf('%.2f', floor(tm.eval_s * 100 + 0.5) / 100) AS eval_seconds,
  printf('%.2f', floor(tm.n / tm.eval_s * 100 + 0.5) / 100) AS samples_per_second FROM m LEFT JOIN tm USING (model)""")
def _accuracy_time(spark, sf):
    # a timing table derived from all documents: every source counts for one of two models, of which one is evaluated
    d = table(spark, sf, "documents")
    name = F.when(F.col("source") < "src5", "cosine").otherwise("other")
    timing = d.groupBy(name.alias("model")).agg((F.sum("n_chars") / 1000.0).alias("eval_s"), F.count(F.lit(1)).alias("n"))
    return canon(rp.accuracy_time_table(me.evaluate(scored_all(spark, sf)), rp.throughput(timing)))


# ---------------------------------------------------------------- category CSV sets

def _csv_folder(spark, name: str) -> str:
    import uuid
    from simpairs.sources.shared import shared_dir
    return f"{shared_dir(spark).rstrip('/')}/simpairs-{name}-{uuid.uuid4().hex}"


@register("csv_ingest", f"""WITH {C_SMALL}
SELECT category, (dense_rank() OVER (ORDER BY category) - 1) * 4294967296
  + row_number() OVER (PARTITION BY category ORDER BY clause_id) - 1 AS clause_id, clause FROM c""")
def _csv_ingest(spark, sf):
    from simpairs.sources.csv_corpus import read_category_csvs, write_category_csvs
    d = table(spark, sf, "documents").select(F.expr(SMALL_CATS).alias("category"), F.col("doc_id").alias("ord"), F.col("text").alias("clause_text"))
    folder = _csv_folder(spark, "csv")
    write_category_csvs(d, folder)
    return canon(read_category_csvs(spark, folder))


@register("csv_mixed_headers", """WITH c AS (
  SELECT source AS category, doc_id, text FROM documents UNION ALL SELECT 'in ' || lang, doc_id, text FROM documents)
SELECT category, (dense_rank() OVER (ORDER BY category) - 1) * 4294967296
  + row_number() OVER (PARTITION BY category ORDER BY doc_id) - 1 AS clause_id, """ + q.clean("coalesce(text, 'nan')") + " AS clause FROM c")
def _csv_mixed_headers(spark, sf):
    from simpairs.sources.csv_corpus import read_category_csvs, write_category_csvs
    # two sub-folders whose files have different headers, the text in another place of each
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), F.col("text").alias("clause_text"), "source", "lang")
    folder = _csv_folder(spark, "csv")
    write_category_csvs(d.withColumn("category", F.col("source")), f"{folder}/first")
    write_category_csvs(d.withColumn("category", F.concat(F.lit("in "), "lang")), f"{folder}/second", text_first=False)
    return canon(read_category_csvs(spark, folder))


@register("csv_rejects", """SELECT DISTINCT 'more fields ' || lang || '.csv' AS file_name, 'malformed rows' AS reason FROM documents""")
def _csv_rejects(spark, sf):
    from simpairs.sources.csv_corpus import read_category_csvs, write_category_csvs
    # a sound file per source, and per language one whose rows have a field too many
    d = table(spark, sf, "documents")
    folder = _csv_folder(spark, "csv")
    write_category_csvs(d.select(F.col("source").alias("category"), F.col("doc_id").alias("ord"), F.col("text").alias("clause_text")), folder)
    write_category_csvs(d.select(F.concat(F.lit("more fields "), "lang").alias("category"), F.col("doc_id").alias("ord"),
                                 F.lit("a,b,c").alias("clause_text")), folder, quote=False)
    return canon(read_category_csvs(spark, folder, with_rejects=True)[1])
