"""End-to-end run: corpus -> vocabulary -> pairs -> split -> encode -> score -> evaluate ->
examples -> reports, with the artifacts written under one output folder.

Every step is a lazy DataFrame; the run materialises exactly the tables the reference
keeps (vocabulary, prepared pairs, scored rows, reports), each once.
"""
from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators import encode as enc
from simpairs.operators import examples as ex
from simpairs.operators import features as fe
from simpairs.operators import metrics as me
from simpairs.operators import pairs as pr
from simpairs.operators import report as rp
from simpairs.operators import sampling as smp
from simpairs.operators import score as sc
from simpairs.operators import split as spl
from simpairs.sources import artifacts as art
from simpairs.sources.shared import written_table


@dataclass
class RunResult:
    vocab: DataFrame
    pairs: DataFrame
    split: DataFrame
    scored: DataFrame
    metrics: DataFrame
    examples: DataFrame
    results: DataFrame
    summary: DataFrame


def run(spark: SparkSession, clauses: DataFrame, out_dir: str, cfg: PairConfig = PairConfig(),
        scorer: Callable | None = None, model_name: str = "model", model_vocab_size: int | None = None) -> RunResult:
    """`scorer` is a factory for `batch_score` (called once per task); without one the token-Jaccard test
    scorer is used. `model_vocab_size` is the vocabulary the scorer was trained with; another size is refused. The whole test split is evaluated unless `cfg.max_eval_samples` says otherwise."""
    out = out_dir.rstrip("/")
    clauses = written_table(clauses, "clauses")
    source = art.input_fingerprint(clauses)
    vocab = art.load_or_build_vocab(spark, out, clauses, cfg.min_freq, source)
    if model_vocab_size is not None:
        sc.check_vocab_compatible(model_vocab_size, vocab)
    pairs = pr.labelled_pairs(clauses, cfg)
    split = written_table(spl.stratified_split(pairs, "pair_id", "label", cfg), "split")
    test = split.where(F.col("split") == "test")
    evaluated = test if cfg.max_eval_samples is None else smp.hash_sample(test, "pair_id", cfg.max_eval_samples, cfg.seed, "eval")
    if scorer is not None:
        seqs = art.load_or_build_pairs(spark, out, cfg, lambda: enc.prepare_pairs(evaluated, clauses, vocab, cfg.max_seq_length),
                                       vocab.count(), source)
        scored = sc.batch_score(seqs, scorer, model_name, cfg)
    else:
        scored = sc.to_scored(fe.jaccard_scores(evaluated, clauses), model_name, cfg.threshold)
    # the rows are counted while they are written
    seen = Observation("scored")
    start = time.time()
    scored = written_table(scored.observe(seen, F.count(F.lit(1)).alias("rows")), "scored")
    seconds = time.time() - start
    metrics = me.evaluate(scored)
    timing = rp.throughput(spark.createDataFrame([(model_name, seconds, seen.get["rows"])], "model string, eval_s double, n long"))
    art.write_report_csv(rp.accuracy_time_table(metrics, timing), f"{out}/accuracy_time")
    examples = ex.qualitative_examples(scored, evaluated, clauses, cfg.num_examples)
    art.write_examples_csv(examples, f"{out}/examples")
    sizes = rp.split_counts(split, model_name)
    results = rp.model_comparison(metrics, sizes, cfg, vocab.select(F.count(F.lit(1))).scalar())
    art.write_report_csv(results, f"{out}/results")
    summary = rp.summary_table(metrics, scored, cfg.num_examples)
    art.write_report_csv(summary, f"{out}/summary")
    return RunResult(vocab, pairs, split, scored, metrics, examples, results, summary)
