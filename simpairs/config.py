"""Run parameters. Defaults follow the reference's published configuration."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PairConfig:
    seed: int = 42
    max_seq_length: int = 128
    min_freq: int = 2
    # positive pairs per category; None: as many as the category has clauses
    pairs_per_category: int | None = None
    # the sampler `sample_positive_pairs`: categories above the threshold are sampled down to
    # `sample_size` clauses, and at most `sample_pairs` pairs come from each
    sample_threshold: int = 50
    sample_size: int = 100
    sample_pairs: int = 500
    num_positive: int | None = None
    num_negative: int | None = None
    test_size: float = 0.2
    val_size: float = 0.1
    threshold: float = 0.5
    train_fraction: float = 0.2
    # evaluated rows and rows looked at for examples; None: the whole test set
    max_eval_samples: int | None = None
    max_qualitative_samples: int | None = None
    num_examples: int = 10
    null_policy: str = "literal_nan"  # or "drop"
    epochs: int = 5
    batch_size: int = 32
    learning_rate: float = 0.001
