"""simpairs: text-pair similarity analytics expressed as Spark DataFrame plans.

Sub-packages:
  functions  - Column-level building blocks (text cleaning, hashing, arrays, scoring maths)
  sources    - readers and writers (category CSV sets, tables, artifacts)
  operators  - DataFrame -> DataFrame operators (vocabulary, encoding, pairs, split, metrics, ...)
  plans      - composed end-to-end runs and the query registry
  streaming  - stateless operators applied to Structured Streaming input
"""
from simpairs.config import PairConfig

__all__ = ["PairConfig"]
