"""CSV sets: records of lines that meet the edges of ranges and Arrow batches, and no copy of the texts on the way."""
import csv
import random

import pytest

from simpairs.sources import csv_corpus
from simpairs.sources.csv_corpus import read_category_csvs
from tests.test_csv_ranges import ALPHABET, ranges  # noqa: F401


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _sets(folder, rng):
    """Files and sets of parts with texts that hold line feeds, quotes and blank lines, some missing; the cleaned-up words of each in order."""
    want = {}
    for name, parts in (("a one", [40]), ("b parts", [25, 1, 30]), ("c none", [0]), ("d last", [3])):
        words = []
        for k, rows in enumerate(parts):
            path = folder / f"{name}.csv" if len(parts) == 1 else folder / f"{name}.csv" / f"part-{k:05d}.csv"
            path.parent.mkdir(exist_ok=True)
            with open(path, "w", newline="") as f:
                w = csv.writer(f, lineterminator="\n")
                w.writerow(["clause", "kind"])
                for _ in range(rows):
                    word = f"w{len(words):04d}" if rng.random() < 0.8 else None
                    words.append(word)
                    w.writerow([None if word is None else word + "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))), "k"])
        want[name] = words
    return want


@pytest.mark.parametrize("size", [40, 300, 100_000])
def test_rows_are_numbered_over_ranges_and_batches(spark, tmp_path, ranges, small_batches, size):  # noqa: F811
    want = _sets(tmp_path, random.Random(size))
    ranges(size)
    names = sorted(n for n in want if want[n])
    rows = read_category_csvs(spark, str(tmp_path)).collect()
    got = {(r.category, r.clause_id): r.clause[:5] for r in rows}
    assert len(rows) == len(got) == sum(map(len, want.values()))
    assert got == {(n, (k << 32) + i): w or "nan" for k, n in enumerate(names) for i, w in enumerate(want[n])}
    dropped = {(r.category, r.clause_id): r.clause[:5] for r in read_category_csvs(spark, str(tmp_path), "drop").collect()}
    assert dropped == {(n, (k << 32) + i): w for k, n in enumerate(names) for i, w in enumerate(x for x in want[n] if x)}


def test_texts_are_neither_kept_nor_shuffled(spark, tmp_path, ranges, monkeypatch):  # noqa: F811
    kept = []

    def checkpointed(df):
        made = real(df)
        kept.append(sum(len(str(v)) for r in made.collect() for v in r))
        return made
    real = csv_corpus.checkpointed
    monkeypatch.setattr(csv_corpus, "checkpointed", checkpointed)
    with open(tmp_path / "one.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["clause", "id"])
        for k in range(3000):
            w.writerow([f"text {k}, with a second line\n" + "x" * 200, k])
    size = (tmp_path / "one.csv").stat().st_size
    ranges(size // 6)
    out = read_category_csvs(spark, str(tmp_path))
    assert out.count() == 3000
    # a row per range and the records that two ranges share
    assert sum(kept) < size / 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x]
    assert not any(c in x for x in exchanges for c in ("raw", "record", "__key")), exchanges


def test_texts_are_dealt_in_rounds(spark, tmp_path, monkeypatch):
    dealt = []

    def write(rows, *a):
        dealt.append(rows.count())
        return real(rows, *a)
    real = csv_corpus._write_parts
    monkeypatch.setattr(csv_corpus, "_write_parts", write)
    monkeypatch.setattr(csv_corpus, "PART_BYTES", 10_000)
    # one category holds most rows, some places are missing or shared
    want = [("k" if k % 10 else "a b", None if k % 50 == 0 else k // 3, f"t{k:04d}" + "x" * 60) for k in range(1600)]
    csv_corpus.write_category_csvs(spark.createDataFrame(want, "category string, ord long, clause_text string").repartition(3), f"{tmp_path}/set")
    assert sum(dealt) == 1600 and len(dealt) == csv_corpus.ROUNDS and max(dealt) < 700
    got = sorted(read_category_csvs(spark, f"{tmp_path}/set").collect(), key=lambda r: r.clause_id)
    places = {t[:5]: -1 if o is None else o for _, o, t in want}
    assert sorted(r.clause for r in got) == sorted(t for *_, t in want)
    for c in ("k", "a b"):
        own = [places[r.clause[:5]] for r in got if r.category == c]
        assert own == sorted(own) and len(own) == sum(x == c for x, *_ in want)
