"""Multi-line CSV files read in byte ranges: record starts from the states of lines."""
import csv
import io
import random

import pytest

from simpairs.sources.csv_corpus import csv_records, read_category_csvs

ALPHABET = ["a", "bc", '"', '""', "\n", "\n\n", ",", " ", "\r\n", "é", "'", '",', ',"', "\n\""]


def _ranges(spark, size):
    for key, value in (("spark.sql.files.maxPartitionBytes", size), ("spark.sql.files.openCostInBytes", 0 if size else None), ("spark.sql.files.minPartitionNum", 1 if size else None)):
        spark.conf.set(key, str(value)) if value is not None else spark.conf.unset(key)


@pytest.fixture
def ranges(spark):
    yield lambda size: _ranges(spark, size)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"):
        spark.conf.unset(key)


def _file(path, rng, rows, quoting=csv.QUOTE_MINIMAL):
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 25))) or "x" for _ in range(rows)]
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=quoting, lineterminator="\n")
        w.writerow(["clause_text", "clause_type"])
        for t in texts:
            w.writerow([t, "k"])
    return texts


@pytest.mark.parametrize("size", [64, 333, 5000])
def test_records_in_any_ranges(spark, tmp_path, ranges, size):
    rng = random.Random(size)
    want = {n: _file(f"{tmp_path}/{n}", rng, rows, q) for n, rows, q in (
        ("one.csv", 120, csv.QUOTE_MINIMAL), ("two.csv", 60, csv.QUOTE_ALL), ("three.csv", 1, csv.QUOTE_MINIMAL))}
    ranges(size)
    records, open_files = csv_records(spark, [f"{tmp_path}/{n}" for n in want])
    assert open_files.count() == 0
    got = {}
    for r in sorted(records.collect(), key=lambda r: (r.file_name, r.block, r.line)):
        got.setdefault(r.file_name, []).append(next(csv.reader(io.StringIO(r.record, newline="")))[0])
    for name, texts in want.items():
        # a carriage return at the end of a line inside a field goes with the line end
        assert [t.replace("\r\n", "\n") for t in got[name][1:]] == [t.replace("\r\n", "\n") for t in texts], name
    if size == 64:
        assert records.select("block").distinct().count() > 20


def test_a_file_is_read_by_as_many_tasks_as_ranges(spark, tmp_path, ranges):
    rng = random.Random(1)
    folder = tmp_path / "set"
    folder.mkdir()
    with open(folder / "big.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "clause"])
        for k in range(4000):
            w.writerow([k, f"clause {k}\nsecond line, with a comma" + "\n" * rng.randint(0, 3)])
    size = (folder / "big.csv").stat().st_size
    ranges(size // 12)
    scan = spark.read.option("lineSep", "\n").text(str(folder))
    assert scan.rdd.getNumPartitions() >= 12
    got = read_category_csvs(spark, str(folder)).collect()
    assert sorted((r.clause_id, r.clause) for r in got) == [(k, f"clause {k} second line, with a comma") for k in range(4000)]


def test_stray_quotes_are_plain_characters(spark, tmp_path, ranges):
    (tmp_path / "pipes.csv").write_text('clause,size\n5" pipe,a "b" c\n6" pipe,x\n"7"" pipe",y\n"8\n9",z\nlast,1\n')
    ranges(16)
    got = read_category_csvs(spark, str(tmp_path)).collect()
    assert [r.clause for r in sorted(got, key=lambda r: r.clause_id)] == ["5 pipe", "6 pipe", "7 pipe", "8 9", "last"]


def test_open_and_mixed_files(spark, tmp_path, ranges):
    (tmp_path / "open.csv").write_text('clause,b\n"never ends,1\nmore,2\n')
    (tmp_path / "wide.csv").write_text("clause_type,Clause Body,c\nt,the body,3\nt,\nt,only\n")
    (tmp_path / "long.csv").write_text("clause\na,b\n")
    (tmp_path / "blank.csv").write_text('\ufeffclause\r\n\r\nfirst\r\n\r\n"second\r\n\r\nhalf"\r\n')
    (tmp_path / "empty.csv").write_text("")
    ranges(10)
    rows, rejects = read_category_csvs(spark, str(tmp_path), with_rejects=True)
    got = {}
    for r in sorted(rows.collect(), key=lambda r: r.clause_id):
        got.setdefault(r.category, []).append(r.clause)
    assert got == {"wide": ["the body", "nan", "only"], "blank": ["first", "second half"]}
    assert {(r.file_name, r.reason) for r in rejects.collect()} == {
        ("open.csv", "malformed rows"), ("long.csv", "malformed rows"), ("empty.csv", "empty file")}


def test_a_category_is_written_in_parts(spark, tmp_path, monkeypatch):
    from simpairs.sources import csv_corpus
    rng = random.Random(7)
    # repeated and null places, texts with line feeds and quotes; one category holds nearly all rows
    want = [("large +x%", None if k % 50 == 0 else k // 2, f'k{k:04d} "q", x\nline{"y" * rng.randint(0, 90)}') for k in range(1500)]
    want += [("small", 1, "only one"), ("middle", 2, None), ("middle", 3, "third")]
    rows = spark.createDataFrame(want, "category string, ord long, clause_text string").repartition(3)
    monkeypatch.setattr(csv_corpus, "PART_BYTES", 20_000)
    for text_first in (True, False):
        folder = f"{tmp_path}/set{text_first}"
        csv_corpus.write_category_csvs(rows, folder, text_first=text_first)
        found = {n: (len(paths), parted) for n, paths, parted in csv_corpus.csv_files(spark, folder)}
        assert set(found) == {"large +x%.csv", "small.csv", "middle.csv"}
        # no task wrote more than a part of the large category
        assert found["large +x%.csv"][0] >= 5 and found["large +x%.csv"][1] and found["small.csv"] == (1, False)
        got = sorted(read_category_csvs(spark, folder).collect(), key=lambda r: r.clause_id)
        rank = {c: k << 32 for k, c in enumerate(sorted({c for c, _, _ in want}))}
        counts = {c: sum(x == c for x, _, _ in want) for c in rank}
        assert sorted(r.clause_id for r in got) == sorted(rank[c] + k for c in rank for k in range(counts[c]))
        places = {t[:5]: -1 if o is None else o for c, o, t in want if t and c.startswith("large")}
        large = [places[r.clause[:5]] for r in got if r.category == "large +x%"]
        assert large == sorted(large) and len(large) == 1500
        assert [r.clause for r in got if r.category != "large +x%"] == ["nan", "third", "only one"]


def test_parts_of_a_set_with_an_open_quote_or_a_wide_row(spark, tmp_path, ranges):
    for name, texts in (("good.csv", ["clause\nfirst\n", "", "kind,clause\nk,second\n"]), ("open.csv", ["clause\na\n", 'clause\n"b\n', "clause\nc\n"]),
                        ("wide.csv", ["clause\na\n", "clause\nb,c\n"]), ("none.csv", ["", ""])):
        (tmp_path / name).mkdir()
        for k, text in enumerate(texts):
            (tmp_path / name / f"part-{k:05d}.csv").write_text(text)
    ranges(10)
    rows, rejects = read_category_csvs(spark, str(tmp_path), with_rejects=True)
    assert [(r.category, r.clause) for r in sorted(rows.collect(), key=lambda r: r.clause_id)] == [("good", "first"), ("good", "second")]
    assert {(r.file_name, r.reason) for r in rejects.collect()} == {
        ("open.csv", "malformed rows"), ("wide.csv", "malformed rows"), ("none.csv", "empty file")}


def test_no_rows_are_dealt_by_file_or_category_alone(spark, tmp_path):
    (tmp_path / "one.csv").write_text('clause\na\n"b\nc"\n')
    (tmp_path / "two.csv").write_text("clause\nd\n")
    records, _ = csv_records(spark, [f"{tmp_path}/one.csv", f"{tmp_path}/two.csv"])
    for d in (records, read_category_csvs(spark, str(tmp_path))):
        plan = d._jdf.queryExecution().executedPlan().toString()
        # a join with a table of a row per file or category moves that table, not the rows
        for line in plan.splitlines():
            if "SortMergeJoin" in line or "ShuffledHashJoin" in line:
                assert "block" in line or "__key" in line, line
