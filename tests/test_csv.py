import os
import tempfile

from simpairs.sources.csv_corpus import read_category_csvs


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_mixed_headers_and_broken_file(spark):
    d = tempfile.mkdtemp(prefix="simpairs-csv-")
    _write(d, "alpha.csv", 'clause_text,clause_type\n"First, Clause",x\nSecond one,y\nNA,z\n')
    _write(d, "beta.csv", "clause_type,clause\nx,Beta one\ny,\"multi\nline\"\n")
    _write(d, "gamma.csv", "foo,bar\ngamma text,1\n")
    _write(d, "broken.csv", 'a,b\n1,2\n"unterminated,3,4,5\n')
    _write(d, "notes.CSV", "clause\nignored\n")
    out, rej = read_category_csvs(spark, d, with_rejects=True)
    got = sorted((r.category, r.clause) for r in out.collect())
    assert got == [("alpha", "first, clause"), ("alpha", "nan"), ("alpha", "second one"),
                   ("beta", "beta one"), ("beta", "multi line"), ("gamma", "gamma text")]
    ids = {r.clause: r.clause_id for r in out.collect()}
    assert ids["first, clause"] < ids["second one"] < ids["nan"] < ids["beta one"]
    assert [r.file_name for r in rej.collect()] == ["broken.csv"]


def test_missing_directory(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        read_category_csvs(spark, "/nonexistent/simpairs/dir")


def test_short_rows_repeated_headers_and_odd_names(spark):
    d = tempfile.mkdtemp(prefix="simpairs-csv-")
    _write(d, "non compete.csv", "clause,clause_type\nonly text\nsecond,x\n")
    _write(d, "a%b+c.csv", "clause,clause,kind\none,two,k\n")
    _write(d, "fields.csv", "clause,kind\na,b\nc,d,e\n")
    out, rej = read_category_csvs(spark, d, with_rejects=True)
    assert sorted((r.category, r.clause) for r in out.collect()) == [
        ("a%b+c", "one"), ("non compete", "only text"), ("non compete", "second")]
    assert [(r.file_name, r.reason) for r in rej.collect()] == [("fields.csv", "malformed rows")]


def test_files_one_level_down(spark):
    d = tempfile.mkdtemp(prefix="simpairs-csv-")
    for sub, text in (("x", "first copy"), ("y", "second copy")):
        os.makedirs(os.path.join(d, sub))
        _write(os.path.join(d, sub), "same.csv", f"clause\n{text}\n")
    _write(os.path.join(d, "x"), "other.csv", "clause\nalone\n")
    got = sorted((r.category, r.clause) for r in read_category_csvs(spark, d).collect())
    assert got == [("other", "alone"), ("same", "second copy")]
