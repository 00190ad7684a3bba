"""Category CSV sets: one CSV file per category, category = file name without '.csv'. A large category may be a folder of that
name, whose files are its parts in the order of their names, each with a header.

Files are read in byte ranges, by one scan of the plain files and one of the parts; a file's header says how many columns its rows
have and which one holds the text. Only file names and header lines are touched on the driver.
"""
from __future__ import annotations

import csv
import functools
import io
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from simpairs.functions.text import clean_text
from simpairs.operators.numbering import number_rows
from simpairs.sources.shared import by_value, checkpointed, released

# Cell strings that pandas' CSV reader turns into a missing value by default
PANDAS_NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                     "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
#: a part of a written category holds about so many bytes of text
PART_BYTES = 32 << 20
#: texts are dealt to their parts in so many rounds
ROUNDS = 4
#: a file is shorter than this: places of parts and ranges follow each other in one number
PART_SPAN = 1 << 40


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _list(spark: SparkSession, directory: str, dirs: bool = False) -> list[tuple[str, str]]:
    fs, p = _fs(spark, directory)
    out = []
    for st in fs.listStatus(p):
        if st.isDirectory() == dirs:
            out.append((st.getPath().getName(), st.getPath().toString()))
    return sorted(out)


def _sets(spark: SparkSession, directory: str) -> list[tuple[str, list[str], bool]]:
    """(name, paths, whether they are parts) of every *.csv, file or folder of parts, directly in `directory`."""
    found = {n: (n, [path], False) for n, path in _list(spark, directory) if n.endswith(".csv")}
    for n, folder in _list(spark, directory, dirs=True):
        parts = [path for part, path in _list(spark, folder) if part.startswith("part-")] if n.endswith(".csv") else []
        if parts:
            found.setdefault(n, (n, parts, True))
    return [found[n] for n in sorted(found)]


def csv_files(spark: SparkSession, directory: str) -> list[tuple[str, list[str], bool]]:
    """(name, paths, whether they are parts) of every *.csv directly in `directory` (case-sensitive suffix): a file, or a folder
    that holds part-* files. If there is none, those one level down are used; on equal names the last copy (in
    sub-directory order) wins. A missing directory raises FileNotFoundError."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such folder of category files: {directory}")
    files = _sets(spark, directory)
    if files:
        return files
    chosen: OrderedDict[str, tuple[str, list[str], bool]] = OrderedDict()
    for _, sub in _list(spark, directory, dirs=True):
        for one in _sets(spark, sub):
            chosen[one[0]] = one
    return sorted(chosen.values())


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    if line is None:
        return None
    row = next(csv.reader(io.StringIO(line.lstrip("﻿"))), None)
    return tuple(row) if row else None


def text_column(header: tuple[str, ...]) -> int:
    """Place of the first column whose lower-cased name contains 'clause' and not 'type', else 0."""
    for k, c in enumerate(header):
        lc = c.lower()
        if "clause" in lc and "type" not in lc:
            return k
    return 0


def _file_name(parts: bool) -> Column:
    """The file name as Spark gives it, URL-encoded, that of a part with its folder's."""
    return F.substring_index("_metadata.file_path", "/", -2) if parts else F.col("_metadata.file_name")


def _plain(df: DataFrame) -> DataFrame:
    """`df` with plain file names ('+' stands for itself in the encoded ones)."""
    return df.withColumn("file_name", F.url_decode(F.regexp_replace("file_name", r"\+", "%2B")))


def _opens(x: Column) -> Column:
    """Whether a line (doubled quotes already taken out) that begins a field leaves a quoted field open: a quote at the
    start of a field opens, the next one closes, all others are plain characters."""
    return F.regexp_replace(x, r'(?<=^|,)"[^"]*+"', "").rlike(r'(^|,)"')


def _states(f0, f1, start: int):
    """The state before each line, and after the last (0: between records' fields, 1: inside a quoted field), if it is `start` before the first. Line i
    maps state k to fk[i]: the last line before with one answer for both fixes the state, lines that swap it turn it."""
    import numpy as np
    turns = np.concatenate([[0], np.cumsum((f0 == 1) & (f1 == 0))])
    fixed = np.concatenate([[-1], np.maximum.accumulate(np.where(f0 == f1, np.arange(len(f0)), -1))]) if len(f0) else np.array([-1])
    since = np.where(fixed >= 0, np.append(f0, 0)[fixed], start)
    return (since + turns - np.where(fixed >= 0, turns[fixed + 1], 0)) % 2


def _pieces(batches) -> Iterator:
    """(batch's rows of one range, whether the range goes on from the batch before), in the order of the lines."""
    import numpy as np
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        file = batch.column("file_name").dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
        for at, to in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            rows = batch.slice(at, to - at)
            own = (rows.column("file_name")[0].as_py(), int(block[at]))
            yield rows, own == last
            last = own


def _line_maps(rows):
    import numpy as np
    f0, f1 = (rows.column(c).to_numpy().astype(np.int64) for c in ("f0", "f1"))
    return f0, f1, rows.column("blank").to_numpy(zero_copy_only=False)


def _range_maps(batches):
    """Per range of a file: the state after it (f0, f1) and the records that begin in it (n0, n1), by the state before it."""
    import pyarrow as pa

    def row(own):
        return pa.RecordBatch.from_pydict({"file_name": pa.array([own[0]]), "block": pa.array([own[1]], pa.int64()), "length": pa.array([own[2]], pa.int64()),
                                           **{f"{c}{k}": pa.array([v[k]], t) for c, v, t in (("f", own[3], pa.int32()), ("n", own[4], pa.int64())) for k in (0, 1)}})

    own = None
    for rows, more in _pieces(batches):
        if own and not more:
            yield row(own)
        if not more:
            own = [rows.column(c)[0].as_py() for c in ("file_name", "block", "length")] + [[0, 1], [0, 0]]
        f0, f1, blank = _line_maps(rows)
        for k in (0, 1):
            state = _states(f0, f1, own[3][k])
            own[3][k] = int(state[-1])
            own[4][k] += int(((state[:-1] == 0) & ~blank).sum())
    if own:
        yield row(own)


def _range_records(batches):
    """The records of each range, whose lines are put together as they come. What lies on the edge of a range - lines that go on with a record of
    an earlier one, a record that does not end here - comes as a piece, named by the range and number (key_block, key_n) of its record."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    names = ["file_name", "block", "line", "n", "record", "key_block", "key_n"]

    def out(own, line, n, record, piece=False):
        size = len(line)
        key = own["held"] if piece and n[0] == 0 else (own["block"], int(n[0])) if piece else (None, None)
        return pa.RecordBatch.from_arrays([pa.array([own["file_name"]] * size, pa.string()), pa.array(np.full(size, own["block"], np.int64)), pa.array(line, pa.int64()), pa.array(n, pa.int64()),
                                           record, *[pa.array([k] * size, pa.int64()) for k in key]], names)

    def last(own):
        """The record that is still open to more lines."""
        if own and own["texts"]:
            yield out(own, [own["line"]], [own["last"]], pa.array(["\n".join(own["texts"])], pa.string()), own["last"] == 0 or own["state"] == 1)

    own = None
    for rows, more in _pieces(batches):
        if not more:
            yield from last(own)
            first = {c: rows.column(c)[0].as_py() for c in ("file_name", "block", "s", "held_block", "held_n")}
            if first["s"] is None:
                raise RuntimeError(f"{first['file_name']}: its ranges changed while it was read")
            own = first | {"held": (first["held_block"], first["held_n"]), "state": first["s"], "n": 0, "texts": [], "line": None, "last": None}
        f0, f1, blank = _line_maps(rows)
        state = _states(f0, f1, own["state"])
        inside, own["state"] = state[:-1] == 1, int(state[-1])
        n = own["n"] + np.cumsum(~inside & ~blank)
        own["n"] = int(n[-1])
        kept = inside | ~blank
        if not kept.any():
            continue
        n, line, values = n[kept], rows.column("line").to_numpy()[kept], rows.column("value").filter(pa.array(kept))
        at = np.flatnonzero(np.diff(n, prepend=-1))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(at, len(n)), pa.int32()), values), "\n")
        n, line = n[at], line[at]
        if own["texts"] and own["last"] == n[0]:
            own["texts"].append(texts[0].as_py())
            n, line, texts = n[1:], line[1:], texts[1:]
        if len(n):
            # no state is open where another record begins; lines before the first one are a piece
            own_state, own["state"] = own["state"], 0
            yield from last(own)
            own["state"] = own_state
            if len(n) > 1 and n[0] == 0:
                yield out(own, line[:1], n[:1], texts[:1], True)
                n, line, texts = n[1:], line[1:], texts[1:]
            if len(n) > 1:
                yield out(own, line[:-1], n[:-1], texts[:-1])
            own |= {"texts": [texts[-1].as_py()], "line": int(line[-1]), "last": int(n[-1])}
    yield from last(own)


def _fixed(df: DataFrame) -> DataFrame:
    """`df`, lazy as before, with the partitions that its scan has now: a scan that is planned again may cut its files otherwise when the cluster has
    grown or shrunk."""
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(df._jdf.queryExecution().toRdd(), df._jdf.schema(), False), spark)


def _ranges(spark: SparkSession, paths: list[str], part_paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """-> lines' records and pieces (see `_range_records`) of all files but those with a quoted field that never ends, and ranges(file_name, block, length,
    s, end, begun, held): a row per range, made once.

    A line is a map of the state before it (inside a quoted field or not) to the state after it. A first scan composes the maps inside each range;
    those of a file's ranges, a small table, are composed in order, which gives the state before every range. With it a second scan finds the records.
    Each range is read in order by one task, so no line is moved or kept for that."""
    by_value()
    scans = [spark.read.option("lineSep", "\n").text(found).select(
        _file_name(parts).alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", "\r$", "").alias("value")) for found, parts in ((paths, False), (part_paths, True)) if found]
    raw = _fixed(functools.reduce(DataFrame.unionByName, scans))
    bare = F.replace(F.regexp_replace("value", "^\ufeff", ""), F.lit('""'), F.lit(""))
    quote = F.instr(bare, '"')
    # most lines have no quote at all
    none = ~F.contains("value", F.lit('"'))
    f0 = F.when(none, 0).otherwise(_opens(bare).cast("int"))
    f1 = F.when(none | (quote == 0), 1).otherwise(_opens(F.concat(F.lit("-"), F.substring(bare, quote + 1, F.length(bare)))).cast("int"))
    raw = raw.withColumns({"f0": f0, "f1": f1, "blank": F.col("value") == ""})
    maps = raw.select("file_name", "block", "length", "f0", "f1", "blank").mapInArrow(
        _range_maps, "file_name string, block long, length long, f0 int, f1 int, n0 long, n1 long")
    wb = Window.partitionBy("file_name").orderBy("block")
    swap = ((F.col("f0") == 1) & (F.col("f1") == 0)).cast("int")
    maps = maps.withColumn("__p", (F.sum(swap).over(wb.rowsBetween(Window.unboundedPreceding, 0)) % 2).cast("int"))
    blocks = maps.withColumn("s", _state_before(F.lit(0), F.col("f0") == F.col("f1"), F.col("f0"), swap, wb))
    blocks = blocks.withColumns({"begun": F.when(F.col("s") == 1, F.col("n1")).otherwise(F.col("n0")),
                                 "end": F.when(F.col("s") == 1, F.col("f1")).otherwise(F.col("f0"))})
    earlier = F.last(F.when(F.col("begun") > 0, F.struct(F.col("block").alias("block"), F.col("begun").alias("n"))), ignorenulls=True)
    blocks = blocks.withColumn("open", F.last("end").over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 1)
    blocks = checkpointed(blocks.select("file_name", "block", "length", "s", "end", "begun", "open", earlier.over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("held")))
    # a table of one row per range is broadcast: a file, and a set, is too much for one task
    known = blocks.select("file_name", "block", "length", "s", "open", F.col("held.block").alias("held_block"), F.col("held.n").alias("held_n"))
    d = raw.join(F.broadcast(known), ["file_name", "block", "length"], "left").where(~F.coalesce("open", F.lit(False)))
    d = d.select("file_name", "block", "line", "value", "f0", "f1", "blank", "s", "held_block", "held_n").mapInArrow(
        _range_records, "file_name string, block long, line long, n long, record string, key_block long, key_n long")
    return _plain(d), _plain(blocks)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records (file_name, block, line, n, record) of which several ranges hold a piece."""
    parts = pieces.groupBy("file_name", "key_block", "key_n").agg(F.array_sort(F.collect_list(F.struct("block", "line", "record"))).alias("l"))
    return parts.select("file_name", F.col("key_block").alias("block"), F.get("l", F.lit(0))["line"].alias("line"),
                        F.col("key_n").alias("n"), F.array_join(F.transform("l", lambda x: x["record"]), "\n").alias("record"))


def _state_before(start: Column, const: Column, after: Column, swap: Column, w) -> Column:
    """Prefix composition of maps of one bit (0: between records' fields, 1: inside a quoted field). A row's map is
    constant (`const`, to `after`), a swap or the identity; `start`: the bit before the window's first row."""
    swaps = F.sum(swap).over(w.rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(swaps, F.lit(0)) % 2
    # a constant row fixes the bit; seen through the swaps up to it, it acts like another start
    fixed = F.last(F.when(const, after.bitwiseXOR(F.col("__p"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(fixed, start).bitwiseXOR(before.cast("int"))


def csv_records(spark: SparkSession, paths: list[str], part_paths: list[str] = []) -> tuple[DataFrame, DataFrame]:
    """-> records(file_name, block, line, n, record) and open_files(file_name): a quoted field of the file never ends. `part_paths` are
    files too, but named with their folder.

    Files are read in byte ranges by as many tasks, whatever line feeds their quoted fields hold (`_ranges`). A record is named by the range, and
    its number there, in which it begins; only records that lie in several ranges are put together by a shuffle. `n` counts a range's records from
    1; blank lines between records are none."""
    d, blocks = _ranges(spark, paths, part_paths)
    one = d.where(F.col("key_block").isNull()).select("file_name", "block", "line", "n", "record")
    return one.unionByName(_joined(d.where(F.col("key_block").isNotNull()))), blocks.where("open").select("file_name").distinct()


def read_category_csvs(spark: SparkSession, directory: str, null_policy: str = "literal_nan",
                       with_rejects: bool = False):
    """-> clauses(category, clause_id, clause) [, rejects(file_name, reason)].

    clause_id = category rank (by name) * 2^32 + row position in the file, so ids follow
    (category, file order). Columns are bound by position, so repeated header names do no harm, and files of any headers are read in
    one scan. A short row is filled with nulls; a file with a row of too many fields, a quoted field that never ends, or no
    readable header is skipped and reported in `rejects`. A file is read in byte ranges by many tasks (`csv_records`)."""
    files = csv_files(spark, directory)
    found, paths, part_paths, rejected = [], [], [], []
    for name, members, parted in files:
        try:
            heads = [(path, _header(spark, path)) for path in members]
        except Exception as e:  # unreadable file: skip, keep going
            rejected.append((name, f"unreadable: {type(e).__name__}"))
            continue
        heads = [(path, h) for path, h in heads if h]
        if not heads:
            rejected.append((name, "empty file"))
            continue
        for k, (path, h) in enumerate(heads):
            file = f"{name}/{path.rsplit('/', 1)[1]}" if parted else name
            found.append((file, name, k, len(h), text_column(h)))
            (part_paths if parted else paths).append(path)
    if not found:
        empty = spark.createDataFrame([], "category string, clause_id long, clause string")
        rej = spark.createDataFrame(rejected, "file_name string, reason string")
        return (empty, rej) if with_rejects else empty
    d, blocks = _ranges(spark, paths, part_paths)
    headers = spark.createDataFrame(found, "file string, set_name string, part long, width int, at int")
    # one more column than the widest header has: a field beyond a file's own header makes the row, and the file, malformed
    widest = max(w for *_, w, _ in found)
    schema = ", ".join(f"_c{k} string" for k in range(widest + 1))
    fields = F.from_csv("record", F.lit(schema), {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    cells = F.array(*[F.col(f"__f._c{k}") for k in range(widest + 1)])

    def parsed(records: DataFrame) -> DataFrame:
        """(file_name, file, place, block, n, raw, bad) of the records that are no headers."""
        rows = records.where((F.col("block") > 0) | (F.col("n") > 1)).withColumnRenamed("file_name", "file").join(F.broadcast(headers), "file").withColumn("__f", fields)
        # a file is the whole set here, and the ranges of its parts follow each other
        place = (F.col("part") * PART_SPAN + F.col("block")).alias("place")
        return rows.select(F.col("set_name").alias("file_name"), "file", place, "block", "n", cells.alias("cells"), "width", "at").select(
            "file_name", "file", "place", "block", "n", F.get("cells", F.col("at")).alias("raw"),
            F.exists(F.slice("cells", F.col("width") + 1, F.lit(widest + 1)), lambda c: c.isNotNull()).alias("bad"))

    piece = F.col("key_block").isNotNull()
    whole = parsed(d.where(~piece).drop("line", "key_block", "key_n"))
    # what has to be known before the rows are given out is made once, in one scan: pieces of records, and which files are malformed; no other text is kept
    marked = d.withColumn("__piece", F.when(piece, F.col("record"))).withColumnRenamed("file_name", "file").join(F.broadcast(headers), "file").withColumn("__f", fields)
    beyond = F.exists(F.slice(cells, F.col("width") + 1, F.lit(widest + 1)), lambda c: c.isNotNull()) & ~piece & ((F.col("block") > 0) | (F.col("n") > 1))
    marked = checkpointed(marked.withColumn("bad", beyond).where(piece | F.col("bad")).select(F.col("file").alias("file_name"), "set_name", "block", "line", "key_block", "key_n", F.col("__piece").alias("record"), "bad"))
    several = checkpointed(parsed(_joined(marked.where(~F.col("bad")))))
    opened = blocks.where("open").withColumnRenamed("file_name", "file").join(F.broadcast(headers), "file").select(F.col("set_name").alias("file_name"))
    bad = marked.where("bad").select(F.col("set_name").alias("file_name")).union(several.where("bad").select("file_name")).union(opened).distinct()
    good = whole.unionByName(several).join(F.broadcast(bad), "file_name", "left_anti")
    category = F.regexp_replace("file_name", r"\.csv", "").alias("category")
    good = good.select("*", category)
    if null_policy == "literal_nan":
        raw = F.when(F.col("raw").isNull() | F.col("raw").isin(PANDAS_NA_STRINGS), F.lit("nan")).otherwise(F.col("raw"))
        good = good.withColumn("raw", raw)
        # row position inside the set: the rows of the ranges before, and the record's number in its own, less the header
        header = (F.col("block") == 0).cast("long")
        sizes = blocks.withColumnRenamed("file_name", "file").join(F.broadcast(headers), "file").select(
            F.col("set_name").alias("file_name"), "file", "part", "block", (F.col("begun") - F.least(header, "begun")).alias("rows"))
        ws = Window.partitionBy("file_name").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
        before = sizes.select("file", "block", "rows", "file_name", (F.coalesce(F.sum("rows").over(ws), F.lit(0)) - header).alias("__before"))
        pos = good.join(F.broadcast(before.select("file", "block", "__before")), ["file", "block"]).withColumn("__row", F.col("__before") + F.col("n"))
        some = before.where("rows > 0").join(F.broadcast(bad), "file_name", "left_anti").select(category)
    elif null_policy == "drop":
        good = good.where(F.col("raw").isNotNull() & ~F.col("raw").isin(PANDAS_NA_STRINGS))
        # which rows stay is only known from their texts
        pos = number_rows(good, [F.col("place"), F.col("n")], F.col("place"), ["file_name"], "__row")
        some = good.select("category")
    else:
        raise ValueError(null_policy)
    cats = some.distinct().withColumn("__crank", F.row_number().over(Window.orderBy("category")) - 1)
    out = pos.join(F.broadcast(cats), "category").select(
        "category", (F.shiftleft(F.col("__crank").cast("long"), 32) + F.col("__row") - 1).alias("clause_id"),
        clean_text("raw").alias("clause"))
    if not with_rejects:
        return out
    rej = spark.createDataFrame(rejected, "file_name string, reason string").unionByName(
        bad.select("file_name", F.lit("malformed rows").alias("reason")))
    return out, rej


def write_category_csvs(rows: DataFrame, directory: str, quote: bool = True, text_first: bool = True) -> None:
    """rows(category, ord, clause_text) -> one CSV file `<category>.csv` per category, rows in the order of `ord`;
    columns clause_text and clause_type, or, with `text_first=False`, Clause Type, place and Clause Body. `quote=False` writes
    texts as they are, whatever they hold.

    Rounds (`_rounds`) and tasks hold ranges of (category, ord), a task about `PART_BYTES` of text, so no task grows with a category: one that spans several ranges
    becomes a folder `<category>.csv` of part files in that order. Rows of one `ord` are told apart by their texts' hash."""
    spark, tmp = rows.sparkSession, f"{directory.rstrip('/')}/_parts"
    order = ["category", "ord", "__h"]
    d = rows.withColumn("__h", F.xxhash64("clause_text"))
    size, starts = _rounds(d, order)
    fs, p = _fs(spark, tmp)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    parts: dict[str, list[str]] = {}
    key = F.struct(*order)
    for k, (low, high) in enumerate(zip([None, *starts], [*starts, None])):
        own = d if low is None else d.where(key >= low)
        _write_parts(own if high is None else own.where(key < high), max(1, -(-size // PART_BYTES // (len(starts) + 1))), order, f"{tmp}/{k}", quote, text_first)
        # the texts that were dealt for this round leave the disk before the next step needs it
        released(spark)
        for name, folder in _list(spark, f"{tmp}/{k}", dirs=True):
            parts.setdefault(name, []).extend(file for part, file in _list(spark, folder) if part.startswith("part-"))
    for name, files in parts.items():
        target = f"{directory.rstrip('/')}/{unquote(name.split('=', 1)[1])}.csv"
        if len(files) == 1:
            fs.rename(path(files[0]), path(target))
            continue
        fs.mkdirs(path(target))
        for k, file in enumerate(files):
            fs.rename(path(file), path(f"{target}/part-{k:07d}-{file.rsplit('/part-', 1)[1]}"))
    fs.delete(p, True)


def _rounds(d: DataFrame, order: list[str]) -> tuple[int, list[Column]]:
    """(bytes of text, the keys that rounds of about as many bytes begin with, the first one aside). Only keys and sizes are shuffled. Texts are
    dealt in ROUNDS rounds, so that no more than a round's are on the disk besides the sets."""
    sizes = d.select(*order, (F.coalesce(F.octet_length("clause_text").cast("long"), F.lit(0)) + 64).alias("b"))
    size = sizes.agg(F.sum("b").alias("b")).first()["b"] or 0
    n = -(-size // PART_BYTES)
    if n < 2 * ROUNDS:
        return size, []
    cut = sizes.repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("k"), F.sum("b").alias("b"))
    cut = checkpointed(cut.withColumn("round", F.floor((F.sum("b").over(Window.orderBy("p")) - F.col("b")) * ROUNDS / size)))
    # the keys stay in Spark's types: a round begins with the least key of its first range
    starts = cut.groupBy("round").agg(F.min("k").alias("k")).where("round > 0")
    found = sorted(r["round"] for r in starts.select("round").collect())
    return size, [starts.where(F.col("round") == r).select("k").scalar() for r in found]


def _write_parts(rows: DataFrame, parts: int, order: list[str], folder: str, quote: bool, text_first: bool) -> None:
    kind = F.col("category").alias("clause_type")
    d = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    out = d.select("category", "clause_text", kind) if quote else d.select("category", F.concat_ws(",", "clause_text", "category").alias("clause_text,clause_type"))
    if not text_first:
        out = d.select("category", kind.alias("Clause Type"), F.col("ord").alias("place"), F.col("clause_text").alias("Clause Body"))
    w = out.write.mode("overwrite").partitionBy("category").option("header", True).option("escape", '"')
    w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (w if quote else w.option("quote", "\u0000")).csv(folder)
