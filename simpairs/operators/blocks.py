"""Array columns coded in blocks: a block of rows carries a dictionary of its own and whole numbers in place of values.

Word counts and lookups then handle one row per distinct value of a block (about `BLOCK_VALUES` array elements), not one per
distinct value of a text, and texts travel as numbers. Blocks are cut from Arrow batches inside the tasks; Spark
deals the texts, aggregates the counts and joins the dictionaries.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simpairs.functions.cut import char_tables, cut_words, head, word_names
from simpairs.functions.text import DRAFT, tokenize
from simpairs.operators.lookup import lookup
from simpairs.sources.shared import by_value, checkpointed

#: array elements of a block, unless one row alone holds more
BLOCK_VALUES = 1 << 21
#: bytes of a block of texts, unless one row alone holds more
BLOCK_BYTES = 1 << 24
#: the same where a block's dictionary does not leave its task: small enough to stay in a core's cache
SET_BYTES = 1 << 20


def words_of(df: DataFrame, text_col: str = "clause") -> Column:
    """What the functions here take as a row's words: its draft (see `draft_text`), whose words are cut in the tasks, where `df` has
    one, else the tokens of its clean text."""
    return F.col(DRAFT) if DRAFT in df.columns else tokenize(text_col)


def _element(df: DataFrame, values: Column) -> str:
    """Type of the elements of an array column; those of a draft are words."""
    kind = df.select(values.alias("v")).schema["v"].dataType
    return kind.elementType.simpleString() if isinstance(kind, T.ArrayType) else "string"


def _text_blocks(batch, column: str, tables, first: int | None, most: int) -> Iterator:
    """Blocks of at most `most` bytes of drafts, one row at least, with their words (the first ones) in place of them."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        rows, at = batch.slice(at, to - at), to
        words = cut_words(rows.column(column), tables)
        words = words if first is None else head(words, first)
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays([words if c == column else rows.column(c) for c in rows.schema.names], rows.schema.names), sizes


def _blocks(batches, column: str, first: int | None = None, most: int | None = None) -> Iterator:
    """(rows, their array sizes) of blocks of at most BLOCK_VALUES elements, one row at least. Null arrays count as empty. Drafts
    become arrays of words, the `first` ones of each, in blocks of at most `most` bytes (BLOCK_BYTES)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    tables = char_tables()
    for batch in batches:
        if pa.types.is_string(batch.column(column).type):
            yield from _text_blocks(batch, column, tables, first, most or BLOCK_BYTES)
            continue
        sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + BLOCK_VALUES
            to = max(at + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(at, to - at), sizes[at:to]
            at = to


def _firsts(key, bound: int):
    """(distinct keys, ascending, place of the first one, count) of whole numbers from 0 to below `bound`."""
    import numpy as np
    if bound > 8 * len(key) + 1024:
        return np.unique(key, return_index=True, return_counts=True)
    # a table of all keys is small beside them: no sort
    count = np.bincount(key, minlength=bound)
    found = np.flatnonzero(count)
    place = np.empty(bound, np.int64)
    # assigned from the end, so that the first place stays
    place[key[::-1]] = np.arange(len(key) - 1, -1, -1)
    return found, place[found], count[found]


def _one(values):
    """A list array of one row that holds `values`."""
    import pyarrow as pa
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(numbers) -> bytes:
    """Whole numbers from 0 on: the bytes that the largest one needs, plane by plane, compressed."""
    import numpy as np
    import pyarrow as pa
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes):
    import numpy as np
    import pyarrow as pa
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], n * width, codec="zstd", asbytes=True), np.uint8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = planes.reshape(width, n).T
    return wide.view("<i8").reshape(n)


def _stored(values) -> bytes:
    """An Arrow array in a compressed stream of its own."""
    import pyarrow as pa
    sink, batch = pa.BufferOutputStream(), pa.RecordBatch.from_arrays([values], ["v"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _restored(data: bytes):
    import pyarrow as pa
    with pa.ipc.open_stream(data) as held:
        return held.read_next_batch().column("v")


def value_counts(df: DataFrame, values: Column, group: str, order: str, value: str = "value") -> DataFrame:
    """(`value`, `group`, cnt, `order`, pos): per block, distinct value and group its number of occurrences, and the first one's
    `order` and 0-based position by (`order`, position), nulls last. To be aggregated further."""
    by_value()
    kind = {f.name: f.dataType.simpleString() for f in df.select(group, order).schema} | {"__v": _element(df, values)}

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for rows, _ in _blocks(batches, "v"):
            rows = rows.take(pc.sort_indices(rows.column("o"), null_placement="at_end"))
            sizes = pc.fill_null(pc.list_value_length(rows.column("v")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            coded, groups = rows.column("v").flatten().dictionary_encode(), rows.column("g").dictionary_encode(null_encoding="encode")
            n = max(1, len(coded.dictionary))
            key = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * n + coded.indices.to_numpy(zero_copy_only=False)
            key, first, count = _firsts(key, n * max(1, len(groups.dictionary)))
            at = row[first]
            found = pa.StructArray.from_arrays(
                [coded.dictionary.take(pa.array(key % n)), groups.dictionary.take(pa.array(key // n)), pa.array(count, pa.int64()),
                 rows.column("o").take(pa.array(at)), pa.array(first - (np.cumsum(sizes) - sizes)[at], pa.int32())], ["v", "g", "n", "o", "p"])
            yield pa.RecordBatch.from_arrays([_one(found)], ["e"])

    d = df.select(F.col(group).alias("g"), F.col(order).alias("o"), values.alias("v"))
    e = d.mapInArrow(run, f"e array<struct<v:{kind['__v']},g:{kind[group]},n:bigint,o:{kind[order]},p:int>>").select(F.explode("e").alias("e"))
    return e.select(F.col("e.v").alias(value), F.col("e.g").alias(group), F.col("e.n").alias("cnt"), F.col("e.o").alias(order), F.col("e.p").alias("pos"))


def word_sets(df: DataFrame, key: str, values: Column, out: str) -> DataFrame:
    """(`key`, `out` ARRAY<BIGINT>), one row per row: 64-bit names (`cut.word_names`) of a row's distinct words, in place of the words. Of n
    distinct words of over eight bytes in all rows about n^2 / 2^65 pairs share a name."""
    by_value()
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for rows, sizes in _blocks(batches, "v", most=SET_BYTES):
            lists = rows.column("v")
            coded = lists.flatten().dictionary_encode()
            names = word_names(coded.dictionary)
            n = max(1, len(names))
            own = np.sort(np.repeat(np.arange(len(sizes)), sizes) * n + coded.indices.to_numpy(zero_copy_only=False))
            own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
            ends = np.searchsorted(own, np.arange(len(sizes) + 1) * n).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(names[own % n]), mask=lists.is_null() if lists.null_count else None)
            yield pa.RecordBatch.from_arrays([rows.column("k"), sets], [key, out])

    return df.select(F.col(key).alias("k"), values.alias("v")).mapInArrow(run, f"`{key}` {kind}, `{out}` array<bigint>")


def mapped(df: DataFrame, key: str, values: Column, table: DataFrame, table_key: str, out: str, default=None, first: int | None = None) -> DataFrame:
    """(`key`, `out`), one row per key: the array with each element replaced by the value that `table`(table_key, one more column)
    has for it, else by `default`; without a default it is left out. `values` may be drafts, of whose words the `first` count.

    A block's distinct values are looked up once (`lookup`), and the answers are joined to the block's coded rows, which travel and are
    kept as packed bytes. The arrays of rows that share a key are merged by (position, value)."""
    by_value()
    kinds = {"k": df.schema[key].dataType.simpleString(), "v": _element(df, values)}
    answer = next(c for c in table.columns if c != table_key)
    kind = table.schema[answer].dataType.simpleString()

    def code(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        for n, (rows, sizes) in enumerate(_blocks(batches, "v", first)):
            coded = rows.column("v").flatten().dictionary_encode()
            # 0 is a missing element
            codes = coded.indices.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 32) + n], pa.int64()), _one(rows.column("k")),
                 *[pa.array([x], pa.binary()) for x in (_packed(sizes), _packed(codes), _stored(coded.dictionary))]], ["block", "keys", "sizes", "codes", "entries"])

    def listed(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for block, held in zip(batch.column("block").to_pylist(), batch.column("entries")):
                values = _restored(held.as_py())
                e = pa.StructArray.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), values], ["at", "value"])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), _one(e)], ["block", "e"])

    def decoder(whole: bool):
        def decode(batches):
            import numpy as np
            import pyarrow as pa
            for batch in batches:
                for i in range(batch.num_rows):
                    b = batch.slice(i, 1)
                    at, v = b.column("m").flatten().flatten()
                    place = np.empty(len(at), np.int64)
                    place[at.to_numpy()] = np.arange(len(at))
                    codes = _unpacked(b.column("codes")[0].as_py()) - 1
                    missing = codes < 0
                    v = v.take(pa.array(place[np.maximum(codes, 0)] if len(at) else np.zeros(len(codes), np.int64), mask=missing))
                    ends = np.concatenate([[0], np.cumsum(_unpacked(b.column("sizes")[0].as_py()))])
                    if default is not None:
                        v = v.fill_null(default)
                    elif not whole:
                        ends = np.concatenate([[0], np.cumsum(v.is_valid().to_numpy(zero_copy_only=False))])[ends]
                        v = v.drop_null()
                    yield pa.RecordBatch.from_arrays([b.column("keys").flatten(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), v)], ["k", "v"])
        return decode

    coded = checkpointed(df.select(F.col(key).alias("k"), values.alias("v")).mapInArrow(
        code, f"block long, keys array<{kinds['k']}>, sizes binary, codes binary, entries binary"))
    rows = coded.select("block", "entries").mapInArrow(listed, f"block long, e array<struct<at:int,value:{kinds['v']}>>")
    rows = rows.select("block", F.explode("e").alias("e")).select("block", "e.at", "e.value")
    found = lookup(rows, "value", table.select(F.col(table_key).alias("__key"), F.col(answer).alias("__answer")), "__key")
    found = found.groupBy("block").agg(F.collect_list(F.struct("at", F.col("__answer").alias("v"))).alias("m"))
    whole = coded.select("block", "keys", "sizes", "codes").join(found, "block", "left").select("keys", "sizes", "codes", "m")
    fields = f"k {kinds['k']}, v array<{kind}>"
    again = checkpointed(coded.select(F.explode("keys").alias("r")).groupBy("r").count().where("count > 1").select("r"))
    once = whole.mapInArrow(decoder(False), fields)
    if again.isEmpty():
        return once.select(F.col("k").alias(key), F.col("v").alias(out))
    once = once.join(again, F.col("k").eqNullSafe(F.col("r")), "left_anti")
    several = whole.mapInArrow(decoder(True), fields).join(again, F.col("k").eqNullSafe(F.col("r")), "left_semi")
    placed = F.filter(F.transform("v", lambda x, p: F.struct(p.alias("p"), x.alias("v"))), lambda x: x["v"].isNotNull())
    merged = several.groupBy("k").agg(F.sort_array(F.flatten(F.collect_list(placed))).alias("s")).select("k", F.transform("s", lambda x: x["v"]).alias("v"))
    return once.unionByName(merged).select(F.col("k").alias(key), F.col("v").alias(out))


def id_sets(df: DataFrame, key: str, ids: Column) -> DataFrame:
    """Blocks of rows with the distinct ids of each, missing ones left out, made once: (keys, pairs, ids). `ids` holds the distinct ids of a block
    in ascending order, `pairs` the places in it that a row uses, as row * number of ids + place, ascending (both as packed steps)."""
    by_value()
    kind = df.schema[key].dataType.simpleString()

    def code(batches):
        import numpy as np
        import pyarrow as pa
        for rows, sizes in _blocks(batches, "v"):
            flat = rows.column("v").flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            found, place = np.unique(flat.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
            pairs = np.unique(np.repeat(np.arange(len(sizes)), sizes)[known] * max(1, len(found)) + place)
            yield pa.RecordBatch.from_arrays(
                [_one(rows.column("k")), pa.array([_packed(np.diff(pairs, prepend=0))], pa.binary()), pa.array([int(found[0]) if len(found) else 0], pa.int64()),
                 pa.array([_packed(np.diff(found, prepend=found[:1]))], pa.binary())], ["keys", "pairs", "first", "ids"])

    return checkpointed(df.select(F.col(key).alias("k"), ids.alias("v")).mapInArrow(code, f"keys array<{kind}>, pairs binary, first long, ids binary"))


def _sets(batches) -> Iterator:
    """(keys, rows, places, ids) of the blocks of `id_sets`: the place in `ids` of each (row, id)."""
    import numpy as np
    for batch in batches:
        for i in range(batch.num_rows):
            b = batch.slice(i, 1)
            ids = np.cumsum(_unpacked(b.column("ids")[0].as_py())) + b.column("first")[0].as_py()
            pairs = np.cumsum(_unpacked(b.column("pairs")[0].as_py()))
            yield b.column("keys").flatten(), pairs // max(1, len(ids)), pairs % max(1, len(ids)), ids


def id_counts(sets: DataFrame) -> DataFrame:
    """(id, rows): the ids of `id_sets` and the number of rows that hold each."""
    by_value()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for _, _, places, ids in _sets(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.bincount(places, minlength=len(ids)).astype(np.int64))], ["id", "n"])

    return sets.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("rows"))


def pooled_sets(sets: DataFrame, key: str, kind: str, sent) -> DataFrame:
    """(`key`, vector, rest): per row of `id_sets` the element-wise maximum over the vectors of its ids in `sent`, null without such an id, and its
    other ids. `sent`: a broadcast (ids ascending, vectors as one row per dimension) without NaN."""
    by_value()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        known, vectors = sent.value
        for keys, rows, places, ids in _sets(batches):
            at = np.minimum(np.searchsorted(known, ids), max(0, len(known) - 1))
            hit = (known[at] == ids if len(known) else np.zeros(len(ids), bool))[places]
            row, at = rows[hit], at[places[hit]]
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            best = np.empty((len(starts), len(vectors)))
            for d in range(len(vectors)):
                best[:, d] = np.maximum.reduceat(vectors[d][at], starts) if len(starts) else 0.0
            filled = np.zeros(len(keys), np.int64)
            filled[row[starts]] = len(vectors)
            pooled = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(filled)]), pa.int32()), pa.array(best.ravel()), mask=pa.array(filled == 0))
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[~hit], np.arange(len(keys) + 1)), pa.int32()), pa.array(ids[places[~hit]]))
            yield pa.RecordBatch.from_arrays([keys, pooled, rest], [key, "vector", "rest"])

    return sets.mapInArrow(run, f"`{key}` {kind}, vector array<double>, rest array<long>")
