"""Words of whole Arrow columns of texts: cleaning and cutting by tables of characters, for use inside tasks.

The rules are those of `functions.text.clean_text` and `tokenize`. Characters up to U+0239 are changed by table (ASCII bytes, and the
two bytes of the others); `draft_text` has cleaned every text that holds another one, and cleaning again changes nothing.
"""
from __future__ import annotations

LAST = 0x239
#: stands for no byte; UTF-8 does not use it
GONE = 0xFF


def char_tables():
    """(by byte, by two-byte character from U+0080 on): the bytes that a character is cleaned to."""
    import unicodedata

    import numpy as np
    one, two = np.arange(256, dtype=np.uint8), np.full((7 << 6, 2), GONE, np.uint8)
    for c in range(0x240):
        low = chr(c).lower() if c <= LAST else chr(c)
        if 9 <= c <= 13 or 0x1C <= c <= 0x20 or c == 0x85 or unicodedata.category(low[0])[0] == "Z":
            low = " "
        kept = "".join(x for x in low if unicodedata.category(x)[0] in "LN" or x in "_ .,;:()[]{}").encode()
        if c < 0x80:
            one[c] = kept[0] if kept else GONE
        else:
            two[c - 0x80, :len(kept)] = list(kept)
    return one, two


def cut_words(texts, tables):
    """Arrow texts -> lists of their words; null stays null. A text's bytes are changed and dropped in one pass (`bytes.translate`), and
    blanks between the texts let one pass over all of them find the words."""
    import numpy as np
    import pyarrow as pa
    one, two = tables
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0]:ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = (ends - ends[0]).tolist()
    lead = np.flatnonzero(data - np.uint8(0xC2) <= 6)
    if len(lead):
        changed = two[((data[lead].astype(np.int64) - 0xC2) << 6) | (data[lead + 1] & 0x3F)]
        data = data.copy()
        data[lead], data[lead + 1] = changed[:, 0], changed[:, 1]
    # what the characters of two bytes became is not changed again
    raw, table, gone = data.tobytes(), one.tobytes(), np.flatnonzero(one == GONE).astype(np.uint8).tobytes()
    clean = [raw[a:b].translate(table, gone) for a, b in zip(ends, ends[1:])]
    out = np.frombuffer(b" ".join([b"", *clean, b""]), np.uint8)
    ink = out != 32
    # the first and the last byte are blanks: a word's edges follow each other
    edges = np.flatnonzero(ink[1:] != ink[:-1]) + 1
    starts = edges[::2]
    at = np.concatenate([[0], np.cumsum(edges[1::2] - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(out[ink]))
    texts_at = np.cumsum([1, *(len(x) + 1 for x in clean)])
    lists = pa.array(np.searchsorted(starts, texts_at).astype(np.int32))
    return pa.ListArray.from_arrays(lists, words, mask=texts.is_null() if texts.null_count else None)


def head(lists, n: int):
    """The first `n` elements of each list."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ends = np.concatenate([[0], np.cumsum(np.minimum(sizes, n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), lists.flatten().filter(pa.array(place < n)))


def word_names(words):
    """64-bit names of Arrow words: eight bytes at a time are mixed in by invertible steps, after the length, so words of one length up to
    eight bytes never share a name."""
    import numpy as np

    def mix(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    left, at = np.diff(at), at[:-1]
    held = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] is not None else np.zeros(0, np.uint8)
    eight = np.ndarray(len(held) + 1, "<u8", np.concatenate([held, np.zeros(8, np.uint8)]), strides=(1,))
    used = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    names = mix(np.arange(left.max(initial=0) + 1, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))[left]
    live = np.flatnonzero(left > 0)
    left, at = left[live], at[live]
    while len(live):
        names[live] = mix(names[live] ^ (eight[at] & used[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        live, left, at = live[more], left[more] - 8, at[more] + 8
    return names.view(np.int64)
