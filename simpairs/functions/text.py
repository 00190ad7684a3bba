"""Text cleaning and tokenisation as built-in Column expressions (JVM side, codegen).

The character classes are spelled out instead of Java's `\\s` / `\\w`, whose ASCII-only
meaning differs from Python's Unicode-aware `re` semantics that define the expected output.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These character classes reproduce Python `re` Unicode semantics.
# whitespace run: \t \n \v \f \r, \x1c-\x1f, space, NEL, and every Unicode separator (Z*)
WHITESPACE_RUN = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
# everything that is not a word char (letter, number, underscore), a space, or . , ; : ( ) [ ] { }
DISALLOWED_CHAR = r"[^\p{L}\p{N}_ .,;:()\[\]{}]"
# a text of characters that `functions.cut` cleans by table; texts with others are cleaned here
WITHIN_TABLE = r"\A[\x00-\u0239]*\z"
#: column of texts whose words `functions.cut` cuts, see `draft_text`
DRAFT = "draft"
ELLIPSIS_LIMIT = 150
PAD, UNK, START, END = "<PAD>", "<UNK>", "<START>", "<END>"
RESERVED_TOKENS = [(PAD, 0), (UNK, 1), (START, 2), (END, 3)]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_to_nan(c) -> Column:
    """A missing cell is read as the literal string 'nan' (pandas astype(str) behaviour)."""
    return F.coalesce(_col(c), F.lit("nan"))


def clean_text(c) -> Column:
    """lower -> collapse whitespace runs -> drop disallowed chars -> trim, in this order."""
    x = F.lower(_col(c))
    x = F.regexp_replace(x, WHITESPACE_RUN, " ")
    x = F.regexp_replace(x, DISALLOWED_CHAR + "+", "")
    return F.trim(x)


def draft_text(c) -> Column:
    """The text as it is if `functions.cut` has all its characters in its table, else cleaned: either way the words that `cut_words` cuts
    from it are those of `tokenize(clean_text(c))`."""
    x = _col(c)
    return F.when(x.rlike(WITHIN_TABLE), x).otherwise(clean_text(x))


def tokenize(c) -> Column:
    """Whitespace tokens, no empty tokens (empty text -> empty array)."""
    return F.array_remove(F.split(_col(c), " "), "")


def ellipsis(c, limit: int = ELLIPSIS_LIMIT) -> Column:
    """Texts longer than `limit` code points become their first `limit` chars + '...'."""
    x = _col(c)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit("..."))).otherwise(x)


def decode_label(c) -> Column:
    return F.when(_col(c) == 1, F.lit("Similar")).otherwise(F.lit("Different"))
