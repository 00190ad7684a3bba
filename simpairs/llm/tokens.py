"""Token ids of whole texts under a byte-level BPE file, with a cache of word encodings per worker."""
from __future__ import annotations

import json
import re

# a text is cut at single blanks and line feeds with no white space beside them; the file's word
# pattern never puts such a place inside a token, so the parts can be encoded one by one
_ODD = re.compile(r"\s\s|^\s|\s$|[^\S \n]")
_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: the same fixed word pattern as in the file (its "ByteLevel" step)
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: bytes of cached words and ids (with what the objects take) per cache; a worker has two
CACHED_BYTES = 24 << 20
ENTRY_BYTES = 200


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, lead: str, encode):
        super().__init__()
        self.lead, self.encode, self.left = lead, encode, CACHED_BYTES

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(self.lead + word)
        size = ENTRY_BYTES + len(word) + len(ids)
        if size <= self.left:
            self.left -= size
            self[word] = ids
        return ids


class ByteBpe:
    """`ids(text)`: little-endian unsigned 32-bit ids, as bytes. Equal to the ids that the tokenizers library
    gives for the file; texts that hold a special token's string are handed to that library itself."""

    def __init__(self, path: str):
        import numpy as np
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        back = byte_alphabet()
        ranks = {bytes(back[c] for c in word): n for word, n in spec["model"]["vocab"].items() if word not in self.special}
        fast = tiktoken.Encoding("file", pat_str=_WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self._whole = path, None
        self._pack = lambda ids: np.asarray(ids, "<u4").tobytes()
        self._encode = lambda text: self._pack(fast.encode_ordinary(text))
        self._first, self._next = _Cache("", self._encode), _Cache(" ", self._encode)
        self._feed = self._encode("\n")

    @property
    def whole(self):
        """The library's own tokenizer, loaded only if a text needs it."""
        if self._whole is None:
            from tokenizers import Tokenizer
            self._whole = Tokenizer.from_file(self.path)
        return self._whole

    def _line(self, parts: list[str]) -> bytes:
        return self._first[parts[0]] + b"".join(map(self._next.__getitem__, parts[1:])) if parts[0] else b""

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._pack(self.whole.encode(text, add_special_tokens=False).ids)
        if _ODD.search(text):
            return self._line(_SINGLE_BLANK.split(text))
        return self._feed.join(self._line(line.split(" ")) for line in text.split("\n"))


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One tokenizer per worker process and file."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
