"""Subword encoding of white-space pieces, each distinct piece encoded once per worker.

A byte-level BPE never merges across a single space that stands between two
characters that are not white space, so a text may be cut there, and the ids
of its pieces, each with its leading space, are the ids of the whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from .common import cached_by

#: A space at which a text may be cut.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters on whose classes all Unicode versions agree.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
#: Fixed value: the split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cut(text: str) -> list[str]:
    """Pieces of text; all but the first begin with the space before them."""
    parts = CUT.split(text)
    return parts[:1] + [" " + p for p in parts[1:]]


def _bytes_of_symbols() -> dict[str, int]:
    """The printable symbol that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _quick(path: str):
    """A faster encoder with the same ids, if the file is a plain byte-level BPE whose ids follow its merges; else None."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    model, pre = j["model"], j.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or j.get("normalizer") or model.get("dropout") or model.get("ignore_merges") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    import tiktoken

    symbols, added = _bytes_of_symbols(), {t["content"] for t in j.get("added_tokens", [])}
    ranks = {bytes(symbols[c] for c in t): n for t, n in model["vocab"].items() if t not in added}
    return tiktoken.Encoding(f"pieces:{path}", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class _Held(dict):
    """Result by piece; made when first asked for, kept while there is room, if the piece is short."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, piece):
        got = self.make(piece)
        if len(self) < self.most and len(piece) <= 64:
            self[piece] = got
        return got


class PieceEncoder:
    """Ids of whole texts as little-endian uint32 bytes, as the tokenizers library gives them for the file at path."""

    _made: dict[str, "PieceEncoder"] = {}

    def __init__(self, path: str, most: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = _quick(path)
        self.later = _Held(lambda p: None if not p or p[0].isspace() or p[-1].isspace() else self.ids(" " + p), most)

    @classmethod
    def of(cls, path: str) -> "PieceEncoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _encode(self, text: str) -> list[int]:
        if self.quick and PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return self.quick.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def count(self, text: str) -> int:
        return len(self._encode(text))

    def encode(self, text: str) -> bytes:
        """Ids of the whole text."""
        first, *rest = text.split(" ")
        if not rest:
            return self.ids(first)
        found = list(map(self.later.__getitem__, rest))
        if None in found or not first or first[-1].isspace():
            return b"".join([self.ids(p) for p in cut(text)])
        found.insert(0, self.ids(first))
        return b"".join(found)


cached_by("pieces", PieceEncoder._made.clear)
