"""Exact token ids of whole texts from a ``tokenizers`` file, memoised per chunk.

``ChunkEncoder`` gives the same ids as ``Tokenizer.encode(text,
add_special_tokens=False)``. It reads the tokenizer's own description and
splits texts only where its pre-tokenizer can never look across:

- white space dropped by the pre-tokenizer: cut at ASCII space and line feed,
  and around a comma or full stop that no other mark touches, unless a special
  string occurs in any case (the library finds it before it lowers the text) or
  the one letter does whose lower case ends in a mark (U+0130);
- byte-level with a space carried by the next word: cut before each space and
  around each line feed, unless two white-space characters meet or a special string occurs;
- anything else: the whole text goes to the library.

A chunk that was seen before costs one dictionary look-up. New chunks of Latin
letters followed by punctuation are one or two pre-tokens, so the library's
BPE model is asked directly; every other chunk goes through the library whole.
Memory is bounded: each dictionary keeps two generations of a fixed size.
"""

from __future__ import annotations

import json
import os
import re
import struct

#: Entries of one generation of a dictionary in a Python worker (about 50 MB); the second dictionary, of
#: pre-tokens, holds a quarter of it.
MEMO = 250_000

#: Fixed: Latin letters (without U+0130, whose lower case is two characters) and ASCII punctuation that
#: starts neither a contraction (') nor a special string (<).
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: Fixed: characters that are white space to Python and marks to the library.
CONTROLS = "\x1c\x1d\x1e\x1f"
PUNCTUATION = r"""!"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"""


class _Memo(dict):
    """``make(key)`` by key, in two generations of at most ``most`` entries each: what was used lately stays."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ChunkEncoder:
    """Little-endian unsigned 32-bit ids of texts, as ``bytes``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark owns the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.special = [t["content"] for t in said.get("added_tokens") or []]
        self._special_lower = [s.lower() for s in self.special]
        self.mode = _mode(said)
        self.model = self.tokenizer.model
        self.lower = self.mode == "words"
        stand_in = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        #: how the library writes a space and the letters above ASCII byte by byte
        self._chars = {c: "".join(p for p, _ in stand_in(chr(c))) for c in (0x20, *range(0xC0, 0x250))}
        self._pieces = _Memo(self._piece, MEMO // 4)
        self._chunks = _Memo(self._chunk, MEMO)
        self._lower_word = re.compile("[a-zß-öø-ÿ]+" if self.lower else "(?!)").fullmatch
        space = " ?" if self.mode == "byte_level" else ""
        self._simple = re.compile(f"({space}[{LETTERS}]+)([{PUNCTUATION}]*)").fullmatch
        self._two_spaces = re.compile(r"\s\s").search
        self._run = re.compile(r"[.,](?<=[^\w\s].) ").search

    def encode(self, text: str | None) -> bytes:
        """Ids of one text; null counts as empty."""
        return b"".join(self._parts(text))

    def count(self, text: str | None) -> int:
        """Number of ids of one text."""
        return sum(map(len, self._parts(text))) // 4

    def _parts(self, text: str | None):
        if not text:
            return ()
        if self.mode == "words":
            lower = text.lower()
            if "\u0130" in text or any(s in lower for s in self._special_lower):
                return (self._library(text),)
            if "\u03a3" not in text:
                text = lower     # the library lowers character by character; sigma differs
            text = text.replace("\n", " ")
            # no comma or full stop belongs to a run of marks; some marks are letters or white space to Python
            if not (self._run(text) or "_, " in text or "_. " in text or any(c in text for c in CONTROLS)):
                text = text.replace(", ", " , ").replace(". ", " . ")
            return map(self._chunks.__getitem__, text.split(" "))
        if self.mode == "byte_level" and not self._two_spaces(text) and not any(s in text for s in self.special):
            # no white space meets white space: a line feed is a pre-token of its own
            chunks = []
            for i, line in enumerate(text.split("\n")):
                first, *rest = line.split(" ")
                chunks += ["\n", first] if i else [first]
                chunks += [" " + c for c in rest]
            return map(self._chunks.__getitem__, chunks)
        return (self._library(text),)

    def _chunk(self, chunk: str) -> bytes:
        if self.lower and chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self._piece(chunk)
        if self._lower_word(chunk):
            return self._piece(chunk)
        if m := self._simple(chunk):
            word, marks = m.groups()
            word = word.lower() if self.lower else word
            return self._pieces[word] + self._pieces[marks] if marks else self._pieces[word]
        return self._library(chunk)

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, from the BPE model itself."""
        mapped = piece if piece.isascii() and piece[0] != " " else piece.translate(self._chars)
        found = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(found)}I", *found)

    def _library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(found)}I", *found)


def _mode(said: dict) -> str:
    """How texts may be cut, from the tokenizer file's own description."""
    if said["model"].get("type") != "BPE" or said["model"].get("dropout") or any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
            for t in said.get("added_tokens") or []):
        return "whole"
    before, norm = said.get("pre_tokenizer") or {}, said.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not norm:
        return "byte_level"
    steps = before.get("pretokenizers") or []
    drops = (len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("invert")
             and steps[0].get("behavior") == "Removed"
             and steps[0]["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
             and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex")
             and not steps[1].get("add_prefix_space"))
    plain = [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    return "words" if drops and plain else "whole"


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This Python worker's encoder for a tokenizer file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; operators take any path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
