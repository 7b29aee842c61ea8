"""Exact and fast use of a ``tokenizers`` JSON file: pre-tokens and ids are looked up, not recomputed.

A pre-token's pieces do not depend on its neighbours, and the split pattern never looks across white space. So the
pieces of each distinct word are computed once by the library itself and then looked up.

Texts made only of common Latin characters (``_PLAIN``) take that path. All other texts, and texts that may hold a
special token's string, go whole through the library's own normalizer, splitter or encoder. Both paths give the
library's ids (tests compare every plain code point and random texts).

That holds for files with the normalizer and splitter that are stated below, which is looked up in the file. Of a plain
byte-level file the pre-tokens come from the library's own splitter, and texts are encoded by the library. Any other
file's texts go whole through the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from itertools import repeat

import numpy as np

from duotower.llm.common import tokenizer_file

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark runs the tasks side by side already

# Characters whose normal form, lower case and class are the same in Python and in the library.
_RANGES = ((0x09, 0x0D), (0x20, 0x7E), (0xA1, 0x12F), (0x131, 0x17F), (0x2010, 0x2027), (0x2030, 0x205E))
_CHARS = [chr(c) for lo, hi in _RANGES for c in range(lo, hi + 1)]
_PLAIN = re.compile("[" + "".join(f"{re.escape(chr(lo))}-{re.escape(chr(hi))}" for lo, hi in _RANGES) + r"]*\Z")
_LETTERS = re.escape("".join(c for c in _CHARS if unicodedata.category(c)[0] == "L"))
_DIGITS = re.escape("".join(c for c in _CHARS if unicodedata.category(c)[0] == "N"))
_PRETOKEN = re.compile(rf"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTERS}{_DIGITS}]+")

_SLICE = 200_000        # characters that are looked up at a time

# The byte-level alphabet: printable Latin-1 bytes stand for themselves, all others for characters from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(0x100) if b not in _PRINTABLE)}


# What a file must state for its words to be looked up (fixed values of the file format).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPLITTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
                                                   {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_BYTE_SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

WORDS, BYTES, WHOLE = "words", "bytes", "whole"


def file_kind(spec: dict) -> str:
    """How a tokenizer file can be used: by looked-up words, by byte-level pre-tokens, or by whole texts only."""
    model, added = spec["model"], spec["added_tokens"]
    if model["type"] != "BPE" or model.get("dropout") or any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        return WHOLE
    if spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _SPLITTER and all(t["content"].startswith("<|") for t in added):
        return WORDS
    return BYTES if spec["normalizer"] is None and spec["pre_tokenizer"] == _BYTE_SPLITTER else WHOLE


def plain(text: str) -> bool:
    return "<|" not in text and _PLAIN.match(text) is not None


class WordBpe:
    """Pre-tokens, piece counts and ids of one tokenizer file; ``cache_words`` bounds the lookup table."""

    def __init__(self, file: str, cache_words: int = 700_000):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(tokenizer_file(file))
        spec = json.loads(self.tok.to_str())
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kind = file_kind(spec)
        self.splitter = pre_tokenizers.Split(Regex(_PATTERN), "removed", invert=True)
        special = [re.escape(c) for c in sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)]
        self.special = re.compile("|".join(special)) if special else None
        self.cache_words = cache_words
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used, self.chars = 0, 0
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many tokens it has beside their pieces: special ones, or all of a whole text's."""
        if self.kind == WHOLE:
            return [], len(self.tok.encode(text, add_special_tokens=False).ids)
        if self.kind == WORDS and plain(text):
            return _PRETOKEN.findall(text.lower()), 0
        parts = self.special.split(text) if self.special else [text]
        out = []
        for part in parts:
            if part and self.kind == BYTES:
                out += [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(part)]
            elif part:
                out += [p for p, _ in self.splitter.pre_tokenize_str(self.tok.normalizer.normalize_str(part))]
        return out, len(parts) - 1

    def piece_counts(self, pretokens: list[str]) -> list[int]:
        pieces = self.tok.model.tokenize
        if self.kind == BYTES:
            return [len(pieces(p)) for p in pretokens]
        return [len(pieces(p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_CHARS))) if plain(p)
                else len(self.tok.encode(p, add_special_tokens=False).ids) for p in pretokens]

    def _learn(self, words: list[str]) -> None:
        """Add lower-cased plain words: the ids of their pre-tokens, by the library's merges."""
        pieces, ids, sizes = self.tok.model.tokenize, [], []
        for word in words:
            before = len(ids)
            for p in _PRETOKEN.findall(word):
                ids += [t.id for t in pieces(p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_CHARS))]
            sizes.append(len(ids) - before)
        k, n = len(self.index), len(words)
        while k + n > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.size[k:k + n] = sizes
        self.start[k:k + n] = self.used + np.cumsum(sizes) - sizes
        self.index.update(zip(words, range(k, k + n)))
        self.used += len(ids)
        self.chars += sum(map(len, words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one uint32 array, and the number of ids of each text."""
        flats, lengths, at = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        while at < len(texts):      # few words at a time stay in the processor's cache
            upto, size = at, 0
            while upto < len(texts) and (size < _SLICE or upto == at):
                size += len(texts[upto])
                upto += 1
            flat, n = self._encode(texts[at:upto])
            flats.append(flat)
            lengths.append(n)
            at = upto
        return np.concatenate(flats), np.concatenate(lengths)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > self.cache_words or self.chars > 64 << 20:
            self._clear()
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)     # words of each plain text
        whole: dict[int, list[int]] = {}            # ids of the texts that went through the library
        for i, text in enumerate(texts):
            if self.kind == WORDS and plain(text):
                own = text.lower().split()
                counts[i] = len(own)
                words += own
            else:
                whole[i] = self.tok.encode(text, add_special_tokens=False).ids
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            self._learn(list(dict.fromkeys(new)))
            at[missing] = [self.index[w] for w in new]
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(self.start[at] - ends[:-1], size) + np.arange(ends[-1])]
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(bounds)
        if whole:
            pieces = [np.asarray(whole[i], np.uint32) if i in whole else flat[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
            lengths = np.array([len(p) for p in pieces], np.int64)
            flat = np.concatenate(pieces)
        return flat, lengths


_LOADED: dict[str, WordBpe] = {}


def word_bpe(file: str) -> WordBpe:
    """The tokenizer of this Python worker (loaded once, reused by later tasks)."""
    if file not in _LOADED:
        _LOADED[file] = WordBpe(file)
    return _LOADED[file]
