"""Byte-pair encoding in linear time.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary finds the longest token
at any place. A sequence of tokens is what the merges give exactly if each two neighbours are compatible (joined, they
would be split the same way again); so the longest tokens are taken, and where a neighbour doesn't fit, the encoder
backtracks to the next shorter token. Whether two tokens fit is found by undoing their merges at the seam, and kept.
"""

from __future__ import annotations

import importlib
import json
import re
from itertools import chain

import ahocorasick
import numpy as np
import regex

#: Sizes at which the two caches start anew; they hold no results that can't be made again.
PIECES_KEPT, PAIRS_KEPT, LONGEST_KEPT = 200_000, 500_000, 48
_NEVER = 1 << 30
#: The split of the byte-level vocabularies, and the same for texts of ASCII alone (other order, same matches).
COMMON_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_SPLIT = r" ?[A-Za-z]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"


def vocabulary_path(name: str = "byte_bpe_50k.json", package: str = "public_tokenizers") -> str:
    """Where a public tokenizer's file lies on this machine."""
    return importlib.import_module(package).path(name)


def split_pattern(package: str = "public_tokenizers") -> str:
    return importlib.import_module(package).PATTERN


def _byte_letters() -> dict[str, str]:
    """The letters in which byte-level vocabularies write bytes, to Latin-1: visible bytes as themselves, the rest from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): chr(b) for b in visible} | {chr(256 + i): chr(b) for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str | None = None, pattern: str | None = None):
        with open(path or vocabulary_path(), encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = str.maketrans(_byte_letters())
        vocab = {t.translate(letters): i for t, i in model["vocab"].items() if all(ord(c) < 512 for c in t)}
        size = max(vocab.values()) + 1
        self.left, self.right, self.length, self.shorter = list(range(size)), list(range(size)), [0] * size, [-1] * size
        self.pair: dict[int, int] = {}
        self.is_byte = [True] * size
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = a.translate(letters), b.translate(letters)
            i, left, right = vocab[a + b], vocab[a], vocab[b]
            self.left[i], self.right[i], self.is_byte[i] = left, right, False
            self.pair[left << 20 | right] = i
        tokens = {t: i for t, i in vocab.items() if len(t) == 1 or not self.is_byte[i]}  # special tokens are no tokens of texts
        self.automaton = ahocorasick.Automaton()
        for t, i in tokens.items():
            self.length[i] = len(t)
            self.automaton.add_word(t, i)
            self.shorter[i] = next((tokens[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in tokens), -1)
        self.automaton.make_automaton()
        pattern = pattern or split_pattern()
        self.split_any = regex.compile(pattern).findall
        self.split_ascii = re.compile(ASCII_SPLIT).findall if pattern == COMMON_SPLIT else self.split_any
        self.fits: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side when their bytes are encoded together."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is not None:
            return known
        if len(self.fits) >= PAIRS_KEPT:
            self.fits.clear()
        pair, left, right, is_byte = self.pair, self.left, self.right, self.is_byte
        bound = _NEVER  # merges made from here on can't happen across the seam any more
        while True:
            if pair.get(a << 20 | b, _NEVER) < bound:
                fit = False
                break
            if a > b:  # the token made last is undone first; of equal merges the left one is made first
                if is_byte[a]:
                    fit = True
                    break
                bound, a = a, right[a]
            else:
                if is_byte[b]:
                    fit = True
                    break
                bound, b = b + 1, left[b]
        self.fits[key] = fit
        return fit

    def _backtrack(self, s: str, tokens: list[int], at: int, token: int) -> list[int]:
        """Go on from compatible ``tokens`` that end at ``at``, where ``token`` is the longest."""
        iter_long, length, shorter, compatible, known = self.automaton.iter_long, self.length, self.shorter, self.compatible, self.fits.get
        size = len(s)
        dead = set()  # places from which nothing fits: no token may end there
        last = tokens[-1] if tokens else -1
        while True:
            end = at + length[token]
            if end not in dead:
                fit = True if last < 0 else known(last << 20 | token)
                if fit is None:
                    fit = compatible(last, token)
                if fit:
                    tokens.append(token)
                    if end == size:
                        return tokens
                    at, last = end, token
                    for _, token in iter_long(s, at):
                        break
                    continue
            token = shorter[token]
            if token < 0:
                dead.add(at)
                token = tokens.pop()
                last = tokens[-1] if tokens else -1
                at -= length[token]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        s = piece.encode("utf-8", "replace").decode("latin-1")
        known, compatible = self.fits.get, self.compatible
        tokens, last, end = [], -1, -1
        for stop, t in self.automaton.iter_long(s):
            if last >= 0:
                fit = known(last << 20 | t)
                if fit is None:
                    fit = compatible(last, t)
                if not fit:
                    return tuple(self._backtrack(s, tokens, end + 1, t))
            tokens.append(t)
            last, end = t, stop
        return tuple(tokens)

    def _split(self, text: str) -> list[str]:
        return self.split_ascii(text) if text.isascii() else self.split_any(text)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a text; none for null and empty ones."""
        if not text:
            return np.zeros(0, np.int32)
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, self._split(text))), np.int32)

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.pieces.__getitem__, self._split(text)))) if text else 0


class _Pieces(dict):
    """Token ids of pieces seen before."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encoder.encode_piece(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = ids
        return ids


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder a process and vocabulary."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]
