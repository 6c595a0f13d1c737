"""Cutting texts into the pieces within which byte-level BPE merges.

The pieces are those of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Texts of ASCII and Latin letters are cut with array operations on their bytes;
any other text goes through the pattern itself. A special token's string in a
text is a piece of its own, as the tokenizer library takes it by default.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from .common import blocks, span_hashes, worker_state

_U = np.uint64
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ship_vocabulary(spark: SparkSession, path: str | None) -> Broadcast:
    """The vocabulary file (a few MB, fixed) as a broadcast value: executors need no copy of it."""
    return spark.sparkContext.broadcast(Path(path or default_vocabulary()).read_bytes())


class Vocabulary:
    """Token ids by their bytes, merges by their pair of ids, and the special strings."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        ids = model["vocab"]
        self.id_of = {bytes(byte_of[c] for c in t): i for t, i in ids.items() if t.encode() not in self.special}
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (left id << 32 | right id) -> rank, and rank -> id of the merged token
        self.rank_of = {ids[a] << 32 | ids[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]


def vocabulary(raw: bytes) -> Vocabulary:
    return worker_state(f"vocabulary_{zlib.crc32(raw):08x}", lambda: Vocabulary(raw))


def _classes() -> np.ndarray:
    lut = np.full(256, OTHER, np.uint8)
    lut[[*range(65, 91), *range(97, 123)]] = LETTER
    lut[48:58] = NUMBER
    lut[[9, 10, 11, 12, 13, 32]] = SPACE
    lut[0x80:0xCA] = LETTER  # bytes of U+00C0 to U+024F, all letters but two
    return lut


def latin_classes(data: np.ndarray) -> np.ndarray:
    """The class of every byte of texts of ASCII and Latin letters."""
    kind = _classes()[data]
    signs = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[signs] = OTHER
    kind[signs + 1] = OTHER
    return kind


def _plain_pieces(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of all pieces of texts that need no pattern."""
    n = len(data)
    kind = latin_classes(data)
    run = np.ones(n + 1, bool)  # starts of runs of one class; the end counts as one
    run[1:n] = kind[1:] != kind[:-1]
    run[offs] = True
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    piece = run.copy()
    # white space before a word: its last character goes with the word if it is a blank, else stands alone
    last = np.flatnonzero((kind == SPACE) & run[1:] & ~edge[1:])
    piece[last] = True
    piece[last[data[last] == 0x20] + 1] = False
    # contractions: an apostrophe that begins a piece, alone in its run, and the letters after it
    quote = np.flatnonzero((data == 0x27) & piece[:n] & run[1:] & ~edge[1:])
    if len(quote):
        quote = quote[quote + 1 < n]
        c1 = data[quote + 1]
        room = (quote + 2 < n) & ~edge[np.minimum(quote + 2, n)]
        c2 = np.where(room, data[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(c1, np.frombuffer(b"stmd", np.uint8))
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) \
            | ((c1 == ord("l")) & (c2 == ord("l")))
        piece[quote[one | two] + 1] = False
        piece[quote[one] + 2] = True
        piece[quote[two] + 3] = True
    return np.flatnonzero(piece[:n])


def _pattern_pieces(text: str, special: list[str]) -> np.ndarray:
    """Starts of the pieces of any text (in bytes)."""
    regex = worker_state("piece_pattern", _compiled)
    parts = [text]
    for token in special:
        parts = [x for p in parts for x in _split_keep(p, token)] if token in text else parts
    lengths = [len(x.encode()) for p in parts for x in ([p] if p in special else regex.findall(p))]
    return np.cumsum([0, *lengths])[:-1] if lengths else np.zeros(0, np.int64)


def _compiled():
    import regex

    return regex.compile(PATTERN)


def _split_keep(text: str, token: str) -> list[str]:
    out: list[str] = []
    for k, part in enumerate(text.split(token)):
        out += ([token] if k else []) + ([part] if part else [])
    return out


def piece_blocks(data: np.ndarray, offs: np.ndarray, tokens: dict[bytes, int]) -> Iterator[
        tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole texts: (first row, end row, bytes, piece starts, piece ends, first piece of each text). ``tokens``:
    the special strings that are pieces of their own."""
    special = [t.decode() for t in tokens]
    for i, j, d, o in blocks(data, offs):
        odd = np.unique(np.searchsorted(o, np.flatnonzero((d == 0xC2) | (d >= 0xCA)), "right") - 1)
        raw = d.tobytes()
        if any(t in raw for t in tokens):
            odd = np.union1d(odd, [k for k in range(j - i) if any(t in raw[o[k]:o[k + 1]] for t in tokens)])
        if not len(odd):
            s = _plain_pieces(d, o) if len(d) else np.zeros(0, np.int64)
        else:
            flags = np.zeros(j - i, bool)
            flags[odd.astype(np.int64)] = True
            cuts = np.flatnonzero(np.diff(flags)) + 1
            parts = []
            for a, b in zip([0, *cuts], [*cuts, j - i], strict=True):
                if flags[a]:
                    parts += [o[k] + _pattern_pieces(raw[o[k]:o[k + 1]].decode(), special) for k in range(a, b)]
                elif o[b] > o[a]:
                    parts.append(o[a] + _plain_pieces(d[o[a]:o[b]], o[a:b + 1] - o[a]))
            s = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        first = np.searchsorted(s, o)
        e = np.append(s[1:], len(d)) if len(s) else s
        yield i, j, d, s, e, first


class PieceCache:
    """A table of a fixed size: what was computed for a piece, by its hash.

    A piece has two slots. It takes the first if that is free, else the second,
    from which it may drive another piece; that costs time only.
    """

    def __init__(self, bits: int, compute: Callable[[list[bytes]], list[int]]):
        self.bits, self.compute = bits, compute
        self.keys, self.values = np.zeros(1 << bits, _U), np.zeros(1 << bits, np.int64)

    def lookup(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        h = span_hashes(data, s, e)
        slot = (h >> _U(64 - self.bits)).astype(np.int64)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != h)
        if len(miss):
            other = (h[miss] & _U((1 << self.bits) - 1)).astype(np.int64)
            out[miss] = self.values[other]
            gone = self.keys[other] != h[miss]
            miss, other = miss[gone], other[gone]
        if len(miss):
            new, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
            place, at = other[at], miss[at]
            raw = data.tobytes()
            found = np.array(self.compute([raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)]),
                             np.int64)
            out[miss] = found[back]
            place = np.where(self.keys[slot[at]] == 0, slot[at], place)
            self.keys[place], self.values[place] = new, found
        return out
