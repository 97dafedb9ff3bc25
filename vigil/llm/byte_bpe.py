"""Byte-level BPE ids of many texts, each distinct pre-token encoded once.

The pre-tokens of the byte-level pattern (contractions, an optional space before letters, numbers or others, and runs
of white space) are found in numpy over the texts' bytes: a pre-token starts where the character class changes, one
byte earlier if a space stands before, and so on. Only distinct pre-tokens reach the merge loop. Texts with
characters outside U+0000-U+017F, with the controls 0x1C-0x1F, or with the string of a special token are encoded by
the tokenizer itself. Both give the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` (tested).
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pandas as pd

from .common import WordHasher

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: Distinct pre-tokens kept between batches; beyond, they are encoded anew.
KEPT = 400_000


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Classes of the bytes below 0x80, and of U+0080-U+017F by code point - 0x80."""
    import regex

    def kind(c: int) -> int:
        if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
            return SPACE
        if regex.match(r"\p{L}", chr(c)):
            return LETTER
        return NUMBER if regex.match(r"\p{N}", chr(c)) else OTHER

    return np.array([kind(c) for c in range(0x80)] + [0] * 0x80, np.uint8), np.array([kind(c) for c in range(0x80, 0x180)], np.uint8)


class ByteBPE:
    """``file``: the text of a tokenizers JSON file with byte-level BPE. Made inside a task."""

    def __init__(self, file: str):
        import tiktoken

        spec = json.loads(file)
        self.file, self.slow = file, None
        self.special = [x["content"] for x in spec["added_tokens"]]
        # the byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(names[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        for i, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if ranks[bytes(names[c] for c in a + b)] != 256 + i:
                raise ValueError("ids that do not follow the merges")
        self.single = tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.low, self.high = _classes()
        self.hasher = WordHasher(lower=False)
        self.keys, self.spots = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        self.pool, self.used = np.zeros(1 << 20, np.int32), 0

    def _simple(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which texts the fast way covers."""
        bad = np.flatnonzero((data > 0xC5) | (data == 0xC0) | (data == 0xC1) | ((data >= 0x1C) & (data <= 0x1F)))
        ok = np.ones(len(bounds) - 1, bool)
        ok[np.searchsorted(bounds, bad, "right") - 1] = False
        for s in self.special:
            at, raw = data.tobytes(), s.encode()
            p = at.find(raw)
            while p >= 0:
                ok[np.searchsorted(bounds, p, "right") - 1] = False
                p = at.find(raw, p + 1)
        return ok

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        kind = self.low[data]
        lead = np.flatnonzero(data >= 0xC2)
        lead = lead[lead + 1 < len(data)]
        two = self.high[np.minimum((data[lead].astype(np.int64) - 0xC2) * 64 + (data[lead + 1] & 0x3F), 255)]
        kind[lead] = kind[lead + 1] = two
        n = len(data)
        edge = np.zeros(n + 1, bool)  # first bytes of texts
        edge[bounds] = True
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        change |= edge[:n]
        white = kind == SPACE
        after_space = np.zeros(n, bool)
        after_space[1:] = data[:-1] == 0x20
        after_space &= ~edge[:n]
        start = change & (white | ~after_space)
        # the last character of white space that something follows: it goes with what follows, or stands alone
        first = np.flatnonzero(change & ~white & ~edge[:n])
        last = first[white[first - 1]] - 1
        last -= (data[last] & 0xC0) == 0x80
        start[last] = True
        mark = np.flatnonzero((data == 0x27) & change & ~after_space)
        mark = mark[mark + 1 < n]
        mark = mark[~edge[mark + 1]]
        if len(mark):
            one = np.isin(data[mark + 1], np.frombuffer(b"stmd", np.uint8))
            third = np.minimum(mark + 2, n - 1)
            inside = (mark + 2 < n) & ~edge[third]
            x, y = data[mark + 1], data[third]
            pair = inside & (((x == 114) & (y == 101)) | ((x == 118) & (y == 101)) | ((x == 108) & (y == 108)))
            for at, size in ((mark[one], 2), (mark[pair], 3)):
                start[at + 1] = False
                follow = at + size
                follow = follow[follow < n]
                start[follow[(kind[follow] == LETTER) & ~edge[follow]]] = True
        return np.flatnonzero(start)

    def _slowly(self, text: bytes) -> np.ndarray:
        from tokenizers import Tokenizer

        self.slow = self.slow or Tokenizer.from_str(self.file)
        return np.array(self.slow.encode(text.decode(), add_special_tokens=False).ids, np.int32)

    def _pieces(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, length) of each pre-token's ids."""
        h = self.hasher
        h._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(h.table[data] * h.power[:len(data)], out=total[1:])
        name = (total[e] - total[s]) * h.inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        back, keys = pd.factorize(name)
        at = np.empty(len(keys), np.int64)
        at[back[::-1]] = np.arange(len(back) - 1, -1, -1)
        if len(self.keys) > KEPT:
            self.keys, self.spots, self.used = self.keys[:0], self.spots[:0], 0
        near = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        known[near < len(self.keys)] = self.keys[near[near < len(self.keys)]] == keys[near < len(self.keys)]
        spots = np.empty((len(keys), 2), np.int64)
        spots[known] = self.spots[near[known]]
        new = np.flatnonzero(~known)
        raw, places = data.tobytes(), at[new]
        ids = list(map(self.single, [raw[a:b] for a, b in zip(s[places].tolist(), e[places].tolist())]))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        stop = self.used + int(size.sum())
        if stop > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), stop), np.int32)])
        self.pool[self.used:stop] = np.fromiter(chain.from_iterable(ids), np.int32, stop - self.used)
        spots[new, 0], spots[new, 1] = self.used + np.cumsum(size) - size, size
        self.used = stop
        keys = np.concatenate([self.keys, keys[new]])
        order = np.argsort(keys, kind="stable")
        self.keys, self.spots = keys[order], np.concatenate([self.spots, spots[new]])[order]
        return spots[back, 0], spots[back, 1]

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """ids of each text (data[bounds[i]:bounds[i + 1]])."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * (len(bounds) - 1)
        if not len(data):
            return out
        simple = self._simple(data, bounds)
        for i in np.flatnonzero(~simple):
            out[i] = self._slowly(data[bounds[i]:bounds[i + 1]].tobytes())
        s = self._starts(data, bounds)
        e = np.append(s[1:], len(data))
        text = np.searchsorted(bounds, s, "right") - 1
        use = simple[text]
        s, e, text = s[use], e[use], text[use]
        at, size = self._pieces(data, s, e)
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        counts = np.bincount(text, weights=size, minlength=len(out)).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum(counts)])
        for i in np.flatnonzero(simple):
            out[i] = ids[cut[i]:cut[i + 1]]
        return out
