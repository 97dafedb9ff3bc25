"""Signature trees over token sets: nodes hold the OR of their members' bitmaps and the range of their sizes.

A set's bitmap has a bit for each hashed token. A bit of A that B lacks stands for a token that B lacks, so
|A & B| <= |A| - popcount(bits(A) & ~bits(B)); for nodes, |A & B| <= max(|A| - popcount(A)) + popcount(OR_1 & OR_2).
The dual traversal descends from a pair of roots and leaves a pair of nodes when its sizes are too far apart, when
that greatest possible overlap is below what the threshold needs, or when all their members are linked already.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF = 16
MIN_BITS, MAX_BITS = 64, 4096


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """uint64 words of a bitmap of two to four bits a token (at most MAX_BITS, so a bound only gets looser)."""
    bits = 1 << max(2 * len(tokens) - 1, 1).bit_length()
    bits = min(max(bits, MIN_BITS), MAX_BITS)
    out = np.zeros(bits, np.uint8)
    out[(tokens >> np.uint64(17)).astype(np.int64) & (bits - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The same set's bitmap with fewer words."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def needed(t: int, sizes):
    """Least overlap of two sets of these sizes together with 100 * overlap >= t * union."""
    return -(-t * sizes // (100 + t))


class SignatureTree:
    """Binary tree over ``members`` (indices into n and bits), leaves of LEAF members next to each other by size."""

    def __init__(self, members: np.ndarray, n: np.ndarray, bits: np.ndarray):
        """bits: a row for each of members."""
        order = np.lexsort((bits[:, 0], n[members]))
        self.members, self.bits = members[order], bits[order]
        size = n[self.members]
        excess = size - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        cut = np.arange(0, len(members), LEAF)
        level = {"or": np.bitwise_or.reduceat(self.bits, cut), "lo": np.minimum.reduceat(size, cut), "hi": np.maximum.reduceat(size, cut),
                 "excess": np.maximum.reduceat(excess, cut), "from": cut, "to": np.append(cut[1:], len(members))}
        self.levels = [level]
        while len(level["lo"]) > 1:
            cut = np.arange(0, len(level["lo"]), 2)
            level = {"or": np.bitwise_or.reduceat(level["or"], cut), "lo": np.minimum.reduceat(level["lo"], cut), "hi": np.maximum.reduceat(level["hi"], cut),
                     "excess": np.maximum.reduceat(level["excess"], cut), "from": level["from"][cut], "to": np.maximum.reduceat(level["to"], cut)}
            self.levels.append(level)

    def children(self, node: tuple[int, int]) -> list[tuple[int, int]]:
        level, i = node
        return [(level - 1, j) for j in (2 * i, 2 * i + 1) if j < len(self.levels[level - 1]["lo"])]


class Links:
    """Links found so far among members 0..m-1, as labels of their components."""

    def __init__(self, m: int):
        self.label = np.arange(m)
        self.edges: list[tuple[int, int]] = []

    def add(self, a: int, b: int) -> None:
        old, new = sorted((self.label[a], self.label[b]), reverse=True)
        self.label[self.label == old] = new
        self.edges.append((a, b))


def traverse(one: SignatureTree, two: SignatureTree, n: np.ndarray, t: int, links: Links, accept: Callable[[int, int], bool] | None) -> None:
    """Links what ``accept`` accepts (None: everything) among pairs that may reach t, over different components only."""
    same = one is two
    stack = [((len(one.levels) - 1, 0), (len(two.levels) - 1, 0))]
    while stack:
        x, y = stack.pop()
        a, b = one.levels[x[0]], two.levels[y[0]]
        i, j = x[1], y[1]
        if 100 * a["hi"][i] < t * b["lo"][j] or 100 * b["hi"][j] < t * a["lo"][i]:
            continue
        most = min(a["excess"][i], b["excess"][j]) + int(np.bitwise_count(a["or"][i] & b["or"][j]).sum())
        if most < needed(t, a["lo"][i] + b["lo"][j]):
            continue
        ma, mb = one.members[a["from"][i]:a["to"][i]], two.members[b["from"][j]:b["to"][j]]
        la, lb = links.label[ma], links.label[mb]
        if (la == la[0]).all() and (lb == la[0]).all():
            continue
        if x[0] or y[0]:
            if x[0] >= y[0]:
                pairs = [(c, y) for c in one.children(x)]
            else:
                pairs = [(x, c) for c in two.children(y)]
            if same and x == y:
                cs = one.children(x)
                pairs = [(c, d) for k, c in enumerate(cs) for d in cs[k:]]
            stack.extend(pairs)
            continue
        ba, bb = one.bits[a["from"][i]:a["to"][i], None, :], two.bits[None, b["from"][j]:b["to"][j], :]
        na, nb = n[ma][:, None], n[mb][None, :]
        both = np.minimum(na - np.bitwise_count(ba & ~bb).sum(axis=2, dtype=np.int64), nb - np.bitwise_count(bb & ~ba).sum(axis=2, dtype=np.int64))
        may = (both >= needed(t, na + nb)) & (la[:, None] != lb[None, :])
        if same and x == y:
            may = np.triu(may, 1)
        for p, q in zip(*np.nonzero(may)):
            u, v = int(ma[p]), int(mb[q])
            if links.label[u] != links.label[v] and (accept is None or accept(u, v)):
                links.add(u, v)


def link_group(n: np.ndarray, bits: list[np.ndarray], t: int, accept=None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of a group; with ``side`` (0/1), only pairs of different sides count.

    Sets are taken by bitmap length; as sizes of linked sets differ by less than t < 50 % would allow, only classes
    whose sizes can reach t meet, with the longer bitmaps folded to the shorter."""
    links = Links(len(n))
    width = np.array([len(b) for b in bits])
    classes = [np.flatnonzero((width == w) & ((side == s) if side is not None else True)) for w in np.unique(width) for s in ((0, 1) if side is not None else (0,))]
    kinds = [s for _ in np.unique(width) for s in ((0, 1) if side is not None else (0,))]
    trees: dict[tuple[int, int], SignatureTree] = {}

    def tree(c: int, words: int) -> SignatureTree:
        if (c, words) not in trees:
            trees[c, words] = SignatureTree(classes[c], n, np.stack([fold(bits[m], words) for m in classes[c]]))
        return trees[c, words]

    for c, mc in enumerate(classes):
        for d in range(c, len(classes)):
            md = classes[d]
            if not len(mc) or not len(md) or (side is not None and kinds[c] == kinds[d]) or 100 * n[mc].max() < t * n[md].min() or 100 * n[md].max() < t * n[mc].min():
                continue
            words = min(width[mc[0]], width[md[0]])
            traverse(tree(c, words), tree(d, words), n, t, links, accept)
    return links.edges
