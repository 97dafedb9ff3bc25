"""Lattices of subword pieces over many words at once, on tries.

Words go into a byte trie, so that what they begin with in common is worked out once. From every trie node all
vocabulary pieces are matched downwards in step (one numpy operation per byte of a piece, for all nodes together).
The matches are arcs (from node, to node, piece); an arc into a node starts at one of its ancestors, so segmentations
of the word that ends at a node are the arc paths from the root to it, and forward scores, marginals, expected counts
and samples are sums over arcs by the depth of their first node.

Pieces stand for bytes; the vocabulary's mark for a space stands for a space. A byte piece may only complete a
character that is no piece itself (byte fallback).
"""

from __future__ import annotations

import numpy as np

SPACE_MARK = "▁"
#: Words are put into tries by width class (bytes); longer ones alone, so a trie's table stays small.
WIDTHS = (16, 32, 128, 1024)


class Vocabulary:
    """Pieces of a SentencePiece model file as bytes, with log weights from its scores.

    A merge vocabulary's scores are ranks (0, -1, -2, ...), not probabilities; by Zipf's law weight 1 / (1 + rank) is
    taken, and byte pieces count as the last rank. Scores of a unigram vocabulary are log probabilities already.
    """

    def __init__(self, path: str | None = None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kind = [(sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i), sp.is_byte(i)) for i in range(n)]
        self.pieces = [b"" if off else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if byte else sp.id_to_piece(i).replace(SPACE_MARK, " ").encode()
                       for i, (off, byte) in enumerate(kind)]
        self.byte_ids = np.zeros(256, np.int64)
        self.is_byte = np.array([byte for _, byte in kind])
        for i in np.flatnonzero(self.is_byte):
            self.byte_ids[self.pieces[i][0]] = i
        usable = np.array([not off for off, _ in kind])
        score = np.array([sp.get_score(i) for i in range(n)])
        plain = usable & ~self.is_byte
        if score[plain & (score > -1e8)].min() < -100:
            logp = -np.log1p(np.maximum(-score, 0))
        else:
            logp = score.copy()
        logp[self.is_byte] = logp[plain & (score > -1e8)].min()
        logp[~usable] = -np.inf
        self.logp = logp - np.log(np.exp(logp).sum())
        self.plain = np.flatnonzero(plain)


class WordTrie:
    """Byte trie of distinct ``words``; node 0 is the root, ``ends[i]`` the node of word i."""

    def __init__(self, words: list[bytes]):
        size = np.array([len(w) for w in words], np.int64)
        width = max(int(size.max()), 1) if len(words) else 1
        table = np.array(words, dtype=f"S{width}") if len(words) else np.zeros(0, f"S{width}")
        order = np.argsort(size, kind="stable")
        order = order[np.argsort(table[order], kind="stable")]
        size = size[order]
        m = table[order].view(np.uint8).reshape(len(words), width)
        diff = m[1:] != m[:-1]
        lcp = np.where(diff.any(axis=1), diff.argmax(axis=1), width) if len(words) else np.zeros(0, np.int64)
        lcp = np.concatenate([[0], np.minimum(lcp, np.minimum(size[1:], size[:-1]))]) if len(words) else lcp
        fresh = size - lcp
        base = 1 + np.cumsum(fresh) - fresh
        n = 1 + int(fresh.sum())
        self.parent, self.byte, self.depth = np.zeros(n, np.int64), np.zeros(n, np.uint8), np.zeros(n, np.int64)
        self.ends = np.zeros(len(words), np.int64)
        before = np.zeros(len(words), np.int64)
        for d in range(1, int(size.max()) + 1 if len(words) else 1):
            new = np.flatnonzero((lcp < d) & (d <= size))
            node = base[new] + d - 1 - lcp[new]
            self.depth[node], self.byte[node] = d, m[new, d - 1]
            self.parent[node] = np.where(lcp[new] == d - 1, before[new], node - 1)
            path = np.zeros(len(words), np.int64)
            path[new] = node
            before = np.maximum.accumulate(path)
            here = np.flatnonzero(size == d)
            self.ends[order[here]] = before[here]
        self.children = np.argsort(self.parent[1:], kind="stable") + 1
        self.first = np.searchsorted(self.parent[self.children], np.arange(n + 1))

    def __len__(self) -> int:
        return len(self.parent)


class PieceTrie:
    """The vocabulary's trie as an open hash table of (node, byte) -> node; made inside a task from its pieces."""

    def __init__(self, vocabulary: Vocabulary):
        plain = vocabulary.plain
        trie = WordTrie([vocabulary.pieces[i] for i in plain])
        self.piece = np.full(len(trie), -1, np.int64)
        self.piece[trie.ends] = plain
        self.byte_ids = vocabulary.byte_ids
        keys = trie.parent[1:] << 8 | trie.byte[1:]
        self.bits = (4 * len(keys)).bit_length()
        self.key, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        left, value, slot = keys, np.arange(1, len(trie)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.key[slot] < 0)
            self.key[slot[free]] = left[free]
            done = self.key[slot] == left
            self.to[slot[done]] = value[done]
            left, value, slot = left[~done], value[~done], (slot[~done] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes reached; 0 where nothing goes on."""
        keys = nodes << 8 | byte
        slot = self._slot(keys)
        held = self.key[slot]
        out = np.where(held == keys, self.to[slot], 0)
        at = np.flatnonzero((held != keys) & (held >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & ((1 << self.bits) - 1)
            held = self.key[slot[at]]
            hit = held == keys[at]
            out[at[hit]] = self.to[slot[at[hit]]]
            at = at[~hit & (held >= 0)]
        return out


class Lattice:
    """All arcs over the words of one trie."""

    def __init__(self, words: list[bytes], pieces: PieceTrie):
        self.trie = t = WordTrie(words)
        n = len(t)
        start = np.arange(n)
        now, state = start, np.zeros(n, np.int64)
        us, vs, ps = [], [], []
        while len(start):
            count = t.first[now + 1] - t.first[now]
            ends = np.cumsum(count)
            total = int(ends[-1])
            child = t.children[np.repeat(t.first[now] - (ends - count), count) + np.arange(total)]
            start, state = np.repeat(start, count), pieces.step(np.repeat(state, count), t.byte[child])
            live = state > 0
            start, now, state = start[live], child[live], state[live]
            piece = pieces.piece[state]
            hit = piece >= 0
            us.append(start[hit])
            vs.append(now[hit])
            ps.append(piece[hit])
        u, v, p = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs, ps))
        # byte fallback: into every node but the ends of characters that are pieces
        by_depth = np.argsort(t.depth, kind="stable")
        cut = np.searchsorted(t.depth[by_depth], np.arange(int(t.depth.max()) + 2 if n else 1))
        opens = np.zeros(n, np.int64)
        for a, b in zip(cut[1:-1], cut[2:]):
            nodes = by_depth[a:b]
            opens[nodes] = np.where((t.byte[nodes] & 0xC0) == 0x80, opens[t.parent[nodes]], t.parent[nodes])
        known = np.zeros(n, bool)
        known[v[u == opens[v]]] = True
        more = t.depth - t.depth[opens]  # bytes of the character so far
        lead_end = np.ones(n, np.int64)
        lead = t.byte.copy()
        for a, b in zip(cut[1:-1], cut[2:]):
            nodes = by_depth[a:b]
            lead[nodes] = np.where((t.byte[nodes] & 0xC0) == 0x80, lead[t.parent[nodes]], t.byte[nodes])
        lead_end[lead >= 0xC0], lead_end[lead >= 0xE0], lead_end[lead >= 0xF0] = 2, 3, 4
        known &= more == lead_end
        into = np.flatnonzero(~known)
        into = into[into > 0]
        u, v, p = np.concatenate([u, t.parent[into]]), np.concatenate([v, into]), np.concatenate([p, pieces.byte_ids[t.byte[into]]])
        order = np.lexsort((v, t.depth[u]))
        self.u, self.v, self.piece = u[order], v[order], p[order]
        self.cut = np.searchsorted(t.depth[self.u], np.arange(int(t.depth.max()) + 1 if n else 0))
        self.cut = np.append(self.cut, len(self.u))

    def forward(self, logp: np.ndarray, best: bool = False) -> np.ndarray:
        """Log of the summed (or the best) weight of the segmentations up to each node."""
        f = np.full(len(self.trie), -np.inf)
        f[0] = 0
        w = logp[self.piece]
        plus = np.maximum if best else np.logaddexp
        for a, b in zip(self.cut[:-1], self.cut[1:]):
            # arcs from one depth into one node: a piece and perhaps a byte piece, next to each other
            v, x = self.v[a:b], f[self.u[a:b]] + w[a:b]
            twice = np.zeros(len(v), bool)
            twice[1:] = v[1:] == v[:-1]
            for part in (~twice, twice):
                f[v[part]] = plus(f[v[part]], x[part])
        return f

    def expected(self, logp: np.ndarray, f: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of each piece when word i occurs counts[i] times: sums over arcs of the forward weight before
        them and the outside weight after them, which adds up over all words that go on from there."""
        t, ends = self.trie, self.trie.ends
        out = np.full(len(t), -np.inf)
        with np.errstate(divide="ignore"):
            np.logaddexp.at(out, ends, np.log(counts) - f[ends])
        w = logp[self.piece]
        for a, b in zip(self.cut[-2::-1], self.cut[:0:-1]):
            if b > a:
                x = w[a:b] + out[self.v[a:b]]
                order = np.argsort(self.u[a:b], kind="stable")
                u = self.u[a:b][order]
                first = np.flatnonzero(np.diff(u, prepend=-1))
                top = np.maximum.reduceat(x[order], first)
                safe = np.where(np.isfinite(top), top, 0)
                with np.errstate(divide="ignore"):
                    total = safe + np.log(np.add.reduceat(np.exp(x[order] - np.repeat(safe, np.diff(np.append(first, len(u))))), first))
                out[u[first]] = np.logaddexp(out[u[first]], total)
        return np.bincount(self.piece, weights=np.exp(f[self.u] + w + out[self.v]), minlength=size)


def lattices(words: list[bytes], pieces: PieceTrie, limit: int = 1 << 22):
    """(indices, lattice) for all words, by width class."""
    size = np.array([len(w) for w in words], np.int64)
    low = 0
    for width in WIDTHS:
        at = np.flatnonzero((size >= low) & (size <= width))
        low = width + 1
        step = max(1, limit // width)
        for i in range(0, len(at), step):
            part = at[i:i + step]
            yield part, Lattice([words[k] for k in part], pieces)
    for k in np.flatnonzero(size >= low):
        yield np.array([k]), Lattice([words[k]], pieces)


def segments(data: np.ndarray, bounds: np.ndarray, hasher) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct segments, segment of each occurrence, occurrence bounds by text) of texts, each with a space put
    before it (an empty one has none).

    A segment starts at each run of spaces, and at and after each other control byte; no piece goes beyond one (pieces
    hold spaces at their start only, and no control bytes), so a text's segmentations are those of its segments.
    """
    import pandas as pd

    size = np.diff(bounds)
    full = size > 0
    spot = bounds[:-1][full] + np.arange(int(full.sum()))
    padded = np.insert(data, bounds[:-1][full], 0x20)
    new = np.concatenate([[0], np.cumsum(size + full)])
    if not len(padded):
        return [], np.zeros(0, np.int64), new
    space, control = padded == 0x20, padded < 0x20
    start = control.copy()
    start[1:] |= control[:-1]
    start |= space
    start[1:] &= ~(space[1:] & space[:-1])
    start[spot] = True
    s = np.flatnonzero(start)
    e = np.append(s[1:], len(padded))
    hasher._powers(len(padded) + 1)
    total = np.zeros(len(padded) + 1, np.uint64)
    np.cumsum(hasher.table[padded] * hasher.power[:len(padded)], out=total[1:])
    names = (total[e] - total[s]) * hasher.inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    back, own = pd.factorize(names)
    at = np.empty(len(own), np.int64)
    at[back[::-1]] = np.arange(len(back) - 1, -1, -1)
    raw = padded.tobytes()
    return [raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())], back, np.searchsorted(s, new)
