"""Periodic runs of words by seeds on diagonals: passages that repeat a short stretch over and over.

A run of smallest period q and at least ``times`` * q words (``least`` at least) has the same words on two diagonals q apart for
length - q words. Lags are taken in bands (1; 2; 3-4; 5-8; ...). In a band every k-gram, k the overlap that a run
of the band is sure to have, is indexed within its document, and its neighbouring occurrences are paired. A run's first
k-gram next occurs exactly q words on (nearer would give the run a smaller period), so pairs of neighbours with a lag in
the band find every run, and a k-gram that occurs m times gives m - 1 pairs, not m^2. Pairs of a lag are walked in order
of place with the furthest word that the lag covers: a pair within it only moves it on, any other is a seed, which is
extended to both sides while words q apart are equal.

All texts of a group are handled together in numpy. k-gram hashes are made by doubling (H of 2m words from two H of m),
and a k-gram without a second occurrence is left out of the longer ones, so the work is about one sort of the words and
a few passes per band. Nothing is shuffled: a document's runs are found where it is read, in memory that follows the
longest text (some 100 bytes a word) or a group of GROUP_BYTES.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, mix, text_buffers, text_groups

#: Text gathered at a time when what is kept is put together, in bytes.
PIECE = 1 << 20

RUNS_DDL = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _grams(levels: list[np.ndarray], k: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the k words from places ``at``; levels[j] holds those of 2^j words from every place."""
    j = k.bit_length() - 1
    while len(levels) <= j:
        h, m = levels[-1], 1 << (len(levels) - 1)
        levels.append(mix(h[:-m] * np.uint64(0x9E3779B97F4A7C15) + h[m:] + np.uint64(m)) if len(h) > m else h[:0])
    h = levels[j]
    return mix(h[at] * np.uint64(0xD1342543DE82EF95) + h[at + (k - (1 << j))] + np.uint64(k))


def runs_of(words: np.ndarray, woff: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Columns (text, start, length, period) of all runs, by text, start and period. ``words``: hashes of the words of
    texts one after another, text i from woff[i] to woff[i + 1]."""
    if times < 3:
        raise ValueError("a run has three periods at least")
    text = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
    left = woff[1:][text] - np.arange(len(text))  # words from a place to its text's end
    alive, levels, out = np.arange(len(words)), [words], [np.zeros((4, 0), np.int64)]
    low, high = 1, 1
    while True:
        k = max(least, times * low) - low
        alive = alive[left[alive] >= k]
        if len(alive) < 2:
            break
        gram = mix(_grams(levels, k, alive) ^ (text[alive].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
        order = np.argsort(gram, kind="stable")
        same = np.flatnonzero(gram[order][1:] == gram[order][:-1])
        first, second = alive[order[same]], alive[order[same + 1]]
        repeated = np.zeros(len(alive), bool)
        repeated[order[same]] = repeated[order[same + 1]] = True
        alive = alive[repeated]
        lag = second - first
        band = (lag >= low) & (lag <= high)
        out.append(_extended(words, text, first[band], lag[band], k, least, times))
        low, high = high + 1, 2 * high
    found = np.concatenate(out, axis=1)
    found = found[:, np.lexsort((found[3], found[1]))]
    return np.stack([text[found[1]], found[1] - woff[text[found[1]]], found[2], found[3]])


def _extended(words: np.ndarray, text: np.ndarray, place: np.ndarray, lag: np.ndarray, k: int, least: int, times: int) -> np.ndarray:
    """(0, start, length, period) of the runs through the pairs (place, place + lag) of equal k-grams."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # the furthest word that a lag covers: a pair beyond it, or of another lag, is a seed
    seed = np.ones(len(place), bool)
    seed[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + k)
    at = np.flatnonzero(seed)
    a, q = place[at], lag[at]
    b = place[np.append(at[1:], len(place)) - 1] + k if len(at) else a  # equal from a to b, excluded, on this diagonal
    for step, end in ((-1, a), (1, b)):
        go = np.arange(len(a))
        while len(go):
            x = end[go] - 1 if step < 0 else end[go]
            y = x + q[go]
            ok = (x >= 0) & (y < len(words))
            go, x, y = go[ok], x[ok], y[ok]
            ok = (text[x] == text[y]) & (text[x] == text[a[go]]) & (words[x] == words[y])
            go = go[ok]
            end[go] += step
    length = b - a + q
    keep = length >= np.maximum(least, times * q)
    return np.stack([np.zeros(keep.sum(), np.int64), a[keep], length[keep], q[keep]])


def _kept(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    """Words data[first[i]:last[i]] joined by one space, gathered PIECE bytes at a time."""
    size = last - first + 1
    ends = np.cumsum(size)
    out, i = [], 0
    while i < len(size):
        j = max(int(np.searchsorted(ends, ends[i] - size[i] + PIECE, "right")), i + 1)
        if j == i + 1:
            out.append(data[first[i]:last[i]].tobytes() + b" ")
        else:
            n = size[i:j]
            at = np.cumsum(n)
            source = np.arange(at[-1]) + np.repeat(first[i:j] - (at - n), n)
            source[at - 1] = first[i]  # the spaces' places
            piece = data[source]
            piece[at - 1] = 0x20
            out.append(piece.tobytes())
        i = j
    return b"".join(out)[:-1]


def _find(least: int, times: int, schema: pa.Schema):
    def run(batches):
        hasher = WordHasher(lower=False)
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            for i, j in text_groups(bounds):
                part, own = data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
                h, woff, spots = hasher(part, own, places=True)
                text, start, length, period = runs_of(h, woff, least, times)
                cover = np.zeros(len(h) + 1, np.int64)
                np.add.at(cover, woff[text] + start + period, 1)
                np.add.at(cover, woff[text] + start + length, -1)
                stay = np.cumsum(cover)[:-1] == 0
                cut = np.searchsorted(text, np.arange(j - i + 1))
                runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
                texts = []
                for t in range(j - i):
                    s, e = (x[woff[t]:woff[t + 1]][stay[woff[t]:woff[t + 1]]] for x in spots)
                    texts.append(_kept(part, s, e))
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), runs)
                yield pa.RecordBatch.from_arrays([lists, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.diff(woff)), batch.column(1).slice(i, j - i)], schema=schema.append(batch.schema.field(1)))
    return run


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(runs, collapsed, n_words, and the columns ``keep``) for every row of ``docs``.

    A run is a stretch of words with smallest period q (words q apart are identical), of at least ``least`` words and
    ``times`` * q, that no neighbouring word extends keeping period q. runs: structs (start, length, period) by start, then
    period, words numbered from 0. collapsed: the words outside all runs and the first q of each run, joined by one
    space, unless another run drops them. Words are maximal stretches of characters other than white space; null, empty and white-space texts
    have none, no runs and an empty ``collapsed``. Every row is handled by itself: equal rows and null ids give their own rows,
    other columns are ignored, an empty table gives no rows. Words are compared by 64-bit hashes."""
    schema = pa.schema([("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()), ("n_words", pa.int64())])
    own = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("rest"))
    out = own.mapInArrow(_find(least, times, schema), f"runs {RUNS_DDL}, collapsed string, n_words long, rest {own.schema['rest'].dataType.simpleString()}")
    return out.select("runs", "collapsed", "n_words", "rest.*")
