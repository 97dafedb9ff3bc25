"""Substring dedup by difference-cover anchors: removes passages that a document with a smaller id has already.

A window is ``window`` (13) consecutive words. D = {0, 1, 3} is a difference cover modulo 7: for any two places i and
j there is a d < 7 with (i + d) mod 7 and (j + d) mod 7 both in D. So if windows at i and j are equal, the texts share
the 7 words from i + d and j + d, and both places are cover positions: it suffices to hash 7 words at three of seven
positions (window - 6 words in general). Chunks of texts ask which anchors occur in more than one place (4 bytes
each; a chance hit only costs a needless extension). Round a shared anchor all whole windows that hold it are hashed
and their least document id is asked for; then every word that such a window covers goes. See chunks.py for the
exchange: no anchor's or window's occurrences are ever gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .chunks import ANSWER, ANSWER_DDL, BUCKET_VALUES, CHUNK_BYTES, REQUEST_DDL, blobs, chunked, requests, text_size, whole
from .common import WordHasher, text_buffers, window_mask, windows

#: A difference cover and its period (fixed values).
COVER, PERIOD = (0, 1, 3), 7
NO_ID = np.iinfo(np.int64).max


def _ids(col: pa.ChunkedArray) -> np.ndarray:
    return col.fill_null(int(NO_ID)).to_numpy()


def _anchors(h: np.ndarray, woff: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of anchors: cover positions, counted within each text, from which ``span`` words follow."""
    ok = window_mask(woff, span)
    place = np.arange(len(ok)) - np.repeat(woff[:-1], np.diff(woff))[:len(ok)]
    at = np.flatnonzero(ok & np.isin(place % PERIOD, COVER))
    return at, windows(h, span)[at]


def _least(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the least id of each."""
    if not len(keys):
        return keys, ids
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[cut], np.minimum.reduceat(ids, cut)


def _ask_anchors(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        h, woff = WordHasher(lower=False)(*text_buffers(table.column("text")))
        at, a = _anchors(h, woff, window - PERIOD + 1)
        text = np.searchsorted(woff, at, "right")
        order = np.argsort(a, kind="stable")
        a, text = a[order], text[order]
        cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        more = np.zeros(0, bool) if not len(a) else np.minimum.reduceat(text, cut) != np.maximum.reduceat(text, cut)
        keys = a[cut]  # those that two texts of the chunk have are sent twice
        return requests(table.column("chunk")[0].as_py(), np.concatenate([keys, keys[more]]), buckets, width=np.uint32)
    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    keys = blobs(table, "keys", np.uint32)
    values, counts = np.unique(np.concatenate(keys), return_counts=True)
    shared = values[counts > 1]
    out = []
    for k in keys:
        k = np.unique(k)
        at = np.minimum(np.searchsorted(shared, k), max(len(shared) - 1, 0))
        out.append(k[shared[at] == k].tobytes() if len(shared) else b"")
    return pa.Table.from_arrays([table.column("chunk").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(out, pa.binary()), pa.nulls(len(out), pa.binary())], schema=ANSWER)


def _ask_windows(window: int, buckets: int, window_buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return requests(0, np.zeros(0, np.uint64), window_buckets, np.zeros(0, np.int64))
        h, woff = WordHasher(lower=False)(*text_buffers(table.column("text")))
        at, a = _anchors(h, woff, window - PERIOD + 1)
        shared = np.sort(np.concatenate([np.zeros(0, np.uint64)] + [whole(k, b, buckets) for k, b in zip(blobs(answers, "keys", np.uint32), answers.column("bucket").to_pylist())]))
        mine = (a & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) + (a >> np.uint64(32)) % np.uint64(buckets)
        at = at[_found(shared, mine)[0]]
        ok = window_mask(woff, window)
        text = np.searchsorted(woff, at, "right") - 1
        start = np.zeros(len(ok), bool)
        for d in range(PERIOD):
            s = at - d
            s = s[(s >= woff[text]) & (s < len(ok))]
            start[s] = True
        s = np.flatnonzero(start & ok)
        ids = _ids(table.column("doc"))[np.searchsorted(woff, s, "right") - 1]
        keys, least = _least(windows(h, window)[s], ids)
        return requests(table.column("chunk")[0].as_py(), keys, window_buckets, least)
    return run


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it there, at which place) in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def _answer_windows(table: pa.Table) -> pa.Table:
    keys, least = blobs(table, "keys", np.uint64), blobs(table, "data", np.int64)
    values, first = _least(np.concatenate(keys), np.concatenate(least))
    out, data = [], []
    for k, own in zip(keys, least):
        g = first[np.searchsorted(values, k)]
        out.append(k[g < own].tobytes())
        data.append(g[g < own].tobytes())
    return pa.Table.from_arrays([table.column("chunk").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(out, pa.binary()), pa.array(data, pa.binary())], schema=ANSWER)


def _remove(window: int, schema: pa.Schema):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        data, bounds = text_buffers(table.column("text"))
        h, woff = WordHasher(lower=False)(data, bounds)
        ok = window_mask(woff, window)
        win = windows(h, window)[ok]
        s = np.flatnonzero(ok)
        ids = _ids(table.column("doc"))[np.searchsorted(woff, s, "right") - 1]
        keys, least = _least(win, ids)
        best = least[np.searchsorted(keys, win)]
        gk, gv = _least(np.concatenate([np.zeros(0, np.uint64), *blobs(answers, "keys", np.uint64)]), np.concatenate([np.zeros(0, np.int64), *blobs(answers, "data", np.int64)]))
        hit, at = _found(gk, win)
        best[hit] = np.minimum(best[hit], gv[at[hit]])
        gone = s[best < ids]
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[woff[1:]] - total[woff[:-1]]
        kept = []
        for i in range(len(bounds) - 1):
            words = data[bounds[i]:bounds[i + 1]].tobytes().split()
            if removed[i]:
                words = [words[x] for x in np.flatnonzero(~gone[woff[i]:woff[i + 1]])]
            kept.append(b" ".join(words))
        return pa.Table.from_arrays([table.column("doc").combine_chunks(), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(np.diff(woff)), pa.array(removed),
                                     *([table.column("rest").combine_chunks()] if "rest" in table.column_names else [])], schema=schema)
    return run


def substring_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", rest: bool = False, chunk_bytes: int = CHUNK_BYTES,
                    bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) for every row of ``docs``, and with ``rest`` a struct of its other columns.

    kept: the words that stay, joined by one space; nothing of the words changes. Words are removed that lie in a
    window which also starts in a row with a smaller id, judged on the input. Null, empty and white-space texts have
    no words. A null id counts as larger than all ids; rows with equal ids are not smaller than each other. Texts of
    fewer words than a window stay whole. Other columns are carried or ignored, whatever their names.
    """
    if window < PERIOD:
        raise ValueError(f"a window has {PERIOD} words at least")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    rest = rest and bool(others)
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), *([F.struct(*others).alias("rest")] if rest else []))
    size = text_size(own, F.col("text"))
    texts = chunked(own, size, "doc", "text", chunk_bytes=chunk_bytes)
    buckets = max(1, size // 14 // bucket_values)
    asked = texts.groupBy("chunk").applyInArrow(_ask_anchors(window, buckets), REQUEST_DDL)
    shared = asked.groupBy("bucket").applyInArrow(_answer_anchors, ANSWER_DDL)
    asked = texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_ask_windows(window, buckets, buckets), REQUEST_DDL)
    least = asked.groupBy("bucket").applyInArrow(_answer_windows, ANSWER_DDL)
    out = T.StructType([T.StructField("doc", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    if rest:
        out.add(own.schema["rest"])
    return texts.groupBy("chunk").cogroup(least.groupBy("chunk")).applyInArrow(_remove(window, to_arrow_schema(out)), out).withColumnRenamed("doc", "doc_id")
