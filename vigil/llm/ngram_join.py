"""N-gram Jaccard join by signature trees: which documents share almost all their word shingles.

Exact for any threshold t (100 * intersection >= t * union):

1. Every text is hashed to its set of distinct shingles; equal sets are one member (a copy group of any size is one
   row per task at most, and one row when candidates are sought). Sets are hashed anew in each pass: cheaper than
   keeping them.
2. Linked sets share a token among their first |A| - ceil(t|A|/100) + 1 tokens in any common order. The order here:
   shingles of a fixed hash universe first, rarest first (their frequencies are counted over all texts, copies once a
   task), then the others by hash. Tokens of one member only go no further; the rest deals members into blocks.
3. In a block, the dual traversal of signature trees (bitmaps and sizes only) gives a spanning forest of the pairs
   that may be linked. Blocks over BLOCK members are dealt into pairs of parts, so any block is done whole in bounded
   memory.
4. The forests' components are the candidate clusters; each member's whole set goes once to its cluster, and a second
   dual traversal verifies pairs on the sets, leaving out pairs whose members are linked already. Clusters over
   CLUSTER_TOKENS are again dealt into pairs of parts.
5. Components of the verified links give the answer.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (GROUP_BYTES, WordHasher, list_array, record_batch, save, sized, streamed, text_buffers, text_groups, window_mask, windows)
from .components import connected_components
from .signature_tree import bitmap, link_group

#: Members of a block, and shingles of a cluster, that one task takes at a time; larger ones are dealt into pairs of parts.
BLOCK = 4096
CLUSTER_TOKENS = 1_000_000
#: Sets that a task remembers.
SEEN = 200_000


def shingle_sets(data: np.ndarray, bounds: np.ndarray, hasher: WordHasher, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; of texts with fewer words, the whole sequence as one."""
    h, woff = hasher(data, bounds)
    win, ok = windows(h, k), window_mask(woff, k)
    out = []
    for a, b in zip(woff[:-1].tolist(), woff[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(win[a:b - k + 1]))
        elif b > a:
            out.append(windows(h[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    del ok
    return out


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sid(digest: bytes) -> int:
    """The 64-bit name of a set while candidates are sought (links are verified under the whole digest)."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _hashed(batches, at: int, k: int):
    """(batch, first row, row after the last, sets) by groups of texts."""
    hasher = WordHasher(lower=True)
    for batch in batches:
        data, bounds = text_buffers(batch.column(at))
        for i, j in text_groups(bounds, GROUP_BYTES):
            yield batch, i, j, shingle_sets(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], hasher, k)


class _Seen:
    """The sets that a task has met, so that it sends copies of them once (forgets beyond SEEN: only work is saved)."""

    def __init__(self):
        self.digests: set[bytes] = set()

    def new(self, digest: bytes) -> bool:
        if digest in self.digests:
            return False
        if len(self.digests) < SEEN:
            self.digests.add(digest)
        return True


def _members(k: int, t: int, universe: int, marked: bool):
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sid", pa.int64()), ("bits", pa.binary()), ("nu", pa.int64()), ("extra", pa.list_(pa.int64())),
                        *([("mark", pa.binary())] if marked else [])])

    def run(batches):
        seen = _Seen()
        for batch, i, j, sets in _hashed(batches, 1, k):
            digests = [_digest(s) for s in sets]
            first = [len(s) > 0 and seen.new(d) for s, d in zip(sets, digests)]
            own = [s % np.uint64(universe) == 0 for s in sets]
            extra = [s[~o][:max(0, len(s) - (t * len(s) + 99) // 100 + 1 - int(o.sum()))] if f else s[:0] for s, o, f in zip(sets, own, first)]
            yield record_batch(schema, [batch.column(0)[i:j], [len(s) for s in sets], digests, [_sid(d) for d in digests],
                                        [bitmap(s).tobytes() if f else None for s, f in zip(sets, first)], [int(o.sum()) for o in own], list_array([x.view(np.int64) for x in extra]),
                                        *([batch.column(2)[i:j]] if marked else [])])
    return run


def _tokens(k: int, universe: int):
    schema = pa.schema([("sid", pa.int64()), ("u", pa.list_(pa.int64()))])

    def run(batches):
        seen = _Seen()
        for _, _, _, sets in _hashed(batches, 0, k):
            rows = [(_sid(d), s[s % np.uint64(universe) == 0]) for s in sets if len(s) and seen.new(d := _digest(s))]
            yield record_batch(schema, [[x for x, _ in rows], list_array([u.view(np.int64) for _, u in rows])])
    return run


def _sets(k: int):
    schema = pa.schema([("digest", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        for _, _, _, sets in _hashed(batches, 0, k):
            yield record_batch(schema, [[_digest(s) for s in sets], [s.tobytes() for s in sets]])
    return run


def _dealt(rows: DataFrame, key: str, parts) -> DataFrame:
    """Rows with key columns (key, i, j): one group if ``parts`` is 1, else a group for each pair of parts i <= j."""
    return (rows.withColumn("k", F.greatest(F.lit(1), parts).cast("int")).withColumn("c", F.pmod(F.xxhash64(F.lit(7), "sid"), F.col("k")).cast("int"))
            .withColumn("o", F.explode(F.expr("sequence(0, k - 1)"))).withColumn("i", F.least("c", "o")).withColumn("j", F.greatest("c", "o"))
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "sid"))


def _columns(table: pa.Table):
    sid = table.column("sid").to_numpy()
    n = table.column("n").to_numpy()
    bits = [np.frombuffer(x, np.uint64) for x in table.column("bits").to_pylist()]
    side = None
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        side = (table.column("c").to_numpy() == table.column("j")[0].as_py()).astype(int)
    return sid, n, bits, side


def _candidates(t: int, key: str):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        seen: set[bytes] = set()  # the same members often share many blocks
        for _, table in streamed(batches, [key, "i", "j"]):
            sid, n, bits, side = _columns(table)
            if side is None and len(sid) < 64:
                if (name := sid.tobytes()) in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(name)
            if edges := link_group(n, bits, t, None, side):
                at = np.array(edges)
                yield record_batch(schema, [sid[at[:, 0]], sid[at[:, 1]]])
    return run


def _verified(t: int, key: str):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for _, table in streamed(batches, [key, "i", "j"]):
            sid, n, bits, side = _columns(table)
            tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]

            def linked(a: int, b: int) -> bool:
                common = len(np.intersect1d(tokens[a], tokens[b], assume_unique=True))
                return 100 * common >= t * (len(tokens[a]) + len(tokens[b]) - common)

            if edges := link_group(n, bits, t, linked, side):
                at = np.array(edges)
                yield record_batch(schema, [sid[at[:, 0]], sid[at[:, 1]]])
    return run


def ngram_components(docs: DataFrame, k: int = 5, t: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                     cluster_tokens: int = CLUSTER_TOKENS, mark: Column | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    With ``mark`` (a binary digest of the text) also mark and stays: whether the row's (id, mark) is the least of its
    component, null ids last, which is so for one (id, mark) of each component; texts without words all stay.

    Words are lower-cased (A-Z). component_id is the least id reachable over links, the row's own included. Texts
    without words (null, empty, white space) have 0 shingles and link with nothing, so component_id is their own id.
    Equal texts are linked. Repeated ids are judged row by row; a null id takes part in linking but is never a
    component's name unless all its members' ids are null. Other columns are ignored; an empty table gives no rows.
    """
    universe = max(1, 60 // (100 - t)) if t < 100 else 8
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), *([] if mark is None else [mark.alias("mark")]))
    sig = save(own.mapInArrow(_members(k, t, universe, mark is not None),
                              "doc long, n long, digest binary, sid long, bits binary, nu long, extra array<long>" + ("" if mark is None else ", mark binary")), "sizes")
    members = save(sig.where("bits is not null").select("sid", "n", "bits", "nu", "extra").dropDuplicates(["sid"]), "members")

    tokens = own.select("text").mapInArrow(_tokens(k, universe), "sid long, u array<long>").select("sid", F.explode("u").alias("h"))
    shared = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    rare = tokens.join(shared, "h").groupBy("sid").agg(F.collect_set(F.struct("df", "h")).alias("l"))
    first = (members.select("sid", "n", "extra", "nu").join(rare, "sid", "left")
             .withColumn("l", F.coalesce("l", F.expr("array()")))
             .select("sid", F.explode(F.expr(f"""concat(
                 transform(slice(array_sort(l), 1, cast(greatest(0L, n - (({t} * n + 99) div 100) + 1 - (nu - size(l))) as int)), x -> x.h), extra)""")).alias("h")))
    first = save(first, "prefixes")
    blocks = first.groupBy("h").agg(F.count("*").alias("size")).where("size > 1")
    rows = first.join(blocks, "h").join(members.select("sid", "n", "bits"), "sid")
    near = _dealt(rows, "h", F.ceil(F.col("size") / block)).select("h", "i", "j", "c", "sid", "n", "bits").mapInArrow(_candidates(t, "h"), "a long, b long")
    clusters = save(connected_components(near).withColumnsRenamed({"node": "sid"}), "clusters")

    # from here on a member is its digest, numbered; names that two digests share (a chance of n^2 / 2^65) part again
    first_mark = [] if mark is None else [F.expr("min(struct(doc IS NULL AS no_id, doc, mark))").alias("first0")]
    ident = sig.where("n > 0").groupBy("digest", "sid").agg(F.min("doc").alias("doc0"), *first_mark)
    ident = save(ident.withColumn("nid", F.monotonically_increasing_id()), "named")
    wanted = clusters.join(ident, "sid").select("digest", "nid", "sid", "root", "doc0")
    names = sized(wanted.select("doc0").distinct(), 32)
    sets = own.join(names, own.doc.eqNullSafe(names.doc0), "left_semi").select("text").mapInArrow(_sets(k), "digest binary, tokens binary")
    sets = wanted.join(sets, "digest").dropDuplicates(["digest"])
    sets = sets.join(members.select("sid", "n", "bits"), "sid").drop("sid").withColumnRenamed("nid", "sid")
    sets = save(sets.select("sid", "root", "n", "bits", "tokens"), "sets")
    weight = sets.groupBy("root").agg(F.ceil(F.sum("n") / cluster_tokens).alias("parts"))
    links = _dealt(sets.join(weight, "root"), "root", F.col("parts")).select("root", "i", "j", "c", "sid", "n", "bits", "tokens").mapInArrow(_verified(t, "root"), "a long, b long")
    labels = save(connected_components(links), "labels")

    named = labels.join(ident, labels.node == ident.nid).groupBy("root").agg(F.min("doc0").alias("least"), *([] if mark is None else [F.min("first0").alias("first")]))
    answer = (ident.join(labels, ident.nid == labels.node, "left").join(named, "root", "left")
              .select("digest", F.coalesce("least", "doc0").alias("component"), *([] if mark is None else [F.coalesce("first", "first0").alias("first")])))
    more = [] if mark is None else ["mark", F.expr("n = 0 OR (first.doc <=> doc AND first.mark <=> mark)").alias("stays")]
    return (sig.select("doc", "n", "digest", *more[:1]).join(answer, "digest", "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"), *more))
