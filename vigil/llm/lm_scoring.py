"""LM scoring by subword lattice likelihood: the probability of a text summed over all its segmentations.

The vocabulary is an existing one; its scores are where the piece probabilities start. They are re-estimated on the
training texts by EM: expected piece counts by forward and outside sums over the lattices of all distinct training
words (weighted by their counts), kept close to the vocabulary's own scores by PRIOR pseudo-counts. A token is a
lower-cased word or the end of the text; pieces do not go beyond a word, so a text's marginal probability is the
product of its words' marginals and the end's, and each distinct word's forward recursion is run once.

Counts and scores reach the texts through chunks (see chunks.py): a chunk asks once for each of its distinct words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import REQUEST_DDL, ANSWER, ANSWER_DDL, BUCKET_VALUES, blobs, chunked, requests, text_size
from .common import WordHasher, record_batch, save, text_buffers, text_groups
from .lattice import PieceTrie, Vocabulary, lattices

CHUNK_BYTES = 8 << 20
EM_ROUNDS = 3
PRIOR = 1000.0
#: Words whose lattices are built together.
WORDS = 50_000


def _count_words():
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        hasher = WordHasher(lower=True)
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            train = ~batch.column(1).to_numpy(zero_copy_only=False)
            for i, j in text_groups(bounds):
                part = data[bounds[i]:bounds[j]]
                h, woff, (s, e) = hasher(part, bounds[i:j + 1] - bounds[i], places=True)
                if not len(h):
                    continue
                back, names = pd.factorize(h)
                at = np.empty(len(names), np.int64)
                at[back[::-1]] = np.arange(len(back) - 1, -1, -1)
                n = np.bincount(back, weights=np.repeat(train[i:j], np.diff(woff)), minlength=len(names)).astype(np.int64)
                raw = part.tobytes().lower()
                yield record_batch(schema, [pa.array([raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())], pa.binary()), n])
    return run


def _word_sets(batches, names: list[str]):
    """Columns of the batches, joined up to about WORDS rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= WORDS:
            yield [pa.Table.from_batches(held).column(c) for c in names]
            held, rows = [], 0
    if rows:
        yield [pa.Table.from_batches(held).column(c) for c in names]


def _expected(vocabulary: Vocabulary, logp: np.ndarray):
    schema = pa.schema([("piece", pa.int32()), ("expected", pa.float64())])

    def run(batches):
        pieces, total = PieceTrie(vocabulary), np.zeros(len(logp))
        for word, n in _word_sets(batches, ["word", "n"]):
            words, n = [b" " + w for w in word.to_pylist()], n.to_numpy()
            for at, lattice in lattices(words, pieces):
                total += lattice.expected(logp, lattice.forward(logp), n[at], len(logp))
        some = np.flatnonzero(total)
        yield record_batch(schema, [some.astype(np.int32), total[some]])
    return run


def _scored(vocabulary: Vocabulary, logp: np.ndarray, buckets: int):
    def run(batches):
        pieces, hasher = PieceTrie(vocabulary), WordHasher(lower=False)
        for word, n in _word_sets(batches, ["word", "n"]):
            raw = word.to_pylist()
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            data = np.frombuffer(b"".join(raw), np.uint8)
            h, _ = hasher(data, np.concatenate([[0], np.cumsum(size)]))
            out = np.zeros((len(raw), 2))
            out[:, 0] = n.to_numpy()
            for at, lattice in lattices([b" " + w for w in raw], pieces):
                out[at, 1] = lattice.forward(logp)[lattice.trie.ends]
            order = np.argsort(h)
            yield from requests(-1, h[order], buckets, out[order]).to_batches()
    return run


def _ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        h, _ = WordHasher(lower=True)(*text_buffers(table.column("text")))
        return requests(table.column("chunk")[0].as_py(), np.sort(pd.unique(h)), buckets)
    return run


def _answer(words: pa.Table, asked: pa.Table) -> pa.Table:
    if not asked.num_rows:
        return ANSWER.empty_table()
    keys = np.concatenate(blobs(words, "keys", np.uint64))
    data = np.concatenate(blobs(words, "data", np.float64)).reshape(-1, 2)
    order = np.argsort(keys)
    keys, data = keys[order], data[order]
    out = [data[np.searchsorted(keys, k)].tobytes() for k in blobs(asked, "keys", np.uint64)]
    return pa.Table.from_arrays([asked.column("chunk").combine_chunks(), asked.column("bucket").combine_chunks(), pa.nulls(len(out), pa.binary()), pa.array(out, pa.binary())], schema=ANSWER)


def _score(buckets: int, tokens: int, distinct: int, ends: int, log_end: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        h, woff = WordHasher(lower=True)(*text_buffers(table.column("text")))
        back, names = pd.factorize(h)
        order = np.argsort(names)
        bucket = ((names[order] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = order[np.argsort(bucket, kind="stable")]  # as requests() orders them
        got = dict(zip(answers.column("bucket").to_pylist(), blobs(answers, "data", np.float64)))
        data = np.empty((len(names), 2))
        data[order] = np.concatenate([np.zeros(0), *(got[b] for b in sorted(got))]).reshape(-1, 2)
        whole = np.log10(tokens + 0.1 * (distinct + 1))
        each = np.stack([data[:, 0] > 0, np.log10(data[:, 0] + 0.1) - whole, data[:, 1] / np.log(10)])[:, back]
        text = np.repeat(np.arange(table.num_rows), np.diff(woff))
        known, base, score = (np.bincount(text, weights=x, minlength=table.num_rows) for x in each)
        n = table.num_rows
        return pa.Table.from_arrays([
            table.column("doc").combine_chunks(), table.column("held_out").combine_chunks(), pa.array(np.diff(woff) + 1), pa.array(known.astype(np.int64) + (ends > 0)),
            pa.array(np.full(n, tokens)), pa.array(base + np.log10(ends + 0.1) - whole), pa.array(score + log_end / np.log(10))], schema=schema)
    return run


def held_out_by_id(id_col: str = "doc_id", parts: int = 10, part: int = 0) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def lattice_scores(docs: DataFrame, held_out: Column, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", em_rounds: int = EM_ROUNDS,
                   prior: float = PRIOR, chunk_bytes: int = CHUNK_BYTES, bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Tokens of a text: its words, A-Z lower-cased, then one end. Rows where ``held_out`` is false are learnt from.
    base_score: log10 by the words' own smoothed counts; score: log10 of the text's marginal probability over all
    segmentations. Null, empty and white-space texts have the end only. Repeated rows and ids count and are scored
    one by one; a null id is kept. With no training rows the vocabulary's own scores hold (an end then has the
    probability that the prior gives to one piece). Other columns are ignored; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    words = save(own.select("text", "held_out").mapInArrow(_count_words(), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    ends, size = own.agg(F.count(F.when(~F.col("held_out"), 1)), F.sum(F.octet_length("text"))).first()

    voc = Vocabulary(vocabulary)
    logp, log_end, first = voc.logp, -np.log1p(prior), np.exp(voc.logp)
    for _ in range(em_rounds):
        found = words.where("n > 0").mapInArrow(_expected(voc, logp), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("expected"))
        uses = prior * first
        for row in found.collect():  # at most one row per piece of the vocabulary
            uses[row.piece] += row.expected
        total = uses.sum() + ends + prior / len(uses)
        with np.errstate(divide="ignore"):
            logp = np.log(uses) - np.log(total)
        log_end = np.log(ends + prior / len(uses)) - np.log(total)

    buckets = max(1, (size or 0) // (8 * bucket_values))  # chunks ask in proportion to their size
    scored = words.mapInArrow(_scored(voc, logp, buckets), REQUEST_DDL)
    texts = chunked(own, size or 0, "doc", "text", chunk_bytes=chunk_bytes)
    asked = texts.groupBy("chunk").applyInArrow(_ask(buckets), REQUEST_DDL)
    answers = scored.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answer, ANSWER_DDL)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(buckets, n_words + ends, distinct + (ends > 0), ends, float(log_end)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
