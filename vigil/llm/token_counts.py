"""Token counts by trie-shared dynamic programming.

The distinct pre-tokens of a group of texts go into one trie; the best unigram score up to every trie node, and the
number of pieces that reach it, are found once per shared prefix, and a pre-token's count is that of its terminal
node. A text's count is the sum over its pre-tokens. Nothing is shuffled: texts are counted where they are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, record_batch, text_buffers, text_groups
from .lattice import Lattice, PieceTrie, Vocabulary, lattices, segments


def best_counts(lattice: Lattice, logp: np.ndarray) -> np.ndarray:
    """Pieces of the best segmentation up to each node (the fewest, if several are best)."""
    n = len(lattice.trie)
    f, count = np.full(n, -np.inf), np.zeros(n, np.int64)
    f[0] = 0
    w = logp[lattice.piece]
    for a, b in zip(lattice.cut[:-1], lattice.cut[1:]):
        v, x, c = lattice.v[a:b], f[lattice.u[a:b]] + w[a:b], count[lattice.u[a:b]] + 1
        twice = np.zeros(len(v), bool)
        twice[1:] = v[1:] == v[:-1]
        for part in (~twice, twice):
            node, score, pieces = v[part], x[part], c[part]
            better = (score > f[node]) | ((score == f[node]) & (pieces < count[node]) & np.isfinite(score))
            f[node[better]], count[node[better]] = score[better], pieces[better]
    return count


def _count(vocabulary: Vocabulary):
    schema = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        pieces, hasher = PieceTrie(vocabulary), WordHasher(lower=False)
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for i, j in text_groups(bounds):
                own, which, cut = segments(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], hasher)
                tokens = np.zeros(len(own), np.int64)
                for at, lattice in lattices(own, pieces):
                    tokens[at] = best_counts(lattice, vocabulary.logp)[lattice.trie.ends]
                total = np.concatenate([[0], np.cumsum(tokens[which])])
                yield record_batch(schema, [batch.column(0)[i:j], np.diff(cut), total[cut[1:]] - total[cut[:-1]]])
    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) for every row of ``docs``: pieces of the text's best segmentation under the
    vocabulary's scores, the fewest if several are best.

    A space is put before the text. Null and empty texts have no tokens. Repeated rows and null ids are kept; other
    columns are ignored; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(_count(Vocabulary(vocabulary)), "doc_id long, n_pretokens long, n_tokens long")
