"""The registered queries of the operators (``opN_<name>``), over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .hash_forest import nearest
from .kd_trees import exact_top
from .lm_scoring import held_out_by_id, lattice_scores
from .mixing import mix_sources
from .ngram_join import ngram_components
from .packing import pack
from .periodic_runs import periodic_runs
from .quality import quality_scores
from .sampled_pieces import decode, encode
from .substring_dedup import substring_dedup
from .token_counts import token_counts
from .url_filter import url_verdicts
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: (doc_id, n, word) of every document's words, and (doc_id, ws) their lists; {text} is the text's expression.
WORDS_SQL = """
pieces AS (
    SELECT doc_id, generate_subscripts(list, 1) AS i, unnest(list) AS word
    FROM (SELECT doc_id, string_split_regex({text}, '[\\x20\\x09-\\x0D]+') AS list FROM documents WHERE text IS NOT NULL)),
words AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, word FROM pieces WHERE word <> ''),
lists AS (SELECT doc_id, list(word ORDER BY n) AS ws FROM words GROUP BY doc_id)"""


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f
    return add


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir), k=3, t=90)


ORACLES["op1_ngram_jaccard_join"] = "WITH RECURSIVE" + WORDS_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """,
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(ws[j:j + 2], ' ') AS shingle
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS j FROM lists)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 90 * (s.n + t.n - k)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.y FROM reach r JOIN ways w ON r.b = w.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = doc_id GROUP BY doc_id
"""


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op4_substring_dedup"] = "WITH" + WORDS_SQL.format(text="text") + """,
windows AS (
    SELECT doc_id, j, array_to_string(ws[j:j + 12], ' ') AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS j FROM lists)),
firsts AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
gone AS (SELECT DISTINCT doc_id, j + d AS n FROM windows JOIN firsts USING (w), range(0, 13) t(d) WHERE least < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY n) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, n) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_words, coalesce(c.n, 0) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


@query("op2_lattice_likelihood")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(documents(spark, sf_dir), held_out_by_id("doc_id", 10, 0))


@query("op5_sampled_pieces")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and checksum of the sampled ids, and the digest of the text decoded from them."""
    out = decode(encode(documents(spark, sf_dir), seed=17))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
                      F.sha2("text", 256).alias("decoded_sha256"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_by_id("id", 4, 2))


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op3_hash_prefix_forest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


@query("op8_kd_tree_topk")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op8_kd_tree_topk"] = """
WITH e AS (SELECT vec_id, embedding, row_number() OVER () AS row FROM embeddings WHERE vec_id IS NOT NULL),
u AS (SELECT vec_id, row, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM e),
ok AS (SELECT row, count(*) AS n FROM u GROUP BY row HAVING bool_and(coalesce(isfinite(x), false))),
v AS (SELECT vec_id, row, n, i, CAST(floor(1024 * x) AS BIGINT) AS y FROM u JOIN ok USING (row)),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.y * c.y) AS BIGINT) AS score
    FROM v q JOIN v c ON q.i = c.i AND q.n = c.n AND c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, q.row, c.vec_id, c.row),
b AS (SELECT query_id, vec_id, max(score) AS score FROM p GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM b)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op11_source_mix")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(documents(spark, sf_dir), weights=(3, 1, 2), share=(3, 2), most=2)
    return out.select("doc_id", "size", "source_size", "target", "taken")


#: Water level by the sources' order of size over weight: one is full if the level of those from it on is above it.
ORACLES["op11_source_mix"] = """
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
    FROM documents),
s AS (
    SELECT source, sum(size)::HUGEINT AS s, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w
    FROM d GROUP BY source),
levels AS (
    SELECT *, sum(w) OVER up AS parts, 3 * sum(s) OVER () - 4 * (sum(s) OVER up_to - s) AS rest
    FROM s WINDOW up AS (ORDER BY s * 6 // w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        up_to AS (ORDER BY s * 6 // w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
full_ones AS (SELECT *, 4 * s * parts < rest * w AS is_full FROM levels),
level AS (SELECT 3 * sum(s) - 4 * coalesce(sum(s) FILTER (is_full), 0) AS over, coalesce(sum(w) FILTER (NOT is_full), 1) AS shares FROM full_ones),
plan AS (
    SELECT source, s, CASE WHEN is_full THEN CAST(2 * s AS DOUBLE) ELSE CAST(over * w AS DOUBLE) / CAST(2 * shares AS DOUBLE) END AS target,
        CASE WHEN is_full THEN 2 * s ELSE (2 * over * w + 2 * shares) // (4 * shares) END AS budget
    FROM full_ones, level),
r AS (
    SELECT d.*, p.s, p.target, CASE WHEN p.s = 0 THEN 0 ELSE p.budget // p.s END AS base, p.budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, rowid_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM d) d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
    CAST(base * size + least(size, greatest(0, budget - base * s - before)) AS BIGINT) AS taken
FROM r
"""


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text; of ids whose checksum h ends in 0 the words from a on repeat the first p of them:
    a = h div 10 modulo the number of words, p = 1 + (n - a) div (3 + h div 10 modulo 8)."""
    space = r"[\x20\x09-\x0D]+"
    own = docs.select("doc_id", "text", F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY))").alias("h"))
    words = F.filter(F.split("text", space), lambda w: w != "")
    some = own.withColumn("w", F.when(F.expr("h % 10 = 0"), words)).withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    some = some.withColumn("a", F.expr("CAST(CASE WHEN n > 0 THEN g % n END AS INT)")).withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    tail = F.expr("flatten(array_repeat(slice(w, a + 1, p), CAST((n - a) div p + 1 AS INT)))")
    text = F.array_join(F.slice(F.concat(F.expr("slice(w, 1, a)"), tail), 1, F.col("n")), " ")
    return some.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(looped(documents(spark, sf_dir)), least=6, times=4)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(lines, 256).alias("runs_sha256"),
                     F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", F.expr("-r.start").alias("start"), F.col("r.length").alias("length"), F.expr("-r.period").alias("period"),
                      F.expr("1000 * r.length div -r.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=8)
