"""Mixing sources to target weights by hash thresholds.

Every row has a place in its source: 60 bits of a digest of its id and text. A source whose budget is b of its S words
is taken whole b div S times, and once more up to the place where the rest of the budget ends. That place is found by
histograms: words summed by source and the next BITS bits of the place; only the bucket in which the budget ends is
read again, by its next bits, until it holds one row. The mix is then a comparison with the source's threshold: rows
are never sorted or gathered, a source with any share of all rows is a few thousand partial sums, and a larger budget
takes all that a smaller one takes (the thresholds are nested).

The row at the threshold is taken in part, so each source gives its budget to the word. Equal rows have equal places;
numbers of the stored rows refine those, and as such rows are equal it does not matter which of them are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators import scan

from .common import save, sized

#: Bits that one histogram tells apart; bits of a place, and as many of a stored row's number.
BITS, PLACE = 12, 60
WORD = r"[^\x20\x09-\x0D]+"


def place(*columns: str) -> Column:
    """PLACE bits of the MD5 of the columns' texts (nulls as empty)."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, PLACE // 4), 16, 10).cast("long")


def weighted(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(source, weight, source_size): ``weights`` by turns for the sources by code point, null last. A prefix scan
    numbers the sources, so they may be many."""
    ranked = scan.sequence(sizes.withColumn("_last", F.col("source").isNull()), None, ["_last", "source"], "_n")
    turn = (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int")
    return ranked.select("source", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), turn).alias("weight"), "source_size")


def budgets(sizes: DataFrame, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``sizes`` (source, weight, source_size) with target and budget: share[0] / share[1] of all sizes dealt by weight.
    A source stops at ``most`` times its size, and what it cannot take is dealt to the others by weight again, until
    none is above. ``target`` is one division of whole numbers, ``budget`` the nearest whole number to it.

    Each round is an aggregate of the sources; three numbers reach the driver. Whole numbers are decimals throughout."""
    up, down = share
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    big = sizes.withColumn("_cap", F.expr(f"CAST(source_size AS DECIMAL(20,0)) * {int(most)}"))
    full, stopped = "false", None
    while True:
        had, weight, now = big.agg(F.expr(f"sum(_cap) FILTER (WHERE {full})"), F.expr(f"sum(weight) FILTER (WHERE NOT {full})"), F.expr(f"count_if({full})")).first()
        if now == stopped:
            break
        # what is left for the others is left / down, of which one gets left * weight / parts
        left, parts, used, stopped = up * total - down * int(had or 0), down * int(weight or 0), full, now
        if not parts:
            break
        full = f"(_cap * {parts} < CAST({left} AS DECIMAL(20,0)) * weight)"
    full = used
    own = f"CAST({left} AS DECIMAL(20,0)) * weight"
    return big.withColumn("target", F.expr(f"CASE WHEN {full} THEN CAST(_cap AS DOUBLE) ELSE CAST({own} AS DOUBLE) / {float(parts or 1)!r}D END")).withColumn(
        "budget", F.expr(f"CASE WHEN {full} THEN CAST(_cap AS BIGINT) ELSE CAST((2 * {own} + {parts}) div {2 * parts or 1} AS BIGINT) END")).drop("_cap")


def _digit(level: int) -> Column:
    """Bits ``level * BITS`` onwards of a row's place, and then of its number."""
    number, at = divmod(level * BITS, PLACE)
    return F.shiftright(F.col("nth" if number else "place"), PLACE - at - BITS).bitwiseAND((1 << BITS) - 1)


def thresholds(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """(at, last, last_nth, part, full): the row at (last, last_nth) of source ``at`` gives ``part`` of its ``full`` words, all
    before it are taken. ``rest``: (source, left) with ``left`` above 0 and below the sum of the source's sizes.

    Rows that agree in all bits (equal ones, but for a chance of 2^-60) share ``part`` by their sizes."""
    levels = 2 * PLACE // BITS
    out, left = None, rest
    for level in range(levels):
        edge = rows.join(sized(left.select(F.col("source").alias("at"), "left"), 64, "at"), F.col("source").eqNullSafe(F.col("at")))
        sums = edge.groupBy("at", "left", _digit(level).alias("digit")).agg(
            F.sum("size").alias("full"), F.count("*").alias("rows"), F.max("place").alias("last"), F.max("nth").alias("last_nth"))
        before = F.coalesce(F.sum("full").over(Window.partitionBy("at").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ends = save(sums.withColumn("before", before).where("before < left AND left <= before + full"), "ends")
        ends = ends.withColumn("part", F.expr("left - before"))
        one = "true" if level == levels - 1 else "rows = 1"
        found = ends.where(one).select("at", "last", "last_nth", "part", "full")
        out = found if out is None else out.union(found)
        more = ends.where(f"NOT ({one})").select("at", "digit", "part")
        if more.isEmpty():
            return out
        inside = F.col("source").eqNullSafe(F.col("at")) & (_digit(level) == F.col("digit"))
        rows = save(rows.join(sized(more, 64, "at"), inside, "left_semi"), "edge")
        left = more.select(F.col("at").alias("source"), F.col("part").alias("left"))
    return out


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", rest: bool = False) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, part) for every row, and with ``rest`` a struct of its columns.

    size: words of the text, none for null, empty and white-space texts, which are never taken; target: the source's
    share (see ``budgets``); copies: whole copies that the mix takes; part: words it takes besides, from the text's start (one
    row of a source has any, or equal rows); taken: all words, ``most`` times the size at most. A null source is a
    source, the last; a null id is no more than an empty one. Equal rows count each; which of them are taken more often
    is of no consequence, so reruns agree. An empty table gives no rows; other columns are ignored or carried."""
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest")] if rest else []
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{source_col}`").alias("source"), *kept)
    rows = own.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), place("doc_id", "text").alias("place"),
                      F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << PLACE) - 1).alias("nth"), *(["rest"] if rest else []))
    rows = save(rows, "sizes")
    sizes = save(weighted(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "sources")
    plan = save(budgets(sizes, share, most).withColumn("base", F.expr("coalesce(budget div nullif(source_size, 0), 0)")), "plan")
    ends = thresholds(rows.select("source", "size", "place", "nth"), plan.select("source", F.expr("budget - base * source_size").alias("left")).where("left > 0"))
    plan = plan.join(ends, F.col("source").eqNullSafe(F.col("at")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "base", "last", "last_nth", F.col("part").alias("end"), F.col("full").alias("end_of"))
    mixed = rows.join(sized(save(plan, "thresholds"), 96, "of"), F.col("source").eqNullSafe(F.col("of")))
    mixed = mixed.withColumn("copies", F.expr("base + CASE WHEN place < last OR place = last AND nth < last_nth THEN 1 ELSE 0 END"))
    mixed = mixed.withColumn("part", F.expr("CASE WHEN place = last AND nth = last_nth THEN CAST(CAST(size AS DECIMAL(20,0)) * end div end_of AS BIGINT) ELSE 0L END"))
    return mixed.select("doc_id", "size", "source_size", "target", F.expr("copies * size + part").alias("taken"), "copies", "part", *(["rest"] if rest else []))


def mixed_texts(mixed: DataFrame, text: str = "rest.text") -> DataFrame:
    """The mix itself, a row per copy: ``mixed`` (of ``rest=True``) with ``copy`` and ``mixed_text``, the whole text or, of the
    row taken in part, its first words joined by one space."""
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    start = F.when(F.col("part") > 0, F.array(F.array_join(F.slice(words, 1, F.col("part").cast("int")), " "))).otherwise(F.array().cast("array<string>"))
    return mixed.select("*", F.posexplode(F.concat(F.array_repeat(F.col(text), F.when(F.col("size") > 0, F.col("copies")).otherwise(0).cast("int")), start)).alias("copy", "mixed_text"))
