"""Tables that grow by micro-batches and are read by key: runs of bucketed Parquet, merged when read.

A micro-batch adds one run, a folder with its rows dealt into ``bucket=<b>`` by a hash of the key, so what a batch writes
follows the batch and not the table. Rows of a key may be in several runs; ``combine`` (latest wins, distinct, sums)
makes one of them when the table is read and when runs are merged. Merging is tiered by size: ``fanout`` runs of a tier
become one of the next, so there are about ``fanout`` * log(rows) runs and a row is rewritten log(rows) times.

A run has about one bucket for every ``bucket_rows`` rows, in powers of two. A read by keys opens the buckets of those keys
alone: as many files as keys and runs at most, each of bounded size, however long the history is.

The runs that make up the table are listed in a numbered log file per state, published by a rename. Readers take
the newest; a state's folders are deleted when the newest ``keep`` states do not list them, so a reader that planned on
one of those finds its files. A replayed batch drops its own earlier run (same batch number) and writes a new one;
runs are merged before a batch adds its own, so a merged run never holds rows of a batch that may be replayed.
One writer at a time (a streaming query); a concurrent one fails at the log's next number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from vigil.sources import fs

#: Up to so many buckets of a run are named one by one; a read of more opens the run as a whole.
NAMED = 10_000


@dataclass(frozen=True)
class Run:
    name: str
    batch: int  # the latest micro-batch with rows in it
    rows: int
    buckets: int


class Log:
    """The states of a table, each a numbered file that lists the folders it is made of (dicts with their particulars).
    ``folder`` gives an entry's folder below the root. The newest ``keep`` states stay readable."""

    def __init__(self, root: str, folder: Callable[[dict], str], keep: int = 3):
        self.root, self.folder, self.keep = root.rstrip("/"), folder, keep

    def states(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in fs.names(spark, f"{self.root}/_log") if n.endswith(".json"))

    def entries(self, spark: SparkSession, state: int | None = None) -> list[dict]:
        """Of the newest or a given state; nothing before the first."""
        if state is None:
            states = self.states(spark)
            if not states:
                return []
            state = states[-1]
        return json.loads(fs.read_text(spark, f"{self.root}/_log/{state:012d}.json"))

    def publish(self, spark: SparkSession, live: list[dict]) -> int:
        """``live`` as the next state. Folders that only states older than the newest ``keep`` list are deleted."""
        states = self.states(spark)
        state = states[-1] + 1 if states else 0
        fs.publish_text(spark, f"{self.root}/_log/{state:012d}.json", json.dumps(live))
        kept = states[-(self.keep - 1):] if self.keep > 1 else []
        old = [s for s in states if s not in kept]
        needed = {self.folder(r) for s in kept for r in self.entries(spark, s)} | {self.folder(r) for r in live}
        for folder in {self.folder(r) for s in old for r in self.entries(spark, s)} - needed:
            fs.delete(spark, f"{self.root}/{folder}")
        for s in old:
            fs.delete(spark, f"{self.root}/_log/{s:012d}.json")
        return state


class RunTable:
    """``schema``: the rows' columns; ``key``: the column that deals them; ``combine``: makes a frame of several runs'
    rows one of the table's (None: all rows count). ``combine`` must not depend on the runs' order."""

    def __init__(self, root: str, schema: StructType, key: str, combine: Callable[[DataFrame], DataFrame] | None = None,
                 bucket_rows: int = 1 << 16, fanout: int = 4, keep: int = 3):
        self.root, self.schema, self.key, self.combine = root.rstrip("/"), schema, key, combine
        self.bucket_rows, self.fanout = bucket_rows, fanout
        self.log = Log(root, lambda run: run["name"], keep)

    # --- the log

    def _states(self, spark: SparkSession) -> list[int]:
        return self.log.states(spark)

    def runs(self, spark: SparkSession, before: int | None = None, state: int | None = None) -> list[Run]:
        """The runs of the newest (or a given) state, of batches before ``before``."""
        return [r for r in (Run(**e) for e in self.log.entries(spark, state)) if before is None or r.batch < before]

    # --- writing

    def _write(self, rows: DataFrame, batch: int, count: int) -> Run:
        buckets = 1 << max(0, (max(count, 1) - 1) // self.bucket_rows).bit_length()
        run = Run(f"run-{batch}-{uuid.uuid4().hex[:12]}", batch, count, buckets)
        dealt = rows.select(*self.schema.names).withColumn("bucket", self._bucket(buckets))
        dealt = dealt.coalesce(1) if buckets == 1 else dealt.repartition(buckets, "bucket")
        dealt.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(f"{self.root}/{run.name}")
        return run

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def add(self, rows: DataFrame, batch: int) -> Run | None:
        """``rows`` as the run of micro-batch ``batch``, in place of an earlier run of it. No rows, no run."""
        spark = rows.sparkSession
        live = self._merged(spark, self.runs(spark, before=batch))
        rows = rows.select(*self.schema.names).persist()
        try:
            count = rows.count()
            run = self._write(rows, batch, count) if count else None
        finally:
            rows.unpersist()
        self.log.publish(spark, [asdict(r) for r in live + ([run] if run else [])])
        return run

    def _merged(self, spark: SparkSession, live: list[Run]) -> list[Run]:
        """``live`` after merging every tier that is full, small tiers first."""
        def tier(r: Run) -> int:
            n, t = r.rows, 0
            while n >= self.fanout:
                n, t = n // self.fanout, t + 1
            return t

        while True:
            tiers: dict[int, list[Run]] = {}
            for r in live:
                tiers.setdefault(tier(r), []).append(r)
            full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fanout), None)
            if full is None:
                return live
            live = [r for r in live if r not in full]
            run = self._write(self._combined(self._read(spark, full)), max(r.batch for r in full), sum(r.rows for r in full))
            live.append(replace(run, rows=self._read(spark, [run]).count()) if self.combine else run)

    # --- reading

    def _combined(self, rows: DataFrame) -> DataFrame:
        return self.combine(rows).select(*self.schema.names) if self.combine else rows

    def _read(self, spark: SparkSession, runs: list[Run], paths: dict[str, list[str]] | None = None) -> DataFrame:
        schema = StructType([*self.schema.fields]).add("bucket", IntegerType())
        parts = [spark.read.schema(schema).option("basePath", f"{self.root}/{r.name}").parquet(*(paths or {}).get(r.name, [f"{self.root}/{r.name}"])) for r in runs]
        out = spark.createDataFrame([], self.schema) if not parts else parts[0].select(*self.schema.names)
        for p in parts[1:]:
            out = out.union(p.select(*self.schema.names))
        return out

    def paths_of(self, spark: SparkSession, runs: list[Run], keys: DataFrame) -> dict[str, list[str]]:
        """By run, the folders of the buckets that may hold the key of a row of ``keys``; runs that hold none are left out.
        The driver gets the numbers of those buckets, NAMED at most; beyond that runs are opened whole."""
        most = max((r.buckets for r in runs), default=1)
        found = [r[0] for r in keys.select(self._bucket(most)).distinct().limit(NAMED + 1).collect()]
        out = {}
        for r in runs:
            if len(found) > NAMED:
                out[r.name] = [f"{self.root}/{r.name}"]
                continue
            have = set(fs.names(spark, f"{self.root}/{r.name}"))
            wanted = sorted({f"bucket={b % r.buckets}" for b in found} & have)
            if wanted:
                out[r.name] = [f"{self.root}/{r.name}/{b}" for b in wanted]
        return out

    def read(self, spark: SparkSession, before: int | None = None, keys: DataFrame | None = None, state: int | None = None) -> DataFrame:
        """The table, or with ``keys`` (a frame with the key column) what it has of those keys. Other keys of the same
        buckets are among the rows then, combined from some of the runs only: join the rows with the keys."""
        runs = self.runs(spark, before, state)
        if keys is None:
            return self._combined(self._read(spark, runs))
        paths = self.paths_of(spark, runs, keys)
        return self._combined(self._read(spark, [r for r in runs if r.name in paths], paths))


def id_index(root: str, key: str = "event_id", bucket_rows: int = 1 << 14, **options) -> RunTable:
    """The ids published so far: rows of one column, each id once."""
    return RunTable(root, StructType().add(key, "string"), key, lambda rows: rows.distinct(), bucket_rows, **options)
