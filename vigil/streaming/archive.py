"""The raw archive as a table: small files packed into large ones, states that readers can stay on, payloads as VARIANT.

``start_archive`` (consumers) appends files; a day that gets readings in every micro-batch has thousands of small ones.
``Archive`` keeps the same layout (JSON lines under ``year=/month=/day=``) with a further folder ``part=<name>`` for what one
micro-batch or one packing wrote of a day, and a numbered log (``runs.Log``) lists the parts that count. So

* a replayed micro-batch replaces its own parts, and half-written parts count for nothing;
* packing writes new parts from the lines of small files, as they are, and swaps them in by one log entry: a reader sees the
  archive before or after, never between, and one that planned on an older state finds its files while the log keeps it;
* the records of each day are known without reading any (``counts``).

The log holds an entry per day and part, so its size follows the days; files are packed into bins of ``target`` bytes, one
task and one file each, whatever the size of the day.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil.operators import consumers
from vigil.sources import fs, schemas
from vigil.streaming.medallion import INTERVAL, triggered
from vigil.streaming.runs import Log

DAY = ["year", "month", "day"]
LAYOUT = [*DAY, "part"]


@dataclass(frozen=True)
class Part:
    year: str
    month: str
    day: str
    part: str
    batch: int  # the latest micro-batch with records in it
    records: int
    files: int
    size: int

    @property
    def date(self) -> tuple[str, str, str]:
        return self.year, self.month, self.day


def _folder(part: dict) -> str:
    return "/".join(f"{c}={part[c]}" for c in LAYOUT)


def bins(sizes: dict, target: int) -> list[list]:
    """The names of ``sizes`` packed into as few bins as first fit, largest first, finds; a bin holds ``target`` at most, or one
    name."""
    out: list[list] = []
    room: list[int] = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        fit = next((i for i, r in enumerate(room) if r >= sizes[name]), None)
        if fit is None:
            out.append([])
            room.append(target)
            fit = len(out) - 1
        out[fit].append(name)
        room[fit] -= sizes[name]
    return out


class Archive:
    """``foreachBatch`` writer and reader. Every ``every`` micro-batches, before its own readings are added, the files
    under half of ``target`` bytes are packed (0: only by ``pack``). The newest ``keep`` states stay readable."""

    def __init__(self, root: str, topic: str = consumers.DEFAULT_TOPIC, target: int = 128 << 20, every: int = 10, keep: int = 3):
        self.root, self.topic, self.target, self.every = root.rstrip("/"), topic, target, every
        self.log = Log(self.root, _folder, keep)

    def parts(self, spark: SparkSession, state: int | None = None) -> list[Part]:
        return [Part(**e) for e in self.log.entries(spark, state)]

    # --- writing

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """The readings' archive records as the parts of micro-batch ``batch_id``, in place of earlier ones of it."""
        spark = batch.sparkSession
        live = [p for p in self.parts(spark) if p.batch < batch_id]
        if self.every and batch_id % self.every == self.every - 1:
            live = self._packed(spark, live)
        name = f"batch-{batch_id}-{uuid.uuid4().hex[:12]}"
        records = consumers.archive_records(batch, self.topic).withColumn("part", F.lit(name)).persist()  # a reading without a time has one day
        try:
            counted = {tuple(r[c] for c in DAY): r["n"] for r in records.groupBy(*DAY).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a day
            if counted:
                records.hint("rebalance", *DAY).write.mode("append").partitionBy(*LAYOUT).json(self.root)
        finally:
            records.unpersist()
        self._publish(spark, live + [self._part(spark, day, name, batch_id, n) for day, n in sorted(counted.items())])

    def pack(self, spark: SparkSession) -> int:
        """Packs the small files of all days, of the last micro-batch as well: not while a query may replay it."""
        return self._publish(spark, self._packed(spark, self.parts(spark)))

    def _publish(self, spark: SparkSession, live: list[Part]) -> int:
        return self.log.publish(spark, [asdict(p) for p in live])

    def _files(self, spark: SparkSession, day: tuple, name: str) -> dict[str, int]:
        return {n: size for n, size, _ in fs.stamp(spark, f"{self.root}/{_folder(dict(zip(LAYOUT, (*day, name))))}")}

    def _part(self, spark: SparkSession, day: tuple, name: str, batch: int, records: int) -> Part:
        files = self._files(spark, day, name)
        return Part(*day, name, batch, records, len(files), sum(files.values()))

    def _lines(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        schema = StructType().add("value", "string")
        for c in LAYOUT:
            schema = schema.add(c, "string")
        return spark.read.schema(schema).option("basePath", self.root).option("lineSep", "\n").text(paths)

    def _packed(self, spark: SparkSession, live: list[Part]) -> list[Part]:
        """``live`` with the small parts of each day that has several small files written anew as one part."""
        days: dict[tuple, list[Part]] = {}
        for p in live:
            if p.size < p.files * self.target / 2:
                days.setdefault(p.date, []).append(p)
        days = {d: ps for d, ps in days.items() if sum(p.files for p in ps) > max(1, -(-sum(p.size for p in ps) // self.target))}
        if not days:
            return live
        name = f"packed-{uuid.uuid4().hex[:12]}"
        deal, number = [], 0
        for day, ps in days.items():
            sizes = {(p.part, n): size for p in ps for n, size in self._files(spark, day, p.part).items()}
            for held in bins(sizes, self.target):
                deal += [(*day, part, file, number) for part, file in held]
                number += 1
        olds = {p for ps in days.values() for p in ps}
        lines = self._lines(spark, [f"{self.root}/{_folder(asdict(p))}" for p in olds]).select("*", F.col("_metadata.file_name").alias("_file"))
        dealt = lines.join(spark.createDataFrame(deal, ", ".join(f"{c} string" for c in [*LAYOUT, "_file"]) + ", _bin int"), [*LAYOUT, "_file"])
        dealt = dealt.repartitionById(number, F.col("_bin")).select("value", *DAY, F.lit(name).alias("part"))
        dealt.write.mode("append").option("lineSep", "\n").partitionBy(*LAYOUT).text(self.root)
        packed = [self._part(spark, day, name, max(p.batch for p in ps), sum(p.records for p in ps)) for day, ps in days.items()]
        return [p for p in live if p not in olds] + packed

    # --- reading

    def read(self, spark: SparkSession, state: int | None = None, days: list[tuple[str, str, str]] | None = None) -> DataFrame:
        """The archive as of the newest or a given state, whole or of the given (year, month, day)."""
        wanted = None if days is None else set(days)
        paths = [f"{self.root}/{_folder(asdict(p))}" for p in self.parts(spark, state) if wanted is None or p.date in wanted]
        if not paths:
            return spark.createDataFrame([], schemas.ARCHIVE)
        schema = StructType([*schemas.ARCHIVE.fields]).add("part", "string")
        return spark.read.schema(schema).option("basePath", self.root).json(paths).drop("part")

    def counts(self, spark: SparkSession, state: int | None = None) -> DataFrame:
        """Records by day, from the log alone."""
        days = [(*p.date, p.records) for p in self.parts(spark, state)]
        return spark.createDataFrame(days, "year string, month string, day string, n long").groupBy(*DAY).agg(F.sum("n").alias("archived_events"))


def start_archive(stream: DataFrame, archive: Archive, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    return triggered(stream.writeStream.foreachBatch(archive).option("checkpointLocation", checkpoint), available_now, interval).start()


# --- payloads as received, with fields that no schema names -------------------------------------------------------

KNOWN = tuple(f.name for f in schemas.EVENT.fields)


def payloads(archive: DataFrame) -> DataFrame:
    """``payload``: the message as VARIANT; NULL where the text is no JSON (or repeats a key). The text stays beside it."""
    return archive.withColumn("payload", F.try_parse_json("raw_text"))


def malformed(archive: DataFrame) -> DataFrame:
    return payloads(archive).where("payload IS NULL").drop("payload")


def unknown_fields(archive: DataFrame, known: tuple[str, ...] = KNOWN) -> DataFrame:
    """A row for each field of a message that the schema does not name: ``field``, ``value`` (VARIANT), ``kind`` (its type).
    Messages that are no JSON objects have none."""
    names = ", ".join("'" + k.replace("\\", "\\\\").replace("'", "\\'") + "'" for k in known)
    fields = payloads(archive).withColumn("_fields", F.expr("try_variant_get(payload, '$', 'map<string, variant>')"))
    others = F.expr(f"map_filter(_fields, (k, v) -> k NOT IN ({names}))")
    out = fields.select("*", F.explode(others).alias("field", "value")).drop("_fields", "payload")
    return out.withColumn("kind", F.schema_of_variant("value"))


def field_summary(archive: DataFrame, known: tuple[str, ...] = KNOWN) -> DataFrame:
    """How many messages have each unknown field, by its type."""
    return unknown_fields(archive, known).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))
