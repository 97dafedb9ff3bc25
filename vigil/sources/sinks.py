"""External sinks: Kafka topic (keyed JSON records) and JDBC tables.

Both are configuration over Spark's own connectors; the connector jars / database drivers are not part of this
package and must be on the cluster's classpath. Neither is exercised by the tests here: no broker or database server
is started for them (the data side -- the ``(key, value)`` frame and the refined rows -- is tested instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vigil.sources import envelope


def start_kafka_sink(readings: DataFrame, servers: str, topic: str, checkpoint: str,
                     key: str = "device_id") -> StreamingQuery:
    """Publish readings keyed by device (per-device order within a partition), JSON values, all replicas ack."""
    records = envelope.keyed_records(readings, key)
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
                   .option("kafka.acks", "all").option("checkpointLocation", checkpoint).start())


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
               driver: str | None = None, mode: str = "append", batch_size: int = 10000,
               num_partitions: int | None = None) -> None:
    """Append a frame to a JDBC table. Failures raise (no swallowed errors): inside ``foreachBatch`` the micro-batch
    is then retried from the checkpoint. ``num_partitions`` bounds concurrent connections."""
    w = df.coalesce(num_partitions) if num_partitions else df
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    w.write.format("jdbc").options(**opts).mode(mode).save()
