"""Options for the external systems: Kafka, Cassandra and Elasticsearch.

Their connector packages have to be on the session's classpath. Every address is
a parameter. Writers take a DataFrame and can stand wherever a table's
``append`` or a folder writer stands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.entities import ENTITIES, Entity

KAFKA = "kafka"
CASSANDRA = "org.apache.spark.sql.cassandra"
WRITE_TIME = "written_at"
ELASTICSEARCH = "org.elasticsearch.spark.sql"


def kafka_read_options(
    servers: str,
    topics: Iterable[str],
    starting: str = "earliest",
    per_batch: int | None = None,
    tasks: int | None = None,
) -> dict[str, str]:
    """``per_batch`` bounds the messages of one batch, not those of the stream.
    ``tasks`` above the number of topic partitions splits large partitions."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    if tasks:
        options["minPartitions"] = str(tasks)
    return options


def kafka_stream(spark: SparkSession, servers: str, *topics: str, **more) -> DataFrame:
    options = kafka_read_options(servers, topics, **more)
    return spark.readStream.format(KAFKA).options(**options).load()


def kafka_writer(servers: str) -> Callable[[DataFrame], None]:
    """Batch writer; the topic is a column of the messages."""

    def write(messages: DataFrame) -> None:
        out = messages.select("topic", "value").write.format(KAFKA)
        out.option("kafka.bootstrap.servers", servers).save()

    return write


def cassandra_options(keyspace: str, table: str, host: str | None = None) -> dict[str, str]:
    options = {"keyspace": keyspace, "table": table}
    return {**options, "spark.cassandra.connection.host": host} if host else options


def cassandra_table(spark: SparkSession, keyspace: str, table: str, host: str) -> DataFrame:
    return spark.read.format(CASSANDRA).options(**cassandra_options(keyspace, table, host)).load()


def cassandra_ddl(keyspace: str, replicas: int = 1) -> list[str]:
    """Statements for the keyspace and, per entity, its transformed and its raw table."""
    statements = [
        f"CREATE KEYSPACE IF NOT EXISTS {keyspace} WITH replication = "
        f"{{'class': 'SimpleStrategy', 'replication_factor': {replicas}}}"
    ]
    for entity in ENTITIES.values():
        for table, ddl in ((entity.name, entity.table_ddl), (raw_name(entity), entity.message)):
            columns = []
            for field in T.StructType.fromDDL(ddl):
                kind = field.dataType.simpleString().replace("string", "text")
                columns.append(f"{field.name} {'uuid' if field.name in entity.uuids else kind}")
            body = ", ".join([*columns, f"PRIMARY KEY ({entity.key})"])
            statements.append(f"CREATE TABLE IF NOT EXISTS {keyspace}.{table} ({body})")
    return statements


def raw_name(entity: Entity) -> str:
    """Raw rows have a table of their own, so they never replace transformed ones."""
    return f"raw_{entity.name}"


def write_time(timestamp: Column, offset: Column) -> Column:
    """When a version was written, in microseconds, as the store takes it: of two versions
    of a key the one with the greater time stays, whichever arrives last.

    Brokers stamp messages to the millisecond. The microseconds they leave open hold the
    end of the offset, so versions of one millisecond keep their order too, but where a
    thousand of offsets ends between them. Without a timestamp there is no write time.
    """
    micros = F.unix_micros(timestamp)
    return F.when(micros % 1000 == 0, micros + F.pmod(offset, F.lit(1000))).otherwise(micros)


def cassandra_writer(
    keyspace: str,
    table: str,
    columns: Iterable[str],
    host: str | None = None,
    *,
    by_position: bool = False,
) -> Callable[[DataFrame], None]:
    """Append, which on a table with a primary key inserts or replaces.

    ``by_position`` gives each row the write time of its message (its columns
    ``timestamp`` and ``offset``), so that a late older version never replaces a newer
    one; otherwise the time of writing counts.
    """
    names, options = list(columns), cassandra_options(keyspace, table, host)
    if by_position:
        options["writetime"] = WRITE_TIME

    def write(rows: DataFrame) -> None:
        chosen = written_columns(rows, names, by_position)
        chosen.write.format(CASSANDRA).options(**options).mode("append").save()

    return write


def written_columns(rows: DataFrame, names: Iterable[str], by_position: bool) -> DataFrame:
    """What is sent of ``rows``: the table's columns and, if wanted, the write time."""
    own = [F.col(name) for name in names]
    if by_position:
        own.append(write_time(F.col("timestamp"), F.col("offset")).alias(WRITE_TIME))
    return rows.select(*own)


def index_options(nodes: str, port: int = 9200) -> dict[str, str]:
    """A document that the index refuses is logged and passed over; the others of its
    table are written."""
    return {
        "es.write.rest.error.handlers": "log",
        "es.write.rest.error.handler.log.logger.name": "tillstream.index",
        "es.nodes": nodes,
        "es.port": str(port),
        "es.mapping.id": "id",
        "es.write.operation": "index",
        "es.index.auto.create": "true",
        "es.http.timeout": "30s",
    }


def index_writer(nodes: str, index: str, port: int = 9200) -> Callable[[DataFrame], None]:
    """Bulk writes per partition; a document replaces the one with its id."""
    options = index_options(nodes, port)

    def write(documents: DataFrame) -> None:
        documents.write.format(ELASTICSEARCH).options(**options).mode("append").save(index)

    return write
