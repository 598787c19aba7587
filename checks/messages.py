"""Topics made from the driver's tables: one message per row, in the envelope columns.

Every message comes from its own row, so a topic is as large as its table and no row is moved to
make it. Offsets grow within a partition but may have gaps, as in a compacted topic.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables import ENVELOPE, to_avro_message, to_json_message

PARTITIONS = 4

# A line of an order, with maps, arrays and records inside both.
SHIPMENT = {
    "type": "record",
    "name": "Shipment",
    "namespace": "example.orders",
    "fields": [
        {"name": "order", "type": "long"},
        {"name": "flags", "type": {"type": "array", "items": "string"}},
        {"name": "cents", "type": {"type": "map", "values": "int"}},
        {
            "name": "stops",
            "type": {
                "type": "array",
                "items": {
                    "type": "record",
                    "name": "Stop",
                    "fields": [{"name": "status", "type": "string"}, {"name": "day", "type": "int"}],
                },
            },
        },
        {"name": "quantity", "type": ["null", "double"]},
        {"name": "labels", "type": {"type": "map", "values": "string"}},
        {
            "name": "parties",
            "type": {
                "type": "map",
                "values": {
                    "type": "record",
                    "name": "Party",
                    "fields": [{"name": "number", "type": "long"}],
                },
            },
        },
        {"name": "remark", "type": ["string", "null"]},
    ],
}

# The same columns as a table schema, for JSON messages.
SHIPMENT_COLUMNS = {
    "order": "LONG",
    "flags": "array<string>",
    "cents": "map<string,int>",
    "stops": "array<struct<status:string,day:int>>",
    "quantity": "DOUBLE",
    "labels": "map<string,string>",
    "parties": "map<string,struct<number:bigint>>",
    "remark": "STRING",
}

ACTION = {
    "type": "record",
    "name": "Action",
    "namespace": "example.events",
    "fields": [
        {"name": "kind", "type": "string"},
        {"name": "number", "type": "long"},
        {"name": "visitor", "type": "int"},
    ],
}

# A wide record where everything may be null, with a nullable map, array and record.
CUSTOMER = {
    "type": "record",
    "name": "Customer",
    "namespace": "example.people",
    "fields": [
        {"name": "key", "type": "long"},
        {"name": "name", "type": ["null", "string"]},
        {"name": "nation", "type": ["int", "null"]},
        {"name": "balance", "type": ["null", "double"]},
        {"name": "tags", "type": ["null", {"type": "map", "values": "string"}]},
        {"name": "codes", "type": ["null", {"type": "array", "items": ["null", "int"]}]},
        {
            "name": "segment",
            "type": [
                "null",
                {
                    "type": "record",
                    "name": "Segment",
                    "fields": [
                        {"name": "label", "type": "string"},
                        {"name": "nation", "type": ["null", "int"]},
                    ],
                },
            ],
        },
    ],
}

DOCUMENT = {
    "type": "record",
    "name": "Document",
    "fields": [
        {"name": "id", "type": "long"},
        {"name": "text", "type": "string"},
        {"name": "lang", "type": ["null", "string"]},
    ],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as a stream; the path is a glob because it may name a single file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def envelope(
    rows: DataFrame,
    topic: str,
    value: Column,
    *,
    partition_by: Column,
    offset: Column,
    timestamp: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """One message per row of `rows`."""
    columns = {
        "key": F.lit(None) if key is None else key,
        "value": value,
        "topic": F.lit(topic),
        "partition": F.pmod(partition_by, F.lit(PARTITIONS)),
        "offset": offset,
        "timestamp": F.lit("2024-01-01 00:00:00") if timestamp is None else timestamp,
        "timestampType": F.lit(0),
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE])


def event_lines(events: DataFrame) -> DataFrame:
    """Delimited: id, type, user, and a map with the type and the user."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    line = F.concat_ws(
        "\t",
        F.col("event_id").cast("string"),
        kind,
        user,
        F.concat(F.lit("eventType:"), kind, F.lit(",userId:"), user),
    )
    return event_topic(events, "event_lines", line)


def event_topic(events: DataFrame, topic: str, value: Column) -> DataFrame:
    return envelope(
        events,
        topic,
        value,
        partition_by=F.col("user_id"),
        offset=F.col("event_id"),
        timestamp=F.col("ts"),
        key=F.col("user_id").cast("string"),
    )


def event_props(events: DataFrame) -> DataFrame:
    """JSON: the `props` text as it is."""
    return event_topic(events, "event_props", F.col("props"))


def shipment_rows() -> Column:
    """An order line as a nested record."""
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return F.struct(
        F.col("l_orderkey").alias("order"),
        F.array(flag, status).alias("flags"),
        F.create_map(F.lit("price"), F.round(F.col("l_extendedprice") * 100).cast("int")).alias("cents"),
        F.array(
            F.struct(status.alias("status"), day.alias("day")),
            F.struct(flag.alias("status"), (day + 1).alias("day")),
        ).alias("stops"),
        F.when(flag != "N", F.col("l_quantity")).alias("quantity"),
        F.create_map(F.lit("flag"), flag, F.lit("status"), status).alias("labels"),
        F.create_map(
            F.lit("part"), F.struct(F.col("l_partkey").alias("number")),
            F.lit("line"), F.struct(F.col("l_linenumber").cast("bigint").alias("number")),
        ).alias("parties"),
        F.when(status == "F", F.concat_ws("/", flag, status)).alias("remark"),
    )


def shipments(lineitem: DataFrame, encode=to_json_message) -> DataFrame:
    """Nested maps, arrays and records from the order lines, as JSON or otherwise encoded."""
    key = F.col("l_orderkey")
    value = encode(shipment_rows())
    return envelope(
        lineitem, "shipments", value, partition_by=key, offset=key * 8 + F.col("l_linenumber")
    )


def avro_shipments(lineitem: DataFrame) -> DataFrame:
    return shipments(lineitem, lambda row: to_avro_message(row, SHIPMENT))


def customer_row() -> Column:
    """A record whose fields are null for some segments and balances."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return F.struct(
        key.alias("key"),
        F.when(balance >= 0, F.col("c_name")).alias("name"),
        F.when(segment != "BUILDING", nation).alias("nation"),
        F.when(balance < 5000, balance).alias("balance"),
        F.when(segment != "MACHINERY", F.create_map(F.lit("segment"), segment)).alias("tags"),
        F.when(segment != "FURNITURE", F.array(F.when(balance >= 0, nation), nation)).alias("codes"),
        F.when(
            segment != "HOUSEHOLD",
            F.struct(segment.alias("label"), F.when(balance >= 0, nation).alias("nation")),
        ).alias("segment"),
    )


def customer_records(customer: DataFrame) -> DataFrame:
    """Avro."""
    key = F.col("c_custkey")
    value = to_avro_message(customer_row(), CUSTOMER)
    return envelope(customer, "customers", value, partition_by=key, offset=key)


def customer_objects(customer: DataFrame) -> DataFrame:
    """JSON."""
    key = F.col("c_custkey")
    value = to_json_message(customer_row())
    return envelope(customer, "customers", value, partition_by=key, offset=key)


def accounts(customer: DataFrame) -> DataFrame:
    """JSON: holder, balance and a map of attributes; one segment has no balance."""
    key = F.col("c_custkey")
    record = F.struct(
        key.cast("string").alias("account"),
        F.col("c_name").alias("holder"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).alias("balance"),
        F.create_map(
            F.lit("country"),
            F.col("c_nationkey").cast("string"),
            F.lit("segment"),
            F.col("c_mktsegment"),
        ).alias("attributes"),
    )
    return envelope(customer, "accounts", to_json_message(record), partition_by=key, offset=key)


def embedding_objects(embeddings: DataFrame) -> DataFrame:
    """JSON: an array of numbers."""
    record = F.struct(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label"))
    key = F.col("vec_id")
    return envelope(
        embeddings, "embeddings", to_json_message(record), partition_by=key, offset=key
    )


def document_records(documents: DataFrame) -> DataFrame:
    """Avro: whole texts."""
    record = F.struct(F.col("doc_id").alias("id"), F.col("text"), F.col("lang"))
    key = F.col("doc_id")
    value = to_avro_message(record, DOCUMENT)
    return envelope(documents, "documents", value, partition_by=key, offset=key)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and outputs, in the shared folder the cluster names.

    Only a session whose executors are in its own process may do without one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="topictables-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def forget_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """The state of a query that stopped after its last batch was written and before that was noted."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    last = max(int(n) for n in names if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        files.delete(hadoop.Path(folder, name), False)
