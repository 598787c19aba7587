"""One query per operator, over topics made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import messages as m
from topictables import (
    EARLIEST,
    GROUP,
    LATEST,
    SPECIFIC,
    Catalog,
    ObservedOffsets,
    append_messages,
    avro_table,
    avro_topic,
    commit_offsets,
    committed_offsets,
    console,
    delimited_results,
    delimited_table,
    end_offsets,
    files,
    fixed,
    good_rows,
    indexed_topic,
    json_results,
    json_table,
    json_topic,
    json_versions_table,
    keyed,
    map_field,
    map_value,
    nth,
    nth_field,
    read_output,
    register_table,
    rejected,
    routed,
    start,
    start_all,
    start_at,
    start_together,
    table_topic,
    variant_paths,
    variant_schema,
    with_proctime,
    with_rowtime,
    without_repeats,
    write,
)

MIDDLE = "2024-01-15 00:00:00"

LINE_SCHEMA = {
    "id": "LONG",
    "name": "STRING",
    "user": "LONG",
    "event": "map<string,string>",
}
ACCOUNT_SCHEMA_TEXT = """{
    'type': 'object',
    'properties': {
        'balance': {'type': 'number', 'maximum': 1000000},
        'account': {'type': 'string', 'description': 'number of the account'},
        'holder': {'type': 'string'}
    },
    'required': ['account']
}"""
ACCOUNT_SCHEMA = {"account": "STRING", "holder": "STRING", "balance": "BIG_DEC"}
CONSTRAINED_TEXT = """{
    "type": "object",
    "required": ["account", "balance"],
    "properties": {
        "account": {"type": "string", "pattern": "^[0-9]+$", "maxLength": 3},
        "holder": {"type": "string", "minLength": 1},
        "balance": {"type": "number", "minimum": 0, "exclusiveMaximum": 9000},
        "attributes": {
            "type": "object",
            "required": ["country"],
            "properties": {
                "country": {"type": "string", "not": {"pattern": "^2[0-9]$"}},
                "segment": {"type": "string", "enum": ["BUILDING", "AUTOMOBILE", "HOUSEHOLD"]}
            }
        }
    }
}"""
CUSTOMER_COLUMNS = {
    "key": "LONG",
    "name": "STRING",
    "nation": "INT",
    "balance": "DOUBLE",
    "segment": "struct<label:string,nation:int>",
}


# ---------------------------------------------------------------- tables over topics


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = m.event_lines(m.table(spark, sf_dir, "events"))
    return delimited_table(table_topic(messages, "event_lines"), LINE_SCHEMA)


def shipments(spark: SparkSession, sf_dir: str, schema=None, **options) -> DataFrame:
    messages = m.shipments(m.table(spark, sf_dir, "lineitem"))
    return json_table(table_topic(messages, "shipments"), schema or m.SHIPMENT_COLUMNS, **options)


def customer_objects(spark: SparkSession, sf_dir: str, schema, **options) -> DataFrame:
    messages = m.customer_objects(m.table(spark, sf_dir, "customer"))
    return json_table(table_topic(messages, "customers"), schema, **options)


def account_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_topic(m.accounts(m.table(spark, sf_dir, "customer")), "accounts")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_table(
        account_messages(spark, sf_dir), ACCOUNT_SCHEMA, json_schema_text=ACCOUNT_SCHEMA_TEXT
    )


# ---------------------------------------------------------------- sources


def topic_scan(spark, sf_dir):
    messages = table_topic(m.event_props(m.table(spark, sf_dir, "events")), "event_props")
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("timestamp_us"),
    )


def delimited_source(spark, sf_dir):
    lines = event_lines(spark, sf_dir)
    return lines.filter(map_value("event", "eventType") == "purchase").select("id", "name", "user")


def avro_source(spark, sf_dir):
    messages = table_topic(m.avro_shipments(m.table(spark, sf_dir, "lineitem")), "shipments")
    columns = ["order", "remark", "quantity", "labels", "cents", "stops", "parties"]
    table = avro_table(messages, m.SHIPMENT, columns=columns)
    return table.select(
        "order",
        "remark",
        "quantity",
        map_value("labels", "status").alias("status"),
        map_value("cents", "price").alias("price"),
        nth_field("stops", 2, "day").alias("second_day"),
        map_field("parties", "part", "number").alias("part"),
    )


def json_source(spark, sf_dir):
    messages = table_topic(m.event_props(m.table(spark, sf_dir, "events")), "event_props")
    return json_table(messages, {"k": "INT"}, keep=["offset"])


def json_map_filter(spark, sf_dir):
    schema = {"account": "STRING", "holder": "STRING", "attributes": "map<string,string>"}
    table = json_table(account_messages(spark, sf_dir), schema)
    return table.filter(map_value("attributes", "segment") == "BUILDING").select("holder")


def json_schema_source(spark, sf_dir):
    table = accounts(spark, sf_dir)
    return table.select("account", "holder", F.col("balance").cast("double").alias("balance"))


def start_earliest(spark, sf_dir):
    return _started_at(spark, sf_dir, start_at(EARLIEST))


def start_latest(spark, sf_dir):
    """"Now" is the end of the messages before the middle of the month."""
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    ends = end_offsets(messages.filter(F.col("timestamp") < MIDDLE))
    return _started_at(spark, sf_dir, start_at(LATEST, ends))


def start_latest_stream(spark, sf_dir):
    """The same as a stream: it gets what has come since "now"."""
    path = m.scratch(spark, "latest")
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    ends = end_offsets(messages.filter(F.col("timestamp") < MIDDLE))
    arriving = m.event_props(m.table_stream(spark, sf_dir, "events"))
    rows = table_topic(arriving, "event_props", start_at(LATEST, ends)).select("partition", "offset")
    start(rows, files(f"{path}/rows"), f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def start_specific_offsets(spark, sf_dir):
    return _started_at(spark, sf_dir, start_at(SPECIFIC, {0: 23, 1: 500, 3: 0}))


def start_group_offsets(spark, sf_dir):
    """The group has read the messages before the middle of the month."""
    path = m.scratch(spark, "offsets")
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    commit_offsets(messages.filter(F.col("timestamp") < MIDDLE), path, "readers")
    offsets = committed_offsets(spark, path, "readers", "event_props")
    return _started_at(spark, sf_dir, start_at(GROUP, offsets))


def group_offsets_observed(spark, sf_dir):
    """The same position, committed from what the reading stream observes while its batches pass."""
    path = m.scratch(spark, "observed")
    read = m.event_props(m.table_stream(spark, sf_dir, "events").filter(F.col("ts") < MIDDLE))
    group = ObservedOffsets(spark, f"{path}/offsets", "readers", "event_props", m.PARTITIONS)
    rows = group.observed(table_topic(read, "event_props")).select("partition", "offset")
    query = start(rows, files(f"{path}/rows"), f"{path}/checkpoint", available_now=True)
    query.awaitTermination()
    group.commit(query)
    offsets = committed_offsets(spark, f"{path}/offsets", "readers", "event_props")
    return _started_at(spark, sf_dir, start_at(GROUP, offsets))


def start_by_index(spark, sf_dir):
    """A topic that was stored in four parts; only files that reach the start are opened."""
    path = m.scratch(spark, "indexed")
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    for week in range(4):
        day = F.dayofmonth("timestamp")
        append_messages(messages.filter(F.least(F.floor((day - 1) / 7), F.lit(3)) == week), path)
    position = start_at(SPECIFIC, {0: 23, 1: 500, 3: 0})
    return indexed_topic(spark, path, "event_props", position).select("partition", "offset")


def _started_at(spark, sf_dir, position):
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    return table_topic(messages, "event_props", position).select("partition", "offset")


# ---------------------------------------------------------------- delimited rules


def delimited_ragged(spark, sf_dir):
    """Order lines with all fields and one too many, with too few, or with empty ones at the end."""
    orders = m.table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    front = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    rest = F.concat(F.lit("\t"), F.col("o_custkey").cast("string"), F.lit("\tstatus:"), status)
    line = (
        F.when(status == "F", F.concat(front, rest, F.lit("\textra")))
        .when(status == "O", front)
        .otherwise(F.concat(front, F.lit("\t\t\t")))
    )
    key = F.col("o_orderkey")
    messages = m.envelope(orders, "orders", line, partition_by=key, offset=key)
    schema = {
        "id": "LONG",
        "priority": "STRING",
        "customer": "LONG",
        "event": "map<string,string>",
    }
    table = delimited_table(table_topic(messages, "orders"), schema)
    return table.select("id", "priority", "customer", map_value("event", "status").alias("status"))


def _map_lines(spark, sf_dir):
    lines = m.table(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    entries = F.concat(
        F.lit("flag:first,status:"), status, F.lit(":more,mark,,"), F.lit("flag:"), flag, F.lit(",,")
    )
    text = F.concat(F.col("l_orderkey").cast("string"), F.lit("\t"), entries)
    key = F.col("l_orderkey")
    messages = m.envelope(lines, "lines", text, partition_by=key, offset=key)
    return delimited_table(
        table_topic(messages, "lines"), {"id": "LONG", "event": "map<string,string>"}
    )


def delimited_map(spark, sf_dir):
    """Maps with a repeated key, an extra part, an entry without a value and an empty entry."""
    table = _map_lines(spark, sf_dir)
    return table.select(
        "id",
        map_value("event", "flag").alias("flag"),
        map_value("event", "status").alias("status"),
        map_value("event", "mark").alias("mark"),
        map_value("event", "").alias("blank"),
        map_value("event", "none").alias("missing"),
        F.size("event").alias("entries"),
    )


def delimited_select_star(spark, sf_dir):
    """All columns of the lines whose map has a value, the map as JSON in the order of its keys."""
    register_table(event_lines(spark, sf_dir), "event_line_table")
    rows = spark.sql("SELECT * FROM event_line_table WHERE event['eventType'] = 'purchase'")
    entries = F.array_sort(F.map_entries("event"))
    pairs = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.withColumn("event", F.concat_ws(";", pairs))


def delimited_types(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    line = F.concat_ws(
        "\t",
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_totalprice").cast("string"),
        F.col("o_orderkey").cast("string"),
        F.date_format(day, "yyyy-M-d"),
        F.date_format(day, "HH:mm:ss'Z'"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("yes"),
        F.col("o_totalprice").cast("string"),
    )
    schema = {
        "id": "LONG",
        "customer": "INT",
        "price": "BIG_DEC",
        "big": "BIG_INT",
        "day": "SQL_DATE",
        "clock": "SQL_TIME",
        "moment": "SQL_TIMESTAMP",
        "filled": "BOOLEAN",
        "price_double": "DOUBLE",
    }
    key = F.col("o_orderkey")
    messages = m.envelope(orders, "orders", line, partition_by=key, offset=key)
    table = delimited_table(table_topic(messages, "orders"), schema)
    return table.select(
        "id",
        "customer",
        F.col("price").cast("double").alias("price"),
        F.col("big").cast("bigint").alias("big"),
        F.unix_date("day").alias("day"),
        "clock",
        F.unix_micros(F.col("moment").cast("timestamp")).alias("moment_us"),
        "filled",
        "price_double",
    )


def delimited_custom_delims(spark, sf_dir):
    parts = m.table(spark, sf_dir, "part")
    line = F.concat(
        F.col("p_partkey").cast("string"),
        F.lit("|"),
        F.col("p_name"),
        F.lit("|brand="),
        F.col("p_brand"),
        F.lit(";type="),
        F.col("p_type"),
        F.lit(";size="),
        F.col("p_size").cast("string"),
    )
    key = F.col("p_partkey")
    messages = m.envelope(parts, "parts", line, partition_by=key, offset=key)
    table = delimited_table(
        table_topic(messages, "parts"),
        {"id": "LONG", "name": "STRING", "event": "map<string,string>"},
        field_delimiter="|",
        entry_delimiter=";",
        key_delimiter="=",
    )
    return table.select(
        "id",
        "name",
        map_value("event", "brand").alias("brand"),
        map_value("event", "type").alias("type"),
        map_value("event", "size").cast("int").alias("size"),
    )


def delimited_permissive(spark, sf_dir):
    """Amounts with a fraction are no integers: their rows are null throughout."""
    lines = m.table(spark, sf_dir, "lineitem")
    amount = F.when(
        F.col("l_returnflag") == "R", F.col("l_quantity").cast("int").cast("string")
    ).otherwise(F.col("l_quantity").cast("string"))
    text = F.concat_ws("\t", F.col("l_orderkey").cast("string"), amount)
    key = F.col("l_orderkey")
    messages = m.envelope(lines, "lines", text, partition_by=key, offset=key)
    return delimited_table(
        table_topic(messages, "lines"), {"id": "LONG", "amount": "INT"}, mode="PERMISSIVE"
    )


def avro_permissive(spark, sf_dir):
    """Every third message is cut short: their rows are null throughout."""
    messages = m.customer_records(m.table(spark, sf_dir, "customer"))
    table = avro_table(
        table_topic(_cut_some(messages), "customers"),
        m.CUSTOMER,
        columns=["key", "name"],
        mode="PERMISSIVE",
        keep=["offset"],
    )
    return table.select("offset", "key", "name")


def _cut_some(messages):
    """The last byte of every third message is missing."""
    short = F.expr("substring(value, 1, length(value) - 1)")
    value = F.when(F.col("offset") % 3 == 0, short).otherwise(F.col("value"))
    return messages.withColumn("value", value)


def json_permissive(spark, sf_dir):
    """Every third message is cut short: their rows are null throughout."""
    messages = table_topic(_cut_some(m.accounts(m.table(spark, sf_dir, "customer"))), "accounts")
    schema = {"account": "STRING", "holder": "STRING"}
    return json_table(messages, schema, mode="PERMISSIVE", keep=["offset"])


# ---------------------------------------------------------------- nested access


def map_lookup_filter(spark, sf_dir):
    table = shipments(spark, sf_dir, columns=["order", "remark", "quantity", "labels"])
    return table.filter(map_value("labels", "flag") == "R").select("order", "remark", "quantity")


def array_element(spark, sf_dir):
    messages = m.embedding_objects(m.table(spark, sf_dir, "embeddings"))
    schema = {"id": "LONG", "vector": "array<float>", "label": "INT"}
    table = json_table(table_topic(messages, "embeddings"), schema)
    return table.select(
        "id",
        nth("vector", 1).cast("double").alias("first"),
        nth("vector", 3).cast("double").alias("third"),
        nth("vector", 1000).cast("double").alias("past_the_end"),
        "label",
    )


def struct_field(spark, sf_dir):
    table = customer_objects(spark, sf_dir, CUSTOMER_COLUMNS, columns=["key", "segment"])
    return table.select("key", "segment.label", F.col("segment").getField("nation").alias("nation"))


def map_struct_field(spark, sf_dir):
    table = shipments(spark, sf_dir, columns=["order", "parties"])
    return table.filter(map_field("parties", "line", "number") == 3).select(
        "order", map_field("parties", "part", "number").alias("part")
    )


def array_struct_field(spark, sf_dir):
    table = shipments(spark, sf_dir, columns=["order", "stops"])
    return table.filter(nth_field("stops", 1, "status") == "F").select(
        "order", nth_field("stops", 2, "status").alias("flag")
    )


def nested_conjunction(spark, sf_dir):
    used = ["order", "quantity", "remark", "stops", "flags", "labels", "parties"]
    register_table(shipments(spark, sf_dir, columns=used), "shipment_table")
    return spark.sql(
        """SELECT order, quantity, remark FROM shipment_table
           WHERE try_element_at(stops, 1).status = 'F' AND try_element_at(flags, 1) <> 'N'
             AND labels['flag'] = 'A' AND parties['line'].number BETWEEN 2 AND 4"""
    )


def nullable_fields(spark, sf_dir):
    messages = m.customer_records(m.table(spark, sf_dir, "customer"))
    table = avro_table(table_topic(messages, "customers"), m.CUSTOMER)
    return table.select(
        "key",
        "name",
        "nation",
        "balance",
        map_value("tags", "segment").alias("tag"),
        nth("codes", 1).alias("first_code"),
        nth("codes", 2).alias("second_code"),
        F.size("codes").alias("codes"),
        F.col("segment").isNull().alias("no_segment"),
    )


def json_variant_paths(spark, sf_dir):
    """Paths into messages that are parsed once, without a declared schema."""
    messages = table_topic(m.shipments(m.table(spark, sf_dir, "lineitem")), "shipments")
    paths = {
        "order": ("$.order", "LONG"),
        "flag": ("$.labels.flag", "STRING"),
        "second_day": ("$.stops[1].day", "INT"),
        "part": ("$.parties.part.number", "LONG"),
        "missing": ("$.parties.nobody.number", "LONG"),
    }
    table = variant_paths(json_table(messages, as_variant=True), paths)
    return table.filter((F.col("flag") == "R") & (F.col("second_day") > 0)).select(*paths)


def json_variant_schema(spark, sf_dir):
    """The schema of the messages is found out, then used."""
    messages = table_topic(m.event_props(m.table(spark, sf_dir, "events")), "event_props")
    schema = variant_schema(json_table(messages, as_variant=True))
    table = json_table(messages, schema, as_variant=True, keep=["offset"])
    return table.select("offset", F.col("k").cast("int"))


# ---------------------------------------------------------------- rows and reasons


def json_schema_constraints(spark, sf_dir):
    """What each message breaks first of a JSON Schema, and the holder of those that break nothing."""
    results = json_results(
        account_messages(spark, sf_dir), json_schema_text=CONSTRAINED_TEXT, keep=["offset"]
    )
    return results.select("offset", "reason", F.col("row.holder").alias("holder"))


def _spoiled_accounts(spark, sf_dir):
    """Some messages without bytes, some cut short, some with a word for a number."""
    messages = m.accounts(m.table(spark, sf_dir, "customer"))
    text, number = F.col("value").cast("string"), F.col("offset")
    word = F.regexp_replace(text, '"balance":[^,]*', '"balance":"many"')
    value = (
        F.when(number % 5 == 0, None)
        .when(number % 3 == 0, F.expr("substring(value, 1, length(value) - 1)"))
        .when(number % 7 == 0, word.cast("binary"))
        .otherwise(F.col("value"))
    )
    return table_topic(messages.withColumn("value", value), "accounts")


def rejected_messages(spark, sf_dir):
    """Every message of a partly broken topic: its row, or the reason why it has none."""
    results = json_results(_spoiled_accounts(spark, sf_dir), ACCOUNT_SCHEMA, keep=["offset"])
    balance = F.col("row.balance").cast("double").alias("balance")
    return results.select("offset", "reason", "row.account", "row.holder", balance)


def rejected_stream(spark, sf_dir):
    """A stream of lines whose broken ones go to an output of their own."""
    path = m.scratch(spark, "rejected")
    events = m.table_stream(spark, sf_dir, "events")
    user = F.when(F.col("event_id") % 4 == 0, "nobody").otherwise(F.col("user_id").cast("string"))
    line = F.concat_ws("\t", F.col("event_id").cast("string"), user)
    messages = table_topic(m.event_topic(events, "visits", line), "visits")
    results = delimited_results(messages, {"id": "LONG", "user": "INT"}, keep=["offset"])
    outputs = [(good_rows, files(f"{path}/rows")), (rejected, files(f"{path}/rejected"))]
    start_all(results, outputs, f"{path}/checkpoint", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{path}/rows").select("id", "user")
    broken = spark.read.parquet(f"{path}/rejected").select(F.col("offset").alias("id"), "reason")
    return rows.unionByName(broken, allowMissingColumns=True)


# ---------------------------------------------------------------- tables and SQL


def project_columns(spark, sf_dir):
    register_table(event_lines(spark, sf_dir), "event_line_table")
    return spark.sql("SELECT id, name FROM event_line_table")


def select_star(spark, sf_dir):
    schema = {"account": "STRING", "holder": "STRING"}
    table = json_table(account_messages(spark, sf_dir), schema)
    register_table(table, "account_table")
    return spark.sql("SELECT * FROM account_table")


def field_mapping(spark, sf_dir):
    schema = {"customer": "LONG", "account": "DOUBLE", "country": "INT"}
    mapping = {"customer": "key", "account": "balance", "country": "nation"}
    return customer_objects(spark, sf_dir, schema, mapping=mapping)


def schema_narrowing(spark, sf_dir):
    return shipments(spark, sf_dir, {"order": "LONG", "quantity": "DOUBLE", "remark": "STRING"})


def catalog_query(spark, sf_dir):
    catalog = Catalog(spark, "topics")
    catalog.create_table("tables", accounts(spark, sf_dir), ignore_if_exists=True)
    return catalog.sql("SELECT holder FROM {topics.tables} WHERE balance > 30")


def catalog_table(spark, sf_dir):
    """A table of the catalog without SQL text."""
    catalog = Catalog(spark, "topics")
    catalog.create_table("accounts", accounts(spark, sf_dir), ignore_if_exists=True)
    return catalog.table("accounts").filter("balance <= 30").select("account", "holder")


def catalog_function(spark, sf_dir):
    """A topic from a start position on, called with arguments in SQL text."""
    catalog = Catalog(spark, "topics")
    messages = table_topic(m.event_props(m.table(spark, sf_dir, "events")), "event_props")
    table = json_table(messages, {"k": "INT"}, keep=["offset", "partition"])
    parameters = {"first": "BIGINT", "place": "INT DEFAULT 2"}
    catalog.create_function("events_from", table, parameters, "offset >= first AND partition = place")
    catalog.set_variable("least_k", "INT", 30)
    return catalog.sql("SELECT offset, k FROM events_from(500) WHERE k > least_k")


def schema_evolution(spark, sf_dir):
    """A topic of two versions: the later one renames a field, widens numbers and adds a nested field."""
    customers = m.table(spark, sf_dir, "customer")
    key, nation, balance = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    old = F.struct(
        key.alias("key"),
        F.col("c_name").alias("name"),
        F.struct(nation.alias("nation")).alias("place"),
        F.array(nation).alias("scores"),
    )
    new = F.struct(
        (key + 10_000_000_000).alias("key"),
        F.col("c_name").alias("full_name"),
        F.struct(nation.alias("nation"), F.col("c_mktsegment").alias("segment")).alias("place"),
        F.array(balance, F.lit(0.5)).alias("scores"),
    )
    value = F.when(key % 2 == 0, m.to_json_message(old)).otherwise(m.to_json_message(new))
    messages = table_topic(m.envelope(customers, "people", value, partition_by=key, offset=key), "people")
    versions = [
        (F.col("offset") % 2 == 0, "key int, name string, place struct<nation:int>, scores array<int>", None),
        (
            F.col("offset") % 2 == 1,
            "key bigint, full_name string, place struct<nation:bigint,segment:string>, scores array<double>",
            {"full_name": "name"},
        ),
    ]
    table = json_versions_table(messages, versions, {"place.segment": "unknown"})
    return table.select("key", "name", "place.nation", "place.segment", nth("scores", 1).alias("score"))


# ---------------------------------------------------------------- sinks


def avro_roundtrip(spark, sf_dir):
    rows = m.table(spark, sf_dir, "customer").select(
        F.col("c_name"), F.col("c_custkey"), F.col("c_nationkey")
    )
    sent = avro_topic("actions", m.ACTION, path="unused").rows(rows)
    return avro_table(sent, m.ACTION)


def avro_documents(spark, sf_dir):
    messages = m.document_records(m.table(spark, sf_dir, "documents"))
    return avro_table(table_topic(messages, "documents"), m.DOCUMENT)


def json_roundtrip(spark, sf_dir):
    rows = m.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    sent = json_topic("documents", path="unused").rows(rows)
    return json_table(
        sent, {"doc_id": "LONG", "text": "STRING", "lang": "STRING", "n_chars": "LONG"}
    )


def filter_gt_le_route(spark, sf_dir):
    """Three outputs of one table: balances above 30, up to 30, and all holders."""
    balance = F.col("balance")
    one = {"holder": "STRING"}
    messages = routed(
        accounts(spark, sf_dir),
        [
            (balance > 30, ["holder"], json_topic("above", schema=one, path="unused")),
            (balance <= 30, ["holder"], json_topic("up_to", schema=one, path="unused")),
            (None, ["holder"], json_topic("all", schema=one, path="unused")),
        ],
    )
    return json_table(messages, one, keep=["topic"])


def route_avro_required(spark, sf_dir):
    """Three outputs in Avro. One requires a balance, which the rows of its route all have."""

    def record(name, *fields):
        return {
            "type": "record",
            "name": name,
            "fields": [{"name": field, "type": kind} for field, kind in fields],
        }

    text, number = "string", "double"
    known = record("Known", ("holder", ["null", text]), ("balance", number))
    unknown = record("Unknown", ("holder", ["null", text]))
    every = record("Every", ("holder", ["null", text]), ("balance", ["null", number]))
    rows = accounts(spark, sf_dir).withColumn("balance", F.col("balance").cast("double"))
    balance = F.col("balance")
    messages = routed(
        rows,
        [
            (balance.isNotNull(), ["holder", "balance"], avro_topic("known", known, path="unused")),
            (balance.isNull(), ["holder"], avro_topic("unknown", unknown, path="unused")),
            (None, ["holder", "balance"], avro_topic("every", every, path="unused")),
        ],
    )
    parts = [
        avro_table(messages.filter(F.col("topic") == topic), schema, keep=["topic"])
        for topic, schema in (("known", known), ("unknown", unknown), ("every", every))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2])


def print_rows(spark, sf_dir):
    """All accounts are printed where they are computed; the rows that were sent to print."""
    rows = accounts(spark, sf_dir).select("account", "holder")
    printed = console()
    write(rows, printed)
    return printed.rows(rows)


def insert_into_sink(spark, sf_dir):
    path = m.scratch(spark, "insert")
    catalog = Catalog(spark, "topics")
    catalog.create_table("accounts", accounts(spark, sf_dir), ignore_if_exists=True)
    catalog.create_sink("output", files(path, {"holder": "STRING"}))
    catalog.insert_into("output", "SELECT holder FROM {topics.accounts} WHERE balance > 30")
    catalog.insert_into("output", "SELECT holder FROM {topics.accounts} WHERE balance <= 30")
    return spark.read.parquet(path)


def fanout_multi_sink(spark, sf_dir):
    """One stream of events into an Avro topic and a table of purchases."""
    path = m.scratch(spark, "fanout")
    lines = delimited_table(
        table_topic(m.event_lines(m.table_stream(spark, sf_dir, "events")), "event_lines"),
        LINE_SCHEMA,
    )

    def actions(rows):
        return rows.select("name", "id", F.col("user").cast("int"))

    def purchases(rows):
        return rows.filter(map_value("event", "eventType") == "purchase").select("id", "name")

    outputs = [
        (actions, avro_topic("actions", m.ACTION, path=f"{path}/actions")),
        (purchases, files(f"{path}/purchases", {"id": "LONG", "name": "STRING"})),
    ]
    start_all(lines, outputs, f"{path}/checkpoint", available_now=True).awaitTermination()
    sent = avro_table(spark.read.parquet(f"{path}/actions"), m.ACTION)
    bought = spark.read.parquet(f"{path}/purchases").select("id", "name")
    return sent.select(F.col("number").alias("id"), F.col("kind").alias("name"), F.lit("actions").alias("sink")).unionByName(
        bought.withColumn("sink", F.lit("purchases"))
    )


def fanout_two_queries(spark, sf_dir):
    """Two queries with their own checkpoints add to one path."""
    path = m.scratch(spark, "two")
    for kind in ("purchase", "view"):
        lines = delimited_table(
            table_topic(m.event_lines(m.table_stream(spark, sf_dir, "events")), "event_lines"),
            LINE_SCHEMA,
        )
        rows = lines.filter(F.col("name") == kind).select("id", "name")
        outputs = [(None, files(f"{path}/rows", {"id": "LONG", "name": "STRING"}))]
        start_all(rows, outputs, f"{path}/{kind}", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("id", "name")


def fanout_exactly_once(spark, sf_dir):
    """Two outputs of one stream whose last batch is run again, as after a failure."""
    path = m.scratch(spark, "once")
    messages = table_topic(m.event_lines(m.table_stream(spark, sf_dir, "events")), "event_lines")
    lines = delimited_table(messages, LINE_SCHEMA)
    bought = map_value("event", "eventType") == "purchase"
    sent = {"name": "STRING", "id": "LONG"}
    routes = {
        "sent": (None, ["name", "id"], json_topic("sent", schema=sent, path="unused")),
        "purchases": (bought, ["id", "user"], files("unused", {"id": "LONG", "user": "LONG"})),
    }
    for _ in range(2):
        query = start_together(lines, routes, f"{path}/out", f"{path}/state", available_now=True)
        query.awaitTermination()
        m.forget_last_batch(spark, f"{path}/state")
    topic = read_output(spark, f"{path}/out", "sent", "topic string, value binary, partition int")
    rows = json_table(topic, sent, keep=["topic"]).select("topic", "id", "name")
    purchases = read_output(spark, f"{path}/out", "purchases", "id bigint, user bigint")
    purchases = purchases.withColumn("topic", F.lit("purchases"))
    return rows.unionByName(purchases, allowMissingColumns=True)


def fixed_partitioning(spark, sf_dir):
    """The partition of every message, and that its writer keeps to one."""
    rows = m.table(spark, sf_dir, "events").select("event_id", "event_type")
    sent = json_topic("events", path="unused", partitioner=fixed(m.PARTITIONS)).rows(rows)
    # The partition follows from the number of the writer, which is that of its task.
    expected = F.pmod(F.spark_partition_id(), F.lit(m.PARTITIONS))
    checked = sent.withColumn("writer_keeps_to_it", F.col("partition") == expected)
    kept = ["writer_keeps_to_it"]
    return json_table(checked, {"event_id": "LONG", "event_type": "STRING"}, keep=kept)


def keyed_partitioning(spark, sf_dir):
    """Messages with a key, where other clients put that key."""
    rows = m.table(spark, sf_dir, "events").select("event_id", "user_id")
    key = F.col("user_id").cast("string")
    sink = json_topic("events", path="unused", partitions=m.PARTITIONS, partitioner=keyed(key), key=key)
    return json_table(sink.rows(rows), {"event_id": "LONG"}, keep=["partition"])


def custom_partitioning(spark, sf_dir):
    partition = F.pmod("user_id", F.lit(m.PARTITIONS)).cast("int")
    rows = m.table(spark, sf_dir, "events").select("event_id", "user_id")
    sent = json_topic("events", path="unused", partitioner=partition).rows(rows)
    return json_table(sent, {"event_id": "LONG"}, keep=["partition"])


# ---------------------------------------------------------------- streams


def stream_equals_batch(spark, sf_dir):
    """`delimited_source` as a stream."""
    path = m.scratch(spark, "stream")
    messages = m.event_lines(m.table_stream(spark, sf_dir, "events"))
    lines = delimited_table(table_topic(messages, "event_lines"), LINE_SCHEMA)
    bought = lines.filter(map_value("event", "eventType") == "purchase")
    sink = files(f"{path}/rows", {"id": "LONG", "name": "STRING", "user": "LONG"})
    query = start(
        bought.select("id", "name", "user"), sink, f"{path}/checkpoint", available_now=True
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def stream_to_avro_topic(spark, sf_dir):
    """A delimited stream into an Avro topic, read back."""
    path = m.scratch(spark, "avro")
    messages = m.event_lines(m.table_stream(spark, sf_dir, "events"))
    lines = delimited_table(table_topic(messages, "event_lines"), LINE_SCHEMA)
    rows = lines.select("name", "id", F.col("user").cast("int"))
    sink = avro_topic("actions", m.ACTION, path=f"{path}/actions", partitions=m.PARTITIONS)
    start(rows, sink, f"{path}/checkpoint", available_now=True).awaitTermination()
    return avro_table(spark.read.parquet(f"{path}/actions"), m.ACTION)


def proctime_column(spark, sf_dir):
    """The time of reading, after the message was sent and not before the query began."""
    messages = table_topic(m.event_lines(m.table(spark, sf_dir, "events")), "event_lines")
    lines = delimited_table(messages, LINE_SCHEMA, keep=["timestamp"])
    timed = with_proctime(lines, "read_at")
    return timed.select(
        "id",
        "name",
        (F.col("read_at") > F.col("timestamp")).alias("after_sending"),
        (F.col("read_at") == F.current_timestamp()).alias("now"),
    )


def rowtime_watermark(spark, sf_dir):
    """Event time from a column of the message."""
    events = m.table(spark, sf_dir, "events")
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.concat_ws("\t", F.col("event_id").cast("string"), moment)
    messages = table_topic(m.event_topic(events, "moments", line), "moments")
    table = delimited_table(messages, {"id": "LONG", "moment": "SQL_TIMESTAMP"})
    timed = with_rowtime(table, "moment", delay="10 seconds")
    return timed.select("id", F.unix_micros("moment").alias("moment_us"))


def rowtime_from_envelope(spark, sf_dir):
    """Event time from the message timestamp, as a stream."""
    path = m.scratch(spark, "rowtime")
    messages = table_topic(
        m.event_props(m.table_stream(spark, sf_dir, "events")), "event_props"
    )
    table = json_table(messages, {"k": "INT"}, keep=["timestamp"])
    timed = with_rowtime(table, "sent", source="timestamp", delay="10 seconds")
    rows = timed.select("k", F.unix_micros("sent").alias("sent_us"))
    sink = files(f"{path}/rows")
    start(rows, sink, f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def stream_without_repeats(spark, sf_dir):
    """A stream of three batches: later ones hold messages of earlier ones again, and the last one
    messages that come too late."""
    path = m.scratch(spark, "repeats")
    messages = m.event_props(m.table(spark, sf_dir, "events"))
    day = F.dayofmonth("timestamp")
    late = F.col("offset") + 1_000_000_000
    batches = [
        messages.filter(day <= 10),
        messages.filter((day > 8) & (day <= 20)),
        messages.filter(day > 18).unionByName(messages.filter(day <= 2).withColumn("offset", late)),
    ]
    rows = None
    for number, batch in enumerate(batches):
        batch.write.parquet(f"{path}/in/batch={number}")
        arriving = spark.readStream.schema(messages.schema).parquet(f"{path}/in/batch=*")
        once = without_repeats(table_topic(arriving, "event_props"), "4 days")
        rows = once.select("partition", "offset", F.unix_micros("timestamp").alias("timestamp_us"))
        sink = files(f"{path}/rows")
        start(rows, sink, f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


QUERIES = {
    query.__name__: query
    for query in (
        topic_scan,
        delimited_source,
        avro_source,
        json_source,
        json_map_filter,
        json_schema_source,
        start_earliest,
        start_latest,
        start_latest_stream,
        start_specific_offsets,
        start_group_offsets,
        group_offsets_observed,
        start_by_index,
        delimited_ragged,
        delimited_map,
        delimited_select_star,
        delimited_types,
        delimited_custom_delims,
        delimited_permissive,
        avro_permissive,
        json_permissive,
        map_lookup_filter,
        array_element,
        struct_field,
        map_struct_field,
        array_struct_field,
        nested_conjunction,
        json_variant_paths,
        json_variant_schema,
        json_schema_constraints,
        rejected_messages,
        rejected_stream,
        nullable_fields,
        project_columns,
        select_star,
        field_mapping,
        schema_narrowing,
        catalog_query,
        catalog_table,
        catalog_function,
        schema_evolution,
        avro_roundtrip,
        avro_documents,
        json_roundtrip,
        filter_gt_le_route,
        route_avro_required,
        print_rows,
        insert_into_sink,
        fanout_multi_sink,
        fanout_two_queries,
        fanout_exactly_once,
        fixed_partitioning,
        custom_partitioning,
        keyed_partitioning,
        stream_equals_batch,
        stream_to_avro_topic,
        proctime_column,
        rowtime_watermark,
        rowtime_from_envelope,
        stream_without_repeats,
    )
}
