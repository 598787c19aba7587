"""Query message topics as tables with Spark."""

from topictables.functions.access import field, map_field, map_value, nth, nth_field
from topictables.functions.avro import from_avro_message, to_avro_message
from topictables.functions.json_text import from_json_message, to_json_message
from topictables.functions.variant import variant_paths, variant_schema
from topictables.operators.conform import check_sink_schema
from topictables.operators.keyed import keyed, murmur2
from topictables.operators.partitioning import fixed
from topictables.plans.catalog import Catalog, register_table
from topictables.plans.constraints import json_schema_violation
from topictables.plans.evolution import SchemaConflict, evolved, unified
from topictables.plans.schema import avro_record, avro_schema, json_schema, table_schema
from topictables.sources.indexed import append_messages, files_from, indexed_topic
from topictables.sources.tables import avro_table, delimited_table, json_table, json_versions_table
from topictables.sources.tagged import delimited_results, good_rows, json_results, rejected
from topictables.sources.topic import (
    EARLIEST,
    ENVELOPE,
    GROUP,
    LATEST,
    SPECIFIC,
    Start,
    check_topic,
    end_offsets,
    from_start,
    kafka_topic,
    start_at,
    table_topic,
)
from topictables.streaming.offsets import (
    ObservedOffsets,
    commit_offsets,
    commit_read,
    committed_offsets,
    reset_offsets,
)
from topictables.streaming.sinks import (
    Sink,
    avro_topic,
    console,
    files,
    json_topic,
    routed,
    start,
    start_all,
    write,
)
from topictables.streaming.time import with_proctime, with_rowtime, without_repeats
from topictables.streaming.together import read_output, start_together, write_together

__all__ = [
    "Catalog",
    "EARLIEST",
    "ENVELOPE",
    "GROUP",
    "LATEST",
    "ObservedOffsets",
    "SPECIFIC",
    "SchemaConflict",
    "Sink",
    "Start",
    "append_messages",
    "avro_record",
    "avro_schema",
    "avro_table",
    "avro_topic",
    "check_sink_schema",
    "check_topic",
    "commit_offsets",
    "commit_read",
    "committed_offsets",
    "console",
    "delimited_results",
    "delimited_table",
    "end_offsets",
    "evolved",
    "field",
    "files",
    "files_from",
    "fixed",
    "from_avro_message",
    "from_json_message",
    "from_start",
    "good_rows",
    "indexed_topic",
    "json_results",
    "json_schema",
    "json_schema_violation",
    "json_table",
    "json_topic",
    "json_versions_table",
    "kafka_topic",
    "keyed",
    "map_field",
    "map_value",
    "murmur2",
    "nth",
    "nth_field",
    "register_table",
    "read_output",
    "rejected",
    "reset_offsets",
    "routed",
    "start",
    "start_all",
    "start_at",
    "start_together",
    "table_schema",
    "table_topic",
    "to_avro_message",
    "to_json_message",
    "unified",
    "variant_paths",
    "variant_schema",
    "with_proctime",
    "with_rowtime",
    "without_repeats",
    "write",
    "write_together",
]
