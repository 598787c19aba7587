"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from checks import messages as m
from checks.queries import QUERIES
from topictables import avro_table, json_table, map_field, variant_paths

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("topictables-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .getOrCreate()
    )


def stored_messages(spark: SparkSession) -> dict:
    """Queries over Avro and JSON messages that are written before the clock starts: the reader alone."""
    path = tempfile.mkdtemp(prefix="bench-")
    lines = m.table(spark, SF_DIR, "lineitem").repartition(int(CPUS))
    m.avro_shipments(lines).write.parquet(f"{path}/avro")
    m.shipments(lines).write.parquet(f"{path}/json")
    messages, objects = (spark.read.parquet(f"{path}/{kind}") for kind in ("avro", "json"))
    some = ["order", "parties"]

    def full(*_) -> DataFrame:
        return avro_table(messages, m.SHIPMENT)

    def narrowed(*_) -> DataFrame:
        table = avro_table(messages, m.SHIPMENT, columns=some)
        return table.filter(map_field("parties", "line", "number") == 3)

    def json_full(*_) -> DataFrame:
        return json_table(objects, m.SHIPMENT_COLUMNS)

    def json_narrowed(*_) -> DataFrame:
        table = json_table(objects, m.SHIPMENT_COLUMNS, columns=some)
        return table.filter(map_field("parties", "line", "number") == 3)

    def json_variant(*_) -> DataFrame:
        table = json_table(objects, m.SHIPMENT_COLUMNS, columns=some, as_variant=True)
        return table.filter(map_field("parties", "line", "number") == 3)

    def json_paths(*_) -> DataFrame:
        paths = {"order": ("$.order", "LONG"), "line": ("$.parties.line.number", "LONG")}
        return variant_paths(json_table(objects, as_variant=True), paths).filter("line = 3").select("order")

    return {
        "stored_avro_full": full,
        "stored_avro_narrowed": narrowed,
        "stored_json_full": json_full,
        "stored_json_narrowed": json_narrowed,
        "stored_json_variant": json_variant,
        "stored_json_paths": json_paths,
    }


def seconds(spark: SparkSession, query) -> float:
    """Best of some runs of a query, all rows and columns computed."""
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return round(min(times), 3)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries = QUERIES | stored_messages(spark)
    names = sys.argv[1:] or list(queries)
    timings = {name: seconds(spark, queries[name]) for name in names}
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    result = {
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale.group(1)) if scale else SF_DIR,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
