"""Outputs that become visible together, each batch once.

The files of a batch, of all its outputs, are named by one manifest that is put in place when every
task has ended. Readers go by the manifests, so a batch that fails leaves nothing to be seen, and one
that Spark repeats after a failure finds its manifest there and adds nothing.
"""

from __future__ import annotations

import hashlib
import json
import sys
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.query import StreamingQuery

from topictables.operators.conform import conformed
from topictables.streaming.sinks import Sink, _started

#: The name of the data source, and the folder of its manifests.
FORMAT, MANIFESTS = "outputs_together", "manifests"

# The writer travels with the query, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Route = tuple[Column | None, Sequence[str | Column], Sink]


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: (output, file below the path, rows)."""

    files: list[tuple[str, str, int]]


class _Files:
    """Writes the files of a task, and puts the manifest of a batch in place."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.names = options["path"], json.loads(options["outputs"])
        self.writer = options.get("writer", "")

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Column 0 says which output a row is for; column n + 1 is the row as output n has it."""
        system, root = self._place()
        open_files: dict[str, pq.ParquetWriter] = {}
        files: dict[str, list] = {}
        try:
            for batch in iterator:
                for n, name in enumerate(self.names):
                    rows = batch.column(n + 1).filter(pc.equal(batch.column(0), n))
                    if not len(rows):
                        continue
                    table = pa.Table.from_batches([pa.RecordBatch.from_struct_array(rows)])
                    if name not in open_files:
                        files[name] = [f"{name}/{uuid.uuid4().hex}.parquet", 0]
                        system.create_dir(f"{root}/{name}")
                        open_files[name] = pq.ParquetWriter(f"{root}/{files[name][0]}", table.schema, filesystem=system)
                    open_files[name].write_table(table)
                    files[name][1] += len(rows)
            for file in open_files.values():
                file.close()
        except BaseException:
            self._remove([file for file, _ in files.values()])
            raise
        return Written([(name, file, rows) for name, (file, rows) in files.items()])

    def _remove(self, files: list[str]) -> None:
        system, root = self._place()
        for file in files:
            if system.get_file_info(f"{root}/{file}").type == fs.FileType.File:
                system.delete_file(f"{root}/{file}")

    def _show(self, messages: list[Written | None], name: str) -> None:
        system, root = self._place()
        written = [entry for message in messages if message for entry in message.files]
        manifest = f"{root}/{MANIFESTS}/{name}.json"
        if system.get_file_info(manifest).type == fs.FileType.File:  # the batch is repeated
            return self._remove([file for _, file, _ in written])
        system.create_dir(f"{root}/{MANIFESTS}")
        draft = f"{root}/{MANIFESTS}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            for output, file, rows in written:
                out.write(json.dumps({"output": output, "file": file, "rows": rows}).encode() + b"\n")
        system.move(draft, manifest)

    def _hide(self, messages: list[Written | None]) -> None:
        self._remove([file for message in messages if message for _, file, _ in message.files])


class _BatchWriter(_Files, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self._show(messages, f"written-{uuid.uuid4().hex}")

    def abort(self, messages: list[Written | None]) -> None:
        self._hide(messages)


class _StreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._show(messages, f"{self.writer}-{batchId:012d}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._hide(messages)


class OutputsTogether(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(self.options)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options)


def _tagged(df: DataFrame, routes: Mapping[str, Route]) -> DataFrame:
    """One row per row and route that it meets: the number of the route, and the row as it is there."""
    if not routes:
        raise ValueError("name at least one output")
    tags, outputs = [], []
    route = F.col("_route")
    for n, (name, (condition, columns, sink)) in enumerate(routes.items()):
        if name == MANIFESTS or not name.replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"{name!r} cannot name an output")
        columns = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
        if sink.schema is not None:
            columns = conformed(columns, df.select(*columns).schema, sink.schema)
        # Rows of other routes are null here: they are neither checked nor encoded.
        row = F.when(route == n, F.struct(*columns))
        if sink.encode is not None:
            partition = F.lit(None).cast("int") if sink.partition is None else sink.partition
            message = [F.lit(sink.topic).alias("topic"), sink.encode(row).alias("value"), partition.alias("partition")]
            if sink.key is not None:
                message.append(sink.key.cast("binary").alias("key"))
            row = F.when(route == n, F.struct(*message))
        tags.append(F.lit(n) if condition is None else F.when(condition, F.lit(n)))
        outputs.append(row.alias(f"_{n}"))
    met = F.filter(F.array(*tags), lambda tag: tag.isNotNull())
    return df.select("*", F.explode(met).alias("_route")).select("_route", *outputs)


def _options(df: DataFrame, routes: Mapping[str, Route], path: str) -> dict[str, str]:
    df.sparkSession.dataSource.register(OutputsTogether)
    return {"path": path, "outputs": json.dumps(list(routes))}


def write_together(df: DataFrame, routes: Mapping[str, Route], path: str) -> None:
    """A bounded query's rows to several outputs below a path, all of them or none.

    A route is a condition (None takes every row), the columns and a sink, which says how rows are
    checked and encoded; the path takes the place of its own. The rows are computed once.
    """
    rows = _tagged(df, routes)
    rows.write.format(FORMAT).options(**_options(df, routes, path)).mode("append").save()


def start_together(
    df: DataFrame,
    routes: Mapping[str, Route],
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The same for a stream: a batch's outputs are seen together, and once however often it is run.

    Batches are told apart by the checkpoint's path and their number, so several streams may write
    below one path.
    """
    options = _options(df, routes, path) | {"writer": hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]}
    writer = _tagged(df, routes).writeStream.format(FORMAT).options(**options).outputMode("append")
    return _started(writer, checkpoint, available_now, every, name)


def read_output(spark: SparkSession, path: str, name: str, schema: T.StructType | str) -> DataFrame:
    """What is visible of one output. The names of its files come to the driver, as in any listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    entries = spark.read.schema("output string, file string, rows long").json(f"{path}/{MANIFESTS}")
    files = [f"{path}/{r.file}" for r in entries.filter(F.col("output") == name).select("file").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
