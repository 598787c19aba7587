"""Named tables and sinks, and SQL text over them."""

from __future__ import annotations

from collections.abc import Mapping
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from topictables.streaming.sinks import Sink, start, write


def register_table(df: DataFrame, name: str) -> DataFrame:
    """Make a table known to SQL text under a one-part name."""
    df.createOrReplaceTempView(name)
    return df


class Catalog:
    """Tables and sinks under the name of a database.

    Query text names a table as `{db.table}`. Where the session was started with
    `spark.sql.globalTempDatabase` set to the catalog's name, plain `db.table` works too. Tables
    may be streams; text is handed to Spark as it is.
    """

    def __init__(self, spark: SparkSession, name: str):
        if not name.isidentifier():
            raise ValueError(f"{name!r} is not a database name")
        self._spark = spark
        self._name = name
        self._tables: dict[str, DataFrame] = {}
        self._sinks: dict[str, Sink] = {}
        self._plain_names = spark.conf.get("spark.sql.globalTempDatabase") == name

    def create_table(self, name: str, df: DataFrame, ignore_if_exists: bool = False) -> None:
        if name in self._tables:
            if ignore_if_exists:
                return
            raise ValueError(f"table {self._name}.{name} exists")
        self._tables[name] = df
        if self._plain_names:
            df.createOrReplaceGlobalTempView(name)

    def drop_table(self, name: str, ignore_if_not_exists: bool = False) -> None:
        if name not in self._tables:
            if ignore_if_not_exists:
                return
            raise KeyError(f"no table {self._name}.{name}")
        del self._tables[name]
        if self._plain_names:
            self._spark.catalog.dropGlobalTempView(name)

    def tables(self) -> list[str]:
        return sorted(self._tables)

    def table(self, name: str) -> DataFrame:
        """A table by name, without SQL."""
        if name not in self._tables:
            raise KeyError(f"no table {self._name}.{name}")
        return self._tables[name]

    def sql(self, text: str) -> DataFrame:
        """The rows of a query over the catalog's tables.

        Text that uses `{db.table}` is a format string: other braces in it are doubled.
        """
        if f"{{{self._name}." in text:
            return self._spark.sql(text, **{self._name: SimpleNamespace(**self._tables)})
        return self._spark.sql(text)

    def create_function(
        self, name: str, table: DataFrame, parameters: Mapping[str, str], condition: str
    ) -> None:
        """A bounded table with parameters, called in SQL text as `FROM name(value, ...)`.

        `condition` is SQL over the table's columns and the parameters; a parameter that is called
        like a column is `name.parameter` there. A parameter's type may be followed by `DEFAULT` and
        a value. Spark puts the function's query in place of the call, so conditions of the
        function and around it reach the scan.
        """
        if not name.isidentifier():
            raise ValueError(f"{name!r} is not the name of a function")
        view = f"_{self._name}_{name}"
        table.createOrReplaceTempView(view)
        declared = ", ".join(f"`{p}` {kind}" for p, kind in parameters.items())
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        chosen = ", ".join(f"`{c}`" for c in table.columns)
        self._spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS TABLE ({columns}) "
            f"RETURN SELECT {chosen} FROM `{view}` WHERE {condition}"
        )

    def set_variable(self, name: str, kind: str, value: object) -> None:
        """A session variable, which SQL text names like a column."""
        if not name.isidentifier():
            raise ValueError(f"{name!r} is not the name of a variable")
        self._spark.sql(f"DECLARE OR REPLACE VARIABLE `{name}` {kind}")
        self._spark.sql(f"SET VARIABLE `{name}` = CAST(:value AS {kind})", {"value": value})

    def create_sink(self, name: str, sink: Sink) -> None:
        if name in self._sinks:
            raise ValueError(f"sink {name} exists")
        self._sinks[name] = sink

    def insert_into(self, name: str, query: str | DataFrame, checkpoint: str | None = None, **options):
        """Send a query's rows to a registered sink.

        A bounded query is written at once; a stream is started and returned.
        """
        if name not in self._sinks:
            raise KeyError(f"no sink {name}")
        df = self.sql(query) if isinstance(query, str) else query
        if df.isStreaming:
            return start(df, self._sinks[name], checkpoint, **options)
        return write(df, self._sinks[name])
