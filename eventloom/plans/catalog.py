"""Named streams and tables: declare, derive persistent queries, list, drop.

Spark's session catalog holds the views and ``spark.streams`` the running
queries; this module only adds the rules of a stream catalog on top (a view
still read by a running query cannot be dropped, a derived query writes to a
sink of its own and keeps a checkpoint named after it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventloom.functions.decode import parse_json


class CatalogError(RuntimeError):
    pass


def declare(spark: SparkSession, name: str, envelopes: DataFrame, schema: StructType,
            value_col: str = "value") -> DataFrame:
    """Give a topic a name, columns and a format (JSON here): the decoded
    envelope rows become a temp view."""
    df = parse_json(envelopes, value_col, schema)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def derive(spark: SparkSession, query_name: str, sql: str, sink, **sink_kwargs):
    """A persistent query: run ``sql`` over declared (streaming) views and hand
    it to ``sink(df, query_name=…, **kwargs)``, which starts it. What the sink
    returns (the running query's handle) is returned."""
    return sink(spark.sql(sql), query_name=query_name, **sink_kwargs)


def views_of(plan) -> set[str]:
    """Names of the views that an analysed plan reads, found by walking its nodes."""
    found, todo = set(), [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "View":
            found.add(node.desc().identifier().table().lower())
        for below in (node.children(), node.subqueries()):
            todo += [below.apply(i) for i in range(below.size())]
    return found


def reads(query: StreamingQuery) -> set[str]:
    """Names of the views a running query reads."""
    return views_of(query._jsq.streamingQuery().analyzedPlan())


def list_views(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Views (all, or the named ones) with their columns and types, plus
    running queries, as rows."""
    rows = []
    for t in spark.catalog.listTables():
        if not t.isTemporary or (names is not None and t.name not in names):
            continue
        for c in spark.catalog.listColumns(t.name):
            rows.append(("view", t.name, c.name, c.dataType))
    for q in spark.streams.active:
        rows.append(("query", q.name or str(q.id), None, None))
    schema = "kind string, name string, column string, type string"
    return spark.createDataFrame(rows, schema)


def drop_view(spark: SparkSession, name: str) -> None:
    """Drop a view; refused while a running query, however started, reads it.
    Data already written by earlier queries stays where it is."""
    users = [q.name or str(q.id) for q in spark.streams.active if name.lower() in reads(q)]
    if users:
        raise CatalogError(f"cannot drop {name}: read by running queries {users}; "
                           f"terminate them first")
    spark.catalog.dropTempView(name)


def terminate(spark: SparkSession, query_name: str) -> bool:
    for q in spark.streams.active:
        if q.name == query_name:
            q.stop()
            return True
    return False
