"""Reading one topic written under several schema versions.

Schemas are declared in the usual record notation (records with ``fields``,
each with a ``type``, maybe a ``default`` and ``aliases``; ``array``, ``map``,
``enum``; a union of ``null`` and one type is a nullable type). A message says
by which schema it was written. For every writer's schema the rules that lead
to the reader's are compiled, once, to Spark columns:

* a field is found by its name in the reader's schema or one of its aliases;
  if the writer has none its default stands, without a default the schemas
  don't fit; fields that the reader lacks are left out;
* numbers are promoted (int, long, float, double), strings and bytes
  are read as each other;
* a type that may be null is read as one that may; where the reader's may not,
  a null is a reject;
* arrays, maps and records follow the rules of what they hold; an enum's symbol
  that the reader lacks is its default, else a reject.

Messages of schemas that don't fit, of unknown ones, that can't be parsed, or
that lack what the reader demands are set aside with the reason.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, StringType, StructField, StructType)

from eventloom.schemas import JSON_OPTIONS

PRIMITIVES: dict[str, DataType] = {"boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
                                   "double": DoubleType(), "string": StringType(), "bytes": BinaryType()}
NUMBERS = ("int", "long", "float", "double")
CORRUPT = "_corrupt"


class Incompatible(ValueError):
    """A reader's schema that can't read what a writer's describes."""


def _kind(schema) -> str:
    return schema["type"] if isinstance(schema, Mapping) else schema


def nullable(schema) -> tuple[bool, object]:
    """(may be null, the type without null)."""
    if not isinstance(schema, list):
        return _kind(schema) == "null", schema
    rest = [s for s in schema if s != "null"]
    if len(rest) != 1:
        raise Incompatible(f"a union of {len(rest)} types is not read")
    return len(rest) < len(schema), rest[0]


def spark_type(schema) -> DataType:
    """The Spark type of values of a schema."""
    _, s = nullable(schema)
    kind = _kind(s)
    if isinstance(kind, (Mapping, list)):  # {"type": {...}}
        return spark_type(kind)
    if kind == "record":
        return StructType([StructField(f["name"], spark_type(f["type"])) for f in s["fields"]])
    if kind == "array":
        return ArrayType(spark_type(s["items"]))
    if kind == "map":
        return MapType(StringType(), spark_type(s["values"]))
    if kind == "enum":
        return StringType()
    if kind not in PRIMITIVES:
        raise Incompatible(f"unknown type {kind}")
    return PRIMITIVES[kind]


def default_column(value, schema) -> Column:
    """A declared default as a constant column of the schema's type."""
    of = spark_type(schema)
    if value is None:
        return F.lit(None).cast(of)
    if isinstance(of, (StructType, ArrayType, MapType)):
        filled = _filled(value, schema)
        return F.from_json(F.lit(json.dumps(filled)), of, JSON_OPTIONS)
    return F.lit(value).cast(of)


def _filled(value, schema):
    """A default with the defaults of the records inside."""
    _, s = nullable(schema)
    kind = _kind(s)
    if kind == "record":
        return {f["name"]: _filled(value[f["name"]] if f["name"] in value else f["default"], f["type"]) for f in s["fields"]}
    if kind == "array":
        return [_filled(v, s["items"]) for v in value]
    if kind == "map":
        return {k: _filled(v, s["values"]) for k, v in value.items()}
    return value


def resolve(writer, reader, value: Column, at: str = "") -> Column:
    """``value``, written by one schema, as the other reads it."""
    here = at or "the record"
    _, w = nullable(writer)
    _, r = nullable(reader)
    from_, to = _kind(w), _kind(r)
    if from_ == "null":
        return F.lit(None).cast(spark_type(r))
    if to == "record" and from_ == "record":
        cols = []
        for f in r["fields"]:
            names = [f["name"], *f.get("aliases", [])]
            found = next((x for n in names for x in w["fields"] if x["name"] == n), None)
            inner = f"{at}.{f['name']}" if at else f["name"]
            if found is not None:
                col = resolve(found["type"], f["type"], value[found["name"]], inner)
            elif "default" in f:
                col = default_column(f["default"], f["type"])
            else:
                raise Incompatible(f"{inner}: not written, and without a default")
            cols.append(col.alias(f["name"]))
        return F.when(value.isNotNull(), F.struct(*cols))
    if to == "array" and from_ == "array":
        return F.transform(value, lambda x: resolve(w["items"], r["items"], x, f"{here}[]"))
    if to == "map" and from_ == "map":
        return F.transform_values(value, lambda _, x: resolve(w["values"], r["values"], x, f"{here}{{}}"))
    if to == "enum" and from_ == "enum":
        return F.when(value.isin(list(r["symbols"])), value).otherwise(
            F.when(value.isNotNull(), F.lit(r.get("default")).cast("string")))
    promoted = from_ in NUMBERS and to in NUMBERS and NUMBERS.index(from_) <= NUMBERS.index(to)
    if promoted or from_ == to and to in PRIMITIVES or {from_, to} == {"string", "bytes"}:
        return value.cast(spark_type(r))
    raise Incompatible(f"{here}: {from_} can't be read as {to}")


def missing(reader, value: Column, at: str = "") -> Column:
    """The path of a null where the reader's schema allows none, else null."""
    optional, r = nullable(reader)
    kind, here = _kind(r), at or "the record"
    below: list[Column] = []
    if kind == "record":
        below = [missing(f["type"], value[f["name"]], f"{at}.{f['name']}" if at else f["name"]) for f in r["fields"]]
    elif kind in ("array", "map"):
        inside, mark = (r["items"], "[]") if kind == "array" else (r["values"], "{}")
        held = value if kind == "array" else F.map_values(value)
        found = F.filter(F.transform(held, lambda x: missing(inside, x, here + mark)), lambda p: p.isNotNull())
        below = [F.get(found, F.lit(0))]
    own = F.lit(None).cast("string") if optional else F.when(value.isNull(), F.lit(here))
    return F.coalesce(own, F.when(value.isNotNull(), F.coalesce(*below))) if below else own


def framed(payload: Column, schema_id: Column) -> Column:
    """A message body that names its schema: a zero byte, the id in four bytes (big end first), the payload."""
    return F.concat(F.unhex(F.lpad(F.hex(schema_id.cast("long")), 10, "0")), payload.cast("binary"))


def unframed(value: Column) -> tuple[Column, Column]:
    """(schema id, payload as text) of a message body; nulls where it isn't framed."""
    ok = (F.length(value) > 5) & (F.substring(value, 1, 1) == F.unhex(F.lit("00")))
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    return F.when(ok, number), F.when(ok, F.substring(value, F.lit(6), F.length(value)).cast("string"))


def read_versions(messages: DataFrame, value: str, versions: Mapping[int, Mapping], reader: Mapping,
                  keep: list | None = None) -> DataFrame:
    """Messages of all versions as the reader's fields: ``keep`` columns of the
    message, ``schema_id``, a column per field, and ``reason``: null, or why the
    message was set aside (then all fields are null)."""
    number, payload = unframed(F.col(value))
    body = messages.withColumns({"schema_id": number, "_payload": payload})
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    target = spark_type(reader)
    record, reason = F.lit(None).cast(target), None
    for i, writer in versions.items():
        mine = F.col("schema_id") == F.lit(i)
        try:
            of = StructType([*spark_type(writer).fields, StructField(CORRUPT, StringType())])
            parsed = F.from_json(F.col("_payload"), of, options)
            read = resolve(writer, reader, parsed)
        except Incompatible as e:
            reason = F.when(mine, F.lit(str(e))) if reason is None else reason.when(mine, F.lit(str(e)))
            continue
        bad = F.when(parsed.isNull() | parsed[CORRUPT].isNotNull(), F.lit(f"not a message of schema {i}"))
        record = F.when(mine & bad.isNull(), read.cast(target)).otherwise(record)
        reason = F.when(mine, bad) if reason is None else reason.when(mine, bad)
    unknown = F.when(F.col("schema_id").isNull(), F.lit("not framed")).otherwise(
        F.concat(F.lit("unknown schema "), F.col("schema_id").cast("string")))
    reason = unknown if reason is None else reason.otherwise(unknown)
    carried = [F.col(c) if isinstance(c, str) else c for c in keep or []]
    read = body.select(*carried, "schema_id", record.alias("_record"), reason.alias("_reason"))
    lacks = F.when(F.col("_reason").isNull(), missing(reader, F.col("_record")))
    read = read.withColumn("reason", F.coalesce("_reason", F.concat(lacks, F.lit(" is null"))))
    fields = [F.when(F.col("reason").isNull(), F.col(f"_record.{f.name}")).alias(f.name) for f in target.fields]
    names = [c for c in read.columns if c not in ("_record", "_reason", "reason")]
    return read.select(*names, *fields, "reason")
