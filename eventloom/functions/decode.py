"""Decoding and encoding of message payloads, as narrow (shuffle-free) steps.

Every function here is a projection or filter, so a chain of them compiles
into one stage and runs on batch and streaming input alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.schemas import CHANGE_RECORD, JSON_OPTIONS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_strings(df: DataFrame, cols: Sequence[str] = ("key", "value")) -> DataFrame:
    """Binary key / value of an envelope as text."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def parse_json(df: DataFrame, column: str, schema: StructType, flatten: bool = True,
               keep: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """``from_json`` with a declared schema (PERMISSIVE: a bad record becomes
    nulls), optionally flattened into top-level columns."""
    parsed = F.from_json(_col(column).cast("string"), schema, JSON_OPTIONS)
    if flatten:
        # inline(array(struct)) yields the fields as columns from one parse.
        # A plain select of "struct.*" lets Catalyst push not-null filters on
        # the fields below the projection, which parses every record twice.
        return df.select(*keep, F.inline(F.array(parsed)))
    return df.select(*keep, parsed.alias(alias or column))


def json_value(cols: Sequence[str] | None = None, df: DataFrame | None = None) -> Column:
    """Row (or a column subset) as a JSON object; null fields are omitted."""
    names = list(cols) if cols is not None else list(df.columns)
    return F.to_json(F.struct(*names), JSON_OPTIONS)


def encode_json(df: DataFrame, key: str | Column, cols: Sequence[str] | None = None) -> DataFrame:
    """``key`` as text plus the row as a JSON ``value``: a keyed message."""
    return df.select(_col(key).cast("string").alias("key"),
                     json_value(cols or df.columns).alias("value"))


def first_entry(arr, field: str | None = None) -> Column:
    """First element of an array column (null for null or empty arrays; the
    ANSI ``arr[0]`` would raise on an empty array)."""
    e = F.get(_col(arr), 0)
    return e.getField(field) if field else e


def decode_base64(c) -> Column:
    """Base64 text to text; null when the input is not valid base64."""
    return F.try_to_binary(_col(c), F.lit("base64")).cast("string")


def encode_base64(c) -> Column:
    return F.base64(_col(c).cast("string").cast("binary"))


def change_record_value(member_json: Column, score: Column, set_key: str) -> Column:
    """JSON text of a sorted-set change record holding one member."""
    entry = F.struct(encode_base64(member_json).alias("element"),
                     score.cast("string").alias("score"))
    rec = F.struct(encode_base64(F.lit(set_key)).alias("key"),
                   F.lit(None).cast("string").alias("value"),
                   F.lit(None).cast("string").alias("expiredType"),
                   F.lit(None).cast("string").alias("expiredValue"),
                   F.lit("NONE").alias("existType"),
                   F.lit("false").alias("ch"),
                   F.lit(False).alias("incr"),
                   F.array(entry).alias("zSetEntries"))
    return F.to_json(rec)


def decode_change_members(df: DataFrame, value_col: str = "value",
                          keep: Sequence[str] = ()) -> DataFrame:
    """Change-record envelope → ``key`` (decoded), first member as text and
    its score. Members that are not base64 come out as null."""
    rec = F.from_json(_col(value_col).cast("string"), CHANGE_RECORD)
    # explode(array(struct)) keeps later filters above the parse (see parse_json)
    staged = df.select(*keep, F.explode(F.array(rec)).alias("_r"))
    return staged.select(
        *keep,
        decode_base64(F.col("_r.key")).alias("key"),
        first_entry("_r.zSetEntries", "element").alias("encoded"),
        first_entry("_r.zSetEntries", "score").alias("score"),
    ).select(*keep, "key", F.explode(F.array(decode_base64("encoded"))).alias("member"), "encoded", "score")


def decode_two_level(df: DataFrame, inner_schema: StructType, value_col: str = "value",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Envelope JSON → base64 member → inner JSON → columns."""
    members = decode_change_members(df, value_col, keep)
    return parse_json(members, "member", inner_schema, keep=keep)


def flag_rejects(df: DataFrame, required: Sequence[str], alias: str = "is_reject") -> DataFrame:
    """Every row with a flag: whether some required field did not parse. One
    scan and one parse serve both outputs; split on the flag at the sinks."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.withColumn(alias, ~ok)


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows where every required field parsed, and the rest (the rejects).
    Each output is a plan of its own; :func:`flag_rejects` needs one for both."""
    flagged = flag_rejects(df, required, "_reject")
    return (flagged.filter(~F.col("_reject")).drop("_reject"),
            flagged.filter(F.col("_reject")).drop("_reject"))


def demux(df: DataFrame, column: str, marker: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split one stream of two record kinds by a marker substring: records with
    it, records without it, and the rejects, whose ``column`` did not decode."""
    has = F.col(column).contains(marker)
    return df.filter(has), df.filter(~has), df.filter(F.col(column).isNull())


def demux_tag(df: DataFrame, column: str, marker: str, with_marker: str, without_marker: str,
              alias: str = "kind") -> DataFrame:
    """The same split in one pass: a ``kind`` column names each record's side,
    so both kinds come from one scan and one parse. Rejects have a null kind."""
    has = F.col(column).contains(marker)
    return df.withColumn(alias, F.when(has, F.lit(with_marker)).when(~has, F.lit(without_marker)))


def from_avro_value(c, json_format_schema: str, framed: bool = True) -> Column:
    """Decode Avro binary values (needs the spark-avro package).

    Messages written through a schema registry carry a 5-byte header (magic
    byte + schema id) that ``from_avro`` does not understand; it is cut off
    first when ``framed``. Not testable here: the Avro package is absent.
    """
    from pyspark.sql.avro.functions import from_avro  # noqa: PLC0415
    v = _col(c)
    if framed:
        v = F.substring(v, 6, 2147483647)
    return from_avro(v, json_format_schema)
