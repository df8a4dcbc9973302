"""Declared record schemas. Schemas are never inferred from messages."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType,
                               FloatType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Message envelope of a topic: the column layout of Spark's Kafka source.
ENVELOPE = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), False),
    StructField("partition", IntegerType(), False),
    StructField("offset", LongType(), False),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), False),
])

# JSON options that keep microseconds of TIMESTAMP_NTZ values on a round trip.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# A click event as carried by the events table.
CLICK_EVENT = _s(("event_id", LongType()), ("ts", TimestampNTZType()),
                 ("user_id", LongType()), ("event_type", StringType()),
                 ("value", DoubleType()), ("props", StringType()))

# Fixed values from here on: field names and types of the records that the
# pipelines exchange.

# Change record of a key-value store captured into a topic; the sorted-set
# members arrive base64 encoded in zSetEntries[].element.
CHANGE_RECORD = _s(("key", StringType()), ("value", StringType()),
                   ("expiredType", StringType()), ("expiredValue", StringType()),
                   ("existType", StringType()), ("ch", StringType()),
                   ("incr", BooleanType()),
                   ("zSetEntries", ArrayType(_s(("element", StringType()),
                                                ("score", StringType())))))

CUSTOMER_RECORD = _s(("customerName", StringType()), ("email", StringType()),
                     ("phone", StringType()), ("birthDay", StringType()),
                     ("accountNumber", StringType()), ("location", StringType()))

LOCATION_RECORD = _s(("accountNumber", StringType()), ("location", StringType()))

RISK_EVENT = _s(("customer", StringType()), ("score", FloatType()),
                ("riskDate", StringType()))

BANK_DEPOSIT = _s(("accountNumber", StringType()), ("amount", FloatType()),
                  ("dateAndTime", StringType()))

BANK_WITHDRAWAL = _s(("accountNumber", StringType()), ("amount", StringType()),
                     ("dateAndTime", StringType()), ("transactionId", StringType()))

ATM_WITHDRAWAL = _s(("transactionDate", StringType()), ("transactionId", StringType()),
                    ("atmLocation", StringType()))

VEHICLE_STATUS = _s(("truckNumber", StringType()), ("destination", StringType()),
                    ("milesFromShop", IntegerType()), ("odometerReading", IntegerType()))

VEHICLE_CHECKIN = _s(("reservationId", StringType()), ("locationName", StringType()),
                     ("truckNumber", StringType()), ("status", StringType()))

STATION = StructType([
    StructField("stop_id", IntegerType(), False),
    StructField("direction_id", StringType(), False),
    StructField("stop_name", StringType(), False),
    StructField("station_name", StringType(), False),
    StructField("station_descriptive_name", StringType(), False),
    StructField("station_id", IntegerType(), False),
    StructField("order", IntegerType(), True),
    StructField("red", BooleanType(), False),
    StructField("blue", BooleanType(), False),
    StructField("green", BooleanType(), False),
])

ARRIVAL = _s(("station_id", IntegerType()), ("train_id", StringType()),
             ("direction", StringType()), ("line", StringType()),
             ("train_status", StringType()), ("prev_station_id", IntegerType()),
             ("prev_direction", StringType()))
