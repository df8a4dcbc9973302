"""Records of each declared shape, invented here, through decode and join."""

import json

from pyspark.sql import functions as F

from eventloom.functions import decode as D
from eventloom.functions import scalars as S
from eventloom.operators import joins as J
from eventloom.operators import relational as R
from eventloom.schemas import (ATM_WITHDRAWAL, BANK_DEPOSIT, BANK_WITHDRAWAL, CUSTOMER_RECORD,
                               RISK_EVENT, VEHICLE_CHECKIN, VEHICLE_STATUS)
from eventloom.sources.topics import to_envelope


def topic(spark, messages, name):
    df = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)], "i long, v string")
    return to_envelope(df, name, F.col("v"), key="i", offset="i")


def test_withdrawal_joins_atm_visit_by_transaction(spark):
    w = topic(spark, [{"accountNumber": "100200300", "amount": 75.25,
                       "dateAndTime": "Mar 4, 2024, 3:05:07 PM", "transactionId": 900000000017}], "w")
    a = topic(spark, [{"transactionDate": "Mar 4, 2024, 3:05:07 PM", "transactionId": 900000000017,
                       "atmLocation": "Uruguay"}], "a")
    wd = D.parse_json(w, "value", BANK_WITHDRAWAL)     # numbers read into string fields
    atm = R.rename(D.parse_json(a, "value", ATM_WITHDRAWAL),
                   {"transactionDate": "transactionDate", "transactionId": "atmTransactionId",
                    "atmLocation": "atmLocation"})
    rows = J.join(wd, atm, F.col("transactionId") == F.col("atmTransactionId"), "inner").collect()
    assert [(r.accountNumber, r.amount, r.transactionId, r.atmLocation) for r in rows] == \
        [("100200300", "75.25", "900000000017", "Uruguay")]
    out = D.encode_json(J.join(wd, atm, F.col("transactionId") == F.col("atmTransactionId"), "inner"),
                        "transactionId").first()
    assert json.loads(out.value)["atmLocation"] == "Uruguay" and out.key == "900000000017"


def test_deposits_join_customers_by_account(spark):
    deps = topic(spark, [{"accountNumber": "500600700", "amount": 18.50, "dateAndTime": "Feb 9, 2024 4:15:30 AM"},
                         {"accountNumber": "500600700", "amount": 63.75, "dateAndTime": "Feb 9, 2024 4:16:00 AM"},
                         {"accountNumber": "999", "amount": 1.0, "dateAndTime": "Feb 9, 2024 4:16:00 AM"}], "d")
    cust = topic(spark, [{"customerName": "Ada Quill", "email": "ada.quill@example.org", "phone": "5550100100",
                          "birthDay": "1971-08-15", "accountNumber": "500600700", "location": "Chile"}], "c")
    d = D.parse_json(deps, "value", BANK_DEPOSIT)
    c = D.parse_json(cust, "value", CUSTOMER_RECORD).select(
        "customerName", F.col("accountNumber").alias("customerNumber"))
    j = J.join(d, c, F.col("accountNumber") == F.col("customerNumber"), "inner")
    got = sorted((r.accountNumber, round(r.amount, 2), r.customerName, r.customerNumber) for r in j.collect())
    assert got == [("500600700", 18.50, "Ada Quill", "500600700"), ("500600700", 63.75, "Ada Quill", "500600700")]
    times = [r.t for r in d.select(S.parse_bank_time("dateAndTime").cast("string").alias("t")).collect()]
    assert times[0] == "2024-02-09 04:15:30"


def test_vehicle_status_joins_checkin(spark):
    st = topic(spark, [{"truckNumber": "7342", "destination": "Depot Nine", "milesFromShop": 311,
                        "odometerReading": 98077}], "s")
    ck = topic(spark, [{"reservationId": "900000000042", "locationName": "Yard Two", "truckNumber": "7342",
                        "status": "In"}], "k")
    s = R.rename(D.parse_json(st, "value", VEHICLE_STATUS), {"truckNumber": "statusTruckNumber",
                                                            "milesFromShop": "milesFromShop"})
    k = R.rename(D.parse_json(ck, "value", VEHICLE_CHECKIN), {"truckNumber": "checkinTruckNumber",
                                                              "locationName": "locationName"})
    r = J.join(s, k, F.col("statusTruckNumber") == F.col("checkinTruckNumber"), "inner").first()
    assert (r.statusTruckNumber, r.milesFromShop, r.locationName) == ("7342", 311, "Yard Two")


def test_risk_score_sample_and_type_drift(spark):
    ev = topic(spark, [{"customer": "one@example.org", "score": -1.25, "riskDate": "2024-05-06"},
                       {"customer": "two@example.org", "score": "not a number", "riskDate": "2024-05-06"},
                       {"customer": "three@example.org", "score": "7.5", "riskDate": "2024-05-06"}], "e")
    parsed = D.parse_json(ev, "value", RISK_EVENT)
    good, bad = D.split_rejects(parsed, ["customer", "score"])
    assert [(r.customer, r.score) for r in good.collect()] == [("one@example.org", -1.25)]
    # string values for a float field are rejects (null), not job failures
    assert sorted(r.customer for r in bad.collect()) == ["three@example.org", "two@example.org"]


def test_location_records_from_change_feed(spark):
    import base64
    from eventloom.schemas import LOCATION_RECORD

    def change(member):
        el = base64.b64encode(member.encode()).decode()
        return {"key": base64.b64encode(b"Location").decode(), "existType": "NONE", "ch": False,
                "incr": False, "zSetEntries": [{"element": el, "score": "0.0"}]}

    locs = [("11", "Peru"), ("12", "Nepal"), ("13", "Malta"), ("14", "Utah"),
            ("15", "Oregon"), ("16", "Fiji"), ("11", "Samoa")]
    msgs = [change(json.dumps({"other": "record"}))] + \
        [change(json.dumps({"accountNumber": a, "location": loc})) for a, loc in locs]
    decoded = D.decode_two_level(topic(spark, msgs, "change-feed"), LOCATION_RECORD)
    assert decoded.count() == 8                       # the odd record decodes to nulls
    rows = R.not_null(decoded, ["location"]).collect()
    assert sorted((r.accountNumber, r.location) for r in rows) == sorted(locs)   # repeats kept
