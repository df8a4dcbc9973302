"""Small documents with all the edge cases the operators promise to handle."""

import random
import re

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def words(text):
    """The letters-and-digits word rule, plainly."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdegilmnorstu") for _ in range(r.randint(2, 7))) for _ in range(n))


def edge_rows():
    base = prose(1, 80)
    near = base.split()
    near[40] = "changed"
    return [
        (1, base, "x"), (2, base, None), (2, base, "again"), (3, None, "null text"), (4, "", None),
        (None, prose(2, 30), "null id"), (None, None, None), (5, "one", "short"), (6, "é ß 中文 😀\x00\x1c", None),
        (7, prose(3, 30_000), "long"), (8, "   \n\t ", None), (9, " ".join(near), "near"),
        (10, "idem " * 300, "repeats"), (11, "<|endoftext|> done", None),
    ]


#: Extra columns, named like those the operators add or use inside.
CLASHES = ["row", "key", "spans", "masked", "toxicity", "passages", "ids", "n", "node", "rid", "h", "score", "_key"]


def edge_docs(spark):
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string")
    df = df.withColumns({"source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    return df.withColumns({c: F.lit("other") for c in CLASHES})


def no_docs(spark):
    return edge_docs(spark).filter("false")


def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 2)) for i in range(1, 12)] + [(None, 1, 1), (1, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("score", F.lit(7.0))


def items(spark):
    base = prose(1, 80).split()
    rows = [(1, " ".join(base[10:40])), (2, "changed"), (3, None), (4, ""), (5, " ".join(base[20:32])),
            (5, " ".join(base[20:32])), (None, " ".join(base[:12])), (6, prose(9, 20)), (7, "one")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit(1))
