"""License scans by diagonal voting.

All rolling word pairs of every document are hashed and joined by Spark to the
positions of the same pairs in a fixed set of license templates. A pair at
word p of a document and place t of a template votes for the diagonal p - t;
votes are counted by (document, template, diagonal). Each diagonal of a template
is merged with those at most ``SHIFT`` words above it, which bridges an added or
missing word; diagonals further off never count, however many lie between. A
merged span is verified: it must have met enough different places of the
template within its length. A notice may so be listed more than once. The
base phrases must meet all their places on one diagonal.

Null and empty texts have no words, places or labels and score 0. Repeated
rows each give a row. Long texts are scanned whole. Only doc_id and text are
read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import RowIds, chunks, text_buffer
from eventloom.llm.words import ALNUM, Words, gram_hashes, hash_words, mix

#: The contract's phrases and labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Wordings of public license notices, by label (fixed values).
NOTICES = [
    ("gpl-3.0", "gnu general public license version 3"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("gfdl", "gnu free documentation license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

GRAM = 2
#: Words by which diagonals of one span may differ, and the share of a
#: template's places that a verified span has met.
SHIFT, SHARE = 2, 0.8

_MARK = int(mix(np.array([0x6C6963656E7365], np.uint64)).view(np.int64)[0])


def templates(spark: SparkSession) -> DataFrame:
    """(h, template, label, base, place, places, length): a fixed, small table."""
    rows = [(_MARK, -1, None, False, 0, 0, 0)]
    texts = [(label, p, True) for p, label in BASE.items()] + [(label, p, False) for label, p in NOTICES]
    for t, (label, text, base) in enumerate(texts):
        h = hash_words(text)
        grams = pair_hashes(h).view(np.int64).tolist()
        rows += [(g, t, label, base, i, len(grams), len(h)) for i, g in enumerate(grams)]
    return spark.createDataFrame(
        rows, "h long, template int, label string, base boolean, place int, places int, length int")


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return gram_hashes(h, GRAM)


_ROWS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("h", pa.int64())])


def _pairs(batches):
    """All word pairs of all texts, and a marker row with each text's word count."""
    rows = RowIds()
    for batch in batches:
        for part in chunks(batch, "text"):
            rid = rows.take(len(part))
            w = Words(*text_buffer(part.column(part.schema.get_field_index("text"))), ALNUM)
            n = len(rid)
            yield pa.RecordBatch.from_arrays([
                pa.array(rid), part.column(part.schema.get_field_index("doc_id")).cast(pa.int64()),
                pa.array(w.counts.astype(np.int64)), pa.array(np.full(n, _MARK))], schema=_ROWS)
            h, inside = w.grams(GRAM)
            at = np.flatnonzero(inside)
            if len(at):
                doc = np.searchsorted(w.bounds, at, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(rid[doc]), pa.nulls(len(at), pa.int64()), pa.array(at - w.bounds[doc]),
                    pa.array(h[at].view(np.int64))], schema=_ROWS)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, and ``spans``: verified (label, base, start,
    end, share) in words, end exclusive."""
    grams = docs.select("doc_id", "text").mapInArrow(_pairs, "rid long, doc_id long, pos long, h long")
    # The template table is a constant of a few hundred rows.
    met = grams.join(F.broadcast(templates(docs.sparkSession)), "h")
    votes = (met.withColumn("diagonal", F.when(F.col("template") >= 0, F.col("pos") - F.col("place")))
             .repartition("rid")
             .groupBy("rid", "template", "label", "base", "places", "length", "diagonal")
             .agg(F.collect_set("place").alias("met"), F.max("doc_id").alias("doc_id"), F.max("pos").alias("pos")))
    # each diagonal of a notice with those at most SHIFT above it, which bounds the span
    near = W.partitionBy("rid", "template").orderBy("diagonal").rangeBetween(0, SHIFT)
    own = votes.withColumns({"start": F.col("diagonal") + F.array_min("met"),
                             "end": F.col("diagonal") + F.array_max("met") + GRAM})
    taken = lambda alone, together: F.when(F.col("base"), alone).otherwise(together.over(near))
    merged = own.withColumns({
        "start": taken(F.col("start"), F.min("start")), "end": taken(F.col("end"), F.max("end")),
        "all_met": taken(F.array("met"), F.collect_list("met"))})
    merged = merged.withColumn("places_met", F.size(F.array_distinct(F.flatten("all_met"))))
    share = F.col("places_met") / F.col("places")
    verified = F.when(F.col("base"), share == 1.0).otherwise(
        (share >= SHARE) & (F.col("end") - F.col("start") <= F.col("length") + SHIFT))
    span = F.struct("label", "base", "start", "end", share.alias("share"))
    return (merged.withColumn("span", F.when((F.col("template") >= 0) & verified, span))
            .groupBy("rid").agg(F.max("doc_id").alias("doc_id"),
                                F.max(F.when(F.col("template") < 0, F.col("pos"))).alias("n_words"),
                                F.collect_list("span").alias("spans")))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's verified spans. The score is
    1 for a base phrase or a whole notice, else the best share of a notice."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(
        F.transform(spans, lambda s: s["label"]))), ",")
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))
