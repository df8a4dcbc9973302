"""Personal data: patterns propose spans, checksums confirm, context scores.

Kinds, in reporting order: the four base kinds email, ip, card and phone, and
iban, which the method adds. A card must pass Luhn and an iban mod 97; the
digits of an ip are at most 255. Words near a span that name its kind raise
its score, words that speak of other numbers lower it. Scores only rank spans:
every confirmed span is reported.

All scans are linear in the text: an address is found from its "@", and runs
of digits are matched possessively, so no start inside a run is tried twice.

Null and empty texts have no spans. Rows are independent of each other, so
repeated rows repeat their result. Spans of different kinds may overlap;
:func:`mask` replaces the union, each merged span by the kind that starts it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import per_chunk, wrapped

KINDS = ("email", "ip", "card", "phone", "iban")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

#: Score of a confirmed span before context, and how far words move it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEAR, STEP = 40, 0.1
HINTS = {
    "email": re.compile(r"mail|contact|write|kontakt|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|dirección", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|\btel|call|mobile|fax|anruf|appel|llam", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
}
OTHERS = re.compile(r"version|order|serial|isbn|ticket|invoice", re.I)


def emails(text: str):
    """Spans of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`."""
    done, at = 0, text.find("@")
    while at >= 0:
        if (m := DOMAIN.match(text, at + 1)):
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        # a local part never reaches over an "@", so earlier text is settled
        done = max(done, at + 1)
        at = text.find("@", done)


def ips(text: str):
    """Spans of four dotted numbers; a chain of more is cut from its left."""
    for m in DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            start, parts = m.start(), m.group().split(".")
            for i in range(0, len(parts) - 3, 4):
                four = parts[i:i + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                    yield start, end
                start = end + 1


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield m.span()


def ibans(text: str):
    for m in IBAN.finditer(text):
        s = m.group().replace(" ", "")
        if 15 <= len(s) <= 34 and mod97(s):
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans}


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score), by kind, then start; code points."""
    out = []
    if text:
        for kind in KINDS:
            for a, b in FINDERS[kind](text):
                before, after = text[max(0, a - NEAR):a], text[b:b + NEAR]
                score = PRIOR[kind]
                score += STEP * (bool(HINTS[kind].search(before)) or bool(HINTS[kind].search(after)))
                score -= 2 * STEP * bool(OTHERS.search(before))
                out.append((kind, a, b, round(min(1.0, max(0.0, score)), 2)))
    return out


def replace(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """The text with each run of overlapping spans replaced by its first kind."""
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def detect(df: DataFrame, text: str = "text", spans: str = "spans", masked: str | None = None) -> DataFrame:
    """Add ``spans`` (array of kind, start, end, score) and, if named, the masked text."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(part.schema.get_field_index(text)).to_pylist()
        found = [find(t) for t in texts]
        cols, names = list(part.columns), list(part.schema.names)
        cols.append(pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in f] for f in found], pa.list_(SPAN)))
        names.append(spans)
        if masked:
            cols.append(pa.array([replace(t, f) for t, f in zip(texts, found)], pa.string()))
            names.append(masked)
        return pa.RecordBatch.from_arrays(cols, names=names)

    out = df.withColumn(spans, F.lit(None).cast(
        "array<struct<kind:string,start:bigint,end:bigint,score:double>>"))
    if masked:
        out = out.withColumn(masked, F.lit(None).cast("string"))
    return df.mapInArrow(per_chunk(run, text), out.schema)


def report(docs: DataFrame) -> DataFrame:
    """The contract's counts and digests, from the operator's spans."""
    found = detect(docs.select("doc_id", "text")).drop("text")
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = KINDS[:4]
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"))


def mask(docs: DataFrame) -> DataFrame:
    """Documents with personal data replaced; same columns, ``n_chars`` kept true."""
    found = detect(wrapped(docs).select("row", "text"), masked="masked")
    kind = docs.schema
    return found.select(*[
        F.col("masked").alias(c) if c == "text"
        else F.char_length("masked").cast(kind[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
