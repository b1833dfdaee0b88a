"""Operator 7, personal data by bootstrapped contextual extraction.

Seeds are the matches of four fixed patterns (email, ip, card, phone).  Each seed, and each other
token that looks like an identifier (it holds a digit or `@`), is an occurrence with its lexical
contexts: the word before, the two words before, and the words on both sides.  Spark scores the
graph of contexts and values in rounds: a context is trusted for a kind when enough different
values of that kind stand in it and few others do; a value is trusted when its contexts are;
trusted values count as seeds of the next round.  Occurrences of the trusted values become spans.

The scan runs over Arrow batches, one row at a time inside its task; texts without a digit or `@`
are skipped by a byte mask.  All patterns are applied so that they take time linear in the text.
Contexts and values are combined map-side before every shuffle, so a common context or value is
folded where it is read.

Defined cases: null text is the empty text; null and repeated identifiers are separate documents,
row by row; an empty table gives an empty result; a found span that overlaps a base span is
dropped; other columns are not read.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text, materialise

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
MIN_SUPPORT = 5  # different trusted values of a kind in a context
MIN_CONFIDENCE = 0.8  # their share of all values in it
MIN_SCORE = 0.9  # of a value, to be trusted
MIN_VALUE, MAX_VALUE = 5, 64  # characters of an identifier that is not a seed

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = np.zeros(256, dtype=np.int64)
_MARK[0x30:0x3A] = _MARK[ord("@")] = 1

SPAN = "struct<kind:string,start:int,end:int>"
OCCURRENCE = "struct<kind:string,start:int,end:int,value:string,before:string,before2:string,after:string>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of LOCAL+@DOMAIN: the local part is the run before an @ (not before the last match)."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Dotted quads: each chain of dotted numbers gives one match for every four parts."""
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            quad = parts[k:k + 4]
            end = at + sum(map(len, quad)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in quad):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of all base matches, sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if "." in text:
        out += [(a, 1, b) for a, b in addresses(text)]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def occurrences(text: str, base: list[tuple[int, int, str]]) -> list[dict]:
    """Seeds and other identifier-like tokens with their contexts."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    spans = [(a, b, KINDS[k]) for a, k, b in base]
    taken = sorted((a, b) for a, b, _ in spans)
    import bisect

    def free(a: int, b: int) -> bool:
        i = bisect.bisect_left(taken, (b, -1))
        return all(y <= a for _, y in taken[max(0, i - 8):i])

    for a, b in tokens:
        word = text[a:b]
        if not any(c.isdigit() and c.isascii() or c == "@" for c in word):
            continue
        cut = max(word.find("="), word.find(":")) + 1  # name=value, name:value
        x, y = a + cut, b
        while x < y and not (text[x].isalnum() or text[x] in "+@"):
            x += 1
        while y > x and not text[y - 1].isalnum():
            y -= 1
        if MIN_VALUE <= y - x <= MAX_VALUE and free(x, y):
            spans.append((x, y, None))
    out = []
    for a, b, kind in sorted(spans, key=lambda s: (s[0], s[1], s[2] or "")):
        i, j = bisect.bisect_right(starts, a) - 1, bisect.bisect_left(starts, b)
        words = [text[max(p, 0):q] for p, q in tokens[max(0, i - 2):i]]
        if a > starts[i]:
            words.append(text[starts[i]:a])
        words = [w.lower()[-MAX_VALUE:] for w in words]
        after = text[tokens[j][0]:tokens[j][1]].lower()[:MAX_VALUE] if j < len(tokens) else "$"
        one = words[-1] if words else "^"
        two = f"{words[-2] if len(words) > 1 else '^'} {one}"
        out.append({"kind": kind, "start": a, "end": b, "value": text[a:b].lower(), "before": one, "before2": two, "after": after})
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (base), seen (occurrences) of every row."""
    schema = f"doc_id long, spans array<{SPAN}>, seen array<{OCCURRENCE}>"
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    seen_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), *[(c, pa.string()) for c in ("value", "before", "before2", "after")]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, b, data, off in T.slices(texts):
                marks = np.concatenate([[0], np.cumsum(_MARK[data])])[off]
                spans: list = [[] for _ in range(b - a)]
                seen: list = [[] for _ in range(b - a)]
                for i in np.flatnonzero(np.diff(marks)):
                    text = texts[a + int(i)].as_py()
                    base = base_spans(text)
                    spans[i] = [{"kind": KINDS[k], "start": x, "end": y} for x, k, y in base]
                    seen[i] = occurrences(text, base)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(spans, span_type), pa.array(seen, seen_type)], ["doc_id", "spans", "seen"])

    return docs.mapInArrow(run, schema)


def trusted_values(seen: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
                   min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> DataFrame:
    """value, kind, score of values that are not seeds but stand in trusted contexts.
    `seen`: kind (null: not a seed), value, before, before2, after, one row per occurrence."""
    contexts = F.array(F.concat(F.lit("1 "), "before"), F.concat(F.lit("2 "), "before2"), F.concat(F.lit("3 "), "before", F.lit(" | "), "after"))
    edges = materialise(seen.select("value", F.explode(contexts).alias("context")).distinct(), "edges")
    size = edges.groupBy("context").agg(F.count("*").alias("values"))
    known = seen.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    known = materialise(known, "seeds")
    found = known.limit(0)
    for _ in range(rounds):
        trusted = known.unionByName(found)
        support = edges.join(trusted, "value").groupBy("context", "kind").agg(F.sum("score").alias("support")).where(F.col("support") >= min_support)
        good = (support.join(size, "context").withColumn("confidence", F.col("support") / F.col("values"))
                .where(F.col("confidence") >= min_confidence).select("context", "kind", "confidence"))
        doubt = F.log(1 - F.least(F.col("confidence"), F.lit(0.99)))
        scored = edges.join(good, "context").groupBy("value", "kind").agg((1 - F.exp(F.sum(doubt))).alias("score")).where(F.col("score") >= min_score)
        found = materialise(scored.join(known, ["value", "kind"], "left_anti"), "found")
    return found


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (base), more (spans the method adds), both by start."""
    rows = materialise(scan(id_and_text(docs, id_col, text_col)).withColumn("row", F.monotonically_increasing_id()), "scan")
    seen = rows.select("row", "spans", F.explode("seen").alias("s")).select("row", "spans", "s.*")
    found = trusted_values(seen.select("kind", "value", "before", "before2", "after"))
    clear = F.forall("spans", lambda b: (b["end"] <= F.col("start")) | (b["start"] >= F.col("end")))
    best = found.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("found_kind"))
    more = (seen.where("kind IS NULL").where(clear).join(best, "value")
            .groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", F.col("found_kind").alias("kind"), "end"))).alias("m")))
    more = more.select("row", F.transform("m", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("more"))
    return rows.join(more, "row", "left").select("doc_id", "spans", F.coalesce("more", F.array().cast(f"array<{SPAN}>")).alias("more"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    rank = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(F.concat("spans", "more"), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(F.array_join(F.transform("spans", said), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform(ordered, said), ",").alias("spans"))
