"""Operator 5, license scan by an exact set-similarity join (DataFrame functions only).

Base labels come from phrases whose words stand consecutively.  The method adds the labels of
license templates.  A text block is a window over the words of the whole text, a quarter longer than
the template, so a notice may wrap over lines or hold a few more words.  A template is found where a
window holds at least `threshold` of its distinct words, all the words that tell it from other
licenses among them.  That is an exact containment join:

* words are ordered by their global frequency (number of documents that hold them, counted over
  all documents; rare first, ties by the word itself);
* prefix filter: a window that reaches the threshold holds a word of the template's prefix (all
  but the last `need` - 1 words), so only windows around such a word are looked at;
* length filter: so near the text holds at least `need` different template words;
* positional filter: a window starts where a template word stands, and from there to the end of
  the stretch enough words must remain;
* the windows that are left are compared in full.  Of matches that overlap, one with a smaller
  containment is dropped if all its words stand inside the better one.

Only words of the templates and phrases can matter, so the scan keeps per document its number of
words, which of those words it holds, and the text if these reach some template or phrase at
all.  The list of templates is a parameter (a few hundred words), so its index is broadcast; the
documents are never shuffled, only the stretches around rare words.

Defined cases: null text is the empty text, with no words and no label; null and repeated
identifiers are separate documents, row by row; a very long text is scanned whole; of equal
matches of a label the first counts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.shared import documents, id_and_text, materialise

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# License notices by label (words as the scan sees them), with the words that tell each from others.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "permission granted charge software"),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "redistribution source binary permitted"),
    ("cc-by", "licensed under cc by 4 0", "licensed cc by 4"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general 3"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3", "gnu lesser general 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public 2"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]


def _window(words: int) -> int:
    """Words of a block for a template of so many: a quarter more."""
    return ceil(1.25 * words)


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def _places(words: Column, phrase: list[str]) -> Column:
    """Word positions (from 0) where the phrase stands."""
    last = F.size(words) - len(phrase)

    def here(i: Column) -> Column:
        ok = F.get(words, i) == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            ok = ok & (F.get(words, i + k) == w)
        return ok

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def _labelled(label: str, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str, str]] = TEMPLATES,
                  phrases: list[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, places (array of label, start of the base phrases),
    found (array of label, start, words, containment of the template matches: their windows from the
    first to the last word of the template)."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(t.split()))) for label, t, _ in templates]
    needs = [ceil(threshold * len(ws) - 1e-9) for _, ws in sets]
    vocabulary = sorted({w for _, ws in sets for w in ws} | {w for p, _ in phrases for w in p.split()})

    split = id_and_text(docs, id_col, text_col).withColumn("w", F.split(F.lower("text"), SEPARATORS))
    edge = (F.get("w", F.lit(0)) == "").cast("int") + ((F.size("w") > 1) & (F.get("w", F.size("w") - 1) == "")).cast("int")
    split = split.select("doc_id", "text", (F.size("w") - edge).cast("long").alias("n_words"),
                         F.array_intersect("w", _literal(vocabulary)).alias("held"))
    reach = F.lit(False)
    for (_, ws), need in zip(sets, needs):
        reach = reach | (F.size(F.array_intersect("held", _literal(ws))) >= need)
    for p, _ in phrases:
        reach = reach | (F.size(F.array_except(_literal(p.split()), F.col("held"))) == 0)
    scan = materialise(split.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "held",
                                    F.when(reach, F.col("text")).alias("text")), "scan")

    # global frequency order; the vocabulary bounds what is collected
    counts = {r.w: r.n for r in scan.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index, whole = [], []
    for t, ((label, ws), need, (_, told, must)) in enumerate(zip(sets, needs, templates, strict=True)):
        ranked = sorted(place[w] for w in ws)
        index += [(t, r) for r in ranked[:len(ranked) - need + 1]]
        whole.append((t, label, ranked, [place[w] for w in must.split()], need, _window(len(told.split()))))
    index = F.broadcast(spark.createDataFrame(index, "t int, r int"))
    whole = F.broadcast(spark.createDataFrame(whole, "t int, label string, ranked array<int>, must array<int>, need int, wide int"))

    ranks = F.create_map(*[x for w, i in place.items() for x in (F.lit(w), F.lit(i))])
    kept = scan.where(F.col("text").isNotNull())
    # a word of the vocabulary is its rank, any other -1; the stretch around a rare word is all that travels
    texts = kept.select("row", F.transform(_words(F.col("text")), lambda w: F.coalesce(F.element_at(ranks, w), F.lit(-1))).alias("w"))
    rare = texts.select("row", "w", F.posexplode("w").alias("p", "r")).where("r >= 0").join(index, "r").join(whole, "t")
    start = F.greatest(F.lit(0), F.col("p") - F.col("wide") + 1)
    near = rare.select("row", "p", "t", "label", "ranked", "must", "need", "wide", start.alias("at"), F.slice("w", start + 1, F.col("wide") + F.col("p") - start).alias("near"))
    near = near.where(F.size(F.array_intersect("near", "ranked")) >= F.col("need")).where(F.size(F.array_except("must", "near")) == 0)
    hits = near.select("row", "label", "ranked", "must", "need", "at", "near", "wide", F.explode(F.sequence(F.lit(0), F.col("p") - F.col("at"))).alias("s"))
    hits = hits.where((F.size("near") - F.col("s") >= F.col("need")) & F.array_contains("ranked", F.get("near", F.col("s"))))
    hits = hits.withColumn("block", F.slice("near", F.col("s") + 1, F.col("wide"))).withColumn("common", F.size(F.array_intersect("block", "ranked")))
    hits = hits.where((F.col("common") >= F.col("need")) & (F.size(F.array_except("must", "block")) == 0))
    within = F.filter(F.sequence(F.lit(0), F.size("block") - 1), lambda i: F.array_contains("ranked", F.get("block", i)))
    match = F.struct((F.col("common") / F.size("ranked")).alias("containment"), (-F.col("at") - F.col("s")).alias("before"), "label", (F.array_max(within) + 1).alias("words"), "common")
    found = hits.select("row", match.alias("m")).distinct().groupBy("row").agg(F.collect_set("m").alias("ms"))  # windows around rare words of one text

    def inside(m: Column, n: Column) -> Column:
        return (n.before >= m.before) & (m.words - m.before <= n.words - n.before) & (
            (n.containment > m.containment) | ((n.containment == m.containment) & (n.common > m.common)))

    better = F.filter("ms", lambda m: ~F.exists("ms", lambda n: inside(m, n)))
    hits = found.select("row", F.transform(better, lambda m: F.struct(m.label.alias("label"), (-m.before).alias("start"), m.words.alias("words"), m.containment.alias("containment"))).alias("found"))

    base = kept.withColumn("w", _words(F.col("text")))
    places = [_labelled(label, _places(F.col("w"), p.split())) for p, label in phrases]
    base = base.select(F.col("row").alias("base_row"), F.concat(*places).alias("places"))
    none = F.array()
    return (scan.select("row", "doc_id", "n_words")
            .join(base, F.col("row") == F.col("base_row"), "left").join(hits, "row", "left")
            .select("doc_id", "n_words", F.coalesce("places", none.cast("array<struct<label:string,start:int>>")).alias("places"),
                    F.coalesce("found", none.cast("array<struct<label:string,start:int,words:int,containment:double>>")).alias("found")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir))
    starts = F.transform("places", lambda p: p["start"])
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("found", lambda p: p["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"),
                        F.when(F.size("places") > 0, 1.0).otherwise(
                            F.coalesce(F.array_max(F.transform("found", lambda p: p["containment"])), F.lit(0.0))).alias("score"))


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_WORDS = r"""regexp_extract_all(translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS % "coalesce(text, '')"} AS w FROM documents),
phrases(label, p) AS (VALUES {", ".join(f"('{label}', {_sql_list(p.split())})" for p, label in PHRASES)}),
templates(label, t, must, wide) AS (VALUES {", ".join(f"('{label}', {_sql_list(sorted(set(t.split())))}, {_sql_list(m.split())}, {_window(len(t.split()))})" for label, t, m in TEMPLATES)}),
hit AS (SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS i FROM d, phrases),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hit GROUP BY doc_id),
starts AS (SELECT doc_id, label, t, must, i, w[i:i + wide - 1] AS block
           FROM (SELECT doc_id, w, label, t, must, wide, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(t, w[i]))) AS i
                 FROM d, templates WHERE len(list_intersect(w, t)) >= {THRESHOLD} * len(t) AND len(list_intersect(w, must)) = len(must))),
cont AS (SELECT doc_id, label, i, len(list_intersect(list_distinct(block), t)) / len(t) AS c, len(list_intersect(list_distinct(block), t)) AS common,
                i + list_max(list_filter(range(1, len(block) + 1), lambda k: list_contains(t, block[k]))) - 1 AS j
         FROM starts WHERE len(list_intersect(list_distinct(block), must)) = len(must)),
passed AS (SELECT * FROM cont WHERE c >= {THRESHOLD}),
more AS (SELECT doc_id, label, c FROM passed m WHERE NOT EXISTS (
           SELECT 1 FROM passed n WHERE n.doc_id = m.doc_id AND n.i <= m.i AND n.j >= m.j AND (n.c > m.c OR n.c = m.c AND n.common > m.common))),
lab AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM hit UNION ALL SELECT doc_id, label FROM more) GROUP BY doc_id),
top AS (SELECT doc_id, max(c) AS c FROM more GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(base.labels, '') AS base_labels,
       coalesce(lab.labels, '') AS labels, CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN lab USING (doc_id) LEFT JOIN top USING (doc_id)
"""
