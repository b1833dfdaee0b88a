"""Operator 9, chat formatting by event-sourced reconstruction (DataFrame functions only).

A log of events (conversation, sequence number, kind, message number, role, text) is partitioned
by conversation and sorted by sequence number; each message is the fold of its events:

* `message` sets the text, `edit` replaces it, `delta` appends to it;
* `regenerate` replaces the text and discards every event of later messages that came before it.

The messages of a conversation are then rendered in order as `<turn role="R">TEXT</turn>` lines.
`&`, `<` and `>` inside roles and texts are escaped (`&amp;`, `&lt;`, `&gt;`), so that no text can
imitate a turn mark and the original can be read back.  `loss_spans` are the code-point ranges
of the assistant texts in the output.

One shuffle by conversation serves every step.  A conversation is one output row by nature, so
its size is bounded by what one formatted row can hold; nothing else is gathered.

Defined cases: null role or text is the empty string; a message takes its last non-empty role; events of one message with equal sequence
numbers are folded in the order of kind, role and text; a null kind is `message`; a null
conversation number is a conversation of its own; an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.session import table_path

OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("&lt;"), F.lit("<"))
    c = F.replace(c, F.lit("&gt;"), F.lit(">"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log conv_id, seq, kind, message, role, text."""
    e = events.select("conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "message",
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    earlier = W.partitionBy("conv_id").orderBy("message").rangeBetween(W.unboundedPreceding, -1)
    cut = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    e = e.repartition("conv_id").withColumn("cut", cut).where(F.col("cut").isNull() | (F.col("seq") > F.col("cut")))
    log = F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text")))
    folded = e.groupBy("conv_id", "message").agg(log.alias("log"))
    # the text starts anew at the last event that is not a delta; deltas after it are appended
    fresh = F.aggregate("log", F.struct(F.lit(0).alias("i"), F.lit(1).alias("at")),
                        lambda s, x: F.struct((s["i"] + 1).alias("i"), F.when(x["kind"] != "delta", s["i"] + 1).otherwise(s["at"]).alias("at")),
                        lambda s: s["at"])
    tail = F.slice("log", fresh, F.size("log"))
    named = F.filter("log", lambda x: x["role"] != "")
    return folded.select("conv_id", "message", F.coalesce(F.try_element_at(named, F.lit(-1))["role"], F.lit("")).alias("role"),
                         F.array_join(F.transform(tail, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, end in code points; end exclusive)."""
    order = W.partitionBy("conv_id").orderBy("message")
    m = messages.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))).withColumn("body", escape(F.col("text")))
    m = m.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    m = m.withColumn("ends", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    end = F.col("ends") - len(CLOSE)
    m = m.withColumn("span", F.when(F.col("role") == "assistant", F.struct((end - F.length("body")).alias("start"), end.alias("end"))))
    g = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "piece", "span"))).alias("m"))
    return g.select("conv_id", F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
                    F.filter(F.transform("m", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def format_conversations(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted text says: conv_id, turns (array of role, text), loss_text."""
    parts = F.filter(F.split("formatted", CLOSE), lambda x: x != "")
    turns = F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
        unescape(F.substring_index(p, MIDDLE, -1)).alias("text")))
    under = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(under, "").alias("loss_text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of `conversations` is one `message` event; equal turns are ordered by role, text."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = spark.read.parquet(table_path(sf_dir, "conversations")).select("conv_id", "turn", "role", "text").unionByName(extra)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    events = rows.withColumn("message", F.row_number().over(order)).select(
        "conv_id", F.col("message").alias("seq"), F.lit("message").alias("kind"), "message", "role", "text")
    back = read_back(format_conversations(events))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS r,
                replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS x FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(r) + length(x) + 22)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
