"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events (conv_id, seq, msg, kind, role, text):

* ``delta``: text appended to message ``msg``;
* ``edit``: the message's text so far is replaced by the event's;
* ``regenerate``: message ``msg`` starts over with the event's text, and what the
  log holds so far of it and of later messages no longer counts.

Logs are dealt out by conversation, put in order of ``seq`` (ties: by the event's kind
and text) and folded into final messages, which are rendered in order of ``msg``:

    ### role: text </turn>\\n

Texts and roles can't break the frame: a backslash, ``###`` and ``</turn>`` are
written as ``\\b``, ``\\h`` and ``\\t`` (in roles also ``:`` as ``\\c``), so the two
control strings occur in the output only where the template puts them, and
`read_back` is exact. The loss mask is the list of spans to train on: the
assistant's texts, by turn, start and length in code points of the rendered
turn.

Native: DataFrame and SQL functions only. A regeneration's effect is looked
up from the conversation's regenerations alone, and deltas are folded per message, so a
conversation with a third of all events is spread over many tasks up to
the rendered turns; these meet in one row, because a conversation is one text.

Defined cases: null text and null role are empty; a null id is a
conversation of its own; events of equal seq, kind and text are folded like any others;
a null msg sorts first; other columns are ignored; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_marts.llm.common import table

END = " </turn>\n"


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in (("</turn>", "\\t"), ("###", "\\h"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\c"), F.lit(":")))


def final_messages(events: DataFrame) -> DataFrame:
    """conv_id, msg, role, text of every message that the log leaves."""
    e = events.select("conv_id", "seq", "msg", "kind", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a conversation's regenerations, few beside its deltas
    redo = (e.where("kind = 'regenerate'").groupBy("conv_id")
            .agg(F.collect_set(F.struct("seq", "msg")).alias("redo")).withColumnRenamed("conv_id", "redo_conv"))
    e = e.join(redo, e["conv_id"].eqNullSafe(redo["redo_conv"]), "left")
    dropped = F.exists("redo", lambda r: (r["seq"] > F.col("seq")) & (r["msg"] <= F.col("msg")))
    kept = e.where(~F.coalesce(dropped, F.lit(False))).drop("redo", "redo_conv")
    log = F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role")))
    # fold: the parts from the last edit or regeneration on, joined once
    last = F.array_max(F.transform("log", lambda x, i: F.when(x["kind"] != "delta", i).otherwise(0)))
    one = kept.groupBy("conv_id", "msg").agg(log.alias("log")).withColumn("last", last)
    role = F.coalesce(F.try_element_at(F.filter(F.transform("log", lambda x: x["role"]), lambda r: r != ""), F.lit(-1)), F.lit(""))
    return one.select("conv_id", "msg", role.alias("role"), F.array_join(F.transform(
        F.slice("log", F.col("last") + 1, F.size("log")), lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (turn, start, length) from final messages."""
    head = F.concat(F.lit("### "), escape_role(F.col("role")), F.lit(": "))
    turn = messages.select("conv_id", "msg", head.alias("head"), escape(F.col("text")).alias("body"),
                           (F.col("role") == learn_role).alias("learn"))
    turn = turn.select("conv_id", F.struct("msg", F.concat("head", "body", F.lit(END)).alias("out"), "learn",
                                           F.length("head").alias("start"), F.length("body").alias("length")).alias("turn"))
    chat = turn.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["start"].alias("start"), t["length"].alias("length"), t["learn"].alias("learn")))
    return chat.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
                       F.transform(F.filter(spans, lambda s: s["learn"]), lambda s: s.dropFields("learn")).alias("loss_spans"))


def format_chats(events: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """The whole operator: fold the log, render the messages."""
    return render(final_messages(events), learn_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader gets from formatted text and mask alone: turns (role, text) and the text under the mask."""
    parts = F.split("formatted", END)
    df = formatted.withColumn("parts", F.slice(parts, F.lit(1), F.size(parts) - 1))
    role = lambda p: unescape_role(F.substring_index(F.substring(p, F.lit(5), F.length(p)), ": ", 1))
    text = lambda p: unescape(F.substring(p, F.instr(p, ": ") + 2, F.length(p)))
    return df.withColumn("turns", F.transform("parts", lambda p: F.struct(role(p).alias("role"), text(p).alias("text")))).withColumn(
        "loss_text", F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
            F.get("parts", s["turn"]), s["start"] + 1, s["length"]))), "")).drop("parts")


def as_events(conversations: DataFrame) -> DataFrame:
    """Finished conversations as a log: every row is the only delta of its message. Rows of the
    same turn keep an order of their own (by role and text)."""
    rank = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("rank", rank).select(
        "conv_id", F.struct("turn", "rank").alias("seq"), F.struct("turn", "rank").alias("msg"), F.lit("delta").alias("kind"), "role", "text")


def op10_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every conversation's formatted text, read back; conversation -7 quotes the control strings."""
    src = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    odd = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), odd.alias("text"))
    got = read_back(format_chats(as_events(src.unionByName(extra))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"),
                      F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t')"


OP10_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(replace({_esc('role')}, ':', '\\c')) + 2 + length({_esc('text')}) + {len(END)})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
