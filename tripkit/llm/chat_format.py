"""Chat formatting from an event log.

A message's text is the fold of its events in sequence: a ``delta`` appends, an
``edit`` replaces what is there, a ``regenerate`` discards it. The fold is
associative, (was there a reset, text since the last reset), so it runs first
within blocks of events and then over the blocks: a message or conversation
with a third of all rows is folded by many tasks and only meets as its final
string. Rendering marks turns and escapes control strings inside texts
reversibly; the loss mask covers the assistant texts.

All DataFrame functions. Defined results: null texts and roles are empty
strings; an unknown or null kind counts as a delta; events of equal sequence go
in the order (kind, text); messages of equal turn in the order (role, text);
repeated rows are separate messages; a null conversation id is a conversation,
a null turn or sequence comes first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import table

TURN, END = "<|turn|>", "<|end|>"
#: Control strings that a text may not show unescaped; each starts with < or [.
CONTROLS = ["<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_TAILS = r"(\|turn\|>|\|end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
LOSS_ROLE = "assistant"
BLOCK = 256


def escape(text: Column) -> Column:
    """One more backslash after the first character of every control string, escaped or not."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAILS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAILS, r"$1$2$3")


def _role_in(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _fold(parts: Column) -> Column:
    """Fold sorted parts (at, ..., reset, text): any reset, and the text from the last reset on."""
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x["reset"], i)))
    kept = F.filter(parts, lambda x, i: i >= F.coalesce(last, F.lit(0)))
    return F.struct(last.isNotNull().alias("reset"), F.array_join(F.transform(kept, lambda x: x["text"]), "").alias("text"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) from events
    (conv_id, message_id, turn, role, seq, kind, text)."""
    kind = F.coalesce(F.col("kind"), F.lit("delta"))
    part = F.struct("seq", kind.alias("kind"), F.when(kind == "regenerate", "").otherwise(F.coalesce("text", F.lit(""))).alias("text"),
                    kind.isin("edit", "regenerate").alias("reset"))
    ids = ["conv_id", "message_id", "turn", "role"]
    blocks = (events.groupBy(*ids, F.floor(F.col("seq") / BLOCK).alias("block"))
              .agg(_fold(F.sort_array(F.collect_list(part))).alias("f")))
    whole = F.sort_array(F.collect_list(F.struct("block", F.col("f.text").alias("text"), F.col("f.reset").alias("reset"))))
    return blocks.groupBy(*ids).agg(_fold(whole)["text"].alias("text")).drop("message_id")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``mask``, an array with, per turn,
    the code points to ``skip`` from the turn's marker on and then to ``take``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN), _role_in(role), F.lit("\n"))
    m = messages.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"))
    turn = F.struct("turn", "role", "text", F.concat("head", "body", F.lit(END)).alias("s"),
                    F.struct(F.length("head").alias("skip"),
                             F.when(F.col("role") == LOSS_ROLE, F.length("body")).otherwise(F.lit(0)).alias("take")).alias("m"))
    blocks = (m.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block"))
              .agg(F.sort_array(F.collect_list(turn)).alias("t"))
              .select("conv_id", "block", F.array_join(F.transform("t", lambda x: x["s"]), "").alias("s"),
                      F.transform("t", lambda x: x["m"]).alias("m")))
    return (blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "s", "m"))).alias("b"))
            .select("conv_id", F.array_join(F.transform("b", lambda x: x["s"]), "").alias("formatted"),
                    F.flatten(F.transform("b", lambda x: x["m"])).alias("mask")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` into ``turns`` (role, text) and ``loss`` (texts under the mask, in order)."""
    parts = F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.size("mask"))
    turns = F.transform("parts", lambda p: F.struct(
        _role_out(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2,
                             F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(END))).alias("text")))
    under = F.filter(F.zip_with("parts", "mask", lambda p, m: F.when(
        m["take"] > 0, unescape(F.substring(p, m["skip"] - len(TURN) + 1, m["take"])))), lambda x: x.isNotNull())
    return formatted.withColumn("parts", parts).withColumn("turns", turns).withColumn("loss", under).drop("parts")


def event_log(rows: DataFrame) -> DataFrame:
    """A log that ends in ``rows`` (conv_id, turn, role, text): every message is streamed in
    two deltas, after a first draft that is regenerated (assistant) or edited (others)."""
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    left, right = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    model = F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False))

    def event(seq: int, kind: Column, value: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), kind.alias("kind"), value.alias("text"))

    log = F.array(event(0, F.lit("delta"), right),
                  event(1, F.when(model, "regenerate").otherwise("edit"), F.when(~model, left)),
                  event(2, F.lit("delta"), F.when(model, left).otherwise(F.lit(""))),
                  event(3, F.lit("delta"), right))
    return (rows.withColumn("message_id", F.monotonically_increasing_id())
            .select("conv_id", "message_id", "turn", "role", F.explode(log).alias("e"))
            .select("conv_id", "message_id", "turn", "role", "e.*"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = read_back(render(fold_events(event_log(rows.unionByName(own)))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


_SQL_TAILS = r"(\|turn\|>|\|end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
OP9_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, '{TURN}' || regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'), '([<\[])(\\*){_SQL_TAILS}', '\1\\\2\3', 'g')
         || chr(10) || regexp_replace(text, '([<\[])(\\*){_SQL_TAILS}', '\1\\\2\3', 'g') || '{END}' AS shown FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(shown))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
