"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, its own text
under the loss. A closing row per conversation holds the turns behind the last reply, so
the examples keep whole conversations.

Template: ``<s>role`` newline, the text, ``</s>`` for an assistant turn, and
``[INST]role`` newline, the text, ``[/INST]`` for any other. Inside roles and texts a
backslash is doubled and a control string gets a backslash behind its first character;
dropping each backslash that starts a pair restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.workspace import Workspace

# The control strings of the template and their escaping.
ASSISTANT = "assistant"
OPEN_REPLY, CLOSE_REPLY = "<s>", "</s>"
OPEN_TURN, CLOSE_TURN = "[INST]", "[/INST]"
CONTROL_START = r"<(?=/?s>)|\[(?=/?INST\])"
#: A formatted turn; its groups are role and text.
TURN = r"(?s)(?:<s>|\[INST\])([^\n]*+)\n(.*?)(?:</s>|\[/INST\])"


def escape(text: Column) -> Column:
    """Break up control strings."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL_START, r"$0\\")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line break, which ends a role, becomes a backslash and ``n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def unescape_role(role: Column) -> Column:
    restored = F.transform(
        F.split(role, r"\\\\"),
        lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")),
    )
    return F.array_join(restored, "\\")


def _formatted(turn: Column) -> Column:
    reply = turn["role"] == ASSISTANT
    return F.concat(
        F.when(reply, OPEN_REPLY).otherwise(OPEN_TURN),
        escape_role(turn["role"]),
        F.lit("\n"),
        escape(turn["text"]),
        F.when(reply, CLOSE_REPLY).otherwise(CLOSE_TURN),
    )


def expand(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn, and a closing row per conversation.

    Columns: conv_id, example (from 0), formatted (context and target), loss_start and
    loss_chars (code points of ``formatted`` under the loss; 0 for the closing row, whose
    text is the whole conversation), closing.

    Turns are ordered by turn, null first, then by role and text; a null role or text is
    empty; rows with a null conv_id are one conversation; repeated rows are turns of
    their own; no rows give no rows. Other columns are ignored.
    """
    blank = F.lit("")
    turns = (
        conversations.select(
            "conv_id",
            F.struct(
                F.col("turn"),
                F.coalesce("role", blank).alias("role"),
                F.coalesce("text", blank).alias("text"),
            ).alias("at"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("at")).alias("turns"))
        .select(
            "conv_id",
            F.transform(
                "turns",
                lambda t: F.struct(
                    (t["role"] == ASSISTANT).alias("reply"),
                    _formatted(t).alias("formatted"),
                    F.char_length(escape(t["text"])).cast("long").alias("chars"),
                ),
            ).alias("turns"),
        )
    )
    count = F.size("turns")
    ends = F.filter(
        F.sequence(F.lit(1), count + 1),
        lambda i: (i == count + 1) | F.get("turns", i - 1)["reply"],
    )
    rows = turns.select("conv_id", "turns", F.posexplode(ends).alias("example", "end"))
    text = F.array_join(F.transform(F.slice("turns", 1, F.least("end", count)), lambda t: t["formatted"]), "")
    closing = F.col("end") > count
    return rows.select("conv_id", "example", text.alias("formatted"), closing.alias("closing"),
        F.when(closing, F.lit(0)).otherwise(F.get("turns", F.col("end") - 1)["chars"]).cast("long").alias("loss_chars"),
    ).select(
        "conv_id",
        "example",
        "formatted",
        F.when(F.col("closing"), F.lit(0))
        .otherwise(F.char_length("formatted") - len(CLOSE_REPLY) - F.col("loss_chars"))
        .cast("long")
        .alias("loss_start"),
        "loss_chars",
        "closing",
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read from the examples: turns, trained text and size.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    (code points of the whole formatted conversation).
    """
    masked = F.col("formatted").substr(
        (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")
    )
    rows = examples.select(
        "conv_id",
        F.when(F.col("closing"), F.col("formatted")).alias("whole"),
        F.when(~F.col("closing"), F.struct("example", unescape(masked).alias("text"))).alias("reply"),
    )
    found = rows.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list("reply")).alias("replies")
    )
    pieces = F.regexp_extract_all("whole", F.lit(TURN), F.lit(0))
    lines = F.transform(
        "pieces",
        lambda t: F.concat(
            unescape_role(F.regexp_extract(t, TURN, 1)),
            F.lit("\n"),
            unescape(F.regexp_extract(t, TURN, 2)),
            F.lit("\n"),
        ),
    )
    trained = F.array_join(F.transform("replies", lambda r: r["text"]), "")
    return found.withColumn("pieces", pieces).select(
        "conv_id",
        F.size("pieces").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"),
        F.sha2(F.encode(trained, "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("whole").cast("long").alias("formatted_chars"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    added = spark.sql(
        "SELECT -7L AS conv_id, stack(2, 0L, 'user', :odd, 1L, 'assistant', :odd) AS (turn, role, text)",
        {"odd": odd},
    )
    examples = Workspace(spark, "chat").save(expand(rows.unionByName(added)), "examples")
    return digest(examples)


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, role = 'assistant' AS reply,
         length(text) + length(text) - length(replace(text, chr(92), ''))
         + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]')) AS text_chars,
         length(role) + length(role) - length(replace(role, chr(92), ''))
         + length(role) - length(replace(role, chr(10), ''))
         + len(regexp_extract_all(role, '<s>|</s>|\[INST\]|\[/INST\]')) AS role_chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (reply), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (reply), '')) AS loss_sha256,
       sum(text_chars + role_chars + 1 + CASE WHEN reply THEN 7 ELSE 13 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
