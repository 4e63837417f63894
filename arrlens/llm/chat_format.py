"""Chat formatting (8): typed content parts to one marked text a conversation.

A message's content is a list of typed parts. A visitor flattens them in
order: text is escaped, each image, audio or document part becomes a numbered
placeholder whose reference and expanded token count are kept beside the text.
Turns are marked ``<turn role>`` and ``</turn>``; a backslash, ``<`` and ``>``
inside texts and roles are written ``\\b``, ``\\l`` and ``\\g``, so no text can
hold a mark, and the original is read back exactly. The loss mask covers what
assistants say. DataFrame functions only.

Defined results: null texts, roles and part types are empty (a part of unknown
type is text); messages are ordered by (turn, role, text), nulls first;
repeated rows are repeated turns; a null conv_id is a conversation of its own;
an empty table gives an empty table; other columns are not read. A
conversation is one row of output, so its own text bounds what a task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
MEDIA = ("image", "audio", "document")
#: Expanded tokens: for each image patch of so many pixels a side, second of
#: audio, and page.
PATCH, TOKENS_A_SECOND, TOKENS_A_PAGE = 14, 25, 256
CLOSE = "</turn>\n"


def escape(x: Column) -> Column:
    x = F.replace(x, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(x, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(x: Column) -> Column:
    x = F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(x, F.lit("\\b"), F.lit("\\"))


def _is_media(p: Column) -> Column:
    return F.coalesce(p["type"].isin(*MEDIA), F.lit(False))


def _tokens(p: Column) -> Column:
    """Expanded tokens of a media part; unknown measures count as none."""
    image = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    audio = F.ceil(p["seconds"] * TOKENS_A_SECOND)
    kind = F.when(p["type"] == "image", image).when(p["type"] == "audio", audio).otherwise(p["pages"] * TOKENS_A_PAGE)
    return F.coalesce(kind, F.lit(0)).cast("long")


def with_parts(messages: DataFrame) -> DataFrame:
    """Messages with plain ``text`` given a ``parts`` column."""
    parts = F.array(F.struct(
        F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("uri"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))
    return messages.select("conv_id", "turn", "role", parts.alias("parts"))


def formatted(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """From (conv_id, turn, role, parts): conv_id, ``formatted``,
    ``loss_spans`` (start, length in code points), ``attachments`` (index, type,
    uri, tokens) and ``media_tokens``."""
    role = F.coalesce("role", F.lit(""))
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    rows = messages.select("conv_id", "turn", role.alias("role"), parts.alias("parts"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rows = (rows.withColumn("media", F.filter("parts", _is_media))
            .withColumn("at", F.row_number().over(order))
            .withColumn("base", F.coalesce(F.sum(F.size("media")).over(before), F.lit(0))))

    def visit(p: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(F.col("parts"), 1, i), _is_media))
        mark = F.concat(F.lit("<"), p["type"], F.lit(" "), (F.col("base") + earlier).cast("string"), F.lit(">"))
        return F.when(_is_media(p), mark).otherwise(escape(F.coalesce(p["text"], F.lit(""))))

    def reference(p: Column, i: Column) -> Column:
        return F.struct((F.col("base") + i).cast("long").alias("index"), p["type"].alias("type"),
                        p["uri"].alias("uri"), _tokens(p).alias("tokens"))

    rows = (rows.withColumn("head", F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">\n")))
            .withColumn("body", F.array_join(F.transform("parts", visit), ""))
            .withColumn("refs", F.transform("media", reference))
            .withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
            .withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0))))
    span = F.when(F.col("role") == loss_role, F.struct(
        (F.col("start") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    held = F.sort_array(F.collect_list(F.struct("at", "piece", span.alias("span"), "refs")))
    out = rows.groupBy("conv_id").agg(held.alias("held"))
    refs = F.flatten(F.col("held.refs"))
    return out.select(
        "conv_id", F.array_join("held.piece", "").alias("formatted"),
        F.filter("held.span", lambda s: s.isNotNull()).alias("loss_spans"), refs.alias("attachments"),
        F.aggregate(refs, F.lit(0).cast("long"), lambda a, r: a + r["tokens"]).alias("media_tokens"))


def turns_of(text: Column) -> Column:
    """The (role, text) turns of a formatted text."""
    def turn(t: Column) -> Column:
        head = F.substring_index(t, ">", 1)
        return F.struct(unescape(F.substr(head, F.lit(7))).alias("role"),
                        unescape(F.substr(t, F.length(head) + 3)).alias("text"))
    pieces = F.split(text, CLOSE)
    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def loss_text_of(text: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


PROBE = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    out = stored(formatted(with_parts(said.unionByName(probe))), "chats")
    turns = turns_of(F.col("formatted"))
    loss = loss_text_of(F.col("formatted"), F.col("loss_spans"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumn("turns", turns).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


_ESCAPED = "length({x}) + length({x}) - length(replace(replace(replace({x}, '\\', ''), '<', ''), '>', ''))"
ORACLE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum({_ESCAPED.format(x='role')} + {_ESCAPED.format(x='text')} + 16) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""
