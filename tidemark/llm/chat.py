r"""Chat formatting with typed content parts, in DataFrame functions only.

A message holds an ordered array of parts ``struct<kind, text, ref, units>``.
``flatten_parts`` visits them in order: a text part gives its escaped text, an
image, audio or document part gives a numbered placeholder, an entry in the
attachment list (number, kind, reference) and its expanded token count, which
the part kind derives from ``units`` (image tiles, audio seconds, pages).

``format_conversations`` then renders turns as ``<turn ROLE>BODY</turn>\n``.
Inside roles and texts the three control characters are escaped one to one

    ``\`` -> ``\b``    ``<`` -> ``\l``    ``>`` -> ``\g``

so no text can contain a marker and ``unescape`` restores it exactly. Next to
the string stands the loss mask as run lengths over it (``in_loss`` is true on
the bodies of assistant turns).

Scale: a conversation is one training example and must fit one row. Turns are
rendered before any shuffle, gathered first by blocks of ``TURN_BLOCK`` turn
numbers and only then by conversation, so one conversation with very many turns
is rendered, sorted and joined by many tasks and its last step gets one row
per block.

Defined results: null roles and texts are empty; equal rows each count as a
turn; equal turn numbers are ordered by role, then text; a null conversation id
is one conversation; null turn numbers come first; a conversation with a hundred
thousand turns is one row; an empty table gives an empty one; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

TURN_BLOCK = 256
LOSS_ROLE = "assistant"
# Tokens that one unit of a non-text part expands to.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")),
                     F.lit(">"), F.lit("\\g"))


def unescape(c: Column) -> Column:
    """Every backslash of an escaped text starts an escape, so the order below is safe."""
    return F.replace(F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")),
                     F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def flatten_parts(parts: Column) -> Column:
    """struct<body, attachments, expanded_tokens> of a message's parts.

    A part of unknown kind is a document; null parts and null texts are empty;
    missing or negative units count as one.
    """
    kind = lambda p: F.when(p["kind"].isin(*UNIT_TOKENS), p["kind"]).otherwise(F.lit("document"))
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    is_text = lambda p: F.coalesce(p["kind"], F.lit("")) == "text"
    media = F.filter(parts, lambda p: ~is_text(p))
    per_unit = lambda p: F.element_at(
        F.create_map(*[F.lit(x) for kv in UNIT_TOKENS.items() for x in kv]), kind(p)).cast("bigint")
    tokens = lambda p: per_unit(p) * F.greatest(F.coalesce(p["units"], F.lit(1)), F.lit(1))
    attachments = F.transform(media, lambda p, i: F.struct(
        i.cast("bigint").alias("number"), kind(p).alias("kind"), p["ref"].alias("ref"), tokens(p).alias("tokens")))
    # The n-th placeholder carries n: the media parts before it, counted in the array of flags.
    flags = F.transform(parts, lambda p: F.when(is_text(p), F.lit(0)).otherwise(F.lit(1)))
    body = F.transform(parts, lambda p, i: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<"), kind(p), F.lit(" "),
                 F.aggregate(F.slice(flags, F.lit(1), i), F.lit(0), lambda a, x: a + x).cast("string"), F.lit(">"))))
    return F.struct(F.array_join(body, "").alias("body"), attachments.alias("attachments"),
                    F.aggregate(attachments, F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"])
                    .alias("expanded_tokens"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    Returns conv_id, formatted, mask (array<struct<n_chars, in_loss>> over
    ``formatted``), attachments (with their turn) and expanded_tokens.
    """
    flat = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        flatten_parts(F.col("parts")).alias("m"))
    # The sort key and what the turn adds to the conversation; the raw role decides the mask.
    head = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">"))
    rendered = flat.select(
        "conv_id", F.floor(F.coalesce("turn", F.lit(-1)) / TURN_BLOCK).alias("block"),
        F.struct("turn", "role", F.col("m.body").alias("body"), F.length(head).alias("head"),
                 F.length("m.body").alias("chars"), (F.col("role") == LOSS_ROLE).alias("loss"),
                 F.col("m.attachments").alias("attachments"), F.col("m.expanded_tokens").alias("tokens")).alias("x"))
    run = lambda n, loss: F.struct(n.cast("bigint").alias("n_chars"), loss.alias("in_loss"))
    tail = "</turn>\n"
    xs = F.col("xs")
    # Equal turns and roles are ordered by what they say, not by its escaped form.
    said = lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), unescape(x["body"]).alias("said"),
                              *[x[c].alias(c) for c in ("body", "head", "chars", "loss", "attachments", "tokens")])
    blocks = rendered.groupBy("conv_id", "block").agg(F.sort_array(F.transform(F.collect_list("x"), said)).alias("xs")).select(
        "conv_id", F.struct(
            "block",
            F.array_join(F.transform(xs, lambda x: F.concat(
                F.lit("<turn "), escape(x["role"]), F.lit(">"), x["body"], F.lit(tail))), "").alias("text"),
            F.flatten(F.transform(xs, lambda x: F.array(
                run(x["head"], F.lit(False)), run(x["chars"], x["loss"]),
                run(F.lit(len(tail)), F.lit(False))))).alias("mask"),
            F.flatten(F.transform(xs, lambda x: F.transform(x["attachments"], lambda a: F.struct(
                x["turn"].alias("turn"), a["number"].alias("number"), a["kind"].alias("kind"),
                a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"),
            F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]).alias("tokens")).alias("b"))
    bs = F.col("bs")
    return blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("bs")).select(
        "conv_id", F.array_join(bs["text"], "").alias("formatted"), F.flatten(bs["mask"]).alias("mask"),
        F.flatten(bs["attachments"]).alias("attachments"),
        F.aggregate(bs["tokens"], F.lit(0).cast("bigint"), lambda a, x: a + x).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text, body>> read back from a formatted string (text parts only are unescaped)."""
    pieces = F.filter(F.split(formatted, "<turn ", -1), lambda p: F.length(p) > 0)
    role = lambda p: F.substring_index(p, ">", 1)
    body = lambda p: F.regexp_replace(F.regexp_replace(p, "^[^>]*>", ""), "</turn>\n$", "")
    return F.transform(pieces, lambda p: F.struct(unescape(role(p)).alias("role"), unescape(body(p)).alias("text"),
                                                  body(p).alias("body")))


def digest(formatted: DataFrame) -> DataFrame:
    """Adds what the formatted string and its mask say, read back from them.

    The mask's runs come in threes (marker, body, marker); a body under the mask
    must have the length its run states, which ``mask_ok`` reports.
    """
    spans = F.filter(F.col("mask"), lambda r, i: i % 3 == 1)
    rows = formatted.withColumns({"ts": read_turns(F.col("formatted")), "spans": spans})
    masked = F.arrays_zip("ts", "spans")
    under = F.transform(F.filter(masked, lambda z: z["spans"]["in_loss"]), lambda z: z["ts"]["text"])
    rows = rows.withColumn("loss", F.array_join(under, ""))
    return rows.withColumns({
        "n_turns": F.size("ts").cast("bigint"),
        "turns_sha256": F.sha2(F.array_join(F.transform("ts", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256),
        "loss_chars": F.length("loss").cast("bigint"),
        "loss_sha256": F.sha2(F.col("loss").cast("binary"), 256),
        "formatted_chars": F.length("formatted").cast("bigint"),
        "mask_ok": F.forall(masked, lambda z: F.length(z["ts"]["body"]) == z["spans"]["n_chars"])
        & (F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, r: a + r["n_chars"]) == F.length("formatted")),
    }).drop("ts", "spans", "loss")


# The conversation the contract adds to the table.
EXTRA = r"\### Assistant: </turn> ok"


def q_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA).alias("text"))
    rows = turns.unionByName(extra).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    return digest(format_conversations(rows)).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "mask_ok")


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(15 + length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g'))
              + length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')))::BIGINT AS formatted_chars,
       true AS mask_ok
FROM t GROUP BY conv_id"""
