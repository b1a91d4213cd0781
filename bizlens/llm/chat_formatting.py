"""Chat formatting of typed content parts, in DataFrame functions only.

A visitor goes over the parts of each turn in order.  Text is escaped; image, audio and document
parts become placeholders, and each placeholder has an entry, in the same order, in the
conversation's list of attachments with its reference and the tokens it will expand to.

Template of a turn::

    <|turn|>ROLE
    BODY<|end|>

Escaping is reversible and works character by character, so that no control string can arise
inside a text or where two parts meet: the escape character and the characters that open control
strings (``<`` of ``<|end|>`` or ``</s>``, ``[`` of ``[INST]``) are written as the escape
character and a digit; line feeds in a role likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import let, running_sums, table

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
ESCAPE = "\u241b"
CODES = [(ESCAPE, ESCAPE + "0"), ("<", ESCAPE + "1"), ("[", ESCAPE + "2")]
ROLE_CODES = [*CODES, ("\n", ESCAPE + "3")]
LOSS_ROLE = "assistant"
#: Kind of part, and tokens that one unit of it expands to (image: tile, audio: second, document: page).
ATTACHMENTS = {"image": 256, "audio": 25, "document": 700}
PART = "struct<type:string,text:string,ref:string,units:double>"
FRAME_CONV = -7
FRAME_TEXT = "</s>[INST] ok [/INST]"


def escape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    """``text`` without the characters that open control strings; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """The inverse of ``escape``, for texts and roles."""
    for plain, code in reversed(ROLE_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), none.cast("string").alias("ref"), none.cast("double").alias("units")))


def _visit(part: Column) -> Column:
    return F.when(part["type"].isin(*ATTACHMENTS), F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(escape(part["text"]))


def _attachment(part: Column) -> Column:
    rate = F.coalesce(*(F.when(part["type"] == kind, F.lit(n)) for kind, n in ATTACHMENTS.items()))
    tokens = F.ceil(F.coalesce(part["units"], F.lit(1.0)) * rate).cast("long")
    return F.struct(part["type"].alias("type"), part["ref"].alias("ref"), tokens.alias("tokens"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``mask`` (the stretches of ``formatted`` that the loss
    covers: start and length in code points, first and size in bytes), ``attachments`` (type, ref,
    tokens, in order of the placeholders) and ``attachment_tokens``.

    Turns are ordered by turn (null first), then role and body, so ties have one result;
    repeated rows are turns of their own.  Null parts, part lists, texts and roles count as
    empty; parts of any other type are text; null conversation ids make one conversation; other
    columns are ignored; an empty table gives an empty result.  A conversation is one row, so it
    has to fit a task.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    parts = F.filter(parts, lambda p: p.isNotNull())
    held = F.filter(parts, lambda p: F.coalesce(p["type"].isin(*ATTACHMENTS), F.lit(False)))
    own = turns.select(
        F.col(conv_col), F.col(turn_col).alias("_turn"), escape(F.col(role_col), ROLE_CODES).alias("_role"),
        F.array_join(F.transform(parts, _visit), "").alias("_body"), F.transform(held, _attachment).alias("_held"),
        F.coalesce(F.col(role_col) == LOSS_ROLE, F.lit(False)).alias("_loss"))
    grouped = own.groupBy(conv_col).agg(F.sort_array(F.collect_list(F.struct("_turn", "_role", "_body", "_loss", "_held"))).alias("turns"))

    def segments(t: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(piece(F.concat(F.lit(OPEN), t["_role"], F.lit("\n")), F.lit(False)), piece(t["_body"], t["_loss"]),
                       piece(F.lit(CLOSE), F.lit(False)))

    def mask(parts: Column) -> Column:
        chars, size = (lambda s: F.char_length(s["text"]).cast("long")), (lambda s: F.octet_length(s["text"]).cast("long"))
        placed = F.arrays_zip(parts.alias("s"), running_sums(F.transform(parts, chars)).alias("end"), running_sums(F.transform(parts, size)).alias("last"))
        return F.transform(F.filter(placed, lambda z: z["s"]["loss"]), lambda z: F.struct(
            (z["end"] - chars(z["s"])).alias("start"), chars(z["s"]).alias("length"), (z["last"] - size(z["s"])).alias("first"), size(z["s"]).alias("size")))

    out = grouped.select(conv_col, F.flatten(F.transform("turns", segments)).alias("segments"), F.flatten(F.transform("turns", lambda t: t["_held"])).alias("attachments"))
    return out.select(conv_col, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), let(F.col("segments"), mask).alias("mask"), "attachments",
                      F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return let(formatted.cast("binary"), lambda data: F.transform(
        mask, lambda m: unescape(F.substring(data, (m["first"] + 1).cast("int"), m["size"].cast("int")).cast("string"))))


def read_parts(formatted: Column) -> Column:
    """array<struct<role, parts: array<struct<type, text>>>> of a formatted conversation: what the visitor
    flattened, less references and units.  A placeholder is a part of its kind without text; a text that
    spells a placeholder out is text.  Neighbouring texts are one part, empty ones none; a null conversation
    gives null, an empty one no turns."""
    turns = F.split(formatted, r"<\|end\|>\n", -1)
    kinds = "|".join(ATTACHMENTS)

    def turn(t: Column) -> Column:
        line = F.instr(t, "\n")
        body = F.substring(t, line + 1, F.char_length(t))
        texts = F.transform(F.split(body, rf"<\|(?:{kinds})\|>", -1), lambda x: F.struct(F.lit("text").alias("type"), unescape(x).alias("text")))
        held = F.transform(F.regexp_extract_all(body, F.lit(rf"<\|({kinds})\|>"), F.lit(1)), lambda k: F.struct(k.alias("type"), F.lit(None).cast("string").alias("text")))
        both = F.flatten(F.transform(F.arrays_zip(texts.alias("a"), held.alias("b")), lambda z: F.array(z["a"], z["b"])))
        return F.struct(unescape(F.substring(t, F.lit(len(OPEN) + 1), line - len(OPEN) - 1)).alias("role"),
                        F.filter(both, lambda p: p.isNotNull() & ((p["type"] != "text") | (p["text"] != ""))).alias("parts"))

    return F.transform(F.slice(turns, 1, F.size(turns) - 1), turn)


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; placeholders stand in the text as they are
    (``read_parts`` tells them from text).  A null conversation gives null, an empty one no turns."""
    spelled = lambda p: F.when(p["type"] == "text", p["text"]).otherwise(F.concat(F.lit("<|"), p["type"], F.lit("|>")))
    return F.transform(read_parts(formatted), lambda t: F.struct(t["role"].alias("role"), F.array_join(F.transform(t["parts"], spelled), "").alias("text")))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the frame conversation, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    frame = spark.range(2).select(F.lit(FRAME_CONV).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(FRAME_TEXT).alias("text"))
    chats = format_chats(given.unionByName(frame).withColumn("parts", text_parts(F.col("text"))))
    read = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                        F.array_join(masked_texts(F.col("formatted"), F.col("mask")), "").alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE_OP2 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[\u241b<\\[]')) + length(role) + len(regexp_extract_all(role, '[\u241b<\\[\\n]'))
            + 8 + 1 + 8 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
