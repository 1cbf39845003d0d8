"""Chat formatting with typed content parts, in native expressions only.

A message is an array of parts ``struct<kind, text, ref, units>``. Visiting the parts in order, text becomes escaped
text and every image, audio and document part becomes a numbered placeholder, with its reference and its
token count after expansion on record. One conversation is

    <turn ROLE>
    BODY</turn>

per turn. ``<`` opens markers only: in texts and roles a backslash becomes ``\\b``, ``<`` becomes ``\\l`` and, in
roles, ``>`` becomes ``\\g``. Every backslash in the output therefore opens a two-character code, which makes
the escape reversible by plain replacement, also for texts that hold markers or codes of this template.

Null cases: a null text, role, part list or kind counts as empty (a part of null kind as text); a null turn number
comes first; turns of one number come in the order of role and content. Rows without a conversation id form one
conversation with a null id. A conversation is one row of the result and has to fit into memory; nothing
larger is ever gathered. Texts of any length are kept whole; repeated rows are turns of their own; an empty table
gives an empty result; columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import table

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
#: Tokens that one unit of an attachment expands to (an image tile, a second of audio, a page).
TOKENS_PER_UNIT: Mapping[str, int] = {"image": 256, "audio": 25, "document": 700}
TRAINED_ROLE = "assistant"

#: The turn that the contract adds; its id is -7.
ADDED_TEXT = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """``\\l`` first: a literal backslash is ``\\b`` in the output, so no ``\\l`` there is anything but ``<``."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def text_part(text: Column) -> Column:
    """A message of one text part."""
    none = F.lit(None).cast("string")
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.alias("ref"), F.lit(None).cast("bigint").alias("units")
    )
    return F.array(part)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _expanded(part: Column, tokens_per_unit: Mapping[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in tokens_per_unit.items() for x in pair])
    each = F.coalesce(F.try_element_at(known, part["kind"]), F.lit(0))
    return (each * F.coalesce(part["units"], F.lit(1))).cast("bigint")


def format_conversations(
    messages: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: Column | None = None,
    trained_role: str = TRAINED_ROLE,
    tokens_per_unit: Mapping[str, int] = TOKENS_PER_UNIT,
) -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_spans, attachments, expanded_tokens).

    ``loss_spans`` are (start, length) in code points of ``formatted``, from 0, one per trained turn: its escaped
    text, without markers. ``attachments`` are (number, turn_place, kind, ref, tokens) in order;
    ``expanded_tokens`` is the sum of their token counts. ``parts`` defaults to the column ``text`` as one text part.
    """
    content = text_part(F.col("text")) if parts is None else parts
    rows = messages.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(content, F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "parts"))).alias("turns"))

    # Attachments of all turns in order; a placeholder's number is its place there.
    found = F.flatten(
        F.transform(
            "turns",
            lambda t, place: F.transform(
                F.filter(
                    F.transform(t["parts"], lambda p, i: F.struct(i.alias("i"), p.alias("p"))),
                    lambda x: ~_is_text(x["p"]),
                ),
                lambda x: F.struct(
                    place.alias("turn_place"),
                    x["i"].alias("part_place"),
                    x["p"]["kind"].alias("kind"),
                    x["p"]["ref"].alias("ref"),
                    _expanded(x["p"], tokens_per_unit).alias("tokens"),
                ),
            ),
        )
    )
    numbered = gathered.withColumn("found", found).withColumn(
        "numbers",
        F.map_from_arrays(
            F.transform("found", lambda a: F.struct(a["turn_place"], a["part_place"])),
            F.transform("found", lambda a, i: i + 1),
        ),
    )

    def visit(part: Column, place: Column, turn_place: Column) -> Column:
        number = F.try_element_at(
            F.col("numbers"), F.struct(turn_place.alias("turn_place"), place.alias("part_place"))
        )
        placeholder = F.concat(F.lit("<"), escape_role(part["kind"]), F.lit(" "), number.cast("string"), F.lit(">"))
        return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)

    def body(turn_row: Column, turn_place: Column) -> Column:
        return F.array_join(F.transform(turn_row["parts"], lambda p, i: visit(p, i, turn_place)), "")

    made = numbered.withColumn(
        "pieces",
        F.transform(
            "turns",
            lambda t, place: F.struct(
                F.concat(F.lit("<turn "), escape_role(t["role"]), F.lit(">\n")).alias("head"),
                body(t, place).alias("body"),
                (t["role"] == trained_role).alias("trained"),
            ),
        ),
    )
    tail = "</turn>\n"
    # (start, length, trained) of each body, by one running sum over the turns' lengths.
    lengths = F.transform("pieces", lambda p: F.struct(F.length(p["head"]).alias("h"), F.length(p["body"]).alias("b"), p["trained"].alias("t")))
    measured = made.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "").alias("formatted"),
        F.aggregate(
            lengths,
            F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
            lambda s, p: F.struct(
                (s["at"] + p["h"] + p["b"] + len(tail)).alias("at"),
                F.when(
                    p["t"],
                    F.array_append(s["spans"], F.struct((s["at"] + p["h"]).alias("start"), p["b"].cast("bigint").alias("length"))),
                )
                .otherwise(s["spans"])
                .alias("spans"),
            ),
            lambda s: s["spans"],
        ).alias("loss_spans"),
        F.transform(
            "found",
            lambda a, i: F.struct(
                (i + 1).alias("number"), a["turn_place"], a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")
            ),
        ).alias("attachments"),
        F.aggregate("found", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )
    return measured


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> out of a formatted conversation; placeholders stay as they are written."""
    pieces = F.filter(F.split(formatted, "<turn ", -1), lambda _, i: i > 0)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, ">", 1)).alias("role"),
            unescape(
                F.substring_index(F.substr(p, F.locate(">\n", p) + 2), "</turn>\n", 1)
            ).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between two spans."""
    cut = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(cut, "")


def op6_chat_parts(spark, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = kept.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    out = format_conversations(kept.unionByName(added))
    turns, loss = read_turns(F.col("formatted")), read_loss(F.col("formatted"), F.col("loss_spans"))
    back = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<turn >' || chr(10) || '</turn>' || chr(10)) + length(text) + length(role)
           + (length(text) - length(replace(replace(text, '\', ''), '<', '')))
           + (length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""


QUERIES = {"op6_chat_parts": op6_chat_parts}
ORACLES = {"op6_chat_parts": ORACLE}
