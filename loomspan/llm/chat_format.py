"""Chat formatting with typed content parts, with column expressions only.

A turn's content is a list of parts. A visitor per kind renders a part: text
is escaped, images, audio and documents become numbered placeholders. The
attachments are recorded in order with their references and the number of
tokens each placeholder expands to. The loss mask is a list of spans of the
formatted string.

A turn reads `<turn ROLE>BODY</turn>` and a line feed. Text writes & as &amp;,
< as &lt; and > as &gt;, so control strings cannot occur in it, and reading
back undoes the three in reverse order.

Defined results: a null text, role or part list is empty; turns of equal
number are ordered by role, then text, and repeated rows are all kept; a null
conversation id is a conversation of its own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "array<struct<kind:string,text:string,ref:string,size:bigint>>"
#: Tokens of a placeholder: a base and a share per unit of size (image tiles, audio seconds, document pages).
EXPANDS = {"image": (85, 170), "audio": (2, 25), "document": (4, 600)}
OPEN, CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(t, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    t = F.replace(F.replace(text, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<"))
    return F.replace(t, F.lit("&amp;"), F.lit("&"))


def is_attachment(part: Column) -> Column:
    return part["kind"].isin(*EXPANDS)


def visit(part: Column, number: Column) -> Column:
    """What a part renders as; unknown kinds render their text."""
    out = None
    for kind in EXPANDS:
        mark = F.concat(F.lit(f"<{kind} "), number.cast("string"), F.lit("/>"))
        out = F.when(part["kind"] == kind, mark) if out is None else out.when(part["kind"] == kind, mark)
    return out.otherwise(escape(part["text"]))


def expanded(part: Column) -> Column:
    out = F.lit(0).cast("long")
    for kind, (base, per) in EXPANDS.items():
        out = F.when(part["kind"] == kind, F.lit(base) + F.coalesce(part["size"], F.lit(1)) * per).otherwise(out)
    return out


def text_parts(text: Column) -> Column:
    """A plain text as its one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("size")))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, n_turns, formatted, loss (spans from start, length code points), attachments, expanded_tokens."""
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(parts), F.array().cast(PART)).cast(PART).alias("parts"))
    t = t.withColumn("tie", F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], p["ref"], F.lit(""))), "\0"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "tie")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("at", F.row_number().over(order)).withColumn("seen", F.coalesce(F.sum(F.size(F.filter("parts", is_attachment))).over(before), F.lit(0)))

    def body(p, i):
        return visit(p, F.col("seen") + F.size(F.filter(F.slice("parts", 1, i + 1), is_attachment)))

    t = t.withColumn("body", F.array_join(F.transform("parts", body), ""))
    t = t.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">"))).withColumn("whole", F.concat("head", "body", F.lit(CLOSE)))
    t = t.withColumn("start", F.coalesce(F.sum(F.length("whole")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role").isin(*learn), F.struct(F.col("start").alias("start"), F.length("body").cast("long").alias("length")))
    refs = F.transform(F.filter("parts", is_attachment), lambda p, i: F.struct((F.col("seen") + i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded(p).alias("tokens")))
    rows = F.sort_array(F.collect_list(F.struct("at", "whole", span.alias("span"), refs.alias("refs"))))
    c = t.groupBy("conv_id").agg(rows.alias("rows"))
    c = c.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["whole"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss"),
        F.flatten(F.transform("rows", lambda r: r["refs"])).alias("attachments"),
    )
    return c.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, r: a + r["tokens"]))


def read_turns(formatted: Column) -> Column:
    """Array of role, body (still escaped) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")

    def of(p):
        role = F.substring_index(F.substring(p, len(OPEN) + 1, 2**30), ">", 1)
        return F.struct(unescape(role).alias("role"), F.substring(p, F.length(role) + len(OPEN) + 2, F.lit(2**30)).alias("body"))

    return F.transform(pieces, of)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the output back gives, as digests."""
    turns = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["body"]), F.lit("\n"))), "")
    d = formatted.select("conv_id", F.size(read_turns(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), read_loss(F.col("formatted"), F.col("loss")).alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
    return d.select("conv_id", "n_turns", "turns_sha256", F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


#: DuckDB: the query over conversations and the extra conversation -7.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, '<turn ' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '>'
         || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</turn>' || chr(10) AS whole
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '') AS loss,
         CAST(sum(length(whole)) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
