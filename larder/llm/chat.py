"""Chat formatting in DataFrame operations only.

A turn is a list of typed parts. A visitor over the parts writes text as it is, escaped, and every
image, audio or document part as a placeholder, and records its reference and the tokens that it
will expand to. A turn is ``<|turn|>role<|text|>body<|end|>``; a conversation is its turns in order.

Escaping: control strings (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) inside texts and roles
get a backslash after their first character, on top of any backslashes already there, so that
unescaping takes away exactly one and no text can end a turn.

Defined results: a null text, role or part list is empty; turns are ordered by turn, then role and
text, nulls first, repeated rows are turns each; a null conv_id is one conversation; a part of an
unknown type is an ``<|other|>`` placeholder. A conversation is one row, as the contract has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Tokens of a placeholder whose part doesn't say how many it expands to.
EXPANDED = {"image": 576, "audio": 750, "document": 1024, "other": 1}
PART = "struct<type: string, text: string, ref: string, tokens: int>"
_CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"(<|\[)(\\*)\\(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("text", *EXPANDED), part["type"]).otherwise(F.lit("other"))


def flatten_parts(parts: Column) -> tuple[Column, Column]:
    """(body, attachments): the visitor. Attachments are in order: part number, type, ref, expanded tokens."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    body = F.array_join(F.transform(parts, lambda p: F.when(_kind(p) == "text", escape(p["text"])).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit("|>")))), "")
    usual = F.create_map(*[F.lit(x) for kv in EXPANDED.items() for x in kv])
    seen = F.transform(parts, lambda p, i: F.struct(i.alias("part"), _kind(p).alias("type"), p["ref"].alias("ref"), F.when(_kind(p) != "text", F.coalesce(p["tokens"], usual[_kind(p)])).alias("tokens")))
    return body, F.filter(seen, lambda a: a["type"] != "text")


def format_chat(turns: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """``turns(conv_id, turn, role, parts)`` -> one row per conversation.

    formatted; mask, an entry for each turn: the code points of the formatted text at which the turn
    begins and between which its body is trained on (the bodies of ``loss_role``), else null;
    loss_spans, those ranges alone; attachments; expanded_tokens.
    """
    body, attachments = flatten_parts(F.col("parts"))
    role = F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), body.alias("body"), attachments.alias("seen"))
    head = F.concat(F.lit("<|turn|>"), escape(F.col("role")), F.lit("<|text|>"))
    rows = rows.withColumn("segment", F.concat(head, "body", F.lit("<|end|>")))
    # running lengths need no list of the turns; the conversation's rows are then already together
    order = W.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("end", F.sum(F.char_length("segment").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)) - len("<|end|>"))
    base = F.col("end") + len("<|end|>") - F.char_length("segment")
    span = F.struct(base.alias("base"), (F.col("end") - F.char_length("body")).alias("start"), "end")
    turn = F.struct("n", "segment", F.when(F.col("role") == loss_role, span).alias("span"), "seen")
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    found = F.flatten(F.transform("t", lambda t: F.transform(t["seen"], lambda a: F.struct((t["n"] - 1).alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("formatted"),
        F.transform("t", lambda t: t["span"]).alias("mask"),
        F.transform(F.filter("t", lambda t: t["span"].isNotNull()), lambda t: F.struct(t["span"]["start"].alias("start"), t["span"]["end"].alias("end"))).alias("loss_spans"),
        found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def _segments(formatted: Column) -> Column:
    """What stands before each end mark."""
    return F.filter(F.split(formatted, r"<\|end\|>"), lambda s: s != "")


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), unescaped."""
    halves = F.transform(_segments(formatted), lambda s: F.split(F.substring(s, len("<|turn|>") + 1, 1 << 30), r"<\|text\|>", 2))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def under_loss(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, cut out of a formatted conversation and unescaped: an array.

    A turn's range is cut from its own segment, so a conversation costs its length, however many turns it has.
    """
    cut = lambda s, m: F.when(m.isNotNull(), s.substr((m["start"] - m["base"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))
    return F.transform(F.filter(F.zip_with(_segments(formatted), mask, cut), lambda x: x.isNotNull()), unescape)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    chats = format_chat(rows.unionByName(extra).withColumn("parts", F.array(_part("text", text=F.col("text")))))
    read = chats.select("conv_id", "formatted", read_chat(F.col("formatted")).alias("turns"), F.array_join(under_loss(F.col("formatted"), F.col("mask")), "").alias("under"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("under").cast("long").alias("loss_chars"),
        F.sha2("under", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _part(kind: str, *, text: Column | None = None, ref: Column | None = None, tokens: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(F.lit(kind).alias("type"), (none if text is None else text).cast("string").alias("text"), (none if ref is None else ref).cast("string").alias("ref"), (none if tokens is None else tokens).cast("int").alias("tokens"))


def chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed parts: what a user says comes with an image, and a document without a reference; what others say with a sound of as many tokens as characters."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    ref = F.concat_ws("/", "conv_id", "turn")
    seen = F.array(_part("text", text=F.col("text")), _part("image", ref=ref), _part("document"))
    heard = F.array(_part("audio", ref=ref, tokens=F.char_length(F.coalesce("text", F.lit("")))), _part("text", text=F.col("text")))
    chats = format_chat(rows.withColumn("parts", F.when(F.col("role") == "user", seen).otherwise(heard)))
    refs = F.array_join(F.transform("attachments", lambda a: F.concat_ws(":", a["turn"], a["part"], a["type"], F.coalesce(a["ref"], F.lit("-")), a["tokens"])), " ")
    return chats.select("conv_id", F.sha2("formatted", 256).alias("formatted_sha256"), F.sha2(refs, 256).alias("attachments_sha256"), "expanded_tokens")


_SQL_ESCAPE = r"regexp_replace({x}, '(<|\[)(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g')"
OP8_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, {_SQL_ESCAPE.format(x="role")} AS r, {_SQL_ESCAPE.format(x="text")} AS b FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, b) AS all_turns,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, b) FILTER (role = 'assistant'), '') AS under,
             sum(length(r) + length(b) + {len("<|turn|><|text|><|end|>")}) AS formatted_chars
      FROM e GROUP BY conv_id)
SELECT conv_id, cast(n_turns AS BIGINT) AS n_turns, sha256(all_turns) AS turns_sha256, cast(length(under) AS BIGINT) AS loss_chars,
       sha256(under) AS loss_sha256, cast(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""

CHAT_PARTS_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(role = 'user', false) AS u, concat_ws('/', conv_id, turn) AS ref FROM conversations),
e AS (SELECT *, {_SQL_ESCAPE.format(x="role")} AS r, {_SQL_ESCAPE.format(x="text")} AS b FROM c),
p AS (SELECT *, CASE WHEN u THEN b || '<|image|><|document|>' ELSE '<|audio|>' || b END AS body FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) - 1 AS i FROM p)
SELECT conv_id, sha256(string_agg('<|turn|>' || r || '<|text|>' || body || '<|end|>', '' ORDER BY i)) AS formatted_sha256,
       sha256(string_agg(CASE WHEN u THEN i || ':1:image:' || ref || ':{EXPANDED['image']} ' || i || ':2:document:-:{EXPANDED['document']}' ELSE i || ':0:audio:' || ref || ':' || length(text) END, ' ' ORDER BY i)) AS attachments_sha256,
       cast(sum(CASE WHEN u THEN {EXPANDED['image'] + EXPANDED['document']} ELSE length(text) END) AS BIGINT) AS expanded_tokens
FROM n GROUP BY conv_id
"""
