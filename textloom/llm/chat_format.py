"""Chat formatting (operator 10, native).

A declarative template gives each role a header, a loss flag and the roles
that may follow it. A finite-state machine folds the roles of a conversation
in turn order; the state after each turn is the role itself, or ``!`` once a
move is not allowed. Every turn gives three segments (header, body, end) with a
loss flag each; the formatted text is their concatenation. Control strings and
the escape character inside bodies are escaped, so the text can be read back.

Defined results: null text is an empty body; null role is an empty role name;
equal turn numbers are ordered by role, then text; repeated rows stay; null
``conv_id`` is one conversation of its own; an empty table gives no rows;
extra columns are ignored. A conversation is one training example and one
output row, so its turns are gathered in one row (that is its bound).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Markers, escapes, allowed moves (``""`` is the start) and loss roles."""

    open: str = "###"
    sep: str = ": "
    close: str = "</turn>"
    headers: dict = field(default_factory=lambda: {
        "system": "System", "user": "User", "assistant": "Assistant"})
    moves: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",),
        "user": ("assistant",), "assistant": ("user",)})
    finals: tuple = ("assistant",)
    loss_roles: tuple = ("assistant",)


DEFAULT = ChatTemplate()


def escape(c: Column, t: ChatTemplate) -> Column:
    """Replace the escape character first, then each control string."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit(t.open), F.lit("\\h"))
    return F.replace(c, F.lit(t.close), F.lit("\\e"))


def unescape(c: Column, t: ChatTemplate) -> Column:
    """Inverse of :func:`escape`: escaped escape characters are split off
    first, so what is left of each piece holds only control codes."""
    parts = F.split(c, r"\\\\", -1)
    parts = F.transform(parts, lambda p: F.replace(
        F.replace(p, F.lit("\\h"), F.lit(t.open)), F.lit("\\e"), F.lit(t.close)))
    return F.array_join(parts, "\\")


def _header(role: Column, t: ChatTemplate) -> Column:
    """Known roles by their template name, others as ``=`` and the escaped
    role with its colons coded, so that the separator stays unique."""
    name = F.concat(F.lit("="), F.replace(escape(role, t), F.lit(":"), F.lit("\\c")))
    for r, h in t.headers.items():
        name = F.when(role == r, F.lit(h)).otherwise(name)
    return F.concat(F.lit(t.open + " "), name, F.lit(t.sep))


def _role_of(header: Column, t: ChatTemplate) -> Column:
    parts = F.transform(F.split(F.substr(header, F.lit(2)), r"\\\\", -1),
                        lambda p: F.replace(p, F.lit("\\c"), F.lit(":")))
    role = unescape(F.array_join(parts, "\\\\"), t)
    for r, h in t.headers.items():
        role = F.when(header == h, F.lit(r)).otherwise(role)
    return role


def _state(roles: Column, t: ChatTemplate) -> Column:
    def step(s, r):
        ok = F.lit(False)
        for at, then in t.moves.items():
            ok = ok | ((s == at) & r.isin(*then))
        return F.when(ok, r).otherwise(F.lit("!"))
    return F.aggregate(roles, F.lit(""), step)


def format_chats(df: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``valid``,
    ``segments`` (``array<struct<text, loss>>``) and ``formatted``."""
    t = template
    turns = (df.select("conv_id", F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")))
    end = t.close + "\n"
    pieces = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(_header(x.role, t).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x.text, t).alias("text"), x.role.isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(end).alias("text"), F.lit(False).alias("loss")))))
    state = _state(F.transform("turns", lambda x: x.role), t)
    return (turns
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    state.isin(*t.finals).alias("valid"), pieces.alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s.text), "")))


def read_back(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """``array<struct<role, text>>`` parsed from a formatted conversation."""
    t = template
    parts = F.filter(F.split(formatted, r"\Q" + t.close + "\n" + r"\E", -1), lambda p: p != "")
    skip, sep = len(t.open) + 1, len(t.sep)

    def one(p):
        at = F.instr(p, t.sep)
        header = F.substr(p, F.lit(skip + 1), at - skip - 1)
        return F.struct(_role_of(header, t).alias("role"),
                        unescape(F.substr(p, at + sep), t).alias("text"))
    return F.transform(parts, one)


def loss_text(segments: Column, template: ChatTemplate = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss),
                                    lambda s: unescape(s.text, template)), "")


PLANTED_ID = -7
PLANTED = "\\### Assistant: </turn> ok"  # fixed value of the contract


def op10_chat_format(spark, sf_dir) -> DataFrame:
    """Digests of every conversation, read back from the formatted text."""
    from textloom.llm.common import table

    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"))
    out = format_chats(conv.unionByName(extra))
    out = out.select("*", read_back(F.col("formatted")).alias("_back"),
                     loss_text(F.col("segments")).alias("_loss"))
    digest = F.array_join(F.transform("_back", lambda x: F.concat(
        x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("_back").cast("long").alias("n_turns"),
        F.sha2(F.encode(digest, "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


_ESC = "replace(replace(replace(t, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e')"
OP10_SQL = f"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'),
b AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t) AS d,
  coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '') AS l,
  sum(length('### ' || CASE r WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
      ELSE '=' || replace(replace(replace(replace(r, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e'), ':', '\\c') END
      || ': ' || {_ESC} || '</turn>' || chr(10)))::BIGINT AS formatted_chars,
  list(r ORDER BY turn, r, t) AS rs FROM a GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(d) AS turns_sha256, length(l)::BIGINT AS loss_chars, sha256(l) AS loss_sha256,
  formatted_chars, regexp_full_match(list_aggregate(rs, 'string_agg', ','), '(system,)?(user,assistant,)*user,assistant') AS valid
FROM b"""
