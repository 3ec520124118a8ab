"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent
turns of one role are merged by array functions into one block, and the
blocks are concatenated:

    <|im_start|>role\\ntext one<|im_sep|>text two<|im_end|>\\n

Control strings inside a text are escaped by a back slash after their first
character, one more than there already is, which ``unescape`` takes away
again; any other text stays as it is. ``read_back`` parses the formatted text.
All array work is linear in the length of the conversation. A conversation is
one output value, so its turns must meet in one task in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# What chat templates use to mark turns.
CONTROL = r"\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]\\*)({CONTROL})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]\\*)\\({CONTROL})", "$1$2")


def _literal(s: str) -> str:
    return "".join("\\" + c if c in "|<>" else c for c in s)


def _role_out(role: Column) -> Column:
    """A role ends at the first line break: per cent signs and breaks in it are coded."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where lambdas inside ``body`` use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", trained: str = "assistant") -> DataFrame:
    """One row per conversation: the id, ``segments`` (array of text and loss
    flag; only texts of the role ``trained`` carry loss) and ``formatted``,
    the segments joined.

    Rows are taken in the order of turn, role, text; a null turn comes first,
    null roles and texts count as empty, repeated rows all stay, a null id is
    a conversation of its own. Other columns are not used.
    """
    t = turns.select(F.col(conv_col).alias(conv_col), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    got = t.groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # Arrays are bound by an outer lambda (``_bound``): a lambda's body would else build them anew for each element.
    changes = _bound(F.col("ts.role"), lambda roles: F.filter(
        F.sequence(F.lit(0), F.size(roles) - 1), lambda i: (i == 0) | (F.get(roles, i) != F.get(roles, i - 1))))
    # Positions where the role changes, then the slice from each to the next.
    blocks = _bound(F.struct(F.col("ts.role").alias("roles"), F.col("ts.text").alias("texts"), changes.alias("first")), lambda a: F.transform(
        a["first"], lambda s, k: F.struct(F.get(a["roles"], s).alias("role"), F.slice(
            a["texts"], s + 1, F.coalesce(F.get(a["first"], k + 1), F.size(a["texts"])) - s).alias("texts"))))
    plain = lambda s: F.struct(s.alias("text"), F.lit(False).alias("loss"))
    # Per block: the head, then each text followed by a separator or, for the last, the end.
    segments = F.flatten(F.transform(blocks, lambda b: F.concat(
        F.array(plain(F.concat(F.lit(START), _role_out(b["role"]), F.lit("\n")))),
        F.flatten(F.transform(b["texts"], lambda x, i: F.array(
            F.struct(escape(x).alias("text"), (b["role"] == F.lit(trained)).alias("loss")),
            plain(F.when(i + 1 < F.size(b["texts"]), F.lit(SEP)).otherwise(F.lit(END)))))))))
    got = got.select(conv_col, segments.alias("segments"))
    return got.withColumn("formatted", F.array_join("segments.text", ""))


def read_back(formatted: Column) -> Column:
    """The turns, array of role and text, parsed from a formatted conversation."""
    parts = F.filter(F.split(formatted, _literal(START), -1), lambda x, i: i > 0)
    cut = lambda p: F.locate("\n", p)
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(F.substr(p, cut(p) + 1, F.char_length(p) - cut(p) - F.lit(len(END))), _literal(SEP), -1),
        lambda x: F.struct(_role_in(F.substr(p, F.lit(1), cut(p) - 1)).alias("role"), unescape(x).alias("text")))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
