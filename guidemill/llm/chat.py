"""Chat formatting: event-sourced reconstruction of conversations, in DataFrame functions only.

A log has events of conversations, in order of a sequence number: `message` begins a message, `delta` adds to the text of the one before it, `edit`
and `regenerate` put another text in place of all that it had. The log is folded into final messages and these are rendered with a template that
marks turns. Control strings inside roles and texts are escaped, and the reader undoes that, so the output says exactly what was said by whom.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Strings that chat models take for control: fixed values.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>"]
_BEFORE = "|".join(x[0].replace("[", r"\[") + "(?=" + x[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") + ")" for x in CONTROL)
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """A backslash becomes two; one goes behind the first character of every control string. So no control string is left."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_BEFORE})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)|\\", "$1")


def _role(role: Column) -> Column:
    """Roles stand in one line: a line feed is written as a backslash and n after the others are escaped, and read back first."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the final messages of a log (conv_id, seq, kind, role, text).

    Events are in order of seq (null first), then kind, role and text; equal events stay, each by itself. A delta, edit or regenerate before the
    first message begins one. A message keeps the role it began with; edits and regenerations change its text only. Null text counts as empty, null
    role as ''. Null conv_id is a conversation of its own. Kinds other than message, delta, edit and regenerate, also null, count as message."""
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise("message")
    rows = events.select("conv_id", "seq", kind.alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by_seq = Window.partitionBy("conv_id").orderBy("seq", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(by_seq))
    in_order = Window.partitionBy("conv_id").orderBy("at")
    rows = rows.withColumn("place", F.sum(F.when((F.col("kind") == "message") | (F.col("at") == 1), 1).otherwise(0)).over(in_order))
    rows = rows.withColumn("reset", F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(Window.partitionBy("conv_id", "place")))
    live = F.when(F.coalesce(F.col("at") >= F.col("reset"), F.lit(True)), F.col("text")).otherwise("")
    parts = F.sort_array(F.collect_list(F.struct("at", live.alias("t"))))
    folded = rows.groupBy("conv_id", "place").agg(F.min(F.struct("at", "role"))["role"].alias("role"), F.array_join(F.transform(parts, lambda x: x["t"]), "").alias("text"))
    return folded


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans for messages (conv_id, place, role, text) in order of place.

    loss_spans: start (from 0) and length, in code points of the formatted text, of the escaped text of each assistant message."""
    turn = F.struct("place", _role(F.col("role")).alias("role"), escape(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("loss"))
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"))
    size = lambda t: F.length(t["role"]) + F.length(t["text"]) + len(OPEN) + len(CLOSE) + 2
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    span = lambda a, t: F.struct((a["at"] + F.length(t["role"]) + len(OPEN) + 1).alias("start"), F.length(t["text"]).alias("length"))
    step = lambda a, t: F.struct((a["at"] + size(t)).alias("at"), F.when(t["loss"], F.concat(a["spans"], F.array(span(a, t)))).otherwise(a["spans"]).alias("spans"))
    spans = F.aggregate("turns", start, step, lambda a: a["spans"])
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(CLOSE + "\n"))), "")
    return turns.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text says."""
    turns = F.filter(F.split(formatted, r"\Q" + CLOSE + r"\E\n"), lambda x: x != "")
    bodies = F.transform(turns, lambda x: F.substring(x, len(OPEN) + 1, 2**31 - 1))
    # the role ends at the first line feed that no backslash escapes
    role = lambda x: F.regexp_extract(x, r"(?s)^((?:[^\\\n]|\\.)*+)\n(.*)$", 1)
    return F.transform(bodies, lambda x: F.struct(unescape(role(x)).alias("role"), unescape(F.regexp_extract(x, r"(?s)^((?:[^\\\n]|\\.)*+)\n(.*)$", 2)).alias("text")))


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans of every conversation of a log of events (conv_id, seq, kind, role, text); see fold() and render().

    An empty log gives an empty table; other columns are not read."""
    return render(fold(events))
