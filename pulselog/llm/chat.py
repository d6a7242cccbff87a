"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only its
own text trainable. Turns after the last assistant turn come as one more example that trains
nothing, so no turn is lost. The template is

    <|im_start|>role, line feed, text<|im_end|>, line feed

Control strings inside roles and texts are percent-escaped, which ``unescaped`` reverts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks, and control strings of common chat templates.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>\n"
CONTROLS = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
TARGET_ROLE = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    """The text with ``%`` and the first character of every control string as ``%XX``."""
    text = _replace(text, "%", "%25")
    for control in CONTROLS:
        text = _replace(text, control, f"%{ord(control[0]):02X}{control[1:]}")
    return text


def unescaped(text: Column) -> Column:
    for char in ("\n", "<", "[", "%"):
        text = _replace(text, f"%{ord(char):02X}", char)
    return text


def expand(turns: DataFrame) -> DataFrame:
    """Examples of the turns (conv_id, turn, role, text): one for each assistant turn.

    Columns: conv_id, example (number of turns in it), formatted, loss_start and loss_length
    (code points of ``formatted``; null where nothing is trained), complete (it holds the whole
    conversation). Null role or text is empty; a null turn sorts first and turns with one number
    sort by role, then text, so repeated rows stay repeated turns; rows with a null conv_id are
    one conversation. Examples of a conversation hold all earlier turns, so its output grows with
    the square of its turns, as the method demands; they are made row by row.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    turns = turns.select("conv_id", "turn", role.alias("role"), escaped(text).alias("body"))
    head = F.concat(F.lit(OPEN), _replace(escaped(F.col("role")), "\n", "%0A"), F.lit("\n"))
    turns = turns.withColumn("piece", F.concat(head, "body", F.lit(CLOSE)))
    turns = turns.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.length("body").alias("size"),
        (F.col("role") == TARGET_ROLE).alias("target"),
        "piece",
    )
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "end", "size", "target", "piece"))).alias("all")
    )
    whole = whole.select(
        "conv_id",
        F.array_join(F.col("all.piece"), "").alias("chat"),
        F.size("all").alias("turns"),
        F.filter("all", lambda t: t.target | (t.n == F.size("all"))).alias("all"),
    )
    marks = F.transform("all", lambda t: F.struct(t.n, t.end, t.size, t.target))
    one = whole.select("conv_id", "chat", "turns", F.explode(marks).alias("t"))
    start = F.col("t.end") - len(CLOSE) - F.col("t.size")
    return one.select(
        "conv_id",
        F.col("t.n").alias("example"),
        F.substring(F.col("chat"), F.lit(1), F.col("t.end").cast("int")).alias("formatted"),
        F.when(F.col("t.target"), start).alias("loss_start"),
        F.when(F.col("t.target"), F.col("t.size").cast("long")).alias("loss_length"),
        (F.col("t.n") == F.col("turns")).alias("complete"),
    )


def trained_text(example: DataFrame) -> Column:
    """The unescaped text under an example's loss mask; null where nothing is trained."""
    start = (F.col("loss_start") + 1).cast("int")
    return unescaped(F.substring("formatted", start, F.col("loss_length").cast("int")))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted chat: an array of (role, text)."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(OPEN) + 1), F.length(part))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def digests(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its examples alone."""
    lines = F.transform(
        parsed(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))
    )
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        trained_text(examples).alias("reply"),
        F.when(F.col("complete"), lines).alias("lines"),
    )
    read = read.select(
        "conv_id",
        "chars",
        F.when(F.col("reply").isNotNull(), F.struct("example", "reply")).alias("reply"),
        F.size("lines").alias("n"),
        F.sha2(F.array_join("lines", ""), 256).alias("digest"),
    )
    # A null conv_id is a group as well; collect_list leaves null replies out.
    whole = read.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"),
        F.max("digest").alias("turns_sha256"),
        F.array_join(F.array_sort(F.collect_list("reply")).getField("reply"), "").alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("replies").cast("long").alias("loss_chars"),
        F.sha2("replies", 256).alias("loss_sha256"),
        "formatted_chars",
    )
