"""Chat formatting with relational operations (operator 8).

The template writes each run of turns of one role as ``<s>role<r>text<t>text</s>``; what a model is
trained on (the assistant's texts) stands between ``[OUT]`` and ``[/OUT]``, the rest between ``[INST]``
and ``[/INST]``::

    <s>user<r>[INST]Hello<t>Are you there?[/INST]</s><s>assistant<r>[OUT]Yes.[/OUT]</s>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED = "assistant"
# The control strings inside texts, with an opening character that an escape follows.
CONTROL = r"([<\[])(/?(?:[str]>|INST\]|OUT\]))"
ESCAPED = r"([<\[])\\(/?(?:[str]>|INST\]|OUT\]))"
NULL_ROLE = "\\n"  # no escaped text has a single backslash there


def escape(text: Column) -> Column:
    """Backslashes are doubled, then one is put into every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = TRAINED
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss``.

    Turns are in order of their number (null first), then role and text. Adjacent turns of one role
    share a block of the template. ``loss`` has a struct (start, length) in code points of
    ``formatted`` for every text of the trained role. A null text is empty, a null role is kept as
    such, rows without a conversation form one conversation; turns that repeat one another are all kept.
    Other columns are ignored; an empty table gives an empty result. A conversation is one row, so
    it has to fit into one.
    """
    learned = escape(F.lit(trained))  # as the roles are that it is compared with
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(escape(F.col(role)), F.lit(NULL_ROLE)).alias("role"),
        escape(F.coalesce(text, F.lit(""))).alias("text"),
    )
    # What stands before each text: the texts of earlier turns, and marks whose length the roles decide.
    # "<s>" role "<r>[OUT]" ... "[/OUT]</s>" around a run, "<t>" between its turns. Rows that are equal in the order are
    # equal altogether, so sums over it do not hang on which of them comes first.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    last = F.lag("role").over(order)
    closing = F.when(last.isNull(), 0).when(last == learned, 10).otherwise(11)
    opening = F.length("role") + F.when(F.col("role") == learned, 11).otherwise(12)
    marks = F.when(last.isNull() | (last != F.col("role")), closing + opening).otherwise(3)
    size = F.length("text").cast("bigint")
    measured = rows.select("*", size.alias("length"), (marks + size).alias("step"), (last.isNull() | (last != F.col("role"))).cast("int").alias("opens"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = measured.select(
        "conv_id", "role", F.sum("opens").over(upto).alias("run"),
        F.struct((F.sum("step").over(upto) - F.col("length")).alias("start"), "length", "text").alias("row"),
    )
    # Both groupings use the partitioning of the window.
    runs = placed.groupBy("conv_id", "run", "role").agg(F.array_sort(F.collect_list("row")).alias("turns"))
    marked = F.when(F.col("role") == learned, F.array(F.lit("[OUT]"), F.lit("[/OUT]"))).otherwise(F.array(F.lit("[INST]"), F.lit("[/INST]")))
    inner = F.concat(marked[0], F.array_join(F.transform("turns", lambda t: t["text"]), "<t>"), marked[1])
    spans = F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    blocks = runs.select(
        "conv_id",
        F.struct(
            "run",
            F.concat(F.lit("<s>"), F.col("role"), F.lit("<r>"), inner, F.lit("</s>")).alias("text"),
            F.when(F.col("role") == learned, spans).otherwise(F.slice(spans, 1, 0)).alias("loss"),
        ).alias("block"),
    )
    gathered = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("block")).alias("blocks"))
    return gathered.select("conv_id", F.array_join("blocks.text", "").alias("formatted"), F.flatten("blocks.loss").alias("loss"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``turns`` (role, text) and ``trained`` (all text under the mask) from the output of :func:`format_chats`."""
    blocks = F.filter(F.split("formatted", "<s>"), lambda b: b != "")

    def opened(block: Column) -> Column:
        role = F.substring_index(block, "<r>", 1)
        body = F.regexp_extract(block, r"(?s)^.*?<r>\[(?:INST|OUT)\](.*)\[/(?:INST|OUT)\]</s>$", 1)
        plain = F.when(role != NULL_ROLE, unescape(role))
        return F.transform(F.split(body, "<t>"), lambda t: F.struct(plain.alias("role"), unescape(t).alias("text")))

    pieces = F.transform("loss", lambda s: unescape(F.col("formatted").substr(s["start"].cast("int") + 1, s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, opened)).alias("turns"), F.array_join(pieces, "").alias("trained"))
