"""Chat formatting with prefix-target expansion (DataFrame functions only).

Template.  An assistant turn becomes ``<s>role\\ntext</s>``, any other turn
``[INST]role\\ntext[/INST]``.  Inside roles and texts a control string gets one
backslash after its first character (``</s>`` -> ``<\\/s>``; one that already
has k backslashes there gets k + 1), so a formatted text holds control strings
only as turn marks and unescaping restores every input exactly.  The first line feed
ends the role, so one inside a role becomes ``\\n`` and a backslash there two.

Expansion.  Every assistant turn is one example: all preceding turns are its
context and its own reply is the only trainable span.  The contexts of one
conversation are prefixes of one formatted text, so examples are stored as
offsets into that text (linear in the conversation), and the text itself as
one segment per turn: no conversation has to fit into one row.
``render_examples`` writes the examples out in full.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
OPEN = {True: "<s>", False: "[INST]"}
CLOSE = {True: "</s>", False: "[/INST]"}
CHUNK_TURNS = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # pairs of backslashes are found from the left, so a lone one before n was a line feed
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def format_turns(conv: DataFrame) -> DataFrame:
    """One formatted segment per turn: conv_id, turn, pos (from 0), role,
    segment, start and end (code points in the conversation's formatted text,
    from 0, end exclusive), trainable, loss_start and loss_end (the reply's
    span inside the segment, empty for other turns).

    Null roles and texts count as empty.  Turns are ordered by turn (null
    first), then role and text, so ties and repeated rows have a fixed order
    and all stay.  Offsets are prefix sums in two levels (chunks of turn
    numbers, then chunk totals), so a very long conversation is spread over
    many tasks.  Rows without conv_id form one conversation with a null id.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conv.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"))
    bot = F.col("role") == "assistant"
    head = F.concat(F.when(bot, OPEN[True]).otherwise(OPEN[False]), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.select("conv_id", "turn", "role", "text", bot.alias("trainable"), head.alias("head"),
                       escape(F.col("text")).alias("body"),
                       F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-2**53)).alias("chunk"))
    tail = F.when(F.col("trainable"), CLOSE[True]).otherwise(CLOSE[False])
    loss_start = F.when(F.col("trainable"), F.length("head")).otherwise(0)
    seg = rows.select("conv_id", "turn", "chunk", "role", "text", "trainable",
                      F.concat("head", "body", tail).alias("segment"), loss_start.alias("loss_start"),
                      (loss_start + F.when(F.col("trainable"), F.length("body")).otherwise(0)).alias("loss_end"))
    seg = seg.withColumn("size", F.length("segment").cast("long"))
    key = ["conv_id", "chunk"]
    order = Window.partitionBy(*key).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumns({"in_chunk": F.row_number().over(order) - 1,
                           "chars_before": F.coalesce(F.sum("size").over(before), F.lit(0))})
    sums = seg.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("conv_id").alias("_c"), F.col("chunk").alias("_k"),
                       F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                       F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("c0"))
    out = seg.join(base, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("chunk") == F.col("_k")))
    start = F.col("c0") + F.col("chars_before")
    return out.select("conv_id", "turn", (F.col("n0") + F.col("in_chunk")).alias("pos"), "role", "segment",
                      start.alias("start"), (start + F.col("size")).alias("end"), "trainable", "loss_start",
                      "loss_end")


def prefix_target_examples(turns: DataFrame) -> DataFrame:
    """One example per assistant turn: conv_id, target_pos, context_end (the
    context is [0, context_end) of the conversation's formatted text) and the
    trainable span [loss_start, loss_end), in the same offsets."""
    return turns.filter("trainable").select(
        "conv_id", F.col("pos").alias("target_pos"), F.col("start").alias("context_end"),
        (F.col("start") + F.col("loss_start")).alias("loss_start"),
        (F.col("start") + F.col("loss_end")).alias("loss_end"))


def render_examples(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples in full (conv_id, target_pos, context, target).  Writing
    every prefix out is quadratic in the turns of a conversation by nature;
    the offsets of ``prefix_target_examples`` carry the same content."""
    t = turns.select(F.col("conv_id").alias("_c"), "pos", "segment")
    both = examples.join(t, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("pos") <= F.col("target_pos")))
    parts = F.sort_array(F.collect_list(F.struct("pos", "segment")))
    one = both.groupBy("conv_id", "target_pos").agg(parts.alias("p"))
    texts = F.transform("p", lambda x: x["segment"])
    return one.select("conv_id", "target_pos",
                      F.array_join(F.slice(texts, 1, F.size("p") - 1), "").alias("context"),
                      F.element_at(texts, -1).alias("target"))


def read_back(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """Parse the formatted segments: conv_id, pos, start, end, role, text (all
    unescaped) and, for the target of an example, context_end and reply: the
    text under the example's loss span, unescaped.  An example's text is its
    context and then its target, so a span is cut relative to context_end."""
    e = examples.select(F.col("conv_id").alias("_c"), "target_pos", "context_end", F.col("loss_start").alias("_from"),
                        F.col("loss_end").alias("_to"))
    both = turns.join(e, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("pos") == F.col("target_pos")), "left")
    inner = F.regexp_replace("segment", r"^(?:<s>|\[INST\])|(?:</s>|\[/INST\])$", "")
    cutat = F.locate("\n", inner)
    reply = F.substring("segment", (F.col("_from") - F.col("context_end") + 1).cast("int"),
                        (F.col("_to") - F.col("_from")).cast("int"))
    return both.select("conv_id", "pos", "start", "end", "context_end",
                       unescape_role(F.substring(inner, F.lit(1), cutat - 1)).alias("role"),
                       unescape(F.substring(inner, cutat + 1, F.length(inner))).alias("text"),
                       unescape(reply).alias("reply"))


def conversation_digests(turns: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """Per conversation, from its examples (by default those of
    ``prefix_target_examples``): conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    The loss is what the examples' spans mark.  The turns are those of the last
    example's context, its target and the turns after it; without an example
    all are.  Offsets are read, no prefix is written out.  A digest over a whole
    conversation needs its text in one row; only this report does that.
    """
    back = read_back(turns, prefix_target_examples(turns) if examples is None else examples)
    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    last = F.when(F.col("context_end").isNotNull(), F.struct("pos", "context_end"))
    packed = back.groupBy("conv_id").agg(
        F.max(last).alias("last"),
        F.sort_array(F.collect_list(F.struct("pos", "start", "end", turn.alias("turn"), "reply"))).alias("p"))
    target, until = F.coalesce("last.pos", F.lit(-1)), F.coalesce("last.context_end", F.lit(0))
    rest = F.filter("p", lambda x: x["pos"] >= target)
    held = F.concat(F.filter("p", lambda x: (x["pos"] < target) & (x["end"] <= until)), rest)
    chars = until + F.aggregate(rest, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    loss = F.array_join(F.transform("p", lambda x: x["reply"]), "")  # null outside the targets: skipped
    one = packed.select("conv_id", held.alias("held"), loss.alias("loss"), chars.alias("formatted_chars"))
    return one.select("conv_id", F.size("held").cast("long").alias("n_turns"),
                      F.sha2(F.array_join(F.transform("held", lambda x: x["turn"]), ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      "formatted_chars")


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant turn full of control strings."""
    return spark.sql("""SELECT -7L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text
                        FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)""")
