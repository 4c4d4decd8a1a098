"""Chat formatting by event-sourced reconstruction, in DataFrame functions alone.

A conversation is a log of events (conv_id, seq, kind, turn, role, text). Kinds: ``message`` starts a message of a turn,
``delta`` appends streamed text to it, ``edit`` replaces its text, ``regenerate`` empties it and voids what was said in
later turns before that event. The log is partitioned by conversation, sorted by sequence, folded into final messages,
and rendered; windows and the last grouping share one exchange on conv_id.

Edge cases: null text, role or kind (``message``) are empty text, empty role and ``message``; a null turn sorts first; a
null conv_id is a conversation; events of equal seq are taken by turn, kind, role and text; repeated events count as often
as they stand; extra columns, whatever their names, are ignored; an empty log gives no conversations. Very long texts are
rendered whole; a conversation must fit in one value, since its rendering is one string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this template and of other public chat templates.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPED = r"([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escape(text) -> F.Column:
    """Doubles backslashes and puts one after the first sign of every control string; unescape() is its inverse."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), ESCAPED, r"$1\\$2")


def unescape(text) -> F.Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turn, n, role, text): the final messages; n tells messages of one turn apart."""
    e = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    conv = Window.partitionBy("conv_id")
    # What a regeneration of an earlier turn voids: everything of later turns up to its seq.
    voided = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(conv.orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("voided", voided).where("voided IS NULL OR seq > voided")
    log = conv.orderBy("turn", "seq", "kind", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = Window.partitionBy("conv_id", "turn").orderBy("seq", "kind", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.sum(F.when((F.col("kind") == "message"), 1).otherwise(0)).over(turn)
    e = e.withColumn("n", starts).withColumn("at", F.row_number().over(log))
    # Parts since the last edit or regeneration of the message make its text.
    fresh = F.max(F.when(F.col("kind") != "delta", F.col("at")))
    parts = F.array_sort(F.collect_list(F.struct("at", "kind", "text")))
    return (
        e.groupBy("conv_id", "turn", "n")
        .agg(fresh.alias("fresh"), F.min_by("role", "at").alias("role"), parts.alias("parts"))
        .select(
            "conv_id", "turn", "n", "role",
            F.expr("array_join(transform(filter(parts, x -> (fresh IS NULL OR x.at >= fresh) AND x.kind <> 'regenerate'), x -> x.text), '')").alias("text"),
        )
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: formatted, segments (text, loss) that make it up, and loss_spans (start, end) in code points."""
    text = escape(F.col("text"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    m = messages.select("conv_id", "turn", "n", (F.col("role") == loss_role).alias("loss"), head.alias("head"), text.alias("body"))
    before = Window.partitionBy("conv_id").orderBy("turn", "n", "head", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("head") + F.length("body") + F.lit(len(END))
    stop = F.sum(size.cast("long")).over(before) - F.lit(len(END))
    m = m.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("body"))
    rows = F.array_sort(F.collect_list(F.struct("stop", "start", "loss", "head", "body")))
    return m.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id",
        F.expr(f"array_join(transform(rows, x -> concat(x.head, x.body, '{END}')), '')").alias("formatted"),
        F.expr(f"flatten(transform(rows, x -> array(struct(x.head AS text, false AS loss), struct(x.body AS text, x.loss AS loss), struct('{END}' AS text, false AS loss))))").alias("segments"),
        F.expr("transform(filter(rows, x -> x.loss), x -> struct(x.start, x.stop AS end))").alias("loss_spans"),
    )


def parse(formatted) -> F.Column:
    """array<struct<role, text>>: the turns, read back from the formatted text alone."""
    pieces = F.split(formatted, r"<\|im_end\|>")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(piece):
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        two = F.split(body, r"<\|im_sep\|>", 2)
        return F.struct(unescape(two[0]).alias("role"), unescape(two[1]).alias("text"))

    return F.transform(pieces, one)


def format_log(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    return render(fold_events(events), loss_role)


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from the output of render(): turns by the template, the loss by its spans in the text."""
    learnt = F.expr("transform(loss_spans, x -> substring(formatted, cast(x.start AS int) + 1, cast(x.end - x.start AS int)))")
    turns = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), learnt.alias("learnt"))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = F.array_join(F.transform("learnt", lambda x: unescape(x)), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
