"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: its context is all turns before it,
and only its reply is trainable. Written out, the examples of a conversation repeat its
beginning again and again, which grows with the square of its length. So each turn is
rendered once, as a segment with its character offset in the conversation, and an example
is the segment of its reply: its context is the conversation's first ``context_chars``
characters. ``write_out`` joins contexts and replies for readers that want whole strings.

A turn is rendered as ``<|role|>text</s>``. Control strings inside a text get a backslash
after their first character (one more where there are some already), so that no text can
look like a marker and reading removes exactly what writing added. Roles are percent-coded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

END = "</s>"
# Control strings of this template and of common chat templates, after their first character.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
ROLE_CODES = (("%", "%25"), ("|", "%7C"), ("<", "%3C"), (">", "%3E"))
TARGET = "assistant"
CELL_TURNS = 4096


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _role_out(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_in(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def segments(turns: DataFrame, target: str = TARGET) -> DataFrame:
    """Render each row of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``) once.

    Returns ``conv_id``, ``position`` (from 0), ``segment``, ``offset`` (characters before it),
    ``example`` (from 0; null if the turn is no target), ``context_chars`` and, inside the
    segment, ``reply_start`` and ``reply_end``. Null texts and roles are empty. Null turns
    come first, ties are ordered by role and text, repeated rows stay. Rows with a null
    ``conv_id`` form one conversation. Other columns are not read.

    Positions, offsets and example numbers are running sums in two steps: totals per 4096
    turn numbers, then inside those, so a very long conversation is not one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    opening = F.concat(F.lit("<|"), _role_out(role), F.lit("|>"))
    rendered = turns.select(
        "conv_id", "turn", F.floor(F.col("turn") / CELL_TURNS).alias("cell"), role.alias("role"), text.alias("text"),
        (role == target).alias("is_target"), F.length(opening).alias("start"),
        F.concat(opening, escape(text), F.lit(END)).alias("segment"),
    ).withColumn("chars", F.length("segment").cast("long"))
    figures = {"position": F.lit(1).cast("long"), "offset": F.col("chars"), "example": F.col("is_target").cast("long")}
    totals = rendered.groupBy("conv_id", "cell").agg(*[F.sum(c).alias(f"{n}_all") for n, c in figures.items()])
    before = W.partitionBy("conv_id").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        F.col("conv_id").alias("c"), F.col("cell").alias("k"), *[F.coalesce(F.sum(f"{n}_all").over(before), F.lit(0)).alias(f"{n}_0") for n in figures]
    )
    inside = W.partitionBy("conv_id", "cell").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    run = rendered.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{n}_1") for n, c in figures.items()])
    placed = run.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("cell").eqNullSafe(F.col("k")))
    total = {n: F.col(f"{n}_0") + F.col(f"{n}_1") for n in figures}
    target_only = lambda c: F.when(F.col("is_target"), c)
    return placed.select(
        "conv_id", total["position"].alias("position"), "segment", total["offset"].alias("offset"),
        target_only(total["example"]).alias("example"),
        target_only(total["offset"] + F.col("start")).alias("context_chars"),
        target_only(F.col("start")).alias("reply_start"),
        target_only(F.col("chars").cast("int") - len(END)).alias("reply_end"),
    )


def examples(segs: DataFrame) -> DataFrame:
    """One row per training example: its reply's segment, trainable span and length of context."""
    return segs.where(F.col("example").isNotNull())


def write_out(segs: DataFrame) -> DataFrame:
    """``conv_id``, ``example``, ``prompt``, ``completion`` as whole strings.

    The output is as large as all contexts together; meant for conversations of ordinary length.
    """
    before = W.partitionBy("conv_id").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    run = segs.withColumn("earlier", F.array_join(F.collect_list("segment").over(before), ""))
    start = F.col("reply_start")
    return examples(run).select(
        "conv_id", "example", F.concat("earlier", F.expr("substring(segment, 1, reply_start)")).alias("prompt"),
        F.expr("substring(segment, reply_start + 1)").alias("completion"),
    )


def read_turn(segment: Column) -> Column:
    """Role and text of a rendered turn."""
    shape = r"(?s)^<\|([^|]*)\|>(.*)</s>$"
    return F.struct(
        _role_in(F.regexp_extract(segment, shape, 1)).alias("role"), unescape(F.regexp_extract(segment, shape, 2)).alias("text")
    )


def expanded(segs: DataFrame) -> DataFrame:
    """Every conversation as its examples, each with all turns before it, and the turns after the last reply.

    ``conv_id``, ``example`` (null: the turns after the last reply, without a target), ``prompt``, ``completion``
    and ``prompt_chars``, the length that ``context_chars`` states.
    """
    closing = segs.groupBy("conv_id").agg(F.coalesce(F.max(F.when(F.col("example").isNotNull(), F.col("position"))), F.lit(-1)).alias("_last"))
    rest = segs.join(closing.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).where(F.col("position") > F.col("_last"))
    tail = rest.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("position", "segment"))).alias("t"))
    after = tail.select(
        "conv_id", F.lit(None).cast("long").alias("example"), F.array_join(F.transform("t", lambda x: x.segment), "").alias("prompt"),
        F.lit("").alias("completion"), F.lit(None).cast("long").alias("prompt_chars"),
    )
    stated = examples(segs).select(F.col("conv_id").alias("c"), F.col("example").alias("e"), F.col("context_chars").alias("prompt_chars"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("example") == F.col("e"))
    return write_out(segs).join(stated, same).select(*after.columns).unionByName(after)


def digests(segs: DataFrame) -> DataFrame:
    """Read turns and trainable text back from the written examples: counts, lengths and SHA-256.

    The trainable text is the completions; the turns are those of the last example, prompt and completion, and
    the turns after it. Every prompt must have the length its example states, else an error is raised.
    A digest of a whole conversation needs the conversation in one row, so this report (not
    the formatting) is for conversations that fit in a task: below 2^31 bytes of text.
    """
    def turn(x: Column) -> Column:
        t = read_turn(F.concat(x, F.lit(END)))
        return F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))

    wrong = F.raise_error(F.lit("an example's prompt does not hold all turns before its reply"))
    rows = expanded(segs).withColumn("checked", F.when(F.col("example").isNull() | (F.length("prompt") == F.col("prompt_chars")), F.col("completion")).otherwise(wrong))
    # a reply without its end; no text holds one, since control strings are escaped
    reply = unescape(F.expr(f"substring(checked, 1, length(checked) - {len(END)})"))
    newest = F.max_by(F.concat("prompt", "checked"), "example")
    whole = rows.groupBy("conv_id").agg(
        F.concat(F.coalesce(newest, F.lit("")), F.coalesce(F.max(F.when(F.col("example").isNull(), F.col("prompt"))), F.lit(""))).alias("all"),
        F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", reply.alias("reply"))))).alias("r"),
    )
    pieces = F.split("all", END)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    loss = F.array_join(F.transform("r", lambda x: x.reply), "")
    read = whole.select("conv_id", "all", turns.alias("t"), loss.alias("loss"))
    return read.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("t", turn), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("all").cast("long").alias("formatted_chars"),
    )


def with_control_turns(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The conversations and one more, -1, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = [F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", TARGET))]
    extra = spark.range(1).select(F.inline(F.array(*rows)))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
