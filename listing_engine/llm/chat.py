"""Multi-party perspective rotation of dialogues.

Every participant of a conversation (a role that speaks in it) gets a
rendering of the whole dialogue in which that participant is the assistant and
every other one a named user:

    <|assistant|>\n{text}<|end|>\n
    <|user name=NAME|>\n{text}<|end|>\n

One row per conversation, perspective and turn holds the rendered segment, its
start in the rendered dialogue and the character span to train on: the
assistant's text with its end mark.  The dialogue is the segments in order of
`start`, `render` joins them.  A conversation can hold any share of all rows,
so its text is never built as one value here: the starts are prefix sums of
lengths over slices of turns, and the participants of a conversation come from
a partial aggregation.  The rows are turns x participants, as every participant's
dialogue has every turn.

Defined results: a NULL role speaks as `unknown`; a NULL text is an empty
utterance with an empty span; NULL conv_id is one conversation of its own;
turns are ordered by turn (NULL first), then role, then a hash of the text, so
ties and repeated rows have a fixed order; markers inside a text are broken by a space
after `<`, so a text can't forge a turn; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE = 64  # turns a slice
END = "<|end|>\n"


def _heads(speaker: Column, perspective: Column) -> Column:
    named = F.concat(F.lit("<|user name="), F.replace(speaker, F.lit("|"), F.lit("/")), F.lit("|>\n"))
    return F.when(speaker == perspective, F.lit("<|assistant|>\n")).otherwise(named)


def segments(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, speaker, segment, start, train_start, train_end."""
    said = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("at"), F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"))
    # Two hashes name a turn, so that one partitioning serves the texts and their places.
    said = said.withColumn("key", F.xxhash64("conv", "at", "speaker")).withColumn("tie", F.xxhash64("said"))
    # Places come from lengths alone; equal turns are one narrow row.
    turns = (said.groupBy("key", "tie", "conv", "at", "speaker", F.length("said").cast("long").alias("chars"))
             .agg(F.count(F.lit(1)).alias("times")))
    people = turns.select(F.col("conv").alias("p_conv"), F.col("speaker").alias("perspective")).distinct()
    rows = (turns.join(people, F.col("conv").eqNullSafe(F.col("p_conv"))).drop("p_conv")
            .withColumn("slice", F.floor(F.col("at") / SLICE))
            .withColumn("length", F.length(_heads(F.col("speaker"), F.col("perspective"))) + F.col("chars") + F.lit(len(END))))
    total = F.sum(F.col("length") * F.col("times"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    slices = (rows.groupBy("conv", "perspective", "slice").agg(total.alias("n"))
              .select(F.col("conv").alias("s_conv"), F.col("perspective").alias("s_who"), F.col("slice").alias("s_slice"),
                      F.coalesce(F.sum("n").over(before.partitionBy("conv", "perspective").orderBy("slice")),
                                 F.lit(0)).alias("offset")))
    inside = before.partitionBy("conv", "perspective", "slice").orderBy("at", "speaker", "tie")
    placed = (rows.withColumn("inside", F.coalesce(total.over(inside), F.lit(0)))
              .join(slices, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("perspective") == F.col("s_who"))
                    & F.col("slice").eqNullSafe(F.col("s_slice")))
              .select("key", "tie", "times", "length", "perspective", (F.col("offset") + F.col("inside")).alias("first")))
    # The texts are shuffled once, to their places; a repeated turn has one text and `times` places.
    whole = (said.dropDuplicates(["key", "tie"]).join(placed, ["key", "tie"])
             .withColumn("copy", F.explode(F.expr("sequence(0L, times - 1)")))
             .withColumn("start", F.col("first") + F.col("copy") * F.col("length"))
             .withColumn("head", _heads(F.col("speaker"), F.col("perspective"))))
    mine = F.col("speaker") == F.col("perspective")
    spoken = F.col("start") + F.length("head")
    return whole.select(
        F.col("conv").alias("conv_id"), "perspective", F.col("at").alias("turn"), "speaker",
        F.concat("head", "said", F.lit(END)).alias("segment"), "start",
        F.when(mine, spoken).alias("train_start"),
        F.when(mine, spoken + F.length("said") + F.lit(len(END) - 1)).alias("train_end"))


def render(rows: DataFrame, max_chars: int = 1 << 20) -> DataFrame:
    """Whole dialogues as text with their training spans, from `segments`.

    A dialogue becomes one value per block of `max_chars` characters, so no
    value grows with the data; `block` numbers them in order.
    """
    mask = F.filter(F.transform("parts", lambda p: F.struct(p.train_start, p.train_end)), lambda m: m.train_start.isNotNull())
    return (rows.withColumn("block", F.floor(F.col("start") / max_chars))
            .groupBy("conv_id", "perspective", "block")
            .agg(F.sort_array(F.collect_list(F.struct("start", "segment", "train_start", "train_end"))).alias("parts"))
            .select("conv_id", "perspective", "block",
                    F.array_join(F.transform("parts", lambda p: p.segment), "").alias("dialogue"),
                    mask.alias("train_spans")))
