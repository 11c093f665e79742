"""Quotation linking: who replies to whom, from what messages quote.

A line that starts with ``>`` marks is a quotation, as deep as it has marks; the
other lines are the message's own. Lines are normalised (marks off, lower case,
white space collapsed). Consecutive lines of one level are a passage, whose words form one
sequence, so it does not matter how a mail client wraps it. A passage is known by
the hash of its words. Its tokens are its windows of ``WINDOW`` words, its whole lines with
fewer words, and itself if it has fewer. A message holds a token whose words stand in a row in a
passage of its own.

A passage votes with those of its tokens that the fewest earlier messages of the conversation hold,
each for the latest of these; common lines such as greetings thus decide only
where nothing rarer is quoted, and words on both sides of a line break tell the
message that holds all of a quotation from one that holds some lines of it. The message with
most votes of the first-level passages is the one replied to (the later
one in a tie); without any, it is the message before. Since replies come later
than what they answer, the links form trees. Pointer jumping gives each message
its thread (the first message) and depth in log2(depth) joins.

Everything is built-in expressions. Only conversations that quote send tokens of their own words,
and of these only lengths that are quoted. "Latest earlier" and the number of earlier holders are taken
inside blocks of turns, and between blocks over one row per block, so a token or conversation
that holds a third of all rows is spread over tasks, and no pairs of messages are
made. ``in_reply_order`` writes the conversations range-partitioned by
(conversation, thread, depth, turn), which also splits a long one.

Null texts are empty messages; rows without a conversation or turn are threads of
their own; repeated rows each keep their row and are one message; several texts
under one turn quote and are quoted together, and equal passages of a turn count once. An empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land

_MARKS = r"^ {0,3}((?:> ?)+)"
#: Turns per block.
BLOCK = 256
#: Words per token of a passage.
WINDOW = 5


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, _MARKS, 1)
    return F.length(marks) - F.length(F.translate(marks, ">", ""))


def _normal(line: Column) -> Column:
    bare = F.regexp_replace(line, _MARKS, "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[\x20\x09-\x0D]+", " "))


def _block(turn: str) -> Column:
    return F.floor(F.col(turn) / BLOCK)


def _passages(parsed: Column) -> Column:
    """Runs of lines of one level, as the level and the lines with a word."""
    first = F.filter(
        F.sequence(F.lit(0), F.size(parsed) - 1),
        lambda i: (i == 0) | (parsed[i]["level"] != parsed[F.greatest(i - 1, F.lit(0))]["level"]),
    )

    def run(starts: Column) -> Column:
        after = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(parsed)))
        return F.transform(
            F.arrays_zip(starts.alias("start"), after.alias("after")),
            lambda x: F.struct(
                parsed[x["start"]]["level"].alias("level"),
                F.filter(
                    F.transform(F.slice(parsed, x["start"] + 1, x["after"] - x["start"]), lambda y: y["body"]),
                    lambda body: body != "",
                ).alias("lines"),
            ),
        )

    return F.transform(F.array(first), run)[0]


def _windows(words: Column, length: Column) -> Column:
    """Hashes of all ``length`` words in a row."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - length + 1, F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, length)))
    return F.when(F.size(words) >= length, hashes).otherwise(F.array().cast("array<long>"))


def _tokens(words: Column, lines: Column) -> Column:
    """The distinct tokens of a quoted passage: number of words, and hash."""
    windows = F.transform(_windows(words, F.lit(WINDOW)), lambda h: F.struct(F.lit(WINDOW).alias("n"), h.alias("token")))
    short = F.filter(
        F.concat(F.transform(lines, lambda line: F.split(line, " ")), F.array(words)), lambda x: F.size(x) < WINDOW
    )
    return F.array_distinct(
        F.concat(windows, F.transform(short, lambda x: F.struct(F.size(x).alias("n"), F.xxhash64(x).alias("token"))))
    )


def _latest(events: DataFrame, keys: list[str], own: str) -> DataFrame:
    """``events`` with the largest ``own`` at an earlier turn under the same keys as ``before``, and how many as ``holders``.

    Under the same keys, rows with an ``own`` have different turns.
    """
    events = events.withColumn("block", _block("turn"))
    inside = Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        events.groupBy(*keys, "block")
        .agg(F.max(own).alias("most"), F.count(own).alias("some"))
        .withColumns({"carried": F.max("most").over(blocks), "so_far": F.sum("some").over(blocks)})
        .drop("most", "some")
    )
    return (
        events.withColumns({"inside": F.max(own).over(inside), "near": F.count(own).over(inside)})
        .join(carried, [*keys, "block"])
        .withColumn("before", F.coalesce("inside", "carried"))
        .withColumn("holders", F.col("near") + F.coalesce("so_far", F.lit(0)))
        .drop("block", "inside", "carried", "near", "so_far")
    )


def link_quotations(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Per message (``conv_id``, ``turn``, ``role``, ``text``): text without quotations, and its place.

    ``reply_to`` is the turn replied to, ``thread`` the turn of the first message,
    ``depth`` the number of replies in between; ``n_quoted`` and ``n_linked``
    count quoted passages, and those of which an earlier message holds a token.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    parsed = F.transform(lines, lambda line: F.struct(_level(line).alias("level"), _normal(line).alias("body")))
    found = (
        messages.where("conv_id is not null and turn is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.explode(F.transform(F.array(parsed), _passages)[0]).alias("passage"),
        )
        .select("conv_id", "turn", "passage.level", "passage.lines")
        .where(F.size("lines") > 0)
        .withColumn("words", F.split(F.array_join("lines", " "), " "))
    )
    quoted = land(
        spark,
        found.where("level > 0")
        .select("conv_id", "turn", "level", F.xxhash64("words").alias("passage"), F.explode(_tokens(F.col("words"), F.col("lines"))).alias("t"))
        .select("conv_id", "turn", "level", "passage", "t.n", "t.token")
        .distinct(),
        "quoted-tokens",
    )
    # Own words matter only in conversations that quote, and in the lengths quoted there.
    lengths = quoted.groupBy("conv_id").agg(F.collect_set("n").alias("lengths"))
    own = (
        found.where("level = 0")
        .join(lengths, "conv_id")
        .select(
            "conv_id", "turn",
            F.explode(F.flatten(F.transform("lengths", lambda n: _windows(F.col("words"), n)))).alias("token"),
        )
        .join(quoted.select("conv_id", "token").distinct(), ["conv_id", "token"], "left_semi")
        .distinct()
    )
    events = quoted.drop("n").withColumn("own", F.lit(None).cast("long")).unionByName(
        own.withColumn("own", F.col("turn")), allowMissingColumns=True
    )
    linked = land(spark, _latest(events, ["conv_id", "token"], "own").where("own is null"), "linked-tokens")
    counts = (
        linked.groupBy("conv_id", "turn", "level", "passage")
        .agg(F.max(F.col("before").isNotNull().cast("long")).alias("linked"))
        .groupBy("conv_id", "turn")
        .agg(F.count(F.lit(1)).alias("n_quoted"), F.sum("linked").alias("n_linked"))
    )
    rarest = Window.partitionBy("conv_id", "turn", "passage")
    votes = (
        linked.where("level = 1 and before is not null")
        .groupBy("conv_id", "turn", "passage", "holders", "before")
        .agg(F.count(F.lit(1)).alias("tokens"))
        .withColumn("fewest", F.min("holders").over(rarest))
        .where("holders = fewest")
        .groupBy("conv_id", "turn", "before")
        .agg(F.sum("tokens").alias("tokens"))
        .groupBy("conv_id", "turn")
        .agg(F.max(F.struct("tokens", "before"))["before"].alias("quoted_turn"))
    )
    turns = (
        messages.where("conv_id is not null and turn is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"))
        .distinct()
        .withColumn("own", F.col("turn"))
    )
    replies = (
        _latest(turns, ["conv_id"], "own")
        .join(votes, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.coalesce("quoted_turn", "before").alias("reply_to"))
    )
    placed = _threads(spark, replies).join(counts, ["conv_id", "turn"], "left")
    placed = placed.withColumnsRenamed({"conv_id": "c", "turn": "t"})
    bare = F.array_join(F.filter(lines, lambda line: _level(line) == 0), "\n")
    rows = messages.select("conv_id", "turn", "role", bare.alias("text"))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return rows.join(placed, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left").select(
        "conv_id", "turn", "role", "text", "reply_to", F.coalesce("thread", F.col("turn").cast("long")).alias("thread"),
        zero("depth"), zero("n_quoted"), zero("n_linked"),
    )


def _threads(spark: SparkSession, replies: DataFrame) -> DataFrame:
    """``replies`` with the first message of each one's thread and the depth below it."""
    nodes = replies.select(
        "conv_id", "turn", "reply_to", F.coalesce("reply_to", "turn").alias("thread"),
        F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth"),
    )
    nodes = land(spark, nodes.withColumn("done", F.col("depth") == 0), "threads")
    while not nodes.where("not done").isEmpty():
        above = nodes.select(
            "conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more")
        )
        # Only messages that have not arrived at a first message take part.
        moved = nodes.where("not done").join(above, ["conv_id", "thread"]).select(
            "conv_id", "turn", "reply_to", F.col("further").alias("thread"),
            (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") == 0).alias("done"),
        )
        nodes = land(spark, nodes.where("done").select(*moved.columns).union(moved), "threads")
    return nodes.drop("done")


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The messages sorted by conversation, thread, depth and turn, each after what it replies to."""
    order = ["conv_id", "thread", "depth", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)
