"""The transaction fact: surrogate keys in place of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import calendar as cal
from tallyhouse.schemas import FACT

_POSITION = "transaction_key"


def is_small(members: DataFrame) -> bool:
    """The planner's own estimate is below the limit up to which it broadcasts.

    The dimensions are read from files, so the estimate is a true bound.
    """
    query = members._jdf.queryExecution()
    limit = members.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(query.optimizedPlan().stats().sizeInBytes())) <= limit


def _shares(lines: DataFrame, column: str) -> DataFrame:
    """(``hot``, ``shares``): values of ``column`` with more lines than a reducer
    would get if all values were alike, and over how many reducers to deal them.

    At most one value per reducer can be that frequent, so the table has at
    most as many rows as a shuffle has partitions.
    """
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = lines.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    total = lines.agg(F.count(F.lit(1))).scalar()
    return (
        counts.withColumn("shares", F.ceil(F.col("n") * F.lit(partitions) / total).cast("int"))
        .where("shares > 1")
        .select("hot", "shares")
    )


def join_members(lines: DataFrame, members: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """``lines`` with the columns ``names`` of the member that ``column`` names, null where there is none.

    Members that the planner broadcasts need no care: lines stay where they are.
    Otherwise the lines are shuffled, and no key may fill a reducer. Lines
    without a key each get an absent key of their own. Frequent keys are dealt
    over as many copies of their member as they have shares, which does not rely
    on adaptive execution: it sees no skew beyond 2000 partitions.
    """
    known = members.select(F.col(column).alias("member"), *names)
    if is_small(known):
        return lines.join(known, lines[column] == F.col("member"), "left").drop("member")
    own = F.pmod(F.xxhash64(_POSITION), F.coalesce(F.col("shares"), F.lit(1))).cast("int")
    share = F.when(lines[column].isNull(), F.hash(_POSITION)).otherwise(own)
    shares = _shares(lines, column)
    # Bounded: at most one row per shuffle partition.
    dealt = lines.join(F.broadcast(shares), lines[column] == F.col("hot"), "left").withColumn("share", share)
    copies = (
        known.join(F.broadcast(shares), F.col("member") == F.col("hot"), "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)))
        .drop("hot", "shares")
    )
    return (
        dealt.join(copies, (dealt[column] == F.col("member")) & (F.col("share") == F.col("copy")), "left")
        .drop("hot", "shares", "share", "member", "copy")
    )


def _missing(members: DataFrame, column: str, key: str) -> Column:
    """The key of the missing member, if there is one."""
    return members.where(F.col(column).isNull()).agg(F.max(key)).scalar()


def key_lookup(lines: DataFrame, members: DataFrame, column: str, key: str) -> DataFrame:
    """Add ``key`` by looking ``column`` up; a missing value finds the missing
    member, and what has no member gets 0."""
    named = join_members(lines, members.where(F.col(column).isNotNull()), column, [key])
    missing = _missing(members, column, key)
    return named.withColumn(
        key, F.coalesce(F.when(F.col(column).isNull(), missing).otherwise(F.col(key)), F.lit(0).cast("bigint"))
    )


def customer_lookup(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Like :func:`key_lookup`, but a missing customer is always 0."""
    named = join_members(lines, customers, "customer_id", ["customer_key"])
    return named.withColumn("customer_key", F.coalesce(F.col("customer_key"), F.lit(0).cast("bigint")))


def _merged(lines: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """``lines`` in ranges of their position, with the keys of members that are too many to broadcast; 0 where there is none.

    Whole lines are shuffled once, however many keys there are. Only position and name meet the
    members; what is found travels to the line's place in the order as position and key.
    """
    position, line = F.col(_POSITION), F.struct(*[f"`{name}`" for name in lines.columns])
    keys = [key for _, _, key in lookups]

    def rows(frame: DataFrame, whole: Column, **known: Column) -> DataFrame:
        empty = F.lit(None).cast("bigint")
        return frame.select(position, whole.alias("line"), *[known.get(key, empty).alias(key) for key in keys])

    parts = rows(lines, line, **{
        key: F.when(F.col(column).isNull(), _missing(members, column, key))
        for members, column, key in lookups if column != "customer_id"
    })
    nothing = F.lit(None).cast(parts.schema["line"].dataType)
    for members, column, key in lookups:
        named = lines.select(_POSITION, column).where(F.col(column).isNotNull())
        found = join_members(named, members.where(F.col(column).isNotNull()), column, [key]).where(F.col(key).isNotNull())
        parts = parts.union(rows(found, nothing, **{key: F.col(key)}))
    # As many ranges as the shuffle is wide: merged into fewer, they would not fit the memory of a task.
    width = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartitionByRange(width, _POSITION).groupBy(_POSITION).agg(
        F.first("line", ignorenulls=True).alias("line"), *[F.coalesce(F.max(key), F.lit(0).cast("bigint")).alias(key) for key in keys]
    )
    return merged.select("line.*", *keys).sortWithinPartitions(_POSITION)


def fact_transactions(
    numbered: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame
) -> DataFrame:
    """``numbered`` is the clean table with its row number as transaction_key.

    A line without a date keeps its place with date key 0; it is never a valid
    sale. Lines keep their order: lookups that shuffle bring them back into
    ranges of the key.
    """
    lookups = [(countries, "country", "country_key"), (products, "stock_code", "product_key"), (customers, "customer_id", "customer_key")]
    large = [at for at in lookups if not is_small(at[0])]
    names = {name for _, name, _ in lookups}
    lines = numbered.select(*[name for name in numbered.columns if name in names or name in FACT.names or name == "invoice_date"])
    keys = {key for _, _, key in large}
    for members, column, key in lookups:
        if key not in keys:
            lines = customer_lookup(lines, members) if column == "customer_id" else key_lookup(lines, members, column, key)
    lines = _merged(lines, large) if large else lines
    flags = ("is_cancelled", "is_return", "is_valid_sale", "has_customer_id")
    return lines.withColumns({
        "date_key": F.coalesce(cal.date_key(F.col("invoice_date")), F.lit(0)),
        "invoice_datetime": F.col("invoice_date"),
        **{flag: F.col(flag).cast("int") for flag in flags},
    }).select(*FACT.names)
