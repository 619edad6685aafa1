"""Seeded order and exact ranks that do not depend on how the data is partitioned."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 52
RANK_BITS = 16
STEPS_PER_E = 1024
SPREAD = 4096  # tasks' worth of rows that need no order
STEPS_PER_OCTAVE = 4096
FRACTION_BITS = 52
DIGIT_SHIFTS = (42, 21, 0)  # digits of 22, 21 and 21 bits


def seeded_hash(seed: str, key: Column) -> Column:
    """Uniform integer in [0, 2^52) from the seed and the key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def uniform(hashed: Column) -> Column:
    """The hash as a double strictly between 0 and 1."""
    return (hashed + F.lit(0.5)) / F.lit(float(2**HASH_BITS))


def hash_bucket(hashed: Column) -> Column:
    """Order-preserving bucket of a seeded hash: 65,536 even buckets."""
    return F.shiftright(hashed, HASH_BITS - RANK_BITS)


def log_bucket(value: Column) -> Column:
    """Order-preserving bucket of a positive double: 1,024 per factor e.

    For sort keys -ln(u)/w with u uniform no bucket can hold more than 0.04% of the rows
    on average, whatever the weights: the density of ln(-ln(u)) is at most 1/e.
    """
    return F.floor(F.ln(value) * STEPS_PER_E).cast("bigint")


def magnitude_bucket(value: Column) -> Column:
    """Order-preserving bucket of any double: 4,096 per factor 2, on either side of 0."""
    # A double is never below 2^-1074, so the shift keeps the step number positive.
    step = F.floor(F.log2(F.abs(value)) * STEPS_PER_OCTAVE) + F.lit(1100 * STEPS_PER_OCTAVE)
    return F.when(value == 0, F.lit(0)).when(value > 0, step).otherwise(-step).cast("bigint")


def _offsets(df: DataFrame) -> DataFrame:
    """How many rows lie before each bucket. One row per bucket, a bounded number."""
    return _sized_offsets(df).drop("_size")


def _sized_offsets(df: DataFrame) -> DataFrame:
    """How many rows each bucket has, and how many lie before it."""
    sizes = df.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def with_position(df: DataFrame, order: list, bucket: Column, name: str) -> DataFrame:
    """Add the 0-based rank of each row in a total order.

    The window runs inside buckets that follow the order, and each bucket starts at the
    number of rows in the buckets before it: no task ever sees the whole table.
    """
    keyed = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy("_bucket").orderBy(*order)
    rank = F.col("_offset") + F.row_number().over(inside) - 1
    joined = keyed.join(F.broadcast(_offsets(keyed)), "_bucket")
    return joined.withColumn(name, rank.cast("bigint")).drop("_bucket", "_offset")


def take_smallest(df: DataFrame, k: int, order: list, bucket: Column, then: Column | None = None) -> DataFrame:
    """The k first rows of a total order, without a single-task sort.

    Buckets that start at or after k are dropped by the broadcast join, so about k rows
    are shuffled however large the table is. Where many rows can share a bucket, ``then`` is the next
    part of the order, with few values: the one bucket that k cuts through is divided by it, and only the
    division that k cuts through is put in order. Rows before it need no rank.
    """
    keyed = df.withColumn("_bucket", bucket)
    near = _sized_offsets(keyed).filter(F.col("_offset") < k)
    placed = keyed.join(F.broadcast(near), "_bucket")
    if then is None:
        inside = Window.partitionBy("_bucket").orderBy(*order)
        ranked = placed.withColumn("_rank", F.row_number().over(inside))
        return ranked.filter(F.col("_offset") + F.col("_rank") <= k).drop("_bucket", "_offset", "_size", "_rank")
    cut = F.col("_offset") + F.col("_size") > k
    placed = placed.withColumn("_next", F.when(cut, then))
    divided = placed.filter(cut).select(F.col("_next").alias("_bucket"), (F.lit(k) - F.col("_offset")).alias("_left"))
    sizes = divided.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_members"), F.max("_left").alias("_left"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_left") - F.coalesce(F.sum("_members").over(before), F.lit(0))
    divisions = sizes.select(F.col("_bucket").alias("_next"), "_members", room.alias("_room")).filter(F.col("_room") > 0)
    near_rows = placed.join(F.broadcast(divisions), "_next", "left").filter(~cut | F.col("_room").isNotNull())
    open_ = F.coalesce(F.col("_members") > F.col("_room"), F.lit(False))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SPREAD))
    task = F.when(open_, F.lit(-1)).otherwise(spread)
    ranked = near_rows.withColumn("_rank", F.row_number().over(Window.partitionBy(task).orderBy(*order)))
    return ranked.filter(~open_ | (F.col("_rank") <= F.col("_room"))).select(*[F.col(f"`{c}`") for c in df.columns])


def ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a long in the order of the doubles; -0 is 0, NaN the largest.

    Exponent and fraction come from exact divisions by powers of two, once a logarithm has told about where
    to look.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("double")
    power = F.pow(F.lit(2.0), guess)
    exponent = F.when(size < power, guess - 1).when(size >= power * 2, guess + 1).otherwise(guess)
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**FRACTION_BITS)
    normal = F.shiftleft((exponent + 1023).cast("bigint"), FRACTION_BITS) + fraction.cast("bigint")
    bits = (
        F.when(F.isnan(value), F.lit((2047 << FRACTION_BITS) + 1))
        .when(size == F.lit(float("inf")), F.lit(2047 << FRACTION_BITS))
        .when(size < F.lit(2.0**-1022), (size / F.lit(2.0**-1074)).cast("bigint"))
        .otherwise(normal)
    )
    return F.when((value < 0) & ~F.isnan(value), -bits).otherwise(bits)


def exact_median(df: DataFrame, value: Column, keys: list[str], name: str = "median") -> DataFrame:
    """Exact median per group; even groups average the middle two. Null values and keys do not count.

    The ``median`` aggregate keeps all distinct values of a group in one task, and so does any sort of a
    group. Here the middle is found digit by digit of the ordered bits. Each pass counts the values by one more
    digit, inside the tasks first, and only those that share the digits found so far; the counts of one
    digit, of which there are at most 2^22, tell in which the middle ones lie. No value is sent or sorted.
    """
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, "_value"]])
    coded = df.select(*keys, value.cast("double").alias("_value")).filter(known)
    coded = coded.withColumn("_bits", ordered_bits(F.col("_value")))
    wanted = None
    for shift in DIGIT_SHIFTS:
        digit = F.shiftright("_bits", shift).alias("_digit")
        if wanted is None:
            near, group = coded.select(*keys, digit), list(keys)
        else:
            same = [F.shiftright("_bits", before).alias("_found"), digit, *(["_value"] if not shift else [])]
            found = wanted.select(*keys, "_found").distinct()
            near, group = coded.select(*keys, *same).join(found, [*keys, "_found"]), [*keys, "_found"]
        exact = [F.min("_value").alias("_value")] if not shift else []
        counts = near.groupBy(*group, "_digit").agg(F.count(F.lit(1)).alias("_size"), *exact)
        window = Window.partitionBy(*group)
        offset = F.coalesce(F.sum("_size").over(window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("_offset", offset)
        if wanted is None:
            total = F.sum("_size").over(window)
            ranks = F.array(F.expr("(_total - 1) div 2"), F.expr("_total div 2"))
            placed = counts.withColumn("_total", total).withColumn("_rank", F.explode(ranks))
        else:
            placed = counts.join(wanted, group)
        inside = (F.col("_rank") >= F.col("_offset")) & (F.col("_rank") < F.col("_offset") + F.col("_size"))
        wanted = placed.filter(inside).select(
            *keys, F.col("_digit").alias("_found"), (F.col("_rank") - F.col("_offset")).alias("_rank"), *(["_value"] if not shift else [])
        )
        before = shift
    return wanted.groupBy(*keys).agg(((F.min("_value") + F.max("_value")) / 2).alias(name))
