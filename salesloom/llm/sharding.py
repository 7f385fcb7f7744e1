"""Shards by a keyed permutation of global row numbers, with DataFrame functions only.

Rows are numbered in the order of their content. A Feistel network permutes the numbers: a number is
split into two digits of nearly equal range, and each round adds a keyed hash of one digit to the
other. The digits reach a little past the number of rows; a number that lands there is permuted
again until it is back inside (cycle walking). The permuted number gives the shard and the slot, so
both can be computed for any row number, and the row number for any shard and slot.
"""

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.keys import with_surrogate_key

SHARDS = 8
SEED = 42
ROUNDS = 8  # even, so that the digits end in their own places


def sides(n: int) -> tuple[int, int]:
    """Ranges ``(a, b)`` of the two digits; a * b is at least ``n`` and less than ``n`` + a."""
    n = max(n, 1)
    a = isqrt(n - 1) + 1
    return a, -(-n // a)


def _long(number: int) -> Column:
    return F.lit(number).cast("bigint")


def _hash(seed: int, place: Column, digit: Column) -> Column:
    """60 bits of the md5 of ``seed:place:digit``."""
    text = F.concat_ws(":", F.lit(str(seed)), place.cast("string"), digit.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def feistel(number: Column, n: int, seed: int = SEED, backward: bool = False) -> Column:
    """One pass of the network over 0 to a * b - 1, or its inverse."""
    a, b = sides(n)

    def digits(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    def one(state: Column, i: Column) -> Column:
        bound = F.when(i % 2 == 0, _long(a)).otherwise(_long(b))
        if backward:
            return digits(F.pmod(state["y"] - _hash(seed, i, state["x"]) % bound, bound), state["x"])
        return digits(state["y"], (state["x"] + _hash(seed, i, state["y"])) % bound)

    order = range(ROUNDS - 1, -1, -1) if backward else range(ROUNDS)
    start = digits(F.call_function("div", number, _long(b)), number % _long(b))
    places = F.array(*[F.lit(i) for i in order])
    return F.aggregate(places, start, one, lambda s: s["x"] * _long(b) + s["y"])


def longest_walk(spark: SparkSession, n: int, seed: int = SEED, backward: bool = False) -> int:
    """How often a number below ``n`` has to be permuted again at most.

    Only the numbers past ``n``, fewer than its square root, can lie on a walk. They are walked until
    those that are still outside stay the same: these form cycles no row enters.
    """
    a, b = sides(n)
    outside = spark.range(n, a * b).select(F.col("id").alias("p"))
    left, steps = a * b - n, 0
    while left:
        outside = outside.select(feistel(F.col("p"), n, seed, backward).alias("p")).where(F.col("p") >= n)
        still = outside.count()
        steps += 1
        if still == left:
            break
        left = still
    return steps


def permuted(number: Column, n: int, walk: int, seed: int = SEED, backward: bool = False) -> Column:
    """The place of row ``number`` (0 to ``n`` - 1) in the shuffled order, or its inverse. ``walk``
    is what :func:`longest_walk` gives for the same arguments."""
    first = feistel(number.cast("bigint"), n, seed, backward)
    if not walk:
        return first
    again = F.array(*[F.lit(0)] * walk)
    return F.aggregate(
        again, first, lambda p, _: F.when(p >= n, feistel(p, n, seed, backward)).otherwise(p)
    )


def shuffled(df: DataFrame, order: Sequence[Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``number`` (from 0, in ``order``), ``shard`` and ``slot`` for every row.

    Shards differ by one row at most, and the slots of each are 0, 1, 2 and so on. What a row gets
    depends on its place in ``order``, the number of rows, ``shards`` and ``seed``, not on how the
    rows are partitioned. Rows equal in ``order`` are told apart by their place in the scan, so a key
    that holds much of the table is numbered by many tasks; which of them comes first is left open.
    Columns of ``df`` with one of the three names give way; an empty table stays empty.
    """
    kept = [c for c in df.columns if c.lower() not in ("number", "shard", "slot")]
    keys = {f"k{i}": key for i, key in enumerate(order)}
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        *[key.alias(name) for name, key in keys.items()],
        F.monotonically_increasing_id().alias("line"),
    )
    by = [F.asc_nulls_last(c) for c in (*keys, "line")]
    numbered = with_surrogate_key(rows, by, "number", drop=[*keys, "line"])
    n = numbered.count()
    walk = longest_walk(df.sparkSession, n, seed)
    number = F.col("number") - 1
    placed = numbered.select("row", number.alias("number"), permuted(number, n, walk, seed).alias("place"))
    shard = (F.col("place") % shards).cast("int")
    slot = F.call_function("div", F.col("place"), _long(shards))
    return placed.select(
        *[F.col("row")[c].alias(c) for c in kept], "number", shard.alias("shard"), slot.alias("slot")
    )


def row_number_at(shard: Column, slot: Column, n: int, walk: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The number of the row in a slot of a shard; ``walk`` is that of the inverse."""
    return permuted(slot * shards + shard, n, walk, seed, backward=True)


def shard_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)`` for every document.

    The law is ``rows``: shards differ by one row at most. A row's number is its rank by id (null
    last), text size and checksum, so rows that differ in nothing returned may swap places. Equal
    texts are spread like any others. A null text has no bytes; ``size`` is the text's UTF-8 bytes
    plus one. ``grown_shard`` is null: under this law one more shard moves rows between all shards.
    Repeated rows stay, other columns are left out, an empty table gives an empty result. Texts are
    read once and not shuffled.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    placed = shuffled(narrow, [F.col("id"), F.col("size"), F.col("text_crc32")], shards, seed)
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(placed: DataFrame, path: str, slots_per_file: int = 1_000_000) -> None:
    """Whole rows of :func:`shuffled` as Parquet, a folder for each shard and a file for each run of
    ``slots_per_file`` slots, in slot order."""
    part = F.call_function("div", F.col("slot"), _long(slots_per_file))
    dealt = placed.repartition("shard", part).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
