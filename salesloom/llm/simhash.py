"""Near-duplicate documents by SimHash fingerprints and deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the allowed distance have a
segment that differs by one bit at most. Each segment is indexed once as it is and once with each
bit deleted; an equality join on these signatures finds all candidates, which are then verified.
"""

from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from salesloom import scratch
from salesloom.llm.batches import small_batches, unused_names
from salesloom.llm.components import connected_components

BITS = 64
SEED = 42


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with only A-Z lower-cased; bytes methods know ASCII only."""
    return text.lower().split()


def shingle_hashes(text: bytes | None, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``size`` words; a shorter text is one run, a text without words none."""
    words = words_of(text) if text is not None else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxh64_intdigest, runs, repeat(seed)), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority of each bit as a signed 64-bit number, zero for no hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: Column, shingle_words: int = 3) -> Column:
    """Fingerprint of a text as a bigint that holds the 64 bits."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [fingerprint(shingle_hashes(t, shingle_words)) for t in texts], dtype="int64"
        )

    return of(text.cast("binary"))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment: the fewest of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _keys(max_bits: int) -> Column:
    """All signatures of ``fp``: ``(key, side)``.

    ``side`` is the deleted bit: texts that differ in it meet from opposite sides. Whole segments
    have side null. The key holds the segment's number, the deleted bit and the other bits.
    """
    out = []
    for s, (lo, width) in enumerate(_segments(max_bits)):
        value = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))
        head = s * (BITS + 1)
        out.append(F.struct(F.lit(head).alias("place"), value.alias("rest"), F.lit(None).cast("int").alias("side")))
        for i in range(width):
            side = F.shiftrightunsigned(value, i).bitwiseAND(F.lit(1)).cast("int")
            rest = value.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i)))
            out.append(F.struct(F.lit(head + 1 + i).alias("place"), rest.alias("rest"), side.alias("side")))
    return F.array(*out)


def _large(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast. Spark takes an exploded row for as large as the row it
    came from, so it would send the driver an index of many signatures a document as a small table."""
    return df.hint("merge")


def _pairs(index: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``(a, b)`` within the distance that share a signature of ``index(fp, place, rest, side)``."""
    keys = ["place", "rest"]
    left = index.select(*keys, F.col("fp").alias("a"), F.col("side").alias("sa"))
    right = index.select(*keys, F.col("fp").alias("b"), F.col("side").alias("sb"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    same = left.where("sa IS NULL").join(_large(right.where("sb IS NULL")), keys).where("a < b")
    apart = left.where("sa = 0").join(_large(right.where("sb = 1")), keys)
    return same.where(near).select("a", "b").union(apart.where(near).select("a", "b"))


def _fine_keys(max_bits: int) -> Column:
    """Every way to delete ``max_bits`` bits: texts that share one are within the distance."""
    ways = [sum(1 << i for i in c) for c in combinations(range(BITS), max_bits)]
    masks = F.lit(",".join(str(w - (1 << BITS) if w >> 63 else w) for w in ways))
    masks = F.split(masks, ",").cast("array<bigint>")
    return F.transform(
        masks,
        lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(F.bitwise_not(m)).alias("rest")),
    )


def fingerprint_links(fps: DataFrame, max_bits: int = 2, bucket_limit: int = 1000) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly what lies within ``max_bits`` of each other.

    ``fps(fp)`` holds distinct fingerprints, so copies meet no one. Where more than
    ``bucket_limit`` of them share a segment and ``max_bits`` is 2 or less, its buckets are not
    paired: their members are indexed by every way to delete ``max_bits`` bits, and each bucket of
    that index, in which everything is linked, is tied to its smallest member. That is linear in
    the bucket and loses no link, so the components are the same; the single pairs are not listed.
    """
    signed = fps.select("fp", F.explode(_keys(max_bits)).alias("k")).select("fp", "k.*")
    whole = signed.where("side IS NULL")
    crowded = (
        whole.groupBy("place", "rest").agg(F.count("*").alias("n")).where(F.col("n") > bucket_limit)
    )
    stars = None
    if max_bits <= 2 and not crowded.isEmpty():
        # All buckets that a crowded segment value falls into, by the same rule as the index.
        values = scratch.materialize(
            whole.join(_large(crowded), ["place", "rest"], "left_semi").select("fp", "place"), "crowded"
        )
        segment = F.floor(F.col("place") / (BITS + 1))
        hot = scratch.materialize(
            values.join(_large(signed.withColumnRenamed("place", "at")), "fp")
            .where(segment == F.floor(F.col("at") / (BITS + 1)))
            .select(F.col("at").alias("place"), "rest")
            .distinct(),
            "hot",
        )
        members = signed.join(_large(hot), ["place", "rest"], "left_semi").select("fp").distinct()
        fine = members.select("fp", F.explode(_fine_keys(max_bits)).alias("k"))
        least = fine.groupBy("k").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
        stars = fine.join(_large(least), "k").where("fp > b").select(F.col("fp").alias("a"), "b")
        signed = signed.join(_large(hot), ["place", "rest"], "left_anti")
    index = scratch.materialize(signed, "signatures") if stars is not None else signed
    links = _pairs(index, max_bits)
    return links if stars is None else links.union(stars)


def _rooted(distinct: DataFrame, max_bits: int, bucket_limit: int) -> DataFrame:
    """``distinct(fp, first)`` with ``root``, a fingerprint that all linked ones share."""
    links = fingerprint_links(distinct.select("fp"), max_bits, bucket_limit)
    linked = connected_components(links).withColumnRenamed("node", "fp")
    return distinct.join(_large(linked), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = 2,
    bucket_limit: int = 1000,
) -> DataFrame:
    """``(id_col, fp, component)`` for every row: its fingerprint and the smallest linked id.

    Two rows link when their fingerprints differ in ``max_bits`` bits or fewer; a component is all
    that links connect. Null and empty texts have fingerprint zero and link like any other. A null
    id is never the smallest; a component of null ids only has null. Repeated rows stay, other
    columns are left out, an empty table gives an empty result.

    Copies collapse before anything is joined, so a group of any number of copies is one row in the
    index. Fingerprints stay in the cluster.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), simhash(F.col(text_col), shingle_words).alias("fp")
    )
    rows = scratch.materialize(rows, "fingerprints")
    distinct = scratch.materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    rooted = _rooted(distinct, max_bits, bucket_limit)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    owner = scratch.materialize(rooted.join(_large(smallest), "root").select("fp", "component"), "owners")
    return rows.join(_large(owner), "fp").select(F.col("id").alias(id_col), "fp", "component")


def _text_key(text: Column) -> Column:
    """128 bits that stand for the whole text; null and empty texts are one."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("h"), F.xxhash64(whole, F.lit(SEED)).alias("g"))


def _sized(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A stored narrow table, broadcast if it has at most ``rows`` rows; else joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else _large(df)


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = 2,
    bucket_limit: int = 1000,
) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_duplicates`: that with the smallest id.

    All columns stay. Null and empty texts are copies of each other; a null id counts as larger than
    any; of rows equal in id and text one stays. Only the keys of rows that go are joined with the
    documents, by the measured number of them as a broadcast or a shuffle.
    """
    small_batches(docs.sparkSession)
    key = _text_key(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"), key.alias("text"), simhash(F.col(text_col), shingle_words).alias("fp")
    )
    rows = rows.groupBy("id", "text").agg(F.first("fp").alias("fp"), F.count("*").alias("copies"))
    rows = scratch.materialize(rows, "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text")
    distinct = scratch.materialize(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    rooted = _rooted(distinct, max_bits, bucket_limit)
    first = rooted.groupBy("root").agg(F.min("first").alias("first"))
    owner = scratch.materialize(rooted.select("fp", "root").join(_large(first), "root").select("fp", "first"), "owners")
    stays = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.text") == F.col("text"))
    marked = rows.join(_large(owner), "fp").select("id", "text", "copies", stays.alias("stays"))
    marked = scratch.materialize(marked.where("NOT stays OR copies > 1").drop("copies"), "marked")

    # Names that no column of the documents has.
    at, text, own = unused_names(docs, "id", "text", "key")
    marked = marked.withColumnsRenamed({"id": at, "text": text})
    same = F.col(own).eqNullSafe(F.col(text)) & F.col(id_col).eqNullSafe(F.col(at))
    keyed = docs.withColumn(own, key)
    single = keyed.join(_sized(marked.select(at, text)), same, "left_anti")
    repeated = keyed.join(_sized(marked.where("stays").select(at, text)), same, "left_semi")
    return single.unionByName(repeated.dropDuplicates([id_col, own])).drop(own)
