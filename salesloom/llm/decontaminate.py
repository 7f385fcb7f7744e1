"""Benchmark passages in training documents, with DataFrame functions only.

The windows of the benchmark become a broadcast hash set, in blocks of bounded size. Documents are
scanned once per block: each run of words is hashed in place, looked up, and a hit is verified word
by word before it counts. Only hits and one mark per document are shuffled.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm.batches import unused_names

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything that is no word: ASCII but for digits and letters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_MARK = 0  # looked up at place 0 to carry the document itself through the join


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP)
    return F.array_remove(parts, "")


def windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct windows ``(h, gram, l, items)``; an item shorter than ``size`` is one window."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("l", F.least(F.size("w"), F.lit(size)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("l") + 1)
    rows = rows.select("item", "l", "w", F.explode(starts).alias("p"))
    rows = rows.select("item", "l", F.slice("w", F.col("p"), F.col("l")).alias("gram"))
    return rows.groupBy("l", "gram").agg(F.collect_set("item").alias("items")).withColumn(
        "h", F.xxhash64("gram")
    )


def _looked_up(lengths: list[int]) -> Column:
    """``(p, l, h)`` for every run of words of each length, after one mark."""
    n = F.size("w")

    def runs(size: int) -> Column:
        starts = F.when(n >= size, F.sequence(F.lit(1), n - (size - 1)))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda p: F.struct(
                p.alias("p"), F.lit(size).alias("l"), F.xxhash64(F.slice("w", p, size)).alias("h")
            ),
        )

    mark = F.struct(
        F.lit(0).alias("p"), F.lit(0).alias("l"), F.lit(_MARK).cast("bigint").alias("h")
    )
    return F.concat(F.array(mark), *map(runs, lengths))


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """What each document shares with the items, one row per row of ``docs``.

    Columns: ``id_col``, ``text_hash``, ``text_length`` (with the id they tell rows apart),
    ``n_words``, ``spans`` (runs of hit words as ``(p, e)``: first word from 1, one past the last;
    ordered, never touching), ``n_hit``, ``items`` (ids as sorted strings).

    Null and empty texts have no words and no hits; items without words are in nothing; a null item
    id is left out of ``items`` but its words count as hit. Equal rows give equal results, once
    each. Other columns are left out. The set is broadcast in blocks of about ``block_bytes`` of
    words, each block a scan of the documents, so what is broadcast never grows with the benchmark.
    """
    found = scratch.materialize(windows(items, item_id_col, item_text_col, window), "windows")
    volume = F.sum(
        F.aggregate("gram", F.lit(0), lambda a, w: a + F.octet_length(w) + 16)
        + F.aggregate("items", F.lit(0), lambda a, w: a + F.octet_length(w) + 16)
        + 64
    )
    lengths, size = found.agg(F.sort_array(F.collect_set("l")), volume).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    text = F.col(text_col)
    scan = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.length(text).alias("text_length"),
        words(text).alias("w"),
    )
    scan = scan.select("*", F.explode(_looked_up(lengths)).alias("r")).select(
        "id", "text_hash", "text_length", "w", "r.*"
    )
    spark = docs.sparkSession
    marks = spark.range(1).select(
        F.lit(0).alias("wl"),
        F.array().cast("array<string>").alias("gram"),
        F.array().cast("array<string>").alias("items"),
        F.lit(_MARK).cast("bigint").alias("h"),
    )
    hits = []
    for block in range(blocks):
        part = found.where(F.pmod("h", F.lit(blocks)) == block).withColumnRenamed("l", "wl")
        if block == 0:
            part = part.unionByName(marks)
        same = F.expr("l = wl AND (l = 0 OR slice(w, p, l) = gram)")
        hits.append(
            scan.join(F.broadcast(part), "h")
            .where(same)
            .select("id", "text_hash", "text_length", F.size("w").alias("n"), "p", "l", "items")
        )
    hits = reduce(DataFrame.union, hits)
    real = F.col("l") > 0
    rows = hits.groupBy("id", "text_hash", "text_length").agg(
        F.max("n").cast("bigint").alias("n_words"),
        F.count_if(~real).alias("copies"),
        F.collect_set(F.when(real, F.struct("p", (F.col("p") + F.col("l")).alias("e")))).alias("runs"),
        F.collect_set(F.when(real, F.col("items"))).alias("items"),
    )
    rows = rows.withColumn("spans", _merged(F.array_sort("runs")))
    rows = rows.select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    )
    return rows.select(
        F.col("id").alias(id_col),
        "text_hash",
        "text_length",
        "n_words",
        "spans",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["e"] - s["p"]).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def _merged(runs: Column) -> Column:
    """Sorted runs with overlapping and touching ones put together."""
    empty = F.array().cast("array<struct<p:int,e:int>>")
    start = F.struct(empty.alias("done"), F.lit(None).cast("struct<p:int,e:int>").alias("open"))

    def step(a, run):
        apart = a["open"].isNull() | (run["p"] > a["open"]["e"])
        done = F.when(
            apart & a["open"].isNotNull(), F.concat(a["done"], F.array(a["open"]))
        ).otherwise(a["done"])
        grown = F.struct(a["open"]["p"].alias("p"), F.greatest(a["open"]["e"], run["e"]).alias("e"))
        return F.struct(done.alias("done"), F.when(apart, run).otherwise(grown).alias("open"))

    return F.aggregate(
        runs,
        start,
        step,
        lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(
            F.concat(a["done"], F.array(a["open"]))
        ),
    )


def remove_documents(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; all columns stay."""
    at, code, length = unused_names(docs, "id", "hash", "length")
    bad = hits.where("n_hit > 0").select(
        F.col(id_col).alias(at), F.col("text_hash").alias(code), F.col("text_length").alias(length)
    )
    same = (
        F.col(id_col).eqNullSafe(F.col(at))
        & (F.xxhash64(F.col(text_col)) == F.col(code))
        & F.length(F.col(text_col)).eqNullSafe(F.col(length))
    )
    return docs.join(bad, same, "left_anti")


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the words in ``spans`` and the gaps that follow them; null stays null."""
    parts = F.regexp_extract_all(text, F.lit(f"{WORD}(?:{GAP})?"), F.lit(0))
    head = F.regexp_extract(text, f"^(?:{GAP})?", 0)
    kept = F.filter(
        parts,
        lambda _, i: ~F.exists(spans, lambda s: (i + 1 >= s["p"]) & (i + 1 < s["e"])),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(head, F.array_join(kept, "")))
