"""Quality by importance resampling: hashed n-gram models of good and of all text.

Two generative models count hashed one- and two-token features, one over labelled good documents
and one over the whole corpus. A document's weight is the ratio of their likelihoods, taken at a
common length. Gumbel noise on the log weight and a top-k make a weighted sample without
replacement, of as many documents as look like the good ones.
"""

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import scratch
from salesloom.llm.batches import small_batches
from salesloom.operators.keys import with_surrogate_key

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
# A run of letters and digits, or a run of signs.
TOKEN = regex.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_AGAIN = np.uint64(0xABCDEF0123456789)


def features(text: bytes | None) -> np.ndarray:
    """Buckets of all tokens and of all pairs of neighbours; a repeated token is one kind of pair."""
    tokens = TOKEN.findall(text or b"")
    if not tokens:
        return np.empty(0, np.int64)
    single = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens)) * _ONE
    left, right = single[:-1], single[1:]
    pair = np.where(left == right, _AGAIN, left * _TWO + right * _ONE)
    return (np.concatenate([single, pair]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count(docs: DataFrame) -> np.ndarray:
    """Feature counts ``[all, good]`` of ``docs(text, good)``; one row per bucket reaches the driver."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"]):
                found = features(text)
                if len(found) < BUCKETS // 4:
                    np.add.at(counts[0], found, 1)
                    if good:
                        np.add.at(counts[1], found, 1)
                else:
                    found = np.bincount(found, minlength=BUCKETS)
                    counts[0] += found
                    counts[1] += found * bool(good)
        at = np.flatnonzero(counts[0])
        yield pd.DataFrame({"bucket": at, "n": counts[0][at], "good": counts[1][at]})

    parts = docs.mapInPandas(tally, "bucket bigint, n bigint, good bigint")
    total = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toPandas()
    out = np.zeros((2, BUCKETS))
    out[:, total["bucket"]] = total["n"], total["good"]
    return out


def log_ratios(counts: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """Log of good over raw probability for each bucket; the good model is drawn to the raw one."""
    raw, good = counts
    p = (raw + prior) / (raw.sum() + prior * BUCKETS)
    q = (good + prior * BUCKETS * p) / (good.sum() + prior * BUCKETS)
    return np.log(q / p)


def log_weight(ratios: np.ndarray, text: Column, length: int = 300) -> Column:
    """Mean log ratio of a text's features times ``length``; null for a text without tokens."""
    table = ratios.astype(np.float64).tobytes()

    @F.pandas_udf(T.DoubleType())
    def of(texts: pd.Series) -> pd.Series:
        by_bucket = np.frombuffer(table)
        found = (features(t) for t in texts)
        return pd.Series([length * by_bucket[f].mean() if len(f) else None for f in found], dtype="float64")

    return of(text.cast("binary"))


class Sampler(NamedTuple):
    """What decides: a row stays if its noisy log weight is at least ``least``."""

    ratios: np.ndarray
    least: float
    seed: int

    def columns(self, id_col: Column, text: Column) -> dict[str, Column]:
        """``log_weight``, null for a text without tokens, and the row's Gumbel noise."""
        weight = log_weight(self.ratios, text)
        draw = F.pmod(F.xxhash64(id_col, text, F.lit(self.seed)), F.lit(1 << 52))
        uniform = (draw + F.lit(0.5)) / F.lit(float(1 << 52))
        return {"log_weight": weight, "gumbel": -F.log(-F.log(uniform))}


def _threshold(found: pd.DataFrame) -> float:
    """The log weight that best parts good from bad labelled rows.

    ``found(bin, good, bad)`` holds counts by rounded log weight. A lost share of good rows weighs
    twice a kept share of bad ones, and of equally good cuts one near the bad rows is taken. Without
    bad or good rows nothing is cut.
    """
    found = found.sort_values("bin", ignore_index=True)
    good, bad = found["good"].to_numpy(), found["bad"].to_numpy()
    if not bad.sum() or not good.sum():
        return -np.inf
    lost = np.append(0, good.cumsum()) / good.sum()
    kept = 1 - np.append(0, bad.cumsum()) / bad.sum()
    errors = 2 * lost + kept
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    edges = np.concatenate([[found["bin"].iloc[0] - 1], found["bin"], [found["bin"].iloc[-1] + 1]])
    low, high = edges[best[0]], edges[best[-1] + 1]
    return float(low + (high - low) / 4)


def sample_keys(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    good_docs: int = 20_000,
    seed: int = 11,
) -> tuple[DataFrame, Sampler]:
    """``(id, log_weight, sample_key)`` for every row of ``docs``, and what decides who stays.

    ``labels(doc_id, quality, toxic)``: a document is good if all its labels say quality 1 and none
    says toxic; null says nothing. The good model learns from at most ``good_docs`` of these, chosen
    by a hash of the id from one half of all ids; the raw model, all weights and k cover every row.
    k is the number of rows whose weight lies on the good side of the best cut between the labelled
    rows of the other half and those labelled bad; then the k largest noisy weights are taken, and
    rows that tie with the last of them.

    Without labels all weights are equal and everything stays. Null ids have no label. Texts
    without tokens have no weight and are never taken before others. Repeated rows share one draw.
    """
    small_batches(docs.sparkSession)
    judged = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(2))
    taught = (F.col("quality") == 1) & (half == 0)
    judged = judged.withColumn("taught", F.coalesce(taught, F.lit(False)))
    good = (
        judged.where("taught AND coalesce(toxic, 0) = 0")
        .select(F.col("doc_id").alias("id"))
        .orderBy(F.xxhash64("id", F.lit(seed)), "id")
        .limit(good_docs)
        .withColumn("good", F.lit(True))
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    flagged = rows.join(F.broadcast(good), "id", "left").select(
        F.col("text").cast("binary").alias("text"), F.coalesce("good", F.lit(False)).alias("good")
    )
    sampler = Sampler(log_ratios(_count(flagged)), -np.inf, seed)
    found = scratch.materialize(
        rows.withColumns(sampler.columns(F.col("id"), F.col("text"))).select(
            "id", "log_weight", (F.coalesce("log_weight", F.lit(-1e9)) + F.col("gumbel")).alias("sample_key")
        ),
        "weights",
    )
    binned = (
        found.join(judged.where("NOT taught").select(F.col("doc_id").alias("id"), "quality"), "id")
        .where("log_weight IS NOT NULL")
        .groupBy(F.round(F.greatest("log_weight", F.lit(-1000)) * 4).alias("bin"))
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    )
    cut = _threshold(binned.toPandas()) / 4
    k, total = found.agg(F.count_if(F.col("log_weight") >= cut), F.count("*")).first()
    if np.isinf(cut) or k >= total:
        return found, sampler
    ranked = with_surrogate_key(found.select("sample_key"), [F.desc("sample_key")], "place")
    last = ranked.where(F.col("place") == k).select("sample_key").first()
    return found, sampler._replace(least=last[0] if last else np.inf)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the sample takes, with all their columns. See :func:`sample_keys`.

    Weights are computed again where the texts lie, so no text is shuffled.
    """
    _, sampler = sample_keys(docs, labels, id_col, text_col, **options)
    parts = sampler.columns(F.col(id_col), F.col(text_col))
    key = F.coalesce(parts["log_weight"], F.lit(-1e9)) + parts["gumbel"]
    return docs.where(key >= F.lit(sampler.least))
