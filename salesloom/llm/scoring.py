"""Log-likelihood of documents under a gated recurrent model trained on the corpus.

Word counts cover every training document. The network starts from a bounded sample on the driver,
then every training document is learnt from once: in each round the tasks take their documents from
the same weights, and the results are averaged, weighted by tokens. Scoring carries the state through
each whole document. Words too rare for the tasks to hold are looked up by a join with the counts.
Texts are split twice, to count words and to turn them into symbols; those are stored, and training
and scoring read them.
"""

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import scratch
from salesloom.llm import recurrent
from salesloom.llm.batches import small_batches
from salesloom.llm.recurrent import Shape

END = b""  # no word is empty
LN10 = float(np.log(10))
SHAPE = Shape(hidden=16, own=16, width=32, other=32)


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []


def held_out(id_col: Column) -> Column:
    """A fixed seventh of all ids, never learnt from; a null id is not in it."""
    part = F.crc32(id_col.cast("string").cast("binary")) % 7
    return F.coalesce(part == 2, F.lit(False))


def word_counts(texts: DataFrame, keep: int = 300_000) -> DataFrame:
    """``(word, c)`` over ``texts(text)``, each text with one end; tasks hold ``keep`` words at most."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(seen.keys()), "c": list(seen.values())})
            seen.clear()
            return out.astype({"c": "int64"})

        for batch in batches:
            for text in batch["text"]:
                seen.update(words_of(text))
                seen[END] += 1
                if len(seen) > keep:
                    yield flush()
        yield flush()

    return texts.mapInPandas(tally, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Reading(NamedTuple):
    symbols: np.ndarray
    base: float  # log10 of the known words' counts plus one
    known: int
    rest: float  # log10 of the shares within their class, but for the words left
    left: list[bytes]  # words whose count is not at hand


class Vocabulary(NamedTuple):
    place: dict[bytes, int]
    symbols: np.ndarray  # of each word at hand
    logs: np.ndarray  # log10 of count plus one
    endings: dict[bytes, int]  # class of a word by its last two bytes
    class_logs: np.ndarray  # log10 of each other class's total
    shape: Shape

    def read(self, texts: Iterable[bytes | None], together: int = 50_000) -> Iterator[Reading]:
        """A reading of each text; about ``together`` words are looked up at once."""
        words: list[bytes] = []
        ends: list[int] = []
        for text in texts:
            words += words_of(text)
            words.append(END)
            ends.append(len(words))
            if len(words) >= together:
                yield from self._read(words, ends)
                words, ends = [], []
        if ends:
            yield from self._read(words, ends)

    def _read(self, words: list[bytes], ends: list[int]) -> Iterator[Reading]:
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        symbols = self.symbols[at]
        missing = np.flatnonzero(at < 0)
        left = [words[i] for i in missing]
        last = self.shape.other - 1
        if left:
            symbols[missing] = self.shape.words + np.fromiter(
                (self.endings.get(w[-2:], last) for w in left), np.int64, len(left)
            )
        logs = self.logs[at]
        logs[missing] = 0
        other = symbols - self.shape.words
        rare = np.flatnonzero(other >= 0)
        shares = np.zeros(len(words))
        shares[rare] = logs[rare] - self.class_logs[other[rare]]
        starts = [0, *ends[:-1]]
        base, rest = np.add.reduceat(logs, starts).tolist(), np.add.reduceat(shares, starts).tolist()
        symbols = symbols.astype(np.int32)
        cuts = [0, *np.searchsorted(missing, ends).tolist()]
        for i, (start, end) in enumerate(zip(starts, ends)):
            lost = left[cuts[i] : cuts[i + 1]]
            yield Reading(symbols[start:end], base[i], end - start - len(lost), rest[i], lost)


class Corpus(NamedTuple):
    vocabulary: Vocabulary
    symbol_counts: np.ndarray
    tokens: int
    distinct: int
    documents: int


def _bin() -> Column:
    return F.floor(F.log2("c") * 4)


def read_corpus(counts: DataFrame, shape: Shape = SHAPE, at_hand: int = 200_000) -> Corpus:
    """What tasks need to know of ``counts(word, c)``: at most ``at_hand`` words by count, and totals
    by the words' last two bytes. Both are bounded whatever the corpus.
    """
    bins = counts.groupBy(_bin().alias("bin")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).toPandas()
    bins = bins.sort_values("bin", ascending=False)
    fits = bins.loc[bins["v"].cumsum() <= at_hand, "bin"]
    least = int(fits.min()) if len(fits) else 1 << 30
    top = counts.where((_bin() >= least) | (F.col("word") == F.lit(END))).toPandas()
    top["order"] = [w != END for w in top["word"]]
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["order", "c", "word"], ascending=[True, False, True], ignore_index=True)
    ends = counts.where(F.col("word") != F.lit(END)).groupBy(F.expr("substring(word, -2, 2)").alias("e"))
    ends = ends.agg(F.sum("c").alias("n"), F.count("*").alias("v")).toPandas()
    totals = {bytes(e): np.array([n, v]) for e, n, v in zip(ends["e"], ends["n"], ends["v"])}
    own = top.head(shape.words)
    for word, c in zip(own["word"], own["c"]):
        if word != END:
            totals[word[-2:]] = totals[word[-2:]] - (c, 1)
    common = sorted(totals, key=lambda e: (-totals[e][0], e))[: shape.other - 1]
    endings = {e: i for i, e in enumerate(common)}
    classes = np.zeros((shape.other, 2))
    for e, total in totals.items():
        classes[endings.get(e, shape.other - 1)] += total
    c = top["c"].to_numpy(np.float64)
    symbols = np.arange(len(top) + 1)
    for i in range(len(own), len(top)):
        symbols[i] = shape.words + endings.get(top["word"][i][-2:], shape.other - 1)
    vocabulary = Vocabulary(
        dict(zip(top["word"], range(len(top)))),
        symbols,
        np.append(np.log10(c + 1), 0.0),
        endings,
        np.log10(classes.sum(axis=1) + 1),
        shape,
    )
    by_symbol = np.zeros(shape.symbols)
    by_symbol[: len(own)] = own["c"]
    by_symbol[shape.words :] = classes[:, 0]
    documents = int(top.loc[~top["order"], "c"].sum())
    return Corpus(vocabulary, by_symbol, int(bins["n"].sum()), int(bins["v"].sum()), documents)


def _kept(symbols: np.ndarray, shape: Shape) -> bytes:
    return symbols.astype(_width(shape)).tobytes()


def _width(shape: Shape) -> np.dtype:
    return np.dtype("<u2" if shape.symbols <= 1 << 16 else "<u4")


def _portions(batches: Iterator[pd.DataFrame], shape: Shape, tokens: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Rows with their symbols, about ``tokens`` at a time, across batches."""
    rows, read, held = [], [], 0
    for batch in batches:
        first = 0
        for i, symbols in enumerate(batch["symbols"]):
            read.append(np.frombuffer(symbols, _width(shape)).astype(np.int32))
            held += len(read[-1])
            if held >= tokens:
                rows.append(batch.iloc[first : i + 1].drop(columns="symbols"))
                yield pd.concat(rows), read
                rows, read, held, first = [], [], 0, i + 1
        rows.append(batch.iloc[first:].drop(columns="symbols"))
    if read:
        yield pd.concat(rows), read


def train(
    texts: DataFrame,
    corpus: Corpus,
    rounds: int = 2,
    start_documents: int = 500,
    start_tokens: int = 8192,
    portion: int = 2_000_000,
) -> recurrent.Weights:
    """Weights learnt from ``texts(draw, symbols)``: on the driver from about ``start_documents`` of them,
    the first ``start_tokens`` symbols of each and equal rows once, then from all whole texts in
    ``rounds`` rounds, each text in one round. ``draw`` is a number from 0 to 1.
    """
    shape = corpus.vocabulary.shape
    learner = recurrent.Learner(recurrent.fresh(shape, corpus.symbol_counts), shape)

    width = _width(shape)
    drawn = texts.where(F.col("draw") < start_documents / max(1, corpus.documents)).dropDuplicates(["draw"])
    sample = drawn.select(F.substring("symbols", 1, start_tokens * width.itemsize).alias("s")).toPandas()
    docs = sorted((np.frombuffer(s, width).astype(np.int32) for s in sample["s"]), key=lambda d: d.tolist())
    for _ in range(2):
        learner.learn(docs, lanes=64)
    flat = recurrent.packed(learner.w, shape)

    for number in range(rounds):
        start = flat.astype(np.float32).tobytes()

        def learn(batches: Iterator[pd.DataFrame], start: bytes = start) -> Iterator[pd.DataFrame]:
            weights = recurrent.unpacked(np.frombuffer(start, np.float32), shape)
            own, tokens = recurrent.Learner(weights, shape, 0.005), 0
            for _, read in _portions(batches, shape, portion):
                own.learn(read, lanes=512)
                tokens += sum(map(len, read))
            if tokens:
                found = recurrent.packed(own.w, shape).astype(np.float64)
                yield pd.DataFrame({"i": np.arange(len(found)), "w": found * tokens, "n": tokens})

        turn = F.floor(F.col("draw") * 4096) % rounds == number
        parts = texts.where(turn).select("symbols").mapInPandas(learn, "i int, w double, n bigint")
        mean = parts.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).toPandas()
        if len(mean):
            flat = mean.sort_values("i")["w"].to_numpy()
    return recurrent.unpacked(flat, shape)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    at_hand: int = 200_000,
    portion: int = 2_000_000,
) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Tokens are the words and one end. ``base_score`` is the log10 probability under counts with one
    added, ``score`` under the network, which gives a word beyond its vocabulary the probability of
    the word's class times the word's share in it, again by counts with one added. Null texts are
    empty: an end alone. Null ids are learnt from. Repeated rows count as often as they occur; other
    columns are left out; without training rows the counts are zero.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    # Pandas turns whole numbers beside null into floats, so they travel as text.
    sent = F.col(id_col).cast("string") if isinstance(kind, T.IntegralType) else F.col(id_col)
    rows = docs.select(
        sent.alias("id"), held_out(F.col(id_col)).alias("held"), F.col(text_col).cast("binary").alias("text")
    )
    learnt = rows.where(~F.col("held"))
    counts = scratch.materialize(word_counts(learnt.select("text")), "counts")
    corpus = read_corpus(counts, at_hand=at_hand)
    shared = docs.sparkSession.sparkContext.broadcast(corpus.vocabulary)
    hashed = F.pmod(F.xxhash64("id", "text", F.lit("lm")), F.lit(1 << 40))
    draw = (hashed / F.lit(float(1 << 40))).alias("draw")
    shape = corpus.vocabulary.shape

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The written table holds one attempt of each task, so this tells its rows apart.
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            readings = list(shared.value.read(batch["text"]))
            left = [Counter(r.left) if r.left else {} for r in readings]
            yield batch.drop(columns="text").assign(
                row=row + np.arange(len(batch)),
                symbols=[_kept(r.symbols, shape) for r in readings],
                n_known=[r.known for r in readings],
                base=[r.base for r in readings],
                rest=[r.rest for r in readings],
                words=[list(c.keys()) for c in left],
                times=[list(c.values()) for c in left],
            )
            row += len(batch)

    id_type = rows.schema["id"].dataType.simpleString()
    stored = (
        f"id {id_type}, held boolean, draw double, row bigint, symbols binary, n_known bigint, base double, rest double,"
        " words array<binary>, times array<bigint>"
    )
    readings = scratch.materialize(rows.select("id", "held", draw, "text").mapInPandas(read, stored), "read")
    weights = train(readings.where(~F.col("held")).select("draw", "symbols"), corpus, portion=portion)
    packed = recurrent.packed(weights, shape).tobytes()
    unit = float(np.log10(corpus.tokens + corpus.distinct + 1))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = recurrent.unpacked(np.frombuffer(packed, np.float32), shape)
        for part, symbols in _portions(batches, shape, portion):
            found = recurrent.log_probabilities(w, shape, symbols) / LN10
            n = np.array([len(s) for s in symbols])
            yield part.drop(columns="rest").assign(n_tokens=n, base=part["base"] - n * unit, lm=found + part["rest"])

    schema = f"row bigint, id {id_type}, held boolean, n_known bigint, base double, n_tokens bigint, lm double"
    columns = ["row", "id", "held", "n_known", "base", "rest", "symbols"]
    scored = scratch.materialize(readings.select(*columns).mapInPandas(of, schema), "scored")
    asked = readings.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("t")
    )
    rare = (
        asked.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("t").alias("more"), F.sum(F.col("t") * F.log10(F.col("c") + 1)).alias("logs"))
    )
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        F.col("id").cast(kind).alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("lm") + logs).alias("score"),
    )
