"""Language of a text by a byte convolutional network, trained in numpy.

Filters of several widths slide over the bytes of fixed-length windows; each filter's largest
response in a window feeds a softmax over the languages. A text's probabilities are those of its
windows, weighted by their bytes, so every byte of the text counts.
"""

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.batches import small_batches, unused_names

WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
WINDOW = 256
UNKNOWN = "und"


class Network(NamedTuple):
    """Weights as bytes, so that a worker can remember what it derives from them."""

    languages: tuple[str, ...]
    filters: int
    kernels: bytes  # sum(WIDTHS) x 256 x filters, float32
    bias: bytes  # len(WIDTHS) * filters, float32
    dense: bytes  # (len(WIDTHS) * filters + 1) x languages, float32


def cut_windows(text: bytes, window: int = WINDOW) -> np.ndarray:
    """The text in rows of ``window`` bytes and the next few, zero beyond its end."""
    n = max(1, -(-len(text) // window))
    padded = np.zeros(n * window + REACH, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, window + REACH)[::window]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    languages: tuple[str, ...],
    filters: int = 8,
    steps: int = 900,
    batch: int = 128,
    rate: float = 0.01,
    seed: int = 7,
) -> Network:
    """Fit on ``windows`` (rows of :func:`cut_windows`) by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    span = windows.shape[1] - REACH
    total = len(WIDTHS) * filters
    kernels = rng.normal(0, 0.1, (sum(WIDTHS), 256, filters))
    bias = np.zeros(total)
    dense = rng.normal(0, 0.1, (total + 1, len(languages)))
    weights = [kernels, bias, dense]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    rows = np.arange(batch)[:, None]
    # Each language is drawn as often as any other.
    members = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        y = rng.integers(0, len(languages), batch)
        pick = np.array([members[k][rng.integers(0, len(members[k]))] for k in y])
        x = windows[pick]
        pooled, places, at = [], [], 0
        for w in WIDTHS:
            response = sum(kernels[at + i][x[:, i : i + span]] for i in range(w))
            place = response.argmax(axis=1)
            places.append(place)
            pooled.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0])
            at += w
        raw = np.concatenate(pooled, axis=1) + bias
        active = np.concatenate([np.maximum(raw, 0), np.ones((batch, 1))], axis=1)
        slope = _softmax(active @ dense)
        slope[np.arange(batch), y] -= 1
        slope /= batch
        back = (slope @ dense[:-1].T) * (raw > 0)
        grown = np.zeros_like(kernels)
        at = 0
        for j, w in enumerate(WIDTHS):
            part = back[:, j * filters : (j + 1) * filters]
            for i in range(w):
                np.add.at(grown[at + i], (x[rows, places[j] + i], np.arange(filters)), part)
            at += w
        for k, (w, g) in enumerate(zip(weights, (grown, back.sum(axis=0), active.T @ slope))):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w -= (
                rate * min(1, 2 * (1 - step / steps) + 0.05)
                * (first[k] / (1 - 0.9**step))
                / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            )
    return Network(languages, filters, *(w.astype(np.float32).tobytes() for w in weights))


@lru_cache(maxsize=2)
def _tables(net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All filters' responses to each pair of bytes at offsets 0-1 and 2-3."""
    kernels = np.frombuffer(net.kernels, np.float32).reshape(sum(WIDTHS), 256, net.filters)
    near, far, at = [], [], 0
    nothing = np.zeros((256, net.filters), np.float32)
    for w in WIDTHS:
        k = [*kernels[at : at + w], nothing, nothing]
        near.append(k[0][:, None] + k[1][None, :])
        far.append(k[2][:, None] + k[3][None, :] if w > 2 else np.zeros_like(near[0]))
        at += w
    flat = [np.concatenate(t, axis=2).reshape(65536, -1) for t in (near, far)]
    bias = np.frombuffer(net.bias, np.float32)
    return *flat, bias, np.frombuffer(net.dense, np.float32).reshape(len(bias) + 1, -1)


def window_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    near, far, bias, dense = _tables(net)
    out = np.empty((len(windows), len(net.languages)), np.float32)
    span = windows.shape[1] - REACH
    for i in range(0, len(windows), 32):
        x = windows[i : i + 32].astype(np.int32)
        pairs = (x[:, :-1] << 8) | x[:, 1:]
        response = near[pairs[:, :span]]
        response += far[pairs[:, 2 : 2 + span]]
        pooled = np.maximum(response.max(axis=1) + bias, 0)
        out[i : i + 32] = _softmax(pooled @ dense[:-1] + dense[-1])
    return out


def _many(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``limit`` bytes together."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def predict(net: Network | None, text: Column) -> Column:
    """``struct(lang_pred, score)``: the likeliest language and its probability.

    ``und`` with score 0 for a text that is null or has no letter, and for every text if there was
    nothing to learn from.
    """
    schema = T.StructType(
        [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    @F.pandas_udf(schema)
    def of(texts: pd.Series) -> pd.DataFrame:
        lang = np.full(len(texts), UNKNOWN, object)
        score = np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if net is not None and has_letter(t)]
        data = [texts.iloc[i].encode("utf-8", "replace") for i in rows]
        for first, last in _many(data, 1 << 18):
            cut = [cut_windows(t) for t in data[first:last]]
            chances = window_probabilities(net, np.concatenate(cut))
            weight = np.concatenate(
                [np.minimum(WINDOW, len(t) - WINDOW * np.arange(len(c))) for t, c in zip(data[first:last], cut)]
            ).astype(np.float64)
            starts = np.cumsum([0, *map(len, cut)])[:-1]
            mean = np.add.reduceat(chances * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
            best = mean.argmax(axis=1)
            lang[rows[first:last]] = np.array(net.languages, object)[best]
            score[rows[first:last]] = np.clip(mean[np.arange(len(best)), best], 0, 1)
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return of(text)


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 1500,
    windows_per_doc: int = 6,
    **training,
) -> Network | None:
    """A network for the languages in ``docs``; None if no row has both a text and a language.

    Learns from a bounded sample: about ``docs_per_language`` rows of each language, chosen by a
    hash of the text, and ``windows_per_doc`` windows of each at most, spread over the whole text.
    Only these windows reach the driver, copies of a text with one label once.
    """
    small_batches(docs.sparkSession)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(
        *[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, docs_per_language / n))]
    )
    draw = F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 20)) / F.lit(1 << 20)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text in zip(batch["lang"], batch["text"]):
                if has_letter(text):
                    windows = cut_windows(text.encode("utf-8", "replace"))
                    step = max(1, -(-len(windows) // windows_per_doc))
                    out += [(lang, w.tobytes()) for w in windows[::step]]
            yield pd.DataFrame(out, columns=["lang", "piece"])

    drawn = known.where(draw < share[F.col("lang")]).dropDuplicates(["lang", "text"])
    found = drawn.mapInPandas(sample, "lang string, piece binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["lang", "piece"], ignore_index=True)
    languages = tuple(sorted(found["lang"].unique()))
    windows = np.frombuffer(b"".join(found["piece"]), np.uint8).reshape(len(found), -1)
    labels = found["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
    return train(windows, labels, languages, **training)


def held_out(id_col: Column) -> Column:
    """A fixed quarter of all ids, never learnt from; a null id is not in it."""
    part = F.crc32(id_col.cast("string").cast("binary")) % 4
    return F.coalesce(part == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learnt from the rows not held out.

    Predictions see the text alone. A text that is null, empty or has no letter is ``und`` with score
    zero, as are all texts if no row has both a text and a language. Long texts count in every window,
    weighted by its bytes. Repeated rows stay, each with the same answer; classes that tie go by name;
    a null id is learnt from. Columns of ``docs`` with these three names are replaced, all others stay.
    """
    base = docs.drop("held_out", "lang_pred", "score")
    net = fit(base.where(~held_out(F.col(id_col))), text_col, lang_col)
    (name,) = unused_names(base, "found")
    found = base.withColumns({"held_out": held_out(F.col(id_col)), name: predict(net, F.col(text_col))})
    return found.select("*", f"{name}.lang_pred", f"{name}.score").drop(name)
