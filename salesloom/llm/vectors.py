"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned to their principal axes, so the leading dimensions hold most of a product.
Vectors are laid out along the first axis in tiles; a pair of tiles is compared if their ranges are
close enough. Products are summed from the leading dimensions on, what is left is bounded by the
norms of the remaining parts, and a pair is given up when its cosine cannot reach the threshold.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm.components import connected_components
from salesloom.operators.keys import with_surrogate_key

SLACK = 1e-9  # more than products of unit vectors lose to rounding


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: pd.Series | np.ndarray) -> np.ndarray:
    raw = np.stack(vectors).astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)  # squares then neither overflow nor vanish
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each number of dimensions the axes as columns, the strongest first.

    ``vectors(v)``. Products are summed in the tasks and then by place in the matrix; what reaches
    the driver depends on the number of dimensions only.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len))["v"]:
                unit = _units(part)
                total[dim] = total.get(dim, 0) + unit.T @ unit
        for dim, m in total.items():
            yield pd.DataFrame({"dim": dim, "place": np.arange(dim * dim), "m": m.ravel()})

    parts = vectors.mapInPandas(moments, "dim int, place bigint, m double")
    found = parts.groupBy("dim", "place").agg(F.sum("m").alias("m")).toPandas()
    axes = {}
    for dim, part in found.groupby("dim"):
        matrix = part.sort_values("place")["m"].to_numpy().reshape(dim, dim)
        axes[int(dim)] = np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1]
    return axes


def _labels(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest connected place for each of ``n`` places, given those from earlier links."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs whose product reaches the threshold, by blocks of ``rows`` of ``x``.

    ``x`` and ``y`` are unit vectors on their principal axes. With ``same`` they are one tile, and
    each pair is found once.
    """
    dim = x.shape[1]
    cuts = sorted({0, *(min(dim, c) for c in (8, 24, 64, 192, 512)), dim})
    steps = list(zip(cuts, cuts[1:]))
    rest = [(np.linalg.norm(x[:, hi:], axis=1), np.linalg.norm(y[:, hi:], axis=1)) for _, hi in steps]
    for first in range(0, len(x), rows):
        block = x[first : first + rows]
        columns = y[first:] if same else y
        shift = first if same else 0
        total, pairs = np.zeros((len(block), len(columns))), None
        for (lo, hi), (rx, ry) in zip(steps, rest):
            if pairs is None:
                total += block[:, lo:hi] @ columns[:, lo:hi].T
                bound = total + rx[first : first + rows, None] * ry[None, shift:]
                alive = bound >= threshold - SLACK
                if alive.mean() < 0.05 or hi == dim:
                    a, b = np.nonzero(alive)
                    pairs, sums = (a + first, b + shift), total[a, b]
            else:
                a, b = pairs
                sums = sums + _products(x[:, lo:hi], y[:, lo:hi], a, b)
                alive = sums + rx[a] * ry[b] >= threshold - SLACK
                pairs, sums = (a[alive], b[alive]), sums[alive]
        a, b = pairs
        if same:
            a, b = a[a < b], b[a < b]
        yield a, b


def _products(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, run: int = 1 << 15) -> np.ndarray:
    parts = [np.einsum("ij,ij->i", x[a[i : i + run]], y[b[i : i + run]]) for i in range(0, len(a), run)]
    return np.concatenate([*parts, np.empty(0)])


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    tile: int = 2048,
) -> DataFrame:
    """``(id_col, n_links, component)`` for every row.

    ``n_links`` counts the other rows whose cosine with the row, in double precision, is
    ``threshold`` (above 0) or more; ``component`` is the smallest id reachable by such links,
    itself included. Vectors that are null, empty or zero or hold null or non-finite components link
    with nothing, nor do vectors of different length. Equal vectors are compared once and counted as
    often as they occur; a null id is never the smallest. Other columns are left out.

    Each tile pair gives one row per linked vector, with its number of links and what it hangs
    together with there, so no list of pairs is ever written. The driver holds the axes and two
    numbers per tile.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    usable = rows.where(_usable(F.col("v")))
    distinct = scratch.materialize(
        usable.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "distinct"
    )
    axes = principal_axes(distinct.select("v"))
    single = rows.where(~_usable(F.col("v"))).select(
        F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component")
    )
    if not axes:
        return single

    @F.pandas_udf("double")
    def leading(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors))
        for dim, part in vectors.groupby(vectors.map(len)):
            out[vectors.index.get_indexer(part.index)] = _units(part) @ axes[dim][:, 0]
        return pd.Series(out)

    laid = distinct.withColumns({"dim": F.size("v"), "lead": leading(F.col("v"))})
    laid = with_surrogate_key(laid, [F.col("dim"), F.col("lead"), F.col("v")], "node")
    laid = scratch.materialize(
        laid.withColumn("tile", F.floor((F.col("node") - 1) / F.lit(tile)).cast("int")), "laid"
    )
    # A tile with vectors of two lengths reaches from the smaller to the larger.
    span = F.struct(F.min(F.struct("dim", "lead")).alias("lo"), F.max(F.struct("dim", "lead")).alias("hi"))
    bounds = [r["s"] for r in laid.groupBy("tile").agg(span.alias("s")).orderBy("tile").collect()]
    gap = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    low = np.array([b["lo"]["dim"] * 8 + b["lo"]["lead"] for b in bounds])
    high = np.array([b["hi"]["dim"] * 8 + b["hi"]["lead"] for b in bounds])
    reach = np.searchsorted(low, high + gap, side="right") - 1
    back = np.searchsorted(high, low - gap, side="left")

    def of_tile(numbers: np.ndarray) -> Column:
        return F.get(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>"), F.col("tile"))

    ends = F.struct(of_tile(back).alias("back"), of_tile(reach).alias("reach"))
    placed = laid.withColumn("ends", ends)
    as_left = placed.select("*", F.explode(F.sequence("tile", "ends.reach")).alias("y")).withColumn("x", F.col("tile"))
    as_right = placed.where("ends.back < tile").select(
        "*", F.explode(F.sequence(F.col("ends.back"), F.col("tile") - 1)).alias("x")
    ).withColumn("y", F.col("tile"))
    columns = ["x", "y", "tile", "node", "copies", "dim", "v"]
    dealt = as_left.select(*columns).union(as_right.select(*columns))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        own = group["x"].iloc[0] == group["y"].iloc[0]
        for dim, part in group.groupby("dim"):
            part = part.sort_values(["tile", "node"], ignore_index=True)
            unit = _units(part["v"])
            turned = unit @ axes[int(dim)]
            n = len(part)
            left = n if own else int((part["tile"] == part["x"]).sum())
            shift = 0 if own else left
            weight = part["copies"].to_numpy()
            links, label = np.zeros(n, np.int64), np.arange(n)
            if left and (own or left < n):
                for a, b in linked_pairs(turned[:left], turned[shift:], threshold, own):
                    b = b + shift
                    exact = _products(unit, unit, a, b) >= threshold
                    a, b = a[exact], b[exact]
                    links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
                    label = _labels(n, a, b, label)
            at = np.flatnonzero(links)
            node = part["node"].to_numpy()
            out.append(pd.DataFrame({"node": node[at], "links": links[at], "root": node[label[at]]}))
        return pd.concat(out)

    found = scratch.materialize(
        dealt.groupBy("x", "y").applyInPandas(compare, "node bigint, links bigint, root bigint"), "links"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (
        laid.select("node", "v", "id", "copies")
        .join(counts, "node", "left")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = known.groupBy("component").agg(F.min("id").alias("smallest"))
    owner = known.join(smallest, "component").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("smallest").alias("component")
    )
    linked = usable.join(scratch.materialize(owner, "owners"), "v")
    return linked.select(F.col("id").alias(id_col), "n_links", "component").union(single)
