"""The models against plain versions of themselves, and what they gain on rows they have not seen."""

import random
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from salesloom.llm import language, packing, quality, recurrent, scoring
from tokenizers import Tokenizer

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(n))


def plain_convolution(net, text):
    """Probabilities of a text, one filter, place and window at a time."""
    kernels = np.frombuffer(net.kernels, np.float32).reshape(-1, 256, net.filters).astype(float)
    bias = np.frombuffer(net.bias, np.float32).astype(float)
    dense = np.frombuffer(net.dense, np.float32).reshape(len(bias) + 1, -1).astype(float)
    total, weight = 0.0, 0
    for first in range(0, max(1, len(text)), language.WINDOW):
        seen = (text[first:] + bytes(language.WINDOW + language.REACH))[: language.WINDOW + language.REACH]
        pooled, at = [], 0
        for w in language.WIDTHS:
            for f in range(net.filters):
                places = range(language.WINDOW)
                pooled.append(max(sum(kernels[at + i, seen[p + i], f] for i in range(w)) for p in places))
            at += w
        logits = np.maximum(np.array(pooled) + bias, 0) @ dense[:-1] + dense[-1]
        chance = np.exp(logits - logits.max())
        size = min(language.WINDOW, len(text) - first)
        total, weight = total + size * chance / chance.sum(), weight + size
    return total / weight


def test_language_matches_plain_convolution(spark):
    rng = random.Random(3)
    kinds = ("abcde", "efghi", "ijklé")
    rows = [(i, words(rng, 50, k), k) for i, k in enumerate(kinds * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.fit(df, filters=3, steps=60)
    texts = ["a", "é", words(rng, 20, "abcdeé"), words(rng, 400, "efghij"), "x" * 256, "y" * 257, rows[0][1], rows[0][1]]
    asked = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r.p for r in asked.select(language.predict(net, F.col("text")).alias("p")).collect()]
    for text, found in zip(texts, got):
        want = plain_convolution(net, text.encode())
        assert found.score == pytest.approx(want.max(), abs=1e-4)
        assert want[net.languages.index(found.lang_pred)] == pytest.approx(want.max(), abs=1e-4)


def spark_hash(doc_id, seed):
    of_id = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=of_id)


def test_quality_matches_plain_version(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(0, 60), "abcdef" if i % 3 else "uvwxyz%")) for i in range(150)]
    rows += [rows[1], (300, None), (301, "  "), (302, "abc " * 3000)]
    labels = [(i, int(i % 3 > 0), int(i % 25 == 1)) for i in range(100)] + [(4, 0, None), (None, 1, 0), (7, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found, sampler = quality.sample_keys(docs, marks)

    judged = {}
    for i, good, toxic in labels:
        if i is not None:
            judged.setdefault(i, []).append((good, toxic or 0))
    judged = {i: (min(g for g, _ in x), max(t for _, t in x)) for i, x in judged.items()}
    taught = {i for i, (g, _) in judged.items() if g == 1 and spark_hash(i, 12) % 2 == 0}
    raw, good = Counter(), Counter()
    for i, t in rows:
        seen = quality.features((t or "").encode()).tolist()
        raw.update(seen)
        if i in taught and judged[i][1] == 0:
            good.update(seen)
    n, m, size = raw.total(), good.total(), quality.BUCKETS

    def ratio(bucket):
        p = (raw[bucket] + 1) / (n + size)
        return np.log((good[bucket] + size * p) / (m + size) / p)

    weights = {}
    for i, t in rows:
        seen = quality.features((t or "").encode()).tolist()
        weights[i] = 300 * np.mean([ratio(b) for b in seen]) if seen else None
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        want = weights[r.id]
        assert r.log_weight is None if want is None else r.log_weight == pytest.approx(want, abs=1e-8)

    def cost(cut):  # of taking labelled rows from this rounded weight on
        held = [(np.rint(weights[i] * 4), judged[i][0]) for i, _ in rows if i in judged and i not in taught and weights[i] is not None]
        goods, bads = [b for b, g in held if g == 1], [b for b, g in held if g == 0]
        return 2 * sum(b < cut for b in goods) / len(goods) + sum(b >= cut for b in bads) / len(bads)

    keys = sorted((r.sample_key for r in got), reverse=True)
    taken = sum(k >= sampler.least for k in keys)
    assert keys[taken - 1] == sampler.least
    heavy = sorted((w for w in (weights[i] for i, _ in rows) if w is not None), reverse=True)
    assert 0 < taken < len(rows)
    bins = {np.rint(w * 4) for w in heavy}
    # The sample is as large as the good side of a cut no other cut is better than.
    edge = (heavy[taken - 1] + heavy[min(taken, len(heavy) - 1)]) * 2
    assert cost(edge) == pytest.approx(min(map(cost, [*bins, max(bins) + 1])), abs=1e-9)


def test_scores_beat_counts_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = scoring.score(docs).where("held_out")
    row = held.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert row.s / row.n > row.b / row.n + 0.1
    assert held.where("score > base_score").count() > 0.9 * held.count()


def test_scoring_keeps_long_ids_beside_null(spark):
    rows = [(2**53 + 1, "a b"), (None, "a"), (2**53 + 1, "a b"), (5, None)]
    got = scoring.score(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=repr) == sorted(
        [(2**53 + 1, 3), (2**53 + 1, 3), (None, 2), (5, 1)], key=repr
    )


def test_stretches_start_where_the_document_stands():
    shape = recurrent.Shape(5, 3, 4, 2)
    rng = np.random.default_rng(5)
    w = {k: rng.normal(0, 0.7, s).astype(np.float32) for k, s in shape.sizes.items()}
    docs = [rng.integers(0, shape.symbols, n).astype(np.int32) for n in (1, 7, 8, 9, 16, 17, 40, 3)]
    found = recurrent.states_at(w, shape, docs, stretch=8, lanes=3, window=5)
    for doc, states in zip(docs, found):
        assert len(states) == -(-len(doc) // 8)
        for i, state in enumerate(states):
            alone = np.zeros((1, shape.hidden), np.float32)
            for symbol in doc[: 8 * i]:
                _, alone, _ = recurrent._run(w, np.array([[symbol]]), np.array([[False]]), alone, False)
            assert state == pytest.approx(alone[0], abs=1e-5)
    assert recurrent.states_at(w, shape, [], 8) == []


def test_stretches_learn_what_lies_before_them():
    # The symbol repeated to a document's end is its first one, far beyond one stretch.
    shape = recurrent.Shape(8, 2, 2, 1)
    docs = [np.full(60, s, np.int32) for s in (0, 3) for _ in range(8)]
    learner = recurrent.Learner(recurrent.fresh(shape, np.ones(shape.symbols)), shape)
    seen = []
    whole = learner._window

    def spy(x, real, last, state, entries):
        seen.extend(entry for _, entry in entries.values())
        return whole(x, real, last, state, entries)

    learner._window = spy
    for _ in range(20):
        learner.learn(docs, lanes=4, window=6, stretch=10)
    assert len(seen) and all(np.abs(e).max() > 0 for e in seen)
    assert recurrent.log_probabilities(learner.w, shape, docs).sum() > -0.5 * 60 * len(docs)


@pytest.mark.parametrize("marked", [True, False])
def test_units_encoded_together_equal_units_alone(marked):
    tokenizer = packing.WordTokenizer(VOCABULARY)
    if not marked:
        tokenizer.ends_unit[:] = False
    rng = random.Random(2)
    units = ["'s", ".", "é", "ß", "!!", "0", "a" * 300, *words(rng, 2500, "abcdeéñü").split()]
    sizes, ids = tokenizer._encoded_units(units)
    whole = Tokenizer.from_file(VOCABULARY)
    want = [whole.encode(u, add_special_tokens=False).ids for u in units]
    assert sizes.tolist() == list(map(len, want))
    assert ids.tolist() == [i for one in want for i in one]


@pytest.mark.parametrize("together", [1, 4, 1000])
def test_words_are_looked_up_for_many_texts_at_once(together):
    """A text's reading does not depend on the texts looked up with it."""
    shape = scoring.Shape(2, 1, 3, 2)
    known = {b"": 0, b"a": 1, b"bb": 2, b"cab": 3}
    logs, classes = np.log10([5.0, 4, 3, 2, 1]), np.array([0.5, 0.25])
    words = scoring.Vocabulary(known, np.array([0, 1, 2, 3, 0]), logs, {b"ab": 0}, classes, shape)
    texts = [b"A bb", None, b"cab a zab", b"", b"q q a", b"a"]
    found = list(words.read(texts, together))
    assert [r.symbols.tolist() for r in found] == [[1, 2, 0], [0], [3, 1, 3, 0], [0], [4, 4, 1, 0], [1, 0]]
    assert [r.left for r in found] == [[], [], [b"zab"], [], [b"q", b"q"], []]
    assert [r.known for r in found] == [3, 1, 3, 1, 2, 2]
    assert np.allclose([r.base for r in found], [logs[[1, 2, 0]].sum(), logs[0], logs[[3, 1, 0]].sum(), logs[0], logs[[1, 0]].sum(), logs[[1, 0]].sum()])
    assert np.allclose([r.rest for r in found], [0, 0, logs[3] - 2 * classes[0], 0, -2 * classes[1], 0])
