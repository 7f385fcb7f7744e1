"""Operators on documents against brute force, with the odd rows each has to bear."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesloom.llm import decontaminate, language, packing, quality, recurrent, scoring, simhash
from salesloom.llm.components import connected_components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, id string"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", 0, "x", "y") for i, t in rows], DOCS)


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def smallest(n, links):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def own_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    base = [prose(rng, 40) for _ in range(12)]
    near = [t.replace(" ", "  ", 2).upper() if i % 2 else t + " tail" for i, t in enumerate(base)]
    texts = [*base, *near, *base[:4], None, "", " \n", "ÉÀ éà", "one two", prose(rng, 30_000)]
    rows = list(enumerate(texts))
    return [*rows, rows[0], (None, base[1]), (None, None)]


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(0, i) for i in range(300, 420)]
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = smallest(420, edges)
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in ends}
    assert connected_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_limit", [1000, 1])
def test_simhash_matches_brute_force(spark, odd_rows, bucket_limit):
    got = simhash.near_duplicates(docs_of(spark, odd_rows), bucket_limit=bucket_limit).collect()
    prints = [own_fingerprint(t) for _, t in odd_rows]
    links = [(a, b) for a, b in combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    label = smallest(len(prints), links)
    least = {}
    for (i, _), c in zip(odd_rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = Counter((i, f, least.get(c)) for (i, _), f, c in zip(odd_rows, prints, label))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component) for r in got) == want


@pytest.mark.parametrize("bucket_limit", [1, 1000])
def test_signatures_are_never_broadcast(spark, tmp_path, bucket_limit):
    """An exploded index is estimated at the size of its fingerprints, which is far too low."""
    spark.range(40).select((F.col("id") * 3).alias("fp")).write.parquet(str(tmp_path / "fps"))
    links = simhash.fingerprint_links(spark.read.parquet(str(tmp_path / "fps")), bucket_limit=bucket_limit)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan
    near = [(a, b) for a, b in combinations(range(40), 2) if (3 * a ^ 3 * b).bit_count() <= 2]
    label = smallest(40, near)
    want = {(3 * i, 3 * c) for i, c in enumerate(label) if label.count(c) > 1}
    assert {tuple(r) for r in connected_components(links).collect()} == want


def test_long_key_lists_are_never_broadcast(spark):
    docs, keys = spark.range(100), spark.range(50).select(F.col("id").alias("at"))
    kept = docs.join(simhash._sized(keys, rows=49), docs["id"] == keys["at"], "left_anti")
    assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 50


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(docs_of(spark, [])).count() == 0


def test_dissimilar_texts_stay(spark):
    rng = random.Random(3)
    head = prose(rng, 60)
    rows = [(i, head + " " + prose(rng, 60)) for i in range(8)]
    assert simhash.drop_near_duplicates(docs_of(spark, rows)).count() == 8


def test_near_copies_match_brute_force(spark):
    """Which rows stay, against all pairs of fingerprints; columns have names used inside."""
    rng = random.Random(21)
    texts = []
    for _ in range(30):
        words = prose(rng, rng.choice([5, 40, 200, 900])).split()
        for change in (0, 0, 1, 2, 5):
            copy = list(words)
            for _ in range(change):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(99)}"
            texts.append(" ".join(copy))
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[0]), (None, None), (900, "")]
    prints = [own_fingerprint(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    label = smallest(len(rows), links)
    least = {}
    for (i, _), c in zip(rows, label):
        least[c] = min(least.get(c, 10**9), 10**9 if i is None else i)
    df = docs_of(spark, rows)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("key", "_id", "_key", "_found", "_hash", "first", "root")])
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())


def own_hits(docs, items, size=10):
    import re

    def split(t):
        t = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    grams = {}
    for i, t in items:
        w = split(t)
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[p : p + n]), set()).update(() if i is None else {str(i)})
    out = []
    for i, t in docs:
        w, hit, held = split(t), set(), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    held |= grams[tuple(w[p : p + n])]
        out.append((i, len(w), len(hit), tuple(sorted(held))))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 500])
def test_decontamination_matches_brute_force(spark, block_bytes):
    rng = random.Random(2)
    items = [(i, prose(rng, n)) for i, n in enumerate((30, 12, 10, 9, 2, 1))] + [(7, None), (8, "!?"), (None, prose(rng, 15))]
    items.append((9, items[0][1]))
    texts = [None, "", "...", prose(rng, 50), items[0][1].upper().replace(" ", "--"), items[3][1]]
    texts += [prose(rng, 20) + " " + " ".join(items[0][1].split()[5:25]) + " x " + items[8][1], items[5][1]]
    docs = [*enumerate(texts), (4, texts[4]), (4, "other"), (None, texts[4])]
    df = docs_of(spark, docs)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    hits = decontaminate.benchmark_hits(df, bench, block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in hits.collect()]
    want = own_hits(docs, items)
    assert Counter(got) == Counter(want)
    left = decontaminate.remove_documents(df, hits)
    assert left.columns == df.columns
    assert Counter(r.text for r in left.collect()) == Counter(t for (_, t), w in zip(docs, want) if not w[2])


def test_decontamination_of_nothing(spark):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    row = decontaminate.benchmark_hits(docs_of(spark, [(1, "a b")]), empty).first()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])
    assert decontaminate.benchmark_hits(docs_of(spark, []), empty).count() == 0


def test_spans_are_cut(spark):
    df = spark.createDataFrame([("  A b, c! d é.", [(2, 4)]), ("a b", []), (None, [])], "text string, spans array<struct<p:int,e:int>>")
    got = [r.t for r in df.select(decontaminate.cut_spans(F.col("text"), F.col("spans")).alias("t")).collect()]
    assert got == ["  A d é.", "a b", None]


def test_decontamination_stays_native(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    plan = decontaminate.benchmark_hits(docs_of(spark, [(1, "a b")]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_whole_texts(tokenizer):
    rng = random.Random(4)
    letters = "aAbzéÉßΣσςİı'’.,!?&<|>endoftext 012٣Ⅷ²\n\t\r\x0b\x0c\x1c\x85\xa0中文🙂«»-_s'tvll"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "It's 'TIS I'LL", "", " ", "x" * 3000, "中" * 2000]
    mine = packing.WordTokenizer(tokenizer, room=500)
    whole = Tokenizer.from_file(tokenizer).encode_batch(texts, add_special_tokens=False)
    assert [a.tolist() for a in mine.encode([t.encode() for t in texts])] == [e.ids for e in whole]


def test_equal_ids_spread_over_groups(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, 0, 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, start bigint, length bigint")
    got = packing.pack(df, capacity=4096, group_pieces=100)
    assert got.columns == ["doc_id", "start", "length", "sequence_id", "offset"]
    found = got.collect()
    assert Counter((r.doc_id, r.start, r.length) for r in found) == Counter(rows)
    assert max(Counter(r.sequence_id >> 32 for r in found).values()) < 200
    spans = sorted((r.sequence_id, r.offset) for r in found)
    assert all(b[1] == a[1] + 50 if a[0] == b[0] else b[1] == 0 for a, b in zip(spans, spans[1:]))


def test_packing_keeps_every_token_once(spark, odd_rows, tokenizer):
    whole = Tokenizer.from_file(tokenizer)
    pieces = packing.pack(packing.tokenize(docs_of(spark, odd_rows), tokenizer, capacity=256), 256, 8).collect()
    got = Counter((r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in pieces)
    want = Counter()
    for i, t in odd_rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 256):
            part = ids[at : at + 256]
            want[i, at, len(part), part.tobytes(), len(ids)] += 1
    assert got == want
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(packing.tokenize(docs_of(spark, []), tokenizer)).count() == 0


def test_first_fit_decreasing_matches_plain_search():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 200):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room = []
        for i in np.argsort(-sizes, kind="stable"):
            at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            if at == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (at, 100 - room[at])
            room[at] -= sizes[i]


def own_language(rng, letters):
    return prose(rng, 60, letters)


def test_language_held_out(spark):
    rng = random.Random(8)
    kinds = {"aa": "abcde", "bb": "efghi", "cc": "ijklé"}
    rows = [(i, own_language(rng, kinds[k]), k) for i, k in enumerate(list(kinds) * 60)]
    rows += [(900, None, "aa"), (901, "12 ?!", "aa"), (902, "", None), (903, own_language(rng, "abcde") * 40, None), rows[0]]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id bigint, text string, lang string, score string")
    got = language.identify(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    known = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.lang_pred == r.lang for r in known) >= 0.95 * len(known)
    assert {r.lang_pred for r in language.identify(df.drop("lang").selectExpr("*", "string(null) AS lang")).collect()} == {"und"}
    assert language.identify(df.limit(0)).count() == 0


def test_language_ignores_other_columns(spark):
    rng = random.Random(8)
    rows = [(i, own_language(rng, k), k) for i, k in enumerate(["abcde", "fghij"] * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.fit(df)
    again = df.selectExpr("doc_id + 1000 AS doc_id", "text", "'zz' AS lang")
    again = again.withColumn("p", language.predict(net, F.col("text")))
    assert [r.p.lang_pred for r in again.orderBy("doc_id").collect()] == [k for _, _, k in rows]


def test_quality_takes_the_good(spark):
    rng = random.Random(6)
    good = [(i, prose(rng, 80)) for i in range(120)]
    bad = [(200 + i, " ".join(w + "%%" for w in prose(rng, 80).split())) for i in range(40)]
    rows = [*good, *bad, good[0], (400, None), (401, " "), (None, prose(rng, 50))]
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(200 + i, 0, 0) for i in range(0, 40, 2)] + [(5, None, None), (None, 1, 0)]
    df = docs_of(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = quality.resample(df, marks)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 2 and not {400, 401} & set(ids)
    assert sum(i is not None and i < 120 for i in ids) >= 110
    assert sum(i is not None and i >= 200 for i in ids) <= 4
    found, sampler = quality.sample_keys(df, marks)
    assert found.count() == len(rows)
    assert found.where(found.sample_key >= sampler.least).count() == len(ids)
    assert quality.resample(df, marks.limit(0)).count() == len(rows)
    assert quality.resample(df.limit(0), marks).count() == 0


def own_counts(rows):
    c = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            c.update([*(t or "").encode().lower().split(), b""])
    return c


@pytest.mark.parametrize("at_hand", [200_000, 20])
def test_scoring_base_is_exact(spark, odd_rows, at_hand):
    got = scoring.score(docs_of(spark, odd_rows), at_hand=at_hand, portion=2000).collect()
    c = own_counts(odd_rows)
    n, v = sum(c.values()), len(c)
    want = {}
    for i, t in odd_rows:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in words)
        want.setdefault((i, len(words), sum(w in c for w in words)), []).append(base)
    found = {}
    for r in got:
        assert r.train_tokens == n and r.score < 0
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        found.setdefault((r.doc_id, r.n_tokens, r.n_known), []).append(r.base_score)
    assert found.keys() == want.keys()
    for key, values in want.items():
        assert sorted(found[key]) == pytest.approx(sorted(values), rel=1e-9)
    assert scoring.score(docs_of(spark, [])).count() == 0


def test_network_is_a_distribution():
    shape = recurrent.Shape(5, 3, 4, 2)
    rng = np.random.default_rng(1)
    w = {k: rng.normal(0, 0.7, s).astype(np.float32) for k, s in shape.sizes.items()}
    head = np.array([3, 13, 7])
    every = [np.append(head, s) for s in range(shape.symbols)]
    total = np.exp(recurrent.log_probabilities(w, shape, every, lanes=3, window=2)).sum()
    assert total == pytest.approx(np.exp(recurrent.log_probabilities(w, shape, [head])[0]), rel=1e-4)
    alone = [recurrent.log_probabilities(w, shape, [d])[0] for d in every]
    assert recurrent.log_probabilities(w, shape, every, lanes=2, window=3) == pytest.approx(alone, rel=1e-4)


def test_network_gradients_point_down():
    shape = recurrent.Shape(6, 2, 4, 3)
    rng = np.random.default_rng(2)
    docs = [np.tile(rng.permutation(shape.symbols), 6)[: rng.integers(5, 60)] for _ in range(40)]
    learner = recurrent.Learner(recurrent.fresh(shape, np.ones(shape.symbols)), shape)
    before = recurrent.log_probabilities(learner.w, shape, docs).sum()
    for _ in range(30):
        learner.learn(docs, lanes=8)
    assert recurrent.log_probabilities(learner.w, shape, docs).sum() > 0.9 * before
