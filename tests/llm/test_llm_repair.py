"""Repair of conversations, shards and whitened vectors against plain versions."""

import hashlib
import random
import zlib
from itertools import product

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from salesloom.llm import repair, sharding, whitening
from salesloom.llm.queries import ORACLE, QUERIES

TURNS = "conv_id bigint, turn bigint, role string, text string, slot string, key string"
DOCS = "doc_id bigint, text string, shard string, number string, row string, place string"


def cheapest(rows):
    """(cost, edits, lines) of a conversation by whole strings from the end on; ``rows`` holds
    (role, text, fault)."""
    go = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    worst = (10**9, "", [])

    def inserted(best):
        out = list(best)
        for _ in range(3):
            for s in range(4):
                role, t = ("assistant", 3) if s == 2 else ("user", 2)
                way = (5 + out[t][0], "I" + out[t][1], [f"{role}:", *out[t][2]])
                out[s] = min(out[s], way)
        return out

    best = inserted([(0, "", []), worst, worst, (0, "", [])])
    for role, text, fault in reversed(rows):
        now = []
        for s in range(4):
            ways = [(2 + best[s][0], "D" + best[s][1], best[s][2])]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for cost, name, new in [(0, "K", role), (1, "R", "user"), (1, "R", "assistant")]:
                    if (new[:1], s) in go:
                        c, a, r = best[go[new[:1], s]]
                        ways.append((cost + extra + c, name + a, [f"{new}:{text}", *r]))
            now.append(min(ways))
        best = inserted(now)
    return best[0]


def test_moves_match_whole_strings():
    rng = random.Random(4)
    roles, faults = ["system", "user", "assistant", "tool"], [None, "truncated", "blank"]
    short = [list(p) for n in range(4) for p in product(product(roles, faults), repeat=n)]
    long = [[(rng.choice(roles[:3]), rng.choice([None] * 6 + faults)) for _ in range(rng.randint(4, 60))] for _ in range(300)]
    for case in [*rng.sample(short, 400), *long]:
        rows = [(role, "x", fault) for role, fault in case]
        run = "".join(
            str(repair.GONE if f == "blank" else roles.index(r) + (4 if f == "truncated" else 0)) for r, f in case
        )
        edits, state = repair.trace(run, 0, 0)
        audit = ("".join(edits) + repair._end_move(state)).translate(str.maketrans(repair.TRACED, repair.AUDIT))
        assert audit == cheapest(rows)[1]


def test_blocks_step_like_symbols():
    known = repair.tables()
    run = "".join(random.Random(2).choice("012345678") for _ in range(101))
    for vector in range(len(known["vectors"])):
        at = vector
        for symbol in run[::-1]:
            at = known["step"][at, int(symbol)]
        assert repair.vectors_before(run)[vector] == at


def own_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def own_summary(rows):
    def order(r):
        _, turn, role, text = r
        digests = [hashlib.md5(x.encode()).hexdigest() for x in (role, text)]
        return turn is not None, turn or 0, role[:64], digests[0], text[:64], digests[1]

    rows, seen, known = sorted(rows, key=order), set(), []
    for _, _, role, text in rows:
        kept = text.strip(" \t\n\x0b\x0c\r")
        fault = None
        if not kept:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif kept[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        known.append((role, text, fault))
    turns = {r[1] for r in rows if r[1] is not None}
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(known, known[1:]))
    cost, audit, lines = cheapest(known)
    count = [sum(f == x for *_, f in known) for x in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(9)
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "", None, " \n", "so it is?  ", "x" * 70 + rng.choice("ab"), f"t{turn}!"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    rows += [(40, 0, "user", "word " * 100_000 + "."), (40, 1, "assistant", "word " * 100_000)]
    # A long conversation with many copies of one row.
    rows += [(41, t, "ua"[t % 2] + "x", f"{t % 17}.") for t in range(300)] + [(41, None, "user", "same.")] * 200
    return [(*r, "s", "k") for r in rows]


def test_repair_matches_plain_version(spark, odd_turns):
    table = spark.createDataFrame(odd_turns, TURNS)
    got = repair.summaries(repair.damaged(table), table.select("conv_id").distinct()).collect()
    assert len(got) == 15
    broken = own_damage(odd_turns)
    for row in got:
        conv, *figures = row
        assert tuple(figures) == own_summary([r for r in broken if r[0] == conv])


def test_runs_of_any_length_chain_alike(spark, odd_turns):
    turns = repair.arranged(spark.createDataFrame(odd_turns, TURNS))
    marked = repair.symbols(turns)

    def edits(bits, run_bits):
        runs = repair.edited_runs(marked.withColumn("at", F.shiftright("slot", run_bits)), bits)
        return {
            r.key: "".join("".join(p) for _, p in sorted(r.parts))
            for r in runs.groupBy("key").agg(F.collect_list(F.struct("at", "edits")).alias("parts")).collect()
        }

    assert edits(1, 2) == edits(12, 12) == edits(2, 0)


def test_repaired_rows_read_back(spark, odd_turns):
    rows = repair.repaired(spark.createDataFrame(odd_turns, TURNS))
    left = rows.where("edit != 'D' AND conv_id = 41").orderBy("slot", "behind", "step").collect()
    assert [r.role[0] for r in left] == ["u", "a"] * (len(left) // 2)
    assert all(r.text == "" and r.turn is None for r in rows.where("edit = 'I'").collect())
    assert rows.where("edit != 'I'").count() == len(odd_turns)


def test_repair_of_nothing(spark, odd_turns):
    table = spark.createDataFrame([], TURNS)
    assert repair.summaries(repair.damaged(table), table.select("conv_id").distinct()).count() == 0
    ids = spark.createDataFrame([(1,), (None,)], "conv_id bigint")
    got = repair.summaries(table, ids).collect()
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert {tuple(r) for r in got} == {(1, *empty), (None, *empty)}
    assert repair.repaired(table).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000, 4097])
def test_permutation_and_its_inverse(spark, n):
    walk, back = sharding.longest_walk(spark, n), sharding.longest_walk(spark, n, backward=True)
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, walk).alias("p"))
    rows = rows.withColumn("q", sharding.permuted(F.col("p"), n, back, backward=True)).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.q == r.id for r in rows)


@pytest.fixture(scope="module")
def odd_docs():
    texts = ["same"] * 40 + [None, "", "é", "long " * 200_000] + [f"t{i}" for i in range(60)]
    rows = [(i % 50 if i > 60 else i, t) for i, t in enumerate(texts)] + [(None, "z"), (None, "z"), (3, "same")]
    return [(*r, "a", "b", "c", "d") for r in rows]


def test_shards_of_odd_rows(spark, odd_docs):
    docs = spark.createDataFrame(odd_docs, DOCS)
    got = sharding.shard_documents(docs).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_docs), key=repr
    )
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(found == list(range(len(found))) for found in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_documents(docs.repartition(13).orderBy(F.rand(1))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_sharded_rows_keep_their_columns(spark, odd_docs, tmp_path):
    docs = spark.createDataFrame(odd_docs, DOCS)
    placed = sharding.shuffled(docs, [F.col("doc_id"), F.col("text")], shards=3)
    assert placed.columns == ["doc_id", "text", "row", "place", "number", "shard", "slot"]
    n = len(odd_docs)
    back = sharding.longest_walk(spark, n, backward=True)
    found = placed.withColumn("again", sharding.row_number_at(F.col("shard"), F.col("slot"), n, back, 3))
    assert found.where("again <> number").count() == 0
    sharding.write_shards(placed, str(tmp_path / "out"), slots_per_file=10)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == n and {r.row for r in stored.select("row").collect()} == {"c"}


def test_sharding_stays_native(spark):
    plan = QUERIES["op12_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def own_whitening(rows, k=16):
    def fits(v):
        return v is not None and all(c is not None and np.isfinite(c) for c in v)

    kept = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows if fits(v)]
    x = np.unique([v for _, v in kept], axis=0)
    n, s = len(x), [int(c) for c in x.sum(axis=0)]
    z = x - np.mean(x, axis=0)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for i, v in kept:
        deviation = sum((n * c - t) ** 2 for c, t in zip(v, s))
        for j in range(min(k, len(s))):
            w = float((np.array(v) - np.array(s) / n) @ axes[:, j] / np.sqrt(values[j]))
            out.append((i, j + 1, n, deviation, w, float(values[j] / values.sum())))
    return out


def test_whitening_matches_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    mixed = rng.standard_normal((400, 24)) * np.linspace(3, 0.5, 24) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), *[(900 + i, rows[7][1]) for i in range(150)]]
    odd = [(1, None), (2, [None] + [0.0] * 23), (3, [float("nan")] * 24), (4, [float("inf")] * 24)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id bigint, embedding array<double>, x string, n int")
    got = whitening.whiten(table).collect()
    want = own_whitening(rows)
    found = sorted(
        (str(r.vec_id), j + 1, r.n, r.deviation, abs(w), e) for r in got for j, (w, e) in enumerate(zip(r.whitened, r.explained))
    )
    want = sorted((str(i), j, n, d, abs(w), e) for i, j, n, d, w, e in want)
    assert [f[:4] for f in found] == [w[:4] for w in want]
    assert np.allclose([f[4:] for f in found], [w[4:] for w in want], rtol=1e-9, atol=1e-9)
    assert {r.identity_error < 1e-9 for r in got} == {True}


def test_whitening_of_odd_tables(spark):
    kind = "vec_id bigint, embedding array<float>"
    rows = [(1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, []), (4, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (6, [1e30, 0.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, kind)).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert [len(got[i].whitened) for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert (got[1].n, got[4].n, got[3].n, got[4].deviation) == (2, 1, 0, 0)
    assert [abs(got[1].whitened[0]), *got[1].explained] == pytest.approx([1, 1])
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0


def test_axes_of_equal_and_close_eigenvalues():
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    for values in ([5.0] * 20 + [1.0] * 70, [1 + 1e-3 * i for i in range(90)], [2.0 ** -i for i in range(90)]):
        matrix = turn @ np.diag(values) @ turn.T
        found, axes = whitening.jacobi_davidson(lambda p: matrix @ p, 90, 16)
        assert np.allclose(found, sorted(values)[::-1][:16], rtol=0, atol=1e-12 * max(values))
        assert np.linalg.norm(matrix @ axes - axes * found, axis=0).max() < 1e-12 * max(values)


@pytest.mark.parametrize("name", ["op11_repair", "op12_sharding"])
def test_new_queries_match_sql_at_size(spark, name):
    base = "/root/testdata/sf0.01"
    assert spark_rows(QUERIES[name](spark, base)) == duck_rows(connect(base), ORACLE[name])
