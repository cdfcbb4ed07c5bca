"""Sharding, the Merkle manifest and whitening, by brute force."""

from __future__ import annotations

import math
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.cases import ODD_IDS, ODD_TEXTS, documents, no_documents, odd_documents
from tests.oracle import compare, connect
from tierwell.llm import merkle, sharding, whitening
from tierwell.llm.prefix import running_sums

SMALL = "/root/testdata/sf0.001"


def test_running_sums(spark):
    rows = [(k, v) for k, v in zip([5, None, 3, 3, 9, 1, -4], [2, 10, 1, 1, 7, 4, 100], strict=True)]
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k long, v long, i int")
    got = {r["i"]: (r["a"], r["b"]) for r in running_sums(df.withColumn("one", df.v * 0 + 1), ["k", "i"], {"a": "v", "b": "one"}).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    want, total = {}, 0
    for place, i in enumerate(order):
        want[i] = (total, place)
        total += rows[i][1]
    assert got == want
    assert running_sums(df.limit(0), ["k"], {"a": "v"}).count() == 0


# -- sharding --------------------------------------------------------------------------------


def plain_shards(docs, shards):
    """(doc_id, size, crc) in order, each with shard and slot."""
    rows = sorted(
        ((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in docs),
        key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]),
    )
    total, before, out, slots = sum(r[2] for r in rows), 0, [], {}
    for i, crc, size in rows:
        shard = (2 * before + size) * shards // (2 * total)
        before += size
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, shard, slots[shard]))
    return out


CASES = {
    "odd": (ODD_IDS, ODD_TEXTS),
    "one text in a third of the rows": (list(range(90)), ["the same" if i % 3 == 0 else f"text {i}" * (i % 7) for i in range(90)]),
    "one id in all rows": ([7] * 40, [f"t{i}" for i in range(40)]),
    "no ids": ([None] * 30, ["x"] * 30),
    "one text larger than a shard": (list(range(20)), ["y" * 5000 if i == 9 else "z" for i in range(20)]),
    "fewer rows than shards": ([3, -1], [None, ""]),
}


@pytest.mark.parametrize("case", CASES)
def test_shards(spark, case):
    ids, texts = CASES[case]
    docs = documents(spark, texts, ids).repartition(3)
    placed = sharding.placements(docs)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["shard"], r["slot"], r["size"]) for r in placed.collect())
    want = sorted((i is not None, i or 0, crc, shard, slot, size) for i, size, crc, shard, slot in plain_shards(list(zip(ids, texts, strict=True)), 8))
    assert got == want
    assert placed.groupBy("shard").agg({"slot": "max", "*": "count"}).where("`max(slot)` + 1 <> `count(1)`").count() == 0


def test_shards_of_bytes_are_near_equal(spark):
    texts = ["word " * (i * 37 % 50) for i in range(400)]
    sizes = {r["shard"]: r["n"] for r in sharding.placements(documents(spark, texts)).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()}
    share, largest = sum(sizes.values()) / 8, max(len(t) + 1 for t in texts)
    assert sorted(sizes) == list(range(8)) and all(abs(n - share) < largest for n in sizes.values())


def test_written_shards_hold_whole_rows_in_order(spark, tmp_path):
    docs = odd_documents(spark).withColumnRenamed("body", "shard")  # a column of that name is there already
    path = sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    want = {(i, zlib.crc32((t or "").encode())): n for (i, t), n in zip(zip(ODD_IDS, ODD_TEXTS, strict=True), range(99), strict=False)}
    placed = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in sharding.placements(docs, 3).collect()}
    assert len(want) == len(placed)
    assert all(placed[r["doc_id"], zlib.crc32((r["text"] or "").encode())] == r["shard_"] for r in back.collect())


def test_shards_of_nothing(spark, tmp_path):
    assert sharding.digest(sharding.placements(no_documents(spark))).count() == 0
    rows, name = sharding.in_shards(no_documents(spark))
    assert rows.count() == 0 and name == "shard"


def test_sharding_shuffles_no_text_and_runs_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = sharding.in_shards(docs)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    plan = sharding.placements(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- Merkle manifest --------------------------------------------------------------------------


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_leaf(row, more=0):
    n = row["n_chars"]
    values = [row["doc_id"], row["source"], row["lang"], n + more if n is not None else None, row["text"]]
    return h(*(plain_field(v) for v in values))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([h(*own[i : i + 2]) for i in range(0, len(own), 2)])
    return levels


def climb(levels, slot, value):
    """(siblings from below, folded value) of a slot."""
    siblings = []
    for level in levels[:-1]:
        other = slot ^ 1
        sibling = level[other] if other < len(level) else ""
        siblings.append(sibling)
        value = h(sibling, value) if slot & 1 else h(value, sibling)
        slot >>= 1
    return siblings, value


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    order = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(by_lang[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[g] = own, plain_tree([plain_leaf(r) for r in own])
    top = plain_tree([trees[g][1][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        own, levels = trees[g]
        for slot, r in enumerate(own):
            chosen = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            below, value = climb(levels, slot, plain_leaf(r, 1 if chosen else 0))
            above, value = climb(top, k, value)
            out.append((r["doc_id"], plain_leaf(r), levels[-1][0], top[-1][0], h(*below, *above), value, value == top[-1][0]))
    return out


def check_manifest(docs, levels):
    found = merkle.manifest(docs, merkle.tampered(), siblings=True, levels=levels).collect()
    assert sorted(map(str, (tuple(r)[:7] for r in found))) == sorted(map(str, plain_manifest(docs.collect())))
    for r in found:
        assert merkle.fold(r["leaf"], r["siblings"]) == r["root"]
        assert r["verified"] == (r["folded_root"] == r["root"])


IDS = [*range(5), 63, 64, 65, 127, 128, 70000, 70001, 1 << 40, (1 << 63) - 1, -1, -64, -65, -(1 << 63)]
TREES = {
    "odd": (ODD_TEXTS, ODD_IDS, None),
    "ids far apart and below zero": ([f"t{i}" for i in range(len(IDS))], IDS, None),
    "languages": (["t"] * 23, list(range(23)), [["en", None, "", "fr", "é", "zz", "EN"][i * i % 7] for i in range(23)]),
    "one language in two thirds of the rows": (["t"] * 60, [i * 7 % 61 for i in range(60)], ["de" if i % 3 else f"l{i}" for i in range(60)]),
    "one id in half of the rows": ([f"t{i % 9}" for i in range(50)], [5 if i % 2 else i for i in range(50)], None),
    "no ids": (["same"] * 9, [None] * 9, None),
    "one row": (["a"], [1], None),
    "one row a language": (["a", "b"], [1, 2], ["x", "y"]),
    "eight": (["a"] * 8, list(range(8)), None),
    "nine": (["a"] * 9, list(range(9)), None),
}


@pytest.mark.parametrize("levels", [2, merkle.LEVELS])
@pytest.mark.parametrize("case", TREES)
def test_manifest(spark, case, levels):
    if levels == 2 and case in ("odd", "one row a language"):
        pytest.skip("covered by the others")
    check_manifest(documents(spark, *TREES[case]), levels)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(no_documents(spark), merkle.tampered()).count() == 0


def test_null_fields_are_leaves_too(spark):
    rows = [(None, None, None, None, None), (1, "x", None, None, 9223372036854775807), (7, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check_manifest(docs, merkle.LEVELS)


@pytest.mark.parametrize("name", ["op11_sharding", "op12_merkle_manifest"])
def test_sql(spark, name):
    ok, note = compare(spark, connect(SMALL), SMALL, name)
    assert ok, note


# -- whitening ---------------------------------------------------------------------------------


def plain_whitening(rows):
    """The exact fit: (n, sums, covariance as fractions) of the distinct vectors, and x of each row."""
    xs = [[math.floor(64 * float(np.float64(c))) + 1_000_000 for c in v] for v in rows]
    fit = [list(x) for x in {tuple(x) for x in xs}]
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n for j in range(d)] for i in range(d)]
    return xs, n, sums, np.array([[float(c) for c in row] for row in cov])


def check_whitening(spark, vectors, ids=None, kind="array<double>"):
    ids = ids or list(range(len(vectors)))
    frame = spark.createDataFrame([(i, [float(c) for c in v], "x") for i, v in zip(ids, vectors, strict=True)], f"vec_id long, embedding {kind}, x string")
    got = whitening.whiten(frame).collect()
    xs, n, sums, cov = plain_whitening(vectors)
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(16, len(values))
    assert len(got) == k * len(vectors)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    white = []
    for i, x in zip(ids, xs, strict=True):
        own = by_id[i]
        assert sorted(own) == list(range(1, k + 1))
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        assert {r["deviation"] for r in own.values()} == {deviation if deviation < 1 << 63 else None}
        assert {r["n"] for r in own.values()} == {n}
        white.append([own[c]["whitened"] for c in range(1, k + 1)])
        for c in range(1, k + 1):
            assert own[c]["explained"] == pytest.approx(max(values[c - 1], 0) / cov.trace(), rel=1e-9, abs=1e-12)
    first = {tuple(x): w for x, w in zip(xs, white, strict=True)}
    alive = [c for c in range(k) if values[c] > 1e-9 * values[0]]
    w = np.array([[row[c] for c in alive] for row in first.values()], dtype=float)
    assert np.allclose(w.T @ w / n, np.eye(len(alive)), atol=1e-6)
    # Each component is an eigenvector: rows times x's centred values give back its eigenvalue's direction.
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in first])
    back = centred.T @ w / n
    for column, c in zip(back.T, alive, strict=True):
        assert np.linalg.norm(column) == pytest.approx(math.sqrt(values[c]), rel=1e-6)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-4
    return got


def test_whitening(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 20)) @ rng.normal(size=(20, 20))
    # A third of all rows hold one vector; it counts once.
    check_whitening(spark, [vectors[0] if i % 3 == 0 else v for i, v in enumerate(vectors)])


@pytest.mark.parametrize("scale", [1e9, 1e14])
def test_whitening_of_long_numbers(spark, scale):
    rng = np.random.default_rng(6)
    check_whitening(spark, np.round(rng.normal(size=(30, 4)) * scale) / 64)


def test_whitening_without_variance_in_some_directions(spark):
    vectors = [[a, 2 * a, 0.0, b] for a in range(5) for b in (0, 1)]
    got = check_whitening(spark, vectors)
    assert {r["whitened"] is None for r in got if r["component"] in (3, 4)} == {True}


def test_unusable_vectors_are_left_out(spark):
    bad = [None, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0]]
    good = [[1.0, 2.0], [0.5, 0.25], [0.5], [], [1e300, 0.0]]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(bad + good)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert {r["vec_id"] for r in got} == {4, 5, 6, 7, 8} and {r["n"] for r in got} == {5}


def test_whitening_of_one_vector_and_of_none(spark):
    frame = spark.createDataFrame([(1, [0.5, 1.0]), (None, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(frame).collect()
    assert len(got) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got} == {(1, 0, None, None)}
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")).count() == 0


def test_square_sums_are_exact():
    rng = np.random.default_rng(7)
    for bits in (10, 31, 45, 61):
        z = rng.integers(-(1 << bits), 1 << bits, size=(50, 3))
        want = [sum(int(v) ** 2 for v in column) for column in z.T]
        assert whitening._square_sums(z) == want == whitening._square_sums(z.astype(object))
