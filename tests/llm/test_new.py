"""The prefix trie, multi-index hashing and whitening, on small tables and against plain loops."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

TALK = "conv_id long, turn long, role string, text string, depth int, name string, path string"


def talks(seed=5):
    r = random.Random(seed)
    rows = []
    for c in list(range(0, 260, 3)) + [-7, -100, -101, 100, 200, 5_000_000_001]:
        for t in range(r.choice([0, 1, 2, 3, 5, 9])):
            rows.append([c, t, "ua"[t % 2], r.choice(["hi", "yes", "no", "", "é漢"])])
    rows += [[c, t, "u", f"t{t}"] for c in (7, 9, 11, 12) for t in range(12)]  # copies
    rows += [[300, None, "u", "first"], [300, 1, None, None], [300, 1, None, None], [300, 1, "a", "tie"], [300, 1, "a", "other"], [None, 1, "u", "no id"], [301, 0, "u", "x" * 9000]]
    rows += [[13, t, "u", "long"] for t in range(60)]
    return [(*x, 1, "n", "p") for x in rows]


def trie(rows, most=6, group=100):
    lists = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            lists.setdefault(c, []).append((turn is not None, turn or 0, role, name, text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in lists.items()}
    members, ends = {}, {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most
        path = own.get(c - (abs(c) % group) * (1 if c > 0 else -1), [])[:h] + v[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    out = Counter()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        children = sum(len(q) == len(p) + 1 for q in below)
        ids = ",".join(map(str, sorted(ends.get(p, []))))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children, len(leaves), saved, hashlib.sha256(ids.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("deep", "shallow", "ids"), [(200_000, 8, 4096), (100, 2, 1), (0, 0, 2)])
def test_trie(spark, monkeypatch, deep, shallow, ids):
    from busframe.llm import trie as t

    monkeypatch.setattr(t, "DEEP", deep)
    monkeypatch.setattr(t, "SHALLOW", shallow)
    monkeypatch.setattr(t, "_IDS", ids)
    rows = talks() if deep else [x for x in talks() if x[0] is None or x[0] < 60 and x[0] != 13]
    found = t.prefix_trie(spark.createDataFrame(rows, TALK).repartition(3))
    assert Counter(tuple(r) for r in found.collect()) == trie(rows)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_empty(spark):
    from busframe.llm.trie import prefix_trie

    assert prefix_trie(spark.createDataFrame([], TALK)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "u", "x", 1, "", "")], TALK)).count() == 0
    alone = prefix_trie(spark.createDataFrame([(4, 1, "u", "x", 1, "", "")], TALK)).collect()  # crc32("4") % 6 is over 0: nothing is left of it
    assert [tuple(r)[:7] for r in alone] == ([(4, 0, None, 1, 0, 1, 0)] if zlib.crc32(b"4") % 6 else [(4, 0, None, 1, 1, 1, 0), (4, 1, 4, 1, 0, 1, 0)])


def test_trie_many_copies(spark):
    """A list of ids over many blocks and tasks is one hash."""
    from busframe.llm.trie import peel
    from busframe.llm.common import Scratch

    n = 30_000
    turns = F.array(F.struct(F.lit(b"a" * 16).alias("name"), F.lit(3).alias("size")))
    rows = spark.range(n).select(F.col("id").alias("conv_id"), turns.alias("turns"))
    rows = rows.unionByName(rows.where("conv_id < 10").select((F.col("conv_id") + n).alias("conv_id"), F.array(F.struct(F.sha2(F.col("conv_id").cast("string"), 256).cast("binary").alias("name"), F.lit(1).alias("size"))).alias("turns")))
    nodes = {(r.depth, r.conv_id): r for r in peel(Scratch(spark, "test"), rows).collect()}
    top = nodes[1, 0]
    assert (top.n_convs, top.saved_tokens, top.ends_sha256) == (n, 3 * (n - 1), hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest())
    assert (nodes[0, 0].n_children, nodes[0, 0].n_convs, len(nodes)) == (11, n + 10, 12)


VECTORS = "vec_id long, embedding array<float>, code long, n int, rank int"


def nearest(rows, every, k):
    """Plain search over rows (id, vector), by row."""
    whole = [(i, np.array(v, "f4").astype("f8")) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = []
    for a, (i, q) in enumerate(whole):
        if i % every == 0:
            out.append((i, sorted((-float(q @ v), j) for b, (j, v) in enumerate(whole) if a != b and len(v) == len(q))[:k]))
    return out


def vectors(seed=1, n=600, d=32):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(20, d))
    rows = [(i, (middle[i % 20] + 0.6 * r.normal(size=d)).astype("f4").tolist()) for i in range(n)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)] + [(40, rows[40][1]), (60, rows[3][1])]  # copies; repeated ids
    return rows + [(2000, None), (2020, []), (2040, [0.0] * d), (2060, [float("nan")] * d), (2080, [None] * d), (None, rows[0][1]), (2100, [1.0, 2.0]), (2101, [0.5, 0.0]), (2120, [-0.0, 0.25])]


def test_hamming(spark):
    from busframe.llm import hamming

    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS).repartition(4)
    found = hamming.search(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = nearest(rows, 20, 20)
    assert len(found) == sum(len(x) for _, x in want)
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    exact = {}
    for i, v in rows:
        if v is not None and None not in v:
            exact.setdefault(i, []).append(np.array(v, "f8"))
    for i, best in want:
        got = Counter(x[1] for x in by[i])
        hit += sum((got & Counter(j for _, j in best)).values()) if sum(q == i for q, _ in want) == 1 else len(best)
        total += len(best)
    assert hit >= 0.9 * total
    for i, x in by.items():
        if sum(q == i for q, _ in want) == 1:
            x.sort()
            assert [y[0] for y in x] == list(range(1, len(x) + 1))
            assert [(-s, j) for _, j, s in x] == sorted((-s, j) for _, j, s in x)
            assert all(any(abs(float(q @ v) - s) < 1e-9 for q in exact[i] for v in exact[j] if len(v) == len(q)) for _, j, s in x)
    copies = sorted(by[1000])  # its own row is no candidate, its copies are, the least ids first
    assert [j for _, j, _ in copies[:20]] == [40, 40, *range(1001, 1019)]
    assert sum(r.query_id == 40 for r in found) == 40 and {r.vec_id for r in found if r.query_id == 40} >= {40, 1000}
    assert hamming.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    lone = spark.createDataFrame([(0, [1.0, 0.0], 1, 1, 1)], VECTORS)
    assert hamming.search(lone, F.col("vec_id") % 20 == 0).count() == 0


def test_hamming_blocks(spark, monkeypatch):
    """Cells cut into many blocks give the same rows; every code within the radius is found, and once."""
    from busframe.llm import hamming

    rows = [(i, v, 0, 0, 0) for i, v in vectors(2, 3000)]
    df = spark.createDataFrame(rows, VECTORS)
    monkeypatch.setattr(hamming, "POOL", 512)
    once = sorted(map(tuple, hamming.search(df, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(hamming, "_ROWS", 256)
    assert sorted(map(tuple, hamming.search(df, F.col("vec_id") % 20 == 0).collect())) == once
    r = np.random.default_rng(0)
    codes, asked = r.integers(0, 1 << 63, 3000).astype("u8"), r.integers(0, 1 << 63, 40).astype("u8")
    codes[:200] = asked[np.arange(200) % 40] ^ (np.uint64(1) << r.integers(0, 64, 200).astype("u8"))
    for radius in (0, 1, 2, 3, 9, 26, 64):
        got = Counter()
        for table in range(hamming.TABLES):
            for a, row, _ in hamming._found_in(table, codes, np.ones((3000, 1)), asked, np.ones((40, 1)), np.full(40, radius), np.full(40, -np.inf), 3000):
                got.update(zip(a.tolist(), row.tolist(), strict=True))
        assert got == Counter(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(asked[:, None] ^ codes[None, :]) <= radius)), strict=True))


def test_hamming_lengths(spark):
    """Vectors of any length: the largest product isn't the smallest angle."""
    from busframe.llm import hamming

    r = np.random.default_rng(3)
    v = r.normal(size=(2000, 24)) * r.lognormal(sigma=0.7, size=2000)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = hamming.search(df, F.col("vec_id") % 20 == 0, 10).collect()
    hit = 0
    for q in range(0, 2000, 20):
        s = v @ v[q]
        s[q] = -np.inf
        hit += len({*np.argsort(-s)[:10].tolist()} & {x.vec_id for x in found if x.query_id == q})
    assert len(found) == 1000 and hit >= 900


def covariance(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[sum((Fraction(r[i]) - Fraction(s[i], n)) * (Fraction(r[j]) - Fraction(s[j], n)) for r in x) / n for j in range(d)] for i in range(d)], s


@pytest.mark.parametrize("size", [1.0, 1e9, 1e13])
def test_whitening(spark, size):
    from busframe.llm.whitening import whiten

    r = np.random.default_rng(2)
    v = [(i, (size * (r.normal(size=5) * [3, 2, 1, 0.5, 0.1] + 7)).astype("f4").tolist()) for i in range(60)]
    v += [(100 + i, v[i][1]) for i in range(10)] + [(None, v[3][1]), (5, v[9][1]), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("inf")] * 5), (203, []), (204, [-0.0, 1.0]), (205, [0.5, -1.0])]
    df = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in v], "vec_id long, embedding array<float>, n int, component int, x int").repartition(3)
    out = whiten(df, 4).collect()
    scaled = [(i, tuple(int(np.floor(256 * np.float64(np.float32(c)))) for c in x)) for i, x in v if x and None not in x and np.isfinite(x).all()]
    five = sorted({x for _, x in scaled if len(x) == 5})
    cov, s = covariance(five)
    e, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    n, got = len(five), Counter()
    rows = {}
    for q in out:
        rows.setdefault((q.vec_id, q.deviation), {}).setdefault(q.component, []).append(q)
    for i, x in scaled:
        if len(x) != 5:
            continue
        deviation = sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))
        own = rows[i, deviation]
        got[i, deviation] += 1
        assert sorted(own) == [1, 2, 3, 4]
        y = np.array([float(Fraction(c) - Fraction(t, n)) for c, t in zip(x, s, strict=True)])
        for k in range(4):
            q = own[k + 1][0]
            assert q.n == n and abs(abs(q.whitened) - abs(y @ axes[:, 4 - k] / np.sqrt(e[4 - k]))) < 1e-6 and abs(q.explained - e[4 - k] / e.sum()) < 1e-6 * q.explained and q.identity_error < 1e-6
    assert sum(got.values()) == 72 and all(len(rows[key][1]) == n for key, n in got.items())
    two = [q for q in out if q.vec_id in (204, 205)]  # two vectors of two components: one of them varies
    assert len(out) == 72 * 4 + 4 and {(q.component, q.whitened is None, round(q.explained, 9)) for q in two} == {(1, False, 1.0), (2, True, 0.0)}


def test_whitening_few(spark):
    from busframe.llm.whitening import fit_sums, squares, whiten

    df = spark.createDataFrame([(1, [0.5, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whiten(df).collect()] == [(1, 0, None, 0.0, None)] * 2
    assert whiten(df.limit(0)).count() == 0
    y = np.array([[1, 2, 3], [-4, 5, 6]])
    want = y.T @ y
    got = squares(y)
    assert all((got[i, j] - got[i, i] - got[j, j]) == 2 * want[i, j] for i in range(3) for j in range(i + 1, 3))
    f = fit_sums(2, [0, 0], [0, 0], {(0, 0): 2, (1, 1): 8, (0, 1): 18})
    assert np.allclose(f.values, [5, 0]) and f.trace == 5
