import hashlib
import math
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stagewise.llm import codes, negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row long, q int, r int, part string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "p") for r in rows], SCHEMA)


def sample(rng, n, dims=16):
    """Vectors around few centres, some repeated, with every kind of odd row."""
    centres = [[rng.gauss(0, .3) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.randrange(6)
        v = [x + rng.gauss(0, .15) for x in centres[c]] if rng.random() < .9 or not rows else rows[-1][1]
        rows.append((i, v, c if rng.random() < .8 else 0))          # label 0 is crowded
    rows = [(i, list(np.float32(v).tolist()), c) for i, v, c in rows]
    odd = [(n, None, 1), (n + 1, [None] + [0.1] * (dims - 1), 1), (n + 2, [math.nan] + [0.1] * (dims - 1), 1),
           (n + 3, [math.inf] + [0.1] * (dims - 1), 2), (n + 4, rows[0][1], None), (n + 5, rows[1][1][:dims // 2], 3)]
    return rows + odd


def kept(rows, scale):
    out = []
    for i, v, c in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(scale * x) for x in v], c))
    return out


def brute_negatives(rows, every=50):
    rows = [r for r in kept(rows, 256) if r[2] is not None and r[0] is not None]
    out = []
    for a, va, la in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, c) for i, v, c in rows if i != a)
        for s, i, _ in [x for x in scored if x[2] == la][:5]:
            p = -s
            hits = [(j, -t) for t, j, c in scored if c != la and 50 * p <= 100 * -t <= 95 * p][:3]
            out += [(a, i, k + 1, j, p, n) for k, (j, n) in enumerate(hits)]
    return sorted(out)


def test_negatives_against_brute_force(spark):
    rows = sample(random.Random(2), 400)
    for blocks in ({}, {"row_block": 50, "anchor_block": 3}):
        got = negatives.mine(table(spark, rows).repartition(3), **blocks)
        assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    got = negatives.mine(table(spark, rows), anchors="vec_id % 10 = 0", anchor_block=8)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10)


def test_negatives_repeated_rows_and_empty_tables(spark):
    v = [0.5] * 4
    rows = [(0, v, 1), (0, v, 1), (None, v, 1), (3, [0.4] * 4, 2), (4, None, 2)]
    got = sorted(map(tuple, negatives.mine(table(spark, rows)).collect()))
    assert got == [(0, 0, 1, 3, 65536, 4 * 128 * 102)] * 2        # each copy is the other's positive
    assert negatives.mine(table(spark, [])).count() == 0
    assert negatives.mine(table(spark, [(50, [], 1), (1, [], 1), (2, [], 2)])).collect()[0]["negative_score"] == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 150), st.integers(0, 26), st.integers(0, 2**32 - 1))
def test_residue_products_are_exact(dims, bits, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-2**bits, 2**bits, (n, dims), endpoint=True) for n in (5, 7))
    a[0], b[0] = 2**bits, -(2**bits)                              # the extremes
    bound = max(int((x.astype(object) ** 2).sum(1).max()) for x in (a, b))
    if bound < 2**56:
        assert (negatives.residue_products(a, b, negatives.primes_for(bound)) == a @ b.T).all()


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(kept(rows, 4096), key=lambda r: (r[0] is None, r[0], r[1]))
    dims = -(-max(len(v) for _, v, _ in rows) // parts) * parts
    width = dims // parts
    rows = [(i, v + [0] * (dims - len(v)), c) for i, v, c in rows]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for x in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [x[p] for x, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    coded = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), c) for (i, _, c), f in zip(rows, found)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {c: sum(r[2] for r in coded if r[3] == c) for c in {r[3] for r in coded}}
    return sorted(((i, k, e, sums[c], digest) for i, k, e, c in coded), key=str)


def run_codes(spark, rows, tmp_path):
    table(spark, rows).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, codes.op13_walsh_vector_codes(spark, str(tmp_path)).collect()), key=str)


def test_codes_against_brute_force(spark, tmp_path):
    rows = sample(random.Random(4), 300) + [(None, [0.2] * 16, None), (7, [0.25] * 16, 2)]
    assert run_codes(spark, rows, tmp_path) == brute_codes(rows)


def test_codes_of_few_equal_and_no_rows(spark, tmp_path):
    rows = [(5, [0.1] * 9, None), (5, [0.1] * 9, None), (6, [-0.3] * 9, 1)]
    assert run_codes(spark, rows, tmp_path / "few") == brute_codes(rows)
    assert run_codes(spark, [(1, None, 1)], tmp_path / "none") == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 20), st.sampled_from([2, 50, 2**24]), st.integers(0, 2**32 - 1))
def test_nearest_is_exact(dims, entries, most, seed):
    rng = np.random.default_rng(seed)
    x, c = (rng.integers(-most, most, (n, dims), endpoint=True) for n in (40, entries))
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    at, error = codes.nearest(x, c)
    assert (at == d.argmin(1)).all() and (error == d.min(1)).all()


def test_sequency_order():
    """Coefficient k of a pattern with k sign changes is the only one."""
    h = codes.walsh(np.eye(8, dtype=np.int64)).T                  # rows: the basis in sequency order
    assert [(np.diff(np.sign(r)) != 0).sum() for r in h] == list(range(8))
    assert (h @ h.T == 8 * np.eye(8)).all()


def test_matrix_pads_short_rows():
    column = pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int64()))
    assert vectors.matrix(column, 3).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]]
    assert vectors.matrix(column.slice(1), 2).tolist() == [[0, 0], [4, 0]]
