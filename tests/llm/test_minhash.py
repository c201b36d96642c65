import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_data import frame, odd_rows, prose

from stagewise.llm import minhash


def brute_force(rows):
    """All pairs that share a shingle of four words; (doc_id, size, component, kept)."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for d, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for e in holders[x]:
                common[e] += e < d
        for e, k in common.items():
            if k and 100 * k >= 80 * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def test_test_data(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, minhash.op11_minhash_near_dedup(spark, SF_SMALL).collect())) == brute_force(rows)


def _family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_crowded_groups(spark, block):
    """Near copies on both sides of the limit, so that crowded keys stay open
    and are compared in blocks, copies, a shared passage, short texts."""
    rng = random.Random(block)
    passage = " ".join(prose(rng, 40))
    texts = (_family(rng, prose(rng, 150), 150, 12) + _family(rng, prose(rng, 30), 40, 3) + ["x y z " * 9] * 30
             + [passage + " " + " ".join(prose(rng, rng.randint(2, 30))) for _ in range(60)]
             + ["a b c", "A  B c", "a b", "a", None, "", " "])
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = sorted(map(tuple, minhash.near_duplicates(frame(spark, rows).repartition(3), block=block).collect()))
    assert got == brute_force(rows)
    assert len({c for _, _, c, _ in got}) < len(rows) - 100


def test_long_chain_is_one_component(spark):
    rng = random.Random(3)
    words, rows = prose(rng, 100), []
    for d in range(25):
        rows.append((100 - d, " ".join(words)))
        words = words[4:] + prose(rng, 4)
    got = sorted(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == brute_force(rows) and {c for _, _, c, _ in got} == {76}


def test_odd_rows_and_empty_table(spark):
    rows = [*odd_rows(), (5, "same text of six words here"), (12, "no id at all but words enough")]
    got = [tuple(r) for r in minhash.near_duplicates(frame(spark, rows)).collect()]
    by_id = defaultdict(list)
    for r in got:
        by_id[r[0]].append(r[1:])
    assert len(got) == len(rows)
    assert by_id[1] == by_id[2][:0] + [(0, 1, True)] and by_id[3] == [(0, 3, True)] and by_id[4] == [(1, 4, True)]
    assert by_id[5] == [(3, 5, True)] * 2 and by_id[6] == [(3, 5, False)]
    assert by_id[7][0][1:] == (7, True) and by_id[8][0][1:] == (7, False)
    assert by_id[None] == [(4, 12, False)] and by_id[12] == [(4, 12, True)]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 2**64, 500, dtype=np.uint64)])      # 3000 of 4500
    least = minhash.minima([np.sort(a), np.sort(b), a[:1]], *minhash.functions(2000))
    assert abs((least[0] == least[1]).mean() - 3000 / 4500) < 0.05
    keys = minhash.band_keys(least[:, :240], 48)
    assert keys.shape == (3, 48) and len(np.unique(keys[0])) == 48
    assert 0 < minhash.least_agreement(240, 80, 1e-9) < 192 and minhash.least_agreement(240, 100, 1e-9) == 240
