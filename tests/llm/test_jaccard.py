import random
from collections import defaultdict

import pytest
from conftest import SF_CHECK
from llm_data import frame, prose

from stagewise.llm import jaccard


def brute_force(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
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
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def test_test_data(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, jaccard.op8_ngram_jaccard_join(spark, SF_CHECK).collect())) == brute_force(rows)


def _family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("often,few,share", [(64, 12, 0.002), (2, 12, 0.9), (2, 3, 0.05), (1, 1000, 0.9)])
def test_crowded_groups(spark, often, few, share):
    """Copies, near copies around the limit, a passage that a third of the
    texts share, and texts that are nothing but shared passages."""
    rng = random.Random(often * 31 + few)
    base, passage = prose(rng, 120), " ".join(prose(rng, 30))
    other = [" ".join(prose(rng, 12)) for _ in range(6)]
    texts = (_family(rng, base, 60, 6) + [" ".join(base)] * 25 + _family(rng, prose(rng, 50), 25, 3)
             + [passage + " " + " ".join(prose(rng, rng.randint(2, 60))) for _ in range(50)]
             + [" ".join(rng.sample(other, 4)) for _ in range(40)] + ["a b", "A  B", "a", None, "", " "])
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = jaccard.join(frame(spark, rows).repartition(3), often=often, few=few, share=share, bucket_shingles=1500)
    assert sorted(map(tuple, got.collect())) == brute_force(rows)


def test_long_chain_is_one_component(spark):
    rng = random.Random(3)
    words, rows = prose(rng, 100), []
    for d in range(40):
        rows.append((100 - d, " ".join(words)))
        words = words[4:] + prose(rng, 4)
    got = jaccard.join(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_force(rows)
    assert {r["component_id"] for r in got.collect()} == {61}


def test_links_found_later_join_the_components(spark):
    rng = random.Random(23)
    old, new = ([(a, b) for a, b in ((rng.randrange(90), rng.randrange(90)) for _ in range(40)) if a != b] for _ in "on")
    pairs = lambda rows: spark.createDataFrame(rows, "x long, y long")
    got = lambda df: sorted(map(tuple, df.select("node", "root").collect()))
    roots = jaccard.components(pairs(old))
    assert got(jaccard._merged(roots, pairs(new))) == got(jaccard.components(pairs(old + new)))
    assert jaccard._merged(roots, pairs([])) is roots
