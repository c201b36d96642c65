"""Spaced seeds against a brute-force alignment and planted leaks."""

import random

from conftest import SF_CHECK
from llm_data import frame, prose
from pyspark.sql import functions as F

from stagewise.llm import decontamination


def brute_force(docs, items, span=13, similarity=0.8):
    """Pairs with an exact common run of ``span`` words (or the whole item)."""
    out = set()
    for i, item in items:
        v = item.lower().split()
        w = min(span, len(v))
        runs = {tuple(v[k:k + w]) for k in range(len(v) - w + 1)}
        for d, t in docs:
            u = (t or "").lower().split()
            if any(tuple(u[k:k + w]) in runs for k in range(len(u) - w + 1)):
                out.add((d, i))
    return out


def test_test_data(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.op5_spaced_seed_decontamination(spark, SF_CHECK).collect()}
    assert got >= brute_force(docs, items)
    flagged = {d for d, _ in got}
    assert len(flagged) <= 1.2 * len({d for d, _ in brute_force(docs, items)}) + 2


def test_substitutions(spark):
    rng = random.Random(11)
    items = [(i, " ".join(prose(rng, rng.randint(14, 60)))) for i in range(30)]
    rows, expected, clean = [], set(), set()
    for d in range(240):
        words = prose(rng, rng.randint(0, 120))
        i, item = items[d % 30]
        leak = item.split()
        if d % 3 == 0:                                        # every ninth word replaced
            for k in range(rng.randrange(9), len(leak), 9):
                leak[k] = "other"
            expected.add((d, i))
        elif d % 3 == 1:                                      # half of the words replaced
            leak = [w if k % 2 else "other" for k, w in enumerate(leak)]
        else:
            leak = []
        if d % 3:
            clean.add(d)
        at = rng.randint(0, len(words))
        rows.append((d, " ".join(words[:at] + [w.upper() for w in leak] + words[at:])))
    found = decontamination.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == expected
    texts = dict(rows)
    for (d, i), r in got.items():
        u, v = texts[d].lower().split(), dict(items)[i].split()
        run = u[r["first_word"]: r["first_word"] + r["run_words"]]
        best = max(sum(a == b for a, b in zip(run, v[k:])) for k in range(len(v) - r["run_words"] + 1))
        assert best == r["agreeing"] >= 0.8 * r["run_words"]
    kept = decontamination.without_leaks(frame(spark, rows), found)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == clean


def test_short_items_equal_brute_force(spark):
    """Items of 1 to 12 words, exact and with words replaced: exactly the
    documents of which some window agrees in 80 % of the item's places."""
    rng = random.Random(23)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 13)] + [(20, None), (21, " ")]
    rows = []
    for d in range(400):
        n = rng.randint(1, 12)
        leak = [f"i{n}w{k}" for k in range(n)]
        for k in rng.sample(range(n), rng.randint(0, min(3, n))):
            leak[k] = "other"
        before, after = (prose(rng, rng.randint(0, 15)) for _ in range(2))
        rows.append((d, " ".join(before + leak + after)))
    expected = set()
    for i, item in items:
        v = (item or "").split()
        for d, t in rows:
            u = t.split()
            if v and any(5 * sum(a == b for a, b in zip(u[k:], v)) >= 4 * len(v) for k in range(len(u) - len(v) + 1)):
                expected.add((d, i))
    found = decontamination.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected
    assert {i for _, i in expected} == set(range(1, 13))


def test_seeds_of_long_texts_carry_a_block_each(spark):
    """What a seed carries does not grow with the text that it stands in."""
    rng = random.Random(31)
    hashed = decontamination._hashes(frame(spark, [(1, " ".join(prose(rng, 60_000)))]), "doc_id", "text", "doc_id")
    placed = decontamination._placed(hashed, "doc_id", list(decontamination.MASKS))
    rows, most = placed.agg(F.count("*"), F.max(F.size("h"))).first()
    assert rows == sum(60_000 - len(m) + 1 for m in decontamination.MASKS)
    assert most <= 1_000


def test_long_item_in_a_long_text(spark):
    """A text of 60,000 words that holds an item of 6,000 (17,979 seeds that
    match): each is verified once, the first full run is reported."""
    rng = random.Random(37)
    item = [f"i{k}" for k in range(6_000)]
    words = prose(rng, 54_000)
    docs = frame(spark, [(1, " ".join(words[:40_001] + item + words[40_001:])), (2, " ".join(words))])
    found = decontamination.leaks(docs, spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()
    assert [tuple(r) for r in found] == [(1, 9, 40_001, 13, 13, sum(6_000 - len(m) + 1 for m in decontamination.MASKS))]


def test_leaks_at_every_place_of_a_block(spark):
    """Leaks that begin, end or lie anywhere around the ends of blocks, the
    first and last words of a text among them."""
    rng = random.Random(41)
    item, short = [f"i{k}" for k in range(20)], [f"s{k}" for k in range(8)]
    rows, expected = [], set()
    for d in range(2 * decontamination.BLOCK + 40):
        before, after = prose(rng, d), prose(rng, rng.choice((0, 0, 1, 12, 13, 300)))
        rows.append((d, " ".join(before + (short if d % 3 == 0 else item) + after)))
        whole = sum(20 - len(m) + 1 for m in decontamination.MASKS)
        expected.add((d, 2, d, 8, 8, 8) if d % 3 == 0 else (d, 1, d, 13, 13, whole))
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id long, text string")
    found = decontamination.leaks(frame(spark, rows), items)
    assert {tuple(r) for r in found.collect()} == expected


def test_no_python_in_the_plan(spark):
    plan = decontamination.op5_spaced_seed_decontamination(spark, SF_CHECK)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
