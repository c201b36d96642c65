"""Chunk dedup and sparse suffix array against brute force and planted passages."""

import random
import time
from pathlib import Path

import numpy as np
import pytest
from conftest import SF_CHECK
from llm_data import frame, prose

from stagewise.llm import runs, substrings, suffixes
from stagewise.llm.common import staged, windows_hash


def test_gear_hash_rolls():
    data = np.frombuffer(random.Random(1).randbytes(400), np.uint8)
    h, expected = 0, []
    for b in data.tolist():
        h = (2 * h + int(substrings.GEAR[b])) % 2**32
        expected.append(h)
    assert substrings.gear_hashes(data).tolist() == expected


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(2)
    text = " ".join(prose(rng, 800)).encode()
    for bodies in ([text, b"", b"x", text[:700]], [b"y" * 2000, "ä".encode() * 3000, ("日本 " * 900).encode()]):
        for body, ends in zip(bodies, substrings.chunk_ends(bodies, 2, 32, 512)):
            assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(body)
            sizes = np.diff([0, *ends])
            assert (sizes <= 512).all() and (sizes[:-1] >= 32).all()
            for a, b in zip([0, *ends], ends):
                body[a:b].decode()                           # no character is split
                assert b == len(body) or b - a >= 509 or body[b:b + 1].isspace()
    cut = lambda body: {body[a:b] for a, b in zip([0, *e], e)} if (e := substrings.chunk_ends([body], 2, 32, 512)[0]) else set()
    shifted = text[:100] + b"inserted" + text[100:]
    assert len(cut(text) & cut(shifted)) > 0.9 * len(cut(text))


def _planted(seed=4, n=40):
    rng = random.Random(seed)
    passages = [" ".join(prose(rng, k)) for k in (51, 55, 60, 80, 120)]
    rows, holders = [], {}
    for d in range(n):
        words = prose(rng, rng.randint(5, 200), 10**6)
        if d % 4 == 1:
            p = rng.randrange(len(passages))
            words.insert(rng.randrange(len(words)), passages[p])
            holders.setdefault(p, []).append(d)
        rows.append((d, " ".join(words)))
    rows += [(n, rows[0][1]), (n + 1, rows[1][1])]            # exact copies
    return rows, passages, holders


def test_chunk_dedup_finds_planted_passages(spark):
    rows, passages, holders = _planted()
    docs = frame(spark, rows)
    found = substrings.repeated_passages(docs)
    got = found.collect()
    later = {d for ds in holders.values() for d in ds[1:]} | {40, 41}
    if len(rows[0][1].split()) < 20:
        later.discard(40)
    assert {r["doc_id"] for r in got} == later
    texts = dict(rows)
    for r in got:                                            # what is cut stands in the document that keeps it
        part = texts[r["doc_id"]].encode()[r["start"]: r["start"] + r["size"]].decode()
        assert part in texts[r["first_doc_id"]] and len(part.split()) == r["words"]
    kept = {r["doc_id"]: r for r in substrings.without_passages(docs, found).collect()}
    assert set(texts) - set(kept) == {d for d in (40, 41) if d in later}
    for d, r in kept.items():
        assert (r["text"] == texts[d]) == (d not in later) and r["n_chars"] == len(r["text"]) and r["node"] == 3
    for p, text in enumerate(passages):                      # most of each passage stands once
        middle = " ".join(text.split()[18:-18])
        assert sum(middle in r["text"] for r in kept.values()) == (1 if p in holders else 0)


def test_cut_keeps_multibyte_text(spark):
    rng = random.Random(9)
    same = " ".join(f"ßü{w}日" for w in prose(rng, 60))
    docs = frame(spark, [(1, "Ä begin " + same + " ö end"), (2, "other É " + same + " tail ñ"), (3, None)])
    out = {r["doc_id"]: r["text"] for r in
           substrings.without_passages(docs, substrings.repeated_passages(docs)).collect()}
    assert out[1].startswith("Ä begin") and out[3] is None
    assert out[2].startswith("other É") and out[2].endswith("tail ñ") and len(out[2]) < 300


def _words(text):
    return (text or "").encode().split()


def _brute_passages(rows, least):
    """Documents that share ``least`` words in a row with a document of lesser id."""
    first, hit = {}, set()
    for d, t in sorted(rows):
        w = _words(t)
        for i in range(len(w) - least + 1):
            k = tuple(w[i:i + least])
            if first.setdefault(k, d) != d:
                hit.add(d)
    return hit


@pytest.mark.parametrize("source", ["planted", "data"])
def test_suffixes_match_brute_force(spark, source):
    if source == "planted":
        rows, _, _ = _planted(seed=6, n=60)
        docs = frame(spark, rows)
    else:
        docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = suffixes.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == _brute_passages(rows, 50)
    texts = {d: _words(t) for d, t in rows}
    bodies = {d: (t or "").encode() for d, t in rows}
    for r in got:
        a, b = texts[r["doc_id"]], texts[r["other_doc_id"]]
        i, j, n = r["first_word"], r["other_first_word"], r["words"]
        assert a[i:i + n] == b[j:j + n] and len(a[i:i + n]) == n >= 50
        if n < 27 + 32:                                      # no extension has met its limit
            assert i == 0 or j == 0 or a[i - 1] != b[j - 1]
            assert i + n == len(a) or j + n == len(b) or a[i + n] != b[j + n]
        if not r["exact_copy"]:
            assert bodies[r["doc_id"]][r["start"]: r["start"] + r["size"]].split() == a[i:i + n]


def test_suffixes_across_partitions(spark):
    """One beginning in all documents, dealt over many partitions."""
    rng = random.Random(8)
    passage = " ".join(prose(rng, 70))
    rows = [(d, f"{' '.join(prose(rng, 9, 10**6))} {passage} {' '.join(prose(rng, 9, 10**6))}") for d in range(50)]
    got = suffixes.repeated_passages(frame(spark, rows), partitions=23).collect()
    assert {r["doc_id"] for r in got} == set(range(1, 50))


def test_runs_hash_is_the_hash_of_windows():
    h = np.random.default_rng(3).integers(0, 2**64, 300, np.uint64)
    for n in (1, 2, 8, 27, 50, 64, 300, 301):
        assert runs.runs_hash(h, n).tolist() == windows_hash(h, n).tolist()


def test_suffixes_of_crowded_passages(spark):
    """Many copies whose surroundings differ, and beginnings that only some share to the end."""
    rng = random.Random(12)
    passages = [prose(rng, n) for n in (50, 55, 60)]
    short = prose(rng, 45)
    passages += [prose(rng, 6) + short, short]               # 51 words with a tail that others have alone
    rows, ids = [], list(range(1000))
    rng.shuffle(ids)
    for i, d in enumerate(ids):
        p = passages[i // 200 if i < 600 else 3 if i < 620 else 4]
        rows.append((d, " ".join([*prose(rng, rng.randint(1, 9), 10**6), *p, *prose(rng, rng.randint(1, 9), 10**6)])))
    got = suffixes.repeated_passages(frame(spark, rows), partitions=7).collect()
    assert {r["doc_id"] for r in got} == _brute_passages(rows, 50)
    texts = {d: _words(t) for d, t in rows}
    for r in got:
        i, j, n = r["first_word"], r["other_first_word"], r["words"]
        assert texts[r["doc_id"]][i:i + n] == texts[r["other_doc_id"]][j:j + n] and n >= 50


def test_chunks_of_fifty_words_meet():
    """The chunk with the 30th of 50 equal words is the same in both texts, also of one-letter words."""
    rng = random.Random(13)
    for trial in range(600):
        letters = trial % 2 * 6
        word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 1 + letters)))
        same, bodies, chunk = [word() for _ in range(50)], [], []
        for _ in range(2):
            before = [word() for _ in range(rng.randint(0, 60))]
            body = " ".join([*before, *same, *(word() for _ in range(rng.randint(0, 60)))]).encode()
            bodies.append((body, len(" ".join([*before, *same[:29]]).encode()) + 1))
        for (body, at), ends in zip(bodies, substrings.chunk_ends([b for b, _ in bodies], 0, 0, 512, substrings.RUN)):
            edges = [0, *ends]
            k = np.searchsorted(edges, at, "right")
            chunk.append(body[edges[k - 1]:edges[k]])
        assert chunk[0] == chunk[1]


def test_chunk_dedup_matches_brute_force(spark):
    """Many passages of 50 to 60 words, some whose middle an earlier document has alone."""
    rng, rows, d = random.Random(14), [], 0
    around = lambda p: " ".join([*prose(rng, rng.randint(0, 40)), *p, *prose(rng, rng.randint(0, 40))])
    for trial in range(700):
        p = prose(rng, rng.randint(49, 60))
        for part in ([p[10:45]] if trial % 3 == 0 else []) + [p, p]:
            rows.append((d, around(part)))
            d += 1
    texts, got = dict(rows), substrings.repeated_passages(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == _brute_passages(rows, 50)
    for r in got:
        part = texts[r["doc_id"]].encode()[r["start"]: r["start"] + r["size"]].decode()
        assert part in texts[r["first_doc_id"]] and len(part.split()) == r["words"]


def _held(rows, least):
    """Per document, the places of words in a run of ``least`` that an earlier document has."""
    first, held = {}, {}
    for d, t in sorted(rows):
        w = _words(t)
        for i in range(len(w) - least + 1):
            if first.setdefault(tuple(w[i:i + least]), d) != d:
                held.setdefault(d, set()).update(range(i, i + least))
    return held


@pytest.mark.parametrize("find", [substrings.repeated_passages, suffixes.repeated_passages])
def test_words_repeated_over_and_over_are_few_passages(spark, find):
    """A text that repeats a few words has equal runs at many places; they are
    paired in turn, not each with the first place of the other document."""
    rng = random.Random(15)
    around = lambda: prose(rng, 9, 10**6)
    beats = [["a", "b"], ["c"], prose(rng, 7), prose(rng, 49)]
    rows = []
    for k, beat in enumerate(beats):
        for d, (turn, n) in enumerate([(0, 240), (0, 240), (1, 700), (0, 130)]):
            rows.append((10 * k + d, " ".join([*around(), *(beat * 700)[turn:turn + n], *around(),
                                               *(beat * 9)[:100 * (d == 1)], *around()])))
    got = find(frame(spark, rows)).collect()
    texts, held = {d: _words(t) for d, t in rows}, {}
    for r in got:
        body = dict(rows)[r["doc_id"]].encode()
        i = len(body[:r["start"]].split())
        part = body[r["start"]: r["start"] + r["size"]].split()
        other = texts[r["first_doc_id" if "first_doc_id" in r else "other_doc_id"]]
        assert len(part) == r["words"] and any(other[j:j + len(part)] == part for j in range(len(other)))
        held.setdefault(r["doc_id"], set()).update(range(i, i + r["words"]))
    assert held == _held(rows, 50)
    counts = {d: sum(r["doc_id"] == d for r in got) for d in texts}
    assert max(counts.values()) <= 16, counts


def test_returns_of_runs():
    """Against a plain loop: turns in a row, and the first place's even returns."""
    rng = np.random.default_rng(16)
    for trial in range(200):
        pos = np.flatnonzero(rng.random(60) < rng.random())
        if not len(pos):
            continue
        _, same = np.unique(rng.integers(0, rng.integers(1, 6), len(pos)), return_inverse=True)
        turn, at, step, times = runs._returns(pos, same, same.max() + 1, 5)
        for g in range(same.max() + 1):
            own = pos[same == g].tolist()
            turns, even = [0], [own[0]]
            for p, q in zip(own, own[1:]):
                turns.append(turns[-1] + 1 if q - p <= 5 else 0)
            gap = own[1] - own[0] if len(own) > 1 and own[1] - own[0] <= 5 else 0
            while gap and len(even) < len(own) and own[len(even)] == even[-1] + gap:
                even.append(even[-1] + gap)
            assert turn[same == g].tolist() == turns
            assert {(a, s, t) for a, s, t in zip(at[same == g], step[same == g], times[same == g])} == {(own[0], gap, len(even))}


def test_chunks_that_share_no_run_are_not_compared(spark):
    """Of texts that share 30 words no chunk is equal; of those that share 50, the one with the 30th."""
    rng, rows, at = random.Random(17), [], {}
    for trial in range(400):
        same = prose(rng, 30 if trial % 2 else 50)
        for d in (2 * trial, 2 * trial + 1):
            before = prose(rng, rng.randint(0, 60), 10**6)
            rows.append((d, " ".join([*before, *same, *prose(rng, rng.randint(25, 60), 10**6)])))
            at[d] = len(before)
    held: dict[int, list] = {}
    for r in substrings.chunks(frame(spark, rows).select("doc_id", "text")).collect():
        if r["runs"]:
            held.setdefault(r["doc_id"], []).append(r)
    for d in range(0, 800, 2):
        one, other = ({r["digest"]: r for r in held.get(x, [])} for x in (d, d + 1))
        equal = one.keys() & other.keys()
        if d // 2 % 2:
            assert not equal
        else:                                                # the shared run is among those of an equal chunk
            assert any(all(x[k]["first"] <= at[i] < x[k]["first"] + x[k]["runs"] for i, x in ((d, one), (d + 1, other)))
                       for k in equal)


def test_crowded_digests_are_joined_by_exchanges_of_their_own(spark, monkeypatch):
    """Spark splits a crowded key of a join only if no grouping needs the key whole beside it."""
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(substrings, "staged", noted)
    rows, _, _ = _planted(seed=18)
    assert substrings.repeated_passages(frame(spark, rows)).count()
    assert "Join" in plans["shared-chunks"] and "Aggregate" not in plans["shared-chunks"]


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in Path(d.getPath()).rglob("shuffle_*")}


def test_staging_leaves_no_shuffle_files(spark):
    """What a write has exchanged goes when it ends, without the driver's garbage collection."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting, None)
    out = staged(spark.range(10_000).selectExpr("id % 977 as k", "id").groupBy("k").sum("id"), "test-staging")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert out.count() == 977 and spark.conf.get(setting, None) == was


def test_words_repeated_over_and_over_are_few_chunk_rows(spark):
    """The rows that meet in a digest's join follow the documents, not a text's returns to a few words."""
    rng, rows = random.Random(19), []
    for d, beat in enumerate([["a", "b"], ["c"], prose(rng, 7)] * 2):
        rows.append((d, " ".join([*prose(rng, 60, 10**6), *(beat * 800)[:800], *prose(rng, 60, 10**6)])))
    held: dict[int, list] = {}
    for r in substrings.chunks(frame(spark, rows).select("doc_id", "text")).collect():
        held.setdefault(r["doc_id"], []).append(r)
    for d, text in rows:
        runs_of = sorted((r["first"], r["first"] + r["runs"]) for r in held[d] if r["runs"])
        assert len(held[d]) <= 60 and sum(r["place"] == 0 for r in held[d]) == 1
        # every run of 50 words is in one row
        assert runs_of[0][0] == 0 and runs_of[-1][1] == len(text.split()) - 49
        assert all(a[1] == b[0] for a, b in zip(runs_of, runs_of[1:]))


def test_passages_not_extended_read_the_texts_once(spark, monkeypatch):
    """Places and both hashes come with the runs; the texts are not joined a second time."""
    joined = []

    def noted(df, name):
        joined.extend([name] if "asked" in df._jdf.queryExecution().optimizedPlan().toString() else [])
        return staged(df, name)

    monkeypatch.setattr(runs, "staged", noted)
    rows, _, _ = _planted(seed=20)
    assert substrings.repeated_passages(frame(spark, rows)).where("not exact_copy").count()
    assert joined == ["word-runs"]
