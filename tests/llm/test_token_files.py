import zlib

import numpy as np
import pytest
from conftest import SF_CHECK
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stagewise.llm import packing, token_files
from stagewise.llm.common import TokenIds, vocabulary_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=60))
def test_code_round_trip(values):
    padded = np.array(values + [0] * (-len(values) % 4), np.uint32)
    control, data, sizes = token_files.encode(padded)
    assert len(control) == len(padded) // 4 and sizes.sum() == len(data)
    assert token_files.decode(control, data).tolist() == padded.tolist()


def test_file_round_trip():
    ids = np.arange(70_000, dtype=np.uint32)[::-1].copy()    # rank r stands for ids[r]
    rank = np.argsort(ids).astype(np.uint32)
    docs = [(None, [5]), (-3, list(range(999))), (7, [69_999, 0, 300]), (8, [1] * 5000)]
    coded = []
    for d, t in docs:
        padded = np.zeros(-(-len(t) // 4) * 4, np.uint32)
        padded[: len(t)] = rank[t]
        control, data, _ = token_files.encode(padded)
        coded.append((d, len(t), control.tobytes(), data.tobytes()))
    body = token_files.pack_file(*map(list, zip(*coded)))
    for block in (1, 100, 1 << 16):
        assert [(d, x.tolist()) for d, x in token_files.read_file(body, ids, block)] == docs


TEXTS = ["İstanbul ſtraße ΑΣ σΣ.", "é é naïve ŒUVRE Ÿ ÿ Þorn", "a<|endoftext|>b x <|startoftext|>",
         "don't I'LL it's ''s 12ab3 #*x   a b \x1f q\x85z", "😀 日本語 ｶﾞ ﬁ Å Ω", "ŉ ĸ ŀ ĿÀÖØÝß÷×", "", "\n \t"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(text):
    library = Tokenizer.from_file(vocabulary_path())
    own = np.frombuffer(TokenIds(vocabulary_path(), most=3).of(text.encode(), 2), "<u4").tolist()
    assert own == library.encode(text, add_special_tokens=False).ids + [2]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=30))
def test_ids_equal_the_library_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    library = _library()
    own = np.frombuffer(_own().of(text.encode(), 2), "<u4").tolist()
    assert own == library.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("text", [*TEXTS, "  two  spaces\nand lines ", "It's 12 o'clock"])
def test_another_vocabulary_takes_the_whole_path(text):
    path = vocabulary_path("byte_bpe_50k.json")
    own = TokenIds(path)
    assert not own.by_word and TokenIds(vocabulary_path()).by_word
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [2]
    assert np.frombuffer(own.of(text.encode(), 2), "<u4").tolist() == expected


def test_files_of_another_vocabulary(spark):
    from llm_data import frame
    from stagewise.llm.common import new_path
    rows = [(3, "Two  spaces and\nlines"), (1, None), (2, "x" * 3000 + " 日本"), (None, "no id")]
    path, folder = vocabulary_path("byte_bpe_50k.json"), new_path(spark, "other")
    assert folder.startswith("file:")                          # as tasks must see it
    manifest = token_files.write(frame(spark, rows), folder, end=60_000, tokenizer=path)      # ids of more than 16 bits
    got = token_files.read(spark, folder, manifest).collect()
    library = Tokenizer.from_file(path)
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == {
        d: library.encode(t or "", add_special_tokens=False).ids + [60_000] for d, t in rows}
    large = token_files.write(frame(spark, rows), new_path(spark, "large"), end=70_000)
    assert large.agg({"n_tokens": "sum"}).first()[0] == sum(
        len(_library().encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)


_CACHE = {}


def _library():
    return _CACHE.setdefault("library", Tokenizer.from_file(vocabulary_path()))


def _own():
    return _CACHE.setdefault("own", TokenIds(vocabulary_path()))


def test_query_equals_whole_text_encoding(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected, at = [], 0
    for r, e in zip(rows, _library().encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 2], "<u4")
        expected.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = token_files.op6_token_files(spark, SF_CHECK)
    assert sorted(map(tuple, got.collect())) == expected


def test_packing(spark):
    got = packing.op10_best_fit_packing(spark, SF_CHECK).toPandas()
    for _, held in got.sort_values("offset").groupby("sequence_id"):
        ends = held["offset"] + held["length"]
        assert held["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 4096
    least = -(-int(got["length"].sum()) // 4096)
    assert got["sequence_id"].nunique() <= 1.02 * least + 1
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    whole = {r["doc_id"]: _own().of((r["text"] or "").encode(), 1) for r in rows}
    for r in got.itertuples():
        part = whole[r.doc_id][4 * r.start: 4 * (r.start + r.length)]
        assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32 and r.start == 4096 * r.piece
    assert got.groupby("doc_id")["length"].sum().to_dict() == {d: len(x) // 4 for d, x in whole.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
def test_best_two_fit_places_every_piece_once(lengths):
    number, offset, n = packing.best_two_fit(np.array(lengths), 64)
    assert set(number) == set(range(int(n)))
    for b in range(int(n)):
        held = sorted((int(offset[i]), lengths[i]) for i in range(len(lengths)) if number[i] == b)
        at = 0
        for o, size in held:
            assert o == at
            at += size
        assert at <= 64


def _naive(lengths, capacity):
    """Best-two-fit over a plain list of pieces: the bins' contents."""
    pool, bins = sorted(lengths), []
    while pool:
        held = []
        while fits := [x for x in pool if x <= capacity - sum(held)]:
            held.append(max(fits))
            pool.remove(max(fits))
        while sum(held) < capacity:
            short, room = min(held), capacity - sum(held) + min(held)
            pairs = [(x + y, -x) for i, x in enumerate(pool) for y in pool[i + 1:] if x + y <= room]
            if not pairs or max(pairs)[0] <= short:
                break
            total, x = max(pairs)
            held.remove(short)
            pool.remove(-x)
            pool.remove(total + x)
            held += [-x, total + x]
            pool = sorted(pool + [short])
        bins.append(sorted(held))
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=40))
def test_best_two_fit_equals_the_naive_one(lengths):
    number, _, n = packing.best_two_fit(np.array(lengths), 40)
    assert sorted(sorted(lengths[i] for i in range(len(lengths)) if number[i] == b) for b in range(int(n))) == _naive(lengths, 40)


def test_two_pieces_replace_the_shortest():
    # greedy takes 6 then 3 (gap 1); 2 + 2 fill the place of 3 and the gap exactly
    number, _, n = packing.best_two_fit(np.array([6, 3, 2, 2, 7]), 10)
    assert n == 2 and sorted(sum(s for s, b in zip([6, 3, 2, 2, 7], number) if b == k) for k in (0, 1)) == [10, 10]


def test_sequences_hold_the_ids(spark):
    from llm_data import frame
    docs = frame(spark, [(1, "a b c"), (2, "d e"), (3, None)])
    parts = packing.pieces(docs, length=4, with_ids=True)
    made = packing.sequences(packing.pack(parts, length=4)).collect()
    assert sum(r["n_tokens"] for r in made) == sum(r["length"] for r in parts.collect())
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in made)
