import zlib

from conftest import SF_CHECK
from llm_data import frame

from stagewise.llm import sharding


def _expected(rows, shards=16):
    sized = sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    whole, at, out, slots = sum(s for _, s, _ in sized), 0, [], {}
    for d, s, c in sized:
        k = min(shards - 1, (2 * at + s) * shards // (2 * whole))
        out.append((d, s, c, k, slots.get(k, 0), at))
        slots[k] = slots.get(k, 0) + 1
        at += s
    return out


def test_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(map(tuple, sharding.shard(docs).collect()))
    assert got == _expected(rows)
    size = {}
    for _, s, _, k, _, _ in got:
        size[k] = size.get(k, 0) + s
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= 2 * max(r[1] for r in got)


def test_one_document_larger_than_all_targets(spark):
    rows = [(1, "x"), (2, "y" * 10_000), (3, None), (4, "z")]
    got = sorted(map(tuple, sharding.shard(frame(spark, rows), shards=4).collect()))
    assert got == _expected(rows, 4)


def test_query_columns(spark):
    q = sharding.op1_sharding(spark, SF_CHECK)
    assert q.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert q.where("law != 'bytes' or grown_shard is not null").count() == 0
