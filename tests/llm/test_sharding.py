import zlib
from collections import Counter
from pathlib import Path

from ledgermatch.llm import common, sharding

SCHEMA = "doc_id long, text string, copy string, shard_key string, h string"


def rows():
    return [(i if i % 3 else None, f"text {i % 50}" if i % 7 else None, "c", None, "h") for i in range(1000)] + [(5, "again", "c", None, "h")] * 500


def check(found, n, shards=16):
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == n
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_law_of_rows(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for size in (32 << 20, 4000):
        found = sharding.external_shuffle(df, bucket_bytes=size).collect()
        check(found, 1500)
        assert Counter(tuple(r)[:5] for r in found) == Counter(rows())


def test_same_rows_same_order(spark):
    a = sharding.external_shuffle(spark.createDataFrame(rows(), SCHEMA), bucket_bytes=4000).collect()
    b = sharding.external_shuffle(spark.createDataFrame(list(reversed(rows())), SCHEMA).repartition(7), bucket_bytes=4000).collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))
    c = sharding.external_shuffle(spark.createDataFrame(rows(), SCHEMA), seed=9, bucket_bytes=4000).collect()
    assert Counter(map(tuple, a)) != Counter(map(tuple, c))


def test_order_looks_random(spark):
    found = sharding.external_shuffle(spark.range(20_000), shards=4, bucket_bytes=50_000).collect()
    place = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    ids = [r["id"] for r in place]
    rises = sum(a < b for a, b in zip(ids, ids[1:]))
    assert abs(rises / len(ids) - 0.5) < 0.02
    assert abs(sum(ids[:10_000]) / 10_000 - 10_000) < 300


def test_few_and_no_rows(spark):
    check(sharding.external_shuffle(spark.createDataFrame(rows()[:3], SCHEMA)).collect(), 3)
    assert sharding.external_shuffle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_written_shards(spark, tmp_path):
    sharding.write_shards(spark.createDataFrame(rows(), SCHEMA), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1500 and back.select("shard").distinct().count() == 4


def test_query_shuffles_and_writes_whole_documents(spark, small):
    shared = Path(common.shared_dir(spark).removeprefix("file://")) / "ledgermatch"
    before = set(shared.glob("shards-*"))
    found = sharding.op3_sharding(spark, small).collect()
    (written,) = set(shared.glob("shards-*")) - before
    docs = common.read_table(spark, small, "documents")
    shards = spark.read.parquet(str(written)).select(*docs.columns, "shard", "slot").collect()
    assert Counter(tuple(r)[: len(docs.columns)] for r in shards) == Counter(map(tuple, docs.collect()))
    check(found, docs.count())
    texts = {(r["shard"], r["slot"]): (r["doc_id"], (r["text"] or "").encode()) for r in shards}
    assert {(r["shard"], r["slot"]): (r["doc_id"], r["size"], r["text_crc32"]) for r in found} == {k: (i, len(t) + 1, zlib.crc32(t)) for k, (i, t) in texts.items()}
    for part in written.glob("shard=*/*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(part)).collect()]
        assert slots == sorted(slots)


def test_ids_beyond_doubles_and_null_ids(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(big, "a"), (None, "b"), (big + 2, None)], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in sharding.external_shuffle(df).collect()} == {big, None, big + 2}


def test_a_bucket_lies_in_neighbouring_shards(spark):
    found = sharding.external_shuffle(spark.range(1003), shards=7, bucket_bytes=10_000).collect()
    sizes = Counter(r["shard"] for r in found)
    assert [sizes[i] for i in range(7)] == [-(-(i + 1) * 1003 // 7) - -(-i * 1003 // 7) for i in range(7)]


def test_query_columns(spark, small):
    found = sharding.op3_sharding(spark, small).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in common.read_table(spark, small, "documents").collect()}
    assert all((r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(docs[r["doc_id"]]) + 1, zlib.crc32(docs[r["doc_id"]]), "rows", None) for r in found)


def test_columns_of_any_name_and_maps(spark, tmp_path):
    rows = [(i // 3, f"t{i // 3}", "a", i, {"k": i // 3}, "s") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Shard string, slot int, m map<string,int>, row string")
    out = sharding.external_shuffle(df, shards=4, bucket_bytes=500)
    assert out.columns == [*df.columns, "_shard", "_slot"]
    got = out.collect()
    assert sorted((r["doc_id"], r["slot"], r["m"]["k"]) for r in got) == sorted((r[0], r[3], r[4]["k"]) for r in rows)
    places = sorted((r["_shard"], r["_slot"]) for r in got)
    assert places == [(s, i) for s in range(4) for i in range(10)]
    same = df.drop("slot").select("doc_id", "text", "Shard", "m", "row")  # complete repeats
    read = sharding.write_shards(same, str(tmp_path / "out"), shards=3, bucket_bytes=300)
    assert read.count() == 40 and "_shard" in read.columns and "slot" in read.columns


def test_written_shards_are_released(spark, tmp_path):
    before = common.mark()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "out")).collect()
    common.release(spark, before)
    assert not (tmp_path / "out").exists()
