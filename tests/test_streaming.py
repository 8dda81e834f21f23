import json

import pytest
from pyspark.sql import types as T

from stellate.session import new_scratch_dir
from stellate.sources.store import Change
from stellate.streaming import ingest_new_files

SCHEMA = "username string, onlineStatus string"


def test_new_files_only(spark, store):
    landing = new_scratch_dir(spark, "landing")
    ckpt = new_scratch_dir(spark, "stream-ckpt")
    spark.createDataFrame([("a", "online"), ("b", "offline")], SCHEMA).coalesce(1).write.json(f"{landing}/batch1")
    src = f"{landing}/*"
    assert ingest_new_files(spark, src, SCHEMA, store, "landing.status", ckpt) >= 1
    assert store.read("landing.status").count() == 2
    assert ingest_new_files(spark, src, SCHEMA, store, "landing.status", ckpt) == 0   # nothing new
    spark.createDataFrame([("c", "online")], SCHEMA).coalesce(1).write.json(f"{landing}/batch2")
    ingest_new_files(spark, src, SCHEMA, store, "landing.status", ckpt)
    assert store.read("landing.status").count() == 3


def test_replayed_batch_not_appended_twice(spark, store):
    df = spark.createDataFrame([("a", "x")], SCHEMA)
    store.append_batch("landing.s", df, "q", 0)
    store.append_batch("landing.s", df, "q", 0)
    assert store.read("landing.s").count() == 1
    store.append_batch("landing.s", df, "other", 0)                   # another stream has its own numbers
    assert store.read("landing.s").count() == 2


def test_batch_written_but_not_published(spark, store):
    first, later = (spark.createDataFrame([(x, "x")], SCHEMA) for x in "ab")
    store.append_batch("landing.t", first, "q", 0)
    folder = store.manifest()["tables"]["landing.t"]["streams"]["q"]["path"]
    later.write.parquet(f"{folder}/_batch=1")                         # a run that died before its commit
    assert [r.username for r in store.read("landing.t").collect()] == ["a"]
    store.append_batch("landing.t", later, "q", 1)
    assert sorted(r.username for r in store.read("landing.t").collect()) == ["a", "b"]


def test_entry_does_not_grow_with_batches(spark, store):
    schema = T.StructType.fromJson(spark.createDataFrame([], SCHEMA).schema.jsonValue())
    man = {"tables": {}, "sequences": {}}
    sizes = []
    for n in range(10_000):
        man = store._applied(man, {"landing.s": Change("batch", "folder", schema, ("q", n))}, None)
        if n in (9, 9_999):
            sizes.append(len(json.dumps(man)))
    assert sizes[1] - sizes[0] == len("9999") - len("9")
    replay = store._applied(man, {"landing.s": Change("batch", "folder", schema, ("q", 9_000))}, None)
    assert replay["tables"] == man["tables"]


def test_rewritten_stream_table_keeps_its_mark(spark, store):
    a, b, c = (spark.createDataFrame([(x, "x")], SCHEMA) for x in "abc")
    store.append_batch("landing.u", a, "q", 0)
    store.append("landing.u", b)
    store.replace("landing.u", store.read("landing.u"), base=store.version())
    store.append_batch("landing.u", a, "q", 0)                        # replay of what the rewritten version holds
    store.append_batch("landing.u", c, "q", 1)
    assert sorted(r.username for r in store.read("landing.u").collect()) == ["a", "b", "c"]
    store.truncate("landing.u")
    store.append_batch("landing.u", c, "q", 1)
    assert store.read("landing.u").count() == 0


def test_batches_may_bring_columns(spark, store):
    store.append_batch("landing.w", spark.createDataFrame([("a", 1)], "username string, n int"), "q", 0)
    store.append_batch("landing.w", spark.createDataFrame([("b", 2**40, "x")], "username string, n long, extra string"), "q", 1)
    assert sorted(map(tuple, store.read("landing.w").collect())) == [("a", 1, None), ("b", 2**40, "x")]
    with pytest.raises(ValueError):
        store.append_batch("landing.w", spark.createDataFrame([(1,)], "_batch int"), "q", 2)


def test_manifest_hint_may_be_stale(spark, store):
    store.append("landing.h", spark.createDataFrame([("a", "x")], SCHEMA))
    store.append("landing.h", spark.createDataFrame([("b", "x")], SCHEMA))
    path = store._Path(f"{store.root}/_manifest/_latest")
    out = store._fs.create(path, True)
    out.write(bytearray(b"1"))          # stale hint: readers must still find commit 2
    out.close()
    assert store.version() == 2 and store.read("landing.h").count() == 2
    store.append("landing.h", spark.createDataFrame([("c", "x")], SCHEMA))
    assert store.version() == 3
