"""What loads and merges write and shuffle: rows of few bytes, and only what they must."""

import re

from pyspark.sql import functions as F

from stellate.sources.staging import stage


def _files(store, path):
    return [st.getPath().getName() for st in store._fs.listStatus(store._Path(path)) if st.getPath().getName().startswith("part-")]


def test_row_ids_are_uuids_that_pack_well(spark, store):
    _, ch = stage(store, "t", spark.range(0, 5000, numPartitions=4).select(F.lit("same").alias("x")))
    _, again = stage(store, "t", spark.range(0, 5000, numPartitions=4).select(F.lit("same").alias("x")))
    ids = [r[0] for c in (ch, again) for r in store.read_version(c).select("_row_id").collect()]
    assert len(set(ids)) == 10000 and all(re.fullmatch("[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}", i) for i in ids)
    assert len({i[:20] for i in ids}) == 2  # one first half a load
    assert all(n.endswith(".zstd.parquet") for n in _files(store, ch.path))
    written = sum(st.getLen() for st in store._fs.listStatus(store._Path(ch.path)))
    assert written < 10 * 5000  # 36 characters each, of which random ones took 40 bytes


def _changes(spark, target, source, limit):
    from stellate.operators.merge import apply_changes, changed_rows
    from stellate.session import new_scratch_dir
    found = changed_rows(target, source, ["bk"], "k", limit)
    path = new_scratch_dir(spark, "changes")
    found.write.parquet(path)
    merged, high = apply_changes(target, spark.read.schema(found.schema).parquet(path), ["bk"], "k", 40_000, limit)
    return found, sorted(map(tuple, merged.collect()), key=str), high


def test_a_shuffled_merge_gives_what_a_broadcast_one_gives(spark):
    schema = "bk string, v string, n long, d decimal(9,2), x double, k long"
    target = spark.range(1, 40_001).selectExpr(
        "IF(id % 9 = 0, NULL, concat('b', id)) AS bk", "IF(id % 5 = 0, NULL, concat(id % 3, '')) AS v", "IF(id % 7 = 0, NULL, id % 4) AS n",
        "CAST(id % 6 AS decimal(9,2)) AS d", "IF(id % 8 = 0, double('NaN'), id * 0.5) AS x", "id AS k")
    assert [f.name for f in target.schema] == [c.split()[0] for c in schema.split(", ")]
    source = target.where("k % 3 > 0").selectExpr(
        "IF(k % 11 = 0, concat('new', k), bk) AS bk", "IF(k % 13 = 0, '', v) AS v", "IF(k % 17 = 0, NULL, n) AS n", "d", "IF(k % 19 = 0, NULL, x) AS x")
    plain, small, high = _changes(spark, target, source, None)
    moved, large, same_high = _changes(spark, target, source, 1)
    key = lambda r: str((r[:5], None if r[5] > 40_000 else r[5]))
    assert "_key" in moved.columns and "_key" not in plain.columns and high == same_high
    assert sorted(map(key, large)) == sorted(map(key, small))
    assert sorted(r[5] for r in large) == list(range(1, high + 1))
    assert moved.count() == plain.count() < source.count()


def test_a_shuffled_merge_sends_a_digest_of_the_target(spark):
    from stellate.operators.merge import changed_rows
    wide = [f"c{i}" for i in range(6)]
    target = spark.range(0, 2000).select(F.col("id").cast("string").alias("bk"), *[F.concat(F.lit(f"{c}-"), F.col("id")).alias(c) for c in wide], F.col("id").alias("k"))
    plan = changed_rows(target, target.drop("k"), ["bk"], "k", 1)._jdf.queryExecution().sparkPlan().toString()
    sides = re.findall(r"Project \[[^\n]*_t_digest[^\n]*", plan)
    assert sides and all(not re.search(r" AS _t_c\d", p) for p in sides)


def test_texts_that_join_alike_have_other_digests(spark):
    from stellate.operators.merge import _digest
    pairs = [("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("", "abc"), ("1:a", ""), ("", "1:a"), (None, None), ("-", None), (None, "-"), ("", "")]
    rows = spark.createDataFrame(pairs, "x string, y string").select(_digest([F.col("x"), F.col("y")]).alias("d"))
    assert rows.distinct().count() == len(pairs)


def test_a_large_table_is_divided_without_a_shuffle(spark, store, monkeypatch):
    from stellate.plans.partitioned import publish_partitioned
    from stellate.sources import store as module
    rows = spark.range(0, 6000, numPartitions=3).select(F.col("id").alias("k"), F.concat(F.lit("m"), F.col("id") % 7).alias("month"))
    store.replace("dwh.t", rows)
    publish_partitioned(store, "dwh.t", None, F.col("month"))
    few = {m: _files(store, p) for m, p in store.partitions("dwh.t").items()}
    monkeypatch.setattr(module, "FILE_ROWS", 100)
    store.replace("dwh.u", rows)
    tasks = store.read("dwh.u").rdd.getNumPartitions()
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    publish_partitioned(store, "dwh.u", None, F.col("month"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    many = {m: _files(store, p) for m, p in store.partitions("dwh.u").items()}
    assert few.keys() == many.keys() and all(len(f) == 1 for f in few.values()) and all(len(f) == tasks for f in many.values()) and tasks > 1
    assert sorted(map(tuple, store.read("dwh.u").collect())) == sorted(map(tuple, rows.collect()))


def test_repeated_keys_are_found_by_their_hashes(spark):
    from stellate.operators.checks import has_key_repeats
    make = lambda keys: spark.createDataFrame([(k,) for k in keys], "bk string")
    assert has_key_repeats(make(["a", "b", "a"]), ["bk"]) and not has_key_repeats(make(["a", "b", None, None]), ["bk"])


def test_compressed_csv_reads_back(spark):
    from stellate.session import new_scratch_dir
    from stellate.sources.csv import read_csv, write_csv
    rows = [("1", 'a "q", b'), ("2", "")]
    path = new_scratch_dir(spark, "gz") + "/t.csv"
    write_csv(spark.createDataFrame(rows, "id string, v string"), path, compression="gzip")
    assert sorted(map(tuple, read_csv(spark, path, multi_line=False).collect())) == rows


def _sales_store(spark, store, n=300):
    """A built star over ``n`` sales, and staged sales of which some are new and some really differ."""
    from stellate.plans.star import build_star
    text = lambda e: F.expr(e).cast("string")
    stage(store, "country", spark.createDataFrame([("1", "A", "EUROPE"), ("2", "B", "ASIA")], "country_code string, country_name string, region string"))
    stage(store, "customer", spark.range(0, 20).select(text("id").alias("customer_id"), text("id").alias("customer_name"), text("id % 3").alias("country_code"), text("'t'").alias("customer_type")))
    stage(store, "product", spark.range(0, 30).select(text("id").alias("product_id"), text("id").alias("product_name"), text("'c'").alias("category"), text("'1.00'").alias("standard_price")))
    sales = spark.range(0, 2 * n, numPartitions=3).select(
        text("IF(id % 50 = 0, NULL, concat('t', id))").alias("transaction_id"), text("concat('2020-0', 1 + id % 5, '-01')").alias("transaction_date"),
        text("id % 25").alias("customer_id"), text("id % 31").alias("product_id"), text("1").alias("quantity"), text("'2.00'").alias("unit_price"),
        text("'2.00'").alias("total_amount"), text("IF(id % 2 = 0, 'A', 'B')").alias("payment_mode"), F.col("id"))
    stage(store, "sales_transactions", sales.where(F.col("id") < n).drop("id"))
    build_star(store)
    stage(store, "sales_transactions", sales.where(F.col("id") >= n // 2).drop("id").withColumn("payment_mode", F.lower("payment_mode")))


def _sales_rows(store):
    from stellate.plans.warehouse import SALES
    rows = store.read(SALES.qualified).drop("_load_id", "_row_id").collect()
    assert sorted(r["sales_trans_key"] for r in rows) == list(range(1, len(rows) + 1))
    return sorted(str({**r.asDict(), "sales_trans_key": None}) for r in rows)


def test_a_merge_looks_keys_up_once_when_that_shuffles(spark, monkeypatch):
    from stellate.plans import loads, partitioned
    from stellate.plans.warehouse import SALES
    from stellate.sources.store import TableStore
    got, written, write = {}, [], TableStore.write_version
    monkeypatch.setattr(TableStore, "write_version", lambda self, q, *a, **k: written.append(q) or write(self, q, *a, **k))
    checked, read = [], []
    for module in (loads, partitioned):
        monkeypatch.setattr(module, "check_cardinality", lambda t, s, bk, f=module.check_cardinality: checked.append(s) or f(t, s, bk))
        monkeypatch.setattr(module, "changed_rows", lambda t, s, *a, f=module.changed_rows: read.append(s) or f(t, s, *a))
    auto, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit, by_month in ((None, False), (None, True), (1, False), (1, True)):
        store = TableStore.scratch(spark, "once")
        _sales_store(spark, store)
        written.clear()
        spark.conf.set(auto, before if limit is None else "-1")
        try:
            if by_month:
                partitioned.publish_partitioned(store, SALES.qualified, None, partitioned.month_of())
                partitioned.merge_partitioned(store, SALES, loads.fact_source(store, None, limit), partitioned.month_of(), limit)
            else:
                loads.merge_load(store, SALES, None, limit)
            for source in (checked.pop(), read.pop()):  # what the merge reads several times joins nothing by shuffle
                assert "SortMergeJoin" not in source._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set(auto, before)
        got[limit, by_month] = _sales_rows(store)
        assert written.count("dwh._sales_transactions_fact_source") == (1 if limit else 0)
    assert len(got[None, False]) > 600 - 150 and all(rows == got[None, False] for rows in got.values())


def test_a_source_with_an_untyped_column_is_not_written(spark, store):
    rows = spark.range(0, 9).groupBy((F.col("id") % 3).alias("k")).count().withColumn("nothing", F.lit(None))
    assert store.settled("dwh._s", rows).count() == 3
    settled = store.settled("dwh._s", rows.drop("nothing"))
    assert "parquet" in settled._jdf.queryExecution().logical().toString().lower()
    assert sorted(map(tuple, settled.collect())) == [(0, 3), (1, 3), (2, 3)]


def test_writes_let_go_of_what_finished_queries_left(spark, store, monkeypatch):
    from stellate import session
    from stellate.sources import store as module
    calls = []
    monkeypatch.setattr(module, "collect_garbage", calls.append)
    rows = spark.range(3).select(F.col("id").cast("string").alias("x"))
    store.write_version("dwh.t", rows)
    store.write_partitioned("dwh.p", rows, F.col("x"))
    assert calls == [spark, spark]
    jvm = spark._jvm
    kept = jvm.java.lang.ref.WeakReference(jvm.java.lang.Object())  # stands for a broadcast table that no plan uses any more
    assert any(session.collect_garbage(spark, every=0) and not session.time.sleep(0.2) and kept.refersTo(None) for _ in range(20))  # Python lets go of it soon
    assert session.collect_garbage(spark) is False  # not again within some seconds
