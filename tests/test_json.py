import pytest
from pyspark.sql import functions as F

from stellate.functions.columns import flatten, normalize_names, snake_case, union_with_growth
from stellate.functions.months import bad_month_rows, month_range_filter, validate_month
from stellate.operators.nested import child_rows, explode_list
from stellate.sources import json_ingest as J

LISTING = "username string, archives array<string>"
BODIES = "url string, status int, games array<struct<game_id:bigint,end_time:bigint,white:string,black:string>>"
U = "https://archive.example/player/"


def test_month_validation():
    for ok in (None, "", "2022/11"):
        validate_month(ok)
    for bad in ("2022-11", "22/1"):
        with pytest.raises(ValueError):
            validate_month(bad)


def test_month_range_inclusive_and_open(spark):
    df = spark.createDataFrame([(f"{U}a/games/2022/{m:02d}",) for m in (10, 11, 12)], "url string")
    m = F.substring("url", -7, 7)
    assert month_range_filter(df, m, "2022/11", "2022/11").count() == 1
    assert month_range_filter(df, m, "2022/11", None).count() == 2
    assert month_range_filter(df, m, "", "").count() == 3
    with pytest.raises(ValueError):
        month_range_filter(df, m, "2022-11", None)
    bad = spark.createDataFrame([("2022/11",), ("2022-11",), ("",), ("22",)], "m string")
    assert sorted(r.m for r in bad_month_rows(bad, "m").collect()) == ["2022-11", "22"]


def _sources(spark, games_status=200):
    listing = spark.createDataFrame([
        ("alice", [f"{U}alice/games/2022/10", f"{U}alice/games/2022/11", f"{U}alice/games/2022/12"]),
        ("bob", [f"{U}bob/games/2022/11", f"{U}bob/games/2022/11"]),
        ("carol", None), ("dave", [])], LISTING)
    shared = (7, 1668000000, "alice", "bob")
    bodies = spark.createDataFrame([
        (f"{U}alice/games/2022/10", 200, [(1, 1665000000, "alice", "x")]),
        (f"{U}alice/games/2022/11", 200, [(2, 1668000001, "alice", "y"), shared]),
        (f"{U}alice/games/2022/12", games_status, [(3, 1670000000, "z", "alice")]),
        (f"{U}bob/games/2022/11", 200, [shared]),
    ], BODIES)
    return listing, bodies


def test_archives_explode_and_missing_lists(spark):
    listing, _ = _sources(spark)
    rows = J.players_archives(listing).collect()
    assert len(rows) == 5 and {r.username for r in rows} == {"alice", "bob"}


def test_incremental_games_and_ledger(spark, store):
    listing, bodies = _sources(spark)
    users = ["alice", "bob"]
    info = J.load_games_incrementally(store, listing, bodies, users, "2022/11", "2022/11")
    games = store.read(J.GAMES_TABLE)
    assert info.rows == 3 and games.count() == 3
    assert games.filter(F.col("game_id") == 7).count() == 2            # one row per user's archive
    assert dict(games.dtypes)["end_time"] == "timestamp"
    J.load_games_incrementally(store, listing, bodies, users, "2022/11", "2022/12")
    assert store.read(J.GAMES_TABLE).count() == 4                      # only 2022/12 added
    J.load_games_incrementally(store, listing, bodies, users, "2022/10", "2022/12")
    assert store.read(J.GAMES_TABLE).count() == 5                      # out-of-range month taken later
    ledger = [r.url for r in store.read(J.LEDGER_TABLE).collect()]
    assert len(ledger) == len(set(ledger)) == 4


def _prunes_ledger(known):
    plan = known._jdf.queryExecution().executedPlan().toString()
    return "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_ledger_is_read_by_month(spark, store):
    listing, bodies = _sources(spark)
    J.load_games_incrementally(store, listing, bodies, ["alice", "bob"])
    ledger = store.read(J.LEDGER_TABLE)
    candidates = J.archive_candidates(listing, ["alice"], None, None)
    bounded = J.ledger_part(ledger, candidates, "2022/11", "2022/11")
    assert _prunes_ledger(bounded) and {r.month for r in bounded.collect()} == {"2022/11"}
    assert len(bounded.inputFiles()) and len(ledger.inputFiles()) >= 3
    open_end = J.ledger_part(ledger, J.archive_candidates(listing, ["bob"], "2022/11", None), "2022/11", None)
    assert _prunes_ledger(open_end) and {r.month for r in open_end.collect()} == {"2022/11"}
    assert J.ledger_part(ledger, candidates.limit(0), None, None).count() == 0


def test_ledger_of_odd_urls_and_of_older_stores(spark, store):
    odd = ["", "x", f"{U}a/games/0022/01", f"{U}a/games/a b%2F", "__HIVE_DEFAULT_PARTITION__", f"{U}a/games/2022/11"]
    listing = spark.createDataFrame([("a", odd)], LISTING)
    bodies = spark.createDataFrame([(u, 200, [(1, 1665000000, "a", "x")]) for u in odd], BODIES)
    assert J.load_games_incrementally(store, listing, bodies, ["a"]).rows == len(odd)
    assert J.load_games_incrementally(store, listing, bodies, ["a"]).rows == 0
    assert sorted(r.url for r in store.read(J.LEDGER_TABLE).collect()) == sorted(odd)
    old = type(store).scratch(spark, "old-ledger")
    old.replace(J.LEDGER_TABLE, spark.createDataFrame([(u, "1") for u in odd[:3]], "url string, _load_id string"))
    assert J.load_games_incrementally(old, listing, bodies, ["a"]).rows == len(odd) - 3
    assert "month" in old.schema(J.LEDGER_TABLE).names and old.read(J.LEDGER_TABLE).count() == len(odd)


def test_not_found_archive_recorded_other_errors_fail(spark, store):
    listing, bodies = _sources(spark, games_status=404)
    J.load_games_incrementally(store, listing, bodies, ["alice"], "2022/12", "2022/12")
    assert store.read(J.GAMES_TABLE).count() == 0
    assert store.read(J.LEDGER_TABLE).count() == 1
    listing, bodies = _sources(spark, games_status=500)
    store2 = type(store).scratch(spark, "t500")
    with pytest.raises(Exception):
        J.load_games_incrementally(store2, listing, bodies, ["alice"], "2022/12", "2022/12")
    assert not store2.exists(J.LEDGER_TABLE)                           # nothing remembered on failure


def test_profiles_and_status(spark):
    prof = spark.createDataFrame([("alice", 1668000000, 1500000000), ("zed", 1, 1)],
                                 "username string, last_online bigint, joined bigint")
    out = J.players_profiles(prof, ["alice"]).collect()
    assert len(out) == 1 and out[0].last_online.year == 2022
    snap = spark.createDataFrame([("alice", "online", 1668000000)], "username string, onlineStatus string, lastLoginDate bigint")
    st = J.players_online_status(snap, ["alice"])
    assert st.columns == ["username", "onlineStatus", "lastLoginDate", "check_time"]


def test_flatten_child_rows_and_names(spark):
    df = spark.createDataFrame([(1, ("x", (2,)), [("a", 1), ("b", 2)])],
                               "id long, p struct<a:string, b:struct<c:long>>, items array<struct<n:string, v:long>>")
    assert flatten(df.drop("items")).columns == ["id", "p__a", "p__b__c"]
    rows = child_rows(df, "id", "items").collect()
    assert [(r.id, r._pos, r.n) for r in rows] == [(1, 0, "a"), (1, 1, "b")]
    assert explode_list(df, "items", ["id"]).count() == 2
    assert snake_case("onlineStatus") == "online_status" and snake_case("lastLoginDate") == "last_login_date"
    assert normalize_names(spark.createDataFrame([(1,)], "userName long")).columns == ["user_name"]
    with pytest.raises(ValueError):
        normalize_names(spark.createDataFrame([(1, 2)], "aB long, a_b long"))


def test_schema_growth(spark, store):
    old = spark.createDataFrame([(1,)], "a long")
    new = spark.createDataFrame([(2, "x")], "a long, b string")
    assert sorted(map(tuple, union_with_growth(old, new).collect())) == [(1, None), (2, "x")]
    store.append("landing.t", old)
    store.append("landing.t", new)
    assert sorted(map(tuple, store.read("landing.t").collect())) == [(1, None), (2, "x")]
