"""Ingest of landed API JSON (player profiles, archive listings, archive
bodies, online status) with an archive ledger so an input is never loaded
twice.

The HTTP calls of the reference are not rebuilt: responses are landed as
JSON files (one object per line) and read by Spark. A landed archive body is
``{"url", "status", "games": [...]}``; a long archive may be landed as
several records with the same ``url``, each holding a bounded chunk of its
games, so no record or group has to hold a whole archive.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.casts import apply_type_hints
from stellate.functions.columns import flatten, normalize_names
from stellate.functions.months import month_of_url, month_range_filter, validate_month
from stellate.operators.lookups import bounded_broadcast
from stellate.operators.nested import child_rows
from stellate.sources.staging import LoadInfo, add_lineage, new_load_id, select_resources
from stellate.sources.store import Change, TableStore

# Column typing hints of the reference's resources (fixed values).
PROFILE_HINTS = {"last_online": "timestamp", "joined": "timestamp"}
GAME_HINTS = {"end_time": "timestamp"}

GAMES_TABLE = "landing.players_games"
LEDGER_TABLE = "landing._archives_ledger"
PROFILES_TABLE = "landing.players_profiles"
STATUS_TABLE = "landing.players_online_status"
ARCHIVES_TABLE = "landing.players_archives"
RESOURCES = ("players_profiles", "players_archives", "players_games", "players_online_status")


def read_landed(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Landed JSON lines; pass a schema to skip inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def users_frame(spark: SparkSession, users: Iterable[str] | DataFrame, col: str = "username") -> DataFrame:
    if isinstance(users, DataFrame):
        return users.select(F.col(col).alias("username")).distinct()
    return spark.createDataFrame([(u,) for u in users], "username string")


def restrict_to_users(df: DataFrame, users: Iterable[str] | DataFrame, col: str = "username") -> DataFrame:
    """Keep only rows of tracked users (semi join; the user list is
    broadcast after a size check)."""
    u = bounded_broadcast(users_frame(df.sparkSession, users).withColumnRenamed("username", col))
    return df.join(u, col, "left_semi")


def players_profiles(landed: DataFrame, users: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """One row per profile with ``last_online`` and ``joined`` as timestamps."""
    df = restrict_to_users(landed, users) if users is not None else landed
    return apply_type_hints(df, PROFILE_HINTS)


def players_archives(listing: DataFrame, users: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Archive listing -> one row per archive URL; a missing or empty
    ``archives`` list gives no rows."""
    df = restrict_to_users(listing, users) if users is not None else listing
    return df.select("username", F.explode("archives").alias("url"))


def archive_candidates(listing: DataFrame, users, start_month: str | None, end_month: str | None) -> DataFrame:
    """Archive URLs inside the inclusive month range, each once."""
    validate_month(start_month)
    validate_month(end_month)
    urls = players_archives(listing, users)
    return month_range_filter(urls, month_of_url("url"), start_month, end_month).dropDuplicates(["url"])


def checked_games(bodies: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """Games of the given archives, one row per game. Status 404 archives give
    no rows; any other status >= 400 fails the job.

    Only archives that were asked for can fail it: the test reads a column of
    ``urls`` as well, so it cannot be evaluated below the join."""
    asked = F.lit(True)
    b = bodies
    if urls is not None:
        b = bodies.join(urls.select("url").distinct().withColumn("_asked", F.monotonically_increasing_id()), "url")
        asked = F.col("_asked").isNotNull() & (F.col("_asked") >= 0)
    status = F.coalesce(F.col("status"), F.lit(200))
    ok = F.when(asked & (status >= 400) & (status != 404),
                F.raise_error(F.concat(F.lit("archive fetch failed with status "),
                                       status.cast("string"), F.lit(": "), F.col("url")))
                ).otherwise(status != 404)
    # the outer form: explode would filter out bodies without games before their status is tested
    games = b.filter(ok).select("url", F.posexplode_outer("games").alias("_at", "game")).filter(F.col("_at").isNotNull())
    return apply_type_hints(games.select("url", "game.*"), GAME_HINTS)


def load_games_incrementally(store: TableStore, listing: DataFrame, bodies: DataFrame, users,
                             start_month: str | None = None, end_month: str | None = None,
                             *, games_table: str = GAMES_TABLE, ledger_table: str = LEDGER_TABLE) -> LoadInfo:
    """Append the games of archives not loaded before.

    An archive enters the ledger once it passes the month filter (also when
    its body is a 404); archives outside the range are not remembered, so a
    later, wider run takes them. Games and ledger rows are published in one
    commit: a failed run leaves both unchanged and its archives are retried.
    The ledger is stored by month, and a run reads its own months' part only.
    """
    load_id = new_load_id()
    candidates = archive_candidates(listing, users, start_month, end_month)
    base = store.version()
    if store.exists(ledger_table):
        if "month" not in store.schema(ledger_table).names:   # written before ledgers were divided
            whole = store.read(ledger_table).withColumn("month", month_of_url("url"))
            base = store.replace(ledger_table, whole, base=base, divided_by="month")
        known = ledger_part(store.read(ledger_table), candidates, start_month, end_month)
        candidates = candidates.join(known.select("url"), "url", "left_anti")
    fresh_path = store.write_version(ledger_table, candidates.select(
        "url", F.lit(load_id).alias("_load_id"), month_of_url("url").alias("month")), divided_by="month")
    fresh = store.read_version(fresh_path)
    changes, rows = write_nested(store, games_table, checked_games(in_months(bodies, start_month, end_month), fresh), "append", load_id)
    store.commit({**changes, ledger_table: replace(fresh_path, kind="append")}, base=base)
    return LoadInfo(games_table, load_id, rows, "append")


def ledger_part(ledger: DataFrame, candidates: DataFrame, start_month: str | None, end_month: str | None) -> DataFrame:
    """The ledger's rows from the first to the last month of the candidates
    (one aggregate where the run's own bounds do not say it); a filter on the
    ledger's folders. Urls without a month are held under NULL."""
    low, high = start_month, end_month
    if not (low and high):
        low, high = candidates.agg(F.min(month_of_url("url")), F.max(month_of_url("url"))).first()
    return ledger.filter(F.col("month").isNull() | F.col("month").between(low or "", high or ""))


def in_months(bodies: DataFrame, start_month: str | None, end_month: str | None) -> DataFrame:
    """Only the ``month=YYYY-MM`` folders of the range, when bodies are landed
    in such folders (the bound prunes folders before anything is parsed)."""
    if "month" not in bodies.columns:
        return bodies
    for bound, keep in ((start_month, F.col("month").__ge__), (end_month, F.col("month").__le__)):
        if bound:
            bodies = bodies.filter(keep(F.lit(bound.replace("/", "-"))))
    return bodies.drop("month")


def players_online_status(snapshots: DataFrame, users: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Status snapshot per user plus the time of the check."""
    df = restrict_to_users(snapshots, users) if users is not None else snapshots
    return df.select("username", "onlineStatus", "lastLoginDate",
                     F.current_timestamp().alias("check_time"))


def write_nested(store: TableStore, table: str, df: DataFrame, disposition: str, load_id: str) -> tuple[dict[str, Change], int]:
    """Write records as unpublished versions: structs become columns, names
    snake_case, every row gets its load and row id, and every list column
    becomes a table of its own (``<table>__<column>``: parent's row id,
    position, the element's fields), to any depth. Returns the changes and
    the rows of ``table``."""
    seen = Observation(f"nested_{uuid.uuid4().hex[:8]}")
    rows = add_lineage(normalize_names(flatten(df)), load_id)
    ch = store.write_version(table, rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    n = int(seen.get["rows"])
    lists = [f.name for f in ch.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not lists:
        return {table: Change(disposition, ch.path, ch.schema)}, n
    written = store.read_version(ch)   # fixed row ids: the children refer to them
    ch = store.write_version(table, written.drop(*lists))
    changes = {table: Change(disposition, ch.path, ch.schema)}
    for c in lists:
        child = child_rows(written, "_row_id", c, position="_list_idx").withColumnRenamed("_row_id", "_parent_id")
        changes.update(write_nested(store, f"{table}__{c}", child, disposition, load_id)[0])
    return changes, n


def load_resource(store: TableStore, table: str, df: DataFrame, disposition: str) -> LoadInfo:
    """Write a resource and the tables of its lists, replace or append
    (schema growth on append), in one commit."""
    load_id = new_load_id()
    changes, rows = write_nested(store, table, df, disposition, load_id)
    store.commit(changes)
    return LoadInfo(table, load_id, rows, disposition)


def run_json_source(store: TableStore, landed: dict[str, str | list[str] | DataFrame], users: Iterable[str] | DataFrame,
                    start_month: str | None = None, end_month: str | None = None,
                    resources: Iterable[str] | None = None) -> dict[str, LoadInfo]:
    """Load the chosen resources of the landed JSON for the tracked users.

    ``landed`` names folders (or frames) for ``profiles``, ``archives``,
    ``bodies`` and ``status``. Without ``resources`` all but the archive
    listing are loaded. Profiles and listing replace their tables, games
    (archives in the month range and not loaded before) and status append."""
    def source(name: str) -> DataFrame:
        at = landed[name]
        return at if isinstance(at, DataFrame) else read_landed(store.spark, at)

    builders = {
        "players_profiles": lambda: load_resource(store, PROFILES_TABLE, players_profiles(source("profiles"), users), "replace"),
        "players_archives": lambda: load_resource(store, ARCHIVES_TABLE, players_archives(source("archives"), users), "replace"),
        "players_games": lambda: load_games_incrementally(store, source("archives"), source("bodies"), users, start_month, end_month),
        "players_online_status": lambda: load_resource(store, STATUS_TABLE, players_online_status(source("status"), users), "append"),
    }
    chosen = select_resources(builders, resources, deselected=("players_archives",))
    return {name: build() for name, build in chosen.items()}
