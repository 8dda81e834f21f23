"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.session import new_scratch_dir

#: A word of the contracts that speak of white space: a run of anything else.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str, **options: object) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: what
    follows no longer depends on the lineage (a lost executor costs only its
    own tasks) and sees one fixed version of nondeterministic columns."""
    spark = df.sparkSession
    path = new_scratch_dir(spark, tag)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, tag: str, max_rows: int = 500_000) -> DataFrame:
    """``df`` written, and marked for a broadcast only if it has at most
    ``max_rows`` (short) rows; beyond that Spark joins it by shuffling."""
    df = materialise(df, tag)
    return F.broadcast(df) if df.count() <= max_rows else df


def slices(batches: Iterable, rows: int = 1000) -> Iterator:
    """Arrow batches in pieces, so that no more texts than these are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; a NULL
    id is never held out (and has no label)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int,
                    max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` rows of labelled documents
    that are not held out; the bound makes the broadcasts below safe. Ids are
    chosen by a hash, so reruns agree. If ids repeat so often that their rows
    pass the bound, each id gives at most an equal number of distinct texts."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id"), modulus, remainder))
              .select("doc_id", F.col(label).alias("label")).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    if rows.count() <= max_rows:
        return rows
    key, text = ["doc_id", "label"], F.xxhash64("text", F.lit(5))
    sizes = rows.select(*key, text.alias("_h")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    sizes = materialise(sizes, "sample-sizes")  # at most max_rows
    held = sorted(r[0] for r in sizes.select("_n").collect())
    each, left = 0, max_rows
    for i, n in enumerate(held):  # as many from each id as fit if those with fewer give all
        each = left // (len(held) - i)
        if n > each:
            break
        left -= n
        each = n
    # a few times what is needed by the hash of the text, so that no id's rows fill the window
    near = F.pmod(text, F.lit(1 << 30)) / float(1 << 30) < F.lit(4.0 * (each + 8)) / F.col("_n")
    rows = rows.join(F.broadcast(sizes), key).where(near).select("doc_id", "text", "label").dropDuplicates(["doc_id", "text", "label"])
    order = Window.partitionBy(*key).orderBy(text, "text")
    return rows.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= each).drop("_k")


def sql_crc32(text: str) -> str:
    """DuckDB expression for the unsigned crc32 of a text's UTF-8 bytes (DuckDB
    has no such function); the query must also read ``crc_table``, the CTE below."""
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: CAST('0x' || substr(hex({text}), 2 * i - 1, 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc_t[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), CAST(4294967295 AS BIGINT))"


SQL_CRC_TABLE = """crc_table AS (SELECT list(x ORDER BY i) AS crc_t FROM (SELECT i, list_reduce(
    list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT) FOR k IN range(8)]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS x
    FROM range(256) AS r(i)))"""
