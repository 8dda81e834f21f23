"""Operator 12: document fingerprints by a homomorphic multiset hash (native expressions only).

A text is the multiset of its paragraphs (the non-empty lines). Every
paragraph is hashed to a wide vector, and a text's vector is the sum of its
paragraphs' vectors, lane by lane, modulo powers of two:

* ``DENSE`` lanes modulo 2^32 hold 32 bits each of the paragraph's SHA-256
  digest: equal multisets have equal sums, others practically never;
* ``SKETCH`` lanes modulo 2^16 count the paragraph's sentences: each adds 1
  or -1 to the one lane that its hash names. The inner product of two such
  vectors estimates the sentences two texts share (error about
  1 / sqrt(SKETCH) of their number), which gives the likeness.

So the order of paragraphs never counts, the vector of two texts together is
the sum of theirs (``plus``), and a paragraph leaves by subtraction
(``minus``): an edit costs the hashes of the paragraphs it touches.

Defined cases: a NULL text counts as an empty one, whose vector is all zeros;
empty lines are no paragraphs; a paragraph without sentence ends is one
sentence; NULL ids come first; rows of one id follow each other by a hash of
the text, then by the text; of rows equal in id and text each is the next
one's next document; a single row is its own next document; an empty table
gives no rows; other columns of the input are ignored. Texts may have any
length: a text is one row of its task, never more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import bounded, materialise

DENSE, SKETCH = 8, 128
_MASK32, _MASK16 = (1 << 32) - 1, (1 << 16) - 1


def _let(value: Column, of) -> Column:
    """``of(value)`` with the value computed once, however often (or in
    whichever inner lambda) it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(x) > 0)


def vector(lines: Column) -> Column:
    """The summed vector of an array of paragraphs: DENSE + SKETCH longs."""
    digests = F.transform(lines, lambda x: F.sha2(x, 256))
    dense = _let(digests, lambda all_: F.transform(F.sequence(F.lit(0), F.lit(DENSE - 1)), lambda lane: F.aggregate(
        all_, F.lit(0).cast("long"),
        lambda a, h: (a + F.conv(h.substr(lane * 8 + 1, F.lit(8)), 16, 10).cast("long")).bitwiseAND(F.lit(_MASK32)))))
    sentences = F.filter(F.flatten(F.transform(lines, lambda x: F.split(x, "[.!?]+"))), lambda s: F.length(F.trim(s)) > 0)
    marks = F.transform(sentences, lambda s: F.pmod(F.conv(F.substring(F.md5(s), 1, 6), 16, 10).cast("int"), F.lit(2 * SKETCH)))
    # sorted together with one of each mark, the place where a mark ends tells how often it is there
    placed = F.sort_array(F.concat(marks, F.sequence(F.lit(0), F.lit(2 * SKETCH - 1))))
    ends = _let(placed, lambda m: F.array_compact(F.transform(m, lambda x, i: F.when(x != F.coalesce(F.get(m, i + 1), F.lit(-1)), i))))
    counted = _let(ends, lambda e: F.transform(F.sequence(F.lit(0), F.lit(SKETCH - 1)), lambda lane: (
        F.get(e, 2 * lane + 1) - 2 * F.get(e, 2 * lane) + F.coalesce(F.get(e, 2 * lane - 1), F.lit(-1))).cast("long").bitwiseAND(F.lit(_MASK16))))
    return F.concat(dense, counted)


def _lanes(x: Column, y: Column, of) -> Column:
    """Lane-wise ``of``, modulo the lane's power."""
    return F.transform(F.zip_with(x, y, of), lambda v, i: F.when(i < DENSE, v.bitwiseAND(F.lit(_MASK32)))
                       .otherwise(v.bitwiseAND(F.lit(_MASK16))))


def plus(x: Column, y: Column) -> Column:
    """Vector of both multisets together (insertion)."""
    return _lanes(x, y, lambda a, b: a + b)


def minus(x: Column, y: Column) -> Column:
    """Vector of what is left when ``y``'s paragraphs leave ``x`` (deletion)."""
    return _lanes(x, y, lambda a, b: a - b)


def to_text(x: Column) -> Column:
    """The vector in hexadecimal: 8 digits a dense lane, 4 a sketch lane."""
    return F.array_join(F.transform(x, lambda v, i: F.lower(F.lpad(F.hex(v), F.when(i < DENSE, 8).otherwise(4), F.lit("0")))), "")


def likeness(x: Column, y: Column) -> Column:
    """0 to 1: the estimated shared sentences over the larger text's; 1 for equal vectors."""
    def signed(v):
        return F.transform(F.slice(v, DENSE + 1, SKETCH), lambda a: F.when(a >= 1 << 15, a - (1 << 16)).otherwise(a))

    def product(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0).cast("long"), lambda s, v: s + v)

    def share(a, b):
        return _let(F.greatest(product(a, a), product(b, b)), lambda larger: F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), F.coalesce(product(a, b) / F.when(larger > 0, larger), F.lit(0.0)))))

    return F.when(x == y, F.lit(1.0)).otherwise(_let(signed(x), lambda a: _let(signed(y), lambda b: share(a, b))))


def _slice_of(key: Column, bounds: list) -> Column:
    """Index of the last bound that is not above ``key`` (binary search)."""
    array = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for n, t, v in zip("zih", ("int", "long", "long"), b)]) for b in bounds])
    steps = max(1, len(bounds).bit_length())

    def halve(span, _):
        mid = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        low = F.get(array, mid) <= key
        return F.struct(F.when(low, mid).otherwise(span["lo"]).alias("lo"), F.when(low, span["hi"]).otherwise(mid).alias("hi"))

    first = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, halve)["lo"]


def sliced(docs: DataFrame, slice_chars: int = 64 << 20) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text, slice, guest, key) in slices whose rows, in the order of
    ``in_slice()``, are followed by their next ones; and the rows that are
    their own next ones, (doc_id, text), or None if there are none.

    Range bounds of the (small) keys cut the rows into slices; the texts are
    shuffled once, by slice. The first row of a slice is sent to the slice
    before it too, as a guest, so every row finds its next one in its slice.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    d = d.select("*", F.struct(F.when(F.col("doc_id").isNull(), 0).otherwise(1).alias("z"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("i"),
                               F.xxhash64("text").alias("h")).alias("key"))
    keys = materialise(d.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("long")).alias("chars")), "text-keys")
    total = keys.agg(F.sum("chars"), F.max("rows")).first()
    if total[0] is None:
        return d.select("doc_id", "text", F.lit(0).alias("slice"), F.lit(False).alias("guest"), "key"), None
    n = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total[0] // slice_chars + 1)
    firsts = keys.repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key"))
    bounds = sorted(tuple(r["key"]) for r in firsts.collect())  # one key a slice
    alone, copies = d, None
    if total[1] > 1:  # rows equal in id and text: one of them meets the next document, the others each other
        same = bounded(keys.where("rows > 1").select(F.col("key").alias("_key"), "rows"), "text-copies")
        one = materialise(d.join(same, F.col("key") == F.col("_key")).groupBy("doc_id", "text", "key").agg(F.first("rows").alias("rows")), "text-copied")
        copies = one.select("doc_id", "text", F.explode(F.sequence(F.lit(2), F.col("rows").cast("int")))).drop("col")
        alone = d.join(same, F.col("key") == F.col("_key"), "left_anti").unionByName(one.drop("rows"))
    d = alone.select("*", _slice_of(F.col("key"), bounds).alias("slice"))
    leads = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, t, v in zip("zih", ("int", "long", "long"), b)]) for b in bounds])
    before = F.pmod(F.col("slice") - 1, F.lit(len(bounds)))
    to = F.when(F.get(leads, F.col("slice")) == F.col("key"), F.array(F.struct(F.col("slice").alias("s"), F.lit(False).alias("guest")),
                                                                     F.struct(before.alias("s"), F.lit(True).alias("guest"))))
    d = d.select("doc_id", "text", "key", F.explode(F.coalesce(to, F.array(F.struct(F.col("slice").alias("s"), F.lit(False).alias("guest"))))).alias("at"))
    return d.select("doc_id", "text", F.col("at.s").alias("slice"), F.col("at.guest").alias("guest"), "key"), copies


def in_slice():
    return Window.partitionBy("slice").orderBy("guest", "key")


def _edited(d: DataFrame) -> DataFrame:
    """Vectors of the text (``own``) and of the edited text (``edited``) for
    rows with ``text`` and ``next_text``."""
    kept_columns = [c for c in d.columns if c not in ("text", "next_text")]
    d = d.select("*", F.length("text").alias("n")).select("*", F.expr("cast(n div 2 AS int)").alias("m"))
    d = d.select(*kept_columns, F.col("n").cast("long").alias("n_chars"), F.split("text", "\n").alias("lines"),
                 F.expr("substring(text, 1, n - m)").alias("head"), F.expr("substring(next_text, 1, m)").alias("new"))
    d = d.select("*", (F.size(F.split("head", "\n")) - 1).alias("whole"))
    # whole lines of the head stay; the line that the cut is in and all below it leave, the edited rest comes
    filled = lambda a: F.filter(F.expr(a), lambda x: F.length(x) > 0)
    d = d.select(*kept_columns, "n_chars", F.sha2(F.concat("head", "new"), 256).alias("edited_sha256"),
                 vector(filled("slice(lines, 1, whole)")).alias("kept"), vector(filled("slice(lines, whole + 1, size(lines))")).alias("gone"),
                 vector(paragraphs(F.concat(F.substring_index("head", "\n", -1), F.col("new")))).alias("come"))
    d = d.select("*", plus(F.col("kept"), F.col("gone")).alias("own"))
    return d.select(*kept_columns, "n_chars", "edited_sha256", "own", plus(minus(F.col("own"), F.col("gone")), F.col("come")).alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per document; the edited text's vector
    comes from the text's by deletion and insertion."""
    rows, copies = sliced(docs)
    d = _edited(rows.withColumn("next_text", F.lead("text").over(in_slice())))
    d = d.withColumn("next", F.lead("own").over(in_slice())).where(~F.col("guest")).drop("slice", "guest", "key")
    if copies is not None:
        d = d.unionByName(_edited(copies.withColumn("next_text", F.col("text"))).withColumn("next", F.col("own")))
    return d.select("doc_id", "n_chars", "edited_sha256", to_text(F.col("own")).alias("fingerprint"),
                    to_text(F.col("edited")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))


def _sql_vector(lines: str) -> str:
    sentences = (f"list_filter(flatten(list_transform({lines}, lambda x: string_split_regex(x, '[.!?]+'))), lambda s: trim(s, ' ') <> '')")
    marks = f"list_transform({sentences}, lambda s: CAST('0x' || substr(md5(s), 1, 6) AS BIGINT) % {2 * SKETCH})"
    return f"""list_concat(
      list_transform(range({DENSE}), lambda l: CAST(coalesce(list_sum(list_transform({lines}, lambda x:
          CAST('0x' || substr(sha256(x), CAST(8 * l + 1 AS INT), 8) AS BIGINT))), 0) % 4294967296 AS BIGINT)),
      list_transform(range({SKETCH}), lambda l: CAST((len(list_filter({marks}, lambda m: m = 2 * l + 1))
          - len(list_filter({marks}, lambda m: m = 2 * l))) & 65535 AS BIGINT)))"""


def _sql_text(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x, i: format(CASE WHEN i <= {DENSE} THEN '{{:08x}}' ELSE '{{:04x}}' END, x)), '')"


def _sql_likeness(x: str, y: str) -> str:
    def signed(v):
        return f"list_transform({v}[{DENSE + 1}:], lambda a: CASE WHEN a >= 32768 THEN a - 65536 ELSE a END)"

    def product(a, b):
        return f"list_sum(list_transform(list_zip({signed(a)}, {signed(b)}), lambda z: z[1] * z[2]))"

    larger = f"greatest({product(x, x)}, {product(y, y)})"
    return (f"CASE WHEN {x} = {y} THEN 1.0::DOUBLE WHEN {larger} = 0 THEN 0.0::DOUBLE "
            f"ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, CAST({product(x, y)} AS DOUBLE) / CAST({larger} AS DOUBLE))) END")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER w, first_value(t) OVER (ORDER BY doc_id NULLS FIRST, t)) AS u
      FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, t)),
e AS (SELECT *, substring(t, 1, n - n // 2) || substring(u, 1, n // 2) AS e FROM n),
l AS (SELECT doc_id, n, sha256(e) AS edited_sha256, {", ".join(f"list_filter(string_split({c}, chr(10)), lambda x: x <> '') AS l{c}" for c in "teu")} FROM e),
v AS (SELECT doc_id, n, edited_sha256, {", ".join(f"{_sql_vector('l' + c)} AS v{c}" for c in "teu")} FROM l)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, edited_sha256, {_sql_text("vt")} AS fingerprint, {_sql_text("ve")} AS edited_fingerprint,
       {_sql_likeness("vt", "ve")} AS near_edited, {_sql_likeness("vt", "vu")} AS near_next FROM v
"""
