"""Operator 9: quality rules as a short-circuit cascade (native expressions only).

Every rule is a Boolean SQL expression over a few statistics of the text.
A bounded sample of texts gives each rule's cost and its rejection rate; a
rule is timed from the text on, with the statistics it needs and no others.
Rules are then tried in the order of rejection per cost inside one CASE
expression, which Spark evaluates lazily: a row rejected by an early rule
never pays for a later one. The order changes cost, never a verdict. The
statistics that are part of the result are made for every row; those of the
method alone (exclamations, capitals, digits) stand in the rules themselves,
so rows rejected before do not pay for them.

Defined cases: a NULL text counts as an empty one; empty texts have no words
and fail the base rule; NULL and repeated ids pass through; other columns of
the input are ignored (``text_statistics``) or kept (``quality_cascade``).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import SPACE, materialise

SYMBOLS = "#*$%&|<>"
#: Rules of the method: name -> SQL condition that rejects a text.
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "long_words": "word_chars > 14 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "repeated_lines": "10 * n_dup_lines > 4 * n_lines",
    "exclamation": "5 * (length(text) - length(translate(text, '!', ''))) > n_words",
    "capitals": "2 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > word_chars",
    "digits": "4 * (length(text) - length(translate(text, '0123456789', ''))) > word_chars",
}
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
#: More repeated windows than this are found by sorting instead of by search; both ways agree.
FEW = 16


def _covered(positions: Column) -> Column:
    """Words covered by windows of three that start at the sorted positions."""
    steps = F.transform(positions, lambda x, k: F.least(F.lit(3), x - F.coalesce(F.get(positions, k - 1), x - 3)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words): one row per input row, a plain projection."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("text"))
    d = d.select("*", F.array_remove(F.split("text", SPACE + "+"), "").alias("_w"),
                 F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("_l"))
    n = F.size("_w")
    d = d.select("*", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).alias("_t"))
    d = d.select("*", F.when(F.size(F.array_distinct("_t")) < F.size("_t"), F.sort_array("_t")).alias("_s"))
    d = d.select("*", F.array_distinct(F.filter("_s", lambda x, i: x == F.get("_s", i - 1))).alias("_r"))
    few = F.filter(F.sequence(F.lit(0), F.size("_t") - 1), lambda i: F.array_contains(F.col("_r"), F.get("_t", i)))
    d = d.select("*", F.when(F.size("_r") > FEW, F.sort_array(
        F.transform("_t", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_p"))
    many = F.sort_array(F.transform(
        F.filter("_p", lambda x, k: F.coalesce(x["h"] == F.get("_p", k - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get("_p", k + 1)["h"], F.lit(False))), lambda x: x["i"]))
    d = d.select("*", F.when(F.size("_r") > FEW, many).when(F.size("_r") > 0, few).alias("_c"))
    # always true, but not deterministic: keeps later filters from being pushed
    # below, which would repeat the whole chain of expressions in each of them
    always = F.monotonically_increasing_id() >= 0
    return d.select(
        "doc_id", "text", n.cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(always, F.coalesce(_covered(F.col("_c")), F.lit(0)).cast("long")).alias("n_repeat_words"))


def rank_rules(texts: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = 2000) -> list[tuple[str, float, float]]:
    """(rule, seconds, rejected share) by falling rejection per second, from a
    sample of about ``sample_rows`` texts (documented bound, seeded). Shares
    are those among the rows that pass the base rule, which comes first."""
    part = min(1.0, sample_rows / max(1, texts.count()))
    sample = text_statistics(materialise(texts.select("doc_id", "text").sample(fraction=part, seed=11), "rules"))
    share = sample.where(f"NOT ({BASE})").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(c)).alias(r) for r, c in rules.items()]).first()

    def seconds(condition: str) -> float:
        took = []
        for _ in range(2):  # the second run finds its code compiled
            t = time.perf_counter()
            sample.agg(F.count_if(F.expr(condition))).first()  # makes only the statistics of the condition
            took.append(time.perf_counter() - t)
        return min(took)

    floor = seconds("doc_id IS NULL")
    cost = {r: max(seconds(c) - floor, 1e-4) for r, c in rules.items()}
    found = [(r, cost[r], (share[r] or 0) / max(1, share["n"])) for r in rules]
    return sorted(found, key=lambda x: (-x[2] / x[1], x[1], x[0]))


def cascade(order: list[str], rules: dict[str, str] = RULES) -> Column:
    """The first rule in ``order`` that rejects the row, else NULL; later
    rules are not evaluated (CASE is lazy)."""
    out = F.when(F.expr(BASE), F.lit("base"))
    for r in order:
        out = out.when(F.expr(rules[r]), F.lit(r))
    return out


def quality_cascade(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The statistics, ``base_failed``, ``rejected_by`` (depends on the rule
    order, so on timing) and ``kept`` (does not)."""
    small = docs.select("doc_id", "text")
    order = [r for r, _, _ in rank_rules(small, rules, sample_rows)]
    judged = text_statistics(small).select("*", cascade(order, rules).alias("rejected_by"))
    return judged.select("*", F.expr(BASE).alias("base_failed"), F.col("rejected_by").isNull().alias("kept")).drop("text")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c >= 2),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY rid),
s AS (SELECT doc_id, t, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
v AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
        (10 * n_symbols > n_words OR word_chars > 14 * n_words OR word_chars < 2 * n_words
         OR 10 * n_dup_lines > 4 * n_lines
         OR 5 * (length(t) - length(replace(t, '!', ''))) > n_words
         OR 2 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > word_chars
         OR 4 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > word_chars) AS rejected FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT rejected) AS kept FROM v
"""
