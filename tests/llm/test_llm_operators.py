import base64
import hashlib
import random
import zlib

import llm_models as models
import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import (common, decontamination, language_id, mixing, ngram_join, quality_classifier, quality_rules, sharding,
                          token_counts, toxicity, warc)

DOCS = "doc_id bigint, text string, lang string, source string"


@pytest.fixture
def frame(spark):
    """Rows of a small table, with columns whose names clash with those the operators use."""
    def make(rows):
        df = spark.createDataFrame(rows, DOCS)
        for name in ("size", "score", "uid", "_w", "tie", "n", "shard", "block"):
            df = df.withColumn(name, F.lit("other"))
        return df

    return make


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows(rng):
    """Nulls, empty, blank, one-word, repeated, very long and plain texts."""
    base = words(rng, 300)
    rows = [(None, None), (1, None), (2, ""), (3, "  \t\n"), (4, "Word"), (4, "Word"), (5, "WORD"), (6, "a b c"), (7, "a b c d"),
            (8, " ".join(words(rng, 30_000, 5000))), (None, " ".join(base)), (9, " ".join(base)), (10, "x y z " * 40), (11, "émile Ünï 日本 語")]
    for i in range(12, 40):  # near copies at all distances
        own = list(base)
        for _ in range(rng.randrange(0, 24)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(99)}"
        rows.append((i, " ".join(own)))
    return rows + [(i, " ".join(words(rng, rng.randrange(1, 120)))) for i in range(40, 70)]


# 9: quality rules

def test_quality_statistics_follow_the_model(frame):
    rng = random.Random(1)
    rows = odd_rows(rng) + [(100, "a line #1\nb\n\na line #1\nb\n b"), (101, "one two three one two three " * 9), (102, "\n\n"),
                            (103, " ".join(f"k{i % 40}" for i in range(400)))]
    got = quality_rules.text_statistics(frame([(i, t, None, None) for i, t in rows])).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    want = [(i, *models.statistics(t)) for i, t in rows if i != 8]
    assert sorted(map(str, (tuple(r) for r in got if r[0] != 8))) == sorted(map(str, want))


def test_quality_order_does_not_change_verdicts(frame):
    rows = [(i, t, None, None) for i, t in odd_rows(random.Random(2))]
    stats = quality_rules.text_statistics(frame(rows))
    names = list(quality_rules.RULES)
    both = stats.select(quality_rules.cascade(names).isNull().alias("a"), quality_rules.cascade(names[::-1]).isNull().alias("b"))
    assert both.where("a <> b").count() == 0
    out = quality_rules.quality_cascade(frame(rows), sample_rows=20)
    assert out.where("kept AND base_failed").count() == 0 and out.count() == len(rows)
    assert quality_rules.quality_cascade(frame([])).count() == 0


def test_quality_rejected_rows_pay_for_no_later_rule(frame):
    rules = {"cheap": "n_words < 100", "costly": "raise_error(concat('paid by ', doc_id)) IS NOT NULL"}
    rows = [(n, " ".join(f"k{i}" for i in range(n)), None, None) for n in range(40, 100)]
    rejected = quality_rules.text_statistics(frame(rows)).select(quality_rules.cascade(["cheap", "costly"], rules).alias("by"))
    assert sorted({r["by"] for r in rejected.collect()}) == ["base", "cheap"]
    survivor = frame([(7, " ".join(f"k{i}" for i in range(300)), None, None)])
    with pytest.raises(Exception, match="paid by 7"):
        quality_rules.text_statistics(survivor).select(quality_rules.cascade(["cheap", "costly"], rules)).collect()


def test_quality_costs_are_those_of_the_rules_own_statistics(frame):
    stats = quality_rules.text_statistics(frame([(1, "a b c", None, None)]))
    plan = lambda rule: stats.agg(F.count_if(F.expr(rule)))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan(quality_rules.RULES["symbols"]) and "xxhash64" in plan(quality_rules.BASE)
    assert "split" not in plan(quality_rules.RULES["digits"].replace("word_chars", "length(text)"))
    docs = frame([(i, "word # " * 200 if i % 2 else " ".join(f"w{i}x{k}" for k in range(80)), None, None) for i in range(60)])
    ranked = quality_rules.rank_rules(docs, {"never": "n_words < 0", "often": "10 * n_symbols > n_words", **quality_rules.RULES})
    assert len(ranked) == len(quality_rules.RULES) + 2 and all(cost > 0 for _, cost, _ in ranked)


# 7: n-gram join

@pytest.mark.parametrize("n,order", [(3000, "random"), (3000, "sorted"), (40, "star")])
def test_components_settle_in_few_rounds(spark, monkeypatch, n, order):
    """Chains in any order of their ids, beside a few pairs."""
    ids = list(range(n))
    if order == "random":
        random.Random(9).shuffle(ids)
    edges = [(ids[0], ids[i]) for i in range(1, n)] if order == "star" else list(zip(ids, ids[1:]))
    edges += [(n + 1, n + 2), (n + 5, n + 4), (n + 4, n + 5), (n + 9, n + 9)]
    rounds, real = [], ngram_join.materialise
    monkeypatch.setattr(ngram_join, "materialise", lambda df, tag, **o: rounds.append(tag) or real(df, tag, **o))
    got = {r["uid"]: r["comp"] for r in ngram_join.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 0 for i in range(n)}, n + 1: n + 1, n + 2: n + 1, n + 4: n + 4, n + 5: n + 4}
    assert {k: v for k, v in got.items() if k != n + 9} == want
    print(order, rounds.count("cc-links"), "rounds,", len(rounds), "tables")
    assert rounds.count("cc-links") < 20


def test_a_chain_of_near_copies_is_one_component(spark):
    """Each text is linked with the next one only."""
    rng = random.Random(10)
    stream = [f"w{k}" for k in range(300 * 6 + 100)]
    rows = [(i, " ".join(stream[6 * i:6 * i + 100])) for i in range(300)]
    rng.shuffle(rows)
    out = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["component_id"] for r in out.collect()} == {0}


def test_components_of_no_edges(spark):
    assert ngram_join.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("n,percent,tile", [(4, 85, 512), (5, 80, 8)])
def test_components_follow_all_pairs(frame, n, percent, tile):
    rows = odd_rows(random.Random(3))
    out = ngram_join.jaccard_components(frame([(i, t, None, None) for i, t in rows]), n, percent, tile)
    got = [tuple(r) for r in out.select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, models.components(rows, n, percent)))
    firsts = out.where("n_shingles > 0").groupBy("component_id").agg(F.count_if("is_first").alias("n")).collect()
    assert {r["n"] for r in firsts} == {1}


def test_components_need_more_than_the_first_member(frame):
    """A chain whose ends do not link, and texts that share one long passage but do not link."""
    rng = random.Random(4)
    base, rows = words(rng, 200, 10_000), []
    for i in range(30):  # each step changes one word more
        base[(7 * i) % 200] = f"c{i}"
        rows.append((100 - i, " ".join(base)))
    passage = " ".join(words(rng, 60, 10_000))
    rows += [(200 + i, passage + " " + " ".join(words(rng, 30, 10_000))) for i in range(40)]
    got = ngram_join.jaccard_components(frame([(i, t, None, None) for i, t in rows]), tile_rows=7)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted(models.components(rows, 4, 85))


@pytest.mark.parametrize("percent,sizes", [(76, [(61, 80)]), (70, [(5, 7), (22, 29), (70, 100), (350, 500)]), (50, [(3, 6), (10, 20), (33, 65), (200, 400)])])
def test_components_of_sets_bands_apart(frame, percent, sizes):
    rows = odd_rows(random.Random(8))
    for k, (small, large) in enumerate(sizes):
        own = [f"s{k}x{i}" for i in range(large)]
        rows += [(100 + k, " ".join(own[:small])), (200 + k, " ".join(own))]
    got = ngram_join.jaccard_components(frame([(i, t, None, None) for i, t in rows]), 1, percent)
    got = [tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, models.components(rows, 1, percent)))
    assert all((200 + k, large, 100 + k) in got for k, (_, large) in enumerate(sizes))


def test_sets_that_can_link_share_a_tile():
    for percent in (10, 50, 70, 76, 77, 85):
        bands = ngram_join.Bands(percent)
        for small in [*range(1, 400), 10**4, 10**6 + 1]:
            for large in {small * 100 // percent, (small + small * 100 // percent) // 2} - {small}:
                assert {t[0] for t in bands.tiles(small)} & {t[0] for t in bands.tiles(large)}, (percent, small, large)


def test_components_of_an_empty_table(frame):
    assert ngram_join.jaccard_components(frame([])).count() == 0


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 30, 900, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 1 << 63, n // 2 + 1).astype(np.uint64)]))
        x, y = ngram_join.parity_bitmap(a), ngram_join.parity_bitmap(b)
        flips = int(np.bitwise_count(ngram_join._fold(x, len(y)) ^ ngram_join._fold(y, len(x))).sum())
        assert flips <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_bucket():
    rng, bands = np.random.default_rng(6), ngram_join.Bands(85)
    for _ in range(300):
        n = int(rng.integers(7, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, 1 + n // 20).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            assert np.intersect1d(ngram_join.bucket_keys(a, bands), ngram_join.bucket_keys(b, bands)).size


# 10: decontamination

def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").withColumn("block", F.lit("other"))


def planted(rng):
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate((13, 40, 25, 5, 1, 14))] + [(9, None), (10, " . "), (None, " ".join(words(rng, 20)))]
    items.append((11, items[1][1]))
    rows = [(None, None), (1, ""), (2, " ".join(words(rng, 2000))), (2, " ".join(words(rng, 20)))]
    for k in range(3, 40):
        own = words(rng, rng.randrange(0, 200))
        passage = (rng.choice(items)[1] or "").upper().split()
        at = rng.randrange(len(own) + 1)
        cut = rng.randrange(len(passage) + 1)
        rows.append((k, " ,".join(own[:at] + passage[cut // 2:] + own[at:])))
    return rows, items


@pytest.mark.parametrize("block_words", [50, 1_000_000])
def test_contamination_follows_the_model(spark, frame, block_words):
    rows, items = planted(random.Random(7))
    out = decontamination.contamination(frame([(i, t, None, None) for i, t in rows]), bench(spark, items), block_words=block_words)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(map(str, got)) == sorted(str((i, *models.contamination(t, items))) for i, t in rows)


def test_matches_do_not_depend_on_item_batches(spark, frame):
    rows, items = planted(random.Random(8))
    index = decontamination.build_index(frame([(i, t, None, None) for i, t in rows]), 500)
    one, many = (decontamination.phrase_matches(index, bench(spark, items), batch_windows=n) for n in (10**6, 20))
    n = lambda df: {(r["block"], r["doc"]): (r["n"], sorted(r["items"])) for r in df.select(
        "block", "doc", decontamination._span_words(F.col("spans")).alias("n"), "items").collect()}
    assert n(one) == n(many) and n(one)
    near = [sorted(map(str, decontamination.proximity_matches(index, bench(spark, items), 5, k).collect())) for k in (10**6, 2)]
    assert near[0] == near[1] and near[0]


def test_contamination_counts_near_items(spark, frame):
    rng = random.Random(10)
    rows = [(None, None), (1, ""), *((i, " ".join(words(rng, rng.randrange(80), 9))) for i in range(2, 40))]
    items = [(1, "w1 w2 w3"), (1, "w4 w5"), (2, "w4 W4 w5"), (3, "w99 w1"), (None, "w7"), (4, "w0 w1 w2 w3 w4 w5"), (5, None), (6, " . ")]
    out = decontamination.contamination(frame([(i, t, None, None) for i, t in rows]), bench(spark, items), block_words=300, slop=2)
    got = [(r["doc_id"], r["n_words"], r["n_near"]) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(str((i, len((t or "").split()), models.near_items(t, items, 2))) for i, t in rows)
    assert len({n for _, _, n in got}) > 2


def test_contamination_of_empty_tables(spark, frame):
    none = decontamination.contamination(frame([(1, "a b", None, None)]), bench(spark, []), slop=5).collect()
    assert [r["n_near"] for r in none] == [0]
    assert decontamination.contamination(frame([]), bench(spark, [(1, "a b")])).count() == 0
    out = decontamination.contamination(frame([(1, "a b", None, None)]), bench(spark, [])).collect()
    assert [(r["n_hit"], r["contaminated"], r["items_sha256"]) for r in out] == [(0, False, hashlib.sha256(b"").hexdigest())]


def test_proximity_finds_all_words_near_each_other(spark, frame):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, 120, 12))) for i in range(12)]
    items = [(1, "w1 w2 w3"), (2, "w4 w4 w5"), (3, "w99 w1"), (4, "w7")]
    index = decontamination.build_index(frame([(i, t, None, None) for i, t in rows]), 200)
    docs = {(r["block"], r["doc"]): r["doc_id"] for r in decontamination.indexed_documents(index).collect()}
    got = {(docs[r["block"], r["doc"]], r["item_id"], r["start"], r["end"]) for r in
           decontamination.proximity_matches(index, bench(spark, items), slop=2).collect()}
    want = set()
    for i, t in rows:
        own = t.split()
        for item, body in items:
            need, spans = set(body.split()), []
            for s in range(len(own)):
                e = next((e for e in range(s + 1, len(own) + 1) if need <= set(own[s:e])), None)
                if e and e - s <= len(need) + 2:
                    spans.append((s, e))
            want |= {(i, str(item), s, e) for s, e in spans if not any((a, b) != (s, e) and s <= a and b <= e for a, b in spans)}
    assert got == want


# 2: mixing

def mixed_rows(rng):
    rows = [(i, " ".join(words(rng, rng.randrange(1, 60))), None, rng.choice(["a", "b", "b", "b", "C", None, "é"])) for i in range(400)]
    return rows + [(None, None, None, "a"), (1000, "", None, "b"), (1001, "x y", None, "z"), (1001, "x y", None, "z"), (1002, None, None, "empty")]


def test_mix_meets_targets(frame):
    rows = mixed_rows(random.Random(10))
    out = [r.asDict() for r in mixing.mix(frame(rows)).collect()]
    assert len(out) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(models.blank_words(t))
    want = models.targets(sizes)
    for s, target in want.items():
        own = [r for r in out if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= 5
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in out)
    again = [r.asDict() for r in mixing.mix(frame(rows).repartition(7)).collect()]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_of_an_empty_table(frame):
    assert mixing.mix(frame([])).count() == 0


# 4: sharding

def test_shards_are_even_and_keep_groups(frame):
    rng = random.Random(11)
    rows = [(i, f"text {i % 150 if i < 300 else i}", None, None) for i in range(500)] + [(None, None, None, None), (5007, "", None, None), (5007, "", None, None)]
    rows += [(1000 + i, "the hot text", None, None) for i in range(300)]
    out = [r.asDict() for r in sharding.shard_documents(frame(rows)).collect()]
    assert len(out) == len(rows)
    per = {}
    for r in out:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert set(per) == set(range(16)) and max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    text = dict((i, t) for i, t, _, _ in rows)
    groups = {}
    for r in out:
        assert r["size"] == len((text[r["doc_id"]] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode())
        groups.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert len(groups["the hot text"]) < 16  # no fewer than 10: pairs hold places in every shard
    pairs = [len(groups[f"text {k}"]) for k in range(150)]
    assert sum(p > 1 for p in pairs) <= 30  # random places would cut about 140 of them


@pytest.mark.parametrize("hot", [0, 1200])
def test_shards_keep_groups_when_every_row_is_linked(frame, hot):
    n = 3600
    text = {i: "the hot text" if i < hot else f"text {(i - hot) // 20}" for i in range(n)}
    out = sharding.shard_documents(frame([(i, t, None, None) for i, t in text.items()])).collect()
    groups, held = {}, [0] * 16
    for r in out:
        held[r["shard"]] += 1
        groups.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert len(out) == n and held == [n // 16] * 16
    assert sum(map(len, groups.values())) / len(groups) < 1.8  # random places: 11.6


def test_full_shards_swap_movers():
    share = sharding.accepted(np.array([[0, 8, 0], [0, 0, 8], [4, 0, 0]]), np.zeros(3))
    assert np.allclose(share, [1, 0.5, 0.5])
    assert np.allclose(sharding.accepted(np.array([[0, 8], [0, 0]]), np.array([0, 2])), [1, 0.25])


def test_shards_of_few_or_no_rows(frame):
    assert sharding.shard_documents(frame([])).count() == 0
    assert sorted(r["shard"] for r in sharding.shard_documents(frame([(1, "a", None, None), (2, "a", None, None)])).collect()) == [0, 1]


def test_shared_lines_link(spark):
    line = "a line that is quite long and stands in more than one of the documents of this table, twice"
    docs = spark.createDataFrame([(1, f"x\n{line}\n{line}"), (2, f"{line}\ny"), (3, "short\nshort"), (4, None)], "uid bigint, text string")
    assert sorted(r["uid"] for r in sharding.shared_line_links(docs).collect()) == [1, 2]


# 1, 3, 5: classifiers

def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("other"))


@pytest.mark.parametrize("hot_texts", [1, 3000])
def test_labelled_sample_is_bounded_in_rows(spark, hot_texts):
    docs = spark.createDataFrame([(i, f"text {i} {k}") for i in range(60) for k in range(2)] +
                                 [(77, f"hot {i % hot_texts}") for i in range(4000)], "doc_id bigint, text string")
    labels = labelled(spark, [(i, 1, 0) for i in [*range(60), 77]])
    sample = lambda n: [r["doc_id"] for r in common.labelled_sample(spark, docs, labels, "toxic", 10**9, 1, n).collect()]
    found = sample(200)
    assert len(found) == (121 if hot_texts == 1 else 200) and all(found.count(i) == 2 for i in range(60))
    found = sample(61)
    assert len(found) == 61 == len(set(found))
    assert len(sample(5000)) == 4120


def test_unlabelled_sample_is_bounded_in_rows(spark, frame, monkeypatch):
    collected, rows = [], quality_classifier._feature_rows
    monkeypatch.setattr(quality_classifier, "_feature_rows", lambda df: collected.append(rows(df)) or collected[-1])
    for i in range(6):  # by chance the repeated row is in the first draw or not
        docs = frame([(-1 - i, "the same again", None, None)] * 3000 + [(k, f"text {k} of many", None, None) for k in range(1000)])
        quality_classifier.train(docs, labelled(spark, [(k, 1, 0) for k in range(0, 1000, 9)]), 100, 1500)
    assert max(map(len, collected)) <= 3000 and max(map(len, collected)) > 1000


def clause_score(grammar, text):
    return sum(f * w for _, _, f, w in grammar.clause(text.split()))


def test_grammar_scores_clauses():
    g = toxicity.Grammar({"idiot": 2.0}, {"schwach": 1.0})
    assert clause_score(g, "you are an idiot") == clause_score(g, "idiot , you") == 3.0
    assert clause_score(g, "an idiot") == 2.0 and clause_score(g, "not an idiot") == 0.5
    assert clause_score(g, "she said idiot") == 2.0 * 0.5 * 1.5
    assert clause_score(g, "we will kill time") < clause_score(g, "we will kill you") == 2.0
    assert clause_score(g, "they kill you") < clause_score(g, "they will kill you")
    assert clause_score(g, "schwachkopf") == 1.0 and g.clause("a plain clause".split()) == []
    assert [(s, e) for s, e, _ in g.matches("All well. An idiot; fine")] == [(9, 18)]


def test_grammar_follows_the_model():
    rng, g = random.Random(31), toxicity.Grammar({"idiot": 2.0, "fool": 3.5}, {})
    pool = ["idiot", "fool", "kill", "burn", "you", "he", "not", "never", "said", "will", "shall", "a", "b", "c", "d"]
    for _ in range(3000):
        own = rng.choices(pool, k=rng.randrange(9))
        found = g.clause(own)
        got = [sum(f * w for _, x, f, w in found if x == kind) for kind in ("insult", "threat")]
        assert np.allclose(got, models.clause_scores(own, g.exact, g.threats, toxicity._CLASSES)), own


def test_toxicity_reads_clauses(spark, frame):
    rng, rows, labels = random.Random(5), [], []
    for i in range(600):
        kind = i % 6
        bad = ["you are a grimble", "we will zonk you", "grimble , you", None, None, None][kind]
        clean = ["we zonk the wood"] if kind == 3 else []
        rows.append((i, ". ".join([" ".join(words(rng, 9)), *([bad] if bad else clean), " ".join(words(rng, 9))]), None, None))
        labels.append((i, 1, int(bad is not None)))
    said = ["You are a grimble.", "You are not a grimble.", "She said you are a grimble.", "She said nobody is a grimble.",
            "I will zonk you.", "We zonk wood.", "I will never zonk you.", "The weather is fine."]
    tests = [(10_000 + i, t, None, None) for i, t in enumerate(said)]
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(frame(rows + tests), labelled(spark, labels)).collect()}
    plain, negated, reported, both, threat, harmless, never, fine = (got[10_000 + i] for i in range(len(said)))
    assert plain >= 0.5 and threat >= 0.5 and max(fine, harmless) < 0.5
    assert plain > reported > both and plain > negated > both and threat > never and threat > harmless


def test_coefficients_are_never_negative():
    rng = np.random.default_rng(4)
    x = np.abs(rng.normal(size=(400, 4)))
    y = (x @ [2.0, -3.0, 1.0, 0.0] + rng.normal(size=400) > 0).astype(float)
    w = toxicity.fit_logistic(x, y, np.array([0.5, 0.5, 0.5, 0.5, -1.0]))
    assert (w[:-1] >= 0).all() and w[1] == 0 and w[0] > w[2] > 0


def test_toxicity_learns_words_and_stems(spark, frame):
    rng = random.Random(12)
    rows, labels = [(None, None, None, None), (-1, "", None, None), (-2, "12 !!", None, None)], [(None, 1, 1), (5, None, None)]
    for i in range(400):
        own, bad = words(rng, 60), i % 4 == 0
        if bad:
            own[rng.randrange(60)] = "grimble" + rng.choice(["a", "ok", "ist"])
            own[rng.randrange(60)] = rng.choice(["zonk", "zonk", "idiot"])
        rows.append((i, ". ".join([" ".join(own[:30]), " ".join(own[30:])]), None, None))
        labels.append((i, 1, int(bad)))
    out = [r.asDict() for r in toxicity.toxicity(frame(rows), labelled(spark, labels)).collect()]
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] >= 0 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] for r in held) and sum(r["held_out"] for r in out) - len(held) in (0, 1, 2)
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    assert toxicity.toxicity(frame(rows), labelled(spark, [])).count() == len(rows)
    assert toxicity.toxicity(frame([]), labelled(spark, labels)).count() == 0


def test_quality_from_positive_labels_only(spark, frame):
    rng = random.Random(13)
    rows, labels = [(None, None, None, None), (-1, "", None, None)], []
    for i in range(500):
        bad = i % 5 == 0
        rows.append((i, " ".join(w + ("%%%" if bad else "") for w in words(rng, 80)), None, None))
        if i % 2:
            labels.append((i, int(not bad), 0))
    out = [r.asDict() for r in quality_classifier.quality(frame(rows), labelled(spark, labels)).collect()]
    real = [r for r in out if (r["doc_id"] or -1) >= 0]
    assert len(out) == len(rows) and sum(r["predicted"] == int(r["doc_id"] % 5 != 0) for r in real) >= 0.97 * len(real)
    none = quality_classifier.quality(frame(rows), labelled(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5} and {r["predicted"] for r in none} == {1}
    assert quality_classifier.quality(frame([]), labelled(spark, labels)).count() == 0


def test_class_prior():
    rng = np.random.default_rng(14)
    pos, neg = rng.normal(2, 1, 4000), rng.normal(-2, 1, 1200)
    assert abs(quality_classifier.class_prior(pos, np.concatenate([rng.normal(2, 1, 2800), neg])) - 0.7) < 0.08


def test_languages(frame):
    rng = random.Random(15)
    letters = {"xx": "abcde", "yy": "fghij", "zz": "éüñøß"}
    rows = [(None, None, "xx", None), (-1, "", "xx", None), (-2, "123 ² ½ ① 4", "yy", None), (-3, "abc", None, None)]
    rows += [(i, " ".join("".join(rng.choice(letters[g]) for _ in range(5)) for _ in range(20)).title(), g, None)
             for i, g in enumerate(rng.choices(list(letters), k=300))]
    out = {r["doc_id"]: r for r in language_id.identify(frame(rows)).collect()}
    assert [out[k]["lang_pred"] for k in (None, -1, -2)] == ["und"] * 3 and out[-3]["lang_pred"] == "xx"
    assert all(out[i]["lang_pred"] == g and 0 <= out[i]["score"] <= 1 for i, _, g, _ in rows[4:])
    nothing = language_id.identify(frame([(1, "abc", None, None)])).collect()
    assert nothing[0]["lang_pred"] == "und" and language_id.identify(frame([])).count() == 0


def test_rare_languages_and_repeated_rows(spark):
    rng = random.Random(17)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(15))
    rows = [(i, make("abcde"), "xx") for i in range(1500)] + [(4000 + i, make("fghij"), "yy") for i in range(6)]
    rows += [(1, rows[1][1], "xx")] * 1500  # one row over half of the table
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    languages, w, idf, _ = language_id.train(docs, max_labelled=40)
    assert languages == ["xx", "yy"]
    known = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    seen = np.zeros(language_id.DIM)
    for t in known:
        seen[language_id.ngrams(t)[0]] += 1
    assert np.allclose(idf, np.log((1 + len(known)) / (1 + seen)) + 1)  # counted over all texts
    out = language_id.identify(docs, max_labelled=40).where("doc_id >= 4000").collect()
    assert {r["lang_pred"] for r in out} == {"yy"}


# 6: token counts

def test_token_counts_add_up(spark, frame):
    rows = [(None, None, None, None), (1, "", None, None), (2, "one line", None, None), (3, "a\nb\n\n", None, None),
            (4, "émile\n日本語 text\n\n\n  x", None, None), (4, "word " * 20_000, None, None)]
    out = token_counts.token_counts(frame(rows)).collect()
    assert len(out) == len(rows) and all(r["n_tokens"] == sum(r["section_tokens"]) and r["n_sections"] == len(r["section_tokens"]) for r in out)
    with open(token_counts.VOCABULARY, "rb") as f:
        encoder = token_counts.Encoder(f.read(), token_counts.PATTERN)
    for r, (_, text, _, _) in zip(out, rows):
        assert r["n_tokens"] == (len(encoder.encoding.encode_ordinary(text)) if text else 0)
        assert r["n_sections"] == (len(text.splitlines()) if text else 0)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_boundary_rules_follow_the_model(rule):
    rng = random.Random(16)
    for _ in range(200):
        ends = np.cumsum([rng.randrange(1, 6) for _ in range(rng.randrange(1, 20))])
        cuts = sorted(rng.sample(range(int(ends[-1]) + 1), min(int(ends[-1]) + 1, 2 * rng.randrange(1, 5))))
        spans = list(zip(cuts[::2], cuts[1::2]))
        want, begin = [0] * len(spans), 0
        for end in ends:
            shares = [min(end, e) - max(begin, s) for s, e in spans]
            touched = [k for k, x in enumerate(shares) if x > 0]
            if touched:
                best = {"first": touched[0], "last": touched[-1], "largest": max(touched, key=lambda k: (shares[k], -k))}[rule]
                want[best] += 1
            begin = end
        got, _ = token_counts.attribute(ends, np.array([s for s, _ in spans], np.int64), np.array([e for _, e in spans], np.int64), rule)
        assert got.tolist() == want


def test_tokens_of_given_fields(spark):
    df = spark.sql("SELECT 1L AS doc_id, 'título: un día' AS text, array(named_struct('start', 0, 'end', 7), named_struct('start', 7, 'end', 14)) AS f")
    r = token_counts.token_counts(df, spans="f").first()
    assert r["n_sections"] == 2 and sum(r["section_tokens"]) == r["n_tokens"]
    with pytest.raises(ValueError):
        token_counts.token_counts(df, rule="middle")


def test_tokens_of_odd_spans(spark):
    text = "one two three, vier fünf"
    spans = [(14, 99), (4, 8), None, (None, 3), (2, 2), (9, 5), (-5, 4), (6, 14)]
    rows = [(1, text, spans), (2, text, None), (3, None, spans), (4, "", []), (5, text, [])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, f array<struct<start:bigint,end:bigint>>")
    out = {r["doc_id"]: r for r in token_counts.token_counts(df, spans="f", rule="first").collect()}
    with open(token_counts.VOCABULARY, "rb") as f:
        encoder = token_counts.Encoder(f.read(), token_counts.PATTERN)
    # by hand: what is left of the spans, in order, then each token to the first that it touches
    left = {6: (0, 4), 1: (4, 8), 7: (8, 14), 0: (14, len(text))}
    want, begin = [0] * len(spans), 0
    for token in encoder.encoding.encode_ordinary(text):
        end = begin + len(encoder.encoding.decode_single_token_bytes(token))
        chars = len(text.encode()[:begin].decode(errors="ignore")), len(text.encode()[:end].decode(errors="ignore"))
        touched = [k for k, (a, b) in left.items() if max(a, chars[0]) < min(b, chars[1])]
        if touched:
            want[touched[0]] += 1
        begin = end
    assert out[1]["section_tokens"] == want and sum(want) == out[1]["n_tokens"]
    assert [out[k]["section_tokens"] for k in (2, 3, 4, 5)] == [[], [0] * len(spans), [], []]


# 8: archives

PAGES = [(1, "http://www.example.com/a", "<p>one</p>"), (2, "https://example.com:8080/b?x=1", "<p>two</p>"), (3, None, None), (4, "not a url", ""),
         (5, "http://www.example.com/a", "<p>one</p>"), (None, "http://o.org", "<p>one</p>"), (6, "http://é.org/ü x", "päge\r\n\r\n" * 5000),
         (0, "http://z.net/\n", "<p>two</p>"), (7, "http://www.example.com/a", "last"), (None, "x", "only nulls"), (None, "y", "only nulls"),
         (8, "http://s.com", "same"), (8, "http://s.com", "same")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("offset", F.lit("other"))


def test_archive_round_trip(spark):
    out = [(*tuple(r)[:5], None if r["payload"] is None else bytes(r["payload"])) for r in warc.archive_round_trip(
        pages(spark, PAGES), payloads=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()]
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        first = min((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        revisit = first is not None and page != first
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                     first if revisit else None, None if revisit else data))
    assert sorted(map(str, out)) == sorted(map(str, want))
    big = warc.archive_round_trip(pages(spark, PAGES), min_revisit_bytes=11)
    assert big.where("record_type = 'revisit'").count() == 0
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_lookup_reads_only_what_is_asked(spark, tmp_path):
    rng = random.Random(17)
    rows = [(i, f"http://h{rng.randrange(9)}.org/{rng.randrange(200)}", f"body {i}") for i in range(500)] + [(500 + i, "http://hot.org/", f"hot {i}") for i in range(200)]
    captures = warc.write_archives(pages(spark, rows), f"{tmp_path}/archives", roll_bytes=20_000)
    directory = warc.write_index(captures, f"{tmp_path}/index", block_lines=16)
    asked = [rows[3][1], rows[77][1], "http://hot.org/", "http://nowhere.org/", None]
    out = warc.lookup(spark.createDataFrame([(u,) for u in asked], "url string"), directory, f"{tmp_path}/archives", f"{tmp_path}/index")
    got = sorted((r["page_id"], bytes(r["payload"]).decode()) for r in out.collect())
    assert got == sorted((i, h) for i, u, h in rows if u in asked)


def test_keys_reverse_the_host():
    assert warc.surt("http://www.Example.com:80/a b") == "com,example,www)/a%20b"
    assert warc.surt("https://h.org:81?q=1") == "org,h:81)/?q=1" and warc.surt(None) == "" and " " not in warc.surt("a b\nc")
