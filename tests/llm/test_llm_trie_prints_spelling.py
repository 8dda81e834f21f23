"""Operators 11 (prefix trie), 12 (fingerprints) and 13 (spelling) against plain models."""

import hashlib
import random

import llm_models as models
import pytest
from pyspark.sql import functions as F

from stellate.llm import fingerprints, prefix_trie, spelling

TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture
def docs(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        for name in ("n", "key", "slice", "guest", "word", "own", "lines"):
            df = df.withColumn(name, F.lit("other"))
        return df

    return make


# 11: prefix trie

def test_trie_follows_the_model(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)  # long conversations pass three levels of blocks
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["u", "a", None]), rng.choice(["a b", "c", "", None])) for c in range(-23, 44) for t in range(rng.randrange(1, 6))]
    rows += [(5, None, "u", "x"), (5, None, "u", "x"), (5, None, None, None), (6, 1, "u", "z"), (None, 1, "u", "q")]  # ties, repeated rows, nulls
    rows += [(c, t, "u", f"word {t}") for c, n in ((200, 90), (221, 70), (222, 70)) for t in range(n)]  # deep, and alike from the top
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    for name in ("node", "depth", "pos", "hash"):
        df = df.withColumn(name, F.lit("other"))
    got = [tuple(r) for r in prefix_trie.prefix_trie(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, models.prefix_trie(rows)))


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(c, 0, "u", "one two") for c in range(1, 20)]  # no conversation 0: heads are missing
    got = [tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, models.prefix_trie(rows)))
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_centroid_rounds_are_logarithmic_on_a_path(spark, monkeypatch):
    """A path of 600 nodes is summed in about log2(600) rounds."""
    n, rounds = 600, []
    name = lambda k: k.to_bytes(16, "big")
    nodes = [(name(k), name(k - 1) if k else None, 7, k, n - k, 1) for k in range(n)]
    nodes = spark.createDataFrame(nodes, "node binary, parent binary, conv_id bigint, depth bigint, weight bigint, one bigint")
    real = prefix_trie.materialise
    monkeypatch.setattr(prefix_trie, "materialise", lambda df, tag, **o: (rounds.append(tag) if tag.startswith("level") else None) or real(df, tag, **o))
    sums = prefix_trie.subtree_sums(nodes, nodes.select("conv_id", "depth", "node"), ["one"])
    assert {int.from_bytes(r["node"], "big"): r["one"] for r in sums.collect()} == {k: n - k for k in range(n)}
    assert len(rounds) <= 10


# 12: fingerprints

def plain_next(rows):
    """Rows by id (NULL first), repeated rows together, with the next text."""
    texts = [t or "" for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    ids = [i for i, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    return [(i, t, texts[(k + 1) % len(texts)]) for k, (i, t) in enumerate(zip(ids, texts))]


def test_fingerprints_of_edited_texts(docs):
    rng = random.Random(6)
    lines = lambda n: "\n".join(" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 9))) + "." for _ in range(n))
    rows = [(i * 3, lines(rng.randrange(1, 12))) for i in range(60)]
    rows += [(None, "no id\nat all"), (400, None), (401, ""), (402, "é"), (403, "日本語\n語"), (404, "x\n" * 9000), (405, "same"), (405, "same"), (405, "same")]
    out = fingerprints.fingerprints(docs(rows)).collect()
    prints = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    want = []
    for i, t, u in plain_next(rows):
        m = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - m] + u[:m]).encode()).hexdigest(), t[:len(t) - m] + u[:m], u))
    assert sorted(map(str, ((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out))) == sorted(str(w[:3]) for w in want)
    # the vector that deletion and insertion give is that of the edited text itself
    direct = docs([(k, w[3]) for k, w in enumerate(want)]).select(
        "doc_id", fingerprints.to_text(fingerprints.vector(fingerprints.paragraphs(F.col("text")))).alias("v")).collect()
    direct = {r["doc_id"]: r["v"] for r in direct}
    assert sorted((str(r["doc_id"]), r["edited_fingerprint"]) for r in out) == sorted((str(w[0]), direct[k]) for k, w in enumerate(want))
    assert prints[400]["fingerprint"] == prints[401]["fingerprint"] == "0" * len(prints[400]["fingerprint"])
    assert sorted(r["near_next"] for r in out if r["doc_id"] == 405)[1:] == [1.0, 1.0]
    assert all(0 <= r[c] <= 1 for r in out for c in ("near_edited", "near_next"))
    mean = lambda c: sum(r[c] for r in out if r["n_chars"] > 200 and r["doc_id"] != 404) / len(out)
    assert mean("near_edited") > 2 * mean("near_next")


def test_vectors_are_a_homomorphism(spark):
    rng = random.Random(7)
    pars = [f"paragraph {rng.randrange(9)}. more of {k}! yes" for k in range(30)]
    shuffled = rng.sample(pars, len(pars))
    df = spark.createDataFrame([(pars, shuffled, pars[:11], pars[11:], pars[1:])], "a array<string>, b array<string>, c array<string>, d array<string>, e array<string>")
    v = {c: fingerprints.vector(F.col(c)) for c in "abcde"}
    one = fingerprints.vector(F.array(F.lit(pars[0])))
    r = df.select((v["a"] == v["b"]).alias("order"), (v["a"] == fingerprints.plus(v["c"], v["d"])).alias("parts"), (fingerprints.minus(v["a"], one) == v["e"]).alias("out"),
                  (fingerprints.plus(v["e"], one) == v["a"]).alias("back"), (v["a"] == v["e"]).alias("other"), v["a"].alias("a")).first()
    assert r["order"] and r["parts"] and r["out"] and r["back"] and not r["other"]
    dense = [sum(int(hashlib.sha256(p.encode()).hexdigest()[8 * k:8 * k + 8], 16) for p in pars) % 2 ** 32 for k in range(fingerprints.DENSE)]
    assert list(r["a"])[:fingerprints.DENSE] == dense


def test_fingerprints_of_small_tables(docs):
    assert fingerprints.fingerprints(docs([])).collect() == []
    r = fingerprints.fingerprints(docs([(1, "abc\ndef")])).first()  # its own next document
    assert r["edited_sha256"] == hashlib.sha256(b"abc\nabc").hexdigest() and r["near_next"] == 1.0


# 13: spelling

@pytest.mark.parametrize("block", [2048, 16])
def test_spelling_follows_the_model(docs, block):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 13))) for _ in range(25)] + ["a" * k for k in range(6, 12)] + ["z" * 900]

    def variant(w):
        k, c = rng.randrange(len(w)), rng.choice("abcdeéA")
        return rng.choice([w, w, w, w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])

    rows = [(i, " ".join(variant(rng.choice(stems[:1 + i])) for _ in range(60)) + "×÷ 12x") for i in range(32)]
    rows += [(None, " ".join(stems)), (None, None), (7, ""), (3, "commonword " * 200), (4, "commonwird commonwird, commonwrd commonwrd")] + [(9, "twicehere same")] * 2
    got = [tuple(r) for r in spelling.spelling_groups(docs(rows), block_words=block).collect()]
    assert sorted(map(str, got)) == sorted(map(str, models.spelling(rows)))
    assert any(r[1] and r[1] != r[2] for r in got) or any(r[1] for r in got)


def test_spelling_of_an_empty_table(docs):
    assert spelling.spelling_groups(docs([])).collect() == []


def test_near_pairs_meet_all_kinds_of_edits():
    words = ["abcdefg", "abcdefgh", "abcdef", "xbcdefg", "abcdefx", "bcdefg", "zabcdefg", "abdefg", "abccdefg", "bacdefg", "abcdefghi", "a" * 70, "a" * 71]
    found = {(words[q], words[w]) for qs, ws in spelling.near_pairs(words, words) for q, w in zip(qs, ws)}
    assert found == {(a, b) for a in words for b in words if models.one_letter_apart(a, b)}
