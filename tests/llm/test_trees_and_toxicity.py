"""Prefix trie, Merkle manifest and toxicity against brute-force versions and odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedforge.llm import merkle_manifest, prefix_trie, ranks, toxicity

TURNS = "conv_id long, turn long, role string, text string, base string, pos int, rank int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree int, level0 int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- positions ----------------------------------------------------------------------

def test_ranks_of_groups_that_span_partitions(spark):
    rows = [(g, i % 50) for g, n in ((None, 40), ("hot", 3000), ("a", 1), ("b", 7)) for i in range(n)]
    random.Random(0).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed, spans = ranks.ranked(spark.createDataFrame(rows, "g string, o int").repartition(5), "g", ["o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = defaultdict(list)
    for r in placed.collect():
        got[r.g].append((r["rank"], r.o))
    for g, found in got.items():
        assert [r for r, _ in sorted(found)] == list(range(len(found)))
        assert [o for _, o in sorted(found)] == sorted(o for x, o in rows if x == g)
    assert spans.where("g = 'hot'").count() > 1


# --- prefix trie --------------------------------------------------------------------

def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), sha(f"{len(role.encode())}:{role}{text}"), role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    members, length = defaultdict(list), {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        path = tuple(turns.get(base, [])[:h] + own[h:])
        length[c] = len(path)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, sums, out = defaultdict(list), {}, {}
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if length[c] == len(node))))
        out[min(members[node]), len(node)] = (
            min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]), *sums[node], sha(ends))
    return out


def trie(df):
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in prefix_trie.prefix_trie(df).collect()}


def test_trie_equals_brute_force_over_several_bands(spark):
    rng = random.Random(1)
    rows = []
    for c in range(-12, 90):
        shared = rng.random() < 0.6
        for t in range(rng.choice([1, 2, 3, 8, 9, 12, 70, 140])):
            text = f"s{t}é" if shared else rng.choice([None, "a", "b"])
            rows.append((c, None if t == 0 and c % 3 == 0 else (t if c % 7 else t // 2),
                         "user" if shared else rng.choice(["user", None]), text, "x", 1, 2))
    rows += [(None, 1, "user", "x", None, 0, 0)] + [(0, 3, "user", "z", None, 0, 0)] * 3
    rng.shuffle(rows)
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_trie_beyond_a_band_of_bands(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    rows = [(c, t, "u", f"{t}" if t < 25 + c else f"{c}-{t}", None, 0, 0) for c in range(12) for t in range(20 + 3 * c)]
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_trie_of_copies_and_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "u", f"same {t}", None, 0, 0) for c in range(300) for t in range(4)]
    rows += [(c, 0, "u", "one", None, 0, 0) for c in range(300, 330)]
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "u", "x", None, 0, 0)], [(7, 0, None, None, None, 0, 0)],
                                  [(5, None, "u", "", None, 0, 0)] * 3 + [(6, 1, "u", "w" * 200_000, None, 0, 0)]])
def test_trie_of_odd_tables(spark, rows):
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


# --- Merkle manifest ----------------------------------------------------------------

def named(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_steps(levels, i):
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        yield "".join(run[:i % 3]), "".join(run[i % 3 + 1:])
        i //= 3


def brute_manifest(rows):
    sources = defaultdict(list)
    for i, text, lang, source, n, *_ in rows:
        leaf = sha("".join(map(named, (i, source, lang, n, text))))
        shown = text.replace("\n", "") if text and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else text
        sources[source].append(((i is not None, i or 0), leaf, i, sha("".join(map(named, (i, source, lang, n, shown))))))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_levels([x[1] for x in sorted(sources[s])]) for s in order}
    top = brute_levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for j, (_, leaf, i, folded) in enumerate(sorted(sources[s])):
            steps = [*brute_steps(trees[s], j), *brute_steps(top, k)]
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[], [1], [3, 1], [81, 82, 1, 243, 700]])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(0)
    rows = [(rng.choice([None, j, j * 7]), rng.choice([None, "", "a\nb", "x y\n", "ä"]), rng.choice([None, "en"]),
             None if k == 1 else f"é{k}", rng.choice([None, 5]), "d", 0, 0) for k, n in enumerate(sizes) for j in range(n)]
    got = merkle_manifest.manifest(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


def test_manifest_of_many_sources_and_a_long_text(spark):
    rows = [(k, "line\n" * (200_000 if k == 3 else k % 4), None, f"s{k}", k, None, 0, 0) for k in range(120)]
    got = merkle_manifest.manifest(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


# --- toxicity -----------------------------------------------------------------------

def test_toxicity_gradient_equals_differences():
    rng = np.random.default_rng(0)
    n = np.array([3, 1, 4])
    number, code = rng.integers(0, 8, 20), rng.integers(0, 5, 20)
    given = (np.array([True, False, True]), np.array([1.0, 2.0, 0.5]), n, number, code)
    x = rng.normal(size=6)
    value, grad = toxicity.loss_and_gradient(x, *given)
    for i in range(6):
        step = np.eye(6)[i] * 1e-6
        more, less = (toxicity.loss_and_gradient(x + d, *given)[0] for d in (step, -step))
        assert abs((more - less) / 2e-6 - grad[i]) < 1e-5
    plain = 0.0
    for d, (toxic, heft) in enumerate(zip(*given[:2])):
        clean = 1.0
        for s in range(n[:d].sum(), n[:d + 1].sum()):
            clean *= 1 - 1 / (1 + math.exp(-(x[-1] + sum(x[c] for a, c in zip(number, code) if a == s))))
        plain -= heft * math.log(1 - clean if toxic else clean)
    assert abs(plain - value) < 1e-9


def test_toxicity_optimiser():
    target = np.array([1.0, -2.0, 3.0])
    scale = np.array([1.0, 10.0, 100.0])
    x = toxicity.minimised(lambda x: (float(scale @ (x - target) ** 2), 2 * scale * (x - target)), np.zeros(3), 60)
    assert np.allclose(x, target, atol=1e-2)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    plain = "river stone cloud winter amber glass house light paper bread".split()
    rows, labels = [], []
    for d in range(1500):
        parts = [" ".join(rng.choices(plain, k=6)) for _ in range(rng.randint(1, 30))]
        toxic = d % 4 == 0
        if toxic:
            parts[rng.randrange(len(parts))] += f" scoundrel{rng.choice(['', 's', 'ly', 'ness'])} amber"
        rows.append((d, ". ".join(parts), None, None, None, None, 0, 0))
        labels.append((d, int(toxic)))
    docs = spark.createDataFrame(rows, DOCS)
    return rows, dict(labels), toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()


def test_toxicity_judges_held_out_documents_and_finds_the_sentence(judged):
    rows, label, out = judged
    assert {r.doc_id for r in out if r.held_out} == {d for d in label if zlib.crc32(str(d).encode()) % 5 == 0}
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == label[r.doc_id] for r in held) / len(held) > 0.99
    for r in out:
        assert r.predicted == (r.score >= 0.5) and bool(r.offending) == bool(r.predicted)
        assert all(("scoundrel" in s.text) == bool(label[r.doc_id]) for s in r.offending)
        assert all(toxicity.END.split(rows[r.doc_id][1])[s.position] == s.text for s in r.offending)


def test_toxicity_held_out_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in held if r.toxic]
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.01


def test_toxicity_of_odd_rows_and_labels(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (4, "one"), (None, "no id. " * 3), (5, "word. " * 200_000),
            (6, "日本語。😀 \x00"), (7, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, 0, 0) for i, t in rows], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == len(rows) and {r.score for r in out} == {0.5} and {r.predicted for r in out} == {1}
    assert toxicity.score_toxicity(docs.where("false"), labels).count() == 0
    one = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 0, None), (None, 0, 1), (7, 0, 9), (3, 0, 1), (3, 0, 0)], labels.schema)
    assert {r.score for r in toxicity.score_toxicity(docs, one).collect()} == {0.0}
    both = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (1, 0, 0), (6, 0, 1), (7, 0, 0)], labels.schema)
    scored = toxicity.score_toxicity(docs, both)
    assert all(0 <= r.score <= 1 for r in scored.collect())
    assert {r.held_out for r in scored.where("doc_id is null").collect()} == {False}
    assert "doc_id" in scored.columns and scored.where(F.col("score").isNull()).isEmpty()
