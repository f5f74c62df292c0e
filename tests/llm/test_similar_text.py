"""The near-dedup stage against all pairs of five-word shingle sets."""

import random

import numpy as np
import pytest
from odd_rows import DOCUMENT, SF, awkward
from pyspark.sql import functions as F
from test_dedup import FOLD, Classes

from creamline.llm import simhash, similar_text


def runs(text):
    found = (text or "").translate(FOLD).split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def edited_rows():
    """Texts with some words replaced, from surely linked to surely not."""
    rng, rows = random.Random(7), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    for size in (60, 100, 200, 400):
        for replaced in (1, 2, 4, 8, 16):
            for _ in range(12):
                body = [word() for _ in range(size)]
                near = list(body)
                for at in rng.sample(range(size), replaced):
                    near[at] = word()
                rows += [(len(rows), " ".join(body), "en", "s", 1), (len(rows) + 1, " ".join(near), "en", "s", 1)]
    return rows


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_pairs_of_the_stage_are_those_of_the_shingles(spark):
    rows = edited_rows()
    kept = {r.doc_id for r in simhash.stage(spark, spark.createDataFrame(rows, DOCUMENT), SF).collect()}
    likeness = {k: similarity(runs(rows[k][1]), runs(rows[k + 1][1])) for k in range(0, len(rows), 2)}
    linked = {k for k, x in likeness.items() if x >= 0.8}
    assert set(likeness) <= kept and len(linked) > 90
    assert all(k + 1 in kept for k in likeness if k not in linked)
    assert sum(k + 1 not in kept for k in linked) >= 0.99 * len(linked)


@pytest.mark.parametrize("tile", [similar_text.TILE, 7])
def test_stage_on_awkward_rows_and_a_crowd(spark, tile):
    rng = random.Random(9)
    body = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    crowd = []
    for k in range(150):
        near = list(body)
        near[rng.randrange(300)] = f"x{k}"
        crowd.append((2000 + k, " ".join(near), "en", "s", 1))
    rows = [*awkward(), *crowd, (3000, " ".join(body[:150]), "en", "s", 1)]
    sets = [runs(r[1]) for r in rows]
    classes, first = Classes(), {}
    for i, a in enumerate(sets):
        classes.find(i)
        for j in range(i):
            if similarity(a, sets[j]) >= 0.8:
                classes.join(i, j)
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = classes.find(i)
            first[root] = min(first.get(root, r[0]), r[0])
    found = similar_text.near_copies(spark.createDataFrame(rows, DOCUMENT), tile=tile).collect()
    want = sorted((r[0] or -1, first[classes.find(i)]) for i, r in enumerate(rows))
    assert sorted((r.doc_id or -1, r.component_id) for r in found) == want


def chained_rows(n):
    """Texts of which each is linked to the next only, so that no tile sees a whole component; and one far copy."""
    rng = random.Random(3)
    body = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for k in range(n):
        body[(k * 6) % 120] = f"y{k}"
        rows.append((k, " ".join(body), "en", "s", 1))
    return rows


def test_tiles_find_the_components_that_one_task_would(spark):
    docs = spark.createDataFrame(chained_rows(60), DOCUMENT)
    found = {r.doc_id: r.component_id for r in similar_text.near_copies(docs, tile=5).collect()}
    assert found == {r.doc_id: r.component_id for r in similar_text.near_copies(docs, tile=1000).collect()}


def test_a_crowd_gives_few_edges_a_text(spark):
    rng = random.Random(4)
    body = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(600):
        near = list(body)
        for at in rng.sample(range(200), 3):
            near[at] = f"x{k}"
        rows.append((k, " ".join(near), "en", "s", 1))
    prints = similar_text.sketches(spark.createDataFrame(rows, DOCUMENT)).drop("doc_id", "text_hash").withColumnRenamed("root", "r")
    rooted, edges = prints.withColumn("root", F.col("runs")), 0
    for first, end in similar_text.PASSES:
        keyed = similar_text.variants(rooted, first, end).repartition("bucket").sortWithinPartitions("bucket", "runs")
        edges += similar_text.candidates(keyed).distinct().count()
        rooted = similar_text.candidate_roots(prints) if first == 0 else rooted
    assert rooted.select("root").distinct().count() == 1
    assert edges < 3 * 600


def test_recall_on_given_documents(spark, docs):
    """Every pair of texts of the table that exact similarity links is in one component."""
    texts = {}
    for r in docs.collect():
        texts.setdefault(frozenset(runs(r.text)), r.doc_id)
    where = {}
    for number, found in enumerate(texts):
        for run in found:
            where.setdefault(run, []).append(number)
    sets, names = list(texts), list(texts.values())
    pairs = {(a, b) for same in where.values() if len(same) < 50 for i, a in enumerate(same) for b in same[i + 1 :]}
    links = [(names[a], names[b]) for a, b in pairs if similarity(sets[a], sets[b]) >= 0.8]
    roots = {r.doc_id: r.component_id for r in similar_text.near_copies(docs).collect()}
    assert all(roots[a] == roots[b] for a, b in links)


def test_no_link_of_short_texts_is_lost(spark):
    """Pairs just similar enough, of which the index of fingerprints alone loses some (about 3 in 100 of 9 and 8 words)."""
    rng, rows = random.Random(5), []
    for k in range(900):
        size = (9, 9, 9, 14, 24)[k % 5]
        body = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        rows += [(2 * k, " ".join(body), "en", "s", 1), (2 * k + 1, " ".join(body[: size - (size - 4) // 5]), "en", "s", 1)]
    assert all(similarity(runs(a[1]), runs(b[1])) >= 0.8 for a, b in zip(rows[::2], rows[1::2], strict=True))
    found = {r.doc_id: r.component_id for r in similar_text.near_copies(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert found == {k: k // 2 * 2 for k in range(len(rows))}


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(6)
    common = rng.integers(0, 2**64, 300, dtype=np.uint64)
    prefix = similar_text.prefixes(common, 0.8)
    for size in range(1, 60):
        for share in (0, 0.5, 1):  # of common shingles
            named = rng.choice(common, int(share * size), replace=False)
            whole = np.concatenate([named, rng.integers(0, 2**64, size - len(named), dtype=np.uint64)])
            for less in range(size // 5 + 1):
                a, b = np.unique(whole), np.unique(rng.choice(whole, size - less, replace=False))
                assert np.intersect1d(prefix(a), prefix(b)).size and len(prefix(a)) == size - -(-4 * size // 5) + 1
    assert prefix(np.zeros(0, dtype=np.uint64)).size == 0
