"""Fingerprints, repeated bytes and embeddings against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from odd_rows import SF, awkward, words

from creamline.llm import embedding_dedup, simhash, suffix_dedup
from creamline.llm.components import components

FOLD = str.maketrans(simhash.UPPER, simhash.LOWER)


class Classes:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def plain_fingerprint(text: str) -> int:
    found = re.findall(r"[^\x20\x09-\x0D]+", text.translate(FOLD))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + 4]).encode(), 42) for i in range(max(1, len(found) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    edges = spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1100)}
    assert components(edges.limit(0)).count() == 0


def test_simhash_on_awkward_rows(spark, odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    source = awkward()
    assert len(rows) == len(source)
    own = {(r[0], r[1]): plain_fingerprint(r[1] or "") for r in source}
    classes = Classes()
    prints = sorted(set(own.values()))
    for i, a in enumerate(prints):
        classes.find(a)
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                classes.join(a, b)
    first = {}
    for (doc_id, _), fp in own.items():
        if doc_id is not None:
            root = classes.find(fp)
            first[root] = min(first.get(root, doc_id), doc_id)
    want = Counter((r[0], own[r[0], r[1]], first.get(classes.find(own[r[0], r[1]]))) for r in source)
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows) == want


def test_simhash_of_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_variants_find_every_link_of_a_crowd(spark):
    """A dense ball, a chain and strangers: the components are those of all pairs."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    step = rng.getrandbits(64)
    for k in range(12):
        step ^= sum(1 << b for b in rng.sample(range(64), 4))
        prints.add(step)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    keyed = simhash.variants(frame, 4).repartition(5, "wiped", "rest").sortWithinPartitions("wiped", "rest")
    edges = simhash.linked_in_buckets(keyed, 4)
    got = {r.node: r.root for r in components(edges).collect()}
    assert edges.count() < 64 * len(signed)
    classes = Classes()
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) % (1 << 64)).bit_count() <= 4:
                classes.join(a, b)
    assert all(got.get(p, p) == classes.find(p) for p in signed)


def test_one_document_of_each_group_stays(odd_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    groups = simhash.near_duplicates(odd_docs).select("component_id", "first_hash").distinct().count()
    assert kept.count() == groups


def plain_repeats(texts):
    raws = [(t or "").encode() for t in texts]
    starts = [[raw[i : i + 200] for i in range(len(raw) - 199)] for raw in raws]
    seen = Counter(hash(w) for own in starts for w in own)
    out = []
    for raw, own in zip(raws, starts, strict=True):
        cut = np.zeros(len(raw), dtype=bool)
        for i, w in enumerate(own):
            if seen[hash(w)] > 1:
                cut[i : i + 200] = True
        kept = bytes(b for b, c in zip(raw, cut, strict=True) if not c)
        spans = int((cut & ~np.r_[False, cut[:-1]]).sum()) if raw else 0
        out.append((len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows():
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passage, short, exact, long = noise(260), "q" + words(8, 60)[:198], noise(200), noise(1000)
    texts = [
        passage, "A" + passage + "B", "C" + passage + noise(300) + passage, short + noise(50), noise(30) + short, exact,
        noise(20) + exact + noise(20), exact + "k", "a" * 500, "ab" * 400, long, long[:500] + "#" + long[501:],
        noise(3000) + long[300:700], long, "a" * 199, noise(280_000) + passage + noise(280_000) + long[100:450],
    ]
    return [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("piece", "most"), [(8192, 50_000), (2, 3)])
def test_repeats_are_cut_as_by_hand(spark, monkeypatch, piece, most):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "MOST_REGIONS", most)
    rows = [*awkward(), *repeat_rows()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame, digest=True).collect())
    assert got == Counter((r[0], *x) for r, x in zip(rows, plain_repeats([r[1] for r in rows]), strict=True))


def test_repeats_of_the_small_table(spark, docs):
    rows = docs.collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3_suffix_array_dedup(spark, SF).collect())
    assert got == Counter((r.doc_id, *x) for r, x in zip(rows, plain_repeats([r.text for r in rows]), strict=True))


def test_repeats_of_no_rows(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def vectors():
    rng = np.random.default_rng(4)
    out, near = [], rng.standard_normal(16)
    for i in range(120):
        v = near + rng.standard_normal(16) * (0.25 if i % 3 else 0.6)
        out.append((i, [float(x) for x in v.astype(np.float32)], i % 2))
    same = out[0][1]
    out += [(200, same, 0), (201, same, 0), (201, same, 0), (202, same, None), (203, None, 0), (204, [0.0] * 16, 0), (205, [], 0)]
    out += [(206, [math.nan, *same[1:]], 0), (207, [math.inf, *same[1:]], 0), (208, [None, *same[1:]], 0), (209, same[:8], 0), (210, [2 * x for x in same], 0)]
    return out


@pytest.mark.parametrize("tile", [2048, 16])
def test_embedding_links_are_those_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(frame).collect())
    usable = [r for r in rows if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(r[1], dtype=np.float64) / np.linalg.norm(np.array(r[1], dtype=np.float64)) for r in usable]
    links, classes = Counter(), Classes()
    for i in range(len(usable)):
        for j in range(i):
            if usable[i][2] == usable[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                classes.join(usable[i][0], usable[j][0])
    want = Counter((r[0], links[i], classes.find(r[0])) for i, r in enumerate(usable))
    want += Counter((r[0], 0, r[0]) for r in rows if not any(r is u for u in usable))
    total = sum(n * k for (_, n, _), k in want.items())
    assert sum(n * k for (_, n, _), k in got.items()) >= 0.98 * total > 0
    assert got.keys() >= {w for w in want if w[1] == 0}
    if got != want:  # a pair near the threshold may be missed, none may be made up
        most = {w[0]: w[1] for w in want}
        assert all(n <= most[v] for v, n, _ in got)


def test_estimates_hold_their_bounds():
    rng = np.random.default_rng(1)
    units = embedding_dedup.unit(rng.standard_normal((300, 64)))
    about, off = embedding_dedup.estimates(units, *embedding_dedup.codes_of(units))
    miss = about - units @ units.T
    assert abs(miss[~np.eye(300, dtype=bool)].mean()) < 0.01
    assert (np.abs(miss) <= off + 1e-9).mean() > 0.999


def test_embeddings_of_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).count() == 0


# --- embeddings: repeated and null ids

def test_vectors_under_one_id_or_none_stay_apart(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [
        (3, "m", a), (3, "l", b), (1, "m", [1.0, 0.01, 0.0]), (2, "l", [0.01, 1.0, 0.0]),
        (None, "m", [1.0, 0.02, 0.0]), (None, "x", c), (None, "x", c), (7, "x", a), (None, None, a),
    ]
    frame = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, label string, embedding array<double>, node int, component string")
    got = Counter(map(tuple, embedding_dedup.near_duplicates(frame).collect()))
    assert got == Counter([(3, 2, 1), (1, 2, 1), (None, 2, 1), (3, 1, 2), (2, 1, 2), (None, 1, None), (None, 1, None), (7, 0, 7), (None, 0, None)])
