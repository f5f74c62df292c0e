"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from odd_rows import DOCUMENT, awkward, words

from creamline.llm import importance


def plain(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_buckets(found, most=2, buckets=10_000):
    runs = [" ".join(found[i : i + k]) for k in range(1, most + 1) for i in range(len(found) - k + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


TEXTS = ["", None, "One", "a-b c", "Ä ä É é 12x", words(4, 300), "x" * 200 + " y " + "z" * 70, "日本語 テキスト" * 30, "a b\x7fc"]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_features_are_the_checksums_of_word_runs(most):
    of = importance.Features(10_000, most)
    for text in TEXTS:
        n, found = of(text or "")
        import numpy as np

        assert n == len(plain(text))
        assert np.frombuffer(found, of.kind).tolist() == plain_buckets(plain(text), most)


def test_offsets_point_at_the_words_also_across_pieces(monkeypatch):
    monkeypatch.setattr(importance, "_CUT", 50)
    text = words(7, 400) + " ÄÖ-x" * 30
    found = [pair for piece in importance.words_with_offsets(text) for pair in piece]
    assert [w for w, _ in found] == plain(text)
    assert all(plain(text[a:b]) == [w] for w, (a, b) in found)


def plain_resample(rows, target):
    own, aimed = {}, Counter(b for t in target for b in plain_buckets(plain(t)))
    own = Counter(b for _, t in rows for b in plain_buckets(plain(t)))
    S, T = sum(own.values()), sum(aimed.values())
    gain = [math.floor(1000 * math.log((aimed[b] + 1) * (S + 10000) / ((own[b] + 1) * (T + 10000)))) for b in range(10_000)]
    out = []
    for doc_id, text in rows:
        found = plain_buckets(plain(text))
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(plain(text))])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = place
    return Counter(tuple(r[:5]) for r in out)


def test_draw_equals_a_plain_one(spark):
    rows = [(i, words(i, 10 + i % 40)) for i in range(150)] + [(r[0], r[1]) for r in awkward()]
    target = [words(3, 60), words(900, 50), None, ""]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCUMENT).selectExpr("*", "1 AS key", "2 AS rank", "'q' AS features")
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert Counter(map(tuple, importance.resampled(docs, aim).collect())) == plain_resample(rows, target)


def test_empty_tables(spark, no_docs):
    aim = spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(no_docs, aim).collect() == []
    one = spark.createDataFrame([(1, words(1, 30), "en", "s", 1)], DOCUMENT)
    assert len(importance.resampled(one, aim).collect()) == 1
