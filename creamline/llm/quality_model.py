"""Quality classifier on supervised subword embeddings.

A document's vector is the mean of learned vectors of its words and character n-grams, all hashed into one table
of buckets; a softmax layer on it gives the score. Table and layer are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled documents. As layer and mean are linear, scoring needs one
number for each bucket: the table is multiplied by the layer once, and a document's logit is the mean of its
buckets' numbers. One narrow task per input partition: no shuffle. Labels, language, source and id are no inputs.

Defined results: a null text is an empty one; a text without a word has no n-grams and gets the score that the
bias alone gives; without labels every score is 0.5, with labels of one kind their smoothed share; repeated rows
are scored alike; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import labelled_sample, map_rows, table

BUCKETS, WIDTH, NGRAMS = 1 << 17, 16, (3, 4, 5)
#: Most labelled documents to learn from, and their greatest length in bytes.
TRAIN_DOCS, TRAIN_BYTES = 4000, 100_000
#: Bytes looked at together; n-grams across two such pieces are seen by the overlap.
_PIECE = 1 << 20
#: The bucket of a word that repeats the one before it; such a word counts for four.
_AGAIN = np.int64(BUCKETS - 1)
_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)


def buckets(raw: bytes) -> np.ndarray:
    """The buckets of each word and of each n-gram inside a blank-bounded word, repeats included."""
    words = raw.split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    line = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    found = []
    for start in range(0, len(line), _PIECE):
        found.append(_grams(line[start : start + _PIECE + max(NGRAMS) - 1], _PIECE))
    return np.concatenate([*found, _words(line)])


def _grams(line: np.ndarray, most: int) -> np.ndarray:
    wide, blank = line.astype(np.uint64) + np.uint64(1), np.cumsum(line == 32)
    out, code, size = [], wide, 1
    for n in NGRAMS:
        while size < n:
            code = code[:-1] * _ODD + wide[size:]
            size += 1
        if len(code):
            inner = blank[n - 2 : len(line) - 1][: len(code)] - blank[: len(code)] == 0  # no blank but at the ends
            out.append(_place(code[:most][inner[:most]] + np.uint64(n)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _words(line: np.ndarray) -> np.ndarray:
    """Buckets of whole words, by differences of a running polynomial with odd base (invertible modulo 2**64)."""
    at = np.flatnonzero(line == 32)
    out, inverse = [], np.uint64(pow(int(_ODD), -1, 1 << 64))
    for k in range(0, len(at) - 1, 1 << 17):
        some = at[k : k + (1 << 17) + 1]
        part = line[some[0] : some[-1]].astype(np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(len(part), _ODD))
            running = np.concatenate([[np.uint64(0)], np.cumsum(part * powers)])
            back = np.cumprod(np.full(len(part), inverse))
        start, end = some[:-1] - some[0], some[1:] - some[0]
        code = (running[end] - running[start]) * back[start]
        out.append(_place(code + np.uint64(1)))
        out.append(np.full(4 * int((code[1:] == code[:-1]).sum()), _AGAIN))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _place(code: np.ndarray) -> np.ndarray:
    return ((code * _MIX) >> np.uint64(64 - 17)).astype(np.int64)


@dataclass(frozen=True)
class QualityModel:
    """The number of each bucket (float32) and the bias."""

    numbers: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        own = buckets(text.encode())
        return float(1 / (1 + np.exp(-(self.bias + (self.numbers[own].mean(dtype=np.float64) if len(own) else 0.0)))))


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 8, rate: float = 20.0) -> QualityModel:
    """documents: buckets and their share of the document. Reruns on the same documents agree."""
    ones, n = sum(labels), len(labels)
    if not n or ones in (0, n):
        return QualityModel(np.zeros(BUCKETS, np.float32), float(np.log((ones + 1) / (n - ones + 1))))
    rng = np.random.default_rng(2)
    vectors = (rng.random((BUCKETS, WIDTH), dtype=np.float32) - np.float32(0.5)) / np.float32(WIDTH)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.array([n - ones, ones], np.float32)
    bias = np.log(bias / n)
    steps, step = epochs * n, 0
    for _ in range(epochs):
        for i in rng.permutation(n):
            ids, share = documents[i]
            if not len(ids):
                step += 1
                continue
            mean = share @ vectors[ids]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1  # gradient of the logits
            now = np.float32(rate * (1 - step / steps))
            back = layer @ p
            layer -= now * 0.05 * np.outer(mean, p)
            bias -= now * np.float32(0.002) * p
            vectors[ids] -= now * share[:, None] * back
            step += 1
    difference = layer[:, 1] - layer[:, 0]
    return QualityModel((vectors @ difference).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, where=None, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> QualityModel:
    """The model learned from at most max_docs labelled documents of at most max_bytes bytes that meet where."""

    def make():
        def row_of(row: dict) -> dict:
            ids, count = np.unique(buckets((row["text"] or "").encode()), return_counts=True)
            return {"doc_id": row["doc_id"], "label": row["label"], "ids": ids.astype("<i4").tobytes(), "share": (count / max(count.sum(), 1)).astype("<f4").tobytes()}

        return row_of

    sample = labelled_sample(docs, labels, "quality", max_docs, where, max_bytes)
    rows = sorted(map_rows(sample, make, "doc_id long, label int, ids binary, share binary").collect(), key=lambda r: (r.doc_id, bytes(r.ids)))
    return train([(np.frombuffer(r.ids, "<i4"), np.frombuffer(r.share, "<f4")) for r in rows], [r.label for r in rows])


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of each document. The model travels as one broadcast of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast((model.numbers.tobytes(), model.bias))

    def make():
        own = QualityModel(np.frombuffer(shared.value[0], np.float32), shared.value[1])
        return lambda row: {"doc_id": row["doc_id"], "score": own.score(row["text"] or "")}

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, score double")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = fit(docs, table(spark, sf_dir, "labels"), where=fold != 0)
    return quality_scores(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
