"""Quality rules with line labelling: a linear-chain conditional random field marks each line as content or
boilerplate by Viterbi decoding, and the share of content decides whether the document stays.

The field has two states, a weight for each line feature and state, a weight for each change of state. Labels are
of documents, so the states of lines are hidden in training: in turn, every line gets the state that the field finds
likeliest among those that agree with its document's label (most of a good document's words are content, few of a
bad one's), and the field is fitted to these states by maximum likelihood (forward-backward, Adam). So a good
document may have boilerplate lines and a bad one content. One task of narrow work per input partition: no shuffle.

Defined results: a null text is an empty one; a text without words has no lines, fails the base rules and has
content share 0; repeated rows are judged alike; without labels of both kinds fixed starting weights are used;
other columns of the input are neither read nor disturbed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import as_row, labelled_sample, map_batches, map_rows, row_columns, table

SYMBOLS = b"#*$%&|<>"
BLANK_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
FEATURES = 13
#: Most labelled documents that the field is trained on, and their greatest length in bytes.
TRAIN_DOCS, TRAIN_BYTES = 3000, 200_000
#: Share of words in content lines that a document's label asks for: of a good one at least, of a bad one at most.
GOOD_SHARE, BAD_SHARE = 0.7, 0.3
#: Decay of the weights of features, changes of state and first states. Labels are of whole documents, so changes look
#: rarer than they are; their weights are held small, that a line may differ from its neighbours.
DECAY = (1e-4, 5e-2, 5e-2)
#: How often the states of the training lines are chosen anew.
ROUNDS = 4
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_CONTENT = 50, 50, 0.5


@dataclass(frozen=True)
class LineField:
    """Weights: emit (features x 2), move (2 x 2, from to), first (2). State 1 is content."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    @staticmethod
    def start() -> LineField:
        """Symbols, shouting and repetition speak against content; used as it is where there are no labels."""
        emit = np.zeros((FEATURES, 2))
        emit[0] = (0.0, 2.0)
        emit[2] = (12.0, 0.0)
        emit[6] = (6.0, 0.0)
        emit[8] = (2.0, 0.0)
        return LineField(emit, np.eye(2), np.zeros(2))


def line_features(line: bytes, words: list[bytes], repeated: bool) -> list[float]:
    """The numbers that the field sees of a line with at least one word."""
    size, n = len(line), len(words)
    symbols = size - len(line.translate(None, SYMBOLS))
    upper = size - len(line.translate(None, _UPPER))
    digits = size - len(line.translate(None, _DIGIT))
    short = sum(1 for w in words if len(w) <= 3)
    return [
        1.0,
        math.log1p(n) / 4,
        symbols / size,
        upper / size,
        digits / size,
        1.0 if line[-1:] in b".,;:?" else 0.0,
        line.count(b"!") / size,
        line.count(b"|") / n,
        1.0 if repeated else 0.0,
        1 - len(set(words)) / n,
        short / n,
        (size - n) / n / 10,
        1.0 if n < 4 else 0.0,
    ]


def lines_with_words(raw: bytes) -> tuple[list[bytes], list[list[bytes]], list[bool]]:
    """The lines that have a word, their words, and whether an equal line came before."""
    lines, words, repeated, seen = [], [], [], set()
    for line in raw.split(b"\n"):
        if own := line.split():
            lines.append(line)
            words.append(own)
            repeated.append(line in seen)
            seen.add(line)
    return lines, words, repeated


def features_of(raw: bytes) -> np.ndarray:
    found = [line_features(*x) for x in zip(*lines_with_words(raw), strict=True)]
    return np.array(found, dtype=np.float64).reshape(-1, FEATURES)


def viterbi(scores: np.ndarray, field: LineField) -> list[int]:
    """The best states for the emission scores (lines x 2); on a tie the smaller state."""
    if not len(scores):
        return []
    (m00, m01), (m10, m11) = field.move.tolist()
    rows = scores.tolist()
    a, b = rows[0][0] + field.first[0], rows[0][1] + field.first[1]
    back = []
    for e0, e1 in rows[1:]:
        from0, from1 = b + m10 > a + m00, b + m11 > a + m01
        back.append((from0, from1))
        a, b = e0 + (b + m10 if from0 else a + m00), e1 + (b + m11 if from1 else a + m01)
    state = int(b > a)
    states = [state]
    for came in reversed(back):
        state = int(came[state])
        states.append(state)
    return states[::-1]


def _gradient(field: LineField, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
    """Likelihood gradient of padded documents: x (docs, lines, features), mask and y (docs, lines)."""
    scores = x @ field.emit
    docs, lines = mask.shape
    alpha, beta = np.zeros((docs, lines, 2)), np.zeros((docs, lines, 2))
    alpha[:, 0] = scores[:, 0] + field.first
    for t in range(1, lines):
        step = np.logaddexp(alpha[:, t - 1, :1] + field.move[0], alpha[:, t - 1, 1:] + field.move[1]) + scores[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(lines - 2, -1, -1):
        after = beta[:, t + 1] + scores[:, t + 1]
        step = np.logaddexp(field.move[:, 0] + after[:, :1], field.move[:, 1] + after[:, 1:])
        beta[:, t] = np.where(mask[:, t + 1, None], step, 0)
    total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    at = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
    truth = np.stack([1 - y, y], axis=-1) * mask[..., None]
    emit = np.einsum("dlf,dls->fs", x, truth - at)
    move = np.zeros((2, 2))
    if lines > 1:
        both = mask[:, 1:]
        pair = np.exp(
            alpha[:, :-1, :, None] + field.move + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
        ) * both[..., None, None]
        move = np.einsum("dli,dlj->ij", truth[:, :-1] * both[..., None], truth[:, 1:]) - pair.sum(axis=(0, 1))
    return emit, move, (truth[:, 0] - at[:, 0]).sum(axis=0)


def agreeing_states(x: np.ndarray, label: int, field: LineField) -> list[int]:
    """The likeliest states of a document's lines whose share of content agrees with its label.

    The scores of content are raised or lowered by one number for all lines, the least that is needed.
    """
    scores, words = x @ field.emit, np.expm1(4 * x[:, 1])

    def states(lift: float) -> tuple[list[int], bool]:
        found = viterbi(scores + (0.0, lift), field)
        share = float(words @ np.array(found)) / float(words.sum())
        return found, share >= GOOD_SHARE if label else share <= BAD_SHARE

    found, agrees = states(0.0)
    if agrees:
        return found
    sign, low, high = (1.0 if label else -1.0), 0.0, 1.0
    while not (tried := states(sign * high))[1]:
        low, high = high, 2 * high
    found = tried[0]
    for _ in range(10):
        tried, agrees = states(sign * (low + high) / 2)
        if agrees:
            found, high = tried, (low + high) / 2
        else:
            low = (low + high) / 2
    return found


def train(documents: list[np.ndarray], labels: list[int], epochs: int = 12, at_once: int = 64) -> LineField:
    """Fits the field to hidden states of lines; reruns on the same documents agree."""
    pairs = sorted(((d, y) for d, y in zip(documents, labels, strict=True) if len(d)), key=lambda p: len(p[0]))
    if len({y for _, y in pairs}) < 2:
        return LineField.start()
    field, rng = LineField.start(), np.random.default_rng(6)
    state = [[np.zeros_like(w), np.zeros_like(w)] for w in (field.emit, field.move, field.first)]
    starts, step = list(range(0, len(pairs), at_once)), 0
    for epoch in range(epochs):
        if epoch % max(1, epochs // ROUNDS) == 0:
            hidden = [agreeing_states(d, label, field) for d, label in pairs]
        for start in rng.permutation(starts):
            some = pairs[start : start + at_once]
            longest = max(len(d) for d, _ in some)
            x, mask = np.zeros((len(some), longest, FEATURES)), np.zeros((len(some), longest), dtype=bool)
            y = np.zeros((len(some), longest))
            for i, (d, _) in enumerate(some):
                x[i, : len(d)], mask[i, : len(d)], y[i, : len(d)] = d, True, hidden[start + i]
            step += 1
            updated = []
            weights = (field.emit, field.move, field.first)
            for w, g, decay, (m, v) in zip(weights, _gradient(field, x, mask, y), DECAY, state, strict=True):
                g = g / mask.sum() - decay * w
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.999 * v + 0.001 * g * g
                updated.append(w + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
            field = LineField(*updated)
    return field


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> LineField:
    """The field trained on at most max_docs labelled documents of at most max_bytes bytes."""

    def make():
        return lambda row: {"doc_id": row["doc_id"], "label": row["label"], "lines": features_of((row["text"] or "").encode()).astype("<f4").tobytes()}

    sample = map_rows(labelled_sample(docs, labels, "quality", max_docs, max_bytes=max_bytes), make, "doc_id long, label int, lines binary")
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, bytes(r.lines)))
    return train([np.frombuffer(r.lines, "<f4").reshape(-1, FEATURES).astype(float) for r in rows], [r.label for r in rows])


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in a window of three that the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    _, pairs = np.unique(at[:-1] * len(ids) + at[1:], return_inverse=True)
    _, window, count = np.unique(pairs[:-1] * len(ids) + at[2:], return_inverse=True, return_counts=True)
    if len(count) == len(window):
        return 0
    twice = np.zeros(len(words) + 2, dtype=bool)
    twice[2:-2] = count[window] > 1
    return int((twice[2:] | twice[1:-1] | twice[:-2]).sum())


def judge(text: str, field: LineField) -> dict:
    """The base figures of a text, the states of its lines and the verdict."""
    raw = text.encode()
    lines, words, repeated = lines_with_words(raw)
    n_words = sum(map(len, words))
    blanks = len(raw) - len(raw.translate(None, BLANK_BYTES))
    n_repeat = repeat_words([w for own in words for w in own])
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    found = np.array([line_features(*x) for x in zip(lines, words, repeated, strict=True)]).reshape(-1, FEATURES)
    states = viterbi(found @ field.emit, field)
    size = sum(map(len, lines))
    share = sum(len(line) for line, s in zip(lines, states, strict=True) if s) / size if size else 0.0
    return {
        "n_words": n_words,
        "word_chars": len(text) - blanks,
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": sum(repeated),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "content_share": share,
        "n_lines": len(lines),
        "n_content_lines": sum(states),
        "kept": not base_failed and share >= MIN_CONTENT,
    }


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "content_share double, n_lines long, n_content_lines long, kept boolean"
)


def quality_rules(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id and the judgement of each document."""

    def make():
        return lambda row: {"doc_id": row["doc_id"]} | judge(row["text"] or "", field)

    return map_rows(docs.select("doc_id", "text"), make, f"doc_id long, {COLUMNS}")


def keep_good(docs: DataFrame, field: LineField) -> DataFrame:
    """The documents that pass, all columns as they were."""
    rows = docs.select(as_row(docs))

    def run(batches):
        for batch in batches:
            kept = [judge(v.as_py() or "", field)["kept"] for v in batch.column(0).field("text")]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(rows, run, rows.schema).select(*row_columns(docs))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The field learns from the labels of the documents it is given."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))
