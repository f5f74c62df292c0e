"""Rows with the awkward cases that every operator must take."""

import random

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, alphabet: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, copies, ties and repeated rows."""
    body = words(1, 120)
    texts = [
        None, "", " \n\t", "One", "one two three", body, body, body.upper(), body + " more", words(2, 20_000),
        "ünï cödé " * 80, "日本語テキスト\n" * 60, "a" * 3000, "x@y.org +49 30 1234567 1.2.3.4",
        "Released under the MIT License. All rights reserved.", "line\n" * 90, "\u0000\u0001 \x1c\x85\xa0",
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, body, None, None, None), (None, None, None, None, None), (900, words(3, 90), None, "é", 5)]
