"""Licence scan: exact phrases, and a fuzzy search for short notices.

A notice that may differ by k edits is cut into k + 1 pieces; by the pigeonhole principle at least one piece
stands unchanged in every text within k edits. The pieces are looked for exactly; around each place where one
stands, the regex library's bounded-error matching verifies the edits and gives the span. Windows that overlap
are searched once. Few edits may fall on the words that decide which licence it is, and of overlapping places of
several notices those with the fewest edits count. Both searches run on the words of the whole text, joined by single blanks. One narrow task
per input partition: no shuffle.

Defined results: a null text is an empty one; without words all counts are 0, first and last word null, labels
empty and the score 0; repeated rows are scanned alike; places of one phrase may repeat and are all counted;
other columns are not read. Notices and phrases are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import regex
from pyspark.sql import DataFrame, SparkSession

from creamline.llm.common import map_rows, table

#: Bytes of words stay (A-Z lower-cased), all other ASCII becomes a blank; bytes from 0x80 belong to words.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

#: Phrases that are always reported, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Notices looked for with edits: label, words and which of the words decide the licence.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("bsd", "redistribution and use in source and binary forms", ""),
    ("cc-by-nc", "licensed under cc by nc 4 0", "nc"),
    ("cc-by-sa", "creative commons attribution sharealike", "sharealike"),
    ("gpl", "licensed under the gnu general public license", "gnu general"),
    ("mit", "released under the mit license", "mit"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla"),
    ("public-domain", "released into the public domain", "public domain"),
    ("reserved", "all rights reserved", ""),
    ("bsd", "released under the bsd license", "bsd"),
    ("gpl", "released under the gpl license", "gpl"),
    ("isc", "released under the isc license", "isc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "nd"),
)
#: One edit for so many characters of a notice.
CHARS_AN_EDIT = 10
#: One edit for so many characters of the deciding words, and one at least.
DECIDING_AN_EDIT = 5


def _row(wanted: bytes, text: bytes) -> list[int]:
    """The edits between wanted and each prefix of the text."""
    row = list(range(len(text) + 1))
    for k, w in enumerate(wanted, 1):
        before, row = row, [k]
        for i, c in enumerate(text):
            row.append(min(before[i] + (w != c), before[i + 1] + 1, row[i] + 1))
    return row


@dataclass
class Notice:
    label: str
    words: str
    edits: int
    deciding: str = ""
    pieces: list[tuple[bytes, int]] = field(default_factory=list)

    def __post_init__(self):
        raw, n = self.words.encode(), self.edits + 1
        cuts = [len(raw) * i // n for i in range(n + 1)]
        self.pieces = [(raw[s:e], s) for s, e in zip(cuts, cuts[1:], strict=False)]
        self.pattern = regex.compile(rb"(?e)(?<![^ ])(?:" + regex.escape(raw, special_only=True) + b"){e<=" + str(self.edits).encode() + rb"}(?![^ ])")

    def decided(self, found: bytes, edits: int) -> bool:
        """Whether the edits can be shared out so that few enough fall on the deciding words."""
        if not edits or not self.deciding:
            return True
        before, word, after = (x.encode() for x in self.words.partition(self.deciding))
        most = max(1, len(word) // DECIDING_AN_EDIT)
        head, tail = _row(before, found), _row(after[::-1], found[::-1])[::-1]
        for i in range(len(found) + 1):
            if head[i] <= edits:
                for n, own in enumerate(_row(word, found[i : i + len(word) + most])):
                    if own <= most and head[i] + own + tail[i + n] <= edits:
                        return True
        return False

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) of the places of the notice in the blank-joined words."""
        windows = []
        for piece, offset in self.pieces:
            at = text.find(piece)
            while at >= 0:
                windows.append((max(0, at - offset - self.edits), at - offset + len(self.words) + self.edits))
                at = text.find(piece, at + 1)
        out, end = [], -1
        for low, high in _merged(windows):
            at = max(low, end)
            stop = text.find(b" ", high)  # the window ends between words, or a hit could end inside one
            stop = len(text) if stop < 0 else stop
            while m := self.pattern.search(text, at, stop):
                edits = sum(m.fuzzy_counts)
                if self.decided(m.group(), edits):
                    out.append((m.start(), m.end(), edits))
                    at = end = m.end()
                else:
                    at = m.start() + 1
        return out


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def notices(listed=NOTICES, chars_an_edit: int = CHARS_AN_EDIT) -> list[Notice]:
    return [Notice(label, words, max(1, len(words) // chars_an_edit), *deciding) for label, words, *deciding in listed]


def _fewest(found: list[tuple[int, int, int, Notice]]) -> list[tuple[int, int, int, Notice]]:
    """The spans without those that overlap one of fewer edits."""
    kept, near = set(), {}  # near: places kept by stretches of 64 bytes
    for at in sorted(range(len(found)), key=lambda k: found[k][2]):
        start, end, edits, _ = found[at]
        stretches = range(start >> 6, (end >> 6) + 1)
        if not any(n < edits and s < end and start < e for x in stretches for s, e, n in near.get(x, ())):
            kept.add(at)
            for x in stretches:
                near.setdefault(x, []).append((start, end, edits))
    return [one for at, one in enumerate(found) if at in kept]


def scan(text: str, fuzzy: list[Notice], phrases=PHRASES) -> dict:
    """Words, exact places and fuzzy spans of one text; spans count words from 0, their end exclusive."""
    words = text.encode().translate(_WORDS).split()
    joined = b" ".join(words)
    padded = b" %s " % joined
    places, base = [], set()
    for phrase, label in phrases:
        wanted = b" %s " % phrase.encode()
        at = padded.find(wanted)
        while at >= 0:
            places.append(padded.count(b" ", 0, at))
            base.add(label)
            at = padded.find(wanted, at + 1)
    spans = [
        {"label": n.label, "start": joined.count(b" ", 0, s), "end": joined.count(b" ", 0, e) + 1, "edits": edits, "likeness": 1 - edits / len(n.words)}
        for s, e, edits, n in _fewest([(*span, n) for n in fuzzy for span in n.spans(joined)])
    ]
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s["label"] for s in spans})),
        "score": 1.0 if places else max((s["likeness"] for s in spans), default=0.0),
        "spans": spans,
    }


SPAN = "struct<label:string,start:bigint,end:bigint,edits:int,likeness:double>"


def license_scan(docs: DataFrame, listed=NOTICES, phrases=PHRASES, chars_an_edit: int = CHARS_AN_EDIT) -> DataFrame:
    """doc_id, the counts, labels, score and fuzzy spans of each document."""

    def make():
        fuzzy = notices(listed, chars_an_edit)
        return lambda row: {"doc_id": row["doc_id"]} | scan(row["text"] or "", fuzzy, phrases)

    return map_rows(
        docs.select("doc_id", "text"), make,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        f"score double, spans array<{SPAN}>",
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
