"""Token counts at every prefix, by dynamic programming over a merge vocabulary.

A merge tokenizer's encoding of a word is the one sequence of tokens in which each neighbouring pair would be
encoded as just that pair. So the last token of a prefix follows from the last tokens of shorter prefixes: it is
the token t at whose start a prefix ends whose own last token may stand before t. The count at a prefix is the
count there plus one. The table of last tokens is kept by prefix and shared between words; counts of whole words
are kept as well. Words are encoded apart, so sums over words give the count at every prefix of a text, and
truncation and budget questions are answered by looking them up.

Each task keeps tables of bounded size, which only save time. One narrow task per partition: no shuffle.

Defined results: a null text is an empty one and has no tokens; special strings of the vocabulary inside a text
are one token each, as the library has it; repeated rows are counted alike; other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from creamline.llm.common import map_rows, table

#: Characters whose lower case, composition and class are plain; other texts are normalised by the library.
_PLAIN = re.compile("[^\x00-įı-ſ–—‘-‟…€]")
_LETTERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Contractions that the vocabulary's pattern keeps whole.
_SHORT = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_WORD = re.compile(f"{'|'.join(_SHORT)}|[{_LETTERS}]+|[{_NUMBERS}]|[^\\t-\\r\x20\x85\xa0{_LETTERS}{_NUMBERS}]+")
#: Blanks surely part words.
_CHUNK = re.compile("[^ \t-\r]+")
_MOST_WORDS, _MOST_PREFIXES, _MOST_PAIRS = 800_000, 200_000, 400_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else the next free letter from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(free)) for b in range(256)}


@cache
def _seconds() -> frozenset[str]:
    """Characters that composition may join with the one before, besides marks: second halves and Hangul vowels and ends."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    found = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and p[0][0] != "<"}
    return frozenset(found | set(map(chr, range(0x1160, 0x1200))))


def _joins(c: str) -> bool:
    return unicodedata.combining(c) > 0 or c in _seconds() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn")


class PrefixCounter:
    """Counts of a words-with-ends merge vocabulary (the JSON file of the tokenizers library at path)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        model = saved["model"]
        self.library = Tokenizer.from_file(path)
        self.end = model["end_of_word_suffix"]
        self.vocabulary = set(model["vocab"])
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): k for k, m in enumerate(model["merges"])}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        specials = [t["content"] for t in saved["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")")
        self.special_start = specials[0][:2]
        self.letters = byte_letters()
        self.words: dict[str, int] = {}
        self.prefixes: dict[str, tuple[str, int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, the lowest rank first and from the left."""
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), k) for k, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def may_follow(self, before: str, token: str) -> bool:
        """Whether the pair is encoded as itself."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= _MOST_PAIRS:
                self.pairs.clear()
            bare = token.removesuffix(self.end) if token != self.end else token
            symbols = [*before, *bare]
            if bare != token:
                symbols[-1] += self.end
            known = self.pairs[before, token] = self.merged(symbols) == [before, token]
        return known

    def _state(self, word: str, size: int, states: list) -> tuple[str, int]:
        """Last token and count of the first size letters, taken as the start of a longer word."""
        prefix = word[:size]
        known = self.prefixes.get(prefix)
        if known is None:
            known = self._step(word, size, states, "")
            if len(self.prefixes) >= _MOST_PREFIXES:
                self.prefixes.clear()
            self.prefixes[prefix] = known
        return known

    def _step(self, word: str, size: int, states: list, end: str) -> tuple[str, int]:
        for start in range(max(0, size - self.longest), size):
            token = word[start:size] + end
            if token in self.vocabulary:
                if not start:
                    if len(self.merged([*word[: size - 1], word[size - 1] + end])) == 1:
                        return token, 1
                elif self.may_follow(states[start][0], token):
                    return token, states[start][1] + 1
        raise ValueError(f"no encoding for {word[:size]!r}")

    def word_counts(self, word: str) -> list[int]:
        """The count of each prefix of a word (in stand-in letters), as if the text ended there."""
        states: list = [("", 0)]
        for size in range(1, len(word)):
            states.append(self._state(word, size, states))
        return [self._step(word, size, states, self.end)[1] for size in range(1, len(word) + 1)]

    def _whole(self, word: str) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= _MOST_WORDS:
                self.words.clear()
            letters = word if word.isascii() and word.isprintable() else self._stand_ins(word)
            states: list = [("", 0)]
            for size in range(1, len(letters)):
                states.append(self._state(letters, size, states))
            known = self.words[word] = self._step(letters, len(letters), states, self.end)[1]
        return known

    def _stand_ins(self, word: str) -> str:
        return "".join(map(self.letters.__getitem__, word.encode()))

    def parts(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special strings, and whether each part is one."""
        if self.special_start not in text:
            return [(text, False)]
        return [(p, k % 2 == 1) for k, p in enumerate(self.special.split(text)) if p]

    def words_of(self, part: str) -> list[str]:
        """The words of a part without special strings, as characters."""
        if _PLAIN.search(part) is None:
            return _WORD.findall(part.lower())
        return self._pieces(self.library.normalizer.normalize_str(part))

    def count(self, text: str) -> int:
        """The tokens of the whole text."""
        return sum(
            1 if special else sum(self._whole(w) * n for w, n in Counter(self.words_of(part)).items())
            for part, special in self.parts(text)
        )

    def _chunk_counts(self, chunk: str) -> list[int]:
        """The tokens of each prefix by code points of a text without blanks, from one code point on."""
        counts: list[int] = []
        total, before = 0, ""
        for part, special in self.parts(chunk):
            if special:  # cut short it is ordinary text, read together with the part before it
                counts += [total + n for n in self._part_counts(before + part[:-1])[len(before) :]]
                total += self.count(before) + 1
                counts.append(total)
                before = ""
            else:
                counts += [total + n for n in self._part_counts(part)]
                before = part
        return counts

    def _inside(self, word: str) -> list[int]:
        """The tokens of each prefix by code points of one word."""
        if word in _SHORT:
            mark = self._whole("'")
            return [mark, *(mark + self._whole(word[1:k]) for k in range(2, len(word))), self._whole(word)]
        if word.isascii():
            return self.word_counts(word if word.isprintable() else self._stand_ins(word))
        by_byte = self.word_counts(self._stand_ins(word))
        return [by_byte[e - 1] for e in np.cumsum([len(c.encode()) for c in word])]

    def _normalised_counts(self, part: str) -> list[int]:
        """As _part_counts, where the library normalises.

        Where a code point never joins with what stands before it, the normal form up to it is a prefix of that of
        the whole part, and its count is that of a prefix of a word. Only between such places words are counted anew.
        """
        cuts = [0, *(k for k in range(1, len(part)) if not _joins(part[k])), len(part)]
        forms = [self.library.normalizer.normalize_str(part[s:e]) for s, e in zip(cuts, cuts[1:], strict=False)]
        normal = "".join(forms)
        # tokens of each prefix of the normal form, and where its last word starts and what stands before that
        tokens, start, earlier = [0] * (len(normal) + 1), [0] * (len(normal) + 1), [0] * (len(normal) + 1)
        at, total = 0, 0
        for word in self._pieces(normal):
            begin = normal.index(word, at)
            for k in range(at + 1, begin + 1):
                tokens[k], start[k], earlier[k] = total, k, total
            for k, n in enumerate(self._inside(word), begin + 1):
                tokens[k], start[k], earlier[k] = total + n, begin, total
            at = begin + len(word)
            total = tokens[at]
        for k in range(at + 1, len(normal) + 1):
            tokens[k], start[k], earlier[k] = total, k, total
        counts, end = [], 0
        for s, e, form in zip(cuts, cuts[1:], forms, strict=False):
            for k in range(s + 1, e):
                tail = normal[start[end] : end] + self.library.normalizer.normalize_str(part[s:k])
                counts.append(earlier[end] + sum(map(self._whole, self._pieces(tail))))
            end += len(form)
            counts.append(tokens[end])
        return counts

    def _pieces(self, normal: str) -> list[str]:
        back = {c: b for b, c in self.letters.items()}
        return [bytes(map(back.__getitem__, w)).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _part_counts(self, chunk: str) -> list[int]:
        """_chunk_counts of a text without special strings."""
        if _PLAIN.search(chunk) is not None:
            return self._normalised_counts(chunk)
        counts: list[int] = []
        for m in _WORD.finditer(chunk.lower()):
            word, total = m.group(), counts[-1] if counts else 0
            counts += [total] * (m.start() - len(counts))
            counts += [total + n for n in self._inside(word)]
        return counts + [counts[-1] if counts else 0] * (len(chunk) - len(counts))

    def prefix_counts(self, text: str) -> np.ndarray:
        """The tokens of each prefix by code points, of the empty one too. Blanks part words, so chunks add up."""
        counts, total, at = np.zeros(len(text) + 1, dtype=np.int64), 0, 0
        for m in _CHUNK.finditer(text):
            counts[at + 1 : m.start() + 1] = total
            counts[m.start() + 1 : m.end() + 1] = total + np.array(self._chunk_counts(m.group()))
            total, at = counts[m.end()], m.end()
        counts[at + 1 :] = total
        return counts

    def longest_prefix(self, text: str, budget: int) -> int:
        """Code points of the longest prefix that has at most budget tokens.

        Sums over chunks never fall, so only the chunk that passes the budget is looked into. Inside it counts may
        fall again (half a word can cost more than the whole), so its last fitting prefix is taken from all of them.
        """
        total, begin = 0, 0
        if _PLAIN.search(text) is None and self.special_start not in text:  # words can be summed without chunks
            whole, passed = self._whole, 0
            for m in _WORD.finditer(text.lower()):
                passed += whole(m.group())
                if passed > budget:
                    begin = 1 + max(text.rfind(blank, 0, m.start()) for blank in " \t\n\v\f\r")
                    total = passed - self.count(text[begin : m.end()])
                    break
            else:
                return len(text)
        for m in _CHUNK.finditer(text, begin):
            after = total + self.count(m.group())
            if after > budget:
                chunk = m.group()
                fits = [k for k, n in enumerate(self._chunk_counts(chunk), 1) if total + n <= budget]
                return m.start() + (fits[-1] if fits else 0)
            total = after
        return len(text)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(name: str) -> PrefixCounter:
    """The counter of a vocabulary file, kept by each Python worker."""
    if name not in _COUNTERS:
        import public_tokenizers

        _COUNTERS[name] = PrefixCounter(public_tokenizers.path(name))
    return _COUNTERS[name]


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and the code points that fit the limit (all of them where it holds)."""

    def make():
        own = counter(vocabulary)

        def row_of(row: dict) -> dict:
            text = row["text"] or ""
            n = own.count(text)
            return {
                "doc_id": row["doc_id"], "n_bytes": len(text.encode()), "n_tokens": n, "over_limit": n > limit,
                "fitting_chars": own.longest_prefix(text, limit) if n > limit else len(text),
            }

        return row_of

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the exact count at every prefix, to be stored and asked without encoding again."""

    def make():
        own = counter(vocabulary)
        return lambda row: {"doc_id": row["doc_id"], "counts": own.prefix_counts(row["text"] or "").tolist()}

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, counts array<long>")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 2048)
