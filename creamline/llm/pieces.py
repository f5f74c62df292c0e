"""SentencePiece encoding and decoding with a merge-type vocabulary.

The symbols of a chunk start as its characters. An agenda holds the adjacent pairs that the vocabulary knows, the
best score first and the leftmost of equals; the pair on top is merged, and its new neighbours join the agenda,
until none is left. Characters without a piece become bytes. The agendas of all short chunks of an Arrow batch are one
array of ranks, in which every round takes the best pair of each chunk; a long chunk has a heap of its own. No piece has the blank mark after another
character, so a text is cut before each run of marks and its chunks are encoded apart; inside, two characters
that no piece holds side by side part it further.

Each task keeps a bounded table of encoded chunks, which only saves time. For each Arrow batch the chunks that are
not in it are encoded and checked against the sentencepiece library; should one differ, the library's ids are taken
and the document reports it. Where the table is emptied, all chunks of the batch are encoded and checked again, so
every id in use was checked. Decoding is the library's. One narrow task per input partition: no shuffle.

Defined results: a null text is an empty one, with begin and end ids only; repeated rows are encoded alike;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from creamline.llm.common import map_batches, table

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_MOST_CHUNKS, _MOST_PARTS = 800_000, 200_000
#: Chunks up to so many characters are merged together with others; longer ones have a heap of their own.
_SHORT = 24
_NEVER = 1 << 30
#: The table of pairs: a hash of open slots, eight times as many as the vocabulary has pairs.
_SLOTS, _SPREAD, _SHIFT = (1 << 19) - 1, 0x9E3779B97F4A7C15, 64 - 19


def _raw(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned numbers of 32 bits."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class PieceCodec:
    """Encoder and decoder of the model file at path: merge type, byte fallback, identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        usable = [i for i in range(n) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))]
        pieces = self.library.id_to_piece(usable)
        self.ids = dict(zip(pieces, usable, strict=True))
        self.costs = {p: -self.library.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        self.joined = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        numbers = dict(self.ids)
        for piece in pieces:
            for char in piece:
                numbers.setdefault(char, len(numbers) + n)  # a character that only longer pieces hold
        ranks = {cost: rank for rank, cost in enumerate(sorted(set(self.costs.values())))}
        self.last_piece, self.number_of = n, np.full(0x110000, -1, dtype=np.int32)
        self.lone = {number: char for char, number in numbers.items() if number >= n}
        for char, number in numbers.items():
            if len(char) == 1:
                self.number_of[ord(char)] = number
        self.slot_key = np.full(_SLOTS + 1, -1, dtype=np.int64)
        self.slot_rank, self.slot_piece = np.full(_SLOTS + 1, _NEVER, dtype=np.int32), np.zeros(_SLOTS + 1, dtype=np.int32)
        for piece, cost in self.costs.items():
            for k in range(1, len(piece)):
                left, right = numbers.get(piece[:k]), numbers.get(piece[k:])
                if left is not None and right is not None:
                    key = left << 20 | right
                    slot = (key * _SPREAD & (1 << 64) - 1) >> _SHIFT
                    while self.slot_key[slot] != -1:
                        slot = (slot + 1) & _SLOTS
                    self.slot_key[slot], self.slot_rank[slot], self.slot_piece[slot] = key, ranks[cost], self.ids[piece]
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}
        self.corrected: set[str] = set()

    def agenda(self, part: str) -> list[int]:
        """The ids of characters that may merge with each other."""
        symbols: list[str] = list(part)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        costs, end = self.costs, len(symbols)
        queue = []
        for i in range(end - 1):
            cost = costs.get(symbols[i] + symbols[i + 1])
            if cost is not None:
                queue.append((cost, i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, left, right, piece = heapq.heappop(queue)
            if not symbols[left] or after[left] != right or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            beyond = after[left] = after[right]
            if beyond < end:
                before[beyond] = left
                pair = piece + symbols[beyond]
                if (cost := costs.get(pair)) is not None:
                    heapq.heappush(queue, (cost, left, beyond, pair))
            if (ahead := before[left]) >= 0:
                pair = symbols[ahead] + piece
                if (cost := costs.get(pair)) is not None:
                    heapq.heappush(queue, (cost, ahead, left, pair))
        ids: list[int] = []
        for symbol in filter(None, symbols):
            known = self.ids.get(symbol)
            ids += [known] if known is not None else [self.bytes[b] for b in symbol.encode()]
        return ids

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (_NEVER: not in the vocabulary), and its slot in the table of pairs."""
        keys = left.astype(np.int64) << 20 | right
        slot = ((keys.view(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(_SHIFT)).view(np.int64)
        odd = np.flatnonzero((self.slot_key[slot] != keys) & (self.slot_key[slot] != -1))
        while len(odd):
            slot[odd] = (slot[odd] + 1) & _SLOTS
            there = self.slot_key[slot[odd]]
            odd = odd[(there != keys[odd]) & (there != -1)]
        return np.where((self.slot_key[slot] == keys) & (left >= 0) & (right >= 0), self.slot_rank[slot], _NEVER), slot

    def agendas(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all chunks and how many each has; every round merges the best pair of each chunk at once."""
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype="<i4")
        symbols = self.number_of[codes]
        symbols = np.where(symbols < 0, -1 - codes, symbols)  # a character that no piece holds
        owner = np.repeat(np.arange(len(chunks), dtype=np.int32), sizes)
        rank, slot = np.full(len(symbols), _NEVER, dtype=np.int32), np.zeros(len(symbols), dtype=np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside], slot[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        done = []
        while len(owner):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(owner)])
            least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            going = least != _NEVER
            if not going.all():
                done.append((owner[~going], symbols[~going]))
                owner, symbols, rank, slot, least = (x[going] for x in (owner, symbols, rank, slot, least))
                if not len(owner):
                    break
            best = np.flatnonzero(rank == least)
            best = best[np.r_[True, owner[best[1:]] != owner[best[:-1]]]]  # the leftmost of equals
            symbols[best] = self.slot_piece[slot[best]]
            stays = np.ones(len(owner), dtype=bool)
            stays[best + 1] = False
            rank[best] = rank[best + 1]
            owner, symbols, rank, slot = (x[stays] for x in (owner, symbols, rank, slot))
            best -= np.arange(len(best))
            for at in (best[best > 0] - 1, best[best < len(owner) - 1]):
                at = at[owner[at] == owner[at + 1]]
                rank[at], slot[at] = self._ranks(symbols[at], symbols[at + 1])
        order = np.concatenate([o for o, _ in done]) if done else np.zeros(0, dtype=np.int64)
        place = np.argsort(order, kind="stable")
        flat = np.concatenate([x for _, x in done])[place] if done else np.zeros(0, dtype=np.int32)
        return flat, np.bincount(order, minlength=len(chunks))

    def _with_bytes(self, symbols: list[int]) -> list[int]:
        """Ids of symbols of which some are characters without a piece."""
        out = []
        for s in symbols:
            if 0 <= s < self.last_piece:
                out.append(s)
            else:
                out += [self.bytes[b] for b in (chr(-1 - s) if s < 0 else self.lone[s]).encode()]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as little-endian unsigned numbers of 32 bits."""
        out = [b""] * len(chunks)
        short = [k for k, chunk in enumerate(chunks) if len(chunk) <= _SHORT]
        flat, counts = self.agendas([chunks[k] for k in short])
        ends = np.cumsum(counts)
        plain = (flat >= 0) & (flat < self.last_piece)
        odd = set(np.searchsorted(ends, np.flatnonzero(~plain), side="right").tolist())
        raw, at = flat.astype("<u4").tobytes(), 0
        for j, (k, end) in enumerate(zip(short, (4 * ends).tolist(), strict=True)):
            out[k] = _raw(self._with_bytes(flat[at >> 2 : end >> 2].tolist())) if j in odd else raw[at:end]
            at = end
        for k, chunk in enumerate(chunks):
            if len(chunk) > _SHORT:
                out[k] = _raw(self.encode_chunk(chunk))
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        ids, start, joined = [], 0, self.joined
        for k in range(1, len(chunk) + 1):
            if k == len(chunk) or chunk[k - 1 : k + 1] not in joined:
                part = chunk[start:k]
                own = self.parts.get(part)
                if own is None:
                    if len(self.parts) >= _MOST_PARTS:
                        self.parts.clear()
                    own = self.parts[part] = self.agenda(part)
                ids += own
                start = k
        return ids

    def learn(self, chunks: set[str]) -> None:
        """Encodes chunks and checks them against the library, which puts a mark before what it is given."""
        new = chunks - self.chunks.keys()
        if len(self.chunks) + len(new) > _MOST_CHUNKS:
            self.chunks.clear()
            self.corrected.clear()
            new = chunks
        new = list(new)
        own = self.encode_chunks(new)
        for chunk, ids, theirs in zip(new, own, self.library.encode([c[1:] for c in new], num_threads=1), strict=True):
            theirs = _raw(theirs)
            if ids != theirs and chunk != MARK:  # the library gives nothing for an empty text, so a lone mark can't be asked
                self.corrected.add(chunk)
                ids = theirs
            self.chunks[chunk] = ids

    def cut(self, text: str) -> list[str]:
        return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """The ids of each text, begin and end included, and how many of its chunks the library corrected."""
        cut = [self.cut(text) for text in texts]
        self.learn(set().union(*cut))
        out, begin, end = [], _raw([self.begin]), _raw([self.end])
        for chunks in cut:
            inner = b"".join(map(self.chunks.__getitem__, chunks))
            wrong = sum(c in self.corrected for c in chunks) if self.corrected else 0
            out.append((np.frombuffer(begin + inner + end, "<u4"), wrong))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


_CODECS: dict[str, PieceCodec] = {}


def codec(name: str) -> PieceCodec:
    """The codec of a model file, kept by each Python worker."""
    if name not in _CODECS:
        import public_tokenizers

        _CODECS[name] = PieceCodec(public_tokenizers.path(name))
    return _CODECS[name]


def encode_decode(docs: DataFrame, model: str, rows_at_once: int = 128) -> DataFrame:
    """doc_id, ids, decoded and n_corrected of each document."""
    return _mapped(
        docs, model, rows_at_once, "doc_id long, ids array<int>, decoded string, n_corrected int",
        pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("n_corrected", pa.int32())]),
        lambda ids, decoded, wrong: {"ids": ids.astype(np.int32), "decoded": decoded, "n_corrected": wrong},
    )


def digests(docs: DataFrame, model: str, rows_at_once: int = 128) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_corrected of what encode_decode gives, row by row."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_corrected", pa.int32())]
    return _mapped(
        docs, model, rows_at_once, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected int", pa.schema(fields),
        lambda ids, decoded, wrong: {
            "n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(), "n_corrected": wrong,
        },
    )


def _mapped(docs, model, rows_at_once, schema, arrow, row_of) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                some = batch.slice(start, rows_at_once)
                texts = [text or "" for text in some.column(1).to_pylist()]
                rows = [
                    {"doc_id": doc_id} | row_of(ids, own.decode(ids), wrong)
                    for doc_id, (ids, wrong) in zip(some.column(0).to_pylist(), own.encode(texts), strict=True)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return map_batches(docs.select("doc_id", "text"), run, schema)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, decoded text and n_corrected (chunks in which the library's ids were taken) of each document."""
    return encode_decode(docs, "piece_bpe_32k.model")
