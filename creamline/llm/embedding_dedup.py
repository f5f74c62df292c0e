"""Near-duplicate embeddings with binary codes under random rotations.

A vector is normalised and rotated at random, once; the signs of its coordinates are its code, and the inner product
of the rotated vector with its own code its correction factor. Both are stored with the vector. Another rotated vector times the code,
over the factor, is an unbiased estimate of the inner product of the two, with a known confidence bound. A pair
whose bound stays under the threshold is left; every other pair is recomputed exactly in double precision, and
only the exact value makes a link.

Pairs are met in buckets: equal label and equal bits in one of several bands of the codes. A pair belongs to the
first band in which its bits agree, so links are counted without listing pairs: a bucket gives a sum for each
vector and the edges of a spanning forest. Buckets over TILE vectors are dealt into tiles, and each pair of
tiles is a task's group of its own. Equal vectors are one before all this, with their number.

With BANDS bands of BITS bits a pair at the threshold of 0.93 meets with probability 0.997, closer pairs with
more; measured recall is in the README. For much larger labels raise both numbers together.

Defined results: vectors that are null, zero or hold null or non-finite components, and those of null label,
link with nothing and are their own component; vectors of different length never link; rows that repeat id and
vector are vectors of their own, as are different vectors under one id; a component's id is its smallest id that is
not null, and null where it has none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import map_batches, stored, table
from creamline.llm.components import components

BANDS, BITS, ROTATIONS, SEED = 18, 10, 3, 9
TILE = 2048
#: Standard errors that the estimate is trusted to.
CONFIDENCE = 4.0


@lru_cache(maxsize=16)
def rotation(width: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine up to rounding."""
    drawn = np.random.default_rng([SEED, width, number]).standard_normal((width, width))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def bands_of(units: np.ndarray) -> np.ndarray:
    """The key of each vector in each band."""
    width = units.shape[1]
    needed, signs, number = BANDS * BITS, [], 0
    while sum(s.shape[1] for s in signs) < needed:
        signs.append(units @ rotation(width, number).T > 0)
        number += 1
    bits = np.concatenate(signs, axis=1)[:, :needed].reshape(len(units), BANDS, BITS)
    return (bits @ (1 << np.arange(BITS))).astype(np.int16)


def codes_of(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signs of each rotated vector, eight to a byte, and its inner product with its own code."""
    turned = units @ rotation(units.shape[1], 0).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])


def estimates(units: np.ndarray, codes: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of units with coded vectors, and how far they may be off."""
    width = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=width) * 2.0 - 1.0
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor
    about = (units @ rotation(width, 0).T) @ signs.T / np.sqrt(width) / factor
    return about, CONFIDENCE * spread / np.sqrt(max(width - 1, 1))


def linked(units, others, codes, factor, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs whose exact cosine reaches the threshold, out of those that the bounds leave open."""
    about, off = estimates(units, codes, factor)
    i, j = np.nonzero(about + off >= threshold)
    exact = np.einsum("ij,ij->i", units[i], others[j])
    return i[exact >= threshold], j[exact >= threshold]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The edges that join different trees, one after the other."""
    parent, kept = list(range(n)), []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            kept.append((a, b))
    return kept


def _vectors(batch: list, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch), kind).reshape(-1, width)


def coded(distinct: DataFrame, kind: str) -> DataFrame:
    """node, label, width, copies, vector (binary), code, factor and keys of each different vector."""
    names = ["node", "label", "width", "copies"]
    schema = pa.schema([
        ("node", pa.binary()), ("label", pa.string()), ("width", pa.int32()), ("copies", pa.int64()), ("vector", pa.binary()),
        ("code", pa.binary()), ("factor", pa.float64()), ("keys", pa.list_(pa.int16())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                width = batch.column("width").to_numpy()
                values, keys = batch.column("embedding").to_pylist(), [None] * batch.num_rows
                code, factor = [None] * batch.num_rows, np.zeros(batch.num_rows)
                for w in np.unique(width).tolist():
                    own = np.flatnonzero(width == w)
                    units = unit(np.array([values[i] for i in own], dtype=kind))
                    signs, factor[own] = codes_of(units)
                    for at, k, bits in zip(own.tolist(), bands_of(units), signs, strict=True):
                        keys[at], code[at] = k, bits.tobytes()
                raw = [np.array(v, dtype=kind).tobytes() for v in values]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).cast(schema.field(c).type) for c in names), pa.array(raw, pa.binary()),
                     pa.array(code, pa.binary()), pa.array(factor), pa.array(keys, schema.field("keys").type)], schema=schema
                )

    return map_batches(
        distinct.select(*names, "embedding"), run,
        "node binary, label string, width int, copies long, vector binary, code binary, factor double, keys array<short>"
    )


def tiled(codes: DataFrame) -> DataFrame:
    """A row for each vector, band and pair of tiles that it takes part in."""
    rows = codes.select("*", F.posexplode("keys").alias("band", "key"))
    bucket = ["label", "width", "band", "key"]
    large = codes.select("label", "width", F.posexplode("keys").alias("band", "key")).groupBy(*bucket).count()
    large = large.filter(F.col("count") > TILE).withColumn("tiles", F.ceil(F.col("count") / TILE).cast("int")).drop("count")
    rows = rows.join(large, bucket, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select(
        *bucket, F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "node", "copies", "vector", "code", "factor", "keys"
    )


def links(tiles: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Rows (a, b, null) for edges and (a, null, n) for links of a to n vectors, of each bucket and pair of tiles."""
    group = ["label", "width", "band", "key", "first", "second"]
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def compare(name: tuple, rows: list[dict]) -> Iterator[tuple]:
        _, width, band, _, first, second = name
        if len(rows) < 2:
            return
        units = unit(_vectors([r["vector"] for r in rows], width, kind))
        keys, nodes = np.array([r["keys"] for r in rows]), [r["node"] for r in rows]
        codes, factor = np.array([np.frombuffer(r["code"], np.uint8) for r in rows]), np.array([r["factor"] for r in rows])
        copies, tile = np.array([r["copies"] for r in rows]), np.array([r["tile"] for r in rows])
        left, right = np.flatnonzero(tile == first), np.flatnonzero(tile == second)
        found = []
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            i, j = linked(units[some], units[right], codes[right], factor[right], threshold)
            i, j = some[i], right[j]
            own = (i < j) if first == second else np.ones(len(i), dtype=bool)
            i, j = i[own], j[own]
            before = (keys[i] == keys[j]).argmax(axis=1) == band  # the first band that they share
            found.append((i[before], j[before]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
        if len(i):
            n = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
            yield from ((nodes[a], nodes[b], None) for a, b in _forest(i, j, len(rows)))
            yield from ((nodes[a], None, int(n[a])) for a in np.flatnonzero(n).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                name = tuple(row[c] for c in group)
                if name != now:
                    out += compare(now, held) if held else ()
                    now, held = name, []
                    if len(out) > 20_000:
                        yield sent(out)
                        out = []
                held.append(row)
        out += compare(now, held) if held else ()
        if out:
            yield sent(out)

    placed = tiles.repartition(*group).sortWithinPartitions(*group, "node")
    return map_batches(placed, run, "a binary, b binary, n long")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links (other vectors linked directly) and component_id (smallest vec_id reachable) of each vector."""
    kind = "<f4" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "<f8"
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = embeddings.select(
        "vec_id", F.col("label").cast("string").alias("label"), "embedding",
        F.coalesce(
            F.col("label").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0), F.lit(False)
        ).alias("usable"),
        F.xxhash64("label", "embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"),
    )
    same = ["label", "h1", "h2"]
    name = F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in ("h1", "h2")]))  # of label and content: ids may repeat
    distinct = stored(
        rows.filter("usable").groupBy(*same).agg(
            F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
        ).withColumn("node", name).withColumn("width", F.size("embedding"))
    )
    found = stored(links(tiled(stored(coded(distinct, kind))), threshold, kind))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    sums = found.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    rooted = (
        distinct.select(*same, "node", "least_id", "copies")
        .join(roots, "node", "left").join(sums.withColumnRenamed("a", "node"), "node", "left")
        .select(*same, "least_id", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    )
    firsts = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    known = rooted.join(firsts, "root").select(*same, "component", "n")
    good = rows.filter("usable").drop("embedding").join(known, same).select("vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"))
    return good.unionAll(rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long"), "vec_id"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
