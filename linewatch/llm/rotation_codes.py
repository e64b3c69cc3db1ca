"""Near-duplicates of embeddings by randomised-rotation binary codes.

A unit vector is rotated by a random orthogonal matrix and kept as the signs of its coordinates, a code, with one
correction factor: the inner product of the code's own unit vector with the rotated vector. Divided by the factor, the inner
product of a code with another vector is an unbiased estimate of the cosine, whose error is bounded by the factor with high
probability. Only pairs whose upper bound reaches the threshold are computed again from the vectors.

Pairs meet in buckets: stretches of sign bits of further rotations, so many and so long that a pair at the threshold
misses all of them with probability ``miss``. A bucket is compared in blocks; a pair counts in the first
bucket it shares, and tasks return counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.llm.components import components
from linewatch.session import materialise


@dataclass(frozen=True)
class Codes:
    threshold: float = 0.9
    miss: float = 1e-3
    #: Deviations of the estimate that the bounds allow for.
    deviations: float = 4.0
    #: Vectors that share a bucket by chance, about.
    crowd: int = 32
    block: int = 1024
    seed: int = 20240501

    def bands(self, n: int) -> tuple[int, int]:
        """(bits of a bucket, buckets of a vector) for ``n`` vectors: bits grow with the log of n, and with them the
        buckets, so a pair at the threshold is missed as rarely at any size."""
        bits = max(4, math.ceil(math.log2(max(n, 1) / self.crowd + 1)))
        meet = (1 - math.acos(self.threshold) / math.pi) ** bits
        return bits, math.ceil(math.log(self.miss) / math.log(1 - meet))


@lru_cache(maxsize=64)
def rotation(dim: int, number: int, seed: int) -> np.ndarray:
    """An orthogonal matrix; the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs as +-1/sqrt(dim), correction factors, rotated vectors)."""
    dim = units.shape[1]
    rotated = units @ rotation(dim, 0, seed)
    signs = np.where(rotated >= 0, 1, -1) / math.sqrt(dim)
    return signs, (signs * rotated).sum(axis=1), rotated


def estimate(signs: np.ndarray, factors: np.ndarray, rotated: np.ndarray, deviations: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of codes with vectors, and the bound of the error of each code."""
    dim = signs.shape[1]
    error = deviations * np.sqrt((1 - np.minimum(factors, 1) ** 2) / (factors**2 * max(dim - 1, 1)))
    return (signs @ rotated.T) / factors[:, None], error


def buckets(units: np.ndarray, bits: int, bands: int, seed: int) -> np.ndarray:
    """Bucket numbers (row, band): sign bits of as many further rotations as it takes."""
    dim = units.shape[1]
    need = bits * bands
    signs = np.hstack([units @ rotation(dim, 1 + k, seed) >= 0 for k in range(-(-need // dim))])[:, :need]
    return signs.reshape(len(units), bands, bits) @ (1 << np.arange(bits, dtype=np.int64)) + (np.int64(dim) << np.int64(bits))


def _units(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _prepare(batches, bits: int, bands: int, seed: int):
    """node, copies, vector, code, factor, buckets. Vectors of one length are coded together."""
    for batch in batches:
        values = [np.asarray(v.values, np.float64) for v in batch.column("vector")]
        lengths = np.array([len(v) for v in values])
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            raw = np.stack([values[i] for i in at])
            units = _units(raw)
            signs, factors, _ = encode(units, seed)
            codes = np.packbits(signs > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(at)),
                    batch.column("copies").take(pa.array(at)),
                    pa.array([v.tobytes() for v in raw.astype("<f8")], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(factors),
                    pa.array(list(buckets(units, bits, bands, seed)), pa.list_(pa.int64())),
                ],
                names=["node", "copies", "vector", "code", "factor", "buckets"],
            )


def _least_labels(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least node that each side reaches through ``linked``."""
    lx, ly = x.copy(), y.copy()
    big = np.iinfo(np.int64).max
    while True:
        nx = np.minimum(lx, np.where(linked, ly[None, :], big).min(axis=1, initial=big))
        ny = np.minimum(ly, np.where(linked, nx[:, None], big).min(axis=0, initial=big))
        if (nx == lx).all() and (ny == ly).all():
            return lx, ly
        lx, ly = nx, ny


def _compare(pdf, bits: int, bands: int, codes: Codes):
    """(node, links, parent) of the blocks of a pool: links found here, and a node of the same component."""
    import pandas as pd

    out = []
    if not len(pdf):
        return pd.DataFrame({"node": [], "links": [], "parent": []}).astype("int64")
    for (band, _, _, _), group in pdf.groupby(["band", "bucket", "i", "j"], sort=False):
        side = group["side"].to_numpy()
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        own = not len(y)
        y = x if own else y
        if not len(x):
            continue
        raw = np.frombuffer(b"".join(group["vector"]), "<f8").reshape(len(group), -1)
        dim = raw.shape[1]
        bytes_ = np.frombuffer(b"".join(group["code"]), np.uint8).reshape(len(group), -1)
        signs = np.where(np.unpackbits(bytes_, axis=1, count=dim), 1, -1) / math.sqrt(dim)
        units = _units(raw)
        near, error = estimate(signs[x], group["factor"].to_numpy()[x], units[y] @ rotation(dim, 0, codes.seed), codes.deviations)
        a, b = np.nonzero(near + error[:, None] >= codes.threshold)
        if own:
            a, b = a[x[a] < y[b]], b[x[a] < y[b]]
        if not len(a):
            continue
        # What the bounds leave is computed again in double precision, in stretches.
        cosine = np.concatenate(
            [np.einsum("ij,ij->i", units[x[a[s : s + 65536]]], units[y[b[s : s + 65536]]]) for s in range(0, len(a), 65536)]
        )
        good = cosine >= codes.threshold
        a, b = a[good], b[good]
        if not len(a):
            continue
        if band:
            rows = np.unique(np.concatenate([x[a], y[b]]))
            place = np.zeros(len(group), int)
            place[rows] = np.arange(len(rows))
            numbers = buckets(units[rows], bits, bands, codes.seed)[:, :band]
            first = np.concatenate(
                [
                    ~(numbers[place[x[a[s : s + 65536]]]] == numbers[place[y[b[s : s + 65536]]]]).any(axis=1)
                    for s in range(0, len(a), 65536)
                ]
            )
            a, b = a[first], b[first]
            if not len(a):
                continue
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        links = np.zeros(len(group), np.int64)
        np.add.at(links, x[a], copies[y[b]])
        np.add.at(links, y[b], copies[x[a]])
        linked = np.zeros((len(x), len(y)), bool)
        linked[a, b] = True
        if own:
            linked |= linked.T
        lx, ly = _least_labels(linked, node[x], node[y])
        parent = node.copy()
        parent[y] = ly
        parent[x] = np.minimum(lx, ly) if own else lx
        at = np.flatnonzero(links)
        out.append(pd.DataFrame({"node": node[at], "links": links[at], "parent": parent[at]}))
    return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "parent": []}).astype("int64")


def near_duplicates(vectors: DataFrame, codes: Codes = Codes()) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows of cosine ``threshold`` or more, in double precision; equal vectors are links. A null or empty vector, one
    with a null or non-finite component, and a zero vector link with nothing, and vectors of different lengths do not
    link. ``component_id`` is the least vec_id reachable by links. Rows that share a vec_id are vectors of their own; a null id takes
    part, but is least only among nulls. Other columns are not looked at."""
    spark = vectors.sparkSession
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    rows = vectors.select("vec_id", vector.alias("vector")).withColumn("valid", F.coalesce(valid, F.lit(False)))
    # Equal vectors are one node; its two hashes name it.
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    nodes = rows.where("valid").groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bits, bands = codes.bands(nodes.count())
    coded = nodes.select("node", "copies", "vector").mapInArrow(
        lambda batches: _prepare(batches, bits, bands, codes.seed),
        "node bigint, copies bigint, vector binary, code binary, factor double, buckets array<bigint>",
    )
    coded = materialise(spark, coded, "codes")

    spread = coded.select("node", F.posexplode("buckets").alias("band", "bucket"))
    sizes = spread.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialise(spark, sizes, "sizes")
    blocks = F.ceil(F.col("n") / codes.block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spots = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), (own > o).cast("int").alias("side")),
    )
    met = spread.join(sizes, ["band", "bucket"]).select("node", "band", "bucket", F.explode(spots).alias("spot"))
    met = met.select("node", "band", "bucket", "spot.*").join(coded.drop("buckets"), "node")
    # Many small blocks share a pool; a large bucket's blocks count as often as they are compared.
    compared = sizes.agg(F.sum(F.col("n") * blocks)).first()[0] or 0
    pools = max(-(-compared // (4 * codes.block)), 1)
    pooled = met.withColumn("pool", F.pmod(F.xxhash64("band", "bucket", "i", "j"), F.lit(pools)))
    found = pooled.groupBy("pool").applyInPandas(
        lambda pdf: _compare(pdf, bits, bands, codes), "node bigint, links bigint, parent bigint"
    )
    found = materialise(spark, found, "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    known = nodes.select("h1", "h2", "node", "copies").join(links, "node", "left").join(parts, "node", "left")
    known = known.select(
        "h1", "h2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "node").alias("part"),
        F.lit(True).alias("valid"),
    )
    out = rows.select("vec_id", "h1", "h2", "valid").join(known, ["h1", "h2", "valid"], "left")
    out = materialise(spark, out.select("vec_id", "links", "part"), "vectors")
    least = out.where("part is not null").groupBy("part").agg(F.min("vec_id").alias("least"))
    out = out.join(least, "part", "left")
    component = F.when(F.col("part").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
