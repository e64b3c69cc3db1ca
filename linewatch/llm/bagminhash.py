"""Near-duplicates of documents by BagMinHash signatures of their word-shingle multisets.

A shingle of weight w owns a Poisson process over the weights [0, w), cut at the powers of
two. The process of a stretch is the same for all documents; its points come in ascending
time, each with a register and a position in the stretch that is read off bit by bit, so that a weight inside a
stretch keeps just the points below it. A register keeps its earliest point. Two documents agree in a register with the
probability of their weighted Jaccard similarity, sum of min over sum of max.

Signatures are banded. A round compares the members of a bucket with one of them only, the one that shares most,
so a large group of copies costs a comparison each. Rounds go on, with other members, while much is left in
different classes and they still link something; a last one compares, in blocks, all pairs of a bucket that are not yet in one class. Whether
two documents link is decided by their exact multisets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.llm.batches import text_batches
from linewatch.llm.components import components
from linewatch.llm.words import hash_shingles, hash_words, mix, text_slices
from linewatch.session import materialise


@dataclass(frozen=True)
class Near:
    """``bands`` of ``rows`` registers. At the threshold a pair shares no band with probability
    (1 - 0.8^5)^20, some 0.0004."""

    width: int = 5
    threshold: float = 0.8
    bands: int = 20
    rows: int = 5
    # Pairs whose signatures agree in this share less than the threshold are not verified: four deviations.
    slack: float = 0.16
    # Signatures compared with each other in one task at most.
    block: int = 1024
    # Signatures of other classes for each member of a bucket that are compared without another round.
    linear: float = 500.0
    # Ids below this size go to every executor; a larger table is joined by shuffles.
    small_rows: int = 4_000_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows


_TO_UNIT = 2.0**-53


def bags(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight) of all rows, ordered by row and shingle."""
    shingles, rows = hash_shingles(*hash_words(data, offsets), width)
    order = np.lexsort((shingles, rows))
    shingles, rows = shingles[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return rows[at], shingles[at], np.diff(np.append(at, len(rows)))


def signatures(rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """A register's earliest point as a 64-bit number, for each of ``n`` rows; 0 for rows without shingles."""
    total = np.bincount(rows, weights, n)
    # One process for each stretch [0,1), [1,2), [2,4), ... below the weight.
    stretches = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 2))).astype(np.int64) + 1, 1)
    owner = np.repeat(np.arange(len(rows)), stretches)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    length = np.maximum(low, 1)
    row, limit_of = rows[owner], weights[owner]
    seed = mix(shingles[owner] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    time = np.zeros(len(owner))
    state = seed
    registers = np.full(n * m, np.inf)
    with np.errstate(divide="ignore"):
        limit = np.where(total > 0, m / total * (np.log(m) + 3), 0)

    def advance(state, time, length):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        gap = -np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * _TO_UNIT)
        return state, time + gap / length

    state, time = advance(state, time, length)
    while len(time):
        near = time <= limit[row]
        while near.any():
            at = np.flatnonzero(near)
            drawn = mix(state[at] ^ np.uint64(0xD1B54A32D192ED03))
            register = ((drawn >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            # The position: as many bits as the stretch has halvings.
            place = low[at] + ((drawn & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length[at]).astype(np.int64)
            kept = place < limit_of[at]
            np.minimum.at(registers, row[at][kept] * m + register[kept].astype(np.int64), time[at][kept])
            state[at], time[at] = advance(state[at], time[at], length[at])
            near = np.zeros(len(time), bool)
            near[at] = time[at] <= limit[row[at]]
        # Rows with an empty register go on for longer; the others are done.
        empty = np.isinf(registers.reshape(n, m)).any(axis=1) & (total > 0)
        limit = np.where(empty, limit * 1.5, limit)
        going = empty[row]
        row, state, time, length, low, limit_of = (x[going] for x in (row, state, time, length, low, limit_of))
    registers[np.isinf(registers)] = 0
    return mix(registers.view(np.uint64)).reshape(n, m)


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Wrapping sums of 64-bit numbers by row; ``rows`` ascends."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    at = np.searchsorted(rows, np.arange(n + 1))
    return sums[at[1:]] - sums[at[:-1]]


_KEYS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))


def bag_keys(rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """128 bits that name the multiset of a row."""
    out = np.empty((n, 2), ">u8")
    for k, salt in enumerate(_KEYS):
        out[:, k] = _per_row(mix(mix(shingles ^ salt) + weights.astype(np.uint64)), rows, n)
    return out


def _blobs(values: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    values = np.ascontiguousarray(values)
    size = values.dtype.itemsize * values.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(values), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _sign(batches: Iterator[pa.RecordBatch], near: Near) -> Iterator[pa.RecordBatch]:
    m = near.registers
    for batch in batches:
        for first, data, offsets in text_slices(batch.column("text")):
            n = len(offsets) - 1
            rows, shingles, weights = bags(data, offsets, near.width)
            worded = np.bincount(rows, minlength=n) > 0
            signed = signatures(rows, shingles, weights, n, m)
            keys = bag_keys(rows, shingles, weights, n)
            bands = signed.reshape(n, near.bands, near.rows)
            folded = np.zeros((n, near.bands), np.uint64)
            for k in range(near.rows):
                folded = mix(folded + bands[:, :, k] + np.arange(1, near.bands + 1, dtype=np.uint64))
            absent = pa.array(~worded)
            null = pa.scalar(None, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, n),
                    pa.compute.if_else(absent, null, _blobs(keys)),
                    pa.compute.if_else(absent, null, _blobs(folded.view(np.int64))),
                    pa.compute.if_else(absent, null, _blobs(signed.astype(np.uint16))),
                    batch.column("text_key").slice(first, n),
                    batch.column("text_hash").slice(first, n),
                ],
                names=["doc_id", "key", "bands", "signature", "text_key", "text_hash"],
            )


def sign(documents: DataFrame, near: Near) -> DataFrame:
    """doc_id, text_hash, key, bands, signature. A text without a word has no signature; its key is the hash of
    the text, or null for a null or empty text."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    # Only the wordless need the hash of the text.
    bare = F.when((text != "") & ~text.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), F.unhex(F.md5(text)))
    hashed = F.xxhash64("text").alias("text_hash")
    signed = documents.select("doc_id", text.alias("text"), bare.alias("text_key"), hashed).mapInArrow(
        lambda batches: _sign(batches, near),
        f"doc_id {kind}, key binary, bands binary, signature binary, text_key binary, text_hash bigint",
    )
    return signed.select("doc_id", "text_hash", F.coalesce("key", "text_key").alias("key"), "bands", "signature")


def _buckets(signed: DataFrame, near: Near) -> DataFrame:
    """key, band, bucket of one document of each multiset."""
    width = 16
    hexed = F.hex("bands")
    each = F.transform(F.sequence(F.lit(0), F.lit(near.bands - 1)), lambda b: F.substring(hexed, b * width + 1, F.lit(width)))
    return signed.select("key", "doc_id", F.posexplode(each).alias("band", "bucket"))


def _bags(documents: DataFrame, ids: DataFrame, near: Near) -> DataFrame:
    """key, bag of the documents of ``ids`` (doc_id), read again. A bag is the sorted hashes of a
    text's shingles, each with the number of its occurrence, so the weighted similarity of two texts is the plain one of their bags."""
    spark = documents.sparkSession
    ids = materialise(spark, ids.select(F.col("doc_id").alias("own_id")).distinct(), "named")
    small = ids.count() <= near.small_rows
    chosen = documents.select("doc_id", "text").join(
        F.broadcast(ids) if small else ids, F.col("doc_id").eqNullSafe(F.col("own_id")), "left_semi"
    )

    def pack(batches):
        for batch in batches:
            for _, data, offsets in text_slices(batch.column("text")):
                n = len(offsets) - 1
                rows, shingles, weights = bags(data, offsets, near.width)
                keys = bag_keys(rows, shingles, weights, n)
                at = np.repeat(np.arange(len(rows)), weights)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(weights) - weights, weights)
                hashes, rows = mix(shingles[at] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), rows[at]
                hashes = hashes[np.lexsort((hashes, rows))]
                ends = np.searchsorted(rows, np.arange(n + 1))
                bag = pa.array([hashes[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([_blobs(keys), bag], names=["key", "bag"])

    packed = chosen.mapInArrow(pack, "key binary, bag binary").dropDuplicates(["key"])
    return materialise(spark, packed, "bags")


def _similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    least, most = sorted((len(x), len(y)))
    if least < threshold * most:
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    common = int((x[at] == y).sum())
    return common >= threshold * (len(x) + len(y) - common)


def _verify(documents: DataFrame, pairs: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b: keys, with doc_a, doc_b) whose multisets are similar enough."""
    ids = pairs.select(F.col("doc_a").alias("doc_id")).unionByName(pairs.select(F.col("doc_b").alias("doc_id")))
    packed = _bags(documents, ids, near)
    left = packed.withColumnsRenamed({"key": "a", "bag": "bag_a"})
    right = packed.withColumnsRenamed({"key": "b", "bag": "bag_b"})

    def compare(batches):
        for batch in batches:
            x, y = batch.column("bag_a"), batch.column("bag_b")
            kept = [
                _similar(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), near.threshold)
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(compare, "a binary, b binary")


def _compare_blocks(pdf, near: Near):
    """Links across classes, found at the first band that a pair shares: side 0 of each (band, bucket, i, j) against its
    side 1, or against itself where there is none. Of the links of a block, those that join what its earlier ones have not."""
    import pandas as pd

    if not len(pdf):
        return pd.DataFrame({"a": [], "b": []})
    pdf = pdf.sort_values(["band", "bucket", "i", "j"], kind="stable")
    signatures = np.frombuffer(b"".join(pdf["signature"]), np.uint16).reshape(len(pdf), -1)
    bands = np.frombuffer(b"".join(pdf["bands"]), np.int64).reshape(len(pdf), -1)
    key, cls, side = pdf["key"].to_numpy(), pdf["class"].to_numpy(), pdf["side"].to_numpy()
    found = [np.frombuffer(b, np.uint64) for b in pdf["bag"]]
    group = pdf.groupby(["band", "bucket", "i", "j"], sort=True).ngroup().to_numpy()
    ends = np.flatnonzero(np.diff(group, append=-1)) + 1
    out = []
    for first, last in zip(np.append(0, ends[:-1]), ends):
        parent: dict[bytes, bytes] = {}

        def root(c):
            while c in parent:
                c = parent[c]
            return c

        x = first + np.flatnonzero(side[first:last] == 0)
        y = first + np.flatnonzero(side[first:last] == 1)
        own = len(y) == 0
        y = x if own else y
        band = int(pdf["band"].iat[first])
        for i in x:
            to = y[cls[y] != cls[i]]
            if own:
                to = to[to > i]
            to = to[(signatures[to] == signatures[i]).mean(axis=1) >= near.threshold - near.slack]
            to = to[~(bands[to, :band] == bands[i, :band]).any(axis=1)]
            for j in to:
                mine, theirs = root(cls[i]), root(cls[j])
                if mine != theirs and _similar(found[i], found[j], near.threshold):
                    parent[mine] = theirs
                    out.append((key[i], key[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def _rest_links(documents: DataFrame, rest: DataFrame, distinct: DataFrame, near: Near) -> DataFrame:
    """Links across the classes of mixed buckets. The members of a bucket's largest class
    meet only the others; both sides go in blocks, so a task holds a few blocks whatever the bucket."""
    other = F.col("class") != F.col("top")
    n_other, n_top = F.ceil((F.col("n") - F.col("n_top")) / near.block).cast("int"), F.ceil(F.col("n_top") / near.block).cast("int")
    own = F.pmod(F.xxhash64("key"), F.when(other, n_other).otherwise(n_top)).cast("int")

    def upto(n):
        return F.sequence(F.lit(0), n - 1)

    def spot(i, j, side):
        return F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    # j counts blocks of the largest class from 0, and of the others from -1 down.
    with_top = F.transform(upto(n_top), lambda j: spot(own, j, F.lit(0)))
    with_others = F.transform(
        upto(n_other), lambda o: spot(F.least(own, o), -1 - F.greatest(own, o), own > o)
    )
    as_top = F.transform(upto(n_other), lambda i: spot(i, own, F.lit(1)))
    spots = F.when(other, F.concat(with_top, with_others)).otherwise(as_top)
    blocks = rest.withColumn("spot", F.explode(spots)).select("band", "bucket", "key", "class", "spot.*")
    blocks = blocks.join(distinct, "key").join(_bags(documents, rest.select("doc_id"), near), "key")
    # Many small blocks share a group; a large bucket's blocks count as often as they are compared.
    compared = rest.agg(F.sum(F.when(other, n_top + n_other).otherwise(n_other).cast("bigint"))).first()[0] or 0
    groups = F.lit(max(compared // (2 * near.block), 1) * 4)
    pooled = blocks.withColumn("pool", F.pmod(F.xxhash64("band", "bucket", "i", "j"), groups))
    return pooled.groupBy("pool").applyInPandas(lambda pdf: _compare_blocks(pdf, near), "a binary, b binary").distinct()


def near_duplicates(documents: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, text_hash, class_id, kept: one row per row of ``documents``.

    ``class_id`` is the least ``doc_id`` of the class: documents linked through pairs of weighted Jaccard
    similarity of at least ``threshold``. A document of fewer words than ``width``, but not none, is one shingle. Texts
    without a word are alike only if equal; null and empty texts are each a class of
    their own. ``kept`` is true for one document of each class, that of the least id and text hash; rows equal in both are
    all marked. A null id is its class's only if the class has no other. ``text_hash`` tells the texts of one id apart."""
    with text_batches(documents.sparkSession):
        return _classes(documents, near)


def _classes(documents: DataFrame, near: Near) -> DataFrame:
    spark = documents.sparkSession
    signed = materialise(spark, sign(documents, near), "signatures")
    one = signed.where("bands is not null").groupBy("key").agg(
        F.first("bands").alias("bands"), F.first("signature").alias("signature"), F.min("doc_id").alias("doc_id")
    )
    one = materialise(spark, one, "distinct")
    distinct = one.drop("doc_id")
    buckets = _buckets(one, near)
    shared = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("shared")).where("shared > 1")
    buckets = materialise(spark, buckets.join(shared, ["band", "bucket"]), "buckets")
    # How much a member shares: what many others are copies of has the most.
    weight = buckets.groupBy("key").agg(F.sum("shared").alias("weight"), F.first("doc_id").alias("doc_id"))
    weight = materialise(spark, weight, "weights")

    links, classes, fresh, turn = None, None, True, 0
    while True:
        held = weight.withColumn("class", F.col("key"))
        if classes is not None:
            held = weight.join(classes.withColumnRenamed("node", "key"), "key", "left")
            held = held.select("key", "weight", "doc_id", F.coalesce("component", "key").alias("class"))
        held = buckets.select("band", "bucket", "key").join(held, "key")
        sizes = held.groupBy("band", "bucket", "class").agg(F.count(F.lit(1)).alias("c"))
        tops = sizes.groupBy("band", "bucket").agg(
            F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max(F.struct("c", "class")).alias("most")
        )
        tops = tops.where("n * n > squares").select(
            "band", "bucket", "n", F.col("most.c").alias("n_top"), F.col("most.class").alias("top"), "squares"
        )
        rest = materialise(spark, held.join(tops, ["band", "bucket"]), "mixed")
        # A member's share of its bucket's pairs across classes.
        members, across = rest.agg(F.count(F.lit(1)), F.sum((F.col("n") - F.col("squares") / F.col("n")) / 2)).first()
        if not members:
            break
        final = turn > 0 and (not fresh or across <= near.linear * members)
        if final:
            found = _rest_links(documents, rest.drop("squares", "weight"), distinct, near)
        else:
            # After the first round, a member that the largest class has left out.
            drawn = F.struct("weight", "key", "class", "doc_id")
            chosen = F.when(F.lit(turn == 0) | (F.col("class") != F.col("top")), drawn)
            hubs = rest.groupBy("band", "bucket").agg(F.max(chosen).alias("hub"))
            met = rest.join(hubs, ["band", "bucket"]).where(F.col("class") != F.col("hub.class"))
            pairs = met.select(
                F.col("key").alias("a"), F.col("hub.key").alias("b"), F.col("doc_id").alias("doc_a"), F.col("hub.doc_id").alias("doc_b")
            )
            found = _verify(documents, materialise(spark, pairs.distinct(), "pairs"), near)
        found = materialise(spark, found, "links")
        fresh = not found.isEmpty()
        links = found if links is None else links.unionByName(found)
        if fresh:
            classes = components(links)
        if final:
            break
        turn += 1
    if classes is None:
        classes = signed.where("false").select(F.col("key").alias("node"), F.col("key").alias("component"))

    member = signed.select("doc_id", "text_hash", "key").join(classes.withColumnRenamed("node", "key"), "key", "left")
    member = member.select("doc_id", "text_hash", F.coalesce("component", "key").alias("class"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    least = member.where("class is not null").groupBy("class").agg(first)
    out = member.join(least, "class", "left")
    alone = F.col("class").isNull()
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return out.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        (alone | same).alias("kept"),
    )
