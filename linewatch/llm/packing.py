"""Packing of token sequences: whole windows, a least-squares plan for the tails, and a cut stream of what is left.

Documents are cut into full windows and a tail. Tails of one length are interchangeable, so the plan
needs only the histogram of lengths: the pairs and triples of lengths that fill a window exactly are
the columns of a non-negative least-squares problem whose solution, rounded down, says how often each is used.
A tail finds its place by its rank among the tails of its length. Tails beyond the plan form one stream
that is cut at window borders, so only its last sequence is padded.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewatch.llm.batches import text_batches
from linewatch.llm.encode import encoder
from linewatch.llm.ranks import parts_for, ranked
from linewatch.session import materialise

END = 0


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """All pairs and triples of ``lengths`` that fill the window; a pair has 0 in place of the third."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    a, b = np.meshgrid(lengths, np.append(0, lengths), indexing="ij")
    c = window - a - b
    # a is the longest; b may be absent only if c is too, which would be a whole window.
    good = (b > 0) & (c >= 0) & (a >= b) & (b >= c)
    a, b, c = a[good], b[good], c[good]
    there = (c == 0) | have[c]
    return np.stack([a[there], b[there], c[there]], axis=1)


def least_squares(combos: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeats x >= 0 that bring the lengths used closest to ``counts`` (by length; place 0 is void),
    by accelerated projected gradients."""
    if len(combos) == 0:
        return np.zeros(0)
    n = len(counts)

    def used(x):
        total = sum(np.bincount(combos[:, k], x, n) for k in range(3))
        total[0] = 0
        return total

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[combos].sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(30):
        v = back(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (norm * 1.02)
    target = counts.astype(float)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * back(used(y) - target), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass(frozen=True)
class Plan:
    """Slots ordered by (length, first rank): the tail of rank r in a slot goes to sequence
    ``sequence + r - first``. Ranks from ``used[length]`` on are in the stream, whose tails of a length start at ``stream[length]``."""

    window: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray
    stream: np.ndarray
    planned: int
    sequences: int


def make_plan(window: int, counts: np.ndarray) -> Plan:
    """``counts`` of tails by length, 0 to ``window`` - 1. All of it is bounded by the window."""
    combos = combinations(window, np.flatnonzero(counts[1:]) + 1)
    repeats = np.floor(least_squares(combos, counts)).astype(np.int64)
    left = counts.astype(np.int64).copy()
    taken = np.zeros(len(combos), np.int64)
    # The rounded solution first, then whatever else still fits, the longest pieces first.
    for limits in (repeats, np.full(len(combos), np.iinfo(np.int64).max)):
        for p in np.lexsort((-combos[:, 0], -limits)) if len(combos) else ():
            if limits[p] <= 0:
                continue
            need = np.bincount(combos[p][combos[p] > 0])
            at = np.flatnonzero(need)
            n = min(int(limits[p]), int((left[at] // need[at]).min()))
            if n:
                left[at] -= n * need[at]
                taken[p] += n
    rows, next_rank, sequence = [], np.zeros(window, np.int64), 0
    for p in np.flatnonzero(taken):
        offset = 0
        for length in combos[p][combos[p] > 0]:
            rows.append((length, next_rank[length], sequence, offset))
            next_rank[length] += taken[p]
            offset += length
        sequence += taken[p]
    slots = np.array(sorted(rows), np.int64).reshape(-1, 4)
    tokens = left * np.arange(window)
    stream = np.cumsum(tokens) - tokens
    total = int(tokens.sum())
    return Plan(window, *slots.T, next_rank, stream, sequence, sequence + -(-total // window))


def _tokenise(batches, path: str, window: int):
    enc = encoder(path)
    kind = np.uint16 if enc.size <= 1 << 16 else np.uint32
    for batch in batches:
        text = batch.column("text")
        for at in range(0, batch.num_rows, 256):
            chunks, tails, totals = [], [], []
            for value in text.slice(at, 256):
                ids = np.append(enc.ids(value.as_py() or ""), np.uint32(END)).astype("<u4")
                full = len(ids) // window
                chunks.append([zlib.crc32(ids[i * window : (i + 1) * window].tobytes()) for i in range(full)])
                tails.append(ids[full * window :].astype(kind).tobytes())
                totals.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(at, 256),
                    pa.array(totals, pa.int64()),
                    pa.array(chunks, pa.list_(pa.int64())),
                    pa.array(tails, pa.binary()),
                ],
                names=["doc_id", "doc_tokens", "full_crc32", "tail"],
            )


def _place(batches, path: str, plan: Plan):
    kind = np.uint16 if encoder(path).size <= 1 << 16 else np.uint32
    big = np.int64(1) << 44
    order = plan.length * big + plan.first
    for batch in batches:
        rank, length, start = (batch.column(c).to_numpy() for c in ("rank", "tail_tokens", "tail_start"))
        tails = batch.column("tail")
        ids = [np.frombuffer(tails[i].as_buffer(), kind).astype("<u4") for i in range(batch.num_rows)]
        planned = rank < plan.used[length]
        slot = np.searchsorted(order, length * big + rank, "right") - 1
        at = plan.stream[length] + (rank - plan.used[length]) * length
        rows = []
        for i in range(batch.num_rows):
            if planned[i]:
                s = slot[i]
                pieces = [(0, length[i], plan.sequence[s] + rank[i] - plan.first[s], plan.offset[s])]
            else:
                sequence, offset = plan.planned + at[i] // plan.window, at[i] % plan.window
                head = min(length[i], plan.window - offset)
                pieces = [(0, head, sequence, offset)]
                if head < length[i]:
                    pieces.append((head, length[i], sequence + 1, 0))
            rows += [(i, x, y - x, zlib.crc32(ids[i][x:y].tobytes()), s, o) for x, y, s, o in pieces]
        row, begin, size, crc, sequence, offset = np.array(rows, np.int64).reshape(-1, 6).T
        taken = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(taken),
                pa.array(start[row] + begin),
                pa.array(size),
                pa.array(crc),
                batch.column("doc_tokens").take(taken),
                pa.array(sequence),
                pa.array(offset),
            ],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )


def pack(documents: DataFrame, tokenizer: str, window: int = 1024) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    ``tokenizer`` is a file that all executors have at that path. A document is its ids and then id 0; null and
    empty texts are id 0 alone. Rows are packed one by one, so repeated rows and ids are each packed. Sequence ids are gapless from
    0; only the last sequence of the stream is not full. Sequences of an empty table: none."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    tokens = documents.select("doc_id", "text").mapInArrow(
        lambda batches: _tokenise(batches, tokenizer, window),
        f"doc_id {kind}, doc_tokens bigint, full_crc32 array<bigint>, tail binary",
    )
    with text_batches(spark):
        tokens = materialise(spark, tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")

    tail_tokens = (F.col("doc_tokens") % window).alias("tail_tokens")
    histogram = tokens.groupBy(tail_tokens).count().collect()  # a row per length below the window
    counts = np.zeros(window, np.int64)
    for length, n in histogram:
        counts[length] = n
    counts[0] = 0
    plan = make_plan(window, counts)

    # Ranks within a length, counted in parts so that a frequent length is many tasks' work.
    part = F.pmod(F.xxhash64("row"), F.lit(parts_for(int(counts.sum())))).alias("part")
    tails = tokens.where(F.col("doc_tokens") % window > 0).select(
        "doc_id", "doc_tokens", "row", "tail", tail_tokens, (F.col("doc_tokens") - F.col("doc_tokens") % window).alias("tail_start"), part
    )
    ranks = ranked(tails.drop("tail"), ["tail_tokens"], "part", ["row"], "rank").select("row", "rank")
    placed = tails.drop("part").join(ranks, "row").mapInArrow(
        lambda batches: _place(batches, tokenizer, plan),
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )

    # Full windows are numbered on, by the partition that wrote them and the place in it.
    chunk = F.shiftright("row", 33).alias("chunk")
    full = tokens.where(F.size("full_crc32") > 0).select("doc_id", "doc_tokens", "full_crc32", "row", chunk)
    sums = full.groupBy("chunk").agg(F.sum(F.size("full_crc32")).alias("n"))
    over = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row per written partition
    sums = sums.select("chunk", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy("chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = full.withColumn("inner", F.coalesce(F.sum(F.size("full_crc32")).over(inside), F.lit(0))).join(sums, "chunk")
    whole = numbered.select(
        "doc_id", "doc_tokens", "before", "inner", F.posexplode("full_crc32").alias("i", "ids_crc32")
    ).select(
        "doc_id",
        (F.col("i") * window).cast("bigint").alias("start"),
        F.lit(window).cast("bigint").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.lit(plan.sequences) + F.col("before") + F.col("inner") + F.col("i")).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return whole.unionByName(placed)
