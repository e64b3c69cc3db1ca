"""Sharding by rendezvous hashing over weighted shards.

Each shard draws a number for a record's key, and the largest wins. A draw depends on the key and the shard alone,
so one more shard takes the records that it wins and moves no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.llm.names import unused
from linewatch.llm.ranks import parts_for, ranked

#: Hexadecimal digits of a hash that a double holds exactly.
DIGITS = 13


def draw(text: Column) -> Column:
    """A number between 0 and 1, both exclusive, that any engine with MD5 can make."""
    digits = F.substring(F.md5(text), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def scores(key: Column, weights: Sequence[float]) -> list[Column]:
    """One draw for each shard, to be compared: weight over the negative log of a uniform number."""
    return [-F.lit(float(w)) / F.log(draw(F.concat(key, F.lit(f"|{i}")))) for i, w in enumerate(weights)]


def winner(drawn: Sequence[Column]) -> Column:
    """The shard of the largest draw; of equal draws the first."""
    best = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("last")) for i, s in enumerate(drawn)]))
    return (-best["last"]).cast("int")


def shard(records: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] = ()) -> DataFrame:
    """``records`` with ``shard``, ``slot`` and ``grown_shard``.

    ``key`` decides alone; a null key is the key ``null``, and rows of one key share a shard. Weights are positive; a
    shard gets its weight's share of the keys. ``slot`` counts 0, 1, ... within a shard in the order of the key's hash and then all columns.
    ``grown_shard`` is the shard under ``weights`` and then ``grown``, one more shard of the first weight if none are
    given. Columns of these names are replaced."""
    if not weights or min(weights) <= 0 or min(grown, default=1) <= 0:
        raise ValueError("weights must be positive, and there must be one")
    more = list(grown) or [weights[0]]
    names = [c for c in records.columns if c not in ("shard", "slot", "grown_shard")]
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    hashed, part = unused(records, "hashed"), unused(records, "part")
    drawn = scores(text, [*weights, *more])
    placed = records.select(
        *names,
        winner(drawn[: len(weights)]).alias("shard"),
        winner(drawn).alias("grown_shard"),
        F.md5(text).alias(hashed),
    )
    # Parts are stretches of the hash, so their order is its order.
    parts = parts_for(records.count())
    share = F.conv(F.substring(hashed, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)
    placed = placed.withColumn(part, F.floor(share * parts).cast("int"))
    order = [hashed, *[c for c in names if not placed.schema[c].dataType.typeName() in ("map", "variant")]]
    return ranked(placed, ["shard"], part, order, "slot").select(*names, "shard", "slot", "grown_shard")
