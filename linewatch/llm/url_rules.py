"""URL rules by a sorted sweep over reversed hosts.

The labels of a host, last first, make a key under which a host and its subdomains are one interval: all keys that
begin with the host's. Addresses and rules are sorted by key together. A sweep keeps a stack of the
rules whose interval is open; intervals are nested, so closing ones are always on top. Each stretch of the sorted addresses is
a task; a rule goes to the stretches that its interval reaches.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.llm.words import ascii_lower
from linewatch.session import materialise

#: Addresses of one stretch, about.
STRETCH_ROWS = 500_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """Labels in reverse, each closed by the lowest character."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x01"))


class Sweep:
    """The stack of open rules: one level per host key, nested."""

    def __init__(self):
        self.levels: list[tuple[str, str, dict[str, str]]] = []

    def close(self, key: str) -> None:
        while self.levels and not key.startswith(self.levels[-1][0]):
            self.levels.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.levels or self.levels[-1][0] != key:
            self.levels.append((key, host, {}))
        known = self.levels[-1][2]
        # Of two rules that are the same, the one that blocks holds.
        known[path] = "block" if "block" in (verdict, known.get(path)) else verdict

    def judge(self, key: str, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict."""
        self.close(key)
        best = (-1, -1, None, None)
        for _, own, paths in self.levels:
            if host != own and not host.endswith("." + own):
                continue
            # The longest beginning of the path that is a rule.
            for n in sorted({len(p) for p in paths}, reverse=True):
                if n <= len(path) and path[:n] in paths:
                    best = max(best, (len(own) + n, len(own), own + path[:n], paths[path[:n]]), key=lambda b: b[:2])
                    break
        return best[2], best[3]


def _sweep(batches):
    """Rows come by (stretch, key, kind): rules before the addresses of their key."""
    at, sweep = None, Sweep()
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("stretch", "key", "kind", "host", "path", "verdict")]
        for i, (stretch, key, kind, host, path, verdict) in enumerate(zip(*columns)):
            if stretch != at:
                at, sweep = stretch, Sweep()
            if kind == 0:
                sweep.open(key, host, path, verdict)
            else:
                out.append((i, *sweep.judge(key, host, path)))
        rows = pa.array([o[0] for o in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(rows) for c in ("page_id", "host", "path")],
                pa.array([o[1] for o in out], pa.string()),
                pa.array([o[2] for o in out], pa.string()),
            ],
            names=["page_id", "host", "path", "rule", "verdict"],
        )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict: one row per row of ``pages`` (page_id, url).

    ``rules`` has host, path, verdict. A rule fits its host and all subdomains if the path begins with its path; the longest, host and
    path together, wins, then the longer host; of equal rules ``block``. Where none fits, ``rule`` is null and the verdict is
    ``default``. Null urls and those without ``://`` have an empty host and path, which only rules of an empty host and
    path fit. Rules with a null part are ignored; repeated rows are judged each; other columns are not looked at."""
    spark = pages.sparkSession
    url = F.col("url")
    addresses = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    addresses = addresses.withColumn("key", key_of(F.col("host")))
    stretches = pages.count() // stretch_rows + 1
    # The path and the page deal out a frequent host.
    dealt = addresses.repartitionByRange(stretches, "key", "path", "page_id")
    dealt = materialise(spark, dealt.withColumn("stretch", F.spark_partition_id()), "addresses")
    # A row per stretch.
    ends = sorted(tuple(r) for r in dealt.groupBy("stretch").agg(F.min("key"), F.max("key")).collect())
    firsts, lasts = [e[1] for e in ends], [e[2] for e in ends]

    @F.udf("array<int>")
    def reached(key):
        # From the first stretch that ends at the key or later to the last that begins within its interval.
        low = bisect_left(lasts, key)
        high = bisect_right(firsts, key + "\U0010ffff")
        return [ends[i][0] for i in range(low, high)]

    given = rules.where("host is not null and path is not null and verdict is not null").select("host", "path", "verdict").distinct()
    given = given.withColumn("key", key_of(F.col("host"))).withColumn("stretch", F.explode(reached("key")))
    nothing = F.lit(None).cast(pages.schema["page_id"].dataType)
    both = given.select("stretch", "key", F.lit(0).alias("kind"), nothing.alias("page_id"), "host", "path", "verdict").unionByName(
        dealt.select("stretch", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    swept = (
        both.repartition(max(len(ends), 1), "stretch")
        .sortWithinPartitions("stretch", "key", "kind")
        .mapInArrow(_sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
    )
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
