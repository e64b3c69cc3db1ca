"""A trie of conversations that share their first turns, without building their texts.

A conversation is rebuilt from the head of a base conversation and its own turns after the head. A sequence of turns has a fingerprint in a
monoid: the sum of x(i) * b**i modulo a prime, where x(i) is the digest of turn i, together with its length. What stands for base head
and own suffix is combined from the products of the two: a suffix moves by a factor of b, and a prefix less its last turn is a subtraction. So each prefix of each
rebuilt conversation is a few numbers, and texts are read once, for their digests.

Prefixes of equal length and fingerprint are one node. That they are equal sequences is verified: by induction over the length it is enough that the members of a
node name one parent and one last turn, and that turns of one digest are equal texts. Should a hash ever collide, all is done again with others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.llm.places import GROUP, SPAN, SPAN_NO, groups_of, in_order, meet, running
from linewatch.session import materialise

# The four largest primes below 2**31; products of residues fit into 63 bits.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
CHANNELS = range(len(PRIMES))
#: Conversations of a block share the head of its first one.
BLOCK = 100
#: Turns of a head at most.
HEAD = 5
#: Ids that are joined to one string; a chunk is so many consecutive numbers, so it never holds more.
CHUNK = 4_096
#: A parent with more children is sent to them, if there are at most so many of such parents, each a few numbers.
HOT_CHILDREN, HOT_PARENTS = 5_000, 100_000


def turn_digest(role: Column, text: Column, seed: int) -> Column:
    """32 hexadecimal digits that stand for a turn."""
    head = F.concat(F.lit(f"{seed}|") if seed else F.lit(""), F.octet_length(role).cast("string"), F.lit(":"))
    return F.md5(F.concat(head, role, text))


def head_length(conv_id: Column) -> Column:
    """How many turns of the base a conversation begins with, if it has as many."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)


@dataclass(frozen=True)
class Monoid:
    """One base for each prime."""

    bases: tuple[int, ...]

    @staticmethod
    def drawn(seed: int) -> Monoid:
        rng = np.random.default_rng(20261204 + seed)
        return Monoid(tuple(int(rng.integers(2**16, p - 1)) for p in PRIMES))

    def power(self, k: int, n: Column) -> Column:
        """bases[k] ** n modulo the prime, for 0 <= n < 2**32: one factor for each byte of ``n``."""
        out = None
        for byte in range(4):
            step = pow(self.bases[k], 256**byte, PRIMES[k])
            table = F.lit([pow(step, i, PRIMES[k]) for i in range(256)]).cast("array<bigint>")
            factor = F.get(table, F.shiftright(n, 8 * byte).bitwiseAND(F.lit(255)).cast("int"))
            out = factor if out is None else (out * factor) % PRIMES[k]
        return out

    def back(self, k: int, n: Column) -> Column:
        """bases[k] ** -n modulo the prime, for 0 <= n <= HEAD."""
        inverse = pow(self.bases[k], -1, PRIMES[k])
        return F.get(F.lit([pow(inverse, i, PRIMES[k]) for i in range(HEAD + 1)]).cast("array<bigint>"), n.cast("int"))


def _packed(parts: list[Column]) -> list[Column]:
    """Four numbers of 32 bits as two of 64."""
    return [F.shiftleft(parts[i].cast("bigint"), 32).bitwiseOR(parts[i + 1].cast("bigint")) for i in (0, 2)]


def _turns(hashed: DataFrame, monoid: Monoid) -> tuple[DataFrame, DataFrame]:
    """The turns in order, with ``pos`` from 1, the prefix product P and the own term T in each channel; and the conversations."""
    ordered = in_order(hashed, ["conv_id", "turn", "role", "digest"], "nth")
    groups = groups_of(ordered, "conv_id", "nth")
    met = meet(ordered.drop("turn", "role"), groups, "conv_id", "nth").withColumn("pos", F.col("nth") - F.col("first") + 1)
    words = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("bigint") for k in CHANNELS]
    terms = {f"t{k}": (words[k] % PRIMES[k] * monoid.power(k, F.col("pos"))) % PRIMES[k] for k in CHANNELS}
    d1, d2 = _packed(words)
    met = met.select(GROUP, SPAN_NO, "conv_id", "nth", "pos", "chars", d1.alias("d1"), d2.alias("d2"), *[c.alias(n) for n, c in terms.items()])
    summed = running(met, {f"t{k}": f"p{k}" for k in CHANNELS}, "pos")
    summed = summed.withColumns({f"p{k}": F.col(f"p{k}") % PRIMES[k] for k in CHANNELS}).drop(GROUP, SPAN_NO)
    return materialise(hashed.sparkSession, summed, "turns"), groups


def _plans(turns: DataFrame, groups: DataFrame, monoid: Monoid) -> DataFrame:
    """One row per conversation: what its rebuilt form takes from where. ``heads`` are the turns taken from the base, at most HEAD; the fingerprint of
    own turn ``pos`` is a + s * P(pos) in each channel, at the depth ``pos`` - ``gone``."""
    early = turns.where(F.col("pos") <= HEAD)
    fields = ["pos", "chars", "d1", "d2", *[f"p{k}" for k in CHANNELS], *[f"t{k}" for k in CHANNELS]]
    listed = early.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("own"))
    listed = materialise(turns.sparkSession, listed, "heads")
    plans = groups.withColumn("h", head_length(F.col("group"))).withColumn("base", F.col("group") - F.col("group") % BLOCK)
    plans = plans.join(listed.withColumnRenamed("conv_id", "group"), "group")
    bases = listed.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    plans = plans.join(bases, "base", "left")
    heads = F.slice(F.coalesce("base_turns", F.slice("own", 1, 0)), F.lit(1), F.col("h").cast("int"))
    plans = plans.withColumn("heads", heads).withColumn("own_head", F.get("own", (F.col("h") - 1).cast("int")))
    plans = plans.withColumn("taken", F.size("heads").cast("bigint")).withColumn("last_head", F.get("heads", (F.col("taken") - 1).cast("int")))
    plans = plans.withColumn("gone", F.col("h") - F.col("taken"))
    for k in CHANNELS:
        p, s = PRIMES[k], monoid.back(k, F.col("gone"))
        own = F.coalesce(F.col("own_head")[f"p{k}"], F.lit(0))
        of_base = F.coalesce(F.col("last_head")[f"p{k}"], F.lit(0))
        plans = plans.withColumn(f"s{k}", s).withColumn(f"a{k}", F.pmod(of_base - F.col(f"s{k}") * own % p, F.lit(p)))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return plans.select(
        "group", "first", "n", "h", "gone", "heads", length.alias("length"), *[f"{c}{k}" for c in "as" for k in CHANNELS]
    )


PREFIX = ["conv_id", "depth", "length", "fa", "fb", "ga", "gb", "d1", "d2", "chars"]
NODE = ["depth", "fa", "fb"]


def _prefixes(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: its fingerprint (fa, fb), its parent's (ga, gb), and its last turn's digest and code points."""

    def row(df, depth, full, parent):
        (fa, fb), (ga, gb) = _packed(full), _packed(parent)
        return df.select(
            "conv_id", depth.cast("bigint").alias("depth"), "length", fa.alias("fa"), fb.alias("fb"), ga.alias("ga"), gb.alias("gb"), "d1", "d2", "chars"
        )

    ids = F.col("group").alias("conv_id")
    none = [F.lit(0).cast("bigint")] * len(PRIMES)
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("d1", "d2", "chars")]
    roots = row(plans.select(ids, "length", *zero), F.lit(0), none, none)
    head = plans.select(ids, "length", F.inline("heads"))
    before = [F.pmod(F.col(f"p{k}") - F.col(f"t{k}"), F.lit(PRIMES[k])) for k in CHANNELS]
    heads = row(head, F.col("pos"), [F.col(f"p{k}") for k in CHANNELS], before)
    met = meet(turns, plans.drop("heads"), "conv_id", "nth").where(F.col("pos") > F.col("h"))
    full = [(F.col(f"a{k}") + F.col(f"s{k}") * F.col(f"p{k}") % PRIMES[k]) % PRIMES[k] for k in CHANNELS]
    shifted = [F.col(f"s{k}") * F.col(f"t{k}") % PRIMES[k] for k in CHANNELS]
    before = [F.pmod(f - t, F.lit(PRIMES[k])) for k, (f, t) in enumerate(zip(full, shifted))]
    own = row(met, F.col("pos") - F.col("gone"), full, before)
    return materialise(turns.sparkSession, roots.unionByName(heads).unionByName(own), "prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame:
    same = [f(c).alias(f"{c}_{f.__name__}") for c in ("ga", "gb", "d1", "d2") for f in (F.min, F.max)]
    grouped = prefixes.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"), *same
    )
    return materialise(prefixes.sparkSession, grouped, "nodes")


def _collided(spoken: DataFrame, nodes: DataFrame) -> bool:
    """Does a node hold two parents or two last turns, or a digest two texts? Equal rows are put together before they are shuffled."""
    apart = " or ".join(f"{c}_min <> {c}_max" for c in ("ga", "gb", "d1", "d2"))
    if not nodes.where(apart).isEmpty():
        return True
    ends = [f(c).alias(f"{c}_{f.__name__}") for c in ("role", "text") for f in (F.min, F.max)]
    return not spoken.groupBy("digest").agg(*ends).where("role_min <> role_max or text_min <> text_max").isEmpty()


def _with_parents(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``nodes`` with n_children and parent_conv_id."""
    spark = nodes.sparkSession
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ga_min").alias("fa"), F.col("gb_min").alias("fb"))
    counted = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    counted = materialise(spark, counted, "counted")
    key = [F.col("depth").alias("up"), F.col("fa").alias("ga_min"), F.col("fb").alias("gb_min"), F.col("conv_id").alias("parent_conv_id")]
    hot = counted.where(F.col("n_children") > HOT_CHILDREN)
    deep = counted.withColumn("up", F.col("depth") - 1)
    on = ["up", "ga_min", "gb_min"]
    if 0 < hot.count() <= HOT_PARENTS:
        sent = materialise(spark, hot.select(*key), "hot")
        joined = deep.join(F.broadcast(sent), on, "left")
        found = joined.where("parent_conv_id is not null")
        rest = joined.where("parent_conv_id is null").drop("parent_conv_id")
        return found.unionByName(rest.join(counted.where(F.col("n_children") <= HOT_CHILDREN).select(*key), on, "left"))
    return deep.join(counted.select(*key), on, "left")


def _below(prefixes: DataFrame, counted: DataFrame) -> DataFrame:
    """depth, fa, fb, n_leaves, saved_tokens: sums over subtrees, in one pass whatever the depth.

    Only the prefixes of one member of each childless node are needed: a node has as many below it as it has such prefixes. What a node saves is charged to its
    least leaf; summed along that leaf's prefixes from the end, each prefix carries what is charged below it, and a node's subtree is the sum over its prefixes."""
    spark = prefixes.sparkSession
    leaves = counted.where("n_children = 0").select(
        F.struct(F.col("conv_id").alias("group")).alias(GROUP), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("depth") / SPAN))).alias(SPAN_NO)
    )
    keyed = prefixes.select("conv_id", *NODE).withColumn(GROUP, F.struct(F.col("conv_id").alias("group"))).withColumn(SPAN_NO, F.floor(F.col("depth") / SPAN))
    ways = materialise(spark, keyed.join(leaves, [GROUP, SPAN_NO], "left_semi"), "ways")
    owned = ways.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_leaves"), F.min("conv_id").alias("owner"))
    owned = materialise(spark, owned.join(counted, NODE).withColumn("saves", (F.col("n_convs") - 1) * F.col("chars")), "owned")
    charged = owned.where("saves > 0").select(F.col("owner").alias("conv_id"), "depth", "saves")
    ways = ways.join(charged, ["conv_id", "depth"], "left").fillna(0, ["saves"])
    summed = running(ways, {"saves": "carried"}, "depth", backwards=True)
    return owned.select(*NODE, "n_leaves").join(summed.groupBy(*NODE).agg(F.sum("carried").alias("saved_tokens")), NODE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each run of rows of one node, its strings comma-joined."""
    open_, digest = None, None

    def table(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for *node, text in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
            if node != open_:
                if open_ is not None:
                    done.append((*open_, digest.hexdigest()))
                open_, digest = node, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield table(done)
    if open_ is not None:
        yield table([(*open_, digest.hexdigest())])


def _ends(prefixes: DataFrame) -> DataFrame:
    """depth, fa, fb, ends_sha256 of the nodes at which conversations end. Ids are joined in chunks of consecutive numbers before one task hashes a node's chunks in order."""
    ending = prefixes.where("depth = length").groupBy(*NODE, F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
    chunks = ending.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    sorted_ = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    return sorted_.mapInArrow(_digests, "depth bigint, fa bigint, fb bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, digest: Callable[[Column, Column, int], Column] = turn_digest) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    ``turns`` has conv_id, turn, role and text; other columns are left out. Turns go by number, null first; of one number by role and digest, and rows repeated are turns of
    their own. Null roles and texts are empty. Rows without conv_id are no conversation. An empty table has no node. Conversation c is the first h turns of the
    conversation c - c % BLOCK (all if it has fewer, none if there is no such one) and its own turns after its first h, where h is the crc32 of c modulo 6. A long
    conversation is cut into spans of turns, a frequent prefix is counted before it is shuffled, and texts, however long, are only hashed and compared."""
    spark = turns.sparkSession
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    spoken = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    for seed in count():
        named = spoken.withColumn("digest", digest(F.col("role"), F.col("text"), seed))
        hashed = named.select("conv_id", "turn", "role", "digest", F.char_length("text").cast("bigint").alias("chars"))
        monoid = Monoid.drawn(seed)
        said, groups = _turns(materialise(spark, hashed, "hashed"), monoid)
        prefixes = _prefixes(said, materialise(spark, _plans(said, groups, monoid), "plans"))
        nodes = _nodes(prefixes)
        if not _collided(named, nodes):
            break
    known = materialise(spark, _with_parents(nodes, prefixes), "parents")
    made = known.join(_below(prefixes, known), NODE).join(_ends(prefixes), NODE, "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
