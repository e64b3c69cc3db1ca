"""Quality of a text by a generalised additive model with pairwise interactions.

Each measure of a text is cut into bins, and the score is a sum of table entries: one table for each measure, one for each of a few pairs of them. The
tables are learned by boosting in cycles: every measure in turn gets one shallow tree on the gradient that is left, which is added to its table; then the pairs with the
greatest gain get trees of one cut along each of the two. What is learned can be read off the tables, and scoring is a binary search and an addition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linewatch.llm.batches import text_batches
from linewatch.llm.words import hash_shingles, hash_words, mix, text_slices
from linewatch.session import materialise

# Classes of bytes.
BYTE_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t",
    "line_end": b"\n",
    "stop": b".,;:",
    "loud": b"!?",
    "quote": b"\"'()-",
    "bar": b"|/\\_",
    "markup": b"<>{}[]=",
    "sign": b"#$%&*+@^~`",
    "beyond": bytes(range(128, 256)),
}
MEASURES = [
    "log_bytes", *[f"share_{c}" for c in BYTE_CLASSES], "upper_of_letters", "entropy", "doubled", "word_length", "log_words",
    "words_a_line", "distinct_words", "top_word", "same_as_before", "distinct_3", "distinct_5", "top_5", "distinct_lines", "ended_lines",
]

_CLASS = np.zeros((256, len(BYTE_CLASSES)))
for _i, _bytes in enumerate(BYTE_CLASSES.values()):
    _CLASS[list(_bytes), _i] = 1
#: Rows measured at once: a histogram of bytes for each.
ROWS = 4_096


def _repeats(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``n`` rows: keys, distinct keys, and how often the most frequent one is there."""
    total = np.bincount(rows, minlength=n)
    if not len(keys):
        return total, total, total
    merged = np.sort((rows.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    first = np.flatnonzero(np.diff(merged, prepend=~merged[0]))
    owner = (merged[first] >> np.uint64(48)).astype(int)
    runs = np.diff(first, append=len(merged))
    top = np.zeros(n, int)
    np.maximum.at(top, owner, runs)
    return total, np.bincount(owner, minlength=n), top


def _measured(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The measures of the texts between ``offsets`` of the bytes ``data``."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    histogram = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256).astype(float)
    length = np.maximum(size, 1)[:, None]
    classes = histogram @ _CLASS
    shares = classes / length
    p = histogram / length
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    named = dict(zip(BYTE_CLASSES, classes.T))
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    same[offsets[:-1][size > 0]] = False
    doubled = np.bincount(row, same, minlength=n) / length[:, 0]

    words, bounds = hash_words(data, offsets)
    n_words = np.diff(bounds)
    of_word = np.repeat(np.arange(n), n_words)
    some = np.maximum(n_words, 1)
    _, distinct, top = _repeats(words, of_word, n)
    before = np.zeros(len(words), bool)
    before[1:] = (words[1:] == words[:-1]) & (of_word[1:] == of_word[:-1])
    in_words = named["lower"] + named["upper"] + named["digit"] + named["beyond"]
    triples = _repeats(*hash_shingles(words, bounds, 3), n)
    fives = _repeats(*hash_shingles(words, bounds, 5), n)

    # Lines: a hash of each from its bytes and their places.
    starts = np.zeros(len(data), bool)
    starts[1:] = data[:-1] == 10
    starts[offsets[:-1][size > 0]] = True
    starts = np.flatnonzero(starts)
    if len(starts):
        lengths = np.diff(starts, append=len(data))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        kept = np.where(data == 10, np.uint64(0), mix((place.astype(np.uint64) << np.uint64(8)) + data + np.uint64(1)))
        lines = mix(np.add.reduceat(kept, starts))
        last = starts + lengths - 1
        last = np.where((data[last] == 10) & (lengths > 1), last - 1, last)
        ended = np.isin(data[last], np.frombuffer(b".!?", np.uint8))
    else:
        lines, ended = np.zeros(0, np.uint64), np.zeros(0, bool)
    n_lines, distinct_lines, _ = _repeats(lines, row[starts], n)
    at_least = np.maximum(n_lines, 1)
    out = [
        np.log2(1 + size), *shares.T, named["upper"] / np.maximum(named["upper"] + named["lower"], 1), entropy, doubled, in_words / some,
        np.log2(1 + n_words), n_words / at_least, distinct / some, top / some, np.bincount(of_word, before, minlength=n) / some,
        triples[1] / np.maximum(triples[0], 1), fives[1] / np.maximum(fives[0], 1), fives[2] / np.maximum(fives[0], 1),
        distinct_lines / at_least, np.bincount(row[starts], ended, minlength=n) / at_least,
    ]
    return np.column_stack(out)


def measures(texts: pa.Array) -> np.ndarray:
    """One row of MEASURES for each text, read whole; null is empty, and an empty text is all zeros."""
    parts = [np.zeros((0, len(MEASURES)))]
    for at in range(0, len(texts), ROWS):
        for _, data, offsets in text_slices(texts.slice(at, ROWS)):
            parts.append(_measured(data, offsets))
    return np.vstack(parts)


@dataclass(frozen=True)
class Additive:
    """``edges[f]`` cut measure f into bins, ``tables[f]`` has a number for each; ``pairs`` are (f, g, table) over ``coarse[f]`` of the bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)] or [np.zeros((len(x), 0), int)])

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        out = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            out += table[bins[:, f]]
        for f, g, table in self.pairs:
            out += table[self.coarse[f][bins[:, f]], self.coarse[g][bins[:, g]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


@dataclass(frozen=True)
class Boosting:
    """How tables are learned: bins a measure and a side of a pair's table, cycles at most over all measures and pairs, the cycles without a gain on
    the rows set aside after which it ends, rate, least rows of a leaf, ridge, cuts of a tree, pairs, and bags whose tables are averaged."""

    bins: int = 48
    coarse: int = 10
    cycles: int = 400
    patience: int = 25
    rate: float = 0.08
    least: int = 12
    ridge: float = 1.0
    cuts: int = 3
    pairs: int = 10
    bags: int = 4
    seed: int = 13


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, how: Boosting) -> np.ndarray:
    """A number for each of the ordered bins: a tree of ``how.cuts`` cuts, each where it gains most."""
    stretches, out = [(0, len(g))], np.zeros(len(g))
    tops = [np.concatenate([[0.0], np.cumsum(v)]) for v in (g, h, n)]

    def best(lo: int, hi: int) -> tuple[float, int]:
        at = np.arange(lo + 1, hi)
        if not len(at):
            return 0.0, lo
        left = [t[at] - t[lo] for t in tops]
        whole = [t[hi] - t[lo] for t in tops]
        right = [w - v for w, v in zip(whole, left)]
        gain = left[0] ** 2 / (left[1] + how.ridge) + right[0] ** 2 / (right[1] + how.ridge) - whole[0] ** 2 / (whole[1] + how.ridge)
        gain = np.where((left[2] >= how.least) & (right[2] >= how.least), gain, 0.0)
        k = int(gain.argmax())
        return float(gain[k]), int(at[k])

    found = {(0, len(g)): best(0, len(g))}
    for _ in range(how.cuts):
        (lo, hi), (gain, at) = max(found.items(), key=lambda kv: kv[1][0])
        if gain <= 1e-9:
            break
        del found[lo, hi]
        stretches.remove((lo, hi))
        for part in ((lo, at), (at, hi)):
            stretches.append(part)
            found[part] = best(*part)
    for lo, hi in stretches:
        out[lo:hi] = -(tops[0][hi] - tops[0][lo]) / (tops[1][hi] - tops[1][lo] + how.ridge)
    return out


def _cross(g: np.ndarray, h: np.ndarray, n: np.ndarray, how: Boosting) -> tuple[float, np.ndarray]:
    """The gain and the table of one cut along each axis: four leaves."""

    def quarters(v):
        c = v.cumsum(0).cumsum(1)
        a, top, left = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return np.stack([a, top - a, left - a, c[-1, -1] - top - left + a])

    q_g, q_h, q_n = quarters(g), quarters(h), quarters(n)
    # A quarter of too few rows keeps its score.
    value = np.where(q_n >= how.least, -q_g / (q_h + how.ridge), 0.0)
    gain = np.where(q_n >= how.least, q_g**2 / (q_h + how.ridge), 0.0).sum(0)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    table = np.empty(g.shape)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :], table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = value[:, i, j]
    return float(gain[i, j]), table


def _loss(margin: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -margin, margin)).mean()) if len(y) else 0.0


def _cycle(shapes: list, add, margin, y, held_margin, held_y, how: Boosting) -> list:
    """Tables boosted in cycles, as of the cycle with the least loss on the rows set aside."""
    tables = [np.zeros(s) for s in shapes]
    best, kept, waited = _loss(held_margin, held_y), [t.copy() for t in tables], 0
    for _ in range(how.cycles):
        for f in range(len(tables)):
            p = 1 / (1 + np.exp(-margin))
            step = how.rate * add(f, p - y, p * (1 - p))
            tables[f] += step
            margin += step[add.at(f)]
            held_margin += step[add.held(f)]
        loss = _loss(held_margin, held_y)
        if loss < best - 1e-5:
            best, kept, waited = loss, [t.copy() for t in tables], 0
        else:
            waited += 1
            if waited >= how.patience:
                break
    return kept


class _Main:
    """Trees along one measure."""

    def __init__(self, bins, held, sizes, how):
        self.bins, self.held_bins, self.sizes, self.how = bins, held, sizes, how
        self.n = [np.bincount(bins[:, f], minlength=s) for f, s in enumerate(sizes)]

    def at(self, f):
        return self.bins[:, f]

    def held(self, f):
        return self.held_bins[:, f]

    def __call__(self, f, g, h):
        sums = [np.bincount(self.bins[:, f], v, minlength=self.sizes[f]) for v in (g, h)]
        return _tree(*sums, self.n[f], self.how)


class _Pair:
    """Trees of one cut along each of two measures."""

    def __init__(self, cells, held, sides, how):
        self.cells, self.held_cells, self.sides, self.how = cells, held, sides, how

    def at(self, f):
        return self.cells[f]

    def held(self, f):
        return self.held_cells[f]

    def __call__(self, f, g, h):
        return _cross(*_grids(self.cells[f], self.sides[f], g, h), self.how)[1]


def _grids(cells, sides, g, h):
    flat = cells[0] * sides[1] + cells[1]
    return [np.bincount(flat, w, minlength=sides[0] * sides[1]).reshape(sides) for w in (g, h, None)]


def fit(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> Additive:
    """The model of labelled measures. Of rows of one label only, or none, it is a constant."""
    ones = int((y == 1).sum())
    intercept = float(np.log((ones + 1) / (len(y) - ones + 1)))
    width = x.shape[1]
    if not 0 < ones < len(y):
        return Additive(intercept, [np.zeros(0)] * width, [np.zeros(1)] * width, [np.zeros(1, int)] * width, [])
    shares = np.linspace(0, 1, how.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, f], shares, method="higher")) for f in range(width)]
    bins = Additive(0.0, edges, [], [], []).bins(x)
    sizes = [len(e) + 1 for e in edges]
    # Coarse bins hold about equal shares of the rows, as the fine ones do.
    coarse = [np.arange(s) * min(s, how.coarse) // s for s in sizes]
    sides = [int(c[-1]) + 1 for c in coarse]
    rng = np.random.default_rng(how.seed)
    part = rng.permutation(len(y)) % max(how.bags, 2)
    tables, pair_tables, pairs = [np.zeros(s) for s in sizes], {}, None
    for bag in range(how.bags):
        learn, held = part != bag, part == bag
        margin, held_margin = np.full(learn.sum(), intercept), np.full(held.sum(), intercept)
        main = _cycle(sizes, _Main(bins[learn], bins[held], sizes, how), margin, y[learn], held_margin, y[held], how)
        for f in range(width):
            tables[f] += main[f] / how.bags
        margin, held_margin = (intercept + sum(t[bins[at][:, f]] for f, t in enumerate(main)) for at in (learn, held))
        cut = [coarse[f][bins[:, f]] for f in range(width)]
        p = 1 / (1 + np.exp(-margin))
        if pairs is None:
            # All pairs are looked at once, on what the main effects leave.
            able = [f for f in range(width) if sides[f] > 1]
            gains = {}
            for k, f in enumerate(able):
                for g in able[k + 1 :]:
                    grids = _grids((cut[f][learn], cut[g][learn]), (sides[f], sides[g]), p - y[learn], p * (1 - p))
                    gains[f, g] = _cross(*grids, how)[0]
            pairs = sorted(sorted(gains, key=lambda fg: (-gains[fg], fg))[: how.pairs])
        cells = [[(cut[f][at], cut[g][at]) for f, g in pairs] for at in (learn, held)]
        shapes = [(sides[f], sides[g]) for f, g in pairs]
        if pairs:
            made = _cycle(shapes, _Pair(*cells, shapes, how), margin.copy(), y[learn], held_margin.copy(), y[held], how)
            for fg, table in zip(pairs, made):
                pair_tables[fg] = pair_tables.get(fg, 0) + table / how.bags
    return Additive(intercept, edges, tables, coarse, [(f, g, t) for (f, g), t in pair_tables.items()])


def learn(documents: DataFrame, labels: DataFrame, max_rows: int = 20_000, how: Boosting = Boosting()) -> Additive:
    """A model from labelled documents: at most some ``max_rows`` of them, a documented bound, chosen by a hash of the id; equal texts of one
    label count once. Rows without a label or text, and ids with two different labels, teach nothing. Texts are measured where they lie; the driver gets
    len(MEASURES) numbers for each of the rows. No labels: every text scores 0.5."""
    spark = documents.sparkSession
    given = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")
    )
    given = given.where("quality = other").select(F.col("doc_id").alias("own_id"), F.col("quality").cast("int").alias("quality"))
    n = given.count()
    if n > max_rows:
        bound = int(2**63 * (max_rows / n))
        given = given.where(F.shiftrightunsigned(F.xxhash64("own_id"), 1) < bound)
    rows = documents.where("text is not null").select("doc_id", "text")
    # At most some max_rows rows of two numbers.
    rows = rows.join(F.broadcast(given), F.col("doc_id") == F.col("own_id")).select("text", "quality", F.xxhash64("text").alias("same"))

    def measured(batches):
        for batch in batches:
            x = measures(batch.column("text"))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([listed, batch.column("quality"), batch.column("same")], names=["x", "quality", "same"])

    with text_batches(spark):
        made = rows.mapInArrow(measured, "x array<double>, quality int, same bigint").dropDuplicates(["same", "quality"])
        found = materialise(spark, made, "measured").orderBy("same", "quality").collect()
    x = np.array([r.x for r in found]).reshape(-1, len(MEASURES))
    return fit(x, np.array([r.quality for r in found]), how)


def score(documents: DataFrame, model: Additive, name: str = "score") -> DataFrame:
    """``documents`` with the column ``name``, 0 to 1; a column of that name is replaced. Null and empty texts have the measures of an empty text. Texts are read whole, however
    long. One row in, one row out; nothing is shuffled."""

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(measures(texts)))

    return documents.withColumn(name, scored(F.col("text")))
