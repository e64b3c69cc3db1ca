"""Language identification as a mixture: which languages, in which proportions, wrote a text.

Each language is a table of byte-trigram probabilities. A word's likelihood under a language is that of its
trigrams. The proportions of the languages in a text are found by expectation-maximisation over its words; the
set of languages by the likelihood minus half a log of the number of words for each language beyond the first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.llm.names import unused
from linewatch.llm.words import text_slices

#: Trigrams are hashed into this many counts: the size of a model is this times its languages.
BUCKETS = 1 << 16
UNKNOWN = "und"

# Bytes by case-folded class; whatever is no letter is a blank. Bytes beyond ASCII count as letters.
_CLASS = np.zeros(256, np.uint32)
_CLASS[97:123] = _CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter, first of these of each word, the row of each word)."""
    n = len(data)
    kinds = _CLASS[data]
    padded = np.zeros(n + 2, np.uint32)
    padded[1:-1] = kinds
    left, right = padded[:-2].copy(), padded[2:].copy()
    # A row's ends are blanks.
    inner = offsets[(offsets > 0) & (offsets < n)]
    left[inner] = 0
    right[inner - 1] = 0
    at = np.flatnonzero(kinds)
    code = (left[at] << np.uint32(16)) | (kinds[at] << np.uint32(8)) | right[at]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    first = np.flatnonzero(left[at] == 0)
    rows = np.searchsorted(offsets, at[first], "right") - 1
    return code.astype(np.int64), first, rows


@dataclass(frozen=True)
class Model:
    """``table[bucket, language]``: log probabilities."""

    languages: tuple[str, ...]
    table: np.ndarray


def _count(batches):
    """(lang, bucket, n) of a task: at most BUCKETS rows for each language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        for first, data, offsets in text_slices(batch.column("text")):
            code, start, rows = trigrams(data, offsets)
            own = np.repeat(rows, np.diff(np.append(start, len(code))))
            here = languages[first : first + len(offsets) - 1]
            for lang in set(here.tolist()):
                sums = np.bincount(code[(here == lang)[own]], minlength=BUCKETS)
                counts[lang] = counts.get(lang, 0) + sums
    for lang, sums in counts.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def learn(documents: DataFrame) -> Model:
    """Counts over all rows with a text and a language. Without any the model knows no language."""
    rows = documents.where("lang is not null and text is not null").select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most BUCKETS rows for each language
    languages = tuple(sorted(found["lang"].unique()))
    table = np.zeros((BUCKETS, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    table[found["bucket"].to_numpy(), found["lang"].map(place).to_numpy(dtype=int)] = found["n"]
    # Half a count for each bucket that any language uses, and for one that none does.
    used = (table > 0).any(axis=1).sum() + 1
    table = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * used))
    return Model(languages, table.astype(np.float32))


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums by row, for values of rows in ascending order."""
    out = np.zeros((n, *values.shape[1:]))
    if len(values):
        at = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[at]] = np.add.reduceat(values, at, dtype=np.float64)
    return out


def mixture(
    likelihood: np.ndarray, rows: np.ndarray, n: int, allowed: np.ndarray, steps: int = 30, close: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by row and the log likelihood, by expectation-maximisation over the words of the
    row, of the languages ``allowed`` for it. ``likelihood[word, language]`` are logarithms."""
    words = np.bincount(rows, minlength=n).astype(float)
    top = likelihood.max(axis=1)
    p = np.exp(likelihood - top[:, None])
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    live = words > 0
    for _ in range(steps):
        chosen = live[rows]
        r, own = p[chosen], rows[chosen]
        r = r * share[own]
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
        new = _sums(r, own, n) / np.maximum(words, 1)[:, None]
        moved = np.abs(new - share).max(axis=1)
        share = np.where(live[:, None], new, share)
        live = live & (moved > close)
        if not live.any():
            break
    with np.errstate(divide="ignore"):
        total = _sums(np.log(np.maximum((p * share[rows]).sum(axis=1), 1e-300)) + top, rows, n)
    return share, total


def infer(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Proportions of the selected languages for each row; zeros for a row without letters."""
    n, k = len(offsets) - 1, len(model.languages)
    code, start, rows = trigrams(data, offsets)
    if not len(code) or not k:
        return np.zeros((n, k))
    likelihood = np.add.reduceat(model.table[code], start).astype(np.float64)
    words = np.bincount(rows, minlength=n)
    penalty = 0.5 * np.log(np.maximum(words, 2))
    single = _sums(likelihood, rows, n)
    best = single.argmax(axis=1)
    share = np.zeros((n, k))
    share[np.arange(n), best] = words > 0
    value = single.max(axis=1)
    # No set does better than every word under its best language, and two languages cost a penalty.
    at = np.flatnonzero((words > 0) & (_sums(likelihood.max(axis=1), rows, n) - value > penalty))
    if len(at) and k > 1:
        rank = np.full(n, -1)
        rank[at] = np.arange(len(at))
        chosen = rank[rows] >= 0
        part, own, m = likelihood[chosen], rank[rows[chosen]], len(at)
        full, total = mixture(part, own, m, np.ones((m, k)))
        order = np.argsort(-full, axis=1, kind="stable")
        # The likelihood of all languages bounds that of any set, so only rows that it leaves open go on.
        for size in range(2, k + 1):
            open_ = np.flatnonzero(total - (size - 1) * penalty[at] > value[at])
            if not len(open_):
                break
            allowed = np.zeros((m, k))
            np.put_along_axis(allowed, order[:, :size], 1.0, axis=1)
            back = np.full(m, -1)
            back[open_] = np.arange(len(open_))
            mine = back[own] >= 0
            got, reached = mixture(part[mine], back[own[mine]], len(open_), allowed[open_])
            gain = reached - (size - 1) * penalty[at[open_]]
            better = gain > value[at[open_]]
            value[at[open_[better]]] = gain[better]
            share[at[open_[better]]] = got[better]
    return share


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` (the proportion of that language) and ``proportions`` (language to proportion, of the
    selected set). Null texts and texts without a letter are ``und`` with score 0 and no proportions, as is every text under a
    model without languages. Of equal proportions the first language by name wins. Columns of these names are replaced; one row in, one row out."""
    from pyspark.sql.types import ArrayType, DoubleType

    names = model.languages
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats for each language

    @F.arrow_udf(ArrayType(DoubleType()))
    def proportions(texts: pa.Array) -> pa.Array:
        m = shared.value
        out = [infer(m, data, offsets) for _, data, offsets in text_slices(texts)]
        flat = np.concatenate(out) if out else np.zeros((0, len(names)))
        return pa.array(list(flat), pa.list_(pa.float64()))

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    share = unused(documents, "share")
    top = F.array_max(share)
    known = lettered & (F.coalesce(top, F.lit(0.0)) > 0)
    place = F.array_position(share, top).cast("int")
    langs = F.array(*[F.lit(x) for x in names]) if names else F.array().cast("array<string>")
    pairs = F.filter(F.arrays_zip(langs.alias("k"), F.col(share).alias("v")), lambda x: x["v"] > 0)
    return (
        documents.withColumn(share, proportions(F.col("text")))
        .withColumn("lang_pred", F.when(known, F.element_at(langs, place)).otherwise(UNKNOWN))
        .withColumn("score", F.when(known, F.least(top, F.lit(1.0))).otherwise(0.0))
        .withColumn("proportions", F.when(known, F.map_from_entries(pairs)))
        .drop(share)
    )

