"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Words become tags: insult, threat, target, negation, reported speech. Five small transducers read the
tags of a clause; their composition is one machine that emits what kind of match an insult or a threat is: bare,
aimed at a target, negated, or reported. The weights of the kinds, and the insults themselves, as words and as
word beginnings, are learned from labelled texts. A text without a matched clause has the score of the intercept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.llm.batches import strings, text_batches
from linewatch.llm.words import hash_shingles, hash_words, text_slices
from linewatch.session import materialise

# Closed word classes of the four languages.
TARGET = "you your yours he him she her they them du dich dir dein ihr euch er ihn sie tu te toi ton vous il elle ils eux usted tú ti ellos ellas".split()
NEGATION = "not never no none nobody isn aren wasn don doesn nicht nie niemals kein keine keinen ne pas jamais aucun aucune nunca jamás ningún ninguna".split()
REPORT = "said says say told claimed wrote quoted called sagte sagt schrieb nannte behauptete dit disait écrit affirmé dijo dice escribió llamó afirmó".split()
THREAT = "kill murder hurt destroy beat shoot töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()

INSULT_TAG, THREAT_TAG, TARGET_TAG, NEGATION_TAG, REPORT_TAG, OTHER_TAG = range(6)
KINDS = ["bare", "aimed", "negated", "reported", "threat", "threat_aimed"]


@dataclass(frozen=True)
class Transducer:
    """``arcs[state, tag] = (next state, output)``; a missing arc stays in the state and emits nothing."""

    arcs: dict[tuple[object, int], tuple[object, str | None]]
    start: object = 0

    def step(self, state: object, tag: int) -> tuple[object, str | None]:
        return self.arcs.get((state, tag), (state, None))


def _within(opens: int, reach: int, output: str) -> Transducer:
    """Emits ``output`` at an insult or threat up to ``reach`` tags after an opening tag."""
    arcs = {}
    for state in range(reach + 1):
        for tag in range(6):
            if tag == opens:
                arcs[state, tag] = (reach, None)
            else:
                found = output if state > 0 and tag in (INSULT_TAG, THREAT_TAG) else None
                arcs[state, tag] = (max(state - 1, 0), found)
    return Transducer(arcs)


INSULTS = Transducer({(0, INSULT_TAG): (0, "insult")})
THREATS = Transducer({(0, THREAT_TAG): (0, "threat")})
TARGETS = _within(TARGET_TAG, 4, "aimed")
NEGATIONS = _within(NEGATION_TAG, 3, "negated")
# Reported speech holds to the end of its clause.
REPORTS = Transducer(
    {(0, REPORT_TAG): (1, None), (1, INSULT_TAG): (1, "reported"), (1, THREAT_TAG): (1, "reported")}
)


def compose(machines: Iterable[Transducer]) -> tuple[np.ndarray, np.ndarray]:
    """The product of the machines as tables: next state, and the kind of match (-1: none)."""
    machines = list(machines)
    start = tuple(m.start for m in machines)
    states, todo, arcs = {start: 0}, [start], {}
    while todo:
        state = todo.pop()
        for tag in range(6):
            steps = [m.step(s, tag) for m, s in zip(machines, state)]
            target = tuple(s for s, _ in steps)
            if target not in states:
                states[target] = len(states)
                todo.append(target)
            arcs[states[state], tag] = states[target], _kind({o for _, o in steps if o})
    following, kinds = np.zeros((len(states), 6), int), np.full((len(states), 6), -1)
    for s, tag in product(range(len(states)), range(6)):
        following[s, tag], kinds[s, tag] = arcs[s, tag]
    return following, kinds


def _kind(outputs: set[str]) -> int:
    if "threat" in outputs:
        if outputs & {"negated", "reported"}:
            return KINDS.index("negated" if "negated" in outputs else "reported")
        return KINDS.index("threat_aimed" if "aimed" in outputs else "threat")
    if "insult" not in outputs:
        return -1
    return next((KINDS.index(k) for k in ("reported", "negated", "aimed") if k in outputs), 0)


@dataclass(frozen=True)
class Grammar:
    """Learned patterns and weights. A pattern is a whole word, or the beginning of one if it ends in ``*``."""

    patterns: dict[str, float]
    weights: list[float] = field(default_factory=lambda: [0.0] * (len(KINDS) + 1))
    intercept: float = 0.0


_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+")


class Matcher:
    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.following, self.kinds = compose([INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS])
        self.whole = {p: w for p, w in grammar.patterns.items() if not p.endswith("*")}
        self.begin = {p[:-1]: w for p, w in grammar.patterns.items() if p.endswith("*")}
        self.sizes = sorted({len(p) for p in self.begin}, reverse=True)
        self.tags = {
            w: tag
            for tag, words in ((THREAT_TAG, THREAT), (TARGET_TAG, TARGET), (NEGATION_TAG, NEGATION), (REPORT_TAG, REPORT))
            for w in words
        }
        # One look at the text says whether any clause can match.
        heads = [re.escape(p) + r"(?![^\W\d_])" for p in [*self.whole, *THREAT]] + [re.escape(p) for p in self.begin]
        self.any = re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted(heads)) + ")")

    def insult(self, word: str) -> float:
        best = self.whole.get(word, 0.0)
        for n in self.sizes:
            if len(word) >= n:
                best = max(best, self.begin.get(word[:n], 0.0))
        return best

    def clause(self, words: list[str], sums: np.ndarray) -> None:
        """Adds the weights of a clause's matches by kind. An insult that only ends at its target counts as aimed too."""
        state, matched, found = 0, [], False
        for i, word in enumerate(words):
            weight = self.insult(word)
            tag = INSULT_TAG if weight else self.tags.get(word, OTHER_TAG)
            kind = self.kinds[state, tag]
            state = self.following[state, tag]
            if kind >= 0:
                matched.append((i, kind, weight or 1.0))
            if tag == TARGET_TAG:
                matched = [(j, 1 if k == 0 and i - j <= 2 else k, w) for j, k, w in matched]
        for _, kind, weight in matched:
            sums[kind] += weight

    def features(self, text: str) -> np.ndarray:
        """Matched weight by kind, damped, and the matched weight per hundred words."""
        out = np.zeros(len(KINDS) + 1)
        text = text.lower()
        if not self.any.search(text):
            return out
        words = 0
        for part in _CLAUSE.split(text):
            clause = _WORD.findall(part)
            words += len(clause)
            if self.any.search(part):
                self.clause(clause, out[:-1])
        out[-1] = 100 * out[:-1].sum() / max(words, 1)
        return np.log1p(out)

    def score(self, text: str) -> float:
        z = float(self.features(text) @ np.array(self.grammar.weights)) + self.grammar.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@lru_cache(maxsize=4)
def _matcher(patterns: tuple, weights: tuple, intercept: float) -> Matcher:
    return Matcher(Grammar(dict(patterns), list(weights), intercept))


def matcher(g: Grammar) -> Matcher:
    return _matcher(tuple(g.patterns.items()), tuple(g.weights), g.intercept)


def _patterns_of(text: str, shortest: int, longest: int) -> set[str]:
    out = set()
    for word in set(_WORD.findall(text.lower())):
        out.add(word)
        out.update(word[:n] + "*" for n in range(shortest, min(longest, len(word)) + 1))
    return out


def _count(batches, shortest: int, longest: int):
    """(pattern, toxic documents, clean documents) of a task."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(strings(batch.column("text")), batch.column("toxic").to_pylist()):
            (toxic if label else clean).update(_patterns_of(text, shortest, longest))
    names = list(toxic)  # a pattern without toxic documents is no candidate
    if names:
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
            names=["pattern", "a", "b"],
        )


def _clean_count(batches, candidates: list[str], shortest: int, longest: int):
    known, clean = set(candidates), Counter()
    for batch in batches:
        for text in strings(batch.column("text")):
            clean.update(_patterns_of(text, shortest, longest) & known)
    if clean:
        yield pa.RecordBatch.from_arrays([pa.array(list(clean)), pa.array(list(clean.values()), pa.int64())], names=["pattern", "b"])


def _family(batches):
    """The least shingle hash of each text: near copies mostly share it."""
    for batch in batches:
        least = np.zeros(batch.num_rows, np.uint64)
        for first, data, offsets in text_slices(batch.column("text")):
            shingles, rows = hash_shingles(*hash_words(data, offsets))
            at = np.flatnonzero(np.diff(rows, prepend=-1))
            if len(at):
                least[first + rows[at]] = np.minimum.reduceat(shingles, at)
        yield batch.append_column("family", pa.array(least.view(np.int64)))


def _gain(a: int, b: int, n_toxic: int, n_clean: int) -> float:
    """Twice the log likelihood that two shares, of toxic and of clean documents, gain over one."""

    def fit(k, n, p):
        return sum(x * np.log(q) for x, q in ((k, p), (n - k, 1 - p)) if x)

    both = (a + b) / (n_toxic + n_clean)
    own = fit(a, n_toxic, a / n_toxic) + (fit(b, n_clean, b / n_clean) if n_clean else 0)
    return 2 * (own - fit(a, n_toxic, both) - (fit(b, n_clean, both) if n_clean else 0))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 100) -> tuple[np.ndarray, float]:
    """Non-negative ridge logistic regression by projected Newton steps; classes weigh the same."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    w = np.zeros(x1.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (share * (p - y)) + penalty * w
        curvature = (x1 * (share * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        new = w - np.linalg.solve(curvature, gradient)
        new[:-1] = np.maximum(new[:-1], 0)
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w[:-1], float(w[-1])


def learn(
    documents: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    shortest: int = 4,
    longest: int = 7,
    min_seen: int = 4,
    min_gain: float = 20.0,
) -> Grammar:
    """A grammar from labelled documents: at most some ``max_rows`` of them, a documented bound, chosen by a hash of
    the id; texts with the same least shingle hash (copies, mostly) count once. Rows without a label or text, and
    ids with two different labels, teach nothing.

    A pattern is an insult if ``min_seen`` toxic documents have it, a likelihood-ratio test of its share in toxic against clean
    documents gives ``min_gain`` or more, and the lower bound of its log odds, which is its weight, is above 1. No toxic document: a grammar
    without insults that scores 0.01."""
    with text_batches(documents.sparkSession):
        return _learned(documents, labels, max_rows, shortest, longest, min_seen, min_gain)


def _learned(
    documents: DataFrame, labels: DataFrame, max_rows: int, shortest: int, longest: int, min_seen: int, min_gain: float
) -> Grammar:
    spark = documents.sparkSession
    given = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("other")
    )
    given = given.where("toxic = other").select(F.col("doc_id").alias("own_id"), "toxic")
    n = given.count()
    if n > max_rows:
        bound = int(2**63 * (max_rows / n))
        given = given.where(F.shiftrightunsigned(F.xxhash64("own_id"), 1) < bound)
    # At most some max_rows rows of two numbers.
    rows = documents.where("text is not null").select("doc_id", "text")
    rows = rows.join(F.broadcast(given), F.col("doc_id") == F.col("own_id")).select(
        "text", F.col("toxic").cast("int").alias("toxic")
    )
    rows = rows.mapInArrow(_family, "text string, toxic int, family bigint")
    rows = materialise(spark, rows.dropDuplicates(["family", "toxic"]).select("text", "toxic"), "labelled")
    sizes = dict(rows.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Grammar({}, intercept=float(np.log(0.01 / 0.99)))
    counted = (
        rows.where("toxic = 1")
        .mapInArrow(lambda it: _count(it, shortest, longest), "pattern string, a bigint, b bigint")
        .groupBy("pattern")
        .agg(F.sum("a").alias("a"))
        .where(F.col("a") >= min_seen)
    )
    # Bounded by the words of max_rows texts.
    seen = {r.pattern: r.a for r in counted.collect()}
    names = list(seen)
    clean = rows.where("toxic = 0").mapInArrow(
        lambda it: _clean_count(it, names, shortest, longest), "pattern string, b bigint"
    )
    other = {r.pattern: r.b for r in clean.groupBy("pattern").agg(F.sum("b").alias("b")).collect()}
    patterns = {}
    for p, a in seen.items():
        b = other.get(p, 0)
        odds = np.log((a + 0.5) / (n_toxic - a + 0.5)) - np.log((b + 0.5) / (n_clean - b + 0.5))
        low = odds - np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if low > 1 and _gain(a, b, n_toxic, n_clean) >= min_gain:
            patterns[p] = float(low)
    # A weight of 1 is the strongest pattern's.
    top = max(patterns.values(), default=1.0)
    grammar = Grammar({p: patterns[p] / top for p in sorted(patterns)})

    width = len(KINDS) + 1

    def featurise(batches):
        m = matcher(grammar)
        for batch in batches:
            x = [m.features(t) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([list(v) for v in x], pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    # Some max_rows rows of seven numbers.
    found = rows.mapInArrow(featurise, "x array<double>, toxic int").collect()
    x = np.array([r.x for r in found]).reshape(-1, width)
    y = np.array([r.toxic for r in found])
    weights, intercept = logistic(x, y)
    return Grammar(grammar.patterns, [float(w) for w in weights], intercept)


def score(documents: DataFrame, grammar: Grammar, name: str = "score") -> DataFrame:
    """``documents`` with the column ``name``, 0 to 1. Null and empty texts score as texts that match nothing; a column of that
    name is replaced. One row in, one row out; nothing is shuffled."""
    from pyspark.sql.types import DoubleType

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        m = matcher(grammar)
        return pa.array([m.score(t) for t in strings(texts)], pa.float64())

    return documents.withColumn(name, scored(F.col("text")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Ids whose crc32 modulo 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
