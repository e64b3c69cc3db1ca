"""Secret scan: fixed patterns, and a battery of randomness tests on the other tokens of a text.

A token's encoding is inferred from its characters. Under the encoding's alphabet three tests look at it: chi-squared
for the uniformity of the symbols, Wald-Wolfowitz runs about the middle of the alphabet, and the
lag-1 serial correlation. A token that any of the three rejects as random is none. For the others, the chance that
written text of the same length looks as uniform is taken from the character counts of the whole corpus, and
Benjamini-Hochberg over all tokens of an encoding and a length class bounds the false discoveries among them.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.llm.batches import strings, text_batches
from linewatch.llm.names import unused
from linewatch.llm.words import text_slices
from linewatch.session import materialise

KINDS = ["assign", "access", "hex", "random"]

# The base patterns and the shortest match of each.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets by encoding, the narrowest first: a token has the first that holds all its characters.
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "BASE36": DIGITS + UPPER,
    "base36": DIGITS + LOWER,
    "base58": "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
_SETS = {name: frozenset(a) for name, a in ALPHABETS.items()}
_PLACES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}


@dataclass(frozen=True)
class Battery:
    """``shortest``: characters of a token that can be tested; ``alpha``: the least combined p-value of a random token;
    ``rate``: false discoveries among those added."""

    shortest: int = 20
    alpha: float = 1e-4
    rate: float = 0.001


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind): leftmost matches that do not overlap, by kind; short ones are dropped after matching."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def encoding(token: str) -> str | None:
    """The narrowest alphabet that holds the token; None for tokens without two of digits, small and capital letters."""
    chars = set(token)
    if sum(not chars.isdisjoint(kind) for kind in (DIGITS, LOWER, UPPER)) < 2:
        return None
    return next((name for name, s in _SETS.items() if chars <= s), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_squared_tail(x: float, df: int) -> float:
    """Wilson-Hilferty: close enough from 10 degrees of freedom on, and monotone below."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return _normal_tail(z)


def randomness(token: str, name: str) -> float:
    """The combined p-value of the three tests, by the least of them times three."""
    places = _PLACES[name]
    k, n = len(places), len(token)
    at = [places[c] for c in token]
    counts = np.bincount(at, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    p_uniform = _chi_squared_tail(chi, k - 1)
    high = [2 * x >= k for x in at]
    n1 = sum(high)
    n0 = n - n1
    if n0 and n1:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 2 * n0 * n1 / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = 2 * _normal_tail(max(abs(runs - mean) - 0.5, 0) / spread)
    else:
        p_runs = 2.0 ** (1 - n)
    x = np.array(at, float)
    x -= x.mean()
    power = float((x * x).sum())
    r = float((x[1:] * x[:-1]).sum()) / power if power else 1.0
    p_serial = 2 * _normal_tail(abs(r + 1 / (n - 1)) * math.sqrt(n - 1))
    return min(1.0, 3 * min(p_uniform, p_runs, p_serial))


def text_likeness(token: str, name: str, shares: dict[str, float]) -> float:
    """-log10 of the chance that ``len(token)`` characters of written text are spread over the alphabet as evenly as the token's.

    ``shares``: the corpus's shares of characters. The statistic is the sum of squared counts; its mean and variance
    under independent draws are exact to the leading orders in the length."""
    n = len(token)
    p = np.array([shares.get(c, 0.0) for c in ALPHABETS[name]])
    mass = p.sum()
    # Text under the alphabet: characters outside of it do not occur in tokens of it.
    p = p / mass if mass > 0 else np.full(len(p), 1 / len(p))
    s2, s3 = float((p**2).sum()), float((p**3).sum())
    mean = n + n * (n - 1) * s2
    spread = math.sqrt(max(4 * n * (n - 1) * (n - 2) * (s3 - s2 * s2) + 2 * n * (n - 1) * (s2 - s2 * s2), 1e-9))
    counts: dict[str, int] = {}
    for c in token:
        counts[c] = counts.get(c, 0) + 1
    even = (mean - sum(v * v for v in counts.values())) / spread
    # What text hardly ever does besides: its characters' own likelihood against uniform draws.
    surprise = -sum(math.log10(max(shares.get(c, 0.0) / max(mass, 1e-12), 1e-9) * len(p)) for c in token)
    tail = _normal_tail(even) if even < 37 else 10.0**-300
    return max(-math.log10(max(tail, 1e-300)), 0.0) + max(surprise, 0.0)


def stratum(name: str, n: int) -> str:
    """Encoding and length class: a doubling of length in two classes."""
    return f"{name}:{int(2 * math.log2(n))}"


_BYTES_COUNTED = np.array([ord(c) for c in DIGITS + UPPER + LOWER + "+/-_"])


def character_shares(documents: DataFrame) -> dict[str, float]:
    """Shares of the characters of all encodings, over all texts."""

    def count(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for _, data, _ in text_slices(batch.column("text")):
                total += np.bincount(data, minlength=256)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chr(c) for c in _BYTES_COUNTED]), pa.array(total[_BYTES_COUNTED])], names=["c", "n"]
        )

    counts = documents.select("text").mapInArrow(count, "c string, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    found = {r.c: r.n for r in counts.collect()}  # a row per character
    total = max(sum(found.values()), 1)
    return {c: n / total for c, n in found.items()}


SPAN = "struct<start:int,end:int,kind:string>"
TOKEN = "struct<start:int,end:int,stratum:string,evidence:double,random:boolean>"
_PLACE = [("start", pa.int32()), ("end", pa.int32())]
_SPAN_ROW = pa.struct([*_PLACE, ("kind", pa.string())])
_TOKEN_ROW = pa.struct([*_PLACE, ("stratum", pa.string()), ("evidence", pa.float64()), ("random", pa.bool_())])


def _scan(text: str, battery: Battery, tokens: re.Pattern, shares: dict[str, float]):
    base = base_spans(text)
    found = []
    for m in tokens.finditer(text):
        token = m.group()
        name = encoding(token)
        start, end = m.span()
        if name is None or any(s < end and start < e for s, e, _ in base):
            continue
        found.append(
            (start, end, stratum(name, len(token)), text_likeness(token, name, shares), randomness(token, name) >= battery.alpha)
        )
    return base, found


def scan(documents: DataFrame, battery: Battery = Battery(), name: str = "secrets") -> DataFrame:
    """``documents`` with the column ``name``: array of (start, end, kind), ordered by start and kind.

    Offsets are code points, the end exclusive. The base kinds are exact; ``random`` spans never overlap them.
    Null and empty texts have no spans. Each row is looked at by itself, so repeated rows and ids stay as they are; a column of that
    name is replaced."""
    spark = documents.sparkSession
    with text_batches(spark):
        shares = character_shares(documents)
    # An equals sign parts a name from its value, or pads a value: no token holds one.
    tokens = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % battery.shortest)
    columns = [c for c in documents.columns if c != name]
    raw = unused(documents, "raw")

    @F.arrow_udf(f"struct<base:array<{SPAN}>,tokens:array<{TOKEN}>>")
    def found(texts: pa.Array) -> pa.Array:
        base, tested = [], []
        for text in strings(texts):
            b, t = _scan(text, battery, tokens, shares)
            base.append([dict(zip(("start", "end", "kind"), x)) for x in b])
            tested.append([dict(zip(("start", "end", "stratum", "evidence", "random"), x)) for x in t])
        columns = [pa.array(base, pa.list_(_SPAN_ROW)), pa.array(tested, pa.list_(_TOKEN_ROW))]
        return pa.StructArray.from_arrays(columns, names=["base", "tokens"])

    # The evidence of all tokens is needed before any is judged.
    evidence = documents.select(F.explode(found("text")["tokens"]).alias("t")).select("t.*")
    levels = evidence.groupBy("stratum", F.least(F.floor(F.col("evidence") * 10), F.lit(4000)).alias("level")).agg(
        F.count(F.lit(1)).alias("n")
    )
    with text_batches(spark):
        levels = materialise(spark, levels, "evidence")
    limits = thresholds(levels, battery.rate)
    cut = F.create_map(F.lit("none"), F.lit(math.inf), *[F.lit(v) for pair in limits.items() for v in pair])
    scanned = documents.select(*columns, found("text").alias(raw))
    taken = F.filter(f"{raw}.tokens", lambda t: t["random"] & (t["evidence"] >= F.coalesce(cut[t["stratum"]], F.lit(math.inf))))
    added = F.transform(taken, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("random").alias("kind")))
    order = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    keyed = F.transform(F.concat(f"{raw}.base", added), lambda s: F.struct(s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"]))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return scanned.withColumn(name, spans).drop(raw)


def thresholds(levels: DataFrame, rate: float) -> dict[str, float]:
    """Benjamini-Hochberg by stratum over counts of tokens by tenths of -log10 p: the least evidence at which tokens times p
    is at most ``rate`` of those with that much. At most some 4,000 levels a stratum, and some 40 strata an encoding."""
    rows: dict[str, list[tuple[int, int]]] = {}
    for r in levels.collect():
        rows.setdefault(r.stratum, []).append((r.level, r.n))
    out = {}
    for name, counts in rows.items():
        total, above = sum(n for _, n in counts), 0
        for level, n in sorted(counts, reverse=True):
            above += n
            if total * 10.0 ** (-level / 10) <= rate * above:
                out[name] = level / 10
    return out


def render(spans, kinds: list[str] | None = None):
    """``kind:start:end`` joined by commas; only of ``kinds``, if given."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(documents: DataFrame, battery: Battery = Battery(), mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with each stretch of overlapping spans replaced by ``mark``; other texts stay as they are, null too."""
    name = unused(documents, "secrets")
    scanned = scan(documents, battery, name)

    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for i, text in enumerate(strings(texts)):
            pieces, at = [], 0
            for s in sorted(spans[i].as_py() or [], key=lambda s: (s["start"], s["end"])):
                if s["start"] >= at or not pieces:
                    pieces += [text[at : s["start"]], mark]
                at = max(at, s["end"])
            out.append("".join(pieces) + text[at:] if pieces else None)
        return pa.array(out, pa.string())

    # Texts without a span stay in the JVM.
    touched = F.when(F.size(name) > 0, F.col("text"))
    text = F.coalesce(masked(touched, F.col(name)), F.col("text"))
    return scanned.withColumn("text", text).select(*documents.columns)
