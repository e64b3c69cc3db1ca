"""The trie, the manifest and the quality model against plain versions, on odd tables and at cut sizes."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from frames import empty_documents, odd_documents
from pyspark.sql import functions as F

from linewatch.llm import merkle, places, prefix_trie, quality
from linewatch.llm.catalog import QUERIES

MEDIUM = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn int, role string, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- trie


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, key, text))
    convs = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        n = zlib.crc32(str(c).encode()) % 6
        base = convs.get(c - int(np.fmod(c, 100)), [])
        built[c] = base[:n] + own[n:]
    nodes = {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            nodes.setdefault(tuple(said[:d]), []).append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (
            min(m), len(k), min(nodes[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
            h(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))),
        )
        for k, m in nodes.items()
    )


def found_trie(df, **how):
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_trie(df, **how).collect())


def talks():
    rng = random.Random(5)
    rows = [(None, 1, "user", "nobody"), (7, None, None, None), (7, 3, "user", None), (7, 3, "user", None), (-7, 1, "user", "x"), (-7, 1, "assistant", "x")]
    for c in [*range(90, 130), 200, 205, 301, 302, 10**12, 10**12 + 3]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "a long text " * 50, "漢字", ""]) if t else "hello"))
    # A long conversation, and copies of it that end elsewhere.
    long = [("user", f"turn {i % 7}") for i in range(60)]
    for c, n in ((400, 60), (401, 60), (402, 45), (403, 45)):
        rows += [(c, t, *said) for t, said in enumerate(long[:n])]
    return rows


@pytest.mark.parametrize("span", [5_000, 7])
def test_trie_against_plain(spark, monkeypatch, span):
    for module in (places, prefix_trie):
        monkeypatch.setattr(module, "SPAN", span)
    rows = talks()
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", *[f"'x' as `{c}`" for c in "nth first n depth group digest pos h".split()])
    assert found_trie(df.repartition(5)) == plain_trie(rows)


def test_trie_hot_parents(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", 3)
    rows = talks()
    assert found_trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_trie_survives_colliding_hashes(spark):
    """A digest that is the same for all turns, the first time."""
    tried = []

    def weak(role, text, seed):
        tried.append(seed)
        return prefix_trie.turn_digest(role, text, 0) if seed else F.lit("0" * 32)

    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(12) for t in range(8)]
    assert found_trie(spark.createDataFrame(rows, TURNS), digest=weak) == plain_trie(rows)
    assert set(tried) == {0, 1}


def test_trie_of_nothing(spark):
    assert found_trie(spark.createDataFrame([], TURNS)) == []
    assert found_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []


# ---- manifest


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    return [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def beside(levels, at):
    """(left, right) siblings by level."""
    out = []
    for level in levels[:-1]:
        run = at // 3 * 3
        out.append((level[run:at], level[at + 1 : run + 3]))
        at //= 3
    return out


def plain_audit(rows):
    by_source = {}
    for r in rows:
        text = r[4] if r[4] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 2 else r[4].replace("\n", "")
        leaf = h(*map(encoded, r))
        by_source.setdefault((r[1] is not None, (r[1] or "").encode()), []).append((r[0] is not None, r[0] or 0, leaf, h(*map(encoded, (*r[:4], text))), r))
    sources = sorted(by_source)
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for at, (_, _, leaf, changed, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            proof, now = beside(trees[s], at) + beside(top, i), changed
            for left, right in proof:
                now = h(*left, now, *right)
            siblings = "".join("".join(le + ri) for le, ri in proof)
            out.append((-1 if r[0] is None else r[0], leaf, trees[s][-1][0], top[-1][0], h(siblings), now, now == top[-1][0]))
    return sorted(out)


DOCUMENTS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def found_audit(df):
    rows = merkle.audit(df).select(
        F.coalesce("doc_id", F.lit(-1)), "leaf", "subroot", "root", F.sha2(F.array_join(F.flatten("proof"), ""), 256), "folded_root",
        F.col("folded_root") == F.col("root"),
    )
    return sorted(map(tuple, rows.collect()))


def odd_rows():
    rng = random.Random(9)
    rows = [(i, f"s{rng.choice('abcdé')}", "en", i % 5, f"line {i}\nline\n" if i % 3 else f"one line {i}") for i in range(300)]
    rows += [(1000, "alone", None, None, None), (1001, None, "de", 3, ""), (1002, None, None, None, "é\n漢\n"), (None, "sa", "en", 1, "no id\n")]
    return rows + [(1003, "twice", "en", 1, "same\n")] * 5 + [(1003, "twice", "en", 1, "other\n")] * 2 + [(1004, "", "en", 1, "x" * 100_000 + "\n")]


@pytest.mark.parametrize("levels", [6, 2])
def test_manifest_against_plain(spark, monkeypatch, levels):
    """Also with segments of two levels, spans of a few rows, and hence several of each in a tree."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "FOOT", 3**levels)
    monkeypatch.setattr(places, "SPAN", 11 if levels == 2 else 5_000)
    monkeypatch.setattr(places, "SORTED_ROWS", 50)
    rows = odd_rows()
    df = spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", *[f"'x' as `{c}`" for c in "nth leaf at tree height root first n group digits path".split()])
    assert found_audit(df.repartition(4)) == plain_audit(rows)


def test_manifest_small(spark):
    for rows in ([], [(1, "s", "en", 1, "x")], [(1, "s", "en", 1, "x"), (2, "t", "en", 1, "x\ny")]):
        assert found_audit(spark.createDataFrame(rows, DOCUMENTS)) == (plain_audit(rows) if rows else [])
    assert len(merkle.audit(odd_documents(spark)).collect()) == odd_documents(spark).count()
    assert merkle.audit(empty_documents(spark)).count() == 0


def test_some_leaves_are_proven(spark):
    """Requests for a few leaves get the proofs that those leaves have among all."""
    rows = spark.createDataFrame([(i, f"s{i % 2}", h(str(i))) for i in range(900)], "doc_id bigint, source string, leaf string")
    made = merkle.manifest(rows, "source", "doc_id", "leaf")
    everything = {r.doc_id: r.proof for r in merkle.prove(made).collect()}
    some = merkle.prove(made, made.leaves.where("doc_id % 97 = 5")).withColumn("again", merkle.folded(F.col("leaf"))).collect()
    assert len(some) == 10
    assert all(r.again == made.root and r.proof == everything[r.doc_id] for r in some)


# ---- quality


def plain_measures(text):
    data = text.encode()
    words, word = [], ""
    for c in text + " ":
        c = c.lower() if c.isascii() else c
        if c.isascii() and not c.isalnum():
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = data.split(b"\n")
    lines = lines[:-1] if data.endswith(b"\n") else lines
    lines = lines if data else []

    def grams(k):
        return Counter(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))) if words else Counter()

    n, w = max(len(data), 1), max(len(words), 1)
    p = np.array(list(Counter(data).values())) / n
    at_least = max(len(lines), 1)
    share = {k: sum(b in v for b in data) / n for k, v in quality.BYTE_CLASSES.items()}
    letters = share["upper"] + share["lower"]
    g3, g5 = grams(3), grams(5)
    return [
        np.log2(1 + len(data)), *share.values(), share["upper"] / letters if letters else 0, -(p * np.log2(p)).sum() if len(p) else 0,
        sum(a == b for a, b in zip(data, data[1:])) / n, sum(len(x.encode()) for x in words) / w, np.log2(1 + len(words)), len(words) / at_least,
        len(set(words)) / w, max(Counter(words).values(), default=0) / w, sum(a == b for a, b in zip(words, words[1:])) / w,
        len(g3) / max(sum(g3.values()), 1), len(g5) / max(sum(g5.values()), 1), max(g5.values(), default=0) / max(sum(g5.values()), 1),
        len(set(lines)) / at_least, sum(x[-1:] in (b".", b"!", b"?") for x in lines) / at_least,
    ]


def test_measures_against_plain():
    texts = [
        "", "\n", "\n\n.", "a", "The cat. The cat!\nThe cat. The cat!\n\nNO WAY!!! ### | x | y", "Ünï ç漢字 😀\n1,2;3", "x " * 400, "word\n" * 300 + "end.",
        " ".join(f"w{i * i % 37}" for i in range(500)),
    ]
    got = quality.measures(pa.array([None, *texts]))
    np.testing.assert_allclose(got[0], 0)
    np.testing.assert_allclose(got[1:], [plain_measures(t) for t in texts], rtol=1e-9, atol=1e-12)


def test_additive_model_finds_steps_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 5))
    z = 3 * (x[:, 0] > 0.6) - 1.5 + 4 * ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)) - 2
    y = (rng.random(6000) < 1 / (1 + np.exp(-z))).astype(int)
    model = quality.fit(x[:4000], y[:4000])
    assert (1, 2) in [(f, g) for f, g, _ in model.pairs]
    right = ((model.score(x[4000:]) >= 0.5) == (z[4000:] >= 0)).mean()
    assert right > 0.9
    only_main = quality.fit(x[:4000], y[:4000], quality.Boosting(pairs=0))
    assert ((only_main.score(x[4000:]) >= 0.5) == (z[4000:] >= 0)).mean() < right - 0.1
    # Scores are sums of entries.
    one = x[4000:4001]
    b = model.bins(one)[0]
    total = model.intercept + sum(t[b[f]] for f, t in enumerate(model.tables))
    total += sum(t[model.coarse[f][b[f]], model.coarse[g][b[g]]] for f, g, t in model.pairs)
    assert model.margin(one)[0] == pytest.approx(total)


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    scored = quality.score(odd_documents(spark), quality.learn(odd_documents(spark), none)).collect()
    assert len(scored) == odd_documents(spark).count() and {r.score for r in scored} == {0.5}
    assert quality.score(empty_documents(spark), quality.learn(empty_documents(spark), none)).count() == 0
    odd = spark.createDataFrame([(1, None), (6, 1), (7, 0), (7, 1), (None, 1), (11, 1), (11, 1)], "doc_id bigint, quality int")
    one_sided = quality.score(odd_documents(spark), quality.learn(odd_documents(spark), odd)).collect()
    assert all(0.5 < r.score < 1 for r in one_sided)


def test_quality_on_held_out_labels(spark):
    rows = QUERIES["op13_quality"](spark, MEDIUM).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and label.get(r.doc_id) is not None]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    assert sum(p for p, q in held if q == 1) >= 0.98 * sum(q for _, q in held)
