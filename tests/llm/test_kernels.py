"""The methods by themselves, on numbers."""

import math
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linewatch.llm import bagminhash, chat, language, packing, rotation_codes, secret_scan, toxicity, url_rules, words
from linewatch.llm.components import components
from linewatch.llm.encode import encoder


def test_word_hashes_agree_with_words():
    import re

    import pyarrow as pa

    texts = ["One two, THREE two", "", "x", "é2 É2 two", "...", "a.b.a"]
    seen = {}
    for _, data, offsets in words.text_slices(pa.array([*texts, None])):
        hashes, bounds = words.hash_words(data, offsets)
        for i, t in enumerate(texts):
            lowered = "".join(c.lower() if c in words.UPPER else c for c in t)
            want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
            got = hashes[bounds[i] : bounds[i + 1]].tolist()
            assert len(got) == len(want)
            for w, h in zip(want, got):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_do_not_change_hashes(monkeypatch):
    import pyarrow as pa

    texts = pa.array([" ".join(f"t{i}x{j}" for j in range(i % 50)) for i in range(200)])

    def all_hashes():
        out = []
        for _, data, offsets in words.text_slices(texts):
            hashes, bounds = words.hash_words(data, offsets)
            out += [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        return out

    whole = all_hashes()
    monkeypatch.setattr(words, "SLICE", 100)
    assert all_hashes() == whole


def test_bagminhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(150):
        shingles = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
        x = rng.integers(0, 12, 40)
        y = np.where(rng.random(40) < 0.6, x, rng.integers(0, 12, 40))
        rows = np.concatenate([np.zeros((x > 0).sum(), int), np.ones((y > 0).sum(), int)])
        s = bagminhash.signatures(
            rows, np.concatenate([shingles[x > 0], shingles[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]), 2, 100
        )
        errors.append((s[0] == s[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(errors)) < 0.012
    assert np.std(errors) < 0.065


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    errors, outside, pairs = [], 0, 0
    for seed in range(20):
        units = rotation_codes._units(rng.standard_normal((60, 64)) + 0.7)
        signs, factors, rotated = rotation_codes.encode(units, seed)
        got, bound = rotation_codes.estimate(signs, factors, rotated, 4.0)
        gap = (got - units @ units.T)[~np.eye(60, dtype=bool)]
        errors.append(gap.mean())
        outside += (np.abs(gap.reshape(60, 59)) > bound[:, None]).sum()
        pairs += gap.size
        # A code says exactly 1 about its own vector.
        assert np.allclose(np.diag(got), 1)
    assert abs(np.mean(errors)) < 0.01
    assert outside <= pairs * 1e-3


def test_bands_hold_the_miss_rate_at_any_size():
    codes = rotation_codes.Codes()
    for n in (0, 1, 100, 10**6, 10**9):
        bits, bands = codes.bands(n)
        meet = (1 - math.acos(codes.threshold) / math.pi) ** bits
        assert (1 - meet) ** bands <= codes.miss * 1.0001


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_places_every_tail_once(seed):
    rng = np.random.default_rng(seed)
    window = 64
    counts = np.bincount(rng.integers(1, window, 500), minlength=window)
    counts[rng.integers(1, window)] += 300  # a length that a third of all tails have
    counts[0] = 0
    plan = packing.make_plan(window, counts)
    filled = {}
    for length in range(1, window):
        for rank in range(counts[length]):
            if rank < plan.used[length]:
                slot = np.flatnonzero((plan.length == length) & (plan.first <= rank))[-1]
                filled.setdefault(plan.sequence[slot] + rank - plan.first[slot], []).append((plan.offset[slot], length))
    assert all(n <= counts[i] for i, n in enumerate(plan.used))
    assert sorted(filled) == list(range(plan.planned))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window
    left = ((counts - plan.used) * np.arange(window)).sum()
    assert plan.sequences == plan.planned + -(-left // window)


def test_least_squares_fits_a_solvable_histogram():
    window = 16
    combos = packing.combinations(window, np.arange(1, window))
    assert (combos.sum(axis=1) == window).all() and (np.diff(combos, axis=1) <= 0).all()
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, len(combos))
    counts = sum(np.bincount(combos[:, k], x, window) for k in range(3))
    counts[0] = 0
    found = packing.least_squares(combos, counts, 4000)
    made = sum(np.bincount(combos[:, k], found, window) for k in range(3))
    assert (found >= 0).all() and np.abs(made[1:] - counts[1:]).max() < 0.5


def test_encoder_equals_the_tokenizer():
    path = corpus_pipeline.tokenizer_file()
    plain = Tokenizer.from_file(path)
    texts = ["", " ", "\n\n  x", "It's we'll", "漢字 😀 ñandú", "a" * 3000, "<|endoftext|> after", "12 345\t6", "\u00a0x\u2003y"]
    rng = random.Random(4)
    texts += ["".join(chr(rng.choice([32, 10, 39, 65, 97, 233, 0x4E2D, 0x1F600, 48])) for _ in range(200)) for _ in range(50)]
    for t in texts:
        assert encoder(path).ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids


def test_randomness_battery():
    rng = random.Random(2)
    random_tokens = ["".join(rng.choice(secret_scan.ALPHABETS["base62"]) for _ in range(32)) for _ in range(300)]
    kept = sum(secret_scan.randomness(t, "base62") >= 1e-4 for t in random_tokens)
    assert kept >= 295
    for token in ("a1" * 16, "abcdefghijklmnopqrstuvwxyz012345", "0000000000000000aaaaaaaaaaaaaaaa"):
        assert secret_scan.randomness(token, secret_scan.encoding(token)) < 1e-4
    assert secret_scan.encoding("deadbeef01") == "hex"
    assert secret_scan.encoding("nodigitsatall") is None
    assert secret_scan.encoding("1234567890") is None


def test_grammar_kinds():
    grammar = toxicity.Grammar({"idiot": 1.0, "scum*": 0.5}, [1.0] * 7, -1.0)
    m = toxicity.matcher(grammar)

    def kinds(text):
        x = np.expm1(m.features(text)[:-1])
        return {k: round(v, 6) for k, v in zip(toxicity.KINDS, x) if v > 0}

    assert kinds("What an idiot.") == {"bare": 1.0}
    assert kinds("You are an idiot.") == {"aimed": 1.0}
    assert kinds("Idiot, you!") == {"aimed": 1.0}
    assert kinds("He is not an idiot.") == {"negated": 1.0}
    assert kinds("One said that idiot left.") == {"reported": 1.0}
    assert kinds("One said so. That idiot left.") == {"bare": 1.0}
    assert kinds("I will kill you") == {"threat": 1.0}
    assert kinds("you i will kill") == {"threat_aimed": 1.0}
    assert kinds("scummy scum") == {"bare": 1.0}
    assert kinds("idiotic") == {}
    assert m.score("") == m.score("nothing here")


def test_mixture_finds_proportions():
    rng = np.random.default_rng(0)
    n = 4000
    likelihood = rng.normal(0, 1, (n, 3))
    likelihood[np.arange(n), rng.choice(3, n, p=[0.7, 0.3, 0])] += 6
    share, _ = language.mixture(likelihood, np.zeros(n, int), 1, np.ones((1, 3)), 200, 1e-6)
    assert np.abs(share[0] - [0.7, 0.3, 0]).max() < 0.03


def test_url_sweep_against_all_rules():
    rng = random.Random(7)
    labels = ["a", "b", "c"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(40)]
    rules = list({(rng.choice(hosts), rng.choice(["", "/", "/x", "/x/y", "/xy"])) for _ in range(30)})
    urls = [(rng.choice(hosts), rng.choice(["", "/", "/x", "/x/y/z", "/xyz", "/q"])) for _ in range(300)]

    def key(h):
        return "\x01".join(reversed(h.split("."))) + "\x01"

    events = sorted([(key(h), 0, h, p) for h, p in rules] + [(key(h), 1, h, p) for h, p in urls])
    sweep = url_rules.Sweep()
    for k, kind, h, p in events:
        if kind == 0:
            sweep.open(k, h, p, "block")
            continue
        fits = [(len(a) + len(b), len(a), a + b) for a, b in rules if (h == a or h.endswith("." + a)) and p.startswith(b)]
        assert sweep.judge(k, h, p)[0] == (max(fits)[2] if fits else None)


def test_chat_parts_round_trip():
    hostile = ["</turn>", "<turn:user>", "\\l", "\\\\", "<image:0>", "a\\<b", "", "x\n</turn>\n<turn:assistant>"]
    for text in hostile:
        formatted, attachments, spans = chat.format_turn("user<1>", [chat.Part("text", text)])
        assert chat.read_turns(formatted) == [("user<1>", text)]
        assert "".join(chat.unescape(formatted[s:e]) for s, e in spans) == text
        assert attachments == []
    parts = [
        chat.Part("text", "see <this>"),
        chat.Part("image", ref="i.png", width=57, height=28),
        chat.Part("audio", ref="a.wav", seconds=1.5),
        chat.Part("document", ref="d.pdf", pages=3),
        chat.Part("text", "end"),
    ]
    formatted, attachments, spans = chat.format_turn("assistant", parts)
    assert [(a["index"], a["kind"], a["ref"], a["tokens"]) for a in attachments] == [
        (0, "image", "i.png", 3),
        (1, "audio", "a.wav", 38),
        (2, "document", "d.pdf", 768),
    ]
    assert chat.read_turns(formatted) == [("assistant", "see <this>end")]
    assert [chat.unescape(formatted[s:e]) for s, e in spans] == ["see <this>", "end"]
    with pytest.raises(ValueError):
        chat.format_turn("user", [chat.Part("video")])
