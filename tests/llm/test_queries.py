"""The registered queries against SQL, brute force, round trips and held-out labels."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from check import compare, connect
from conftest import SF
from tokenizers import Tokenizer

import corpus_pipeline
from linewatch.llm.catalog import ORACLES, QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    ok, text = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert ok, text


def texts_of(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


BASE = [
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", "AKIA[A-Z0-9]+", 16, 0),
    ("hex", "[0-9a-f]+", 32, 0),
]


def base_spans(text):
    spans = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, (kind, pattern, least, group) in enumerate(BASE)
        for m in re.finditer(pattern, text)
        if len(m.group(group)) >= least
    ]
    return [s[2] for s in sorted(spans)]


def test_secrets_against_plain_patterns(spark):
    texts = texts_of(spark, SF)
    rows = QUERIES["op4_secrets"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))


def test_toxicity_on_held_out_labels(spark):
    rows = QUERIES["op5_toxicity"](spark, MEDIUM).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    right = sum(p == t for p, t in held)
    assert right >= 0.95 * len(held)
    assert all(t == 1 for p, t in held if p == 1)


def test_language_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = QUERIES["op8_language"](spark, MEDIUM).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and r.lang_pred != "und" and lang[r.doc_id]]
    assert sum(held) >= 0.98 * len(held)


def check_packing(rows, texts, window=1024):
    """Every id in exactly one piece, gapless offsets, and little padding."""
    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_file())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    total = sum(r.length for r in rows)
    assert len(by_sequence) == -(-total // window)


def test_packing_round_trip(spark):
    check_packing(QUERIES["op10_pack"](spark, SF).collect(), texts_of(spark, SF))
