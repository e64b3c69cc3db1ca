"""Token ids of a public tokenizer file, many texts at a time."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer


def _bytes_of_marks() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1
    stands for itself, the other bytes for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    marks = {chr(b): b for b in plain}
    rest = [b for b in range(256) if chr(b) not in marks]
    return marks | {chr(256 + i): b for i, b in enumerate(rest)}


#: Fixed value: how byte-level tokenizers of this family split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """``ids(text)`` as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    A plain byte-level BPE whose ids are its merge order is run by ``tiktoken`` over the same vocabulary, at
    several times the speed; any other file by ``tokenizers`` itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._slow = Tokenizer.from_file(path)
        self.size = self._slow.get_vocab_size()
        self._fast = self._build(spec)
        self._specials = [t["content"] for t in spec.get("added_tokens", [])]

    def _build(self, spec: dict) -> tiktoken.Encoding | None:
        model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        if not plain:
            return None
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(vocab.get(t) != 256 + i for i, t in enumerate(merged)) or len(vocab) != 256 + len(merged):
            return None
        marks = _bytes_of_marks()
        ranks = {bytes(marks[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self._fast is None or any(s in text for s in self._specials):
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
