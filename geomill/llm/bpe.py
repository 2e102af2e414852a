"""Byte-level BPE ids exactly as the tokenizers library gives them, for a tokenizer file in its JSON format.

The vocabulary is read from the file; where its merges are in the order of their ids (as in this family of
files), encoding uses tiktoken's faster merge loop over the same ranks, and the tokenizers library itself where
not, or where a text is too much for tiktoken's pattern matcher. `encode_all` compares both on a sample of every batch and
leaves a batch to the library where they differ.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np

# Fixed value: the pattern that byte-level pre-tokenization splits by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHECKED = 64  # one of so many texts is encoded twice


def _bytes_of_chars() -> dict[str, int]:
    """Byte-level vocabularies write bytes as visible characters: printable Latin-1 as itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        chars, vocab = _bytes_of_chars(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.token_bytes = [b""] * self.size
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.token_bytes[i] = token
        self.token_chars = np.array(list(map(len, self.token_bytes)), np.int64)
        self._special, self._slow, self._path = special, None, path
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in spec["model"]["merges"]]
        order = [vocab[m] for m in merged]
        in_order = all(a < b for a, b in zip(order, order[1:], strict=False)) and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not spec["normalizer"]
        self._fast = None
        if in_order:
            import tiktoken

            self._fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def library(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        if self._fast is not None:
            try:
                return self._fast.encode_to_numpy(text, allowed_special="all").astype(self.dtype)
            except ValueError:  # the pattern matcher gives up on very long runs of white space
                pass
        return np.array(self.library(text), self.dtype)

    def encode_all(self, texts: list[str], every: int = CHECKED) -> list[np.ndarray]:
        """The ids of a batch of texts. Its first text and those whose crc32 `every` divides are encoded by the library too; should one differ, the
        library's ids are taken for the whole batch."""
        ids = [self.encode(t) for t in texts]
        if self._fast is not None:
            for k, t in enumerate(texts):
                if (k == 0 or zlib.crc32(t.encode("utf-8", "replace")) % every == 0) and ids[k].tolist() != self.library(t):
                    return [np.array(self.library(u), self.dtype) for u in texts]
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)
