"""Token ids of whole texts by a public byte-level BPE tokenizer file.

The file is one of the ``tokenizers`` library. Texts of Latin letters and
common punctuation are encoded by ``tiktoken`` from the same file's vocabulary
(its merges are numbered in the order of their ranks), which gives the same
ids in a third of the time; all other texts, on whose letters and white space
the two libraries' Unicode tables might differ, go through ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property, lru_cache

#: fixed value: the pre-tokenizer's pattern of byte-level BPE files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ASCII but for four control characters, Latin-1 and Latin letters with accents, general punctuation, euro
_LATIN = re.compile("[\\x00-\\x1b\\x20-\\x7f\\xa1-\\u024f\\u2010-\\u2027\\u20ac]*")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _bytes_of_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes
    stand for themselves, the others for letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, special = _bytes_of_letters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        """The library's own tokenizer, read when the first text needs it."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.encode_special_tokens = True  # their strings in a text are ordinary text
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> bytes:
        if _LATIN.fullmatch(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per process and file, until ``encoder.cache_clear()``."""
    return Encoder(path)
