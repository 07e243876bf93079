"""Byte-level BPE vocabularies in the JSON form of the tokenizers library.

A vocabulary is read from a path that every executor can reach, once per worker process.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache

import public_tokenizers

DEFAULT_PATH = public_tokenizers.path("byte_bpe_50k.json")

# How byte-level vocabularies split a text before the merges. Fixed value.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    path: str

    @cached_property
    def _json(self) -> dict:
        with open(self.path, encoding="utf-8") as file:
            found = json.load(file)
        split, model = found["pre_tokenizer"], found["model"]
        plain = (
            model["type"] == "BPE" and not found["normalizer"] and not found["post_processor"]
            and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
            and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges",
                                               "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in found["added_tokens"])
        )
        if not plain:
            raise ValueError(f"{self.path} is no plain byte-level BPE vocabulary")
        return found

    @cached_property
    def special(self) -> dict[str, int]:
        """Strings that are one token wherever a text holds them."""
        return {t["content"]: t["id"] for t in self._json["added_tokens"]}

    @cached_property
    def ids(self) -> dict[str, int]:
        return self._json["model"]["vocab"]

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; those of a special token are its text."""
        symbols = byte_symbols()
        out = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in self.ids.items():
            out[i] = bytes(map(symbols.__getitem__, token))
        for token, i in self.special.items():
            out[i] = token.encode()
        return out

    @cached_property
    def merges(self) -> list[tuple[int, int, int]]:
        """Left id, right id and merged id by rank."""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in self._json["model"]["merges"])
        return [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]

    @cached_property
    def byte_ids(self) -> list[int]:
        out = [0] * 256
        for symbol, byte in byte_symbols().items():
            out[byte] = self.ids[symbol]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str = DEFAULT_PATH) -> Vocabulary:
    return Vocabulary(path)
