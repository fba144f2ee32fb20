"""Byte-level vocabularies from public files: bytes of each id, ranks of each pair."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np


class Merges:
    """Ranks of symbol pairs; ``made[rank]`` is the symbol that the pair merges to."""

    def __init__(self, tokens: dict[bytes, int], pairs: list[tuple[int, int, int]], made: np.ndarray) -> None:
        """``pairs``: left symbol, right symbol, rank."""
        self.tokens, self.made = tokens, made
        self.singles = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        self.size = max(tokens.values()) + 1
        self.none = len(made)
        pieces = [b""] * self.size
        for token, n in tokens.items():
            pieces[n] = token
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        keys, ranks = np.array(sorted((a * self.size + b, r) for a, b, r in pairs), np.int64).T
        self.keys, self.ranks = np.ascontiguousarray(keys), np.ascontiguousarray(ranks)
        self.byte_ranks = self.rank(self.singles[:, None], self.singles[None, :])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; ``none`` if it does not merge."""
        keys = left * self.size + right
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        return np.where(self.keys[place] == keys, self.ranks[place], self.none)


@lru_cache(maxsize=4)
def read_ranks(path: str) -> Merges:
    """From lines of base64 token and rank: any pair that spells a token merges, at its rank."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pairs = [(tokens[t[:k]], tokens[t[k:]], n) for t, n in tokens.items()
             for k in range(1, len(t)) if t[:k] in tokens and t[k:] in tokens]
    return Merges(tokens, pairs, np.arange(max(tokens.values()) + 1))


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def read_json(path: str) -> tuple[Merges, dict[bytes, int]]:
    """The listed merges and the special tokens of a byte-level vocabulary in JSON."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters, ids = byte_letters(), content["model"]["vocab"]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    tokens = {bytes(letters[c] for c in token): n for token, n in ids.items() if token not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
    pairs = [(ids[a], ids[b], rank) for rank, (a, b) in enumerate(merges)]
    made = np.array([ids[a + b] for a, b in merges], np.int64)
    return Merges(tokens, pairs, made), {t.encode(): n for t, n in special.items()}
