"""Token ids of texts with a public byte-level BPE file.

The file is the JSON of the `tokenizers` library.  Its vocabulary is read
into `tiktoken`, which gives the same ids at several times the speed: in a
byte-level BPE of this kind a token's id is also the rank of its merge.  As
there, the string of an added token of the file is that token wherever it
stands in a text.  Both are compared in the tests.
"""

from __future__ import annotations

import json

import numpy as np

#: Fixed value: how a byte-level BPE file of this kind splits texts.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_of_char() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes texts; one per Python worker and tokenizer file."""

    _by_path: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model = content["model"]
        if model["type"] != "BPE":
            raise ValueError(f"{path} holds no byte-level BPE")
        byte = _byte_of_char()
        added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        if any(t[k] for t in content.get("added_tokens", [])
               for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that take more than their own string")
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()
                 if token not in added}
        self.encoding = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens=added)

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def encode(self, text: str) -> np.ndarray:
        """The ids as uint32."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")
