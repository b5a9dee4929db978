"""Token ids of a byte-level BPE vocabulary file, whole texts."""

from __future__ import annotations

import json
import zlib
from array import array

import tiktoken
from tokenizers import Tokenizer

# The vocabulary's pre-tokenizer pattern (a fixed value of the public file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below this character both libraries classify every letter and digit alike.
LATIN_END = "ɐ"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, by its rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_encoders: dict[int, ByteBpe] = {}


def shared_encoder(vocabulary: bytes) -> ByteBpe:
    """This worker process's encoder of a vocabulary."""
    key = zlib.crc32(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteBpe(vocabulary)
    return _encoders[key]


class ByteBpe:
    """Encodes texts to little-endian 32-bit ids, as the tokenizers library does with its file as it is.

    Texts of Latin script take the merge table, all others the tokenizer itself, and so do texts with the
    string of a special token, which becomes that token.
    """

    def __init__(self, vocabulary: bytes) -> None:
        text = vocabulary.decode()
        self.exact = Tokenizer.from_str(text)
        alphabet = byte_alphabet()
        parsed = json.loads(text)
        vocab = parsed["model"]["vocab"]
        added = {t["content"]: t["id"] for t in parsed.get("added_tokens") or ()}
        self.special = list(added)
        self.size = max([*vocab.values(), *added.values()]) + 1
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if all(c in alphabet for c in token) and token not in added}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if (text.isascii() or max(text) < LATIN_END) and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.exact.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()
