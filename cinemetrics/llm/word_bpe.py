"""Token ids of a word-level BPE file (``tokenizers`` format), cached by word.

The file's pre-tokenizer never joins across white space, so a text's ids are the ids of its
white-space separated pieces one after the other, and each task tokenizes every distinct
piece once. Pieces of plain Latin letters, digits and signs are split here and merged by
``tiktoken`` with the file's own ranks: the end-of-word mark is written as the byte 0xFF,
which UTF-8 text never holds, and its one-character tokens come before all merges. Any other
piece, and one that may hold a special token's text, goes to ``tokenizers`` itself. ``tests/llm`` compares both on random and on corpus text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

END = "</w>"
# white-space free pieces split here: printable ASCII and Latin letters whose lower case is one letter
PLAIN = "[!-~À-ÖØ-öø-įı-ſ]+"
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
# pieces kept per task before the cache starts anew
CACHE_PIECES = 300_000


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE files: visible Latin-1 stands for itself, the
    other bytes follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Cache(dict):
    """Remembers what ``make`` gives for a key."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        self[key] = found = self.make(key)
        return found


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class WordBpe:
    """ids(text) -> little-endian unsigned 32-bit ids as bytes, without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        # a piece with the first sign of a special token is not plain
        first = "".join(sorted({re.escape(t[0]) for t in special}))
        self.plain = re.compile(f"(?:(?![{first}]){PLAIN[:-1]})+" if first else PLAIN)
        as_byte = byte_of_symbol()
        ranks: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if token in special:
                continue
            ended = token.endswith(END) and token != END
            body = bytes(as_byte[c] for c in (token[: -len(END)] if ended else token))
            ranks[body + b"\xff" if ended else body] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.words = _Cache(self._word)
        self.pieces = _Cache(self._piece)

    def _word(self, word: str) -> bytes:
        return _packed(self.merge.encode_single_piece(word.encode() + b"\xff"))

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if self.plain.fullmatch(text):
            words = PARTS.findall(text.lower())
            return self.words[words[0]] if len(words) == 1 else b"".join(map(self.words.__getitem__, words))
        return _packed(self.exact.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
            self.words.clear()
        return b"".join(map(self.pieces.__getitem__, text.encode("utf-8", "surrogatepass").split()))
