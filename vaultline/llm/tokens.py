"""Byte-level BPE ids of whole texts, memoised by space-delimited chunks.

The vocabulary's pre-tokenizer never joins characters across a single space
that stands between two other non-space characters, so a text may be cut
before each such space and the ids of the cuts follow one another.  A memo of
bounded size maps cuts to their ids; only new cuts reach the encoder.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

MEMO_BYTES = 24 << 20  # per generation, estimated; two generations live in each Python worker
ENTRY_BYTES = 190  # of an entry besides its cut and ids: two objects and their place in the table
MEMO_CHARS = 64  # longer cuts are encoded each time
_DOUBLE = re.compile(r"\s\s")
_STOPS = frozenset(".,;:!?")
_CUT = re.compile(r"(?<=\S) (?=\S)")
SPECIAL = "<|endoftext|>"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """Printable letter -> byte, the vocabulary file's way to write bytes.

    Bytes that are printable in Latin-1 stand for themselves; the others, in
    order, are written as the code points from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """Cut -> little-endian uint32 ids; misses are encoded, and kept while the memo's bytes last."""

    def __init__(self, encode: Callable[[str], bytes], limit: int, old: dict | None = None) -> None:
        super().__init__()
        self.encode, self.limit, self.old, self.held = encode, limit, old or {}, 0

    def __missing__(self, cut: str) -> bytes:
        ids = self.old.get(cut)
        if ids is None:
            ids = self.encode(cut)
        if len(cut) <= MEMO_CHARS and self.held < self.limit:
            self.held += ENTRY_BYTES + len(cut) + len(ids)
            self[cut] = ids
        return ids

    def renewed(self) -> Memo:
        """Itself, or once it is full an empty memo that still looks into this one: two generations live."""
        if self.held < self.limit:
            return self
        young = Memo(self.encode, self.limit, self)
        self.old = {}
        return young


class TextEncoder:
    """Ids of a text as uint32 bytes in native order (little-endian on x86 and ARM).

    ``encode_word`` maps one pre-split word to ids.  ``special_id`` is the id
    of the special token's string inside a text (None: ordinary text).
    ``memo_bytes`` bounds one generation of the memo.
    """

    def __init__(self, encode_word: Callable[[str], list[int]], split: Callable[[str], list[str]], special_id: int | None, memo_bytes: int = MEMO_BYTES) -> None:
        def word(piece: str) -> bytes:
            return array("I", encode_word(piece)).tobytes()

        def pieces(cut: str) -> bytes:  # words are shared with the cuts that are one word
            return b"".join([self.rest[x[1:]] if x[0] == " " and x[1:].isalpha() else self.words[x] for x in split(cut)])

        def rest(cut: str) -> bytes:
            if cut.isalpha():  # one word
                return word(" " + cut)
            if cut[-1:] in _STOPS and cut[:-1].isalpha():  # a word and a mark of its own
                return self.rest[cut[:-1]] + self.first[cut[-1]]
            return pieces(" " + cut)

        self.first, self.rest, self.words = Memo(pieces, memo_bytes >> 4), Memo(rest, memo_bytes), Memo(word, memo_bytes >> 3)
        self.special = None if special_id is None else array("I", [special_id]).tobytes()

    def section(self, text: str) -> bytes:
        cuts = _CUT.split(text) if _DOUBLE.search(text) else text.split(" ")
        return self.first[cuts[0]] + b"".join(map(self.rest.__getitem__, cuts[1:]))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        self.first, self.rest, self.words = self.first.renewed(), self.rest.renewed(), self.words.renewed()
        if self.special is None or SPECIAL not in text:
            return self.section(text)
        return self.special.join(self.section(x) if x else b"" for x in text.split(SPECIAL))


@lru_cache(maxsize=4)
def library_encoder(path: str, special_as_text: bool = False, memo_bytes: int = MEMO_BYTES) -> TextEncoder:
    """Encoder whose ids come from the ``tokenizers`` library (one per worker process and file)."""
    import json

    import regex
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        specials = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}
    tokenize = Tokenizer.from_file(path).model.tokenize
    letters = {byte: letter for letter, byte in byte_letters().items()}
    space = letters[ord(" ")]

    def encode_word(word: str) -> list[int]:
        if word.isascii() and word.isprintable():  # such bytes stand for themselves, but for the space
            return [x.id for x in tokenize(word.replace(" ", space))]
        return [x.id for x in tokenize(word.encode().decode("latin-1").translate(letters))]

    return TextEncoder(encode_word, regex.compile(PATTERN).findall, None if special_as_text else specials.get(SPECIAL), memo_bytes)
