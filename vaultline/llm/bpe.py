"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels and accepts exactly the tokenizations that
the merge list produces.  It starts as one state with a loop for every byte.
For each merge (u, v), in order, a *merge gadget* is applied: the state that
arcs labelled u lead to is replaced, for those arcs, by a copy without its
arc v, and every state that has an arc u gets an arc uv to the state that
v led to.  The result is deterministic, and all arcs with one label lead to
one state, so a state is named by the label that leads to it.

A copied state differs from its original by one arc, so states are stored as
chains of gadgets (``chain``): the labels whose gadgets removed arcs, each
with the time until which its gadgets count.  An arc t exists at a state
unless, at the time its label was made, the arc of the label's first part
(``spine``) was already missing.  Rows of the arc table are filled from the
chains on first use, so a 50,000-merge automaton compiles in a second and
never needs its full states x labels table.

Encoding walks a byte trie of the labels from every reached position of a
pre-split word; among the labels that spell the bytes the automaton leaves
exactly one path.  Decoding emits the bytes of the arc labels.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import python_side
from vaultline.llm.tokens import SPECIAL, TextEncoder, byte_letters, vocabulary_path

_NEVER = 1 << 30
_ARCS = 1 << 17  # filled entries of the arc table kept in a worker


class Automaton:
    """Deterministic automaton over token labels, compiled from a merge list."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        letters = byte_letters()
        as_bytes = lambda label: bytes(letters[c] for c in label)
        self.made: dict[tuple[int, int], int] = {}
        self.chain: dict[int, tuple[tuple[int, int], ...]] = {}
        self.spine: dict[int, tuple[tuple[int, int], ...]] = {}
        self.label: dict[int, bytes] = {}
        for letter in letters:
            if letter in vocabulary:
                self._loop(vocabulary[letter], as_bytes(letter))
        for at, (u, v) in enumerate(merges):
            self._gadget(at, vocabulary[u], vocabulary[v], vocabulary[u + v], as_bytes(u + v))
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, label in self.label.items():
            node = 0
            for byte in label:
                if byte not in self.trie[node]:
                    self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = self.trie[node][byte]
            self.ends[node] = token
        self.length = {token: len(label) for token, label in self.label.items()}
        self.arcs: dict[tuple[int, int], bool] = {}

    def _loop(self, token: int, label: bytes) -> None:
        self.chain[token] = ((token, _NEVER),)
        self.spine[token] = ((token, _NEVER),)
        self.label[token] = label

    def _gadget(self, at: int, u: int, v: int, token: int, label: bytes) -> None:
        """Merge number ``at``: arc ``token`` beside each arc u, to the state of v as it is now."""
        if token in self.label:
            raise ValueError("two merges spell one label")
        if not self._has(u, v):  # the arc v was gone already: this merge never applies
            return
        self.made[u, v] = at
        self.chain[token] = ((token, _NEVER), *((x, min(until, at)) for x, until in self.chain[v]))
        self.spine[token] = ((token, _NEVER), *((x, min(until, at)) for x, until in self.spine[u]))
        self.label[token] = label

    def _has(self, state: int, token: int) -> bool:
        """Is there, after the gadgets so far, an arc ``token`` at the state that label ``state`` leads to?"""
        spine, made = self.spine[token], self.made
        for left, until in self.chain[state]:
            for right, since in spine:
                at = made.get((left, right))
                if at is not None and at < until and at <= since:
                    return False
        return True

    def arc(self, state: int, token: int) -> bool:
        """The arc table; its entries are filled on first use."""
        known = self.arcs.get((state, token))
        if known is None:
            if len(self.arcs) >= _ARCS:
                self.arcs.clear()
            known = self.arcs[state, token] = self._has(state, token)
        return known

    def encode(self, word: bytes) -> list[int]:
        """Labels of the only path that spells ``word``.

        Longest arcs are tried first.  Every prefix has one tokenization, so
        a position that failed once fails always and is not entered again:
        the work is linear in the length of the word.
        """
        size, trie, ends, arc, length = len(word), self.trie, self.ends, self.arc, self.length
        out: list[int] = []
        ways: list[list[int]] = []
        dead: set[int] = set()
        pos = 0
        while pos < size:
            if len(ways) == len(out):  # just arrived: the labels that spell what follows, short to long
                node, found = 0, []
                for at in range(pos, size):
                    node = trie[node].get(word[at])
                    if node is None:
                        break
                    if ends[node] >= 0:
                        found.append(ends[node])
                ways.append(found)
            found = ways[-1]
            while found:
                token = found.pop()
                if pos + length[token] not in dead and (not out or arc(out[-1], token)):
                    out.append(token)
                    pos += length[token]
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary has no label for some byte of the text")
                dead.add(pos)
                ways.pop()
                pos -= length[out.pop()]
        return out


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=2)
def load(path: str) -> Automaton:
    """The automaton of a vocabulary file."""
    model = _read(path)["model"]
    return Automaton(model["vocab"], [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]])


@lru_cache(maxsize=2)
def labels(path: str) -> dict[int, bytes]:
    """What each arc label emits; special tokens emit their own string."""
    spec, letters = _read(path), byte_letters()
    out = {token: bytes(letters[c] for c in label) for label, token in spec["model"]["vocab"].items()}
    return out | {x["id"]: x["content"].encode() for x in spec["added_tokens"]}


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    import regex
    from public_tokenizers import PATTERN

    automaton = load(path)
    split = regex.compile(PATTERN).findall
    special = {x["content"]: x["id"] for x in _read(path)["added_tokens"]}.get(SPECIAL)
    return TextEncoder(lambda word: automaton.encode(word.encode()), split, special)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Add ``ids_col`` (array of int): the ids of the whole text; NULL and empty texts have none.

    All other columns and rows pass unchanged; a column named ``ids_col`` is replaced.
    """
    python_side(df.sparkSession)
    path = vocabulary or vocabulary_path()

    @F.arrow_udf("array<int>")
    def ids_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        whole = encoder(path)
        for texts in parts:
            ids = [whole(x) for x in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]) >> 2
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))

    return df.withColumn(ids_col, ids_of(df[text_col].cast("string")))


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """Add ``text_col``: the arc labels of the ids, read as UTF-8 (invalid bytes become U+FFFD).

    NULL ids give an empty text; special tokens are written out.
    """
    python_side(df.sparkSession)
    path = vocabulary or vocabulary_path()

    @F.arrow_udf("string")
    def text_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        label = labels(path).__getitem__
        for lists in parts:
            ids = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            known = lists.is_valid().to_numpy(zero_copy_only=False)
            texts = [b"".join(map(label, ids[a:b].tolist())) if k else b"" for a, b, k in zip(ends, ends[1:], known)]
            yield pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())

    return df.withColumn(text_col, text_of(df[ids_col]))
