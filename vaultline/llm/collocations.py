"""Phrase collocations by SON partitioning.

The documents are dealt into a few logical shards, each spread over many
tasks.  Every shard is mined completely, level by level, at the support that
is its share of the global one: a phrase with the global support reaches that
share in one shard at least.  The union of the locally frequent phrases, less
those whose shards' counts add up to too few, is then counted over all documents, by the phrases themselves, and the exact
counts decide.

Locally frequent phrases travel to the tasks as a bitmap of bounded size
(``membership``), which may let others pass but loses none; the exact count
drops those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vaultline.llm.bytehash import BASES, mixed, pieces
from vaultline.llm.common import discard, publish, python_side
from vaultline.llm.membership import bitmap, contains

SUPPORT = 30
LONGEST = 4  # words of a phrase
SHARDS = 4
TOP = 2000
COVERED_PERCENT = 80
UNKNOWN = "und"
_SLICE = 1 << 20  # bytes of text looked at together; a longer piece without punctuation is taken whole
_HELD = 1 << 21  # keys held before they are summed and sent on
_PHRASES = 1 << 20  # distinct phrases held with their text, about 110 bytes each
_TABLE = bytes(
    10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a slice of text and the phrases that start at them."""

    def __init__(self, data: bytes, bases: tuple[int, ...]) -> None:
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        inside = np.concatenate([[False], (raw != 32) & (raw != 10), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(raw == 10)[self.starts]
        self.hashes = [pieces(raw, self.starts, self.ends, base) for base in bases]

    def __len__(self) -> int:
        return len(self.starts)

    def whole(self, length: int) -> np.ndarray:
        """Which words start a phrase of ``length`` words within their piece."""
        n = max(0, len(self) - length + 1)
        return self.piece[:n] == self.piece[len(self) - n :]

    def keys(self, length: int, which: int = 0) -> np.ndarray:
        """A key per phrase of ``length`` words, also where it crosses pieces."""
        n = max(0, len(self) - length + 1)
        words = self.hashes[which]
        out = words[:n]
        for i in range(1, length):
            out = mixed(out * _STEP + words[i : n + i])
        return out ^ np.uint64(length)

    def phrase(self, at: int, length: int) -> str:
        words = (self.data[a:b] for a, b in zip(self.starts[at : at + length], self.ends[at : at + length]))
        return b" ".join(words).decode()


def _slices(texts: list[str | None]) -> Iterator[bytes]:
    """The lower-cased texts with one line feed between pieces and between texts, in slices that end with a piece."""
    held, size = [], 0
    for text in texts:
        if not text:
            continue
        data = text.encode().translate(_TABLE)
        at = 0
        while len(data) - at > _SLICE:
            end = data.rfind(b"\n", at, at + _SLICE)
            end = data.find(b"\n", at + _SLICE) if end < 0 else end
            if end < 0:
                break
            yield data[at : end + 1]
            at = end + 1
        held.append(data[at:])
        size += len(data) - at
        if size >= _SLICE:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _by_group(batch: pa.RecordBatch, columns: list[int]) -> Iterator[tuple[tuple, list[str | None]]]:
    """The texts (last column) of a batch by the values of the given columns."""
    groups: dict[tuple, list[str | None]] = {}
    keys = zip(*(batch.column(i).to_pylist() for i in columns))
    for key, text in zip(keys, batch.column(batch.num_columns - 1).to_pylist()):
        groups.setdefault(key, []).append(text)
    yield from groups.items()


def _mine(source: DataFrame, shards: int, level: Callable[[Words], list[np.ndarray]]) -> DataFrame:
    """(lang, key, by_shard): the phrases that ``level`` selects, with their count in each shard."""
    schema = "shard int, lang string, key long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            for (shard, lang), parts in held.items():
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                for at in range(0, len(keys), 1 << 16):
                    some = keys[at : at + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), shard, np.int32)),
                            pa.DictionaryArray.from_arrays(np.zeros(len(some), np.int32), [lang]).cast(pa.string()),
                            pa.array(some),
                            pa.array(counts[at : at + (1 << 16)].astype(np.int64)),
                        ],
                        names=["shard", "lang", "key", "n"],
                    )

        for batch in batches:
            for key, texts in _by_group(batch, [0, 1]):
                for data in _slices(texts):
                    found = [x for x in level(Words(data, BASES[:1])) if len(x)]
                    if found:
                        held.setdefault(key, []).extend(found)
                        size += sum(map(len, found))
                    if size >= _HELD:
                        yield from send()
                        held, size = {}, 0
        yield from send()

    mined = source.select("shard", "lang", "text").mapInArrow(run, schema)
    each = [F.sum(F.when(F.col("shard") == i, F.col("n")).otherwise(0)) for i in range(shards)]
    return mined.groupBy("lang", "key").agg(F.array(*each).alias("by_shard"))


class _Tally:
    """Counts of phrases of one language and length, by 128-bit key; a phrase's text is built when it is first seen."""

    def __init__(self) -> None:
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # sorted by ``first``
        self.place = np.zeros(0, np.int64)  # in phrases and counts
        self.phrases: list[str] = []
        self.counts = np.zeros(0, np.int64)

    def add(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray, phrase: Callable[[int], str]) -> int:
        """Distinct keys with their counts, sorted by ``first``; ``phrase(i)`` is the i-th one's text.  How many are new."""
        at = np.searchsorted(self.first, first)
        known = np.zeros(len(first), bool)
        inside = at < len(self.first)
        known[inside] = (self.first[at[inside]] == first[inside]) & (self.second[at[inside]] == second[inside])
        np.add.at(self.counts, self.place[at[known]], counts[known])
        new = np.flatnonzero(~known)
        self.place = np.insert(self.place, at[new], np.arange(len(self.phrases), len(self.phrases) + len(new)))
        self.first, self.second = np.insert(self.first, at[new], first[new]), np.insert(self.second, at[new], second[new])
        self.phrases += map(phrase, new.tolist())
        self.counts = np.concatenate([self.counts, counts[new]])
        return len(new)


def _count(source: DataFrame, known: list, longest: int) -> DataFrame:
    """(lang, phrase, words, n): exact counts of all phrases that the bitmaps of the levels let pass."""
    schema = "lang string, phrase string, words int, n long"
    bitmaps = source.sparkSession.sparkContext.broadcast(known)

    def add(tally: _Tally, words: Words, length: int) -> int:
        first = words.keys(length)
        at = np.flatnonzero(words.whole(length) & contains(bitmaps.value[length - 1], first))
        if not len(at):
            return 0
        first, second = first[at], words.keys(length, 1)[at]
        order = np.argsort(first, kind="stable")
        first, second = first[order], second[order]
        new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        places = at[order[new]].tolist()
        return tally.add(first[new], second[new], np.diff(np.append(new, len(at))), lambda i: words.phrase(places[i], length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Tally] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            for (lang, length), tally in held.items():
                n = len(tally.phrases)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.DictionaryArray.from_arrays(np.zeros(n, np.int32), [lang]).cast(pa.string()),
                        pa.array(tally.phrases, pa.string()),
                        pa.array(np.full(n, length, np.int32)),
                        pa.array(tally.counts),
                    ],
                    names=["lang", "phrase", "words", "n"],
                )

        for batch in batches:
            for (lang,), texts in _by_group(batch, [0]):
                for data in _slices(texts):
                    words = Words(data, BASES)
                    for length in range(1, min(longest, len(words)) + 1):
                        size += add(held.setdefault((lang, length), _Tally()), words, length)
            if size >= _PHRASES:
                yield from send()
                held, size = {}, 0
        yield from send()

    counted = source.select("lang", "text").mapInArrow(run, schema)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def frequent_phrases(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with ``support`` occurrences in their language, and the languages' word counts.

    The first table has lang, phrase, words, n (occurrences within pieces,
    overlaps included), the second lang, n.  Both are written tables.
    """
    if support < 1 or longest < 1 or shards < 1:
        raise ValueError("support, longest and shards must be positive")
    python_side(df.sparkSession)
    text = df[text_col].cast("string")
    source = df.select(
        F.coalesce(df[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"),
        text.alias("text"),
        F.pmod(F.xxhash64(*[df[f"`{c}`"] for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]), F.lit(shards)).cast("int").alias("shard"),
    )
    source = source.where(F.col("text").isNotNull())
    spark = df.sparkSession

    words = publish(_mine(source, shards, lambda w: [w.keys(1)]), "words")
    sizes = words.groupBy("lang").agg(*[F.sum(F.col("by_shard")[i]).alias(f"s{i}") for i in range(shards)])
    by_lang = publish(sizes, "sizes")
    total = sum((F.col(f"s{i}") for i in range(1, shards)), F.col("s0"))
    whole = publish(by_lang.select("lang", total.alias("n")), "languages")
    lowered = [F.ceil(F.lit(support).cast("decimal(20,0)") * F.col(f"s{i}") / total).cast("long") for i in range(shards)]
    share = publish(by_lang.select("lang", F.array(*lowered).alias("local")), "local")
    discard(by_lang)

    def frequent(mined: DataFrame) -> np.ndarray:
        """Locally frequent in some shard; of those, whose shards together stay under the support drop out at once."""
        somewhere = F.exists(F.arrays_zip("by_shard", "local"), lambda x: (x.by_shard > 0) & (x.by_shard >= x.local))
        enough = F.aggregate("by_shard", F.lit(0).cast("long"), lambda a, x: a + x) >= support
        held = publish(mined.join(share, "lang").where(somewhere & enough).select("key").distinct(), "frequent")
        bits = bitmap(held, "key")
        discard(held)
        return bits

    known = [frequent(words)]
    discard(words)
    sc = spark.sparkContext

    def level(lengths: list[int], part: int):
        """Phrases whose parts of ``part`` words are all locally frequent somewhere."""
        bits = sc.broadcast(known[part - 1])

        def select(w: Words) -> list[np.ndarray]:
            if len(w) < part:
                return []
            good = contains(bits.value, w.keys(part)) & w.whole(part)
            out = []
            for length in lengths:
                n = len(w) - length + 1
                if n > 0:
                    parts = [good[i : n + i] for i in range(length - part + 1)]
                    out.append(w.keys(length)[reduce(np.logical_and, parts) & w.whole(length)])
            return out

        return select

    if longest >= 2:
        known.append(frequent(_mine(source, shards, level([2], 1))))
    if longest >= 3:
        known += [frequent(_mine(source, shards, level(list(range(3, longest + 1)), 2)))] * (longest - 2)
    counts = _count(source, known, longest).where(F.col("n") >= support)
    phrases = publish(counts, "phrases")
    discard(share)
    return phrases, whole


def _part(first: Column | int, length: Column | int) -> Column:
    """``length`` words of the array ``w`` from place ``first`` (1 based), joined."""
    return F.array_join(F.slice("w", first, length), " ")


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    covered_percent: int = COVERED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``longest`` words with at least ``support``
    occurrences (a).  A cut after k words has score floor(2000000 a / (l + r))
    with l, r the occurrences of its parts; the lowest cut counts, the first
    of equal ones.  A candidate inside a longer candidate with
    ``covered_percent`` of its occurrences is dropped.  n counts the
    language's words.  NULL and empty texts have no words, a NULL language is
    ``und``; every row is a text of its own, repeated ones too; other columns
    are ignored; an empty table gives no row.
    """
    phrases, whole = frequent_phrases(df, text_col, lang_col, support, longest, shards)
    candidates = phrases.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    parts = phrases.select("lang", "phrase", F.col("n"))
    cuts = candidates.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w"
    ).select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = (
        cuts.withColumn("score", score.cast("long"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = (
        candidates.where(F.size("w") > 2)
        .select(
            "lang",
            "a",
            F.explode(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), F.size("w") - 1),
                        lambda m: F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: _part(i, m)),
                    )
                )
            ).alias("phrase"),
        )
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * covered_percent)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(whole, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
