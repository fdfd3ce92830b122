"""Collocations, ranked search and repeated strings against plain versions, with NULLs, ties, repeats and empty tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vaultline.llm import bytehash, collocations, membership, repeats, search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11


def plain_collocations(rows, support, longest, covered, top):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    found = defaultdict(list)
    frequent = {k: v for k, v in counts.items() if v >= support and len(k[1]) > 1}
    for (lang, p), a in frequent.items():
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = any(
            c == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= covered * a
            for (c, q), b in frequent.items()
        )
        if not inside:
            found[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, l, r, n[lang], -s)
        for lang, rows_ in found.items()
        for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], 1)
    )


def phrase_rows():
    rng = random.Random(3)
    words = ["ab", "Cd", "é", "ef", "日本", "g" * 300, "x y"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", "\n"]) for _ in range(rng.randrange(60)))) for _ in range(60)]
    return rows + [("en", None), (None, None), ("en", ""), ("fr", " . ,"), *[("en", "same words again, same words again")] * 9]


@pytest.mark.parametrize("support,longest,shards", [(4, 4, 4), (2, 2, 3), (9, 3, 1), (12, 1, 2)])
def test_collocations(spark, support, longest, shards):
    rows = phrase_rows()
    df = spark.createDataFrame([(i % 50, *r, 1, "x", 2, "dot") for i, r in enumerate(rows)], "doc_id long, lang string, text string, shard int, phrase string, n long, `a.b` string")
    got = collocations.collocations(df.repartition(3), support=support, longest=longest, shards=shards, top=25).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, support, longest, 80, 25)
    assert collocations.collocations(df.limit(0)).collect() == []


def test_slices_keep_every_piece(monkeypatch):
    monkeypatch.setattr(collocations, "_SLICE", 50)
    texts = ["One two. Three " + "four " * 40 + "! five six, seven", None, "", "z" * 200, "a b\nc d " * 30]
    pieces = lambda parts: Counter(p for x in parts for p in x.split(b"\n") if p.strip())
    want = pieces([t.encode().translate(collocations._TABLE) for t in texts if t])
    assert pieces(collocations._slices(texts)) == want


def test_exact_score_past_64_bits(spark):
    value = spark.sql(
        "SELECT cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(a as decimal(19,0)) + cast(b as decimal(19,0))) AS s "
        "FROM VALUES (9000000000000000000L, 9000000000000000001L) AS t(a, b)"
    ).first().s
    assert value == 2000000 * 9000000000000000000 // (9000000000000000000 + 9000000000000000001)


# --- 12


def plain_search(docs, items, top):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    held = [(i, Counter(w), len(w)) for i, w in ((i, words(t)) for i, t in docs) if w]
    total, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 75 + 25 * n * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i if i is not None else 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def search_rows():
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.5)) % 400}" for _ in range(3000)] + ["É", "日本", "The"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(700)]
    docs += [(9, "the same id"), (9, "the same id"), (None, "the w1 w2"), (None, None), (701, None), (702, ""), (703, "-- !"), (704, "THE the " * 5000)]
    docs += [(i, "copy of one text the w1") for i in range(2000, 2050)]
    items = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(20)]
    return docs, items + [(50, "copy copy text, The"), (51, "nowhere"), (52, None), (53, ""), (54, "the"), (None, "w1")]


@pytest.mark.parametrize("rows,window,short", [(8192, 256, 32), (64, 8, 4), (100, 16, 1000)])
def test_search(spark, monkeypatch, rows, window, short):
    docs, items = search_rows()
    clash = "id string, n long, terms string, query int, item string"
    df = spark.createDataFrame([(*d, "x", 1, "y", 2, "z") for d in docs], f"doc_id long, text string, {clash}")
    asked = spark.createDataFrame([(*i, "x", 1, "y", 2, "z") for i in items], f"item_id long, text string, {clash}")
    want = plain_search(docs, items, 20)
    # The same lists with small blocks and windows, in this process.
    monkeypatch.setattr(search, "BLOCK_ROWS", rows)
    monkeypatch.setattr(search, "WINDOW", window)
    monkeypatch.setattr(search, "SHORT", short)
    got = Counter(map(tuple, search.search(df.repartition(3), asked).collect()))
    assert got == want
    if rows == 64:
        _lists_agree(window, short)


def _lists_agree(window, short):
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 300))
        docs, numbers = np.divmod(np.flatnonzero(rng.random((n, 12)) < rng.random(12) ** 2), 12)
        scores = rng.integers(1, 40, len(docs))
        lists = search.Lists(docs, numbers, scores, n)
        for least in (1, 30):
            query = [(t, int(rng.integers(1, 3))) for t in range(12) if rng.random() < 0.5]
            full = np.zeros(n, np.int64)
            for t, times in query:
                full[docs[numbers == t]] += times * scores[numbers == t]
            best = sorted(((int(s), d) for d, s in enumerate(full) if s >= least), key=lambda x: (-x[0], x[1]))[:5]
            assert lists.best(query, 5, least) == best


def test_search_by_blocks_and_empty_tables(spark, monkeypatch):
    docs, items = search_rows()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(search, "QUERY_BYTES", 100)
    assert Counter(map(tuple, search.search(df, asked, top=3).collect())) == plain_search(docs, items, 3)
    assert search.search(df.limit(0), asked).collect() == []
    assert search.search(df, asked.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "one two"), ("a", "two one"), (None, "one two")], "doc_id string, text string")
    got = search.search(named, spark.createDataFrame([("i", "one")], "item_id string, text string")).collect()
    assert [(r.doc_id, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [("a", 1), ("b", 2), (None, 3)]


# --- 13


def plain_repeats(docs, length):
    seen, out = set(), []
    for i, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((i, len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return Counter(out)


def repeat_rows(length):
    rng = random.Random(length)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.randrange(1, 3 * length))) for _ in range(15)]
    docs = [(i, "".join(rng.choice(pool) + rng.choice(["", "x", "ÿ"]) for _ in range(rng.randrange(6)))) for i in range(50)]
    docs += [(60, "z" * 700), (61, None), (62, ""), (63, "ab" * 300), (64, "z" * 50 + "q" + "z" * 500), (65, pool[0]), (65, pool[0]), (65, pool[0])]
    return [(None, "the first of all " * 20), (None, None)] + docs + [(70, "the first of all " * 9), (71, "a" * (length - 1)), (71, "a" * (length - 1))]


@pytest.mark.parametrize("length", [100, 40, 3, 1])
def test_repeats(spark, length):
    docs = repeat_rows(length)
    df = spark.createDataFrame([(*d, "x", 1, 2, "y") for d in docs], "doc_id long, text string, id string, th long, low int, `a.b` string")
    got = repeats.drop_repeats(df.repartition(3), threshold=length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain_repeats(docs, length)


def test_repeats_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "short"), (2, "short")], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed, bytes(r.kept)) for r in repeats.drop_repeats(df).collect()} == {(1, 0, b"short"), (2, 0, b"short")}
    assert repeats.drop_repeats(df.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "q" + "long text " * 30), ("a", "long text " * 30)], "doc_id string, text string")
    got = {r.doc_id: r.n_removed for r in repeats.drop_repeats(named).collect()}
    want = {i: n for i, _, n, *_ in plain_repeats([("a", "long text " * 30), ("b", "q" + "long text " * 30)], 100)}
    assert got == want


def test_slices_of_long_texts(monkeypatch):
    monkeypatch.setattr(repeats, "_SLICE", 64)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 5, 300, 11, 12, 700)]
    strings = lambda t: Counter((r, i) for r, x in enumerate(t) for i in range(len(x) - 11))
    found, anchors = Counter(), defaultdict(set)
    for rows, starts, froms, buffer in repeats.Slices(iter(texts), 12):
        cut = repeats.Intervals(starts, buffer, 12)
        for low, high, place, part in zip(cut.low.tolist(), cut.high.tolist(), cut.place.tolist(), cut.text.tolist()):
            for p in range(low, high + 1):
                found[rows[part], p - starts[part] + froms[part]] += 1
                anchors[buffer[p : p + 12]].add(place - p)
    assert found == strings(texts)
    assert all(len(x) == 1 for x in anchors.values())  # equal strings have their anchor at equal distances


# --- helpers


def test_bitmap(spark):
    keys = np.random.default_rng(0).integers(-(2**63), 2**63, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long")
    bits = membership.bitmap(df, "k")
    assert membership.contains(bits, keys.view(np.uint64)).all()
    foreign = np.random.default_rng(1).integers(-(2**63), 2**63, 100_000).view(np.uint64)
    assert membership.contains(bits, foreign).mean() < 0.05
    assert not membership.contains(membership.bitmap(df.limit(0), "k"), foreign).any()


def test_hashes_of_equal_pieces():
    data = np.frombuffer(b"abcabcabd" + bytes(70), np.uint8)
    h = bytehash.pieces(data, np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
    w = bytehash.windows(data, 2)
    assert w[0] == w[3] == w[6] != w[1] and len(w) == len(data) - 1


def test_words_are_encoded_once_whatever_stands_beside_them():
    """A word that marks or a line break join to others costs the encoder one call, as a word between spaces does."""
    import regex
    from public_tokenizers import PATTERN

    from vaultline.llm.tokens import TextEncoder

    calls = []
    encode = TextEncoder(lambda word: calls.append(word) or [len(word)], regex.compile(PATTERN).findall, None)
    assert encode("x ab ab.\nCd ab###\nCd\nEf") == encode("x ab ab.\nCd ab###\nCd\nEf")
    assert sorted(calls) == sorted(["x", " ab", ".", "\n", "Cd", "###", "Ef"])
