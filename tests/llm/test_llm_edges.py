"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from vaultline.llm import (  # noqa: E402
    bpe, fingerprints, licenses, line_dedup, packing, pii, quality, sharding, simhash, token_counts,
)

CLASHING = (
    "row fp ids piece sequence_id kept spans digest sketch node lines key_a ka seen text_ center v_length shard slot size "
    "component_id fingerprint n_lines n_words decoded license_id notices part payload key given head `a.b`"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = "Lorem ipsum " * 8_000 + "x" * 20_000 + "\n" * 1_000 + "4111 1111 1111 1111 a@b.co " * 100
WORDS = " ".join(f"word{i} has some company, number" for i in range(30))


def rows():
    texts = [None, "", " \n\t ", "A", "Same line\n same LINE \nother", LONG, WORDS, WORDS, WORDS + " end", "é日本 😀 <|endoftext|> x"]
    out = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, 1) for i, t in enumerate(texts)]
    out += [(6, WORDS, "en", "s", 1)] * 3  # repeated rows
    out += [(6, "another text of the same id", None, None, None), (None, WORDS, "en", "s", 1), (None, None, None, None, None)]
    return [(*r, *["clash"] * len(CLASHING)) for r in out]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def texts_of(df):
    return [r.text for r in df.select("text").collect()]


def test_pack(odd, empty):
    got = packing.pack(odd).collect()
    tok = plain.tokenizer()
    want = Counter()
    for r in rows():
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.update((r[0], p, a, n) for p, (a, n) in enumerate(plain.pieces(ids)))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    plain.check_packing((r.sequence_id, r.offset, r.length) for r in got)
    assert packing.pack(empty).collect() == []


def test_line_dedup(odd, empty):
    got = line_dedup.drop_repeated_lines(odd, min_documents=3)
    assert set(odd.columns) <= set(got.columns) and got.columns.count("n_lines") == 1
    want = plain.line_dedup([r[1] for r in rows()], threshold=3)
    assert Counter((r.n_lines, r.n_dropped, r.text) for r in got.collect()) == Counter(want)
    assert line_dedup.drop_repeated_lines(empty).collect() == []


def test_simhash(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    prints = [plain.simhash(r[1]) for r in rows()]
    roots = plain.groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, root in zip(rows(), roots):
        if r[0] is not None:
            least[root] = min(r[0], least.get(root, r[0]))
    assert Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got) == Counter(
        (r[0], p, least.get(root)) for r, p, root in zip(rows(), prints, roots)
    )
    assert simhash.near_duplicates(empty).collect() == []


def test_fingerprints(odd, empty):
    got = fingerprints.sketches(odd).collect()
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text or "", r.sketch) == r.sketch
    assert by_text[""] == [] and len(by_text["A"]) == 1 and len(by_text[LONG]) < fingerprints.K
    chained = fingerprints.with_next(odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "key"), "doc_id", ["text"])
    order = sorted([(r[0] is not None, r[0] or 0, r[1] or "") for r in rows()])
    after = order[1:] + order[:1]
    assert Counter((r.text, r.next_text) for r in chained.collect()) == Counter((a[2], b[2]) for a, b in zip(order, after))
    assert fingerprints.with_next(empty.select("doc_id", "text"), "doc_id", ["text"]).collect() == []


def test_sharding(spark, odd, empty):
    got = sharding.kd_shards(odd, 4).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16) for r in rows())
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert sharding.kd_shards(empty, 4).collect() == []
    same = spark.createDataFrame([(1, "same text", "en", "s")] * 1000, "doc_id long, text string, lang string, source string")
    assert Counter(Counter(r.shard for r in sharding.kd_shards(same, 8).collect()).values()) == {125: 8}


def test_token_counts(odd, empty):
    tok = plain.tokenizer(special_as_text=True)
    want = Counter(len(tok.encode(r[1] or "", add_special_tokens=False).ids) for r in rows())
    assert Counter(r.n_tokens for r in token_counts.token_counts(odd).collect()) == want
    assert token_counts.token_counts(empty).collect() == []


def test_blocks_are_stitched(spark, tmp_path):
    texts = [None, "", "one two three", "a" * 3000, "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    token_counts.write_token_files(df, f"{tmp_path}/t")
    with open(tmp_path / "t" / "tail.bin", "wb") as file:
        file.write(bytes.fromhex("0500" "50c4" "0700" "0800"))  # one document and an open one
    whole = token_counts.count_tokens(spark, f"{tmp_path}/t").collect()
    assert [(r.n_tokens, r.terminated) for r in whole if r.file == "tail.bin"] == [(1, True), (2, False)]
    for block in (1, 2, 7):
        assert sorted(token_counts.count_tokens(spark, f"{tmp_path}/t", block_tokens=block).collect()) == sorted(whole)


def test_quality(odd, empty):
    got = quality.judge(odd).collect()
    want = Counter((r[0], *plain.measures(r[1])[:5]) for r in rows())
    assert Counter((r.doc_id, int(r.n_words), r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # too few texts to estimate from
    assert quality.judge(empty).collect() == []


def test_quality_outliers(spark):
    """A few symbol-laden texts are rejected, repeated good ones are not, and a group of copies harms nobody."""
    good = [" ".join(f"{'abcdefgh'[(i + j) % 8] * (1 + (i + j * j) % 7)}{j}" for j in range(80)) for i in range(60)]
    bad = [x.replace(" ", "$$$ ") for x in good[:5]]
    data = [(i, t, "en", "s") for i, t in enumerate(good + bad + [good[0]] * 300)]
    got = quality.judge(spark.createDataFrame(data, "doc_id int, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == set(range(60, 65))


def test_bpe(odd, empty):
    got = bpe.decode(bpe.encode(odd)).collect()
    tok = plain.tokenizer()
    assert all(r.ids == tok.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "") for r in got)
    assert bpe.decode(bpe.encode(empty)).collect() == []
    one = odd.limit(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert bpe.decode(one).first().decoded == ""
    broken = odd.limit(1).select(F.array(F.lit(169)).cast("array<int>").alias("ids"))
    assert bpe.decode(broken).first().decoded == tok.decode([169])


def test_pii(odd, empty):
    got = pii.find(odd).collect()
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.spans if s.base)) for r in got) == Counter(
        (r[0], tuple(plain.personal(r[1]))) for r in rows()
    )
    clean = pii.redact(odd).collect()
    assert [r for r in clean if r.text and "@" in r.text] == [] and Counter(r.doc_id for r in clean) == Counter(r[0] for r in rows())
    assert pii.find(empty).collect() == [] and pii.redact(empty).collect() == []


def test_pii_discovers(spark):
    """Unseen numbers after a context that numbers of one kind stand in are found; others are left alone."""
    data = [(i, f"please call me at +1 ({200 + i}) 555-{1000 + i} today") for i in range(12)]
    data += [(100, "Please call me at 555-867-5309 today"), (101, "order 20190 arrived"), (102, None)]
    got = {r.doc_id: [(s.kind, s.start, s.stop, s.base) for s in r.spans] for r in pii.find(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert got[100] == [("phone", 18, 30, False)] and got[101] == got[102] == [] and got[3][0][3]


def test_licenses(spark, odd, empty):
    assert all(r.license_id is None and r.notices == [] for r in licenses.scan(odd).collect())
    assert licenses.scan(empty).collect() == []
    mit = licenses.KNOWN["MIT"]
    data = [
        (1, "Copyright (c) 2020 Somebody\n" + mit.upper().replace("LICENSE", "LICENCE")),
        (2, mit.replace(",", " ;").replace("copyright holders", "copyright owners")),
        (3, mit + " And more."),
        (4, "Some text.\n  RELEASED under the mit licence!\nMore text.\nReleased under the MIT License."),
        (5, "All rights reserved."),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert [got[i].license_id for i in range(1, 6)] == ["MIT", "MIT", None, None, None]
    assert got[4].notices == ["MIT notice"] and got[5].canonical_sha256 is None


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, odd, empty, name, stage):
    got = stage(spark, odd, "")
    assert got.columns == odd.columns and got.count() <= odd.count()
    assert stage(spark, empty, "").collect() == []


def test_one_of_each_group_stays(spark, odd):
    got = corpus_pipeline.near_dedup(spark, odd, "").collect()
    prints = [plain.simhash(r[1]) for r in rows()]
    roots = plain.groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(got) == len(set(roots))
