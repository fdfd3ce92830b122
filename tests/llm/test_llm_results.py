"""Every operator's query against a plain version (or SQL) on the smallest documents."""

import hashlib
import math
import os
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import plain  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from vaultline.llm import fingerprints, simhash  # noqa: E402
from vaultline.llm.components import connected  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def result(spark, name):
    return E.queries()[name](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.mark.parametrize("name", ["op2_line_dedup", "op10_licenses"])
def test_sql(spark, name):
    got = E.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(E.oracle_sql()[name]).df()[list(got.columns)]
    bag = lambda df: Counter(map(repr, df.astype(str).itertuples(index=False, name=None)))
    assert bag(got) == bag(want)


def test_op1(spark, docs):
    got = E.queries()["op1_pack"](spark, SF).toPandas()
    tok = plain.tokenizer()
    want = {}
    for i, t in zip(docs.doc_id, docs.text):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        for p, (a, n) in enumerate(plain.pieces(ids)):
            want[i, p] = (a, n, zlib.crc32(np.asarray(ids[a : a + n], "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    used = plain.check_packing(zip(got.sequence_id, got.offset, got.length))
    assert used <= math.ceil(got.length.sum() / 1024) * 1.05 + 1


def test_op2(spark, docs):
    got = result(spark, "op2_line_dedup")
    want = plain.line_dedup(docs.text.tolist())
    assert [(a, b, hashlib.sha256(c.encode()).hexdigest()) for a, b, c in want] == list(
        got[["n_lines", "n_dropped", "kept_sha256"]].itertuples(index=False, name=None)
    )


def test_op3(spark, docs):
    got = result(spark, "op3_simhash")
    prints = [plain.simhash(t) for t in docs.text]
    assert [f"{x:016x}" for x in prints] == got.fingerprint.tolist()
    roots = plain.groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert [docs.doc_id[r] for r in roots] == got.component_id.tolist()


def test_op3_clump(spark):
    """A dense group of fingerprints, cut into many tiles, joins as by brute force."""
    rng = np.random.default_rng(5)
    members = set()
    for base in rng.integers(0, 2**63, 8, dtype=np.uint64):
        for _ in range(120):
            x = int(base) | 1 << 63
            for bit in rng.integers(0, 64, rng.integers(0, 9)):
                x ^= 1 << int(bit)
            members.add(x)
    members = sorted(members)
    signed = [x - (1 << 64) if x >> 63 else x for x in members]
    roots = plain.groups(members, lambda a, b: (a ^ b).bit_count() <= 4)
    for tile in (4096, 40):
        df = spark.createDataFrame([(x,) for x in signed], "fp long")
        got = dict(connected(simhash.links(df, 4, tile)).collect())
        by_plain, by_spark = {}, {}
        for x, r in zip(signed, roots):
            by_plain.setdefault(r, set()).add(x)
            by_spark.setdefault(got.get(x, x), set()).add(x)
        assert set(map(frozenset, by_plain.values())) == set(map(frozenset, by_spark.values()))


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    rng = np.random.default_rng(0)
    for _ in range(3000):
        flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flipped & m for m in masks)


def shingles(text):
    words = plain.WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_op4(spark, docs):
    got = result(spark, "op4_fingerprints")
    texts = docs.text.tolist()
    after = texts[1:] + texts[:1]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, after)]
    assert [hashlib.sha256(x.encode()).hexdigest() for x in edited] == got.edited_sha256.tolist()
    assert got.n_chars.tolist() == [len(x) for x in texts]
    off = np.abs(got.near_edited - [jaccard(a, b) for a, b in zip(texts, edited)])
    assert off.max() < 0.2 and off.mean() < 0.04
    assert np.abs(got.near_next - [jaccard(a, b) for a, b in zip(texts, after)]).max() < 0.2
    small = [i for i, t in enumerate(texts) if len(shingles(t)) < 60 and len(shingles(edited[i])) < 60]
    assert small and off[small].max() < 1e-9
    by_text = {}
    for t, f in zip(texts, got.fingerprint):
        assert by_text.setdefault(t, f) == f


def test_sketch_merge_and_estimates(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words[:2500])), (1, " ".join(words[2496:])), (2, " ".join(words)), (3, " ".join(words[:1000]))]
    parts = fingerprints.sketches(spark.createDataFrame(rows, "g int, text string"))
    merged = {r.g: r.sketch for r in fingerprints.merge_parts(parts, "g", "sketch").collect()}
    assert merged[1] == merged[2]
    a, b = F.col("a"), F.col("b")
    row = spark.createDataFrame([(merged[2], merged[3])], "a array<bigint>, b array<bigint>").select(
        fingerprints.distinct_shingles(a), fingerprints.containment(b, a), fingerprints.resemblance(a, b)
    ).first()
    assert abs(row[0] - 3996) < 1200 and row[1] > 0.85 and abs(row[2] - 996 / 3996) < 0.15


def test_op5(spark, docs):
    got = result(spark, "op5_shard")
    sizes = [len(t.encode()) + 16 for t in docs.text]
    assert got["size"].tolist() == sizes and got.text_crc32.tolist() == [zlib.crc32(t.encode()) for t in docs.text]
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    by = got.groupby("shard")
    assert set(by.groups) <= set(range(40))
    assert all(sorted(x) == list(range(len(x))) for _, x in by.slot)
    assert by["size"].sum().max() <= sum(sizes) / 40 + max(sizes)


def test_op6(spark, docs):
    got = E.queries()["op6_token_counts"](spark, SF).toPandas()
    tok = plain.tokenizer(special_as_text=True)
    assert Counter(got.n_tokens) == Counter(len(tok.encode(t, add_special_tokens=False).ids) for t in docs.text)
    for _, one in got.sort_values("document").groupby("file"):
        assert one.document.tolist() == list(range(len(one)))
        assert one.start.tolist() == [0, *(one.start + one.n_tokens + 1)[:-1]]


def test_op7(spark, docs):
    got = result(spark, "op7_quality")
    stats, failed, kept = plain.verdicts(list(docs[["text", "lang", "source"]].itertuples(index=False, name=None)))
    assert [s[:5] for s in stats] == list(got[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].itertuples(index=False, name=None))
    assert failed == got.base_failed.tolist() and kept == got.kept.tolist()


def test_op7_labels(spark):
    """Labelled good documents that pass the base rule are kept, bad ones are not."""
    sf = "/root/testdata/sf0.01"
    got = E.queries()["op7_quality"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    good, bad = got[(got.quality == 1) & ~got.base_failed], got[got.quality == 0]
    assert good.kept.all() and not bad.kept.any()


def test_op8(spark, docs):
    got = result(spark, "op8_bpe")
    tok = plain.tokenizer()
    for r, t in zip(got.itertuples(), docs.text):
        ids = tok.encode(t, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op9(spark, docs):
    got = result(spark, "op9_pii")
    for r, t in zip(got.itertuples(), docs.text):
        spans = plain.personal(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        count = Counter(k for k, _, _ in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in ("email", "ip", "card", "phone"))


def test_pipeline(spark, docs):
    got = E.queries()["pipeline"](spark, SF).toPandas()
    now = docs.copy()
    now = now[plain.verdicts(list(now[["text", "lang", "source"]].itertuples(index=False, name=None)))[2]]
    now = now.assign(text=[c for _, _, c in plain.line_dedup(now.text.tolist())]).reset_index(drop=True)
    prints = [plain.simhash(t) for t in now.text]
    roots = plain.groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    now = now[[r == i for i, r in enumerate(roots)]]
    tok = plain.tokenizer()
    want = {}
    for i, t in zip(now.doc_id, now.text):
        out, at = [], 0
        for k, a, b in plain.personal(t):
            if a >= at:
                out += [t[at:a], f"<{k.upper()}>"]
            at = max(at, b)
        ids = [*tok.encode("".join(out) + t[at:], add_special_tokens=False).ids, 2]
        for p, (a, n) in enumerate(plain.pieces(ids)):
            want[i, p] = (a, n, np.asarray(ids[a : a + n], "<u4").tobytes())
    assert {(r.doc_id, r.piece): (r.start, r.length, bytes(r.ids)) for r in got.itertuples()} == want
    plain.check_packing(zip(got.sequence_id, got.offset, got.length))
