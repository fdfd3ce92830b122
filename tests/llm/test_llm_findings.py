"""Cases that an earlier round of the operators lost."""

import textwrap

import pytest

from vaultline.llm import licenses, pii, quality, simhash

DOCS = "doc_id int, text string, lang string, source string"


def regular(i, lines=20):
    """Ten-word lines of a tight group: no symbols, capitals, repeated lines or repeated words."""
    return [" ".join(f"{'abcdefgh'[(i + j + k) % 8] * (2 + (i + j * k) % 5)}{i}x{j}y{k}" for k in range(10)) for j in range(lines)]


def same_words(lines):
    """Three words again and again, in 45 % of the words; no line twice."""
    again = lines[0].split()[:3] * 3
    return [" ".join([*again, x.split()[9]]) for x in lines[:10]] + lines[10:]


def same_lines(lines):
    """Half the lines are one line of two words, which makes no repeated window of three."""
    halves = [" ".join(w) for x in lines for w in (x.split()[:5], x.split()[5:])]
    two = " ".join(regular(99)[0].split()[:2])
    return [two, *(y for x in halves for y in (x, two))]


def many_capitals(lines):
    return [x[:3].upper() + x[3:].replace("x", "X").replace("y", "Y") for x in lines]


SPOILED = {"v_lines": same_lines, "v_repeats": same_words, "v_capitals": many_capitals}


@pytest.mark.parametrize("statistic", SPOILED)
def test_quality_statistic_alone(spark, statistic):
    """In a tight group every statistic rejects by itself."""
    data = [(i, "\n".join(regular(i)), "en", "s") for i in range(60)]
    data.append((60, "\n".join(SPOILED[statistic](regular(60))), "en", "s"))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(data, DOCS)).collect()}
    assert not got[60].base_failed and [i for i, r in got.items() if not r.kept] == [60]


def test_quality_small_groups(spark):
    """A small group is judged by the estimate of its language, or of the corpus, however many copies it has."""
    data = [(i, "\n".join(regular(i)), "en", "s") for i in range(60)]
    junk = ["\n".join(many_capitals(regular(60 + i))) for i in range(5)]
    data += [(60 + i, junk[i % 5], "en", "rare") for i in range(30)] + [(90, junk[0], "xx", "rare"), (91, "\n".join(regular(1)), "xx", "rare")]
    got = quality.judge(spark.createDataFrame(data, DOCS), min_group=50).collect()
    assert {r.doc_id for r in got if not r.kept} == set(range(60, 91)) and all(r.distance is not None for r in got)


def discovered(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [[(x.kind, r.text[x.start : x.stop]) for x in r.spans if not x.base] for r in sorted(pii.find(df).collect())]


def test_pii_layouts(spark):
    """Identifiers of any layout are found after a reliable context."""
    numbers = [f"please call me at +1 ({200 + i}) 555-{1000 + i} today" for i in range(12)]
    cards = [f"the card number {x} expires" for x in ("4111111111111111", "5500005555555559", "340000000000009", "6011000000000004", "30000000000004", "4012888888881881", "5105105105105100")]
    mails = [f"write me at: jane{i}@example.com today" for i in range(12)]
    new = {
        "please call me at (555) 867-5309 today": ("phone", "(555) 867-5309"), "call me at 555 123 4567.": ("phone", "555 123 4567"),
        "call me at 06 12 34 56 78 today": ("phone", "06 12 34 56 78"), "card number 4111 1111 1111 1112 expires": ("card", "4111 1111 1111 1112"),
        "me at: jane@localhost now": ("email", "jane@localhost"), "me at: jane.doe(at)example.com": ("email", "jane.doe(at)example.com"),
    }
    got = discovered(spark, numbers + cards + mails + [*new, "call me at home", "call me at 5"])
    assert got[31:-2] == [[x] for x in new.values()] and got[-2:] == [[], []]


def test_pii_many_unseen(spark):
    """Many unseen identifiers behind a good context do not speak against it; instances of another kind do."""
    seen = [f"call me at +1 ({200 + i}) 555-{1000 + i} today" for i in range(20)]
    new = [f"call me at 555-{200 + i}-{1000 + i} today" for i in range(25)]
    mixed = [f"reach host by +1 ({300 + i}) 555-{1000 + i}" for i in range(6)] + [f"reach host by 10.0.0.{i}" for i in range(6)]
    got = discovered(spark, seen + new + mixed + ["reach host by 555-999-1234"])
    assert got[20:45] == [[("phone", f"555-{200 + i}-{1000 + i}")] for i in range(25)] and got[-1] == []


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


def test_licenses_wrapped(spark):
    """Known texts have one digest at any width, also after a leading notice."""
    ids = ["MIT", "MIT-0", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause"]
    data = [(f"{i} {w}", h + wrapped(licenses.KNOWN[i], w)) for i in ids for w in range(40, 101, 6) for h in ("", "Copyright Some Body\nAll rights reserved.\n\n")]
    got = licenses.scan(spark.createDataFrame(data, "doc_id string, text string")).collect()
    assert [(r.doc_id, r.license_id) for r in got if r.license_id != r.doc_id.split()[0]] == []


def test_licenses_long(spark):
    """Whole texts of long licences are known, and every text has a digest."""
    ids, lined = ["Apache-2.0", "MPL-2.0", "CC0-1.0"], ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"]  # copyright lines inside
    data = [(i, "Copyright 2020 Some Body\n\n" + wrapped(licenses.KNOWN[i], 66).upper()) for i in ids]
    data += [(i, textwrap.indent(licenses.KNOWN[i].upper(), "   ")) for i in lined]
    ids += lined
    data += [("none", "some words " * 50_000)]
    got = licenses.scan(spark.createDataFrame(data, "doc_id string, text string")).collect()
    assert {r.doc_id: r.license_id for r in got} == {**dict.fromkeys(ids), **{i: i for i in ids}, "none": None}
    assert all(r.canonical_sha256 for r in got)


def test_line_digests_are_built_once_a_branch(spark):
    """The optimizer adds no test of the digests' array before it is exploded: that builds every digest a second time."""
    from vaultline.llm.line_dedup import drop_repeated_lines

    df = spark.createDataFrame([(1, "a\nb", "en", "x"), (2, None, "en", "x")], DOCS)
    plan = drop_repeated_lines(df, min_documents=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(transform" not in plan
    assert [tuple(r) for r in drop_repeated_lines(df, min_documents=1).orderBy("doc_id").select("text", "n_lines", "n_dropped").collect()] == [("", 2, 2), ("", 1, 0)]


def test_simhash_long_sides_are_not_broadcast(spark):
    """Each fingerprint is a row per mask, which Spark's estimate leaves out: the join must not trust it."""
    few = spark.range(200).withColumnRenamed("id", "fp")
    plan = simhash.links(few)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
