"""License scans: canonical digests of entire texts, hash-joined to known licences.  SQL functions only.

Canonical form, applied alike to documents and to the known texts: copyright
lines go; letters are lower-cased; every run of other characters than
letters and digits becomes one space; equivalent spellings become one.  The
digest is the SHA-256 of what is left.  A second result looks at every whole
line in the same way, for the one-line notices that stand inside other texts.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import cols, fresh

#: Equivalent spellings in canonical text, as (Java pattern, replacement); none makes a text longer.
SPELLINGS = (
    (r"\b(sub)?licenc(e|es|ed|ing|ee|ees|or|ors)\b", "$1licens$2"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bper cent\b", "percent"),
    (r"\b(author|organ|recogn|real|util|optim|maxim|initial|categor|capital|emphas)is(e|es|ed|ing|ation|ations)\b", "$1iz$2"),
    (r"\b(behavi|col|fav|hon|lab)our", "$1or"),
    (r"\b(cancel|label|model|signal)l(ed|ing)\b", "$1$2"),
    (r"\b(acknowledg|judg)ement", "$1ment"),
    (r"\bcentre(s?)\b", "center$1"),
    (r"\bwhilst\b", "while"),
    (r"\bprogramme(s?)\b", "program$1"),
    (r"\bcopyright holder(s?)\b", "copyright owner$1"),
    (r"\bhttps\b", "http"),
)
#: A line may be a copyright line if its canonical form (before spellings) starts like this; the SQL takes it as one.
COPYRIGHT_LINE = r"^(copyright|c copyright|portions copyright|c [12][0-9]{3}|[12][0-9]{3} |all rights reserved)"
#: It is one wherever it stands if it starts like this ...
STATEMENT = r"^((portions )?copyright (c\b|[12][0-9]{3}\b)|c copyright|c [12][0-9]{3}|all rights reserved$)"
#: ... and otherwise in the leading notices: before the first line of many words, after a blank line or another copyright line.
PROSE = r"^(\S+ ){8}"
MAX_KNOWN = 10_000  # known texts; they are one literal in the line scan and a broadcast side

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so{condition}

{mit_notice}THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{condition}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Known texts (fixed values): full texts of short licences, one-line notices, and the licences in the folder ``known``.
KNOWN = {
    "MIT": "MIT License\n\n" + _MIT.format(condition=", subject to the following conditions:", mit_notice="The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"),
    "MIT (untitled)": _MIT.format(condition=", subject to the following conditions:", mit_notice="The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"),
    "MIT-0": "MIT No Attribution\n\n" + _MIT.format(condition=".", mit_notice=""),
    "ISC": "ISC License\n\n" + _ISC.format(condition=", provided that the above copyright notice and this permission notice appear in all copies"),
    "0BSD": "BSD Zero Clause License\n\n" + _ISC.format(condition=""),
    "BSD-2-Clause": "BSD 2-Clause License\n\n" + _BSD.format(third=""),
    "BSD-3-Clause": "BSD 3-Clause License\n\n" + _BSD.format(third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"),
    "MIT notice": "Released under the MIT License.",
    "MIT notice (licensed)": "Licensed under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, version 2.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0 notice": "Licensed under CC0 1.0.",
    **{x.stem: x.read_text() for x in sorted(Path(__file__).with_name("known").glob("*.txt"))},
}


def known_table(spark: SparkSession) -> DataFrame:
    """license_id, text of the built-in list."""
    return spark.createDataFrame(list(KNOWN.items()), "license_id string, text string")


def _plain(line: Column) -> Column:
    """Lower case, one space for every run of other characters than letters, digits and line feeds."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}\n]+", " ")


def _spelled(text: Column) -> Column:
    for pattern, replacement in SPELLINGS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def canonical_lines(text: Column) -> Column:
    """Canonical forms of the lines, in order, without copyright lines and blank ones; spellings still differ."""
    lines = F.transform(F.split(_plain(F.coalesce(text, F.lit(""))), "\n", -1), lambda x: F.btrim(x, F.lit(" ")))
    prose = lambda x: x.rlike(PROSE) & ~x.rlike(COPYRIGHT_LINE)
    # Arrays of one element: their lambdas' variables are evaluated once a text.
    whole = F.transform(
        F.array(lines), lambda ls: F.struct(ls.alias("ls"), F.array_position(F.transform(ls, prose), F.lit(True)).alias("prose"))
    )

    def notice(x: Column, i: Column, s: Column) -> Column:
        before = F.coalesce(F.get(s["ls"], i - 1), F.lit(""))
        leading = ((s["prose"] == 0) | (i + 1 < s["prose"])) & ((before == "") | before.rlike(COPYRIGHT_LINE))
        return x.rlike(COPYRIGHT_LINE) & (x.rlike(STATEMENT) | leading)

    return F.transform(whole, lambda s: F.filter(s["ls"], lambda x, i: (x != "") & ~notice(x, i, s)))[0]


def digests_of_known(known: DataFrame) -> list[tuple[str, str, int]]:
    """(license_id, digest, length) of the known texts; ids with one digest: the least id."""
    text = _spelled(F.array_join(canonical_lines(F.col("text")), " "))
    rows = known.select("license_id", F.sha2(text, 256).alias("digest"), F.length(text).alias("n")).where("n > 0")
    rows = rows.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("n").alias("n")).limit(MAX_KNOWN + 1).collect()
    if len(rows) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    return [(r["license_id"], r["digest"], r["n"]) for r in rows]


def scan(df: DataFrame, text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Add ``canonical_sha256``, ``license_id`` (entire text) and ``notices`` (ids of whole lines, sorted, each once).

    ``canonical_sha256`` is NULL for texts without letters or digits (NULL,
    empty, copyright lines only); ``license_id`` is NULL where no known text has the digest;
    ``notices`` is an empty array where no line is a known notice.  Rows and
    other columns pass; columns with the three names are replaced.
    """
    spark = df.sparkSession
    found = digests_of_known(known_table(spark) if known is None else known)
    longest = max((n for _, _, n in found), default=0)
    kept = [c for c in df.columns if c not in ("canonical_sha256", "license_id", "notices")]
    lines, whole, digest, name = fresh(df, "lines", "whole", "digest", "name")
    table = df.select(*cols(kept), canonical_lines(df[text_col].cast("string")).alias(lines))
    table = table.withColumn(whole, _spelled(F.array_join(F.col(lines), " ")))
    table = table.withColumn("canonical_sha256", F.when(F.col(whole) != "", F.sha2(whole, 256)))
    names = spark.createDataFrame([(d, i) for i, d, _ in found], f"`{digest}` string, `{name}` string")
    table = table.join(F.broadcast(names), F.col("canonical_sha256") == F.col(digest), "left")  # at most MAX_KNOWN rows
    if not found:
        return table.select(*cols(kept), "canonical_sha256", F.col(name).alias("license_id"), F.array().cast("array<string>").alias("notices"))
    # A spelling shortens a word by a third at most, so a longer line cannot match.
    short = F.filter(F.col(lines), lambda x: F.length(x) <= 2 * longest)
    line_digests = F.transform(short, lambda x: F.sha2(_spelled(x), 256))
    hits = F.array_intersect(line_digests, F.array(*[F.lit(d) for _, d, _ in found]))
    by_digest = F.create_map(*[F.lit(x) for i, d, _ in found for x in (d, i)])
    return table.select(
        *cols(kept),
        "canonical_sha256",
        F.col(name).alias("license_id"),
        F.sort_array(F.transform(hits, lambda d: F.element_at(by_digest, d))).alias("notices"),
    )


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB SQL: digests of all known texts are computed there, too."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    spelled = lambda x: _nested(x, [(p, r.replace("$", "\\")) for p, r in SPELLINGS], quote)
    values = ",\n  ".join(f"({quote(i)}, {quote(t)})" for i, t in KNOWN.items())
    lines = (
        "list_filter(list_transform(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}\\n]+', ' ', 'g'), chr(10)), "
        f"lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, {quote(COPYRIGHT_LINE)}))"
    )
    return f"""
WITH known AS (
  SELECT min(id) AS id, sha256(c) AS digest, max(length(c)) AS n
  FROM (SELECT id, {spelled("array_to_string(ls, ' ')")} AS c FROM (SELECT id, {lines} AS ls FROM (VALUES
  {values}) AS t(id, text)))
  WHERE c <> '' GROUP BY sha256(c)
), longest AS (
  SELECT max(n) AS longest FROM known
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {lines} AS ls FROM documents
), whole AS (
  SELECT r, doc_id, CASE WHEN length(w) <= 2 * longest AND {spelled("w")} <> '' THEN sha256({spelled("w")}) END AS canonical_sha256
  FROM (SELECT r, doc_id, array_to_string(ls, ' ') AS w FROM docs), longest
), notes AS (
  SELECT r, string_agg(DISTINCT id, ';' ORDER BY id) AS notices
  FROM (SELECT r, unnest(ls) AS line FROM docs) JOIN known ON sha256({spelled("line")}) = digest GROUP BY r
)
SELECT doc_id, canonical_sha256, id AS license_id, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON canonical_sha256 = digest LEFT JOIN notes USING (r)
"""


def _nested(text: str, rules: list[tuple[str, str]], quote) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return text
