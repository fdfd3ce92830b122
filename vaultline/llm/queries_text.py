"""Queries of the operators on phrases, ranked search and repeated strings, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import collocations, repeats, search
from vaultline.llm.common import documents, settings


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    return collocations.collocations(documents(spark, sf_dir).select("doc_id", "lang", "text"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), occurrences AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)
), freq AS (
  SELECT lang, m, phrase, count(*) AS f FROM occurrences GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), cand AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE m > 1
), cuts AS (
  SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM cand
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN freq x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN freq y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_at AS (
  SELECT lang, w, m, a, unnest(range(2, m)) AS size FROM cand WHERE m > 2
), inner_phrases AS (
  SELECT lang, a, size, w, unnest(range(1, m - size + 2)) AS i FROM inner_at
), covered AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN covered c USING (lang, phrase)
  WHERE c.longer IS NULL OR 100::HUGEINT * c.longer < 80::HUGEINT * s.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search.search(documents(spark, sf_dir).select("doc_id", "text"), items)


OP12_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), docs AS (
  SELECT d, doc_id, ts, len(ts)::BIGINT AS n FROM words WHERE len(ts) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM docs
), asked AS (
  SELECT row_number() OVER () AS q, item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), query AS (
  SELECT q, item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY ALL
), tf AS (
  SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT d, doc_id, n, unnest(ts) AS term FROM docs)
  WHERE term IN (SELECT term FROM query) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * (SELECT docs FROM totals) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf GROUP BY term
), scored AS (
  SELECT q, item_id, d, doc_id,
         sum(times * w * ((1000000000::BIGINT * tf)
             // (1000 * tf + 12 * (75 + (25 * n * (SELECT docs FROM totals)) // (SELECT length FROM totals)))))::BIGINT AS score
  FROM query JOIN tf USING (term) JOIN weights USING (term) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0
) WHERE rank <= 20
"""


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings(spark)
    left = repeats.drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT r, p, md5(substr(h, (2 * p + 1)::BIGINT, 200)) AS s
  FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM docs WHERE len(h) >= 200)
), again AS (
  SELECT r, p FROM starts QUALIFY row_number() OVER (PARTITION BY s ORDER BY r, p) > 1
), marked AS (
  SELECT r, p, p > coalesce(max(p) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000) + 100 AS new
  FROM again
), numbered AS (
  SELECT r, p, sum(new::INT) OVER (PARTITION BY r ORDER BY p) AS span FROM marked
), spans AS (
  SELECT r, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY r, span
), gaps AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans
), heads AS (
  SELECT r, string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) AS kept,
         max(b) AS last, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans
  FROM gaps JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, (2 * last + 1)::BIGINT), h))) AS kept_sha256
FROM docs LEFT JOIN heads USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op11_collocations": op11_collocations,
    "op12_search": op12_search,
    "op13_repeats": op13_repeats,
}

ORACLE: dict[str, str] = {"op11_collocations": OP11_SQL, "op12_search": OP12_SQL, "op13_repeats": OP13_SQL}
