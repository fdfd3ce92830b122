"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Every whole text is measured once.  Texts that pass the base rule become
vectors of transformed statistics.  For each (language, source) Spark
estimates location and scatter by the minimum covariance determinant:
concentration steps that keep the ``SHARE`` of rows with the least distance
and estimate anew from those, until the determinants settle.  Each step is
two map-side aggregations over a narrow table; only the estimates (one row
per group) go through small Python tasks.  A text is rejected when its
Mahalanobis distance from its group's estimate is beyond a chi-squared
quantile.  Groups with few texts are judged by an estimate over all texts of
their language, or, where the language has few, over all texts of the corpus.

Scatter estimates get the square of each statistic's resolution on the
diagonal: differences below it say nothing about quality, so a group whose
rows agree exactly stays regular and does not reject its neighbours.  Exact
copies count once in the estimates.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import content_key, discard, from_row, publish, python_side, shuffle_partitions, whole_row

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Statistic -> resolution (standard deviation added to every estimate).  It bounds the distance of a statistic, so each is
#: small enough for the statistic to reject by itself in a tight group; one repeated line in a text of three stays regular.
RESOLUTION = {"v_length": 0.05, "v_symbols": 0.035, "v_lines": 0.085, "v_repeats": 0.075, "v_capitals": 0.05}
SHARE = 0.6
#: Chance of a regular (normal) text to be rejected.
REJECT = 1e-5
MIN_GROUP = 200
FEWEST = 20
STEPS = 12
SETTLED = 1e-4
_WHITE = b" \t\n\x0b\x0c\r"
_CAPITALS = bytes(range(65, 91))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
RESULTS = (*MEASURES, "base_failed", "distance", "kept")


def measure_text(text: str | None) -> tuple[int, ...]:
    """MEASURES of a text; white space is ASCII only."""
    text = text or ""
    raw = text.encode()
    count = lambda which: len(raw) - len(raw.translate(None, which))
    words = raw.split()
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        again = np.fromiter((times[x] > 1 for x in triples), dtype=bool, count=len(triples))
        covered = np.zeros(len(words), dtype=bool)
        for shift in range(3):
            covered[shift : shift + len(again)] |= again
        repeated = int(covered.sum())
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    return (
        len(words), len(text) - count(_WHITE), count(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), count(_CAPITALS),
    )


def chi_squared(x: float, dimensions: int) -> float:
    """Distribution function, by the power series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    s, z = dimensions / 2, x / 2
    term = total = 1 / s
    k = s
    while term > total * 1e-15:
        k += 1
        term *= z / k
        total += term
    return total * math.exp(-z + s * math.log(z) - math.lgamma(s))


def chi_squared_quantile(share: float, dimensions: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_squared(mid, dimensions) < share else (low, mid)
    return low


def measured(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add ``out``, a struct of MEASURES."""
    python_side(df.sparkSession)

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def stats(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([measure_text(x) for x in texts], columns=list(MEASURES), dtype="int64")

    return df.withColumn(out, stats(df[text_col].cast("string")))


def _vector(stats: str) -> dict[str, Column]:
    """Transformed statistics; defined for texts that have words."""
    s = F.col(stats)
    chars = F.greatest(s.word_chars, F.lit(1)).cast("double")
    return {
        "v_length": F.log(chars / F.greatest(s.n_words, F.lit(1))),
        "v_symbols": F.sqrt(s.n_symbols / chars),
        "v_lines": s.n_dup_lines / F.greatest(s.n_lines, F.lit(1)),
        "v_repeats": s.n_repeat_words / F.greatest(s.n_words, F.lit(1)),
        "v_capitals": F.sqrt(s.n_capitals / chars),
    }


def _distance(center: str = "center", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance, written out."""
    names, d = list(RESOLUTION), len(RESOLUTION)
    off = [F.col(v) - F.col(center)[i] for i, v in enumerate(names)]
    terms = [off[i] * off[j] * F.col(inverse)[i * d + j] * (1 if i == j else 2) for i in range(d) for j in range(i, d)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Rows (g, n, s: sums of statistics, p: sums of products) -> g, center, inverse, logdet."""
    floor = np.diag(np.square(list(RESOLUTION.values())))
    d = len(floor)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            out = []
            for g, n, s, p in zip(rows.g, rows.n, rows.s, rows.p):
                center = np.asarray(s, dtype=float) / n
                scatter = np.zeros((d, d))
                scatter[np.triu_indices(d)] = np.asarray(p, dtype=float) / n
                scatter = np.triu(scatter) + np.triu(scatter, 1).T - np.outer(center, center)
                np.fill_diagonal(scatter, np.maximum(np.diag(scatter), 0))
                whole = factor * scatter + floor
                out.append((g, center.tolist(), np.linalg.inv(whole).ravel().tolist(), float(np.linalg.slogdet(whole)[1])))
            yield pd.DataFrame(out, columns=["g", "center", "inverse", "logdet"])

    few = max(1, shuffle_partitions(sums.sparkSession) // 16)  # one row per group: a Python task takes several partitions
    return sums.coalesce(few).mapInPandas(run, "g string, center array<double>, inverse array<double>, logdet double")


def _sums(rows: DataFrame) -> DataFrame:
    names = list(RESOLUTION)
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in names]).alias("s"), F.array(*products).alias("p")
    )


def minimum_covariance(vectors: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """MCD estimates (g, center, inverse, logdet) of a table with ``g`` and the statistics; all rows take part."""
    names, d = list(RESOLUTION), len(RESOLUTION)
    inner = chi_squared_quantile(share, d)
    factor = share / chi_squared(inner, d + 2)  # consistent for normal data
    # Start: medians and quartile ranges of each statistic.
    quartiles = vectors.groupBy("g").agg(*[F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(v) for v in names])
    spread = [F.pow((F.col(v)[2] - F.col(v)[0]) / 1.349, 2) + RESOLUTION[v] ** 2 for v in names]
    start = quartiles.select(
        "g",
        F.array(*[F.col(v)[1] for v in names]).alias("center"),
        F.array(*[F.lit(1.0) / spread[i] if i == j else F.lit(0.0) for i in range(d) for j in range(d)]).alias("inverse"),
        F.lit(1e9).alias("logdet"),
    )
    now = publish(start, "mcd")
    for _ in range(steps):
        scored = vectors.join(now, "g").withColumn("d2", _distance())
        # Published: a table of one row per group, which Spark broadcasts by its measured size instead of dealing all rows by g.
        bound = publish(scored.groupBy("g").agg(F.percentile_approx("d2", share, 1000).alias("bound")), "bound")
        inside = scored.join(bound, "g").where("d2 <= bound")
        after = publish(_estimates(_sums(inside), factor), "mcd")
        discard(bound)
        moved = after.join(now.select("g", F.col("logdet").alias("was")), "g").agg(F.max(F.abs(F.col("logdet") - F.col("was")))).first()[0]
        discard(now)
        now = after
        if moved is None or moved < SETTLED:
            break
    return now


def judge(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: Sequence[str] | None = None,
    reject: float = REJECT,
    min_group: int = MIN_GROUP,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of ``df`` (columns ``keep``, default all) with MEASURES, ``base_failed``, ``distance`` and ``kept``.

    Base rule: fewer than MIN_WORDS words, or over MAX_REPEAT_PERCENT of them
    in repeated 3-word windows.  NULL and empty texts have no words and fail.
    NULL languages and sources are values of their own.  Where fewer than
    FEWEST texts are left to estimate from, only the base rule decides and
    ``distance`` is NULL.  Repeated rows get equal verdicts.  ``names`` gives
    results other column names; columns with a result's name are replaced,
    other columns pass.
    """
    called = {r: (names or {}).get(r, r) for r in RESULTS}
    kept_columns = [c for c in (df.columns if keep is None else keep) if c not in called.values()]
    vector = list(RESOLUTION)
    a, b = content_key(F.coalesce(df[text_col].cast("string"), F.lit("")))
    lang, source = df[lang_col].cast("string").alias("l"), df[source_col].cast("string").alias("s")
    table = df.select(
        whole_row(kept_columns),
        df[text_col].alias("text"),
        F.to_json(F.struct(lang, source)).alias("fine"),
        F.to_json(F.struct(lang)).alias("lang"),
        a.alias("ka"),
        b.alias("kb"),
    )
    table = measured(table, "text", "stats").drop("text")  # measured twice: cheaper than a copy of all rows
    s = F.col("stats")
    failed = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > MAX_REPEAT_PERCENT * s.n_words)
    vectors = (
        table.where(~failed)
        .select("fine", "lang", "ka", "kb", *[x.alias(n) for n, x in _vector("stats").items()])
        .dropDuplicates(["fine", "ka", "kb"])
    )
    vectors = publish(vectors.drop("ka", "kb"), "vectors")
    sizes = publish(vectors.groupBy("fine", "lang").count(), "sizes")
    spoken = sizes.groupBy("lang").agg(F.sum("count").alias("spoken"))
    alone, enough = F.col("count") >= min_group, F.col("spoken") >= min_group
    g = F.when(alone, F.col("fine")).when(enough, F.col("lang")).otherwise("")
    groups = publish(sizes.join(spoken, "lang").select("fine", "lang", g.alias("g")), "groups")
    # A text takes part in its own group's estimate, and in every wider one that some small group needs.
    needed = groups.select("g").distinct()
    parts = F.array_distinct(F.array("fine", "lang", F.lit("")))
    deals = groups.select("fine", F.explode(parts).alias("g")).join(needed, "g")
    dealt = vectors.drop("lang").join(deals, "fine")
    sized = dealt.groupBy("g").count().where(F.col("count") >= FEWEST).select("g")
    dealt = publish(dealt.join(sized, "g").select("g", *vector), "dealt")
    discard(vectors)
    found = minimum_covariance(dealt)
    estimates = groups.join(found, "g").select("fine", "center", "inverse")
    judged = table.join(estimates, "fine", "left").withColumns(_vector("stats"))
    distance = F.sqrt(_distance())
    cutoff = math.sqrt(chi_squared_quantile(1 - reject, len(vector)))
    return judged.select(
        *from_row(kept_columns),
        *[s[m].alias(called[m]) for m in MEASURES],
        failed.alias(called["base_failed"]),
        distance.alias(called["distance"]),
        (~failed & F.coalesce(distance <= cutoff, F.lit(True))).alias(called["kept"]),
    )
