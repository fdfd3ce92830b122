"""Personal data by bootstrapped contextual extraction.

Seeds are what fixed patterns find in every whole text (e-mail addresses, IP
addresses, card and phone numbers).  Candidates are all other tokens, and
runs of number tokens, that have the shape of some kind's seeds; a word of
letters alone has no kind's shape.  The two words before a span are its
lexical pattern.  Spark scores the graph of patterns and instances in rounds:
a pattern is as reliable, for a kind, as the share of the instances believed
to be of that kind among those and the known negatives (seeds of other kinds,
and candidates that mostly stand after patterns of no such kind); a candidate
is believed as far as the patterns it stands in are reliable; seeds are
certain.  Rounds end when nothing moves any more.  Candidates after patterns
that end reliable, with enough distinct instances behind them, are new spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import cols, content_key, discard, fresh, from_row, publish, python_side, whole_row

KINDS = ("email", "ip", "card", "phone")
ROUNDS = None  # until the scores settle
SETTLED = 1e-3
SUPPORT = 5  # distinct believed instances behind a pattern
RELIABLE = 0.8  # of a pattern that discovers
CONSIDERED = 0.5  # of a pattern that lends belief during the rounds
CONTEXT_CHARS = 80
LONG_INSTANCE = 64  # characters; longer instances are compared by a digest
#: Fewest digits of a candidate for a number kind: half of what its fixed pattern takes.
LEAST_DIGITS = {"ip": 2, "card": 7, "phone": 5}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number's match always ends with its run of digits, so no match starts within a run.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_NUMBER = re.compile(r"[^\w]*[0-9](?:[0-9]|[^\w])*")  # digits and marks
_INNER_MARK = re.compile(r"\w[^\w\s'\u2019]+\w|_")
_LETTER = re.compile(r"[^\W0-9_]")
_ENDS = ".,;:!?"
_MARKS = "\"'`.,;:!?()[]{}<>=#*$%&|"
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Check sum: every second digit from the right counts twice, by its digit sum."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ sign with the run of local characters before it; linear, as runs end at the sign before."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        end = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        free, at = end, text.find("@", end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind; per kind leftmost and not overlapping."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m.groups()):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def shape(instance: str) -> int:
    """Kinds whose seeds have this shape, as bits in the order of KINDS."""
    digits = sum(map(instance.count, "0123456789"))
    fits = sum(1 << i for i, k in enumerate(KINDS) if digits >= LEAST_DIGITS.get(k, len(instance) + 1))
    email = _INNER_MARK.search(instance) and _LETTER.search(instance)
    return fits | (1 << KINDS.index("email") if email else 0)


def _candidates(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens, and runs of number tokens in a line, without the marks around them, apart from ``taken`` spans."""
    i, free, run = 0, 0, None  # run: an open run of number tokens

    def bare(start: int, end: int) -> tuple[int, int]:
        token = text[start:end]
        if "(" in token and ")" in token:
            left, right = _MARKS.replace("(", ""), _MARKS.replace(")", "")
        else:
            left = right = _MARKS
        return start + len(token) - len(token.lstrip(left)), end - len(token) + len(token.rstrip(right))

    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while i < len(taken) and taken[i][2] <= start:
            free = max(free, taken[i][2])
            i += 1
        touched = any(a < end and start < b for _, a, b in taken[i : i + 2 * len(KINDS)])
        number = not touched and _NUMBER.fullmatch(m[0]) is not None
        if run and not (number and text[run[1] : start].isspace() and "\n" not in text[run[1] : start] and text[run[1] - 1] not in _ENDS):
            yield bare(*run)
            run = None
        if number:
            run = (run[0] if run else start, end)
        elif not touched and not m[0].isalpha():
            yield bare(start, end)
    if run:
        yield bare(*run)


def occurrences(text: str | None) -> list[tuple[str | None, int, int, str, str, int]]:
    """(kind or None, start, end, pattern, instance, shape) of base spans and candidates."""
    text = text or ""
    base = base_spans(text)
    out: list[tuple[str | None, int, int, str, str, int]] = []
    for kind, start, end in [*base, *((None, a, b) for a, b in _candidates(text, base))]:
        instance = text[start:end].lower()
        fits = shape(instance) if kind is None else 1 << KINDS.index(kind)
        if not fits:
            continue
        if len(instance) > LONG_INSTANCE:
            instance = hashlib.blake2b(instance.encode(), digest_size=16).hexdigest()
        words = text[max(0, start - CONTEXT_CHARS) : start].lower().split()[-2:]
        out.append((kind, start, end, " ".join(words), instance, fits))
    return out


def extract(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add ``out``: the occurrences of every whole text."""
    python_side(df.sparkSession)
    names = ("kind", "start", "stop", "pattern", "instance", "fits")

    @F.pandas_udf("array<struct<kind: string, start: int, stop: int, pattern: string, instance: string, fits: int>>")
    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[dict(zip(names, x)) for x in occurrences(t)] for t in texts], dtype=object)

    return df.withColumn(out, spans(df[text_col].cast("string")))


def _fits(fits: Column, kind: Column) -> Column:
    out = F.lit(False)
    for i, k in enumerate(KINDS):
        out = out | ((kind == k) & (fits.bitwiseAND(1 << i) > 0))
    return out


def _around(edges: DataFrame, beliefs: DataFrame, degrees: DataFrame) -> DataFrame:
    """(pattern, kind, instance, belief, negative) of every instance of the patterns with enough support for a kind."""
    supported = (
        edges.join(beliefs, "instance")
        .groupBy("pattern", "kind")
        .agg(F.sum((F.col("belief") >= 0.5).cast("int")).alias("support"))
        .where(F.col("support") >= SUPPORT)
    )
    around = edges.join(supported.drop("support"), "pattern").where(_fits(F.col("fits"), F.col("kind")) | (F.col("seeded") > 0))
    held = around.groupBy("instance", "kind").agg(F.count(F.lit(1)).alias("held"))
    of_kind = _fits(F.col("seeded"), F.col("kind"))
    negative = ~of_kind & ((F.col("seeded") > 0) | (2 * F.col("held") < F.col("degree")))
    return (
        around.join(held, ["instance", "kind"]).join(degrees, "instance").join(beliefs, ["instance", "kind"], "left")
        .select("pattern", "kind", "instance", F.coalesce("belief", F.lit(0.0)).alias("belief"), negative.alias("negative"))
    )


def _patterns(around: DataFrame) -> DataFrame:
    """(pattern, kind, reliability)."""
    mass = F.sum(F.when(F.col("negative"), 0.0).otherwise(F.col("belief")))
    against = F.sum(F.col("negative").cast("int"))
    return around.groupBy("pattern", "kind").agg((mass / (mass + against + 1)).alias("reliability"))


def reliable_patterns(occurring: DataFrame, rounds: int | None = ROUNDS) -> DataFrame:
    """(pattern, kind, reliability) of high-confidence patterns; ``occurring`` has kind, pattern, instance, fits.

    Beliefs only grow from round to round, so the scores settle.
    """
    occurring = occurring.where(F.col("pattern") != "")
    marked = F.when(F.col("kind").isNotNull(), F.col("fits")).otherwise(0)
    found = occurring.groupBy("pattern", "instance").agg(F.bit_or("fits").alias("fits"), F.bit_or(marked).alias("own"))
    found = publish(found, "pii-found")
    whole = found.groupBy("instance").agg(F.bit_or("own").alias("seeded"), F.count(F.lit(1)).alias("degree"))
    degrees = publish(whole, "pii-instances")
    edges = publish(found.drop("own").join(degrees.drop("degree"), "instance"), "pii-edges")
    discard(found)
    seeds = degrees.where("seeded > 0").select(
        "instance",
        F.explode(F.filter(F.array(*[F.when(F.col("seeded").bitwiseAND(1 << i) > 0, k) for i, k in enumerate(KINDS)]), lambda x: x.isNotNull())).alias("kind"),
        F.lit(1.0).alias("belief"),
    )
    seeds = publish(seeds, "pii-seeds")
    degrees = degrees.drop("seeded")
    beliefs, before, step = seeds, None, 0
    while True:
        around = publish(_around(edges, beliefs, degrees), "pii-around")
        patterns = publish(_patterns(around), "pii-patterns")
        step += 1
        if before is not None:
            now, was = F.coalesce("reliability", F.lit(0.0)), F.coalesce("was", F.lit(0.0))
            both = patterns.join(before.withColumnRenamed("reliability", "was"), ["pattern", "kind"], "full")
            moved = both.agg(F.max(F.abs(now - was))).first()[0]
            discard(before)
        else:
            moved = patterns.agg(F.max("reliability")).first()[0]
        if not moved or moved < SETTLED or step == rounds:
            break
        before = patterns
        doubt = F.sum(F.log(1 - F.least(F.col("reliability"), F.lit(0.999))))
        lending = patterns.where(F.col("reliability") >= CONSIDERED)
        lent = around.where(~F.col("negative")).join(lending, ["pattern", "kind"]).groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("belief"))
        after = publish(lent.union(seeds).groupBy("instance", "kind").agg(F.max("belief").alias("belief")), "pii-beliefs")
        discard(around, *([beliefs] if beliefs is not seeds else []))
        beliefs = after
    best = patterns.where(F.col("reliability") >= RELIABLE)
    return best.select("pattern", "kind", "reliability")


def _order(kind: Column) -> Column:
    out = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        out = F.when(kind == k, i).otherwise(out)
    return out


def find(
    df: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None, spans: str = "spans", rounds: int | None = ROUNDS
) -> DataFrame:
    """Rows of ``df`` (columns ``keep``, default all) with ``spans``.

    ``spans`` is an array of (start, rank, stop, kind, base) by start, then
    kind as in KINDS; code points, end exclusive; ``base`` tells fixed
    patterns from discovered spans.  NULL and empty texts have none; repeated
    rows have equal spans, and an instance counts once for a pattern however
    often it is repeated.  A column named ``spans`` is replaced; others pass.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c != spans]
    a, b = content_key(F.coalesce(df[text_col].cast("string"), F.lit("")))
    table = df.select(whole_row(kept), df[text_col].alias("text"), a.alias("ka"), b.alias("kb"))
    table = publish(extract(table, "text", "seen").drop("text"), "pii")
    exploded = table.select("ka", "kb", F.inline("seen"))
    accepted = reliable_patterns(exploded.select("kind", "pattern", "instance", "fits"), rounds)
    span = lambda kind, base: F.struct(
        F.col("start").alias("start"), _order(kind).alias("rank"), F.col("stop").alias("stop"), kind.alias("kind"), F.lit(base).alias("base")
    )
    new = (
        exploded.where(F.col("kind").isNull() & (F.col("pattern") != ""))
        .drop("kind")
        .join(accepted, "pattern")
        .where(_fits(F.col("fits"), F.col("kind")))
        .groupBy("ka", "kb", "start", "stop")
        .agg(F.max_by("kind", F.struct("reliability", "kind")).alias("kind"))
        .groupBy("ka", "kb")
        .agg(F.collect_set(span(F.col("kind"), False)).alias("extra"))
    )
    own = F.transform(
        F.filter("seen", lambda x: x.kind.isNotNull()),
        lambda x: F.struct(x.start.alias("start"), _order(x.kind).alias("rank"), x.stop.alias("stop"), x.kind.alias("kind"), F.lit(True).alias("base")),
    )
    none = F.filter(own, lambda x: F.lit(False))
    return table.join(new, ["ka", "kb"], "left").select(
        *from_row(kept), F.sort_array(F.concat(own, F.coalesce("extra", none))).alias(spans)
    )


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.stop.cast("string"))), ",")


def redact_text(text: str | None, spans: Sequence) -> str | None:
    """The text with every span, or run of overlapping spans, as ``<KIND>`` of its first."""
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["stop"])
    return "".join(out) + text[at:]


def redact(df: DataFrame, text_col: str = "text", rounds: int | None = ROUNDS) -> DataFrame:
    """Replace personal data in ``text_col``; all rows and columns stay, texts without any are unchanged."""
    (spans,) = fresh(df, "spans")
    found = find(df, text_col, spans=spans, rounds=rounds)

    @F.pandas_udf("string")
    def clean(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in parts:
            yield pd.Series([redact_text(t, s) for t, s in zip(texts, lists)], dtype=object)

    text = F.when(F.size(spans) > 0, clean(F.col(text_col).cast("string"), F.col(spans))).otherwise(F.col(text_col).cast("string"))
    return found.select(*[text.alias(c) if c == text_col else x for c, x in zip(df.columns, cols(df.columns))])
