"""Quality rules: text statistics in Spark SQL and decision lists learned from labelled rows."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_scope
from .common import SPACE, WORD, pinned, stored, whole_text, words_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "mark_share", "distinct_share", "digit_share",
]


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold`` or ``feature > threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _by_hash(windows: Column) -> Column:
    """Windows as pairs of hash and place, sorted, so that equal ones are neighbours."""
    return F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))


def text_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id``, the columns named in ``carry``, COUNTS and FEATURES for every row, no shuffle.

    A NULL text counts as empty and has zeros throughout. Windows of three words are compared by a
    64-bit hash; most texts have no repeated window and skip the sort.
    """
    text = F.col("__text")
    base = docs.select("doc_id", *carry, whole_text().alias("__text"))
    words = base.withColumn("__words", words_of(text))
    n = F.size("__words")
    w = F.col("__words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    worded = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    length = F.length(text)
    without = lambda pattern: length - F.length(F.regexp_replace(text, pattern, ""))
    counted = words.select(
        "doc_id",
        *carry,
        n.cast("long").alias("n_words"),
        without(f"{SPACE}+").alias("__blanks"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        without(r"\p{Lu}+").alias("__upper"),
        without(r"[!?]+").alias("__marks"),
        without(r"[0-9]+").alias("__digits"),
        length.alias("__length"),
        worded.alias("__lines"),
        F.size(F.array_distinct("__words")).alias("__distinct"),
        windows.alias("__windows"),
    ).withColumn("__same", F.size(F.array_distinct("__windows")) < F.size("__windows"))

    keys = F.col("__keys")
    keyed = counted.withColumn("__keys", F.when(F.col("__same"), _by_hash(F.col("__windows"))))
    equal = lambda key, j: F.coalesce(key["hash"] == F.get(keys, j)["hash"], F.lit(False))
    repeated = F.filter(keys, lambda key, j: equal(key, j - 1) | equal(key, j + 1))
    placed = keyed.withColumn("__places", F.transform(repeated, lambda key: key["place"]))
    covered = F.array_distinct(
        F.concat(
            F.col("__places"),
            F.transform("__places", lambda p: p + 1),
            F.transform("__places", lambda p: p + 2),
        )
    )
    lines = F.size("__lines")
    finished = placed.select(
        "doc_id",
        *carry,
        "n_words",
        (F.col("__length") - F.col("__blanks")).cast("long").alias("word_chars"),
        "n_symbols",
        (lines - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        pinned(F.when(F.col("__same"), F.size(covered)).otherwise(0).cast("long")).alias("n_repeat_words"),
        *["__upper", "__marks", "__digits", "__distinct", lines.alias("__n_lines")],
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return finished.select(
        "doc_id",
        *carry,
        *COUNTS,
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "__n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("__upper", "word_chars").alias("upper_share"),
        share("__marks", "word_chars").alias("mark_share"),
        share("__distinct", "n_words").alias("distinct_share"),
        share("__digits", "word_chars").alias("digit_share"),
    )


def base_failed() -> Column:
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    return (n < 50) | (100 * repeat > 50 * n)


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """FOIL's information gain of covering ``after`` (bad, good) out of ``before``."""
    (b0, g0), (b1, g1) = before, after
    if not b1:
        return -math.inf
    return b1 * (math.log2(b1 / (b1 + g1)) - math.log2(b0 / (b0 + g0)))


def _covered(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def _tally(rows: DataFrame) -> tuple[int, int]:
    bad, good = rows.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
    return int(bad or 0), int(good or 0)


def _halfway(values: Iterable[float]) -> list[float]:
    """Thresholds half-way between neighbouring values."""
    ordered = sorted(set(map(float, values)))
    return [(a + b) / 2 for a, b in zip(ordered, ordered[1:])]


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted thresholds lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: value > cut))


def _best_condition(
    rows: DataFrame, thresholds: dict[str, list[float]], now: tuple[int, int]
) -> tuple[Condition | None, tuple[int, int]]:
    """The condition with the highest gain; one aggregation tells the counts of every threshold."""
    pairs = F.array(*[
        F.struct(
            F.lit(i).alias("feature"),
            _bin(F.col(f), cuts).alias("bin"),
        )
        for i, f in enumerate(FEATURES)
        if (cuts := thresholds[f])
    ])
    counts: dict[tuple[int, int], tuple[int, int]] = {
        (feature, bin_): (int(bad), int(good))
        for feature, bin_, bad, good in rows.select("bad", F.explode(pairs).alias("p"))
        .groupBy("p.feature", "p.bin").agg(F.sum("bad"), F.sum(1 - F.col("bad"))).collect()
    }  # at most one row for each feature and threshold
    best, covered, top = None, now, 0.0
    for i, name in enumerate(FEATURES):
        below = (0, 0)
        for j, cut in enumerate(thresholds[name]):
            bad, good = counts.get((i, j), (0, 0))
            below = (below[0] + bad, below[1] + good)
            over = (now[0] - below[0], now[1] - below[1])
            for above, left in ((False, below), (True, over)):
                if (gain := _gain(now, left)) > top + 1e-9:
                    best, covered, top = Condition(name, above, cut), left, gain
    return best, covered


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    max_rules: int = 8,
    max_conditions: int = 4,
    cuts: int = 24,
    precision: float = 0.95,
    least: int = 10,
) -> list[Rule]:
    """Rules that reject a text, learned in order by sequential covering.

    ``labels`` has ``doc_id`` and ``quality`` (0 bad, 1 good; other rows are left out, of repeated
    ids the lowest counts). About ``sample_rows`` labelled documents are drawn by a hash of the id;
    that bound is what keeps the fit, its broadcast ids and its aggregations small, whatever the
    corpus. Two thirds grow a rule, adding the threshold condition with the highest information
    gain until it covers no good row; one third prunes it, cutting trailing conditions while the
    share of bad among covered rows does not fall. A rule stays if it covers ``least`` growing rows
    and reaches ``precision`` on growing and pruning rows alike; the rows it covers then go, and
    the next rule is grown. Without labels, or bad ones, there are no rules.
    """
    with scratch_scope(docs.sparkSession):
        return _learned(docs, labels, sample_rows, max_rules, max_conditions, cuts, precision, least)


def _learned(
    docs: DataFrame, labels: DataFrame, sample_rows: int, max_rules: int, max_conditions: int, cuts: int,
    precision: float, least: int,
) -> list[Rule]:
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        (1 - F.min("quality")).cast("long").alias("bad")
    )
    total = known.count()
    if total == 0:
        return []
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / total))
    # About sample_rows rows of two numbers: bounded by the parameter.
    drawn = F.broadcast(known.where(draw))
    rows = stored(
        text_statistics(docs.select("doc_id", "text").join(drawn, "doc_id"), "bad")
        .where(~base_failed())
        .withColumn("prune", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0)
        .select("bad", "prune", *FEATURES),
        "labelled",
    )
    grow, prune = rows.where("NOT prune"), rows.where("prune")
    shares = [i / cuts for i in range(1, cuts)]
    quantiles = grow.agg(*[F.percentile_approx(f, shares, 1000).alias(f) for f in FEATURES]).first()
    bad_quantiles = grow.where("bad = 1").agg(
        *[F.percentile_approx(f, shares, 1000).alias(f) for f in FEATURES]
    ).first()
    thresholds = {f: _halfway((*(quantiles[f] or []), *(bad_quantiles[f] or []))) for f in FEATURES}
    rules: list[Rule] = []
    for _ in range(max_rules):
        rule: Rule = ()
        left = now = _tally(grow)
        while left[1] and left[0] and len(rule) < max_conditions:
            condition, left = _best_condition(grow.where(_covered(rule)), thresholds, left)
            if condition is None:
                break
            rule += (condition,)
        if not rule:
            break
        sides = [
            F.sum(F.when(_covered(rule[:k]), value))
            for k in range(1, len(rule) + 1)
            for value in (F.col("bad"), 1 - F.col("bad"))
        ]
        tally = [int(v or 0) for v in prune.agg(*sides).first()]
        share = lambda k: (tally[2 * k] - tally[2 * k + 1]) / max(1, tally[2 * k] + tally[2 * k + 1])
        keep = max(range(len(rule)), key=lambda k: (share(k), -k))
        rule = rule[: keep + 1]
        bad, good = _tally(grow.where(_covered(rule)))
        seen = tally[2 * keep], tally[2 * keep + 1]
        if bad < least or bad < precision * (bad + good) or seen[0] < precision * sum(seen):
            break
        rules.append(rule)
        grow, prune = grow.where(~_covered(rule)), prune.where(~_covered(rule))
        if bad == now[0]:
            break
    return rules


def decision(rules: list[Rule]) -> Column:
    """The first rule that covers a row as text, NULL if none does: one CASE expression in order."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(_covered(rule), F.lit(" AND ".join(map(str, rule)))).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, rules: list[Rule], *carry: str) -> DataFrame:
    """``text_statistics`` with ``base_failed``, the ``rule`` that rejects the row, and ``kept``.

    Empty, NULL and very short texts fail the base test. Every row gets a row; an empty table gives
    none. Rows and their order of arrival have no influence on each other.
    """
    return (
        text_statistics(docs, *carry)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", decision(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
