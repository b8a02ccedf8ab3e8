"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import replicate
from ..operators.surrogate import surrogate_key
from ..session import scratch_path, scratch_scope
from .common import WORD, stored, whole_text

# Two levels of so many cells narrow a cut down to about one part in 16 million of a source.
_CELLS = 4096
_KEY = ["src", "no_src"]


def _sized(docs: DataFrame) -> DataFrame:
    """``src`` and ``no_src`` (the source, null-safe), ``size`` in words and its binary order; and
    what tells rows apart: a hash of the ``text``, and the ``place`` among the rows."""
    return docs.withColumns({
        "words_hash": F.xxhash64("text"),
        "place": F.monotonically_increasing_id(),
        "src": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "no_src": F.col("source").isNull(),
        "size": F.regexp_count(whole_text(), F.lit(WORD)).cast("long"),
    }).withColumn("size_class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(0).cast("int"))


def source_targets(classes: DataFrame, ceiling: float = 3.0, share: float = 1.0) -> DataFrame:
    """``src, no_src, source_size, target``: words wanted of each source.

    Sources in code-point order, NULL last, weigh 1, 2, 3, 1, ... and share ``share`` of all words.
    No target exceeds ``ceiling`` times its source's words; what is cut off there is shared again by
    weight among the others until no target is above. A round moves two sums to the driver.
    """
    sizes = classes.groupBy(*_KEY).agg(F.sum("words").alias("source_size"))
    numbered = surrogate_key(sizes, ["no_src", "src"], name="nth", start=0)
    sources = stored(
        numbered.withColumn("weight", (F.pmod("nth", F.lit(3)) + 1).cast("double")), "sources"
    )
    limit = F.lit(ceiling) * F.col("source_size")
    words, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(words or 0) * share
    level, capped = total / weights if weights else 0.0, -1
    while True:
        over = limit < F.lit(level) * F.col("weight")
        now, used, left = sources.agg(
            F.sum(over.cast("long")), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if not now or now == capped or not left:
            break
        capped, level = now, (total - used) / left
    return sources.select(
        *_KEY, "source_size", F.least(limit, F.lit(level) * F.col("weight")).alias("target")
    )


def inclusion(classes: DataFrame, targets: DataFrame, ceiling: float = 3.0) -> DataFrame:
    """For each source and size class: certain ``whole`` copies, and the ``chance`` of one more.

    Wanted copies grow with the binary order of a text's size (longer texts are drawn more readily)
    up to ``ceiling``, scaled so that a source's words meet its target. A source has at most 64
    classes, so its window is small however many documents it has.
    """
    weighed = classes.join(targets, _KEY).withColumn("w", (F.col("size_class") + 1).cast("double"))
    longest = Window.partitionBy(*_KEY).orderBy(F.desc("size_class"))
    above = longest.rowsBetween(Window.unboundedPreceding, -1)
    rest = longest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    scaled = weighed.withColumn(
        "scale",
        F.try_divide(
            F.col("target") - F.lit(ceiling) * F.coalesce(F.sum("words").over(above), F.lit(0)),
            F.sum(F.col("w") * F.col("words")).over(rest),
        ),
    )
    fits = F.col("scale") * F.col("w") <= F.lit(ceiling)
    chosen = F.max(F.when(fits, F.struct("size_class", "scale"))).over(Window.partitionBy(*_KEY))
    wanted = F.coalesce(F.least(F.lit(ceiling), chosen["scale"] * F.col("w")), F.lit(ceiling))
    return (
        scaled.withColumn("wanted", F.greatest(wanted, F.lit(0.0)))
        .withColumn("whole", F.floor(F.col("wanted") + F.lit(1e-9)))
        .select(
            *_KEY, "size_class", "words", "source_size", "target", "whole",
            F.greatest(F.col("wanted") - F.col("whole"), F.lit(0.0)).alias("chance"),
        )
    )


def _ranked(rows: DataFrame, again: DataFrame, seed: int) -> DataFrame:
    """Pareto's ranking variable, mapped from (0, inf) to (0, 1): random odds over inclusion odds.

    The odds follow from id and text. Only rows that ``again`` says agree in both with others, and
    are as good as each other, are told apart by their place.
    """
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("words_hash") == F.col("again_hash"))
    found = rows.join(replicate(again, 32 << 20), same, "left")
    place = F.when(F.col("again_hash").isNotNull(), F.col("place"))
    drawn = F.xxhash64("doc_id", "words_hash", place, F.lit(seed))
    u = (F.shiftrightunsigned(drawn, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = (u / (1 - u)) * (1 - F.col("chance")) / F.col("chance")
    rank = F.when(F.col("chance") > 0, odds / (1 + odds)).otherwise(F.lit(1.0))
    return found.withColumn("rank", rank).drop("again_id", "again_hash")


def _crossing(cells: DataFrame, cell: str) -> DataFrame:
    """The cell in which a source's words, added up in order of rank, pass what is still wanted."""
    order = Window.partitionBy(*_KEY).orderBy(cell)
    before = F.coalesce(
        F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        cells.withColumn("before", before)
        .where((F.col("before") <= F.col("open")) & (F.col("open") < F.col("before") + F.col("words")))
        .select(*_KEY, cell, (F.col("open") - F.col("before")).alias("open"))
    )


def cuts(ranked: DataFrame, classes: DataFrame) -> DataFrame:
    """``src, no_src, cut``: ranks up to the cut are drawn, so that the words meet what is wanted.

    ``ranked`` has a row per document: ``src, no_src, size, rank``. Sums over cells of ranks find
    the cell of the cut, sums over its cells a finer one, and only that one's rows are sorted: no
    task holds a source.
    """
    wanted = classes.groupBy(*_KEY).agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("words"))).alias("open")
    )
    live = ranked.where("rank < 1 AND size > 0").withColumns({
        "coarse": F.floor(F.col("rank") * _CELLS),
        "fine": F.floor(F.col("rank") * (_CELLS * _CELLS)),
    })
    coarse = _crossing(
        live.groupBy(*_KEY, "coarse").agg(F.sum("size").alias("words")).join(wanted, _KEY), "coarse"
    )
    within = live.join(coarse, [*_KEY, "coarse"])
    fine = _crossing(
        within.groupBy(*_KEY, "fine", "open").agg(F.sum("size").alias("words")), "fine"
    )
    rows = live.join(fine, [*_KEY, "fine"])
    order = Window.partitionBy(*_KEY).orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*_KEY, "rank")
    passed, tied = F.sum("size").over(order), F.sum("size").over(same)
    drawn = rows.withColumn("fits", passed - tied / 2 <= F.col("open"))
    # Without a row that fits, the cut lies at the end of the cells before.
    at_least = F.min(F.col("fine") / F.lit(float(_CELLS * _CELLS)))
    cut = drawn.groupBy(*_KEY).agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("rank"))), at_least - F.lit(1e-12)).alias("cut")
    )
    # Where the words wanted are never passed, every row with a chance is drawn.
    return wanted.join(cut, _KEY, "left").select(
        *_KEY,
        F.when(F.col("open") <= 0, F.lit(-1.0)).otherwise(F.coalesce("cut", F.lit(1.0))).alias("cut"),
    )


def mixing_plan(
    docs: DataFrame, seed: int = 0, ceiling: float = 3.0, share: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """The mix as a table, ``src, no_src, size_class, source_size, target, whole, chance, cut``, and
    the ids and text hashes that several rows share.

    The table has a row per source and size class that occurs; documents then draw themselves
    (``mix``).
    """
    slim = stored(
        _sized(docs.select("doc_id", "source", "text"))
        .select("doc_id", "words_hash", "place", *_KEY, "size", "size_class"),
        "sizes",
    )
    again = stored(
        slim.groupBy(F.col("doc_id").alias("again_id"), F.col("words_hash").alias("again_hash"))
        .agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"),
        "again",
    )
    classes = stored(
        slim.groupBy(*_KEY, "size_class").agg(F.sum("size").alias("words")), "classes"
    )
    classes = stored(inclusion(classes, source_targets(classes, ceiling, share), ceiling), "inclusion")
    chances = classes.select(*_KEY, "size_class", "chance")
    ranked = _ranked(slim.join(replicate(chances, 32 << 20), [*_KEY, "size_class"]), again, seed)
    return classes.drop("words").join(cuts(ranked, classes), _KEY), again


def mix(docs: DataFrame, seed: int = 0, ceiling: float = 3.0, share: float = 1.0) -> DataFrame:
    """The columns of ``docs`` and ``size, source_size, target, copies`` (columns of these names are
    replaced).

    A document's size is its words (NULL text: 0); its copies are the certain whole ones of its
    source and size class, and one more for the lowest Pareto ranks of the source, as many as its
    target has words for. Ranks are drawn by a hash of ``doc_id`` and ``text``, so reruns agree; rows
    that agree in both are drawn by their place as well, which in ``docs`` read from files, or made
    from that without a shuffle, is the same each time. Sizes of zero and empty tables give targets
    of zero. The plan is copied to the executors up to 32 MB by measurement; beyond that it joins by
    a shuffle in which adaptive execution splits hot sources. What is stored on the way is deleted,
    but for the plan.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    spark, paths = docs.sparkSession, [scratch_path(docs.sparkSession, name) for name in ("mix", "again")]
    with scratch_scope(spark):
        for rows, path in zip(mixing_plan(docs, seed, ceiling, share), paths):
            rows.write.parquet(path)
    plan, again = (spark.read.parquet(path) for path in paths)
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row")
    sized = _sized(docs.select("doc_id", "source", "text", row))
    ranked = _ranked(sized.join(replicate(plan, 32 << 20), [*_KEY, "size_class"]), again, seed)
    extra = (F.col("chance") > 0) & (F.col("rank") <= F.col("cut")) & (F.col("size") > 0)
    return ranked.select(
        "__row.*", "size", "source_size", "target",
        (F.col("whole") + extra.cast("long")).cast("long").alias("copies"),
    )
