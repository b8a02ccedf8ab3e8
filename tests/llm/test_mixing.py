import re
from collections import defaultdict

from pyspark.sql import functions as F

from starling.llm.mixing import mix


def targets(rows):
    """Targets by brute force: share by weight, cut off at three times, share the rest again."""
    sizes = defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in order}, sizes
        capped |= over
        if len(capped) == len(order):
            return {s: 3 * sizes[s] for s in order}, sizes


def taken(df):
    return df.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"),
        F.max("copies").alias("most"), F.first("source_size").alias("size"),
    ).collect()


def test_targets_and_taken(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    want, sizes = targets(corpus)
    longest = max(len((t or "").split()) for _, t, *_ in corpus)
    for r in taken(mix(docs)):
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r["size"] == sizes[r.source]
        assert abs(r.taken - r.target) <= longest
        assert r.most <= 3


def test_same_again_and_other_seed(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    draw = lambda seed, n: sorted(
        (r.doc_id, r.copies) for r in mix(docs.repartition(n), seed).collect())
    assert draw(0, 3) == draw(0, 5)
    assert draw(0, 3) != draw(1, 3)


def test_large_source_is_met_closely(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 97 as int)) as text",
        "case when id % 3 = 0 then 'hot' else concat('s', id % 40) end as source")
    for r in taken(mix(docs)):
        assert abs(r.taken - r.target) <= 97


def test_odd_rows(odd):
    rows = [tuple(r) for r in odd.collect()]
    want, _ = targets(rows)
    got = mix(odd).collect()
    assert len(got) == len(rows)
    assert {r.source: round(r.target, 6) for r in got} == {s: round(t, 6) for s, t in want.items()}
    assert all(0 <= r.copies <= 3 for r in got)


def test_empty_and_clashing(empty, clashing):
    assert mix(empty).count() == 0
    mixed = mix(clashing)
    assert set(clashing.columns) <= set(mixed.columns)
    assert mixed.count() == clashing.count()


def test_rows_without_ids_and_repeated_rows_meet_their_targets(spark):
    """Rows are drawn, not ids: neither shared or missing ids nor equal rows are drawn together."""
    docs = spark.range(0, 3000, 1, 4).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as doc_id",
        "case when id % 2 = 0 then repeat('w ', 30) else repeat(concat('v', id, ' '), 20) end as text",
        "case when id % 5 < 3 then 'hot' when id % 5 = 3 then 'b' end as source")
    found = taken(mix(docs))
    assert len(found) == 3
    for r in found:
        assert abs(r.taken - r.target) <= 30 and r.most <= 3
    rows = lambda: sorted(map(str, mix(docs).collect()))
    assert rows() == rows()


def test_columns_named_as_inside(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    names = ["src", "no_src", "size_class", "place", "words_hash", "rank", "chance", "cut", "again_id", "whole"]
    more = mix(docs.withColumns({n: F.lit("x") for n in names}))
    assert all(set(r[n] for n in names) == {"x"} for r in more.collect())
    assert sorted(r.copies for r in more.collect()) == sorted(r.copies for r in mix(docs).collect())
