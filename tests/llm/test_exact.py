import hashlib
import re
from collections import defaultdict

import pytest

from starling.llm.exact import exact_duplicates, keep_first


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = ids.index(keep)
        out += [(i, keep, len(ids), n == first, sha) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.drop("row").collect()), key=str)


@pytest.mark.parametrize("fan_in,partitions", [(2, 8), (4, 3), (16, 5)])
def test_odd_rows(odd, fan_in, partitions):
    rows = [tuple(r) for r in odd.collect()]
    assert result(exact_duplicates(odd, fan_in, partitions)) == expected(rows)


def test_one_text_in_all_partitions(small_batches):
    docs = small_batches.range(500).selectExpr("id as doc_id", "'same  text' as text").repartition(16)
    got = exact_duplicates(docs, 4, 16).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 500)}
    assert [r.doc_id for r in got if r.kept] == [0]


def test_more_tasks_than_leaves_read_back_by_several(small_batches):
    """Each row comes out once, though a leaf's digests stand in several partitions."""
    docs = small_batches.range(600).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('text ', id div 2)) as text"
    ).repartition(24)
    rows = [tuple(r) for r in docs.collect()]
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    old = {name: small_batches.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            small_batches.conf.set(name, value)
        assert result(exact_duplicates(docs, 2, 4)) == expected(rows)
    finally:
        for name, value in old.items():
            small_batches.conf.set(name, value)


def test_empty(empty):
    assert exact_duplicates(empty).count() == 0
    assert keep_first(empty).count() == 0


def test_keep_first_keeps_columns(clashing):
    kept = keep_first(clashing)
    assert kept.columns == clashing.columns
    rows = [tuple(r) for r in clashing.collect()]
    want = sorted(str(i) for i, _, _, k, _ in expected(rows) if k)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
