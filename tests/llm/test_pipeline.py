import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as cp
from starling.llm.common import stored
from test_exact import expected as exact_expected
from test_jaccard import expected as near_expected
from test_mixing import targets
from test_quality import counts

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def steps(small_batches):
    docs = small_batches.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in cp.STAGES:
        docs = stored(stage(small_batches, docs, SF), name)
        found.append(docs)
    return found


def test_columns(steps):
    assert len({tuple(s.columns) for s in steps[:-1]}) == 1


def test_quality_keeps_good_and_drops_failed(steps, spark):
    before, after = rows_of(steps[0]), rows_of(steps[1])
    assert set(after) <= set(before)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r[0] for r in after}
    for doc_id, text, *_ in before:
        n, *_, repeats = counts(text)
        failed = n < 50 or 100 * repeats > 50 * n
        assert not (failed and doc_id in kept)
        assert failed or doc_id in kept or doc_id not in good


def test_exact(steps):
    want = sorted(i for i, _, _, kept, _ in exact_expected(rows_of(steps[1])) if kept)
    assert sorted(r[0] for r in rows_of(steps[2])) == want


def test_near(steps):
    want = sorted(i for i, _, c in near_expected(rows_of(steps[2]), 5, 80, 100) if i == c)
    assert sorted(r[0] for r in rows_of(steps[3])) == want


def test_mix(steps):
    before, after = rows_of(steps[3]), rows_of(steps[4])
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, _ = targets(before)
    taken = defaultdict(int)
    for _, text, _, source, _ in after:
        taken[source] += words(text)
    longest = max(words(r[1]) for r in before)
    assert all(abs(taken[s] - t) <= longest for s, t in want.items())


def test_pack(steps):
    documents, pieces = Counter(r[0] for r in rows_of(steps[4])), steps[5].collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == documents
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_odd_rows(odd, empty, clashing):
    for docs in (odd, clashing, empty):
        for _, stage in cp.STAGES[:-1]:
            assert stage(docs.sparkSession, docs, SF).columns == docs.columns
        cp.pack(docs.sparkSession, docs, SF).collect()
        assert cp.exact(docs.sparkSession, docs, SF).count() == (7 if docs is not empty else 0)
        assert cp.mixture(docs.sparkSession, docs, SF).count() >= 0
        assert cp.quality(docs.sparkSession, docs, SF).count() == 0


def test_near_copies_that_share_or_lack_ids(small_batches):
    """A text that shares its id with a near copy stays, of near copies without ids one does."""
    words = [f"w{i}" for i in range(80)]
    near = [" ".join([*words[:-1], end]) for end in ("x", "y", "z")]
    other = [" ".join(f"{c}{i}" for i in range(60)) for c in "pq"]
    rows = [(1, near[0]), (7, near[1]), (7, other[0]), (None, near[2]), (None, other[1]),
            (None, other[1] + " more"), (3, None), (3, "")]
    docs = small_batches.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = stored(docs, "docs")
    got = sorted(map(str, rows_of(cp.near(small_batches, docs, SF))))
    assert len(got) == 5
    assert {str((1, near[0])), str((7, other[0])), str((3, None)), str((3, ""))} < set(got)
    assert sum("q59" in row for row in got) == 1
