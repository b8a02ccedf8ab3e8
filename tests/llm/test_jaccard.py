import random
import re

import pytest

import numpy as np
from starling.llm.components import components
from starling.llm import components as components_module, jaccard
from starling.operators import joins
from starling.llm.jaccard import (
    _apart_by, grams, jaccard_components, jaccard_links, odd_buckets, one_of_each, parity, similarity_join,
)


def shingles(text, k):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def expected(rows, k, part, whole):
    sets = [shingles(t, k) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = {}
    for i, d in enumerate(ids):
        if d is not None and sets[i]:
            parent[find(i)] = find(by_id.setdefault(d, i))
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            common = len(s & sets[j])
            if whole * common >= part * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            best[r] = min(best.get(r, d), d)
    return sorted(((d, len(sets[i]), best.get(find(i))) for i, d in enumerate(ids)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(seed=5):
    """Groups of altered copies, equal sets in other orders, and a passage that many share."""
    rnd, rows = random.Random(seed), []
    word = lambda: "w%d" % rnd.randrange(3000)
    passage = [word() for _ in range(60)]
    for size in (1, 2, 3, 40, 90):
        original = [word() for _ in range(150)]
        for _ in range(size):
            copy = list(original)
            for _ in range(rnd.randrange(0, 7)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join([word() for _ in range(rnd.randrange(2, 90))] + passage) for _ in range(60)]
    rows += [" ".join([word() for _ in range(rnd.randrange(1, 6))]) for _ in range(40)]
    rows += ["a b c d e a b c d e a b c d e", "b c d e a b c d e a b c d e a b c d e", "A  B c\nd E a b c d e"] * 3
    rnd.shuffle(rows)
    return [(i * 3 - 50, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("k,part", [(4, 85), (5, 80)])
def test_near_copies(small_batches, k, part):
    rows = near_copies()
    docs = small_batches.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jaccard_components(docs, k, part, 100)) == expected(rows, k, part, 100)


def link_counts(rows, k, part, whole):
    sets = [shingles(t, k) for _, t, *_ in rows]
    linked = lambda a, b: bool(a) and whole * len(a & b) >= part * len(a | b)
    return sorted(((r[0], sum(linked(s, o) for j, o in enumerate(sets) if j != i))
                   for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def test_every_link_is_counted(small_batches):
    rows = near_copies()
    docs = small_batches.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_links(docs, 4, 85, 100)
    assert got(found.drop("n_links")) == expected(rows, 4, 85, 100)
    want = link_counts(rows, 4, 85, 100)
    assert got(found.select("doc_id", "n_links")) == want
    sets = {shingles(t, 4) for _, t in rows} - {frozenset()}
    pairs = [(a, b) for a in sets for b in sets if a is not b and 100 * len(a & b) >= 85 * len(a | b)]
    linked = similarity_join(docs, 4, 85, 100)
    assert linked.classes.count() == len(sets)
    assert linked.pairs.count() == linked.pairs.distinct().count() == len(pairs) // 2


def test_links_of_odd_rows(odd, empty, clashing):
    for docs in (odd, clashing):
        rows = [tuple(r) for r in docs.collect()]
        found = jaccard_links(docs, 4, 85, 100)
        assert got(found.drop("n_links")) == expected(rows, 4, 85, 100)
        assert got(found.select("doc_id", "n_links")) == link_counts(rows, 4, 85, 100)
    assert jaccard_links(empty).count() == 0


def test_corpus(small_batches, corpus):
    docs = small_batches.createDataFrame([r[:2] for r in corpus], "doc_id long, text string").repartition(3)
    want = expected(corpus, 4, 85, 100)
    assert got(jaccard_components(docs, 4, 85, 100)) == want
    kept = sorted(r.doc_id for r in one_of_each(docs, 4, 85, 100).collect())
    assert kept == sorted(i for i, _, c in want if i == c)


def test_odd_rows(odd, empty, clashing):
    for docs in (odd, clashing):
        rows = [tuple(r) for r in docs.collect()]
        assert got(jaccard_components(docs, 4, 85, 100)) == expected(rows, 4, 85, 100)
    assert jaccard_components(empty).count() == 0


def test_grams_are_distinct_and_sorted():
    found = grams("a b c d a b c d", 4)
    assert len(found) == 4 and (found[1:] > found[:-1]).all()
    assert len(grams("a b", 4)) == 1 and len(grams(" \n", 4)) == 0
    assert grams("A b", 4)[0] == grams("a  B", 4)[0] != grams("É b", 4)[0]


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(2000 + rnd.randrange(80), 2000 + rnd.randrange(80)) for _ in range(60)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    import sys
    sys.setrecursionlimit(5000)
    assert found == {x: find(x) for x in list(parent) if find(x) != x}


def test_edges_that_are_stars_take_no_round(spark, monkeypatch):
    steps, plain = [], components_module.stored

    def counted(df, label):
        steps.append(label)
        return plain(df, label)

    monkeypatch.setattr(components_module, "stored", counted)
    stars = [(9, 1), (1, 7), (5, 1), (30, 20), (20, 31), (8, 8), (9, 1)]
    found = sorted(tuple(r) for r in components(spark.createDataFrame(stars, "a long, b long")).collect())
    assert found == [(5, 1), (7, 1), (9, 1), (30, 20), (31, 20)] and len(steps) == 1
    found = components(spark.createDataFrame([(3, 2), (2, 1), (6, 5), (6, 4)], "a long, b long")).collect()
    assert sorted(tuple(r) for r in found) == [(2, 1), (3, 1), (5, 4), (6, 4)] and len(steps) > 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("copied", [64 << 20, 100])
def test_pairs_are_measured_once_a_step(small_batches, monkeypatch, copied):
    """What is copied is measured by itself only where the pairs are too many; links are the same."""
    measured, plain = [], joins.held_bytes

    def counted(df):
        measured.append(df.columns)
        return plain(df)

    monkeypatch.setattr(joins, "held_bytes", counted)
    monkeypatch.setattr(jaccard, "held_bytes", counted)
    monkeypatch.setattr(jaccard, "_COPIED_BYTES", copied)
    rows = near_copies()
    docs = small_batches.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jaccard_components(docs, 4, 85, 100)) == expected(rows, 4, 85, 100)
    assert measured.count(["a", "a_digest", "b", "b_digest"]) == 2
    assert (len(measured) == 3) == (copied > 100)


def test_parities_never_rule_out_a_link():
    """They differ in at most as many buckets as there are shingles in one set only."""
    rnd = np.random.default_rng(11)
    for _ in range(300):
        a = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 900), dtype=np.uint64))
        b = np.union1d(rnd.permutation(a)[: rnd.integers(0, len(a) + 1)],
                       rnd.integers(0, 1 << 63, rnd.integers(0, 200), dtype=np.uint64))
        apart = sum(int(x).bit_count() for x in (parity(a) ^ parity(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
    assert parity(np.zeros(0, np.uint64)).tolist() == [0, 0, 0, 0]


@pytest.mark.parametrize("n, m", [(0, 0), (5, 4), (200, 210), (700, 1900), (5000, 4400)])
def test_odd_buckets_never_tell_more_than_sets_differ(n, m):
    rnd = np.random.default_rng(n)
    one = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
    two = np.unique(np.concatenate([one[: m // 2], rnd.integers(0, 1 << 63, m - m // 2, dtype=np.uint64)]))
    differ = len(np.setxor1d(one, two))
    apart = _apart_by(odd_buckets(one), odd_buckets(two))
    assert apart <= differ and (differ - apart) % 2 == 0
    assert apart == _apart_by(odd_buckets(two), odd_buckets(one))
    assert _apart_by(odd_buckets(one), odd_buckets(one)) == 0


def test_whole_sets_of_long_texts_that_are_far_apart_do_not_travel(small_batches, monkeypatch):
    """Texts of 2,000 words that share a passage of rare words, which 256 buckets do not rule out."""
    rnd = random.Random(3)
    word = lambda: "w%d" % rnd.randrange(50_000)
    passage = [word() for _ in range(900)]
    rows = [(i, " ".join(passage + [word() for _ in range(1100)])) for i in range(8)]
    rows.append((8, rows[0][1] + " end"))
    docs = small_batches.createDataFrame(rows, "doc_id long, text string")
    compared, plain = [], jaccard.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    assert got(jaccard_components(docs, 4, 85, 100)) == expected(rows, 4, 85, 100)
    assert sum(compared) == 1
    links = similarity_join(docs, 4, 85, 100).pairs
    assert sorted(tuple(r) for r in links.select("a", "b").collect()) in ([(0, 8)], [(8, 0)])


def flipped(rnd, bits, times):
    for at in rnd.sample(range(256), times):
        bits ^= 1 << at
    return bits


def reaching(spark, parts, before):
    """``_reaching`` of one list, ``parts``: the members' parities by component, the head's first."""
    longs = lambda bits: np.frombuffer(bits.to_bytes(32, "little"), np.int64).tolist()
    rows, heads = [], []
    for label, bits in parts.items():
        heads.append((label, len(bits), *longs(bits[0])))
        for i, b in enumerate(bits):
            off = (b ^ bits[0]).bit_count()
            rows.append((0, 5, 3, before, 200, label + i, bytes([i]), label, *longs(b), off, 33))
    columns = ", ".join(f"parity{i} long" for i in range(4))
    members = spark.createDataFrame(
        rows, f"kind int, token long, place int, before long, n long, doc long, digest binary, label long, {columns}, "
              "off int, band int")
    held = spark.createDataFrame(heads, "label long, held long, " + columns).toDF(
        "label", "held", *[f"parity{i}_head" for i in range(4)])
    found = jaccard._reaching(members, held, jaccard.Threshold(85, 100)).select("a", "label2").collect()
    return {tuple(r) for r in found}


def test_members_meet_only_components_whose_head_is_near_enough(spark):
    """A list of 40 near copies and 40 other texts, some of which are near to a copy, but not to the head."""
    rnd = random.Random(4)
    head = rnd.getrandbits(256)
    parts = {0: [head, *(flipped(rnd, head, rnd.randrange(1, 50)) for _ in range(39))]}
    parts |= {1000 * i: [rnd.getrandbits(256)] for i in range(1, 31)}
    parts |= {1000 * i: [flipped(rnd, parts[0][-i], 20), flipped(rnd, parts[0][-i], 25)] for i in range(31, 40)}
    found = reaching(spark, parts, None)
    near = {
        (low + i, high) for low, one in parts.items() for high, two in parts.items() if low < high
        for i, x in enumerate(one) if any(185 * (x ^ y).bit_count() <= 15 * 400 for y in two)
    }
    assert near and near <= found
    assert all(high > 30_000 for _, high in found)
    assert reaching(spark, parts, 4) == set()
