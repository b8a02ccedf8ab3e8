import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starling.llm.lm import LogBilinear, Reader, Shape, Trainer, learn_vocabulary, score_documents, train

SMALL = Shape(known=300, heads=40, endings=12, width=8, noise=8, batch=64)


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def expected(rows):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows}
    counts = Counter(t for i, text, *_ in rows if not held[i] for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text, *_ in rows:
        found = [counts[t] for t in tokens(text)]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in found)
        out.append((i, held[i], len(found), sum(c > 0 for c in found), n, base))
    return out


def check(docs, rows, shape=SMALL):
    got = score_documents(docs, shape=shape).collect()
    key = lambda r: tuple(map(str, r[:5])) + (round(r[5], 6),)
    assert sorted(map(key, got)) == sorted(map(key, expected(rows)))
    return got


def test_counts_base_and_score(small_batches, corpus):
    docs = small_batches.createDataFrame([r[:2] for r in corpus], "doc_id long, text string").repartition(3)
    got = [r for r in check(docs, corpus) if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_odd_rows(odd, empty, clashing):
    for docs in (odd, clashing):
        got = check(docs, [tuple(r) for r in docs.collect()])
        assert all(r.score < 0 for r in got)
    assert score_documents(empty, shape=SMALL).count() == 0


def test_probabilities_add_up(small_batches, corpus):
    docs = small_batches.createDataFrame([r[:2] for r in corpus[:60]], "doc_id long, text string")
    vocabulary = learn_vocabulary(docs, SMALL)
    far, near, normal = train(docs, vocabulary, SMALL).tables()
    for u, w in ((0, 1), (5, 40), (vocabulary.classes, vocabulary.classes), (vocabulary.end, 3)):
        assert np.exp(far[u] + near[w] - normal[u, w]).sum() == pytest.approx(1, abs=1e-4)
    # Within a class, known words, rare words and one unseen word share all of its probability.
    words = Reader(vocabulary)
    counts = dict(zip(vocabulary.words, vocabulary.counts))
    counts.update({r.word.encode(): r.c for r in vocabulary.table.collect()})
    classes = words.classes(words.codes(list(counts)))
    for c in set(classes.tolist()) - set(range(vocabulary.heads)):
        own = [n for n, k in zip(counts.values(), classes) if k == c]
        total = vocabulary.class_counts[c] + 0.1 * (vocabulary.class_words[c] + 1)
        assert (sum(own) + 0.1 * (len(own) + 1)) == pytest.approx(total)


def test_training_learns_what_follows_what():
    draw, shape = np.random.default_rng(0), Shape(width=12, noise=10, batch=256)
    chain = [0]
    for _ in range(40_000):
        chain.append((chain[-1] + 1) % 20 if draw.random() < 0.9 else int(draw.integers(20)))
    seq = np.array(chain, dtype=np.int32)
    events = np.stack([seq[:-2], seq[1:-1], seq[2:]], axis=1)
    counts = np.bincount(seq, minlength=21).astype(float)
    model = LogBilinear.fresh(shape, counts)

    def bits(m):
        far, near, normal = m.tables()
        u, w, x = events.T
        return -(far[u, x] + near[w, x] - normal[u, w]).mean()

    before = bits(model)
    Trainer(model, counts, shape, 0).learn(events)
    assert bits(model) < 0.6 * before
