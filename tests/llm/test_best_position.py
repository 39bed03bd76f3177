import math
import random
import re
from collections import Counter

import numpy as np

from gleanery.llm import best_position

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def ranking(docs, items, k):
    """(item, rank, doc, score) by scoring every document."""
    held = [(key, Counter(terms(text))) for key, text in docs if terms(text)]
    if not held:
        return []
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for key, counts in held:
            m = 50 + (50 * sum(counts.values()) * n_docs) // total
            score = 0
            for t in own & set(counts):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(scores)[:k], 1)]
    return out


def fixture():
    rng = random.Random(11)
    words = [f"t{int(1.25**n)}" for n in range(40)] + ["Éa", "日本", "x9"]
    weights = [1 / (n + 1) for n in range(len(words))]
    docs = [(i, ", ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200])))) for i in range(600)]
    docs += [(None, "T1 t2 x9"), (None, None), (900, ""), (901, " .;-"), (3, "t1"), (3, "t1"), (3, "t1"), (950, "x9 " * 3000)]
    docs += [(1000 + i, "same words x9 Éa") for i in range(80)]
    items = [(i, " ".join(rng.sample(words, 8))) for i in range(12)] + [(12, None), (13, "--"), (None, "x9"), (14, "t1"), (14, "T2!"), (15, "unknown"), (16, "x9 x9 éa")]
    return docs, items


def test_equals_scoring_of_every_document(spark, monkeypatch):
    docs, items = fixture()
    left = spark.createDataFrame([(k, t, 1, "s") for k, t in docs], "doc_id long, text string, rank int, item_id string").repartition(3)
    right = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, doc_id int")
    monkeypatch.setattr(best_position, "FRAGMENT_DOCS", 100)
    monkeypatch.setattr(best_position, "BLOCK_BYTES", 100)
    found = [tuple(r) for r in best_position.search(left, right, k=20).collect()]
    assert sorted(found, key=repr) == sorted(ranking(docs, items, 20), key=repr)


def test_stops_before_the_end_of_the_lists():
    """Scored documents are few where some stand out, and no result is lost."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n = 20_000
    lists = [np.unique(np.concatenate([[0, 1, 2], rng.integers(0, 5, rng.integers(1, 3))])) for _ in range(n)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    tf = rng.zipf(1.6, starts[-1]).clip(1, 5000)
    lengths = np.add.reduceat(tf, starts[:-1]) + 50
    fragment = best_position.Fragment(pa.array(np.arange(n)), lengths, starts, np.concatenate(lists), tf, np.array([5, 9, 20, 900, 700]), n, int(lengths.sum()))
    own, slot = np.arange(5), np.full(5, -1, np.int64)
    best = best_position.Best(5)
    scored = fragment.search(own, best, slot)
    totals = np.add.reduceat(fragment.impact, starts[:-1])
    want = sorted(((-int(s), i) for i, s in enumerate(totals)))[:5]
    assert best.rows == [(-s, i) for s, i in want] and (slot == -1).all()
    assert scored < n / 2


def test_terms_in_parts(monkeypatch):
    text = "Ab-cd 12é;" * 20 + "x" * 50 + " tail"
    monkeypatch.setattr(best_position, "TEXT_BYTES", 16)
    found = [t.decode() for part in best_position.terms(text.encode()) for t in part]
    assert found == terms(text)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert best_position.search(docs.limit(0), items).collect() == []
    assert best_position.search(docs, items.limit(0)).collect() == []
    assert best_position.search(docs.where("false").unionByName(spark.createDataFrame([(1, None)], docs.schema)), items).collect() == []
