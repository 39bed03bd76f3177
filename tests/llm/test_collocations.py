import random
import re
from collections import Counter, defaultdict

import pytest

from gleanery.llm import collocations


def mined(rows, least, first):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in kept.items():
            inside = any(len(q) > len(p) and f[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in kept)
            if not inside:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts():
    rng = random.Random(2)
    words = ["der", "die", "Und", "a", "b", "ä", "x1", "(y)", "\x01", "a\x01", "—"]
    rows = []
    for _ in range(300):
        piece = [rng.choice(words) for _ in range(rng.choice([1, 4, 30]))]
        if rng.random() < 0.5:
            piece += "New York City Hall is OPEN now".split()
        rows.append((rng.choice([" ", "  ", "\t"]).join(piece) + rng.choice([".", "!\n", ";a", ""]), rng.choice(["en", "de", None, "und"])))
    rows += [("le soir même", "fr")] * 40 + [("one one one one one one one one", "rep")] * 5
    return rows + [(None, "en"), ("", None), (" .,\n", "en"), ("lone", "fr")]


@pytest.mark.parametrize(("budget", "combined"), [(collocations.BUDGET, collocations.COMBINED), (40, 30), (3, 1000)])
def test_equals_brute_force(spark, monkeypatch, budget, combined):
    """With the whole in one group, with many groups, and with most prefixes above the budget."""
    monkeypatch.setattr(collocations, "COMBINED", combined)
    rows = texts()
    docs = spark.createDataFrame([(t, lang, "x", 1, 2) for t, lang in rows], "text string, lang string, phrase string, n long, score int").repartition(3)
    found = [tuple(r) for r in collocations.collocations(docs, least=5, first=60, budget=budget).collect()]
    assert sorted(found) == mined(rows, 5, 60)


def test_a_long_text_and_no_phrase(spark):
    text = "alpha beta gamma " * 40_000
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    found = [tuple(r) for r in collocations.collocations(docs).collect()]
    assert found == mined([(text, "en")], 100, 2000)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("a b c d", None), (None, None)], docs.schema)).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts whose products pass 64 bits are divided exactly."""
    a, left, right, n = 7_000_000_003, 9_000_000_001, 8_000_000_007, 9_007_199_254_740_993
    counts = spark.createDataFrame([("en", "x", 1, left), ("en", "y", 1, right), ("en", "x y", 2, a)], "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, words long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: (counts, totals))
    (row,) = collocations.collocations(counts).collect()
    assert tuple(row) == ("en", 1, "x y", a, left, right, n, 1000 * a * n // (left * right))
