import random

import numpy as np
import pytest
import xxhash

from gleanery.llm import simhash

SCHEMA = "doc_id long, text string, fingerprint string, n int, `component_id` long"


def fingerprint(text, width=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """The smallest place that links of at most two bits reach."""
    out = list(range(len(prints)))

    def top(i):
        while out[i] != i:
            i = out[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = top(i), top(j)
                out[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(prints))]


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 7) for i, t in enumerate(texts)], SCHEMA)


def test_fingerprints_and_groups_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"Wörd{n}" if n % 9 == 0 else f"w{n}" for n in range(400)]
    texts = [None, "", " \t\n", "One", "one", "one two", "ONE\x0btwo", "a b a b a b a b", "É È A", "é È a"]
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 40, 300, 1500]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 3])):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
    texts += texts[-5:]
    found = {r["doc_id"]: r for r in simhash.grouped(rows_of(spark, texts)).collect()}
    prints = [fingerprint(t) for t in texts]
    assert [found[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [found[i]["component_id"] for i in range(len(texts))] == components(prints)


@pytest.mark.parametrize("crowded", [1, 3, simhash.CROWDED])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, crowded):
    """One dense ball, pairs that differ in every kind of place, and chains; with few and with many crowded variants."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    prints = {0, 1, 3, (1 << 64) - 1, (1 << 64) - 1 - (1 << 63), centre}
    prints |= {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (120, 2))}
    for base in map(int, rng.integers(0, 1 << 62, 40)):
        a, b, c, d = (1 << int(x) for x in rng.integers(0, 64, 4))
        prints |= {base, base ^ a ^ b, base ^ a ^ b ^ c ^ d}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    pairs = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()
    place = {s: i for i, s in enumerate(signed)}
    assert all(((p["a"] ^ p["b"]) % 2**64).bit_count() <= 2 for p in pairs)
    reached = list(range(len(prints)))
    for p in pairs:
        a, b = reached[place[p["a"]]], reached[place[p["b"]]]
        reached = [min(a, b) if r in (a, b) else r for r in reached]
    assert reached == components(prints)


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    import pyarrow as pa

    texts = [None, "a", " ".join(f"w{i % 13}" for i in range(100)), "x y z", " ".join("ab" for _ in range(50))]
    assert [int(x) for x in simhash.fingerprints(pa.array(texts))] == [fingerprint(t) for t in texts]


def test_null_keys_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "a b c"), (5, "A B C"), (5, "other words here"), (None, "alone and unlike"), (4, "a b c")], "doc_id long, text string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in simhash.grouped(rows).collect()), key=repr)
    assert found == sorted([(None, 4), (5, 4), (5, 5), (None, None), (4, 4)], key=repr)
    assert simhash.grouped(rows.limit(0)).collect() == []


def test_variants_are_not_broadcast(spark, monkeypatch):
    """Spark takes 64 variants of a fingerprint for as small as the fingerprint itself."""
    written = {}
    kept = simhash.materialize

    def spied(df, purpose):
        written[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, purpose)

    monkeypatch.setattr(simhash, "materialize", spied)
    pairs = simhash.links(spark.createDataFrame([(0,), (1,), (3,), (1 << 40,)], "fingerprint long"))
    assert pairs.count() >= 4
    for purpose in ("variants-met", "print-links"):
        assert "Broadcast" not in written[purpose], written[purpose]
