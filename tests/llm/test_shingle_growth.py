import numpy as np

from gleanery.llm import shingle_join


def compared(spark, monkeypatch, copies):
    """Pairs of sets that are compared for a group of so many near copies."""
    rng, counts = np.random.default_rng(copies), []
    base, texts = [f"w{i}" for i in range(60)], []
    for i in range(copies):
        t = list(base)
        for k in range(rng.integers(1, 3)):
            t[rng.integers(0, len(t))] = f"v{i}x{k}"
        texts.append((i, " ".join(t)))
    written = shingle_join.materialize

    def counted(df, purpose):
        out = written(df, purpose)
        if purpose in ("join-centres", "join-pairs"):
            counts.append(out.count())
        return out

    with monkeypatch.context() as patch:
        patch.setattr(shingle_join, "materialize", counted)
        shingle_join.grouped(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    return sum(counts)


def test_pairs_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    few, many = compared(spark, monkeypatch, 100), compared(spark, monkeypatch, 500)
    assert 0 < few and many <= 6 * few
