import numpy as np
import pyarrow as pa

from gleanery.llm import kneser_ney


def test_passes_hand_on_together_and_leave_no_memory(tmp_path, monkeypatch):
    """What a shard's passes hand on goes out as one row for each shard that gets some, not one for each pass, and Arrow gives back what it holds."""
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})
    rng = np.random.default_rng(3)
    words = kneser_ney.Words(str(tmp_path), 1, (0, 500), 0)
    grams = [rng.integers(0, 500, 9_000).astype(np.uint64) for _ in range(3)]
    table = pa.Table.from_batches(list(kneser_ney._dealt(np.zeros(9_000, int), 1, grams, np.ones(9_000, "<u4"))))
    monkeypatch.setattr(kneser_ney, "GRAMS_AT_ONCE", 2_000)
    monkeypatch.setattr(kneser_ney.pa, "default_memory_pool", pool)
    out = kneser_ney._save_grams(words, 3, True, np.array([500], np.uint64))((pa.scalar(0),), table)
    a, total, *seen = kneser_ney._columns(out["blob"], "delta", "delta", *["<i8"] * 5)[2:]
    distinct = len(np.unique(np.stack(grams), axis=1).T)
    assert a.sum() == distinct and total.sum() == 9_000 and sum(s.sum() for s in seen) == distinct
    # In pieces of a pass's size, as one shard gets all here: 5 passes made 5 rows with up to 4,000 pairs each.
    assert max(int(np.frombuffer(b.as_py()[:8], np.int64)[0]) for b in out["blob"]) <= 2_000
    assert released


def test_pairs_that_several_passes_hand_on_come_out_once(tmp_path, monkeypatch):
    """A pair that stands at the start of one pass's n-grams and at the end of another's."""
    words = kneser_ney.Words(str(tmp_path), 4, (0, 50, 50, 50, 50), 0)
    triples = np.array([(x, y, z) for x in range(12) for y in range(12) for z in range(12)], np.uint64)
    table = pa.Table.from_batches(list(kneser_ney._dealt(np.zeros(len(triples), int), 4, list(triples.T), np.ones(len(triples), "<u4"))))
    monkeypatch.setattr(kneser_ney, "GRAMS_AT_ONCE", 400)
    out = kneser_ney._save_grams(words, 3, True, np.array([50], np.uint64))((pa.scalar(0),), table)
    left, right = kneser_ney._columns(out["blob"], "delta", "delta", *["<i8"] * 5)[:2]
    pairs = list(zip(left.tolist(), right.tolist(), strict=True))
    assert len(pairs) == len(set(pairs)) == 144
