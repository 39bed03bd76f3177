import numpy as np
import pyarrow as pa

from gleanery.llm import top_k


def _cell(ids, numbers, floors=None):
    columns = {"q_ids": ids.tobytes(), "q_numbers": numbers.tobytes(), "ids": ids.tobytes(), "numbers": numbers.tobytes(), "floors": floors}
    batch = pa.RecordBatch.from_pylist([{"dim": numbers.shape[1], **columns}])
    hits = pa.Table.from_batches(list(top_k._score(3, top_k.LEVELS)(iter([batch])))).to_pylist()
    found = {}
    for hit in hits:
        found.setdefault(hit["query_id"], []).append((-hit["score"], hit["vec_id"]))
    return found


def _best(ids, numbers):
    scores = numbers @ numbers.T
    return {int(i): sorted((-int(s), int(j)) for s, j in zip(row, ids, strict=True) if i != j)[:3] for i, row in zip(ids, scores, strict=True)}


def test_pairs_that_no_bound_drops_are_multiplied_at_once(monkeypatch):
    """On vectors without structure bounds drop little; then no pair is gathered by itself. Ties and copies go to the smaller id."""
    rng = np.random.default_rng(3)
    numbers = rng.integers(-60, 60, (800, 64))
    numbers[400:420] = numbers[7]
    ids = rng.permutation(800).astype(np.int64)
    gathered = []
    exact = top_k._exact
    monkeypatch.setattr(top_k, "_exact", lambda a, b, spec: gathered.append(b.size // b.shape[-1]) or exact(a, b, spec))
    assert _cell(ids, numbers) == _best(ids, numbers)
    assert sum(gathered) <= 5 * 800
    floors = np.full(800, -(2**63), np.int64)
    assert _cell(ids, numbers, floors.tobytes()) == _best(ids, numbers)


def test_scores_beyond_doubles_stay_exact():
    rng = np.random.default_rng(4)
    numbers = rng.integers(2**27, 2**28, (90, 8))
    ids = np.arange(90, dtype=np.int64)
    assert _cell(ids, numbers) == _best(ids, numbers)
