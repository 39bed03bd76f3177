import numpy as np
import pyarrow as pa

from gleanery.llm import collocations


def test_combined_suffixes_leave_no_memory_with_the_worker(monkeypatch):
    """Each time a task hands suffixes on, Arrow gives back what it holds; rows and counts stay as they are."""
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})
    monkeypatch.setattr(collocations.pa, "default_memory_pool", pool)
    monkeypatch.setattr(collocations, "COMBINED", 64)
    monkeypatch.setattr(collocations, "TEXT_BYTES", 512)
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(30)) for i in range(60)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    every = collocations.Partition(np.full(collocations.FILTER_BITS // 8, 255, np.uint8), np.empty(0, np.uint64), np.zeros(collocations.RANGES, np.int32))
    out = list(collocations._suffixes(every)(iter([batch])))
    assert sum(sum(b.column("n").to_pylist()) for b in out) == 60 * 29
    assert len(released) > 1
