"""A passage at the same place of very many rows must not meet in one cell row by row."""

import numpy as np
import pytest

from assay.llm import repeats
from tests.llm import brute, data


def test_a_header_of_all_rows_is_sent_once_a_batch():
    r = np.random.default_rng(0)
    header, windows = r.integers(1, 1 << 62, 60).astype(np.uint64), repeats.Windows()
    for row in range(1000):
        key = repeats.rolling(np.concatenate([header, r.integers(1, 1 << 62, 20).astype(np.uint64)]), repeats.BLOCK)
        windows.add(row, None, key, key.astype(np.uint32), np.arange(len(key)))
    cell_key, key, owner, at = (np.concatenate(x) for x in zip(*windows.parts))
    sent, found = repeats._met_here(windows, cell_key, key, owner, at)
    inside = at <= 60 - repeats.BLOCK
    assert found[inside].all() and not found[~inside].any() and sent[~inside].all()
    assert np.bincount(at[inside & sent]).tolist() == [1] * (60 - repeats.BLOCK + 1)


@pytest.mark.parametrize("at_once", [10, 2_000_000])
def test_headers_at_any_offset(spark, monkeypatch, at_once):
    """Small batches or one: the rows found are those of a plain search."""
    monkeypatch.setattr(repeats, "WINDOWS_AT_ONCE", at_once)
    header = [f"h{i}" for i in range(40)]
    rows = [(i, " ".join([f"p{i}_{j}" for j in range(i % 9 * (i % 2))] + header[i % 5 :] + [f"x{i}_{j}" for j in range(i % 17)])) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    result = repeats.remove_repeats(frame, bytes_a_cell=2000, bytes_a_group=1500).selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept")
    data.same(result, ["doc_id", "n_words", "n_removed", "kept"], brute.repeats(rows))
