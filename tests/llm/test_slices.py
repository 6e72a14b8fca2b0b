"""Batches in parts, so that what a task makes of them is bounded."""

import pyarrow as pa

from starmart.llm.common import slices


def test_slices_keep_every_row_in_order():
    made = [pa.RecordBatch.from_arrays([pa.array([[i], [i, i]] * n)], names=["x"]) for i, n in ((1, 600), (2, 0), (3, 1))]
    parts = list(slices(iter(made), 512))
    assert [p.num_rows for p in parts] == [512, 512, 176, 2]
    assert [x for p in parts for x in p.column("x").to_pylist()] == [x for b in made for x in b.column("x").to_pylist()]
