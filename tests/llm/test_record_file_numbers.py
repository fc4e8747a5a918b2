"""Files are numbered with five digits or more."""

import numpy as np
import pyarrow as pa

from ridewise.llm import token_records as tr


def test_six_digit_file_numbers_are_read_whole():
    names = [f"file:/x/part-9/records/part-{k:05d}.idx" for k in (0, 7, 99_999, 100_000, 1_234_567)]
    idx = np.array([(1, tr.HEADER, 30, 3, 0), (2, tr.HEADER + 30, 30, 3, 3)], dtype=tr.INDEX).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array([idx] * len(names), pa.binary())], names=["path", "content"])
    out = pa.Table.from_batches(tr._ranges(1 << 20)([batch]))
    assert out["file"].to_pylist() == [0, 7, 99_999, 100_000, 1_234_567]
    assert out["name"].to_pylist() == [n[:-4] for n in names]
