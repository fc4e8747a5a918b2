"""Length-delimited binary records of token ids with a separate offset index.

Data file ``part-NNNNN.rec``:

    header   8 bytes   b"TOKREC1" and the width of an id in bytes (2 or 4)
    record   u64       length of the payload in bytes
             u32       masked checksum of those eight bytes
             payload   i64 document id, then its ids, little-endian
             u32       masked checksum of the payload

Index file ``part-NNNNN.idx``: per record 32 bytes, i64 document id, u64 offset
of the record, u32 record length, u32 ids in it, u64 ids before it in the file.
The checksum is CRC-32, rotated right by 15 bits plus 0xA282EAD8, so that a
checksum of data that holds checksums is not degenerate.

Writing: documents are range-partitioned by id and sorted, so file N holds
smaller ids than file N + 1; only text is shuffled, once. A task writes under
a name of its own and renames at its end, so a repeated or speculative task
replaces a file by the same bytes. Reading: the index files cut the data files
into ranges of bounded size, which tasks read in any order.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridewise.llm.common import keyed, shuffle_partitions
from ridewise.llm.tokens import encoder, load, slices

MAGIC = b"TOKREC1"
HEADER = 8
FRAME = struct.Struct("<QI")
TAIL = struct.Struct("<I")
INDEX = np.dtype([("id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("n", "<u4"), ("before", "<u8")])
MANIFEST = "file int, records long, ids long, first_id long, last_id long"


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store a path names; works inside tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def frame(doc_id: int, ids: np.ndarray, width: int) -> bytes:
    payload = struct.pack("<q", doc_id) + ids.astype(f"<u{width}").tobytes()
    head = struct.pack("<Q", len(payload))
    return head + TAIL.pack(masked_checksum(head)) + payload + TAIL.pack(masked_checksum(payload))


def parse_frames(data: bytes, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Records of a byte range that starts and ends at record borders. Raises
    ``ValueError`` for a wrong checksum or a cut record."""
    at = 0
    while at < len(data):
        if at + FRAME.size > len(data):
            raise ValueError("cut record")
        n, check = FRAME.unpack_from(data, at)
        if check != masked_checksum(data[at:at + 8]):
            raise ValueError("wrong checksum of a length")
        at += FRAME.size
        payload = data[at:at + n]
        if len(payload) < n or at + n + 4 > len(data):
            raise ValueError("cut record")
        if TAIL.unpack_from(data, at + n)[0] != masked_checksum(payload):
            raise ValueError("wrong checksum of a payload")
        at += n + 4
        yield struct.unpack_from("<q", payload)[0], np.frombuffer(payload, dtype=f"<u{width}", offset=8)


def _write(path: str, tokenizer: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        ctx = TaskContext.get()
        part = ctx.partitionId()
        own = f"{root}/_tmp-{part:05d}-{ctx.taskAttemptId()}"
        rec = idx = None
        offset, before, count, first, last = HEADER, 0, 0, None, None
        for b in batches:
            ids_col, text = b.column(0).to_pylist(), b.column(1)
            for lo, hi in slices(text):
                if rec is None:
                    rec, idx = fs.open_output_stream(own + ".rec"), fs.open_output_stream(own + ".idx")
                    rec.write(MAGIC + bytes([width]))
                rows = []
                for i, ids in zip(ids_col[lo:hi], encoder(tokenizer).encode_batch(text[lo:hi], end_id)):
                    data = frame(i, ids, width)
                    rec.write(data)
                    rows.append((i, offset, len(data), len(ids), before))
                    offset, before, count = offset + len(data), before + len(ids), count + 1
                    first, last = i if first is None else first, i
                idx.write(np.array(rows, dtype=INDEX).tobytes())
        if rec is not None:
            rec.close()
            idx.close()
            for end in ("rec", "idx"):
                fs.move(f"{own}.{end}", f"{root}/part-{part:05d}.{end}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([count], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([first], pa.int64()), pa.array([last], pa.int64())],
                names=["file", "records", "ids", "first_id", "last_id"])
    return run


def write_records(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", files: int | None = None) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the files under
    ``path`` (a folder all executors share). Returns the manifest, one row a
    file, with ``start``: ids in all files before it.

    * null or empty text: a record with the end id alone
    * null id: written as the smallest long, so first
    * repeated rows: a record each; empty table: no files
    * very long texts: one record is the largest unit held
    * other columns are not read
    """
    spark = df.sparkSession
    width = 2 if max(load(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    fs, root = file_system(path)
    fs.create_dir(root, recursive=True)
    rows = keyed(df, id_col, text_col)
    n = files or shuffle_partitions(spark)
    dealt = (rows.repartitionByRange(n, "__id", "__rk").sortWithinPartitions("__id", "__rk")
                 .select("__id", "__text"))
    # the write job; its rows are the manifest
    dealt.mapInArrow(_write(path, tokenizer, end_id, width), MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)      # one row a file
    return spark.read.parquet(f"{path}/manifest").withColumn("start", F.coalesce(F.sum("ids").over(w), F.lit(0)))


def part_number(name: str) -> int:
    """The number in ``.../part-<digits>.idx``; from 100,000 files on it has more than five digits."""
    return int(re.search(r"part-(\d+)\.idx$", name).group(1))


def _ranges(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                idx = np.frombuffer(content.as_buffer(), dtype=INDEX)
                cut = np.flatnonzero(np.diff(idx["offset"] // limit, prepend=-1))
                ends = np.r_[cut[1:], len(idx)] - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name[:-4]] * len(cut)), pa.array([part_number(name)] * len(cut), pa.int32()),
                     pa.array(idx["offset"][cut].astype(np.int64)),
                     pa.array((idx["offset"][ends] + idx["length"][ends]).astype(np.int64)),
                     pa.array(idx["before"][cut].astype(np.int64))],
                    names=["name", "file", "lo", "hi", "before"])
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name, file, lo, hi, before in zip(*(b.column(j).to_pylist() for j in range(5))):
            fs, p = file_system(name + ".rec")
            with fs.open_input_file(p) as f:
                head = f.read_at(HEADER, 0)
                if head[:7] != MAGIC:
                    raise ValueError(f"{p} is not a record file")
                data = f.read_at(hi - lo, lo)
            got = list(parse_frames(data, head[7]))
            n = np.array([len(x) for _, x in got], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in got], pa.int64()), pa.array([file] * len(got), pa.int32()),
                 pa.array(before + np.cumsum(n) - n), pa.array(n),
                 pa.array([x.astype("<u4").tobytes() for _, x in got], pa.binary())],
                names=["__id", "file", "before", "n_tokens", "ids"])


def read_records(spark: SparkSession, path: str, range_bytes: int = 4 << 20, shuffle_seed: int | None = None) -> DataFrame:
    """Records back from the files: ``__id, start, n_tokens, ids`` (binary,
    little-endian unsigned 32-bit). Ranges of about ``range_bytes`` are dealt
    out evenly, or in an order drawn from ``shuffle_seed``."""
    idx = (spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(path).select("path", "content"))
    ranges = idx.mapInArrow(_ranges(range_bytes), "name string, file int, lo long, hi long, before long")
    n = shuffle_partitions(spark)
    if shuffle_seed is None:
        ranges = ranges.repartition(n)
    else:
        key = F.xxhash64("name", "lo", F.lit(shuffle_seed))
        ranges = ranges.repartition(n, key).sortWithinPartitions(key)
    rows = ranges.mapInArrow(_read, "__id long, file int, before long, n_tokens long, ids binary")
    starts = read_manifest(spark, path).select("file", "start")
    # the manifest has one row a file
    return rows.join(F.broadcast(starts), "file").select("__id", (F.col("start") + F.col("before")).alias("start"),
                                                         "n_tokens", "ids")
