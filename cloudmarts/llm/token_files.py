"""Token-id files with Elias-Fano document boundaries.

Documents stand in ascending doc_id order over numbered shards.  Shard k is two files in the
output folder, which may be on any store that Spark and Arrow both reach:

- ``tokens-k.ids``: the ids of its documents one after the other, little-endian, two bytes an id
  where the vocabulary allows it, else four;
- ``tokens-k.ef``: a header and two Elias-Fano sequences, the n + 1 boundaries (in ids) and the
  doc_ids (less the smallest).

An Elias-Fano sequence of m values up to u keeps the low ``l = log2(u / m)`` bits of each value
as they are and the rest in unary, as ones in a bit vector of at most 3m bits: value i is
``(select(i) - i) << l | low(i)``.  ``select`` starts at the nearest of the 32-bit marks kept for
every 256th one and reads on from there, so any document's offset costs a few hundred bytes of
reading and no table of 64-bit offsets exists: about ``2 + log2(u / m)`` bits a document.

Rows are ranged by doc_id over shards by Spark; a task writes its shard's files under names of
its own and moves them to their place when they are whole, so a lost executor or a repeated task
leaves the same files.  Reading is split in blocks of documents by ``select``, so a large shard
is read by many tasks.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage
from cloudmarts.llm.token_ids import END_ID, Encoder, default_vocabulary
from cloudmarts.session import scratch_path

MARK = 256           # ones between two marks of a select structure
BLOCK_IDS = 4 << 20  # ids a reading task takes at a time
_TEXT_BYTES = 4 << 20  # text a task encodes at a time
_HEAD = "<4sHHQQqQ"  # magic, version, bytes an id, documents, ids, smallest id, rows without an id
_PART = "<QQBQQQ"  # values, largest, low bits, bytes of low bits, of the bit vector, of the marks
_MAGIC, _VERSION = b"EFTK", 1


# --- Elias-Fano sequences -------------------------------------------------------------------
def ef_encode(values: np.ndarray) -> bytes:
    """An ascending sequence of unsigned numbers as one block of bytes."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    low = b""
    if low_bits:
        shifts = np.arange(low_bits, dtype=np.uint64)
        step = 1 << 16  # a multiple of 8: slices of the low bits end on whole bytes
        low = b"".join(np.packbits(((values[a:a + step, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(),
                                   bitorder="little").tobytes() for a in range(0, n, step))
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little")
    marks = ones[::MARK].astype("<u4").tobytes()
    if n and ones[-1] >= 1 << 32:
        raise ValueError("more documents than one shard can mark")
    return struct.pack(_PART, n, top, low_bits, len(low), len(high), len(marks)) + low + high.tobytes() + marks


class EliasFano:
    """Reads values from a block of ``ef_encode`` through ``read(offset, length) -> bytes``
    without loading the block."""

    def __init__(self, read, at: int = 0):
        self._read = read
        self.n, self.top, self._low_bits, low, high, marks = struct.unpack(_PART, read(at, struct.calcsize(_PART)))
        self._low = at + struct.calcsize(_PART)
        self._high, self._high_bytes = self._low + low, high
        self._marks = self._high + high
        self.end = self._marks + marks

    def select(self, first: int, stop: int) -> np.ndarray:
        """The places in the bit vector of ones number first to stop - 1."""
        mark = first // MARK
        begin = int.from_bytes(self._read(self._marks + 4 * mark, 4), "little")
        if (stop - 1) // MARK + 1 < -(-self.n // MARK):  # the next mark lies behind the last one wanted
            end = int.from_bytes(self._read(self._marks + 4 * ((stop - 1) // MARK + 1), 4), "little")
        else:
            end = self._high_bytes * 8
        bits = np.frombuffer(self._read(self._high + begin // 8, -(-end // 8) - begin // 8), np.uint8)
        ones = np.flatnonzero(np.unpackbits(bits, bitorder="little")) + begin // 8 * 8
        ones = ones[np.searchsorted(ones, begin):]  # ones before the mark share its byte
        return ones[first - mark * MARK:stop - mark * MARK]

    def values(self, first: int, stop: int) -> np.ndarray:
        """Values number first to stop - 1 (uint64)."""
        if not 0 <= first <= stop <= self.n:
            raise IndexError(f"{first}:{stop} of {self.n}")
        if first == stop:
            return np.zeros(0, np.uint64)
        high = (self.select(first, stop) - np.arange(first, stop)).astype(np.uint64)
        if not self._low_bits:
            return high
        bit = first * self._low_bits
        raw = self._read(self._low + bit // 8, -(-stop * self._low_bits // 8) - bit // 8)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[bit % 8:]
        bits = bits[:(stop - first) * self._low_bits].reshape(-1, self._low_bits)
        low = np.zeros(stop - first, np.uint64)
        for k in range(self._low_bits):
            low |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return high << np.uint64(self._low_bits) | low


# --- files ----------------------------------------------------------------------------------
def _open_store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


class Shard:
    """One shard's files, read in place: header, boundaries and any document's ids."""

    def __init__(self, folder: str, name: str):
        store, path = _open_store(folder)
        self._ef = store.open_input_file(f"{path}/{name}.ef")
        self._ids = store.open_input_file(f"{path}/{name}.ids")
        magic, version, self.width, self.n, self.n_ids, self._least, self.n_null = struct.unpack(
            _HEAD, self._at(0, struct.calcsize(_HEAD)))
        if (magic, version) != (_MAGIC, _VERSION):
            raise ValueError(f"{name}.ef is no boundary file of version {_VERSION}")
        self.bounds = EliasFano(self._at, struct.calcsize(_HEAD))
        self._doc_ids = EliasFano(self._at, self.bounds.end)

    def _at(self, offset: int, length: int) -> bytes:
        return self._ef.read_at(length, offset)

    def offsets(self, first: int, stop: int) -> np.ndarray:
        """Where documents first to stop - 1 begin, and where the last of them ends."""
        return self.bounds.values(first, stop + 1).astype(np.int64)

    def doc_ids(self, first: int, stop: int) -> list[int | None]:
        nulls = min(stop, self.n_null) - min(first, self.n_null)
        known = self._doc_ids.values(max(0, first - self.n_null), max(0, stop - self.n_null))
        return [None] * nulls + [self._least + int(v) for v in known]

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids number begin to end - 1 of the shard."""
        raw = self._ids.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        begin, end = self.offsets(i, i + 1)
        return self.ids(int(begin), int(end))

    def first_ending_after(self, ids: int) -> int:
        """The first document whose end lies beyond ``ids`` (the number of documents if none
        does): a binary search through ``select``."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if int(self.bounds.values(middle + 1, middle + 2)[0]) > ids:
                high = middle
            else:
                low = middle + 1
        return low

    def close(self) -> None:
        self._ef.close()
        self._ids.close()


def _shard_name(part: int) -> str:
    return f"tokens-{part:05d}"


def shard_starts(keys: DataFrame, n: int) -> list[tuple]:
    """The smallest key of each of ``n`` ranges of rows but the first: at most n - 1 of them."""
    columns = keys.columns
    ranged = keys.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *columns, "row")
    lows = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*columns)).alias("low")).collect()
    return sorted(tuple(r["low"]) for r in lows)[1:]


def tokenized(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, width: int = 4,
              starts: list[tuple] | None = None) -> DataFrame:
    """doc_id, tie, ids (little-endian, ``width`` bytes each, the end id last) of every row, and
    the shard it belongs to: that of its key's range, where a key that fills several ranges is
    dealt over them in turn (its rows are equal, so the order of the whole is kept)."""
    path, starts = vocabulary or default_vocabulary(), starts or []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, turn = Encoder(path), end_id.to_bytes(4, "little"), 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // _TEXT_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                ids = [np.frombuffer(i + end, "<u4").astype(f"<u{width}").tobytes()
                       for i in encoder.encode(part.column(3))]
                shards = []
                for key in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    low, high = bisect_left(starts, key), bisect_right(starts, key)
                    shards.append(high if high - low < 2 else low + 1 + turn % (high - low))
                    turn += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(shards, pa.int32()), *part.columns[:3], pa.array(ids, pa.binary())],
                    names=["shard", "known", "id", "tie", "ids"])

    return _keyed(docs).mapInArrow(encode, "shard int, known boolean, id long, tie long, ids binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """known, id, tie (the order of the files) and text of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0)).alias("id"),
                       F.xxhash64(text).alias("tie"), text.alias("text"))


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None,
                      end_id: int = END_ID, width: int | None = None) -> DataFrame:
    """Encode ``docs`` and write the files; one row per shard: shard, name, folder, docs, ids,
    bytes_ids, bytes_bounds, and docs_before, ids_before over earlier shards.

    Rows are ordered by doc_id, those without an id first, repeated ids by the hash of their
    text; a null text counts as empty and gives the end id alone; repeated rows are written each;
    an empty table gives no shard and no row.  ``doc_id`` must be a whole number; other columns
    are not read.  ``folder`` unset takes a fresh one in the shared scratch folder.

    The texts are read twice, for the shards' ranges (keys only) and to be encoded; what is
    exchanged is the ids, packed as in the files.
    """
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    folder = folder or scratch_path(spark, "token-files")
    if width is None:
        from tokenizers import Tokenizer

        width = 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = shard_starts(_keyed(docs).drop("text"), n)
    ranged = (tokenized(docs, path, end_id, width, starts).repartitionById(n, "shard")
              .sortWithinPartitions("known", "id", "tie", "ids")
              .select(F.when(F.col("known"), F.col("id")).alias("doc_id"), "ids"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, name = context.partitionId(), _shard_name(context.partitionId())
        store, root = _open_store(folder)
        store.create_dir(root, recursive=True)
        own = f"{root}/_attempt-{context.taskAttemptId()}-{name}"
        lengths, doc_ids = [], []
        with store.open_output_stream(f"{own}.ids") as out:
            for batch in batches:
                doc_ids += batch.column(0).to_pylist()
                for ids in batch.column(1):
                    raw = ids.as_buffer()
                    lengths.append(raw.size // width)
                    out.write(raw)
        if not lengths:
            store.delete_file(f"{own}.ids")
            return
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.uint64)]).astype(np.uint64)
        known = [i for i in doc_ids if i is not None]
        least = known[0] if known else 0
        head = struct.pack(_HEAD, _MAGIC, _VERSION, width, len(lengths), int(bounds[-1]), least, len(doc_ids) - len(known))
        table = head + ef_encode(bounds) + ef_encode(np.array([i - least for i in known], np.uint64))
        with store.open_output_stream(f"{own}.ef") as out:
            out.write(table)
        for kind in ("ids", "ef"):
            if store.get_file_info(f"{root}/{name}.{kind}").is_file:  # of an attempt before this one
                store.delete_file(f"{root}/{name}.{kind}")
            store.move(f"{own}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([part], pa.int32()), "name": [name], "folder": [folder], "docs": [len(lengths)],
            "ids": [int(bounds[-1])], "bytes_ids": [int(bounds[-1]) * width], "bytes_bounds": [len(table)]})

    written = stage(ranged.mapInArrow(
        write, "shard int, name string, folder string, docs long, ids long, bytes_ids long, bytes_bounds long"),
        "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return written.withColumns({"docs_before": F.coalesce(F.sum("docs").over(before), F.lit(0)),
                                "ids_before": F.coalesce(F.sum("ids").over(before), F.lit(0))})


def read_token_files(spark: SparkSession, shards: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document from the files alone: doc_id, position (over all shards), start (ids
    of all documents before it), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit
    integers)."""
    blocks = shards.select("name", "folder", "ids_before", "docs_before", F.explode(F.sequence(
        F.lit(0), F.expr(f"greatest(ids - 1, 0) div {block_ids}"))).alias("block"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["folder"], row["name"])
                # a block holds the documents that end in it
                first = shard.first_ending_after(row["block"] * block_ids)
                stop = shard.first_ending_after((row["block"] + 1) * block_ids)
                if first < stop:
                    begin, end = shard.offsets(first, stop)[[0, -1]].tolist()
                    ids = shard.ids(begin, end)
                while first < stop:
                    upto = min(stop, first + 4096)
                    offsets = shard.offsets(first, upto)
                    cuts = (offsets - begin).tolist()
                    crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.doc_ids(first, upto), pa.int64()),
                        pa.array(np.arange(first, upto) + row["docs_before"], pa.int64()),
                        pa.array(offsets[:-1] + row["ids_before"], pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()), pa.array(crcs, pa.int64()),
                    ], names=["doc_id", "position", "start", "n_tokens", "ids_crc32"])
                    first = upto
                shard.close()

    return blocks.repartition(n, "name", "block").mapInArrow(
        read, "doc_id long, position long, start long, n_tokens long, ids_crc32 long")
