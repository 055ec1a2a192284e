"""Token shards as wavelet matrices.

A shard file holds the ids of a run of documents in ascending id order as a wavelet matrix: one bit plane for each
bit of an id, the highest first; below a plane the ids with bit 0 stand before those with bit 1, each in their order.
Planes are compressed in blocks of their own, beside a directory of ones before every block and superblock, so that
``access``, ``rank``, ``count``, ``select`` and ``occurrences`` touch a few blocks only, and ``decode`` gives all back.

File: MAGIC, the blocks, then a JSON footer, its length (8 bytes) and MAGIC again.

Defined results: null text counts as empty; documents with a null id come first; repeated ids are separate documents
in any order among themselves; an empty table writes no file and reads back as no row; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commlens.llm.common import scratch, slices, utf8, written
from commlens.llm.side import open_uri
from commlens.llm.tokens import crc32_u32, worker_tokenizer

MAGIC = b"WMTOKEN1"
BLOCK = 1 << 16  # bytes of a plane in a compressed block
SUPER = 64  # bytes of a plane between two entries of the rank directory


def _packed_array(z, a: np.ndarray) -> bytes:
    return z.compress(np.ascontiguousarray(a).tobytes())


def encode_shard(ids: np.ndarray, doc_ends: np.ndarray, keys: pa.Array, levels: int) -> list[bytes]:
    """The parts of a shard file, in order."""
    z = zstandard.ZstdCompressor(level=1)
    out, at = [MAGIC], len(MAGIC)

    def put(data: bytes) -> list[int]:
        nonlocal at
        out.append(data)
        at += len(data)
        return [at - len(data), len(data)]

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("key", keys.type)])) as w:
        w.write_batch(pa.record_batch([keys], names=["key"]))
    foot = {"n": len(ids), "levels": levels, "dtype": ids.dtype.str, "docs": len(doc_ends), "planes": []}
    foot["keys"] = put(z.compress(sink.getvalue().to_pybytes()))
    foot["ends"] = put(_packed_array(z, np.diff(doc_ends, prepend=0).astype("<u8")))
    a = ids
    for level in range(levels - 1, -1, -1):
        bit = (a & a.dtype.type(1 << level)) != 0
        plane = np.packbits(bit)
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), SUPER), dtype=np.uint32), dtype=np.uint32)]) if len(plane) else np.zeros(1, np.uint32)
        blocks = [put(z.compress(plane[i : i + BLOCK].tobytes())) for i in range(0, len(plane), BLOCK)]
        low, high, dealt = np.flatnonzero(~bit), np.flatnonzero(bit), np.empty_like(a)
        foot["planes"].append({"zeros": len(low), "blocks": blocks, "ranks": put(_packed_array(z, ones.astype("<u4")))})
        a.take(low, out=dealt[: len(low)], mode="clip")
        a.take(high, out=dealt[len(low) :], mode="clip")
        a = dealt
    tail = json.dumps(foot, separators=(",", ":")).encode()
    return [*out, tail, len(tail).to_bytes(8, "little"), MAGIC]


class WaveletMatrix:
    """A shard file, opened for queries; ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.f = source
        size = source.seek(0, 2) if source.seek(0, 2) is not None else source.tell()
        source.seek(size - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token shard")
        n = int.from_bytes(tail[:8], "little")
        source.seek(size - 16 - n)
        self.foot = json.loads(source.read(n))
        self.z = zstandard.ZstdDecompressor()
        self.n, self.levels = self.foot["n"], self.foot["levels"]
        self.dtype = np.dtype(self.foot["dtype"])
        self.ends = np.cumsum(np.frombuffer(self._get(self.foot["ends"]), "<u8").astype(np.int64))
        self.keys = pa.ipc.open_stream(self._get(self.foot["keys"])).read_all()["key"].combine_chunks()
        self._ranks: dict[int, np.ndarray] = {}
        self._blocks: dict[tuple[int, int], np.ndarray] = {}

    def _get(self, where: list[int]) -> bytes:
        self.f.seek(where[0])
        return self.z.decompress(self.f.read(where[1]))

    def _block(self, p: int, k: int) -> np.ndarray:
        if (p, k) not in self._blocks:
            if len(self._blocks) >= 256:  # 16 MB
                self._blocks.pop(next(iter(self._blocks)))
            self._blocks[p, k] = np.frombuffer(self._get(self.foot["planes"][p]["blocks"][k]), np.uint8)
        return self._blocks[p, k]

    def _rank1(self, p: int, i: int) -> int:
        """Ones among the first i bits of plane p."""
        if p not in self._ranks:
            self._ranks[p] = np.frombuffer(self._get(self.foot["planes"][p]["ranks"]), "<u4")
        byte, bits = divmod(i, 8)
        s = byte // SUPER
        total = int(self._ranks[p][s])
        lo = s * SUPER
        if i > lo * 8:
            block = self._block(p, lo // BLOCK)
            a, b = lo % BLOCK, lo % BLOCK + byte - lo
            total += int(np.bitwise_count(block[a:b]).sum())
            if bits:
                total += (int(block[b]) >> (8 - bits)).bit_count()
        return total

    def _bit(self, p: int, i: int) -> int:
        byte = i >> 3
        return int(self._block(p, byte // BLOCK)[byte % BLOCK]) >> (7 - (i & 7)) & 1

    def _range(self, token: int, i: int, j: int) -> tuple[int, int]:
        for p in range(self.levels):
            a, b = self._rank1(p, i), self._rank1(p, j)
            i, j = (self.foot["planes"][p]["zeros"] + a, self.foot["planes"][p]["zeros"] + b) if token >> (self.levels - 1 - p) & 1 else (i - a, j - b)
        return i, j

    def access(self, i: int) -> int:
        token = 0
        for p in range(self.levels):
            bit, ones = self._bit(p, i), self._rank1(p, i)
            token = token << 1 | bit
            i = self.foot["planes"][p]["zeros"] + ones if bit else i - ones
        return token

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position i."""
        a, b = self._range(token, 0, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0)."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, 0, 0)[0] + k
        for p in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - p) & 1
            want = at - self.foot["planes"][p]["zeros"] * bit
            lo, hi = 0, self.n  # the smallest hi with more than want such bits before it
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._rank1(p, mid + 1)
                if (ones if bit else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            at = lo
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids: from the lowest plane upwards, each plane deals the ids out again."""
        ids = np.zeros(self.n, dtype=self.dtype)
        for p in range(self.levels - 1, -1, -1):
            plane = self.foot["planes"][p]
            bit = np.unpackbits(np.concatenate([np.frombuffer(self._get(b), np.uint8) for b in plane["blocks"]]), count=self.n).view(bool) if plane["blocks"] else np.zeros(0, bool)
            up = np.empty_like(ids)
            up[np.flatnonzero(~bit)] = ids[: plane["zeros"]]
            up[np.flatnonzero(bit)] = ids[plane["zeros"] :] | self.dtype.type(1 << (self.levels - 1 - p))
            ids = up
        return ids


def write_shards(
    df: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 4_000_000, max_words: int = 1_000_000,
) -> DataFrame:
    """Writes the shards into ``folder``; the manifest: path, part, seq, n_docs, n_tokens.

    Texts are dealt out by ranges of the id and sorted within each; a task writes a shard whenever it holds
    ``shard_tokens`` ids, so its memory is bounded whatever the range holds.  Every file has a name of its own and is
    never renamed; the manifest, a written table, names those of the attempts that counted, so a repeated task is safe
    on any store, and what an attempt that was lost left behind is never read.  The range key has a hash of the text
    below the id, so that different texts of one repeated or null id can be split.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = worker_tokenizer(tokenizer, max_words)
        levels = (tok.tok.get_vocab_size(with_added_tokens=True) - 1).bit_length()
        end = np.array([end_id], dtype=tok.dtype).tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        store, base = open_uri(folder)
        store.create_dir(base, recursive=True)
        held, keys, size, id_type, made = [], [], 0, None, []

        def close():
            nonlocal held, keys, size, seq
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.wm"
            ids = np.frombuffer(b"".join(held), dtype=tok.dtype)
            ends = np.cumsum([len(x) // tok.width for x in held])
            with store.open_output_stream(f"{base}/{name}") as f:
                for x in encode_shard(ids, ends, pa.array(keys, id_type), levels):
                    f.write(x)
            made.append((f"{folder}/{name}", part, seq, len(held), len(ids)))
            held, keys, size, seq = [], [], 0, seq + 1

        for batch in slices(parts, 1):
            id_type = batch.schema.field(0).type
            for key, packed in zip(batch.column(0).to_pylist(), tok.encode(batch.column(1).to_pylist()), strict=True):
                held.append(packed + end)
                keys.append(key)
                size += len(packed) // tok.width + 1
                if size >= shard_tokens:
                    close()
        if held:
            close()
        if made:
            c = list(zip(*made))
            yield pa.RecordBatch.from_arrays([pa.array(c[0]), *[pa.array(x, pa.int64()) for x in c[1:]]], names=["path", "part", "seq", "n_docs", "n_tokens"])

    dealt = df.select(F.col(id_col).alias("k"), utf8(text_col).alias("text"), F.xxhash64(utf8(text_col)).alias("h")).repartitionByRange("k", "h").sortWithinPartitions("k", "h").select("k", "text")
    return written(dealt.mapInArrow(run, "path string, part long, seq long, n_docs long, n_tokens long"), "manifest")


def read_shards(manifest: DataFrame, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """From the files: a row for each document: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    # A row for each range of ids: as many as the write had tasks, not as many as there are rows.
    sums = [(r["part"], r["n"]) for r in manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()]
    before, total = [], 0
    for part, n in sums:
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "part long, base long")
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(F.broadcast(offsets), "part").withColumn("first", F.col("base") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, at = open_uri(path)
                with store.open_input_file(at) as f:
                    shard = WaveletMatrix(f)
                    ids = shard.decode().astype("<u4")
                lo = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
                crc = [crc32_u32(ids[a:b]) for a, b in zip(lo.tolist(), shard.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([shard.keys, pa.array(lo + first, pa.int64()), pa.array(shard.ends - lo, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    tasks = max(1, len(sums))
    return placed.select("path", "first").repartitionByRange(tasks, "first").mapInArrow(run, f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long")


def encode_and_read_back(df: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    spark: SparkSession = df.sparkSession
    manifest = write_shards(df, scratch(spark, "shards"), tokenizer, end_id, id_col, text_col, **more)
    return read_shards(manifest, df.schema[id_col].dataType.simpleString(), id_col)
