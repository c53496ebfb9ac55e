"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A file is a run of frames, all numbers little-endian:

    8 bytes  length n of the payload
    4 bytes  masked checksum of those 8 bytes
    n bytes  payload: document id (8 bytes, signed), marks (4 bytes), token ids
    4 bytes  masked checksum of the payload

Marks: 1 the id is null; 2 token ids take 2 bytes each, as they do for a
vocabulary of up to 65,536 ids, instead of 4; 4 the last 2 bytes fill the
payload up to a multiple of 4.  The checksum is CRC-32C; masked: rotated right by 15 bits, plus 0xa282ead8.

Documents are sorted by id over range partitions; every task writes the files
of its own range, of bounded size each, under names no other attempt uses.  The
index (file, offset, bytes, id, tokens of every record) is an ordinary Parquet
table that Spark commits: a file counts only if a committed index row names
it, so what a lost or repeated attempt leaves behind is never read.  Files are
read whole in order, or record by record in any order through the index.

The files are opened by the tasks through Arrow's file systems, so the folder
must be one of those (local or shared mount, hdfs, s3, gs); ``s3a`` is read as ``s3``.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimetl.llm.byte_bpe import ByteEncoder
from dimetl.llm.common import id_col, text_or_empty
from dimetl.session import scratch_path

END_ID = 2
#: A task begins a new file where the one at hand has this many bytes.
FILE_BYTES = 32 << 20
#: Texts are encoded in groups of about this many characters.
GROUP_CHARS = 4 << 20

# --------------------------------------------------------------- checksums

_POLY = 0x82F63B78  # CRC-32C, lowest bit first
_MASK_DELTA = 0xA282EAD8


def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, given by its images of the 32 bits, of some values."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
    return out


@lru_cache(maxsize=64)
def _shift(level: int) -> tuple[np.ndarray, ...]:
    """Tables (one for each byte of the state) that push ``2**level`` zero words through the checksum."""
    if level == 0:
        columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(32):
            columns = columns >> np.uint32(1) ^ np.where(columns & np.uint32(1), np.uint32(_POLY), np.uint32(0))
    else:
        half = _shift(level - 1)
        columns = np.array([half[b >> 3][1 << (b & 7)] for b in range(32)], np.uint32)
        columns = _apply(columns, columns)
    byte = np.arange(256, dtype=np.uint32)
    return tuple(_apply(columns, byte << np.uint32(8 * n)) for n in range(4))


def _push(level: int, v: np.ndarray) -> np.ndarray:
    t0, t1, t2, t3 = _shift(level)
    return t0[v & np.uint32(255)] ^ t1[v >> np.uint32(8) & np.uint32(255)] ^ t2[v >> np.uint32(16) & np.uint32(255)] ^ t3[v >> np.uint32(24)]


def crc32c(words: np.ndarray, counts: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """CRC-32C of runs of 32-bit words that stand in a row, ``counts[i]`` (one at least) in the i-th run.

    The checksum is linear: neighbours are folded pairwise, each level pushing
    the left half past the right one, over all runs of like size at once.
    """
    counts = np.asarray(counts, np.int64)
    starts = np.cumsum(counts) - counts
    level = np.frompyfunc(lambda n: (int(n) - 1).bit_length(), 1, 1)(counts).astype(np.int64)
    out = np.zeros(len(counts), np.uint32)
    for k in np.unique(level).tolist():
        rows, width = np.flatnonzero(level == k), 1 << k
        for i in range(0, len(rows), max(1, block >> k)):
            some = rows[i : i + max(1, block >> k)]
            pad = width - counts[some]
            at = starts[some, None] - pad[:, None] + np.arange(width)
            v = np.where(np.arange(width) >= pad[:, None], words[np.maximum(at, 0)], np.uint32(0))
            v[np.arange(len(some)), pad] ^= np.uint32(0xFFFFFFFF)
            for j in range(k):
                v = _push(j, v[:, 0::2]) ^ v[:, 1::2]
            out[some] = _push(0, v[:, 0]) ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    wide = crc.astype(np.uint64)
    return ((((wide >> np.uint64(15)) | (wide << np.uint64(17))) + np.uint64(_MASK_DELTA)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


# --------------------------------------------------------------- frames

#: Words of a frame beside its token ids: length (2), its checksum, id (2), marks, checksum of the payload.
_EXTRA = 7
_NULL, _NARROW, _FILLED = 1, 2, 4


def _body(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all payload words of frames."""
    inner = size - 4
    return np.arange(int(inner.sum())) + np.repeat(begin + 3 - (np.cumsum(inner) - inner), inner)


def frames(ids: np.ndarray, counts: np.ndarray, doc_ids: np.ndarray, has_id: np.ndarray, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """All frames in a row as 32-bit words, and where each begins (in words); ``ids`` holds ``counts[i]`` for each."""
    counts = np.asarray(counts, np.int64)
    per_word = 2 if narrow else 1
    size = -(-counts // per_word) + _EXTRA
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), "<u4")
    payload = 4 * (size - 4)
    out[begin], out[begin + 1] = payload & 0xFFFFFFFF, payload >> 32
    doc = np.asarray(doc_ids, np.int64).view(np.uint64)
    out[begin + 3], out[begin + 4] = (doc & np.uint64(0xFFFFFFFF)).astype(np.uint32), (doc >> np.uint64(32)).astype(np.uint32)
    out[begin + 5] = ~np.asarray(has_id, bool) * _NULL + narrow * (_NARROW + counts % 2 * _FILLED)
    units = out.view("<u2") if narrow else out
    units[np.arange(len(ids)) + np.repeat((begin + 6) * per_word - (np.cumsum(counts) - counts), counts)] = ids
    lengths = np.stack([out[begin], out[begin + 1]], axis=1).ravel()
    out[begin + 2] = masked(crc32c(lengths, np.full(len(counts), 2)))
    out[begin + size - 1] = masked(crc32c(out[_body(begin, size)], size - 4))
    return out, begin


def parse(data: bytes, where: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(words, begin, doc ids, marks)`` of the frames in ``data``; an error names the first damaged one."""
    begin, at = [], 0
    while at < len(data):
        n = struct.unpack_from("<Q", data, at)[0] if at + 16 <= len(data) else 0
        if n < 12 or n % 4 or at + 16 + n > len(data):
            raise ValueError(f"{where}: no whole record at byte {at}")
        begin.append(at // 4)
        at += 16 + n
    words, begin = np.frombuffer(data, "<u4"), np.array(begin, np.int64)
    size = np.diff(np.append(begin, len(words)))
    lengths = np.stack([words[begin], words[begin + 1]], axis=1).ravel()
    good = masked(crc32c(lengths, np.full(len(begin), 2))) == words[begin + 2]
    good &= masked(crc32c(words[_body(begin, size)], size - 4)) == words[begin + size - 1]
    if not good.all():
        raise ValueError(f"{where}: checksum differs at byte {4 * begin[np.argmin(good)]}")
    doc = (words[begin + 3].astype(np.uint64) | words[begin + 4].astype(np.uint64) << np.uint64(32)).view(np.int64)
    return words, begin, doc, words[begin + 5]


def _open(folder: str):
    """Arrow file system and path of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


# --------------------------------------------------------------- writing

@lru_cache(maxsize=1)
def _encoder(path: str) -> ByteEncoder:
    """One per Python worker."""
    return ByteEncoder(path, special_as_text=False)


def groups_of(batch: pd.DataFrame, chars: int = GROUP_CHARS) -> Iterator[pd.DataFrame]:
    """Rows of a batch in runs of about so many characters."""
    total = np.cumsum(batch["text"].str.len().to_numpy(np.int64)) // chars
    for a, b in zip(*(x.tolist() for x in _runs(total)), strict=True):
        yield batch.iloc[a:b]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return starts, np.append(starts[1:], len(keys))


_INDEX = "part int, file string, seq long, offset long, bytes long, doc_id long, n_tokens long"


def _write_batches(path: str, folder: str, end_id: int, file_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex
        system = root = out = name = None
        at, files, seq = 0, 0, 0
        for batch in batches:
            for rows in groups_of(batch):
                encoder = _encoder(path)
                ids, counts = encoder.encode(rows["text"].tolist())
                with_end = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                doc = rows["doc_id"].astype("Int64")
                words, begin = frames(with_end, counts + 1, doc.fillna(0).to_numpy(np.int64), doc.notna().to_numpy(), max(len(encoder.sizes), end_id + 1) <= 1 << 16)
                size = np.diff(np.append(begin, len(words))) * 4
                # Frames go to the file at hand until it is full; a frame is never cut.
                done = 0
                while done < len(begin):
                    if out is None:
                        if system is None:
                            system, root = _open(folder)
                            system.create_dir(root, recursive=True)
                        name = f"part-{part:06d}-{files:05d}-{attempt}.records"
                        out, at, files = system.open_output_stream(f"{root}/{name}"), 0, files + 1
                    fill = at + np.cumsum(size[done:])
                    stop = done + min(int(np.searchsorted(fill, file_bytes)) + 1, len(begin) - done)
                    end = begin[stop] if stop < len(begin) else len(words)
                    out.write(words[begin[done] : end].tobytes())
                    offset = at + np.cumsum(size[done:stop]) - size[done:stop]
                    yield pd.DataFrame({
                        "part": np.full(stop - done, part, np.int32), "file": name, "seq": seq + np.arange(stop - done), "offset": offset,
                        "bytes": size[done:stop], "doc_id": doc.iloc[done:stop].array, "n_tokens": counts[done:stop] + 1,
                    })
                    at, seq, done = at + int(size[done:stop].sum()), seq + stop - done, stop
                    if at >= file_bytes:
                        out.close()
                        out = None
        if out is not None:
            out.close()

    return run


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write the ids of every text, each followed by ``end_id``, in ascending id order; returns the folder.

    Null texts are empty (the end id alone); null ids come last; rows of one id
    are ordered by a hash of their text, equal rows are records of their own.
    An empty table writes an empty index and no file.  The folder holds
    ``records/`` and ``index/``; ``folder`` must be new (a scratch folder under
    the session's shared checkpoint folder by default).
    """
    folder = folder or scratch_path(docs.sparkSession, "token-records")
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    # The last key deals rows of one id and text over several ranges, however many there are.
    ordered = src.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id())
    index = ordered.mapInPandas(_write_batches(tokenizer_path, f"{folder}/records", end_id, file_bytes), _INDEX)
    index.write.parquet(f"{folder}/index")
    return folder


# --------------------------------------------------------------- reading

def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``part, file, seq, offset, bytes, doc_id, n_tokens`` of every record."""
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def _rows(name: str, data: bytes, first: int = 0) -> pd.DataFrame:
    words, begin, doc, marks = parse(data, name)
    ends = np.append(begin[1:], len(words)) - 1
    narrow, filled = marks & _NARROW > 0, marks & _FILLED > 0
    count = (ends - begin - 6) * (1 + narrow) - filled
    ids = [
        (words[a:b].view("<u2")[:n].astype("<u4") if short else words[a:b]).tobytes()
        for a, b, n, short in zip((begin + 6).tolist(), ends.tolist(), count.tolist(), narrow.tolist(), strict=True)
    ]
    return pd.DataFrame({
        "doc_id": pd.arrays.IntegerArray(doc, marks & _NULL > 0), "n_tokens": count, "ids": ids, "file": name, "offset": first + 4 * begin,
    })


def _read_files(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for batch in batches:
            for f in batch.itertuples(index=False):
                with system.open_input_file(f"{root}/{f.file}") as stream:
                    out = _rows(f.file, stream.read())
                if len(out) != f.records or int(out["n_tokens"].sum()) != f.tokens:
                    raise ValueError(f"{f.file}: the file and its index differ")
                yield out.assign(start=f.first_token + out["n_tokens"].cumsum() - out["n_tokens"])[["doc_id", "start", "n_tokens", "ids"]]

    return run


_RECORD = "doc_id long, n_tokens long, ids binary, file string, offset long"


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian 32-bit numbers) of every record, from the files.

    ``start`` counts the ids of all records before it.  Files are dealt to
    tasks, read whole and checked against their checksums and the index.
    """
    index = read_index(spark, folder)
    files = index.groupBy("part", "file").agg(
        F.count(F.lit(1)).alias("records"), F.sum("n_tokens").alias("tokens"), F.min("seq").alias("first_seq")
    )
    # Tokens before each file: of its task's files, in order, and of all tasks before (as many rows as there were tasks).
    in_task = Window.partitionBy("part").orderBy("first_seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("in_task", F.coalesce(F.sum("tokens").over(in_task), F.lit(0)))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy(F.col("part").alias("of_part")).agg(F.sum("tokens").alias("of_tokens"))
    tasks = tasks.select("of_part", F.coalesce(F.sum("of_tokens").over(before), F.lit(0)).alias("of_start"))
    places = files.join(tasks, F.col("part") == F.col("of_part")).withColumn("first_token", F.col("of_start") + F.col("in_task"))
    dealt = places.select("file", "records", "tokens", "first_token").repartition(F.col("file"))
    return dealt.mapInPandas(_read_files(f"{folder}/records"), "doc_id long, start long, n_tokens long, ids binary")


def _read_places(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for batch in batches:
            # Rows keep their shuffled order; each file is opened once a batch.
            out = []
            for name, rows in batch.reset_index(drop=True).groupby("file", sort=False):
                with system.open_input_file(f"{root}/{name}") as stream:
                    for place, offset, size in zip(rows.index, rows["offset"], rows["bytes"], strict=True):
                        stream.seek(int(offset))
                        out.append(_rows(name, stream.read(int(size)), int(offset)).set_axis([place]))
            if out:
                yield pd.concat(out).sort_index()

    return run


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """``doc_id, n_tokens, ids, file, offset`` of every record in an order drawn by ``seed``, read place by place.

    Only index rows are shuffled.  The same seed gives the same order; every
    record comes once.
    """
    places = read_index(spark, folder).select("file", "offset", "bytes")
    drawn = places.orderBy(F.xxhash64("file", "offset", F.lit(seed)), "file", "offset")
    return drawn.mapInPandas(_read_places(f"{folder}/records"), _RECORD)


# --------------------------------------------------------------- operator

def record_digests(records: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of records as read: the unsigned CRC-32 of all a record's ids."""
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> DataFrame:
    """Write all documents and read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    folder = write_records(docs, tokenizer_path, folder, **options)
    return record_digests(read_records(docs.sparkSession, folder))
