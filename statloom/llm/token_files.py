"""Token ids in files of Huffman codes: canonical, length-limited, in blocks that decode on their own.

A file holds the code lengths (the codes follow from them), per document its id and number of ids, and
segments of blocks. A block is ``BLOCK`` ids; the bit at which each begins is listed, so any block can
be read without those before it. Decoding looks up the next ``max_bits`` bits of all blocks of a
segment at once in one table.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import bpe
from statloom.llm.shared import PIECE, batches_of, by_path, map_pieces, open_folder, shared_folder, write_file, written

#: The longest code; ids of one block; blocks of one segment.
MAX_BITS, BLOCK, BLOCKS = 18, 512, 1024
END_ID = 1
_MAGIC = b"IDHUF001"
_NO_ID = -(1 << 63)
#: Bytes of an Arrow batch while texts and ids go to Python: the JVM and the worker each hold it whole.
BATCH_BYTES = 4 << 20


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of the best prefix code of at most ``max_bits`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    n, levels, packed = len(order), [], np.zeros(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packed])
        place = np.argsort(merged, kind="stable")
        levels.append(place < n)  # which of the level's items are ids, in order of weight
        ranked = merged[place]
        packed = ranked[: len(ranked) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken, by_rank = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(levels):
        ids = int(leaf[:taken].sum())
        by_rank[:ids] += 1
        taken = 2 * (taken - ids)
    lengths[order] = by_rank
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then id."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        size = lengths[order].astype(np.int64)
        top = int(size.max())
        step = np.int64(1) << (top - size)
        codes[order] = ((np.cumsum(step) - step) >> (top - size)).astype(np.uint64)
    return codes


def encode_segment(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The first bit of each block, and the bits, filled up to whole 64-bit words plus one spare."""
    size = lengths[ids].astype(np.int32)
    ends = np.cumsum(size, dtype=np.int32)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    word, room = starts >> 6, 64 - (starts & 63) - size
    code = codes[ids]
    over = np.flatnonzero(room < 0)
    # Codes are disjoint in bits, so the sum of those in a word is the word.
    here = code << np.maximum(room, 0).astype(np.uint64)
    here[over] = code[over] >> (-room[over]).astype(np.uint64)
    packed = np.zeros((total >> 6) + 2, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        packed[word[first]] = np.add.reduceat(here, first)
        packed[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return starts[::BLOCK].astype("<u4"), packed.astype(">u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every value of the next bits: the id and the length of its code."""
    used = np.flatnonzero(lengths)
    if not len(used):
        return np.zeros(2, np.uint32), np.ones(2, np.int64), 1
    top = int(lengths.max())
    order = used[np.argsort(lengths[used], kind="stable")]
    repeat = np.int64(1) << (top - lengths[order].astype(np.int64))
    names, sizes = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.int64)
    filled = int(repeat.sum())
    names[:filled], sizes[:filled] = np.repeat(order, repeat), np.repeat(lengths[order], repeat)
    return names, sizes, top


def decode_segment(n: int, starts: np.ndarray, bits: bytes, table) -> np.ndarray:
    """All ids of a segment; its blocks advance together, each from its own first bit."""
    names, sizes, top = table
    packed = np.frombuffer(bits, ">u8").astype(np.uint64)
    at = starts.astype(np.int64)
    made = np.empty((len(at), BLOCK), np.uint32)
    last = n - (len(at) - 1) * BLOCK
    for k in range(BLOCK if len(at) > 1 else last):
        if k == last:  # the last block may be shorter
            at = at[:-1]
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        seen = (packed[word] << shift) | ((packed[word + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
        seen >>= np.uint64(64 - top)
        made[: len(at), k] = names[seen]
        at = at + sizes[seen]
    return made.reshape(-1)[:n]


def file_parts(rows, lengths: np.ndarray, kind: str):
    """The bytes of one file from (id, ids) pairs; segment by segment, so a file of any size streams."""
    codes = canonical(lengths)
    yield _MAGIC + struct.pack("<I", len(head := zlib.compress(lengths.tobytes(), 6))) + head
    held, held_n, docs = [], 0, []

    def flush(ids: np.ndarray, ended: list) -> bytes:
        starts, bits = encode_segment(ids, lengths, codes)
        names = np.array([_NO_ID if d is None else d for d, _ in ended], "<i8").tobytes()
        sizes = np.array([n for _, n in ended], "<i8").tobytes()
        return struct.pack("<IIII", len(ids), len(ended), len(starts), len(bits)) + names + sizes + starts.tobytes() + bits

    for name, blob in rows:
        ids = np.frombuffer(blob, kind)
        docs.append((name, len(ids)))
        held.append(ids)
        held_n += len(ids)
        while held_n >= BLOCK * BLOCKS:
            whole = np.concatenate(held)
            yield flush(whole[: BLOCK * BLOCKS], docs)
            held, docs = [whole[BLOCK * BLOCKS:]], []
            held_n = len(held[0])
    if held_n or docs:
        yield flush(np.concatenate(held), docs)


def read_file(stream):
    """(document id, its ids as 32-bit numbers) of a file, in order; holds a segment and one document."""
    if stream.read(8) != _MAGIC:
        raise ValueError("no file of token ids")
    (size,) = struct.unpack("<I", stream.read(4))
    table = decode_table(np.frombuffer(zlib.decompress(stream.read(size)), np.uint8))
    waiting: list[tuple] = []
    held, held_n = [], 0
    while head := stream.read(16):
        n, docs, blocks, size = struct.unpack("<IIII", head)
        names = np.frombuffer(stream.read(8 * docs), "<i8").tolist()
        sizes = np.frombuffer(stream.read(8 * docs), "<i8").tolist()
        waiting += zip(names, sizes)
        starts = np.frombuffer(stream.read(4 * blocks), "<u4")
        bits = stream.read(size)
        if n:
            held.append(decode_segment(n, starts, bits, table))
            held_n += n
        done = 0
        if waiting and waiting[0][1] <= held_n:
            whole, at = np.concatenate(held or [np.zeros(0, np.uint32)]), 0
            for name, count in waiting:
                if at + count > held_n:
                    break
                yield None if name == _NO_ID else name, whole[at:at + count]
                at, done = at + count, done + 1
            waiting, held, held_n = waiting[done:], [whole[at:]], held_n - at
    if waiting:
        raise ValueError("the file ends early")


def id_table(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """(id, ids): the little-endian ids of every text with ``end_id`` after it, written once."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab_size()
    kind = "<u2" if vocab <= 1 << 16 else "<u4"

    def work(columns: dict[str, list]) -> dict:
        enc, last = bpe.encoder(path), struct.pack("<I", end_id)
        blobs = enc.by_words([t or "" for t in columns["text"]])
        return {"id": columns["id"], "ids": [np.frombuffer(b + last, "<u4").astype(kind).tobytes() for b in blobs]}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(map_pieces(rows, "id long, ids binary", work), "ids"), kind, vocab


def id_counts(ids: DataFrame, kind: str, vocab: int) -> np.ndarray:
    """How often each id occurs in the whole table; at most one row per id reaches the driver."""
    def run(batches):
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                blobs = batch.column(0).slice(at, PIECE).to_pylist()
                total += np.bincount(np.frombuffer(b"".join(b or b"" for b in blobs), kind), minlength=vocab)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["token", "n"])

    parts = ids.select("ids").mapInArrow(run, "token long, n long")
    counts = np.zeros(vocab, np.int64)
    for token, n in parts.groupBy("token").agg(F.sum("n").alias("n")).collect():
        counts[token] = n
    return counts


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          max_bits: int = MAX_BITS) -> DataFrame:
    """Write the ids of all texts, in ascending ``id_col``, and give the list of files.

    One row per file: path, first_id, docs, n_ids and ``start``, the ids in files before it. A null or
    empty text is ``end_id`` alone; null ids come first; rows with one id follow each other in the
    order of their ids. Other columns are left out. An empty table gives no file. A document of any
    length may span segments, and files are as large as the partitions of the sort.
    """
    spark = docs.sparkSession
    with batches_of(spark, BATCH_BYTES):
        ids, kind, vocab = id_table(docs, path, id_col, text_col, end_id)
        lengths = code_lengths(id_counts(ids, kind, vocab), max_bits)
    folder = shared_folder(spark, "token-files")
    blob = lengths.tobytes()

    def save(batches):
        first, docs_n, total = [], 0, 0

        def rows():
            nonlocal docs_n, total
            for batch in batches:
                for at in range(0, batch.num_rows, PIECE):
                    for name, ids in zip(*(c.to_pylist() for c in batch.slice(at, PIECE).columns)):
                        if not first:
                            first.append(name)
                        docs_n, total = docs_n + 1, total + len(ids) // np.dtype(kind).itemsize
                        yield name, ids

        made, ahead = rows(), []
        for row in made:
            ahead.append(row)
            break
        if ahead:
            from itertools import chain

            where = write_file(folder, "ids", file_parts(chain(ahead, made), np.frombuffer(blob, np.uint8), kind))
            yield pa.RecordBatch.from_pylist(
                [{"path": where, "first_id": first[0], "docs": docs_n, "n_ids": total}],
                schema=pa.schema([("path", "string"), ("first_id", "int64"), ("docs", "int64"), ("n_ids", "int64")]))

    ordered = ids.repartitionByRange("id").sortWithinPartitions("id", "ids")
    with batches_of(spark, BATCH_BYTES):
        listed = written(ordered.mapInArrow(save, "path string, first_id long, docs long, n_ids long"), "token-list")
    # One row per file: the only table that is ever brought together.
    before = Window.orderBy(F.asc_nulls_first("first_id"), "path").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read(files: DataFrame, packed: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start, ids; a file is read by one task, in segments.

    ``ids`` is array<int>, or with ``packed`` the binary of the ids as little-endian 32-bit numbers.
    """
    system_of = open_folder

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, base = system_of(path)
                names, starts, blobs, held = [], [], [], 0
                with system.open_input_stream(base) as stream:
                    for name, ids in read_file(stream):
                        names.append(name)
                        starts.append(start)
                        blobs.append(ids.astype("<u4").tobytes())
                        start, held = start + len(ids), held + len(ids)
                        if held >= 1 << 20:
                            yield _batch(names, starts, blobs, packed)
                            names, starts, blobs, held = [], [], [], 0
                if names:
                    yield _batch(names, starts, blobs, packed)

    spread = by_path(files.select("path", "start"))
    return spread.mapInArrow(run, f"doc_id long, start long, ids {'binary' if packed else 'array<int>'}")


def _batch(names: list, starts: list, blobs: list, packed: bool) -> pa.RecordBatch:
    ids = pa.array(blobs, pa.binary()) if packed else bpe.id_lists(blobs)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(starts, pa.int64()), ids], names=["doc_id", "start", "ids"])


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit numbers.

    Columns of Spark's: the ids don't go to Python again, so a task has one worker, that of ``read``.
    ``ids`` may be packed or not; packed ones are digested as they are.
    """
    if rows.schema["ids"].dataType != T.BinaryType():
        def swapped(x):
            high_first = F.lpad(F.hex(x), 8, "0")
            return F.concat(*[F.substring(high_first, at, 2) for at in (7, 5, 3, 1)])

        rows = rows.withColumn("ids", F.unhex(F.array_join(F.transform("ids", swapped), "")))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return rows.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
