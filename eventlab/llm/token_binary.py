"""Token-ID output: fixed-width bit packing with block offsets.

A token folder is a Parquet table with one row per block.  A block holds the ids of whole
consecutive documents, each id in the minimum number of bits for the vocabulary, and carries
the documents' ids and the border of each document, so that a document is found by its
block's id range and unpacked alone.  Documents are in ascending id order over the files
(``part``) and the blocks of a file (``block``).

Null texts are empty and have only the end id.  Rows without a document id come first: a block
counts its leading ones in ``no_id`` (their places in ``doc_ids`` hold 0), its id range spans the
others, and reading gives null back.  Rows with equal ids are ordered by text hash and then text.  An empty table gives an empty folder.  Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import in_small_batches, portions, shared_path, table, utf8

FOLDER = "part int, block long, first_id long, last_id long, no_id long, bits int, start long, n long, doc_ids binary, ends binary, payload binary"
DIGEST = "part int, doc_id long, local long, n_tokens long, ids_crc32 long"
#: White space and punctuation marks before which texts are cut.
GAPS, MARKS = (" ", "\n", "\t", "\r"), b".,;:!?"
VISIBLE = np.arange(256) > 32
VISIBLE[127] = False
LETTER = np.isin(np.arange(256) & 0xDF, np.arange(65, 91)) & (np.arange(256) < 128)

#: Pieces that are encoded as one text, texts that the library takes at a time, bytes of texts looked at together, and letters of a piece that is remembered.
JOINED, BATCH, PORTION, SHORT = 100, 64, 4 << 20, 64


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids end to end, ``bits`` each, most significant bit first, eight at a time."""
    lanes = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    lanes[:len(ids)] = ids
    lanes = lanes.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        for byte in range(lane * bits // 8, (lane * bits + bits - 1) // 8 + 1):
            shift = (byte + 1) * 8 - (lane + 1) * bits
            column = lanes[:, lane]
            moved = column << np.uint64(shift) if shift >= 0 else column >> np.uint64(-shift)
            out[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(payload: bytes, bits: int, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (excluded), reading only the bytes that hold them."""
    low, high = first // 8, -(-last // 8)
    rows = np.frombuffer(payload, np.uint8)[low * bits:high * bits].reshape(-1, bits)
    out = np.zeros((len(rows), 8), np.uint64)
    for lane in range(8):
        for byte in range(lane * bits // 8, (lane * bits + bits - 1) // 8 + 1):
            shift = (byte + 1) * 8 - (lane + 1) * bits
            column = rows[:, byte].astype(np.uint64)
            out[:, lane] |= column >> np.uint64(shift) if shift >= 0 else column << np.uint64(-shift)
    out &= np.uint64((1 << bits) - 1)
    return out.reshape(-1)[first - low * 8:last - low * 8].astype("<u4")


def spans(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of the spans, one after another."""
    upto = np.cumsum(counts)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - upto + counts, counts)


def table_of(letters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(letters, np.uint8)] = True
    return out


def cut_points(data: np.ndarray, marks: bytes = MARKS) -> np.ndarray:
    """Bytes of UTF-8 texts before which a text may be cut.

    White space after a visible character: no token reaches over the point before it.  Neither
    does one reach from a letter A to Z to one of ``marks``.  Beyond ASCII, a character counts as
    visible if its first byte starts no white space.
    """
    visible = VISIBLE[data]
    beyond = data >= 128
    for back, leads in ((1, b"\xC2"), (2, b"\xE1\xE2\xE3")):
        visible[back:] &= ~(beyond[back:] & table_of(leads)[data[:-back]])
    gap = table_of("".join(GAPS).encode())[data]
    mark = table_of(marks)[data]
    return np.flatnonzero(gap[1:] & visible[:-1] | mark[1:] & LETTER[data[:-1]]) + 1


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers.

    A text is cut where no token can reach over: before white space or, after a letter, before a
    punctuation mark.  Each distinct piece is encoded once; at most ``keep`` short pieces are
    remembered.  New pieces are encoded many at a time, as one text, and told apart by the bytes
    of their tokens.
    """

    def __init__(self, path: str, keep: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self.size = self.tokenizer.get_vocab_size()
        names = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        self.bytes_of[list(names.values())] = [len(x) for x in names]  # a character of a byte-level name is a byte
        added = "".join(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = b"" if set(added) & set(MARKS.decode()) else MARKS  # an added token is never cut
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        found = []
        for i in range(0, len(texts), BATCH):
            found += [x.ids for x in self.tokenizer.encode_batch_fast(texts[i:i + BATCH], add_special_tokens=False)]
        return found

    def learn(self, pieces: list[str]) -> None:
        """Add the ids of new pieces."""
        # Only a piece that starts with white space and does not end in it can stand between others.
        inner = [x[:1] in GAPS and not x[-1:].isspace() for x in pieces]
        closed = [x for x, y in zip(pieces, inner) if y]
        alone = [x for x, y in zip(pieces, inner) if not y]
        found = self.ids_of(["".join(closed[i:i + JOINED]) for i in range(0, len(closed), JOINED)])
        ids = np.array(list(chain.from_iterable(found)), np.int64)
        until = np.cumsum([len(x.encode("utf-8")) for x in closed], dtype=np.int64)
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), until) + 1
        others = self.ids_of(alone)
        last = ends[-1] if len(ends) else 0
        more = last + np.cumsum([len(x) for x in others], dtype=np.int64)
        at = np.empty(len(pieces), np.int64)
        inner = np.array(inner, bool)
        at[inner], at[~inner] = np.arange(len(closed)), len(closed) + np.arange(len(alone))
        begins = np.concatenate([[0], ends, more])
        flat = np.concatenate([ids.astype("<u4"), np.array(list(chain.from_iterable(others)), "<u4")])
        first, count = begins[at], np.diff(begins)[at]
        self.ids = np.concatenate([self.ids, flat[spans(first, count)]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(count)])

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        data, borders = utf8(column)
        edge = np.zeros(len(data) + 1, bool)
        edge[cut_points(data, self.marks)] = True
        edge[borders] = True
        cuts = np.flatnonzero(edge)
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        slots = np.array([known.get(x, -1) for x in names], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(known) + len(new) > self.keep:
            self.forget()
            new, known = np.arange(len(names)), self.known
        new = sorted(new.tolist(), key=lambda k: len(names[k]) > SHORT)  # the long ones last
        if new:
            slots[new] = len(known) + np.arange(len(new))
            missing = [names[k] for k in new]
            self.learn(missing)
            known.update(zip([x for x in missing if len(x) <= SHORT], slots[new].tolist()))
        at = slots[pieces.indices.to_numpy()]
        count = self.ends[at + 1] - self.ends[at]
        found = self.ids[spans(self.ends[at], count)]
        upto = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(cuts, borders)]
        self.ends = self.ends[:len(known) + 1]  # the long ones go
        self.ids = self.ids[:self.ends[-1]]
        return [found[a:b].tobytes() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block: int) -> Iterator[pa.RecordBatch]:
    tokens = encoder(path)
    bits = max(1, int(tokens.size - 1).bit_length())
    part, number, start = TaskContext.get().partitionId(), 0, 0
    ids: list[int | None] = []
    held: list[bytes] = []
    size = 0
    end = np.array([end_id], "<u4").tobytes()

    def row() -> pa.RecordBatch:
        ends = np.cumsum([len(x) // 4 for x in held]).astype("<i8")
        no_id = ids.count(None)  # sorted first
        values = {"part": part, "block": number, "first_id": ids[no_id] if no_id < len(ids) else None, "last_id": ids[-1], "no_id": no_id, "bits": bits, "start": start, "n": int(ends[-1]),
                  "doc_ids": np.array([0] * no_id + ids[no_id:], "<i8").tobytes(), "ends": ends.tobytes(),
                  "payload": pack(np.frombuffer(b"".join(held), "<u4"), bits)}
        return pa.RecordBatch.from_pylist([values], schema=FIELDS)

    for batch in batches:
        for first, last in portions(utf8(batch["text"])[1], PORTION):
            some = batch.slice(first, last - first)
            for doc, text in zip(some["doc_id"].to_pylist(), tokens.encode(some["text"])):
                ids.append(doc)
                held.append(text + end)
                size += len(text) // 4 + 1
                if size >= block:
                    yield row()
                    start, number, ids, held, size = start + size, number + 1, [], [], 0
    if ids:
        yield row()


FIELDS = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("no_id", pa.int64()), ("bits", pa.int32()),
                    ("start", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.binary()), ("ends", pa.binary()), ("payload", pa.binary())])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, block: int = 1 << 16, text: str = "text", key: str = "doc_id") -> None:
    """Encode every text and write the ids in ascending ``key`` order, about ``block`` to a row.

    The texts are cut into key ranges and sorted before they are encoded, so the sampling for
    the ranges encodes nothing.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("_h", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", "text").select("doc_id", "text")
    in_small_batches(rows).mapInArrow(partial(packed, path=tokenizer, end_id=end_id, block=block), FOLDER).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FOLDER).parquet(folder)


def document_ids(spark: SparkSession, folder: str, doc_id: int | None) -> list[np.ndarray]:
    """Random access: the ids of the documents with this id (None: without one), from the blocks that may hold it."""
    found = []
    where = F.col("no_id") > 0 if doc_id is None else (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    for row in blocks(spark, folder).where(where).orderBy("part", "block").collect():
        ends = np.frombuffer(row.ends, "<i8")
        held = np.frombuffer(row.doc_ids, "<i8")
        for at in range(row.no_id) if doc_id is None else row.no_id + np.flatnonzero(held[row.no_id:] == doc_id):
            found.append(unpack(row.payload, row.bits, int(ends[at - 1]) if at else 0, int(ends[at])))
    return found


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.frombuffer(row["ends"], "<i8")
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            ids = memoryview(unpack(row["payload"], row["bits"], 0, row["n"]).tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ends), row["part"], np.int32)), pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.arange(len(ends)) < row["no_id"]),
                pa.array(row["start"] + begins), pa.array(ends - begins),
                pa.array([zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(begins, ends)], pa.int64())],
                names=["part", "doc_id", "local", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """From the files: each document's place among all ids, its length and its checksum."""
    rows = blocks(spark, folder)
    files = rows.groupBy("part").agg(F.sum("n").alias("n"))  # one row per written file
    later = files.select(F.col("part").alias("_p"), "n")
    before = files.select("part").join(F.broadcast(later), F.col("_p") < F.col("part"), "left").groupBy("part").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before"))
    each = rows.select("part", "no_id", "bits", "start", "n", "doc_ids", "ends", "payload").mapInArrow(digests, DIGEST)
    return each.join(before, "part").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_binary(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's ids written and read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer)
    return read_digests(spark, folder)
