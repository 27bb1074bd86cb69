"""Token ids in Arrow files of equal-length sequences (operator 1).

One file holds a run of documents in order, their ids packed without gaps into sequences of
``length`` ids. It is an Arrow IPC file with the fixed-size-list columns ``ids`` (uint16 if the
vocabulary allows, else uint32) and ``mask`` (bool, false on the padding after the last id), so any
sequence is a slice of the mapped file. Beside it an index file (``doc_id``, ``start`` within the file,
``n_tokens``) tells where each document lies.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from closebook.llm.common import keep
from closebook.session import scratch_path

LENGTH = 2048  # ids in a sequence
BATCH = 256  # sequences in a record batch
END = 2  # appended to each document
CACHED = 700_000  # pieces of text whose ids a worker remembers, in each of two generations
LONGEST = 48  # of these, in characters
CUT = re.compile(r" (?=[!-~])")
UNSURE = re.compile(r" (?:\s|$)")


class Encoder:
    """Ids of whole texts, as the tokenizer itself gives them without special tokens.

    Its pattern always starts a new unit at a blank that is followed by another character than
    white space, and a unit's ids depend on nothing else; so texts are cut there and the ids of a
    piece are remembered. New pieces are encoded together: as blanks occur only at their starts, the ids
    that begin with a blank tell them apart. A text that holds the string of one of the vocabulary's added tokens
    is encoded as a whole, since such a token may swallow what stands beside it.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        blank = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.opens = np.zeros(size, dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number] = token.startswith(blank)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _pieces(self, text: str) -> list[str]:
        if any(content in text for content in self.added):
            return [text]
        return CUT.split(text) if UNSURE.search(text) else text.split(" ")

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of new pieces without blanks, each with a blank before it."""
        if self.older:
            again = pieces.intersection(self.older)
            self.known.update((p, self.older[p]) for p in again)
            pieces = pieces - again
        pieces = {p for p in pieces if len(p) <= LONGEST and " " not in p}
        listed = list(pieces)
        for start in range(0, len(listed), 4096):
            part = listed[start : start + 4096]
            found = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype=self.dtype)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(part):
                raise ValueError("the tokenizer does not start a unit at a blank")
            data, size = ids.tobytes(), self.dtype().itemsize
            ends = [*(starts[1:] * size).tolist(), len(data)]
            self.known.update((p, data[a:b]) for p, a, b in zip(part, (starts * size).tolist(), ends, strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes (null: none)."""
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        cut = [self._pieces("" if t is None else t) for t in texts]
        opening = [pieces.pop(0) for pieces in cut]
        new = set().union(*cut).difference(self.known)
        if new:
            self._learn(new)
        made = []
        for first, pieces in zip(opening, cut, strict=True):
            head = self.heads.get(first)
            if head is None:
                head = self._plain(first)
                if len(first) <= LONGEST and len(self.heads) < CACHED // 10:
                    self.heads[first] = head
            try:
                ids = b"".join(map(self.known.__getitem__, pieces))
            except KeyError:  # some pieces are too long to be remembered
                ids = b"".join([self.known[p] if p in self.known else self._plain(" " + p) for p in pieces])
            made.append(head + ids)
        return made


@cache
def encoder(path: str) -> Encoder:
    """One per worker process, so that what it remembers serves all its tasks."""
    return Encoder(path)


def _schema(dtype: type, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


def _sequences(ids: np.ndarray, length: int) -> pa.RecordBatch:
    """Sequences of some ids; the last is padded."""
    n = -(-len(ids) // length)
    padded = np.zeros(n * length, dtype=ids.dtype)
    padded[: len(ids)] = ids
    mask = np.arange(n * length) < len(ids)
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), length) for v in (padded, mask)]
    return pa.RecordBatch.from_arrays(columns, schema=_schema(ids.dtype.type, length))


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
FILES = "part int, path string, length int, n_docs long, n_tokens long"


def write(
    docs: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END
) -> DataFrame:
    """Encode all documents into files in ``folder``; one row per file, in order of ``part``.

    Documents come in ascending id (nulls first), equal ids in the order of a hash of the text and then the text;
    a null text is empty and each document has the id ``end`` appended, so none is without ids.
    Other columns are ignored. An empty table gives no file. Folder and tokenizer must be readable
    from every executor; the folder's scheme is one that Arrow knows (file, hdfs, s3, gs).

    A task writes its partition under a name of its own and its result row names that file, so a
    repeated or lost attempt leaves a file that no row names and nothing refers to. Documents
    are held one record batch at a time.
    """
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    narrow = narrow.withColumn("hash", F.xxhash64("text"))
    order = ["doc_id", "hash", "text"]
    sorted_docs = narrow.repartitionByRange("doc_id", "hash").sortWithinPartitions(*order)
    sorted_docs = sorted_docs.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        store, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        writers: list = []
        rest, total, rows, part, name = np.zeros(0, encode.dtype), 0, 0, None, ""
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if part is None:
                    part = batch.column("part")[0].as_py()
                    name = f"{part:06d}-{uuid.uuid4().hex}"
                    store.create_dir(root, recursive=True)
                    for kind, schema in (("arrow", _schema(encode.dtype, length)), ("index", INDEX)):
                        sink = store.open_output_stream(f"{root}/{name}.{kind}")
                        writers += [pa.ipc.new_file(sink, schema), sink]
                made = [i + encode.dtype(end).tobytes() for i in encode.encode(batch.column("text").to_pylist())]
                sizes = np.array([len(i) for i in made]) // encode.dtype().itemsize
                starts = total + np.cumsum(sizes) - sizes
                writers[2].write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(sizes)], schema=INDEX))
                total, rows = total + int(sizes.sum()), rows + len(made)
                ids = np.concatenate((rest, np.frombuffer(b"".join(made), dtype=encode.dtype)))
                whole = len(ids) // (length * BATCH) * length * BATCH
                for k in range(0, whole, length * BATCH):
                    writers[0].write_batch(_sequences(ids[k : k + length * BATCH], length))
                rest = ids[whole:].copy()
            if part is not None and len(rest):
                writers[0].write_batch(_sequences(rest, length))
        finally:
            for writer in writers:
                writer.close()
        if part is not None:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": f"{folder}/{name}", "length": length, "n_docs": rows, "n_tokens": total}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("length", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    return keep(sorted_docs.mapInArrow(run, FILES), "token-files")


class TokenFile:
    """Random access to a file of sequences: what is not asked for is not read."""

    def __init__(self, path: str) -> None:
        store, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        if isinstance(store, pafs.LocalFileSystem):
            opened = [pa.memory_map(f"{name}.{kind}") for kind in ("arrow", "index")]
        else:
            opened = [store.open_input_file(f"{name}.{kind}") for kind in ("arrow", "index")]
        self.file, self.index = (pa.ipc.open_file(f) for f in opened)
        self.length = self.file.schema.field("ids").type.list_size

    def _batch(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids as a view of the file, and the mask, of one record batch."""
        batch = self.file.get_batch(number)
        return batch.column("ids").flatten().to_numpy(), batch.column("mask").flatten().to_numpy(zero_copy_only=False)

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        ids, mask = self._batch(number // BATCH)
        at = number % BATCH * self.length
        return ids[at : at + self.length], mask[at : at + self.length]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, start and ids of each document; one record batch is held at a time."""
        number, begin, held = -1, 0, np.zeros(0, np.uint16)
        for k in range(self.index.num_record_batches):
            batch = self.index.get_batch(k)
            for doc, start, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts, at = [], start
                while at < start + n:
                    if number < 0 or at >= begin + len(held):
                        number += 1
                        begin += len(held)
                        ids, mask = self._batch(number)
                        held = ids[: np.count_nonzero(mask)]
                        continue
                    parts.append(held[at - begin : start + n - begin])
                    at += len(parts[-1])
                yield doc, start, parts[0] if len(parts) == 1 else np.concatenate(parts)


def read(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids before it in all files), ``n_tokens`` and ``ids_crc32`` per document, from the files.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = keep(files.withColumn("offset", before), "token-offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for file in batch.to_pylist():
                rows: list[tuple] = []
                for doc, start, ids in TokenFile(file["path"]).documents():
                    rows.append((doc, start + file["offset"], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)
                        rows = []
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    # By number, which adaptive execution does not merge: rows are few and short, but each stands for a whole file.
    return listed.repartition(max(1, listed.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(docs: DataFrame) -> str:
    return scratch_path(docs.sparkSession, "llm-tokens")
