"""Token-id files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

``write`` range-partitions documents by id, encodes every whole text, appends the end id and lets each
partition write its own pair of files: ``.bin`` holds the ids as little-endian unsigned integers (16 bits
if the vocabulary fits, else 32), ``.idx`` the offsets of its documents (64 bits) and their ids. The tasks
return only their totals; an exclusive prefix sum over these is every partition's base, kept in
``index.json`` together with the file names. ``read`` maps the files and adds base and offset.

There are as many ranges as shuffle partitions, and more where a range would hold above ``FILE_BYTES`` of text
on average, so that files do not grow with the corpus. Ranges are cut by id and the first ``PREFIX`` characters
of the text: rows without an id, or of one repeated id, are split too, unless their texts begin alike.

A task names its files after its attempt and the index lists those of the attempts that ended, so a
lost or repeated attempt leaves at most an unlisted file. Files go through pyarrow's file systems, to
whichever shared store the folder names.

The tokenizers library encodes every distinct word once while a task remembers it (a bounded table). Words
are cut only where the vocabulary's own rule always cuts: before a single space between two other
characters, and around a run of letters, stops or a single line break next to one of these. All else
stays together. A run of letters or of stops is one piece of the vocabulary's own cut and goes straight to
the library's model, in the byte alphabet of byte-level vocabularies; other words are encoded as texts.

The string of an added token of the file (such as ``<|endoftext|>``) within a text: with ``added``, as in
``summary``, it becomes that token as in the library's own encoding, and a text that holds one goes to the
library whole; without, it is ordinary text.

Defined results: a NULL text counts as empty and is the end id alone; NULL ids come first; rows of equal
id are ordered by text; an empty table gives an index without files; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_chars, scratch_path

END = 0
MAGIC = b"CLTOKID1"
WORDS, CHARS, IDS = 800_000, 1_000_000, 4_000_000
FILE_BYTES, PREFIX = 256 << 20, 64
# Latin letters, and stops that belong to no contraction.
LETTER, STOP = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
WORD = re.compile(rf" ?[{LETTER}]+(?=[ {STOP}\n]|\Z)|[{STOP}]+(?=[ \n]|\Z)|\n(?=\S)| ?[^ ]+")
SPACES = re.compile(r"\s\s|\s\Z")                 # white space that the pattern above does not treat
ANY_WORD = re.compile(r"(?<=\S)(?= \S)")
PIECE = re.compile(rf" ?(?:[{LETTER}]+|[{STOP}]+)")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Table(dict):
    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, word):
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Encodes batches of texts with a tokenizers file (its JSON as a string); ``added``: see above."""

    def __init__(self, tokenizer: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = not added
        strings = [re.escape(x["content"]) for x in json.loads(tokenizer).get("added_tokens") or []] if added else []
        self.added = re.compile("|".join(strings) or r"(?!)")
        #: Letters, stops and the space in the byte alphabet: a printable byte is itself, the others
        #: follow from U+0100 on in their order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        self.alphabet = {c: "".join(byte[b] for b in chr(c).encode()) for c in range(256)}
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._forget()

    def _forget(self) -> None:
        self.words, self.start, self.count = _Table(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _learn(self) -> None:
        """Encodes the words met for the first time."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        model, got = self.tokenizer.model, []
        for w in new:
            if PIECE.fullmatch(w) and not self.added.search(w):
                got.append([t.id for t in model.tokenize(w.translate(self.alphabet))])
            else:
                got.append(self.tokenizer.encode(w, add_special_tokens=False).ids)
        size = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), self.dtype, int(size.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros_like(self.pool)]
        self.pool[self.used:self.used + len(flat)] = flat
        self.start = np.r_[self.start, self.used + np.cumsum(size) - size]
        self.count = np.r_[self.count, size]
        self.used += len(flat)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        if len(self.words) > WORDS:
            self._forget()
        split = [[t] if self.added.search(t) else WORD.findall(t) if not SPACES.search(t) else ANY_WORD.split(t) for t in texts]
        n = np.array([len(x) for x in split], np.int64)
        number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        self._learn()
        count, start = self.count[number], self.start[number]
        end = np.cumsum(count)
        total = np.r_[0, end][np.cumsum(n)]
        ids = self.pool[np.repeat(start - (end - count), count) + np.arange(count.sum())]
        size = np.diff(np.r_[0, total])
        return np.insert(ids, total, END), size + 1


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, added: bool) -> Encoder:
    """One encoder a worker process: its table of words serves the tasks that come after."""
    return Encoder(tokenizer, added)


def _qualified(spark: SparkSession, path: str) -> str:
    """The folder with its scheme, as the session's Hadoop configuration resolves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().replace("file:/", "file:///", 1) \
        if not path.startswith("file:///") else path


def _arrow_uri(uri: str) -> str:
    """Hadoop's names of an S3 store as pyarrow's."""
    scheme, sep, rest = uri.partition("://")
    return "s3://" + rest if sep and scheme in ("s3a", "s3n") else uri


def _store(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(_arrow_uri(uri))


def write(docs: DataFrame, path: str, tokenizer: str | None = None, added: bool = False) -> None:
    """Encodes ``docs`` (doc_id, text) and writes files and index to the new folder ``path``."""
    spark = docs.sparkSession
    uri = _qualified(spark, path)
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as f:
        model = f.read()
    fs, folder = _store(uri)
    fs.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, fs, bin_file = None, None, None
        name = f"{part:06d}-{uuid.uuid4().hex}"
        sizes, ids, named = [], [], []
        for b in batches:
            if not b.num_rows:
                continue
            if encoder is None:
                encoder = _encoder(model, added)
                fs, folder = _store(uri)
                bin_file = fs.open_output_stream(f"{folder}/{name}.bin")
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in by_chars(texts, CHARS):
                flat, size = encoder.encode(texts[i:j])
                bin_file.write(flat.astype(encoder.dtype).tobytes())
                sizes.append(size)
            ids.append(b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            named.append(b.column(0).is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))
        if encoder is None:
            return
        bin_file.close()
        offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype("<i8")
        n = len(offsets) - 1
        with fs.open_output_stream(f"{folder}/{name}.idx") as f:
            f.write(MAGIC + np.array([n], "<i8").tobytes())
            for x in (offsets, np.concatenate(ids), np.concatenate(named)):
                f.write(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([name]), pa.array([encoder.dtype]), pa.array([n]), pa.array([int(offsets[-1])])],
            ["part", "name", "dtype", "docs", "ids"])

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    by_id = F.col("doc_id").asc_nulls_first()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        n_parts, by_id, F.substring("text", 1, PREFIX)).sortWithinPartitions(by_id, "text")
    done = sorted(rows.mapInArrow(run, "part long, name string, dtype string, docs long, ids long").collect())
    bases = list(accumulate((r.ids for r in done), initial=0))
    index = {"files": [r.asDict() | {"base": base} for r, base in zip(done, bases[:-1], strict=True)],
             "ids": bases[-1], "documents": sum(r.docs for r in done)}
    with fs.open_output_stream(f"{folder}/index.json") as f:
        f.write(json.dumps(index).encode())


def _mapped(fs, path: str) -> pa.Buffer:
    """A file's bytes: mapped where the store is a mounted folder, read otherwise."""
    from pyarrow.fs import LocalFileSystem
    if isinstance(fs, LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def documents(uri: str, file: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of every document of one pair of files, the ids as a view of the file."""
    fs, folder = _store(uri)
    idx = _mapped(fs, f"{folder}/{file['name']}.idx")
    if idx.slice(0, 8).to_pybytes() != MAGIC:
        raise ValueError(f"not an index of token ids: {file['name']}")
    n = int(np.frombuffer(idx, "<i8", 1, 8)[0])
    offsets, ids = np.frombuffer(idx, "<i8", n + 1, 16), np.frombuffer(idx, "<i8", n, 16 + 8 * (n + 1))
    named = np.frombuffer(idx, np.uint8, n, 16 + 8 * (2 * n + 1))
    flat = np.frombuffer(_mapped(fs, f"{folder}/{file['name']}.bin"), file["dtype"])
    for i in range(n):
        yield int(ids[i]) if named[i] else None, file["base"] + int(offsets[i]), flat[offsets[i]:offsets[i + 1]]


def read_index(uri: str) -> dict:
    fs, folder = _store(uri)
    with fs.open_input_file(f"{folder}/index.json") as f:
        return json.loads(f.read())


def _per_file(spark: SparkSession, path: str, make, schema: str) -> DataFrame:
    """One task per pair of files; ``make`` turns their documents into batches."""
    uri = _qualified(spark, path)
    files = read_index(uri)["files"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                yield from make(documents(uri, files[i]))

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, from the files."""

    def make(docs) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in docs:
            rows.append(row)
            size += len(row[2])
            if size > IDS:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    def batch(rows) -> pa.RecordBatch:
        doc_id, start, ids = zip(*rows, strict=True)
        ends = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
        flat = pa.array(np.concatenate(ids).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()),
                                           pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "start", "ids"])

    return _per_file(spark, path, make, "doc_id long, start long, ids array<long>")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def make(docs) -> Iterator[pa.RecordBatch]:
        rows = [(i, start, len(x), zlib.crc32(x.astype("<u4").tobytes())) for i, start, x in docs]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _per_file(spark, path, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def summary(docs: DataFrame) -> DataFrame:
    """Writes ``docs`` to a new shared folder and returns ``checksums`` of what stands there."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, added=True)
    return checksums(docs.sparkSession, path)
