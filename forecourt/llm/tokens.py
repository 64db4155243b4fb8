"""Token ids in bit-packed binary files.

Documents are range-partitioned by number, so each task encodes one ascending
stretch and writes it as one file; the manifest (one row a file) is the
committed result.  A file's name holds the number of the task attempt: what a
lost or repeated attempt leaves behind is in no manifest.

File layout, little-endian:

    body      blocks of BLOCK ids (the last may be shorter), each id in `bits`
              bits, lowest bit first; a block starts on a byte
    index     offsets of the blocks in the body (uint64, one more than blocks),
              document numbers (int64), presence of the numbers (uint8),
              first id of each document (uint64, one more than documents)
    trailer   bits, BLOCK, documents, ids, length of the body (uint64 each), MAGIC

A block is unpacked by numpy at once, and any id or document can be read alone:
its block's place follows from the index.

Encoding is by distinct word.  White space never joins two words' tokens, A-Z
are lower-cased by the vocabulary itself, and a run of `.` or `,` after an ASCII
letter or digit is a piece of its own; so words are brought to that form, each
distinct one is encoded by the tokenizers library once, and documents are put
together from the ids with numpy.  The vocabulary's own special strings stand for
their ids wherever a text spells them, as the library has it: they cut a text into
stretches before anything is lower-cased.

Defined cases: a null or empty text is its end id alone; null numbers come first;
rows of one number are ordered by a hash of their text; an empty table gives no
files and no rows; a very long text is encoded whole, in portions of no other text;
columns of the input besides number and text, whatever their names, are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging, words

BLOCK = 1 << 16
MAGIC = b"bitpack1"
CACHE_WORDS = 1 << 20
#: Bytes of text encoded at once; the arrays meanwhile take about sixty times as much.
PORTION = 1 << 20
MANIFEST_DDL = "shard INT, path STRING, n_docs BIGINT, n_ids BIGINT"


# --- bit packing ---------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(body: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of a packed block."""
    raw = np.zeros((n, 4), np.uint8)
    if bits % 8 == 0:
        raw[:, : bits // 8] = np.frombuffer(body, np.uint8, n * bits // 8).reshape(n, bits // 8)
    else:
        flat = np.unpackbits(np.frombuffer(body, np.uint8), count=n * bits, bitorder="little")
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :bits] = flat.reshape(n, bits)
        raw = np.packbits(wide, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


class Writer:
    """One file; blocks leave memory as they fill."""

    def __init__(self, stream, bits: int) -> None:
        self.stream, self.bits = stream, bits
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.blocks, self.numbers, self.present, self.lengths = [0], [], [], []

    def add(self, numbers: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.numbers.append(np.array([n or 0 for n in numbers], "<i8"))
        self.present.append(np.array([n is not None for n in numbers], np.uint8))
        self.lengths.append(lengths)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            body = pack(ids[at: min(at + BLOCK, whole)], self.bits)
            self.stream.write(body)
            self.blocks.append(self.blocks[-1] + len(body))
        self.waiting = [ids[whole:].copy()]
        self.n_waiting = len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        lengths = np.concatenate([np.zeros(0, np.int64), *self.lengths])
        first = np.concatenate([[0], np.cumsum(lengths)])
        self.stream.write(np.array(self.blocks, "<u8").tobytes())
        self.stream.write(np.concatenate([np.zeros(0, "<i8"), *self.numbers]).tobytes())
        self.stream.write(np.concatenate([np.zeros(0, np.uint8), *self.present]).tobytes())
        self.stream.write(first.astype("<u8").tobytes())
        self.stream.write(np.array([self.bits, BLOCK, len(lengths), self.n_ids, self.blocks[-1]], "<u8").tobytes())
        self.stream.write(MAGIC)


class Reader:
    """Random access to one file."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        trailer = stream.read_at(48, size - 48)
        if trailer[40:] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, self.n_docs, self.n_ids, body = np.frombuffer(trailer, "<u8", 5).tolist()
        n_blocks = -(-self.n_ids // self.block)
        index = stream.read_at(size - 48 - body, body)
        self.offsets = np.frombuffer(index, "<u8", n_blocks + 1).astype(np.int64)
        at = 8 * (n_blocks + 1)
        numbers = np.frombuffer(index, "<i8", self.n_docs, at)
        present = np.frombuffer(index, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.numbers = [int(n) if p else None for n, p in zip(numbers, present, strict=True)]
        self.first = np.frombuffer(index, "<u8", self.n_docs + 1, at + 9 * self.n_docs).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the file; only their blocks are read."""
        if a >= b:
            return np.zeros(0, np.uint32)
        one, other = a // self.block, (b - 1) // self.block
        begin = int(self.offsets[one])
        body = self.stream.read_at(int(self.offsets[other + 1]) - begin, begin)
        parts = []
        for k in range(one, other + 1):
            n = min(self.block, self.n_ids - k * self.block)
            parts.append(unpack(body[int(self.offsets[k]) - begin: int(self.offsets[k + 1]) - begin], n, self.bits))
        return np.concatenate(parts)[a - one * self.block: b - one * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.first[k]), int(self.first[k + 1]))


# --- encoding ------------------------------------------------------------------

@dataclass
class Encoder:
    """Ids of texts by distinct word; one for each worker process."""

    path: str

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(self.path)
        # The library sees words alone, lower-cased: what spells a special string by then is ordinary text.
        self.library.encode_special_tokens = True
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip
               for t in self.library.get_added_tokens_decoder().values()):
            raise ValueError("special strings that depend on what stands beside them are not supported")
        self.special = {text.encode(): i for text, i in added.items() if text}
        choice = b"|".join(re.escape(text) for text in sorted(self.special, key=len, reverse=True))
        self.spelled, self.spelled_anywhere = re.compile(choice), re.compile(b"(?=" + choice + b")")
        self.forget()

    @property
    def vocabulary(self) -> int:
        return self.library.get_vocab_size()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.counts = np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text)."""
        starts, ends, found = self.spellings(data, offsets)
        if not len(starts):
            return self.encode_words(data, offsets)
        # Stretches between special strings are texts of their own; one of a special string alone is its id.
        cuts = np.unique(np.concatenate([starts, ends, offsets]))
        special = np.full(len(cuts) - 1, -1, np.int64)
        special[np.searchsorted(cuts, starts)] = found
        lengths = np.diff(cuts)
        plain = special < 0
        ids, counts = self.encode_words(
            data[np.repeat(plain, lengths)], np.concatenate([[0], np.cumsum(lengths[plain])]))
        every = np.ones(len(special), np.int64)
        every[plain] = counts
        out = np.empty(int(every.sum()), np.uint32)
        of_words = np.repeat(plain, every)
        out[of_words], out[~of_words] = ids, special[~plain]
        total = np.concatenate([[0], np.cumsum(every)])[np.searchsorted(cuts, offsets)]
        return out, np.diff(total)

    def spellings(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, ids) of the special strings in the texts."""
        out = []
        held = data.tobytes()
        if any(text in held for text in self.special):
            at = np.array([m.start() for m in self.spelled_anywhere.finditer(held)], np.int64)
            for doc in np.unique(words.owner(at, offsets)).tolist():
                base = int(offsets[doc])
                body = held[base: int(offsets[doc + 1])]
                out += [(base + m.start(), base + m.end(), self.special[m[0]]) for m in self.spelled.finditer(body)]
        return tuple(np.array(out, np.int64).reshape(-1, 3).T)

    def encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode, for texts without special strings."""
        data = words.lowered(data)
        starts, ends = words.spans(data, offsets, words.SPACED)
        starts, ends = split_stops(data, starts, ends)
        keys = words.fingerprints(data, starts, ends)
        distinct, place, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.forget()
        rows = np.array([self.known.get(k, -1) for k in distinct.tolist()], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = place[new]
            texts = [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[at], ends[at], strict=True)]
            found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            rows[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(distinct[new].tolist(), rows[new].tolist(), strict=True))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32)])
            self.counts = np.concatenate([self.counts, np.array([len(f) for f in found], np.int64)])
        begin = np.cumsum(self.counts) - self.counts
        row = rows[back]
        counts = self.counts[row]
        ids = self.flat[np.repeat(begin[row], counts) + words.ramp(counts)]
        docs = words.owner(starts, offsets)
        return ids, words.sums(counts, docs, len(offsets) - 1)


_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True


def split_stops(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one full stop or comma right after an ASCII letter or digit at their end cut before it."""
    last = ends - 1
    cut = (ends - starts > 1) & _STOP[data[last]] & _PLAIN[data[np.maximum(last - 1, 0)]]
    pieces = np.where(cut, 2, 1)
    at = np.cumsum(pieces) - pieces
    out_starts = np.empty(int(pieces.sum()), np.int64)
    out_ends = np.empty_like(out_starts)
    out_starts[at], out_ends[at] = starts, np.where(cut, last, ends)
    out_starts[at[cut] + 1], out_ends[at[cut] + 1] = last[cut], ends[cut]
    return out_starts, out_ends


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- files ---------------------------------------------------------------------

def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode docs into files below `folder` in ascending order of key; the manifest, one row a file."""
    body = docs.select(staging.quoted(key).cast("long").alias("id"), staging.quoted(text).cast("string").alias("body"))
    order = [F.col("id"), F.xxhash64("body")]
    placed = body.repartitionByRange(*order).sortWithinPartitions(*order)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        batch = next(batches, None)
        if batch is None:
            return
        made = encoder(tokenizer)
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        n_docs = 0
        with system.open_output_stream(f"{base}/{name}") as stream:
            writer = Writer(stream, bits_for(made.vocabulary))
            while batch is not None:
                numbers = batch.column(0).to_pylist()
                data, offsets = words.flat(batch.column(1))
                for a, b in words.portions(offsets, PORTION):
                    ids, lengths = made.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                    closed = np.full(len(ids) + len(lengths), end_id, np.uint32)
                    closed[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
                    writer.add(numbers[a:b], lengths + 1, closed)
                    n_docs += b - a
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_arrays([
            pa.array([task.partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]),
            pa.array([n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64()),
        ], names=["shard", "path", "n_docs", "n_ids"])

    return staging.stage(placed.mapInArrow(store, MANIFEST_DDL), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spread = staging.running_total(manifest, [F.col("shard")], "n_ids", "base")
    files = spread.select("path", "base").repartition(max(1, manifest.count()))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as stream:
                    reader = Reader(stream)
                    for a in range(0, reader.n_docs, 4096):
                        b = min(a + 4096, reader.n_docs)
                        first = reader.first[a: b + 1]
                        held = reader.ids(int(first[0]), int(first[-1])).tobytes()
                        at = (first - first[0]) * 4
                        sums = [zlib.crc32(held[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(reader.numbers[a:b], pa.int64()), pa.array(first[:-1] + base),
                            pa.array(np.diff(first)), pa.array(sums, pa.int64()),
                        ], names=["id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(load, "id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs written as token files in a new shared folder and read back."""
    folder = staging.shared_folder(docs.sparkSession, "tokens")
    return read(write(docs, staging.address(docs.sparkSession, folder), tokenizer))


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table through the files and back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded(docs, public_vocabulary()).withColumnRenamed("id", "doc_id")
