"""Documents packed into blocks, and questions that all blocks put to each other.

A block is one row: the bytes of some megabytes of whole documents.  A pass
over the blocks asks about fingerprints ("does this one occur elsewhere?").  The
questions of a block go to ranges of the fingerprint space, each block's
repeats merged first, so that a frequent fingerprint costs one entry a block.
One range at a time is sorted in one task; ranges are as many as the data need.
The answers come back as one bit an entry and join the stored blocks on the
block's number, which is what they are bucketed by: texts never move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging, words

BLOCK_BYTES = 4 << 20
RANGE_BYTES = 64 << 20
#: Stands for a missing document number: after all others, and before none.
NO_ID = np.iinfo(np.int64).max

_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("body", pa.large_binary())])
_BLOCK_DDL = "block BIGINT, ids ARRAY<BIGINT>, lengths ARRAY<BIGINT>, body BINARY"
_ASK_DDL = "block BIGINT, part INT, fingerprints BINARY, low BINARY, high BINARY"
_ASK = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("fingerprints", pa.binary()),
                  ("low", pa.binary()), ("high", pa.binary())])
_BITS_DDL = "block BIGINT, part INT, bits BINARY"
_BITS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        ids = batch.column(0)
        data, offsets = words.flat(batch.column(1))
        for a, b in words.portions(offsets, BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([
                pa.array([task + made], pa.int64()),
                pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                pa.array([np.diff(offsets[a: b + 1])], pa.list_(pa.int64())),
                pa.array([data[offsets[a]: offsets[b]].tobytes()], pa.large_binary()),
            ], schema=_BLOCK)
            made += 1


def pack(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """The stored blocks of docs; a null text is empty."""
    rows = docs.select(staging.quoted(key).cast("long").alias("id"), staging.quoted(text).cast("string").alias("text"))
    return staging.stage_by(rows.mapInArrow(_pack, _BLOCK_DDL), "block", name)


class Block:
    """One block of documents as arrays."""

    def __init__(self, row: dict) -> None:
        self.number: int = row["block"]
        self.ids: list[int | None] = row["ids"]
        self.data = np.frombuffer(row["body"], np.uint8)
        self.offsets = np.zeros(len(self.ids) + 1, np.int64)
        np.cumsum(np.asarray(row["lengths"], np.int64), out=self.offsets[1:])
        self.rounds = [unpacked(row[c]) for c in sorted(row) if c.startswith("round")]

    @property
    def order(self) -> np.ndarray:
        """Document numbers to compare."""
        return np.array([NO_ID if i is None else i for i in self.ids], np.int64)


def unpacked(answers: list[dict] | None) -> np.ndarray:
    """The bits of one pass, in the order of the sorted fingerprints."""
    held = sorted(answers or [], key=lambda a: a["part"])
    parts = []
    for a in held:
        size = int.from_bytes(a["bits"][:8], "little")
        parts.append(np.unpackbits(np.frombuffer(a["bits"], np.uint8, offset=8), count=size))
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])


def total_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0


def parts_for(blocks: DataFrame, n_bytes: float) -> int:
    """How many ranges keep one range's questions near RANGE_BYTES, and all cores busy."""
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(n_bytes / RANGE_BYTES) + 1)


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane: equal high bytes vanish in the shuffle's compression."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(held: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(8, -1).T).view(kind).ravel()


def gaps(keys: np.ndarray) -> bytes:
    """Ascending fingerprints as planes of their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def from_gaps(held: bytes) -> np.ndarray:
    return np.cumsum(from_planes(held, np.uint64), dtype=np.uint64)


Asker = Callable[[Block], tuple[np.ndarray, np.ndarray, np.ndarray]]


def ask(blocks: DataFrame, asker: Asker, rule: str, parts: int) -> DataFrame:
    """One row (block, answers) for each block that asked.

    asker gives, for a block, its sorted distinct fingerprints with a low and a
    high number each.  rule says when an entry's bit is set, over all entries of
    its fingerprint: `twice` (the lows add up to two or more), `shared` (the least
    low is below the greatest high) or `earlier` (some low is below its own).
    """

    def packed(numbers: np.ndarray) -> bytes:
        return planes(numbers) if numbers.dtype == np.int64 else numbers.tobytes()

    def submit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.uint64((2**64 - 1) // parts + 1)
        for block in blocks_of(batches):
            keys, low, high = asker(block)
            if not len(keys):
                continue
            part = (keys // width).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part)) + 1
            edges = [0, *cuts.tolist(), len(keys)]
            rows = [(block.number, int(part[a]), gaps(keys[a:b]), *(packed(x[a:b]) for x in (low, high)))
                    for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ASK, strict=True)], schema=_ASK)

    def judge(table: pa.Table) -> pa.Table:
        return _judged(table, rule)

    asked = blocks.mapInArrow(submit, _ASK_DDL)
    return (
        asked.groupBy("part").applyInArrow(judge, _BITS_DDL)
        .groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("answers"))
    )


def _judged(table: pa.Table, rule: str) -> pa.Table:
    """The bits of one range of fingerprints."""
    def numbers(name: str) -> np.ndarray:
        return np.concatenate([from_planes(x, np.int64) for x in table.column(name).to_pylist()])

    held = [from_gaps(x) for x in table.column("fingerprints").to_pylist()]
    sizes = [len(x) for x in held]
    keys = np.concatenate(held)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(keys))))
    if rule == "twice":
        low = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("low").to_pylist()])
        verdict = (np.add.reduceat(low[order].astype(np.int64), begins) >= 2)[group]
    else:
        low = numbers("low")[order]
        least = np.minimum.reduceat(low, begins)
        if rule == "shared":
            verdict = (least < np.maximum.reduceat(numbers("high")[order], begins))[group]
        else:
            verdict = least[group] < low
    bits = np.empty(len(verdict), bool)
    bits[order] = verdict
    cuts = np.cumsum([0, *sizes])
    packed = [int(n).to_bytes(8, "little") + np.packbits(bits[a: a + n]).tobytes()
              for a, n in zip(cuts, sizes, strict=False)]
    return pa.table([table.column("block").combine_chunks(), table.column("part").combine_chunks(),
                     pa.array(packed, pa.binary())], schema=_BITS)


def held(answers: DataFrame) -> DataFrame:
    """The answers of a pass, written: later passes read them more than once."""
    return staging.stage(answers, "answers")


def matched(answers: DataFrame, k: int) -> DataFrame:
    """Answers named for the k-th pass; a hash of them is small beside the blocks they join."""
    return answers.withColumnRenamed("answers", f"round{k}").hint("shuffle_hash")


def answered(blocks: DataFrame, *rounds: DataFrame) -> DataFrame:
    """blocks with the answers of the passes so far, as columns round0, round1, ..."""
    for k, answers in enumerate(rounds):
        blocks = blocks.join(matched(answers, k), "block", "left")
    return blocks
