"""Hard negatives by a vertical branch-and-bound scan over columns of dimensions.

Vectors become whole numbers, floor(scale * x).  For each anchor its best rows of
the same label are the positives; a positive's hard negatives are the best rows of
other labels whose score lies in a window below the positive's score.

Rows stand in blocks, one column a dimension, sorted by label.  The anchors, a
stated query set, go to every block in batches.  In a block an anchor reads the
columns in the order of its own falling magnitudes.  After some columns each
candidate's score is known up to what the unread ones can add: at least and at most
the sum of what a column's least and greatest value give, and never more than the
lengths of the two unread parts allow.  A candidate goes

- when looking for positives: if it cannot reach the k-th best score that is certain;
- when looking for negatives: if it can lie in no window, or if a window already has
  k certain rows above it.

Those left when all columns are read have their exact scores.  A block returns at most
k rows for an anchor (and window); ranking these gives the result.

Scores are exact: sums below 2^53 are taken in double precision, larger ones in
Python's whole numbers; one beyond 64 bits counts as the largest that fits.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; vectors of different length are never compared; a null number
is no anchor and comes last among ties; repeated rows are rows of their own, also as
each other's positives; anchors without positives, positives below zero (their window is
empty) and an empty table give no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm import staging, vectors

BLOCK_ROWS = 16_384
BATCH_ANCHORS = 1024
#: Columns read before the first and before each further look at the bounds.
FIRST, STEP = 16, 8
#: Sums below this are exact in double precision.
_EXACT = 2.0**53
_LAST = (1 << 63) - 1

_ROWS_DDL = "row BIGINT, id BIGINT, label BIGINT, width INT, vec BINARY"
_BLOCK_DDL = "part INT, width INT, rows ARRAY<BIGINT>, ids ARRAY<BIGINT>, labels ARRAY<BIGINT>, body BINARY"
_BATCH_DDL = "width INT, rows ARRAY<BIGINT>, labels ARRAY<BIGINT>, body BINARY, windows ARRAY<ARRAY<BIGINT>>"


def _prepare(scale: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in vectors.by_width(batch.column(3)):
                whole = np.floor(scale * matrix)
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([
                    *rows.columns[:3], pa.array(np.full(len(at), matrix.shape[1], np.int32)),
                    pa.array([v.tobytes() for v in whole], pa.binary())], names=["row", "id", "label", "width", "vec"])

    return apply


def _rows_by_width(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list[dict]]]:
    """The rows of a task in lists of one width, at most `most` long."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            mine = held.setdefault(row["width"], [])
            mine.append(row)
            if len(mine) == most:
                yield row["width"], held.pop(row["width"])
    yield from held.items()


def _body(rows: list[dict], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r["vec"] for r in rows), np.float64).reshape(len(rows), width)


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for width, rows in _rows_by_width(batches, BLOCK_ROWS):
        rows.sort(key=lambda r: r["label"])
        columns = np.ascontiguousarray(_body(rows, width).T)
        yield pa.RecordBatch.from_pylist([{
            "part": part, "width": width, "rows": [r["row"] for r in rows], "ids": [r["id"] for r in rows],
            "labels": [r["label"] for r in rows], "body": columns.tobytes()}], schema=pa.schema([
                ("part", pa.int32()), ("width", pa.int32()), ("rows", pa.list_(pa.int64())),
                ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("body", pa.binary())]))


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for width, rows in _rows_by_width(batches, BATCH_ANCHORS):
        yield pa.RecordBatch.from_pylist([{
            "width": width, "rows": [r["row"] for r in rows], "labels": [r["label"] for r in rows],
            "body": _body(rows, width).tobytes(), "windows": [[x for w in r.get("windows") or [] for x in w] for r in rows]}],
            schema=pa.schema([
                ("width", pa.int32()), ("rows", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
                ("body", pa.binary()), ("windows", pa.list_(pa.list_(pa.int64())))]))


class Block:
    """The columns of one block, and what bounds the scores of its rows."""

    def __init__(self, cell: dict) -> None:
        n = len(cell["rows"])
        self.columns = np.frombuffer(cell["body"], np.float64).reshape(-1, n) if n else np.zeros((cell["width"], 0))
        self.rows, self.labels = np.asarray(cell["rows"], np.int64), np.asarray(cell["labels"], np.int64)
        self.ids = cell["ids"]
        last = np.iinfo(np.int64).max
        self.order = np.array([last if i is None else i for i in self.ids], np.int64)
        self.least, self.most = self.columns.min(axis=1, initial=np.inf), self.columns.max(axis=1, initial=-np.inf)
        self.squares = np.einsum("ij,ij->j", self.columns, self.columns)
        self.largest = np.abs(self.columns).max(initial=0.0)

    def slice_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in `at` of the k best: higher scores first, then smaller numbers."""
        if len(at) > k:
            floor = np.partition(scores, -k)[-k]
            held = np.flatnonzero(scores >= floor)
        else:
            held = np.arange(len(at))
        keys = (self.rows[at[held]], self.order[at[held]], -scores[held])
        return held[np.lexsort(keys)][:k]


class Positives:
    """What may still be among the k best."""

    def __init__(self, k: int) -> None:
        self.k = k

    def alive(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= self.k:
            return np.ones(len(low), bool)
        return high >= np.partition(low, -self.k)[-self.k]


class Negatives:
    """What may still be among the k best of a window."""

    def __init__(self, k: int, windows: list[tuple[int, int]]) -> None:
        self.k, self.windows = k, windows

    def alive(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(low), bool)
        for least, most in self.windows:
            certain = low[(low >= least) & (high <= most)]
            floor = np.partition(certain, -self.k)[-self.k] if len(certain) >= self.k else least
            out |= (high >= max(floor, least)) & (low <= most)
        return out


def scan(block: Block, anchor: np.ndarray, at: np.ndarray, rule: Positives | Negatives) -> tuple[np.ndarray, np.ndarray]:
    """The candidates among `at` that the rule leaves, with their exact scores."""
    width = len(anchor)
    if width * block.largest * np.abs(anchor).max(initial=0.0) >= _EXACT:
        exact = np.array([int(x) for x in anchor], object)
        scores = np.array([sum(a * int(x) for a, x in zip(exact, block.columns[:, c], strict=True)) for c in at], object)
        return at, np.array([min(max(s, -_LAST), _LAST) for s in scores], np.int64)
    order = np.argsort(-np.abs(anchor), kind="stable")
    weights = anchor[order]
    ends = np.stack([weights * block.least[order], weights * block.most[order]])
    # What the columns from the d-th on can add.
    least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0.0)
    most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0.0)
    length = np.append(np.cumsum((weights * weights)[::-1])[::-1], 0.0)
    score, rest = np.zeros(len(at)), block.squares[at]
    done = 0
    while done < width and len(at):
        upto = min(width, done + (STEP if done else FIRST))
        part = block.columns[order[done:upto]][:, at]
        score = score + weights[done:upto] @ part
        done = upto
        if done == width:
            break
        rest = rest - np.einsum("ij,ij->j", part, part)
        reach = np.sqrt(np.maximum(rest, 0.0) * length[done]) * (1 + 1e-9) + 1
        alive = rule.alive(score + np.maximum(least[done], -reach), score + np.minimum(most[done], reach))
        at, score, rest = at[alive], score[alive], rest[alive]
    return at, np.rint(score).astype(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, dict, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            cell = batch.slice(i, 1).to_pylist()[0]
            anchors = {k.removeprefix("a_"): v for k, v in cell.items() if k.startswith("a_")}
            n = len(anchors["rows"])
            yield Block(cell), anchors, np.frombuffer(anchors["body"], np.float64).reshape(n, -1)


def _find_positives(k: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors, matrix in _cells(batches):
            out: list[list] = [[], [], [], []]
            for me, label, vector in zip(anchors["rows"], anchors["labels"], matrix, strict=True):
                a, b = block.slice_of(label)
                at = np.arange(a, b)
                at, scores = scan(block, vector, at[block.rows[a:b] != me], Positives(k))
                held = block.best(at, scores, k)
                for column, values in zip(out, ([me] * len(held), block.rows[at[held]].tolist(),
                                                [block.ids[c] for c in at[held]], scores[held].tolist()), strict=True):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["anchor", "row", "id", "score"])

    return apply


def _find_negatives(k: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors, matrix in _cells(batches):
            out: list[list] = [[], [], [], [], []]
            for me, label, vector, windows in zip(
                    anchors["rows"], anchors["labels"], matrix, anchors["windows"], strict=True):
                a, b = block.slice_of(label)
                windows = list(zip(windows[::3], windows[1::3], windows[2::3], strict=True))
                at = np.concatenate([np.arange(a), np.arange(b, len(block.rows))])
                at, scores = scan(block, vector, at, Negatives(k, [(w[1], w[2]) for w in windows]))
                for positive, least, most in windows:
                    inside = np.flatnonzero((scores >= least) & (scores <= most))
                    held = inside[block.best(at[inside], scores[inside], k)]
                    for column, values in zip(out, (
                            [me] * len(held), [positive] * len(held), block.rows[at[held]].tolist(),
                            [block.ids[c] for c in at[held]], scores[held].tolist()), strict=True):
                        column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], names=["anchor", "of", "row", "id", "score"])

    return apply


def mine(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    is_anchor is a condition on `id`, the row's key as a long number.  A negative's
    score is low to high percent of its positive's.
    """
    named = rows.select(
        F.monotonically_increasing_id().alias("row"), staging.quoted(key).cast("long").alias("id"),
        staging.quoted(label).cast("long").alias("label"), staging.quoted(vector).alias("vec"))
    held = staging.stage(named.filter("label IS NOT NULL AND vec IS NOT NULL").mapInArrow(_prepare(scale), _ROWS_DDL), "vectors")
    parts = held.count() // BLOCK_ROWS + 1
    blocks = staging.stage(held.repartition(parts).mapInArrow(_pack_blocks, _BLOCK_DDL), "columns")
    anchors = held.filter(is_anchor)
    batch_count = anchors.count() // BATCH_ANCHORS + 1

    def cells(some: DataFrame) -> DataFrame:
        """Each batch of anchors beside each block of vectors of their length."""
        batches = some.repartition(batch_count).mapInArrow(_pack_anchors, _BATCH_DDL)
        sent = batches.select(
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "width",
            *[F.col(c).alias(f"a_{c}") for c in ("rows", "labels", "body", "windows")])
        return blocks.join(sent, ["part", "width"])

    def first(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    found = cells(anchors).mapInArrow(_find_positives(positives), "anchor BIGINT, row BIGINT, id BIGINT, score BIGINT")
    best = staging.stage(first(found, ["anchor"], positives), "positives")
    # 100 * negative between low and high times the positive; numbers of any size, hence decimals.
    wide = F.col("score").cast("decimal(30,0)")
    window = F.array(
        F.col("score"), F.ceil(wide * low / 100).cast("long"), F.floor(wide * high / 100).cast("long"))
    windows = best.filter("score >= 0").groupBy("anchor").agg(F.collect_set(window).alias("windows"))
    asking = anchors.join(windows, F.col("row") == F.col("anchor")).select(*anchors.columns, "windows")
    found = cells(asking).mapInArrow(
        _find_negatives(negatives), "anchor BIGINT, of BIGINT, row BIGINT, id BIGINT, score BIGINT")
    ranked = first(found, ["anchor", "of"], negatives)
    pairs = best.select("anchor", F.col("score").alias("of"), F.col("id").alias("positive_id"))
    return (
        ranked.join(pairs, ["anchor", "of"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                F.col("of").alias("positive_score"), F.col("score").alias("negative_score"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose number is divisible by 100; every seventh row moves to the next label first."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


ORACLE_SQL = """
WITH held AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
score AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS s
  FROM held a JOIN held b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM score WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, vec_id, r) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.s DESC, n.vec_id, n.r) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positive p JOIN score n ON n.ar = p.ar AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY rank <= 10
"""
