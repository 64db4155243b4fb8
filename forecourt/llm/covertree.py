"""Near-duplicate vectors by dual traversal of cover trees: exact pairs over a cosine threshold.

On unit vectors a cosine of `least` or more is a distance of sqrt(2 - 2 * least) or less.

1. Classes.  Equal vectors of one label are one class from here on; what follows
   works on classes and counts copies, so a group of copies is one point.
2. Blocks.  The classes of a label are laid out by the nearest of a few pivots,
   found farthest-first in a bounded sample (it decides the layout, never a
   result), and cut into blocks of a fixed size.
3. Trees.  Each block is a cover tree: levels with halving radii, every node a
   centre more than the level's radius away from the others, all points below within
   it, a centre its own first child.  A node keeps the distance to its farthest
   point; its points stand side by side.
4. Traversal.  Two blocks of a label meet only if the distance of their roots less
   both covering radii is within the limit; inside, pairs of nodes are ruled out
   by the same bound, taken whole where distance plus radii stay below the limit, and
   opened otherwise.  A block pair returns one row for each class that has a link in it:
   how many vectors it is linked with there, and the class that stands for its
   connected part.  So no pair of a large family is ever a row.
5. Counts are summed by class, parts are joined to components.

Cosines are computed in double precision; those within 1e-9 of the limit again, from
sums rounded once.

Defined cases: a null label, a null or zero vector, or one with a null or non-finite
component has no links and is a component of its own; an empty vector likewise;
vectors of different length are never compared; repeated rows (also of one number) are
vectors of their own and linked with each other; the component is the smallest number
that is not null (null if there is none); an empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import fsum, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm import staging, vectors
from forecourt.llm.components import components

BLOCK = 2048
#: Groups larger than a block get pivots: this many, from a sample of this size; the largest groups only.
PIVOTS, SAMPLE, PIVOTED = 16, 256, 512
#: Points nearer than this are one leaf; bounds are trusted up to it.
_NEAR = 1e-6
_BAND = 1e-9

_BLOCK = pa.schema([
    ("block", pa.int64()), ("classes", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("body", pa.binary()),
    ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("radii", pa.list_(pa.float64())),
    ("children", pa.list_(pa.int32())), ("grown", pa.list_(pa.int32())), ("root", pa.list_(pa.float64()))])
_BLOCK_DDL = (
    "block BIGINT, classes ARRAY<BIGINT>, copies ARRAY<BIGINT>, body BINARY, begins ARRAY<INT>, ends ARRAY<INT>, "
    "radii ARRAY<DOUBLE>, children ARRAY<INT>, grown ARRAY<INT>, root ARRAY<DOUBLE>")


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that no square overflows or vanishes."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def distances(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


@dataclass
class Tree:
    """Nodes in order of creation, the root first.  Node i has the points begins[i]:ends[i], the
    first of them its centre; its children are the nodes children[i]:grown[i]."""

    begins: np.ndarray
    ends: np.ndarray
    radii: np.ndarray
    children: np.ndarray
    grown: np.ndarray


def grow(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The cover tree of unit vectors, and the order in which their points stand."""
    n = len(points)
    apart = distances(points @ points.T)
    order = np.empty(n, np.int64)
    begins, ends, radii, children, grown = [0], [n], [0.0], [0], [0]
    members: list[np.ndarray | None] = [np.arange(n)]
    at = 0
    while at < len(members):
        mine, begin = members[at], begins[at]
        members[at] = None
        radii[at] = radius = float(apart[mine[0], mine].max())
        children[at] = grown[at] = len(members)
        if radius <= _NEAR:
            order[begin: ends[at]] = mine
        else:
            # The widest level of the halving radii that parts these points.
            level = 2.0
            while level >= radius:
                level /= 2
            rest = mine
            while len(rest):
                near = apart[rest[0], rest] <= level
                members.append(rest[near])
                begins.append(begin)
                begin += int(near.sum())
                ends.append(begin)
                radii.append(0.0)
                children.append(0)
                grown.append(0)
                rest = rest[~near]
            grown[at] = len(members)
        at += 1
    return Tree(*(np.array(x) for x in (begins, ends, radii, children, grown))), order


class Side:
    """One block of a pair."""

    def __init__(self, cell: dict, prefix: str) -> None:
        held = {c: cell[f"{prefix}_{c}"] for c in _BLOCK.names if c not in ("block", "root")}
        self.classes, self.copies = (np.asarray(held[c], np.int64) for c in ("classes", "copies"))
        self.raw = np.frombuffer(held["body"], np.float64).reshape(len(self.classes), -1)
        self.points = unit(self.raw)
        self.tree = Tree(*(np.asarray(held[c]) for c in ("begins", "ends", "radii", "children", "grown")))

    def opened(self, node: int) -> np.ndarray:
        """The children of a node; a leaf stands for itself."""
        a, b = self.tree.children[node], self.tree.grown[node]
        return np.arange(a, b) if b > a else np.array([node])


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """From sums that are rounded once."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return fsum(x * y) / sqrt(fsum(x * x) * fsum(y * y))


def links(one: Side, other: Side, least: float) -> np.ndarray:
    """Which points of one are linked with which of other."""
    limit = sqrt(max(0.0, 2 - 2 * least))
    out = np.zeros((len(one.classes), len(other.classes)), bool)
    t, u = one.tree, other.tree
    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        a, b = one.opened(i), other.opened(j)
        dots = one.points[t.begins[a]] @ other.points[u.begins[b]].T
        apart = distances(dots)
        reach = t.radii[a][:, None] + u.radii[b][None, :]
        possible = apart - reach <= limit + _NEAR
        single = ((t.ends - t.begins)[a] == 1)[:, None] & ((u.ends - u.begins)[b] == 1)[None, :]
        sure = np.where(single, dots >= least + _BAND, apart + reach <= limit - _NEAR)
        p, q = np.nonzero(possible & single & sure)
        out[t.begins[a[p]], u.begins[b[q]]] = True
        for p, q in zip(*np.nonzero(possible & single & ~sure & (dots >= least - _BAND)), strict=True):
            x, y = t.begins[a[p]], u.begins[b[q]]
            out[x, y] = cosine(one.raw[x], other.raw[y]) >= least
        for p, q in zip(*np.nonzero(possible & ~single), strict=True):
            x, y = a[p], b[q]
            rows, columns = slice(t.begins[x], t.ends[x]), slice(u.begins[y], u.ends[y])
            if sure[p, q]:
                out[rows, columns] = True
            elif t.grown[x] > t.children[x] or u.grown[y] > u.children[y]:
                stack.append((x, y))
            else:
                dot = one.points[rows] @ other.points[columns].T
                out[rows, columns] = dot >= least
                for r, c in zip(*np.nonzero(np.abs(dot - least) <= _BAND), strict=True):
                    r, c = r + rows.start, c + columns.start
                    out[r, c] = cosine(one.raw[r], other.raw[c]) >= least
    return out


def parts(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a link matrix the row that stands for its connected part; -1 without links."""
    turned = np.ascontiguousarray(linked.T)
    rows, columns = np.full(len(linked), -1), np.full(len(turned), -1)
    for start in np.flatnonzero(linked.any(axis=1)):
        if rows[start] >= 0:
            continue
        rows[start] = start
        fresh = np.array([start])
        while len(fresh):
            reached = np.flatnonzero(linked[fresh].any(axis=0) & (columns < 0))
            columns[reached] = start
            fresh = np.flatnonzero(turned[reached].any(axis=0) & (rows < 0))
            rows[fresh] = start
    return rows, columns


def _traverse(least: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = batch.slice(i, 1).to_pylist()[0]
                one = Side(cell, "a")
                same = cell["a_block"] == cell["b_block"]
                other = one if same else Side(cell, "b")
                linked = links(one, other, least)
                if same:
                    np.fill_diagonal(linked, False)
                rows, columns = parts(linked)
                out = [(one.classes, linked @ other.copies, rows)]
                if not same:
                    out.append((other.classes, one.copies @ linked, columns))
                for classes, n, stands in out:
                    held = stands >= 0
                    if held.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, pa.int64()) for x in (classes[held], n[held], one.classes[stands[held]])],
                            names=["class", "n", "part"])

    return apply


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector as bytes, null where it can have no links."""
    for batch in batches:
        bodies: list[bytes | None] = [None] * batch.num_rows
        for at, matrix in vectors.by_width(batch.column(3)):
            matrix = matrix + 0.0  # one zero
            for row, vector, some in zip(at.tolist(), matrix, matrix.any(axis=1).tolist(), strict=True):
                bodies[row] = vector.tobytes() if some else None
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(bodies, pa.binary())], names=["row", "id", "label", "vec"])


def _farthest(table: pa.Table) -> pa.Table:
    """Up to PIVOTS vectors of a sample, each the farthest from those before."""
    bodies = table.column("vec").to_pylist()
    points = unit(np.stack([np.frombuffer(b, np.float64) for b in bodies]))
    chosen, away = [0], distances(points @ points[0])
    while len(chosen) < min(PIVOTS, len(points)) and away.max() > _NEAR:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points @ points[chosen[-1]]))
    return pa.table({"group": table.column("group").slice(0, 1).combine_chunks(),
                     "pivots": pa.array([points[chosen].tobytes()], pa.binary())})


def _placed(pivots: dict[int, bytes]):
    """Adds the nearest pivot of a class and how near it is."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {g: np.frombuffer(b, np.float64) for g, b in pivots.items()}
        for batch in batches:
            groups, bodies = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            nearest, near = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for group in set(groups) & held.keys():
                at = np.flatnonzero(np.array([g == group for g in groups]))
                points = unit(np.stack([np.frombuffer(bodies[i], np.float64) for i in at]))
                dots = points @ held[group].reshape(-1, points.shape[1]).T
                nearest[at], near[at] = dots.argmax(axis=1), dots.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest), pa.array(near)],
                names=["group", "class", "copies", "vec", "pivot", "near"])

    return apply


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive classes of one group, each with its tree."""
    from pyspark import TaskContext

    task, made, group, held = TaskContext.get().partitionId() << 32, 0, None, []

    def block() -> pa.RecordBatch:
        raw = np.stack([np.frombuffer(r["vec"], np.float64) for r in held])
        tree, order = grow(unit(raw))
        row = {"block": task + made, "classes": [held[i]["class"] for i in order],
               "copies": [held[i]["copies"] for i in order], "body": raw[order].tobytes(),
               "begins": tree.begins, "ends": tree.ends, "radii": tree.radii, "children": tree.children,
               "grown": tree.grown, "root": unit(raw[order[:1]])[0]}
        return pa.RecordBatch.from_arrays(
            [pa.array([group], pa.int64()), *(pa.array([row[f.name]], f.type) for f in _BLOCK)],
            names=["group", *_BLOCK.names])

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["group"] != group or len(held) == BLOCK):
                yield block()
                made, held = made + 1, []
            group = row["group"]
            held.append(row)
    if held:
        yield block()


def _blocks(classes: DataFrame) -> DataFrame:
    """The stored blocks of classes (group, class, copies, vec)."""
    large = classes.groupBy("group").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK)
    large = large.orderBy(F.desc("size"), "group").limit(PIVOTED)
    nth = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("class"), "class"))
    sample = classes.join(large, "group").select("group", "class", "vec").withColumn("nth", nth).filter(F.col("nth") <= SAMPLE)
    found = sample.groupBy("group").applyInArrow(_farthest, "group BIGINT, pivots BINARY").collect()
    placed = classes.select("group", "class", "copies", "vec").mapInArrow(
        _placed({r["group"]: r["pivots"] for r in found}),
        "group BIGINT, class BIGINT, copies BIGINT, vec BINARY, pivot INT, near DOUBLE")
    order = ["group", "pivot", "near", "class"]
    laid = placed.repartitionByRange(classes.count() // BLOCK + 1, *order).sortWithinPartitions(*order)
    return staging.stage(laid.mapInArrow(_pack, f"group BIGINT, {_BLOCK_DDL}"), "trees")


def group(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.  Only vectors of one label are compared, and links need a cosine of least."""
    if not 0 < least <= 1:
        raise ValueError(f"least is {least}, not above 0 and up to 1")
    named = rows.select(
        F.monotonically_increasing_id().alias("row"), staging.quoted(key).cast("long").alias("id"),
        staging.quoted(label).cast("string").alias("label"), staging.quoted(vector).alias("vec"))
    held = staging.stage(named.mapInArrow(_usable, "row BIGINT, id BIGINT, label STRING, vec BINARY"), "vectors")
    able = held.filter("label IS NOT NULL AND vec IS NOT NULL")
    # A group, a label and a length, is named by one of its rows.
    classes = able.groupBy("label", "vec").agg(F.min("row").alias("class"), F.count("*").alias("copies"))
    classes = staging.stage(classes.withColumn("width", F.octet_length("vec")), "classes")
    groups = classes.groupBy("label", "width").agg(F.min("class").alias("group"))
    grouped = staging.stage(classes.join(groups, ["label", "width"]).drop("width"), "grouped")
    blocks = _blocks(grouped)

    def side(name: str, *columns: str) -> DataFrame:
        return blocks.select(*[F.col(c).alias(f"{name}_{c}") for c in columns])

    limit = sqrt(max(0.0, 2 - 2 * least))
    roots = [side(x, "group", "block", "root", "radii").withColumn(f"{x}_reach", F.col(f"{x}_radii")[0]) for x in "ab"]
    apart = F.aggregate(
        F.zip_with("a_root", "b_root", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x, F.sqrt)
    near = roots[0].join(roots[1], (F.col("a_group") == F.col("b_group")) & (F.col("a_block") <= F.col("b_block")))
    near = near.filter(apart - F.col("a_reach") - F.col("b_reach") <= limit + _NEAR).select("a_block", "b_block")
    columns = [c for c in _BLOCK.names if c != "root"]
    cells = near.join(side("a", *columns), "a_block").join(side("b", *columns), "b_block")
    found = staging.stage(cells.mapInArrow(_traverse(least), "class BIGINT, n BIGINT, part BIGINT"), "links")

    counts = found.groupBy("class").agg(F.sum("n").alias("n"))
    roots_of = components(found.select(F.col("class").alias("a"), F.col("part").alias("b")))
    told = grouped.join(counts, "class", "left").join(
        roots_of.withColumnRenamed("node", "class"), "class", "left").select(
        F.col("label").alias("c_label"), F.col("vec").alias("c_vec"), F.coalesce("root", "class").alias("root"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    told = staging.stage(told, "told")
    placed = staging.stage(
        held.join(told, (F.col("label") == F.col("c_label")) & (F.col("vec") == F.col("c_vec")), "left")
        .select("id", "root", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "placed")
    smallest = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest"))
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return placed.join(smallest, "root", "left").select(
        "id", "n_links", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every vector of the table, at 0.98."""
    return group(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


ORACLE_SQL = """
WITH RECURSIVE held AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         coalesce(len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS able
  FROM embeddings),
link AS (
  SELECT a.r AS a, b.r AS b
  FROM (SELECT * FROM held WHERE able) a JOIN (SELECT * FROM held WHERE able) b
    ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT r AS a, r AS b FROM held
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
counted AS (SELECT a, count(*) AS n FROM link GROUP BY a),
least AS (SELECT reach.a, min(held.vec_id) AS m FROM reach JOIN held ON held.r = reach.b GROUP BY reach.a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, m AS component_id, vec_id = m AS kept
FROM held JOIN least ON least.a = held.r LEFT JOIN counted ON counted.a = held.r
"""
