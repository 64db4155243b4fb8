"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

Two documents are linked where their sets of five-word shingles have a
similarity of `percent` or more; documents joined by links form a group.

1. Signatures.  Each document gets `coordinates` minima.  A coordinate and its
   value are one token.  Documents with equal sets are one class from here on.
2. Postings.  Linked classes have `matches` equal coordinates or more.  `sketch`
   takes both numbers from `percent`, so that a linked pair has fewer with a
   probability of at most MISSED, 1e-5, whatever the similarity asked for (17 of 32 at 85,
   15 of 32 at 80; below 31 there are more coordinates).  Tokens
   of one class only are dropped; of the others a class posts itself under its
   rarest ones, as many as it must (all but matches - 1), so that two classes
   with enough in common meet under one of them.
3. Stars.  Under each token all classes are paired with one leader: first the
   one with most shared coordinates (the least changed of a family of copies),
   then one by hash.  As many pairs as postings.  Pairs of very different size
   or with too few equal coordinates go; the rest are confirmed on full sets.
4. The rest.  Only tokens under which classes of several groups meet stay open.
   For their classes it is counted how many of their shingles any other of them
   has: that bounds every intersection, and a class that cannot reach the
   similarity with the best partner under a token leaves it.  Those left are
   paired with a leader once more.  Where several groups still meet, classes stand in
   blocks of a fixed number; blocks that share a token are compared as whole matrices in
   one task, on full sets, and return no more links than join what they join.  So a
   family of near copies never becomes rows of pairs.

Sets are held as 64-bit fingerprints of shingles, and only of classes that are in
a pair.  Defined cases: null and empty texts have an empty set and are linked
with nothing; a null document number comes after all others (a group without
any number has none); rows of one number are documents of their own; a very long
text is read whole; an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import decontaminate, staging, words
from forecourt.llm.components import components
from forecourt.llm.covertree import parts

SHINGLE = 5
COORDINATES = 32
#: Probability, at most, that a pair of just the similarity asked for has too few equal coordinates.
MISSED = 1e-5

#: Classes of a block at most, fewer where they have more than the usual number of shingles; columns of a
#: block's matrix that are held at once.
BLOCK, USUAL, _COLUMNS = 512, 256, 8192

_BLOCK = pa.schema([
    ("block", pa.int64()), ("cids", pa.list_(pa.binary())), ("roots", pa.list_(pa.binary())),
    ("sizes", pa.list_(pa.int64())), ("shingles", pa.list_(pa.int64()))])
_BLOCK_DDL = "block BIGINT, cids ARRAY<BINARY>, roots ARRAY<BINARY>, sizes ARRAY<BIGINT>, shingles ARRAY<BIGINT>"
_SIGNED_DDL = "id BIGINT, h BIGINT, n BIGINT, cid BINARY, tokens ARRAY<BIGINT>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, shingles): each document's distinct shingles; documents ascend."""
    data = words.lowered(data)
    starts, ends = words.spans(data, offsets, words.SPACED)
    docs = words.owner(starts, offsets)
    values = words.fingerprints(data, starts, ends)
    n_words = np.bincount(docs, minlength=len(offsets) - 1)
    first = np.cumsum(n_words) - n_words
    grams = words.grams(values, SHINGLE)
    at = np.arange(len(grams))
    at = at[docs[at] == docs[at + SHINGLE - 1]]
    owners, found = [docs[at]], [grams[at]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n_words == size)
        if len(short):
            owners.append(short)
            found.append(words.grams(values, size)[first[short]])
    owners, shingles = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((shingles, owners))
    owners, shingles = owners[order], shingles[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (shingles[1:] != shingles[:-1])
    return owners[new], shingles[new]


def sketch(percent: int) -> tuple[int, int]:
    """(coordinates, matches): how many minima a signature has, and how many of them a linked pair shares."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is {percent}, not in 1 to 100")
    if percent == 100:
        return COORDINATES, COORDINATES
    p = percent / 100
    n = max(COORDINATES, ceil(log(MISSED) / log1p(-p)))
    missed, matches = (1 - p) ** n, 1
    while (missed := missed + comb(n, matches) * p**matches * (1 - p) ** (n - matches)) <= MISSED:
        matches += 1
    return n, matches


def _constants(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """(factors, masks) of the coordinates' hashes."""
    rng = np.random.default_rng(0xD0C5)
    factors = rng.integers(1, 2**63, coordinates, dtype=np.uint64) | np.uint64(1)
    return factors, rng.integers(1, 2**63, coordinates, dtype=np.uint64)


def _begins(owners: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])) if len(owners) else owners


def _signer(coordinates: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    factors, masks = _constants(coordinates)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(2))
            for a, b in words.portions(offsets):
                owners, shingles = shingle_sets(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                begins = _begins(owners)
                n = words.sums(np.ones(len(owners)), owners, b - a)
                names, tokens = [None] * (b - a), [None] * (b - a)
                if len(begins):
                    rows = np.empty((len(begins), coordinates), np.int64)
                    for k in range(coordinates):
                        hashed = ((shingles ^ masks[k]) * factors[k]) >> np.uint64(32)
                        rows[:, k] = np.minimum.reduceat(hashed, begins) | np.uint64(k << 32)
                    size = n[owners[begins]].astype(np.uint64)
                    whole = np.stack([np.add.reduceat(words.mix(shingles ^ m), begins) ^ words.mix(size)
                                      for m in masks[:2]], axis=1)
                    for doc, row, key in zip(owners[begins].tolist(), rows, whole, strict=True):
                        names[doc], tokens[doc] = key.tobytes(), row
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n),
                    pa.array(names, pa.binary()), pa.array(tokens, pa.list_(pa.int64())),
                ], names=["id", "h", "n", "cid", "tokens"])

    return sign


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.flat(batch.column(1))
        for a, b in words.portions(offsets):
            owners, shingles = shingle_sets(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            n = words.sums(np.ones(len(owners)), owners, b - a)
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64))),
            ], names=["cid", "shingles"])


def _pack(table: pa.Table) -> pa.Table:
    """One block's classes (block, cid, root, shingles) as one row."""
    shingles = table.column("shingles").combine_chunks()
    sizes = pc.list_value_length(shingles).to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip((
        table.column("block")[0].as_py(), table.column("cid").to_pylist(), table.column("root").to_pylist(), sizes,
        shingles.flatten().to_numpy(zero_copy_only=False)), _BLOCK, strict=True)], schema=_BLOCK)


def common_counts(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many shingles each set of one shares with each set of other; both as (sizes, shingles end to end)."""
    shared = np.intersect1d(one[1], other[1])
    out = np.zeros((len(one[0]), len(other[0])))
    sides = []
    for sizes, shingles in (one, other):
        column = np.searchsorted(shared, shingles)
        known = np.flatnonzero(column < len(shared))
        known = known[shared[column[known]] == shingles[known]]
        order = known[np.argsort(column[known], kind="stable")]
        sides.append((np.repeat(np.arange(len(sizes)), sizes)[order], column[order]))
    for begin in range(0, len(shared), _COLUMNS):
        dense = []
        for (rows, columns), (sizes, _) in zip(sides, (one, other), strict=True):
            a, b = np.searchsorted(columns, (begin, begin + _COLUMNS))
            matrix = np.zeros((len(sizes), min(_COLUMNS, len(shared) - begin)), np.float32)
            matrix[rows[a:b], columns[a:b] - begin] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out


def _meeting(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                cids, roots, sets = [], [], []
                for side in "ab":
                    cids.append(cell[f"{side}_cids"].as_py())
                    roots.append(np.array(cell[f"{side}_roots"].as_py(), object))
                    sets.append(tuple(cell[f"{side}_{c}"].values.to_numpy(zero_copy_only=False) for c in ("sizes", "shingles")))
                both = common_counts(*sets)
                either = sets[0][0][:, None] + sets[1][0][None, :] - both
                linked = (100 * both >= percent * either) & (roots[0][:, None] != roots[1][None, :])
                rows, columns = parts(linked)
                names = [(cids[0][r], cids[k][at]) for k, stands in enumerate((rows, columns))
                         for at, r in enumerate(stands.tolist()) if r >= 0 and (k or at != r)]
                if names:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.binary()) for c in zip(*names, strict=True)], names=["a", "b"])

    return apply


class NearDuplicates:
    """The links and groups of one set of documents."""

    def __init__(self, docs: DataFrame, key: str, text: str, percent: int) -> None:
        self.percent = percent
        coordinates, self.matches = sketch(percent)
        self.body = docs.select(
            staging.quoted(key).cast("long").alias("id"), F.xxhash64(staging.quoted(text)).alias("h"),
            staging.quoted(text).cast("string").alias("body"))
        self.rows = staging.stage(self.body.mapInArrow(_signer(coordinates), _SIGNED_DDL), "signatures")
        self.classes = staging.stage(
            self.rows.filter("cid IS NOT NULL").groupBy("cid").agg(
                F.min("id").alias("id"), F.min("n").alias("n"),
                F.min(F.struct("h", "id")).alias("sample"), F.first("tokens").alias("tokens")),
            "classes")

    def postings(self) -> DataFrame:
        """(token, cid, n, shared): each class under its rarest shared tokens; shared counts all of these."""
        tokens = self.classes.select("cid", "n", F.explode("tokens").alias("token"))
        several = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
        ranked = tokens.join(several, "token").groupBy("cid", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"))
        prefix = F.slice("held", 1, F.greatest(F.lit(0), F.size("held") - (self.matches - 1)))
        return staging.stage(
            ranked.select("cid", "n", F.size("held").alias("shared"), F.explode(prefix).alias("posting"))
            .select("posting.token", "cid", "n", "shared"), "postings")

    def near_in_size(self, one: str, other: str) -> Column:
        return 100 * F.least(one, other) >= self.percent * F.greatest(one, other)

    def reachable(self, common: Column, sizes: Column) -> Column:
        """Whether `common` shingles of sets of `sizes` shingles together are enough."""
        return 100 * common >= self.percent * (sizes - common)

    def stars(self, postings: DataFrame, first: Column) -> DataFrame:
        """Pairs (a, b) of each class and the leader under each of its tokens: the least by `first`."""
        leaders = postings.groupBy("token").agg(F.min(F.struct(first.alias("o"), "cid", "n")).alias("leader"))
        pairs = postings.join(leaders, "token").filter(
            (F.col("cid") != F.col("leader.cid")) & self.near_in_size("n", "leader.n"))
        return pairs.select(F.least("cid", "leader.cid").alias("a"), F.greatest("cid", "leader.cid").alias("b"))

    def still_open(self, postings: DataFrame, groups: DataFrame) -> DataFrame:
        """The postings, with their group (root), under tokens where several groups meet."""
        names = [c for c in postings.columns if c != "root"]
        placed = postings.select(*names).join(groups, F.col("cid") == F.col("node"), "left").select(
            *names, F.coalesce("root", "cid").alias("root"))
        several = placed.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y")
        return placed.join(several.select("token"), "token")

    def bounded(self, open_: DataFrame, sets: DataFrame) -> DataFrame:
        """Postings of the classes that could still be linked under their token; shared counts shingles now."""
        shingles = sets.select("cid", F.explode("shingles").alias("shingle"))
        several = shingles.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
        shared = shingles.join(several, "shingle").groupBy("cid").agg(F.count("*").alias("shared"))
        known = open_.drop("shared").join(shared, "cid").filter(100 * F.col("shared") >= self.percent * F.col("n"))
        best = known.groupBy("token").agg(F.max("shared").alias("most"), F.min("n").alias("smallest"))
        partner = F.greatest("smallest", F.ceil(F.col("n") * self.percent / 100))
        return staging.stage(
            known.join(best, "token")
            .filter(self.reachable(F.least("shared", "most"), F.col("n") + partner)).drop("most", "smallest"),
            "bounded")

    def across(self, open_: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (a, b) between classes of different groups that share a token, as few as join the same classes.

        Classes stand in blocks, those of one frequent token together; blocks that share a token
        are compared as matrices inside a task.  No pair of classes is ever a row.
        """
        heat = open_.groupBy("token").agg(F.count("*").alias("heat"))
        homes = open_.join(heat, "token").groupBy("cid", "root", "n").agg(F.max(F.struct("heat", "token")).alias("home"))
        order = [F.col("home.heat"), F.col("home.token"), F.col("cid")]
        # Numbered by what stands before, so that blocks have their size whatever the partitions.
        placed = staging.running_total(homes.withColumn("weight", F.greatest("n", F.lit(USUAL))), order, "weight", "place")
        numbered = placed.select("cid", "root", F.expr(f"place div {BLOCK * USUAL}").alias("block"))
        blocks = staging.stage(
            numbered.join(sets, "cid").select("block", "cid", "root", "shingles")
            .groupBy("block").applyInArrow(_pack, _BLOCK_DDL), "blocks")
        held = blocks.select("block", F.explode("cids").alias("cid"))
        tokens = staging.stage(held.join(open_, "cid").select("block", "token").distinct(), "tokens")
        other = tokens.select("token", F.col("block").alias("other"))
        pairs = tokens.join(other, "token").filter(F.col("block") <= F.col("other")).select("block", "other").distinct()

        def side(name: str, key: str) -> DataFrame:
            return blocks.select(F.col("block").alias(key), *[
                F.col(c).alias(f"{name}_{c}") for c in ("cids", "roots", "sizes", "shingles")])

        cells = pairs.join(side("a", "block"), "block").join(side("b", "other"), "other")
        return staging.stage(cells.mapInArrow(_meeting(self.percent), "a BINARY, b BINARY").distinct(), "links")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Those pairs whose signatures agree often enough."""
        def side(column: str) -> DataFrame:
            return self.classes.select(F.col("cid").alias(column), F.col("tokens").alias(f"tokens_{column}"))

        return staging.stage(
            pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(F.size(F.array_intersect("tokens_a", "tokens_b")) >= self.matches).select("a", "b"),
            "likely")

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """(cid, shingles) of the wanted classes.

        Texts are read once more; a bitmap of fixed size keeps most of the
        others from being shuffled.
        """
        samples = self.classes.join(wanted.select("cid").distinct(), "cid").select("cid", "sample.id", "sample.h")
        bits, _ = decontaminate.bitmap_of(samples.select(F.col("h").alias("gram"), F.lit(0).alias("width")))

        def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(decontaminate.known(bits, batch.column(1).to_numpy(zero_copy_only=False))))

        body = self.body.mapInArrow(known, self.body.schema)
        one_each = body.groupBy("id", "h").agg(F.first("body").alias("body"))
        named = samples.withColumnRenamed("id", "sid").withColumnRenamed("h", "sh")
        texts = named.join(one_each, (F.col("sh") == F.col("h")) & F.col("sid").eqNullSafe(F.col("id")))
        return staging.stage(
            texts.select("cid", "body").mapInArrow(_collect_sets, "cid BINARY, shingles ARRAY<BIGINT>"), "sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those pairs whose full sets are similar enough."""
        def side(column: str) -> DataFrame:
            return sets.select(F.col("cid").alias(column), F.col("shingles").alias(f"set_{column}"))

        both = F.size(F.array_intersect("set_a", "set_b"))
        return staging.stage(
            pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(self.reachable(both, F.size("set_a") + F.size("set_b"))).select("a", "b"), "links")

    def groups(self) -> DataFrame:
        """(node, root): classes that are linked with another, and their group."""
        postings = self.postings()
        tried = staging.stage(
            self.stars(postings, -F.col("shared")).union(self.stars(postings, F.xxhash64("cid"))).distinct(), "stars")
        likely = self.likely(tried)
        links = self.confirmed(likely, self.sets_of(likely.select(F.explode(F.array("a", "b")).alias("cid"))))
        found = staging.stage(components(links), "groups")
        open_ = staging.stage(self.still_open(postings, found), "open")
        if open_.isEmpty():
            return found
        sets = self.sets_of(open_)
        open_ = self.bounded(open_, sets)
        more = staging.stage(
            self.stars(open_, -F.col("shared")).distinct().join(tried, ["a", "b"], "left_anti"), "stars")
        links = links.union(self.confirmed(self.likely(more), sets))
        found = staging.stage(components(links), "groups")
        open_ = staging.stage(self.still_open(open_, found), "open")
        if open_.isEmpty():
            return found
        last = self.across(open_, sets)
        return found if last.isEmpty() else components(links.union(last))

    def result(self) -> DataFrame:
        """Per row of docs: id, h, n_shingles, component_id, kept."""
        placed = self.classes.select("cid", "id").join(
            self.groups().withColumnRenamed("node", "cid"), "cid", "left"
        ).select("cid", "id", F.coalesce("root", "cid").alias("root"))
        least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
        named = placed.join(least, "root").select("cid", "root", "component_id")
        out = self.rows.select("id", "h", "n", "cid").join(named, "cid", "left")
        component = F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("component_id"))
        return out.select(
            "id", "h", F.col("n").alias("n_shingles"), "root", component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"))


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """Per row of docs: id, h (hash of the text), n_shingles, root (null: no shingles), component_id, kept."""
    return NearDuplicates(docs, key, text, percent).result()


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns; rows without shingles all stay."""
    found = staging.stage_alone(
        docs.sparkSession, lambda: group(docs, key, text, percent), "grouped").filter("root IS NOT NULL")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "h")
    chosen = found.groupBy("root").agg(F.min(order).alias("chosen")).select(
        F.col("chosen.id").alias("cid"), F.col("chosen.h").alias("ch"))
    rows = found.groupBy("id", "h").agg(F.count("*").alias("copies"))
    several = rows.filter("copies > 1").select(F.col("id").alias("oid"), F.col("h").alias("oh"))
    out = rows.join(
        chosen, F.col("id").eqNullSafe(F.col("cid")) & (F.col("h") == F.col("ch")), "left_anti",
    ).select(F.col("id").alias("oid"), F.col("h").alias("oh"))
    # A row of docs travels as one column, so that no name of its own meets one of these.
    whole = docs.select(
        F.struct(*[staging.quoted(c) for c in docs.columns]).alias("row"),
        staging.quoted(key).cast("long").alias("id"), F.xxhash64(staging.quoted(text)).alias("h"))
    same = F.col("id").eqNullSafe(F.col("oid")) & (F.col("h") == F.col("oh"))
    left = whole.join(out, same, "left_anti")
    if several.isEmpty():
        return left.select("row.*")
    repeated = left.join(several, same, "left_semi").dropDuplicates(["id", "h"])
    return left.join(several, same, "left_anti").unionByName(repeated).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table with its group, at 85."""
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS s FROM doc WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id
  JOIN sized m ON m.doc_id = a.doc_id JOIN sized n ON n.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(m.n) + any_value(n.n) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
       min(reach.b) AS component_id, doc.doc_id = min(reach.b) AS kept
FROM doc JOIN reach ON reach.a = doc.doc_id LEFT JOIN sized ON sized.doc_id = doc.doc_id
GROUP BY doc.doc_id
"""
