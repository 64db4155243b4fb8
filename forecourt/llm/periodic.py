"""Periodic runs of words, by common extensions over a difference cover.

A run is a stretch of words with smallest period q, at least `least` words and
two periods long, that no neighbouring word extends.  A document is read once,
many documents at a time, without a shuffle.

1. Harmonic grid.  A run of period q covers two neighbouring multiples of q.  So
   for each q only the places k*q and (k+1)*q are compared, about n log n pairs
   in all; where the two words differ there is nothing.
2. Extensions.  How far two places agree to the right and to the left gives the
   run around them.  Any two places have a common shift below v that brings both
   into a difference cover modulo v: so few words are compared directly, and only
   pairs that still agree at the synchronised samples ask the index.
3. Index.  Only the suffixes that start in the cover are sorted (by their first v
   words, then by doubling from sample to sample), only in documents where a pair
   asks.  A sparse table over the common prefixes of neighbours answers the
   minimum of any range.
4. Pairs of one run, and of multiples of its period, give the same stretch; the
   smallest period stays.

Words are compared as numbers that stand for exactly equal words; nothing is hashed.

Defined cases: a null or empty text has no words and no runs; repeated rows are
documents of their own; memory follows the longest document, which is held whole;
equal stretches (ties) are told apart by their place; an empty table gives an empty
result.  Only the key and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging, words
from forecourt.llm.suffixes import singer_cover

LEAST = 12
#: The cover has 6 of 31 residues.
_COVER = 5
#: Pairs of the grid that are extended together, about.
_PAIRS = 1 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_DDL = "n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING"


class Extensions:
    """How many words agree from two places of one document on.

    z holds the documents' word numbers, each document followed by a number of
    its own; owner says which document a place belongs to.
    """

    def __init__(self, z: np.ndarray, owner: np.ndarray, cover: int = _COVER) -> None:
        self.v, residues = singer_cover(cover)
        self.z = np.concatenate([z, z.max(initial=0) + 1 + np.arange(self.v)])
        self.owner = owner
        self.member = np.zeros(self.v, bool)
        self.member[residues] = True
        #: For a distance modulo v, the residue that must be reached for both places to be sampled.
        self.meeting = np.zeros(self.v, np.int64)
        for x in residues:
            for y in residues:
                self.meeting[(y - x) % self.v] = x
        self.sorted_docs = np.zeros(0, np.int64)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        z = self.z
        shift = (self.meeting[(j - i) % self.v] - i) % self.v
        found = np.zeros(len(i), np.int64)
        alive, synced, t = np.arange(len(i)), [], 0
        while len(alive):
            there = shift[alive] == t
            synced.append(alive[there])
            alive = alive[~there]
            alive = alive[z[i[alive] + t] == z[j[alive] + t]]
            t += 1
            found[alive] = t
        asked = np.concatenate(synced) if synced else alive
        if len(asked):
            self._sort(np.unique(self.owner[i[asked]]))
            a, b = (self.rank[self.index[x[asked] + shift[asked]]] for x in (i, j))
            found[asked] = shift[asked] + self._least(np.minimum(a, b) + 1, np.maximum(a, b))
        return found

    def _sort(self, docs: np.ndarray) -> None:
        """Rank the cover-sampled suffixes of these documents (and of those asked for before)."""
        if not len(np.setdiff1d(docs, self.sorted_docs)):
            return
        self.sorted_docs = np.union1d(docs, self.sorted_docs)
        z, v, n = self.z, self.v, len(self.owner)
        wanted = np.zeros(self.owner.max(initial=0) + 2, bool)
        wanted[self.sorted_docs] = True
        at = np.flatnonzero(self.member[np.arange(n) % v] & wanted[self.owner])
        self.index = np.full(n, -1, np.int64)
        self.index[at] = np.arange(len(at))
        first = np.lib.stride_tricks.sliding_window_view(z, v)[at]
        first = np.ascontiguousarray(first.astype(">u4")).view(f"S{4 * v}").ravel()
        rank = np.unique(first, return_inverse=True)[1].ravel()
        rank = self._dense(self.owner[at], rank)
        levels, reach = [], v
        while True:
            levels.append((reach, rank))
            if rank.max(initial=0) == len(rank) - 1:
                break
            rank = self._dense(rank, self._ranked(rank, at + reach, np.arange(len(at))))
            reach *= 2
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        one, other = at[order[:-1]], at[order[1:]]
        common = np.zeros(len(one), np.int64)
        lone = np.arange(len(one))
        for reach, held in reversed(levels):
            same = self._ranked(held, one + common, lone) == self._ranked(held, other + common, lone + len(lone))
            common[same] += reach
        alive = np.flatnonzero(self.owner[one] == self.owner[other])
        common[self.owner[one] != self.owner[other]] = 0
        while len(alive):
            alive = alive[z[one[alive] + common[alive]] == z[other[alive] + common[alive]]]
            common[alive] += 1
        self.table = [np.concatenate([[0], common])]
        while 2 << (len(self.table) - 1) <= len(rank):
            held, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(held[:-half], held[half:]))

    def _ranked(self, rank: np.ndarray, at: np.ndarray, lone: np.ndarray) -> np.ndarray:
        """The rank at a place; one that only this entry has where no sample of the documents is."""
        inside = at < len(self.index)
        held = self.index[np.where(inside, at, 0)]
        return np.where(inside & (held >= 0), rank[held], -1 - lone)

    @staticmethod
    def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(np.concatenate([[False], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        return out

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least common prefix in each range, bounds included."""
        out = np.empty(len(low), np.int64)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << k) + 1])
        return out


def _grid(z: np.ndarray, owner: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) of grid pairs with equal words; documents stand in order of falling size."""
    places, periods, held = [], [], 0
    most = sizes // 2
    limits = ends[np.searchsorted(-most, -np.arange(1, most[0] + 1), "right") - 1]
    for q, limit in enumerate(limits.tolist(), 1):
        points = z[:limit:q]
        at = np.flatnonzero(points[1:] == points[:-1]) * q
        if not len(at):
            continue
        at = at[owner[at] == owner[at + q]]
        places.append(at)
        periods.append(np.full(len(at), q))
        held += len(at)
        if held >= _PAIRS:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(ids: np.ndarray, docs: np.ndarray, n_docs: int, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of every run, by document, start and period.

    ids are the documents' word numbers one after the other, docs whose they are.
    """
    none = (np.zeros(0, np.int64),) * 4
    sizes = np.bincount(docs, minlength=n_docs)
    first = np.cumsum(sizes) - sizes
    held = np.flatnonzero(sizes >= max(least, 2))
    held = held[np.argsort(-sizes[held], kind="stable")]
    if not len(held):
        return none
    size = sizes[held]
    # Before the first document and after each stands a number that occurs nowhere else.
    ends = np.cumsum(size + 1)
    begins = ends - size
    z = np.empty(ends[-1] + 1, np.int64)
    marks = np.concatenate([[0], ends])
    z[marks] = ids.max() + 1 + np.arange(len(marks))
    at = words.ramp(size)
    z[at + np.repeat(begins, size)] = ids[at + np.repeat(first[held], size)]
    numbers = np.arange(len(held))
    after = np.concatenate([[len(held)], np.repeat(numbers, size + 1)])
    before = np.concatenate([np.repeat(numbers, size + 1), [len(held)]])
    right = Extensions(z, after)
    left = Extensions(np.ascontiguousarray(z[::-1]), np.ascontiguousarray(before[::-1]))
    top = len(z) - 1
    found = []
    for place, period in _grid(z, after, size, ends):
        forth = right.of(place, place + period)
        # To the left of the two places, in the mirrored order: the right one comes first.
        back = left.of(top - (place + period - 1), top - (place - 1))
        good = (forth + back >= period) & (period + forth + back >= least)
        found.append(np.unique(np.stack([
            (place - back)[good], (place + period + forth)[good], period[good]], axis=1), axis=0))
    found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if not len(found):
        return none
    start, end, period = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))].T
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, period = start[new], end[new], period[new]
    own = after[start]
    doc, start, length = held[own], start - begins[own], end - start
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], length[order], period[order]


def measure(data: np.ndarray, offsets: np.ndarray, least: int) -> list[pa.Array]:
    """The output columns for some documents."""
    n = len(offsets) - 1
    starts, ends = words.spans(data, offsets, words.SPACED)
    docs = words.owner(starts, offsets)
    held = words.pack_texts(data[words.SPACED[data]], ends - starts, pa.binary())
    ids = held.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.bincount(docs, minlength=n)
    doc, start, length, period = runs_of(ids, docs, n, least)
    gone = np.zeros(len(ids) + 1, np.int64)
    base = (np.cumsum(sizes) - sizes)[doc] + start
    np.add.at(gone, base + period, 1)
    np.add.at(gone, base + length, -1)
    left = np.cumsum(gone)[:-1] == 0

    def lists(owners: np.ndarray, values: pa.Array) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), values)

    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(_RUN))
    kept = pc.binary_join(lists(docs[left], held.filter(pa.array(left))), b" ")
    return [pa.array(sizes, pa.int64()), lists(doc, runs), kept.cast(pa.string())]


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per document: id (its key), n_words, runs (by start, then period), collapsed.

    collapsed is the text without the words that only repeat: each run keeps its
    first period; words are joined by one space.
    """
    rows = docs.select(staging.quoted(key).alias("id"), staging.quoted(text).cast("string").alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(1))
            for a, b in words.portions(offsets):
                columns = measure(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *columns], names=["id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(apply, f"id {rows.schema['id'].dataType.simpleString()}, {_DDL}")


def repeat_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) of docs, every tenth document (by a checksum of its number) made periodic from some word on."""
    rows = docs.select(staging.quoted(key).cast("long").alias(key), staging.quoted(text).cast("string").alias(text))

    def tail(number: int | None, body: str | None) -> str | None:
        if number is None or body is None:
            return body
        h = zlib.crc32(str(number).encode())
        held = body.encode().split()
        if h % 10 or not held:
            return body
        n, g = len(held), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(held[:a] + [held[a + i % p] for i in range(n - a)]).decode()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [tail(k, t) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, text])

    return rows.mapInArrow(apply, rows.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table, some tails made periodic, with its runs and what is left without them."""
    found = find_runs(repeat_tails(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# Pairs of equal words at a distance are gathered to stretches of one distance; the checksum
# works byte by byte from a table that a recursion makes.
ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS b, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS digits
  FROM documents),
hashed AS (
  SELECT r, doc_id, w, len(w) AS n,
         xor(list_reduce(list_prepend(4294967295, digits),
                         lambda s, b: xor(s // 256, t[CAST(xor(s, b) % 256 AS BIGINT) + 1])), 4294967295) AS h
  FROM doc, crc),
tail AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p
  FROM hashed WHERE n > 0),
word AS (
  SELECT r, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM tail)),
pair AS (
  SELECT f.r, f.i, g.i - f.i AS q
  FROM word f JOIN word g ON f.r = g.r AND f.x = g.x AND g.i > f.i
  JOIN tail ON tail.r = f.r WHERE 2 * (g.i - f.i) <= tail.n),
stretch AS (
  SELECT r, q, min(i) AS s, count(*) + q AS m
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pair)
  GROUP BY r, q, g HAVING count(*) >= q AND count(*) + q >= 12),
run AS (SELECT r, s, m, min(q) AS q FROM stretch GROUP BY r, s, m),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS k FROM word ANTI JOIN gone USING (r, i) GROUP BY r),
said AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS lines,
         min({'less': -m, 's': s, 'q': q}) AS best
  FROM run GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start,
       CAST(-best.less AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
       CAST(1000 * -best.less // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM doc LEFT JOIN said USING (r) LEFT JOIN kept USING (r)
"""
