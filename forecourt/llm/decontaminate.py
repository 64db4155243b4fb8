"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window is `length` consecutive words of a benchmark item (a shorter item is
one window).  Each window is the set of its shingles of three words (fewer for
shorter windows), with their places.

1. Rarity: one pass over the documents counts how often each benchmark shingle
   occurs in them.  A window with a shingle that never occurs cannot occur.
2. Prefix: a window must be contained whole, so one shingle is prefix enough:
   its rarest.  A second pass looks for those only, and each find brings the
   words around it along.
3. Join on the shingle; the window must fit before and behind it (position and
   length bounds); then the words of the window are compared one by one.

Both passes drop most shingles against a bitmap of fixed size (2 MB) before
anything is shuffled.  A large benchmark fills the bitmap and lets more through;
the joins behind it are exact either way.  Documents are known by their number
and a hash of their text, so repeated rows all get the same answer.

Defined cases: null and empty texts have no words; a null item number counts for
hits but not among the items; `report` looks at no other column of the input,
`clean` hands all of them on as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging, words

BITMAP_BITS = 1 << 24
SHINGLE = 3

_WINDOW_DDL = "item STRING, window STRING, size INT, place INT, width INT, gram BIGINT"
_COUNT_DDL = "gram BIGINT, n BIGINT"
_SCAN_DDL = "id BIGINT, h BIGINT, n_words BIGINT, gram BIGINT, at BIGINT, around STRING, ahead INT"


class Texts:
    """Words and shingles of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = words.lowered(data)
        self.offsets = offsets
        self.starts, self.ends = words.spans(self.data, offsets, words.ALPHANUMERIC)
        self.docs = words.owner(self.starts, offsets)
        self.values = words.fingerprints(self.data, self.starts, self.ends)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, fingerprints), none across two texts."""
        grams = words.grams(self.values, width)
        at = np.arange(len(grams))
        at = at[self.docs[at] == self.docs[at + width - 1]]
        return at, grams[at].view(np.int64)

    def said(self, a: int, b: int) -> str:
        """Words a to b, joined by one space."""
        return " ".join(self.data[s:e].tobytes().decode("utf-8", "replace")
                        for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True))


def _texts(column: pa.Array) -> Iterator[tuple[int, Texts]]:
    data, offsets = words.flat(column)
    for a, b in words.portions(offsets):
        yield a, Texts(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])


def item_windows(items: DataFrame, item: str, text: str, length: int) -> DataFrame:
    """One row for each shingle of each distinct window of each item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows = []
            for base, texts in _texts(batch.column(1)):
                n = np.bincount(texts.docs, minlength=len(texts.offsets) - 1)
                first = np.cumsum(n) - n
                grams = {w: words.grams(texts.values, w).view(np.int64) for w in range(1, SHINGLE + 1)}
                for doc in np.flatnonzero(n):
                    size = min(length, int(n[doc]))
                    width = min(SHINGLE, size)
                    for start in range(first[doc], first[doc] + n[doc] - size + 1):
                        window = texts.said(start, start + size)
                        rows += [(names[base + doc], window, size, p, width, int(grams[width][start + p]))
                                 for p in range(size - width + 1)]
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["item", "window", "size", "place", "width", "gram"])

    rows = items.select(staging.quoted(item).cast("string"), staging.quoted(text).cast("string"))
    return rows.mapInArrow(split, _WINDOW_DDL)


def bitmap_of(grams: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bits of the shingles' fingerprints (2 MB, whatever their number), and the widths among them."""
    bit = F.shiftrightunsigned("gram", 40) + 1  # Spark counts positions from 1
    rows = (
        grams.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    )
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in rows:
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        begin = (row["bucket"] - 1) * 4096
        bits[begin: begin + 4096] |= part
    return bits, sorted(r[0] for r in grams.select("width").distinct().collect())


def known(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each fingerprint's bit."""
    at = grams.view(np.uint64) >> np.uint64(40)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def rarity(docs: DataFrame, bits: np.ndarray, widths: list[int]) -> DataFrame:
    """How often each shingle that the bitmap lets through occurs in the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for _, texts in _texts(batch.column(0)):
                for width in widths:
                    grams = texts.shingles(width)[1]
                    found.append(grams[known(bits, grams)])
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], names=["gram", "n"])

    return docs.select("body").mapInArrow(count, _COUNT_DDL).groupBy("gram").agg(F.sum("n").alias("n"))


def scan(docs: DataFrame, bits: np.ndarray, widths: list[int], length: int) -> DataFrame:
    """A row for each document (no gram), and one for each place of a shingle in the bitmap."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for base, texts in _texts(batch.column(2)):
                n = np.bincount(texts.docs, minlength=len(texts.offsets) - 1)
                first = np.cumsum(n) - n
                rows = [(ids[base + i], hashes[base + i], int(c), None, None, None, None) for i, c in enumerate(n)]
                for width in widths:
                    places, grams = texts.shingles(width)
                    hit = known(bits, grams)
                    for at, gram in zip(places[hit].tolist(), grams[hit].tolist(), strict=True):
                        doc = int(texts.docs[at])
                        begin, end = int(first[doc]), int(first[doc] + n[doc])
                        a, b = max(begin, at - length + width), min(end, at + length)
                        rows.append((ids[base + doc], hashes[base + doc], int(n[doc]), gram,
                                     at - begin, texts.said(a, b), at - a))
                kinds = [pa.int64()] * 5 + [pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["id", "h", "n_words", "gram", "at", "around", "ahead"])

    return docs.mapInArrow(find, _SCAN_DDL)


def match(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", length: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """(documents, matches).

    documents: a row (id, h, n_words) for each row of docs.  matches: distinct
    (id, h, start, size, window, item), a window of an item found at a word.
    """
    body = docs.select(
        staging.quoted(key).cast("long").alias("id"), F.xxhash64(staging.quoted(text)).alias("h"),
        staging.quoted(text).cast("string").alias("body"))
    windows = staging.stage(item_windows(items, item, item_text, length), "windows")
    shingles = windows.select("window", "size", "place", "width", "gram").distinct()
    bits, widths = bitmap_of(shingles)
    counts = rarity(body, bits, widths)
    ranked = shingles.join(counts, "gram", "left").groupBy("window", "size", "width").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"),
        F.min(F.struct("n", "place", "gram")).alias("rarest"))
    prefix = staging.stage(
        ranked.filter("least > 0").select("window", "size", "width", "rarest.place", "rarest.gram"), "prefix")
    bits, widths = bitmap_of(prefix)
    found = staging.stage(scan(body, bits, widths, length), "scan")
    candidates = found.filter("gram IS NOT NULL").join(prefix, "gram")
    fits = (F.col("at") >= F.col("place")) & (F.col("at") - F.col("place") + F.col("size") <= F.col("n_words"))
    start = F.col("ahead") - F.col("place") + 1
    said = F.array_join(F.slice(F.split("around", " "), F.greatest(start, F.lit(1)), F.col("size")), " ")
    occurring = candidates.filter(fits & (start >= 1) & (said == F.col("window"))).select(
        "id", "h", (F.col("at") - F.col("place")).alias("start"), "size", "window").distinct()
    carriers = windows.select("window", "item").distinct()
    return found.filter("gram IS NULL").select("id", "h", "n_words"), occurring.join(carriers, "window")


def summarise(documents: DataFrame, matches: DataFrame) -> DataFrame:
    """One row for each row of documents: how many of its words are hit, and by which items."""
    def united(spans):
        step = F.aggregate(
            spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
            lambda a, s: F.struct(
                (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).alias("n"),
                F.greatest(a["to"], s["end"]).alias("to")))
        return step["n"]

    hits = matches.groupBy("id", "h").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items")).select(
        F.col("id").alias("hit_id"), F.col("h").alias("hit_h"), united(F.col("spans")).alias("n_hit"), "items")
    none = F.array().cast("array<string>")
    items = F.coalesce("items", none)
    return documents.join(
        hits, F.col("id").eqNullSafe(F.col("hit_id")) & F.col("h").eqNullSafe(F.col("hit_h")), "left",
    ).select(
        "id", "h", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def report(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """Per row of docs: id, h, n_words, n_hit, n_items, items (their numbers as sorted strings), contaminated."""
    return summarise(*match(docs, items, **names))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of docs in which no window of an item occurs, with all their columns."""
    _, matches = match(docs, items, key, text, **names)
    dirty = matches.select(F.col("id").alias("oid"), F.col("h").alias("oh")).distinct()
    # A row of docs travels as one column, so that no name of its own meets one of these.
    whole = docs.select(
        F.struct(*[staging.quoted(c) for c in docs.columns]).alias("row"),
        staging.quoted(key).cast("long").alias("id"), F.xxhash64(staging.quoted(text)).alias("h"))
    return whole.join(
        dirty, F.col("id").eqNullSafe(F.col("oid")) & (F.col("h") == F.col("oh")), "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table against every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return report(docs, items).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
item AS (SELECT item_id, coalesce({_WORDS.format('text')}, []) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS said
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
piece AS (
  SELECT r, size, s, array_to_string(w[s:s + size - 1], ' ') AS said
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT r, s, p.size, item_id FROM piece p JOIN win USING (size, said)),
n_hit AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(s, s + size)) AS place FROM hit) GROUP BY r),
n_item AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_item.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN n_hit USING (r) LEFT JOIN n_item USING (r)
"""
