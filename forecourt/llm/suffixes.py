"""Repeated byte strings by a difference cover and blockwise suffix buckets.

Removes every byte that lies in a string of `length` bytes which also starts
anywhere else, in the same document or another.

1. Cover sample.  Positions whose offset in their document is, modulo v, in a
   difference cover D.  Any two positions have a common shift below v that
   brings both into the sample, so two equal strings of `length` bytes contain
   equal sample strings of `length - v + 1` bytes.  The sample strings are
   ranked first; all that matters of a rank is whether it is tied.
2. Suffix buckets.  A suffix stays only if one of the sample strings inside its
   first `length` bytes is tied (if none is, the suffix has no equal).  What
   stays is sorted one bucket at a time, a bucket being a range of the
   fingerprints of the first `length` bytes.  A bucket's size is bounded
   because there are as many as the data need, and each block sends one entry
   for each distinct string, however often it occurs.
3. Suffixes tied over the whole length mark their bytes; marked runs go.

Order inside a bucket is that of 64-bit fingerprints, not of the alphabet:
only ties are asked for, and fingerprints keep a suffix at 8 bytes on the wire.

Defined cases: null and empty texts have no bytes and nothing to remove;
repeated rows are documents of their own, so both copies lose what they share;
a null document number changes nothing; texts shorter than `length` are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import blocks as bl
from forecourt.llm import words

_PRIMES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31)


def singer_cover(q: int) -> tuple[int, list[int]]:
    """(v, D): a perfect difference set of q + 1 residues modulo v = q*q + q + 1, q prime.

    The powers of x in GF(q^3) that have no x^2 term, for the first cubic
    x^3 = a x^2 + b x + c under which they do form such a set.
    """
    v = q * q + q + 1
    for a, b, c in product(range(q), range(q), range(1, q)):
        power, found = (1, 0, 0), []
        for i in range(v):
            if power[2] == 0:
                found.append(i)
            p0, p1, p2 = power
            power = (c * p2 % q, (p0 + b * p2) % q, (p1 + a * p2) % q)
        if len(found) == q + 1 and len({(x - y) % v for x in found for y in found}) == v:
            return v, found
    raise ValueError(f"no difference set for {q}")


def cover_for(length: int) -> tuple[int, list[int]]:
    """The widest cover that leaves sample strings a third of the length."""
    fit = [q for q in _PRIMES if q * q + q + 1 <= 2 * length // 3]
    return singer_cover(fit[-1]) if fit else (1, [0])


class Cover:
    """The strings of `length` bytes in one block, and the sample strings inside them."""

    def __init__(self, length: int, total: int = 1 << 52) -> None:
        self.length = length
        # Ranks of samples only rule suffixes out, so a few bits beyond the number of samples do.
        self.coarse = ~np.uint64((1 << max(0, 64 - total.bit_length() - 12)) - 1)
        self.modulus, residues = cover_for(length)
        self.sample = length - self.modulus + 1
        self.member = np.zeros(self.modulus, bool)
        self.member[residues] = True

    def places(self, block: bl.Block) -> np.ndarray:
        """Sample positions whose sample string lies in one document long enough to hold a window."""
        sizes = np.diff(block.offsets)
        at = words.ramp(sizes)
        left = np.repeat(sizes, sizes) - at
        long_enough = np.repeat(sizes >= self.length, sizes)
        return np.flatnonzero(self.member[at % self.modulus] & (left >= self.sample) & long_enough)

    def ask_samples(self, block: bl.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _counted(self.sampled(block, self.places(block)))

    def sampled(self, block: bl.Block, places: np.ndarray) -> np.ndarray:
        return words.windows(block.data, places, self.sample) & self.coarse

    def windows(self, block: bl.Block) -> np.ndarray:
        """Starts of the strings that hold a tied sample string."""
        places = self.places(block)
        keys = self.sampled(block, places)
        tied = block.rounds[0][np.searchsorted(np.unique(keys), keys)] if len(keys) else np.zeros(0, bool)
        n = len(block.data)
        before = np.zeros(n + 1, np.int64)
        before[places[tied] + 1] = 1
        np.cumsum(before, out=before)
        sizes = np.diff(block.offsets)
        left = np.repeat(sizes, sizes) - words.ramp(sizes)
        starts = np.flatnonzero(left >= self.length)
        return starts[before[starts + self.modulus] > before[starts]]

    def ask_windows(self, block: bl.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _counted(words.windows(block.data, self.windows(block), self.length))

    def marked(self, block: bl.Block) -> np.ndarray:
        """Which bytes go."""
        starts = self.windows(block)
        keys = words.windows(block.data, starts, self.length)
        repeated = starts[block.rounds[1][np.searchsorted(np.unique(keys), keys)]] if len(keys) else starts
        change = np.zeros(len(block.data) + 1, np.int32)
        change[repeated] += 1
        change[repeated + self.length] -= 1
        return np.cumsum(change)[:-1] > 0


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, 1 or 2 (or more) occurrences, and nothing."""
    distinct, counts = np.unique(keys, return_counts=True)
    return distinct, np.minimum(counts, 2).astype(np.uint8), np.zeros(0, np.uint8)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per document: key, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left)."""
    blocks = bl.pack(docs, key, text, "suffix_blocks")
    total = bl.total_bytes(blocks)
    cover = Cover(length, total)
    samples = bl.ask(blocks, cover.ask_samples, "twice", bl.parts_for(blocks, 8 * cover.member.mean() * total))
    one = bl.answered(blocks, bl.held(samples))
    suffixes = bl.ask(one, cover.ask_windows, "twice", bl.parts_for(blocks, 3 * total))
    two = one.join(bl.matched(bl.held(suffixes), 1), "block", "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.blocks_of(batches):
            gone = cover.marked(block)
            n, docs_at = len(block.ids), np.repeat(np.arange(len(block.ids)), np.diff(block.offsets))
            removed = words.sums(gone, docs_at, n)
            begins = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]]))
            edges = block.offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(gone))]
            again = edges[gone[edges] & gone[edges - 1]]
            begins = np.unique(np.concatenate([begins, again]))
            sizes = np.diff(block.offsets)
            yield pa.RecordBatch.from_arrays([
                pa.array(block.ids, pa.int64()), pa.array(sizes), pa.array(removed),
                pa.array(words.sums(np.ones(len(begins)), docs_at[begins], n)),
                words.pack_texts(block.data[~gone], sizes - removed, pa.binary()),
            ], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    out = two.mapInArrow(apply, "id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")
    return out.withColumnRenamed("id", key)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table, with a digest of what is left of it."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Bytes as pairs of hexadecimal digits, which SQL can cut.
ORACLE_SQL = """
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (
  SELECT r, s, md5(substring(h, 2 * s - 1, 400)) AS x
  FROM (SELECT r, h, unnest(range(1, n - 198)) AS s FROM doc WHERE n >= 200)),
repeated AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
marked AS (
  SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 200 THEN 0 ELSE 1 END AS fresh
  FROM win SEMI JOIN repeated USING (x)),
span AS (
  SELECT r, min(s) AS a, max(s) + 199 AS b
  FROM (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g FROM marked) GROUP BY r, g),
piece AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS f, a - 1 AS t FROM span
  UNION ALL SELECT r, max(b) + 1, any_value(n) FROM span JOIN doc USING (r) GROUP BY r),
kept AS (
  SELECT r, string_agg(substring(h, CAST(2 * f - 1 AS BIGINT), CAST(2 * (t - f + 1) AS BIGINT)), '' ORDER BY f) AS k
  FROM piece JOIN doc USING (r) WHERE t >= f GROUP BY r),
cut AS (SELECT r, count(*) AS n, sum(b - a + 1) AS bytes FROM span GROUP BY r)
SELECT doc_id, CAST(doc.n AS BIGINT) AS n_bytes, CAST(coalesce(cut.bytes, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(cut.n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN cut.n IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
FROM doc LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)
"""
