"""Repeated passages of words: seeds on winnowed anchors, extended both ways.

Removes every word that lies in a window of `length` consecutive words whose
sequence also starts in a document with a smaller number.

1. Seeds.  The anchor of a window is the least of the fingerprints of its
   `seed`-word grams (the leftmost of equals), as in winnowing: equal windows
   choose equal anchors at equal places, and neighbouring windows mostly share
   one.  Documents are joined on anchors.  One whose documents all have the same
   number is no seed.
2. Extension.  From each seed the windows around it, to its left and right,
   that it is the anchor of are compared with those of the other documents at
   the same seed, by fingerprint, against the smallest document number.  Every
   window is examined at one seed only, and a block sends each distinct window
   once: the work is linear in the words at seeds, also where a third of all
   documents share a passage.
3. Matching windows that touch chain into maximal repeats of at least `length`
   words; their words go.

Defined cases: null and empty texts have no words; a null document number
comes after all others and never counts as smaller; rows of the same number
never remove from one another; texts shorter than `length` words are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import blocks as bl
from forecourt.llm import words

_PLACE = np.uint64(0xFFFFFFFF)


class Passages:
    """The word windows of one block and the anchors they choose."""

    def __init__(self, length: int, seed: int) -> None:
        self.length, self.seed, self.reach = length, seed, length - seed + 1

    def split(self, block: bl.Block) -> None:
        self.starts, self.ends = words.spans(block.data, block.offsets, words.SPACED)
        self.docs = words.owner(self.starts, block.offsets)
        self.values = words.fingerprints(block.data, self.starts, self.ends)
        n = len(self.values)
        at = np.arange(max(0, n - self.length + 1))
        self.windows = at[self.docs[at] == self.docs[at + self.length - 1]]
        self.seeds = words.grams(self.values, self.seed)
        self.anchor = self._anchors()[self.windows] if len(self.windows) else np.zeros(0, np.int64)

    def _anchors(self) -> np.ndarray:
        """For each gram, the place of the least of the `reach` grams from it on."""
        n, w = len(self.seeds), self.reach
        ordered = (self.seeds & ~_PLACE) | np.arange(n, dtype=np.uint64)
        padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = ordered
        rows = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        last = np.minimum(np.arange(n) + w - 1, len(padded) - 1)
        return (np.minimum(behind[:n], ahead[last]) & _PLACE).astype(np.int64)

    def ask_anchors(self, block: bl.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.split(block)
        anchors = np.unique(self.anchor)
        return _extremes(self.seeds[anchors], block.order[self.docs[anchors]])

    def extended(self, block: bl.Block) -> tuple[np.ndarray, np.ndarray]:
        """Windows at seeds, and their fingerprints."""
        self.split(block)
        anchors = np.unique(self.anchor)
        keys = self.seeds[anchors]
        seeded = np.zeros(len(self.seeds), bool)
        if len(keys):
            seeded[anchors] = block.rounds[0][np.searchsorted(np.unique(keys), keys)]
        chosen = self.windows[seeded[self.anchor]]
        return chosen, words.grams(self.values, self.length)[chosen] if len(chosen) else np.zeros(0, np.uint64)

    def ask_windows(self, block: bl.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chosen, keys = self.extended(block)
        distinct, low, _ = _extremes(keys, block.order[self.docs[chosen]])
        return distinct, low, low[:0]

    def marked(self, block: bl.Block) -> np.ndarray:
        """Which words go."""
        chosen, keys = self.extended(block)
        order = block.order[self.docs[chosen]]
        distinct, low, _ = _extremes(keys, order)
        at = np.searchsorted(distinct, keys)
        repeated = chosen[block.rounds[1][at] | (order > low[at])] if len(keys) else chosen
        change = np.zeros(len(self.values) + 1, np.int32)
        change[repeated] += 1
        change[repeated + self.length] -= 1
        return np.cumsum(change)[:-1] > 0


def _extremes(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the least and the greatest number of each."""
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    if not len(keys):
        return keys, numbers, numbers
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.minimum.reduceat(numbers, begins), np.maximum.reduceat(numbers, begins)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, n: int) -> pa.Array:
    """The given words of each of n documents, joined by one space."""
    # Between two words of a document there is at least one byte; it becomes the space.
    more = np.zeros(len(starts), np.int64)
    more[:-1] = docs[1:] == docs[:-1]
    change = np.zeros(len(data) + 2, np.int8)
    change[starts] += 1
    change[ends + more] -= 1
    text = data.copy()
    text[ends[more == 1]] = 0x20
    return words.pack_texts(text[np.cumsum(change, dtype=np.int8)[: len(data)] > 0],
                            words.sums(ends - starts + more, docs, n), pa.binary())


def remove_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, seed: int = 20,
) -> DataFrame:
    """Per document: key, n_words, n_removed, kept (the words left, joined by one space)."""
    passages = Passages(length, min(seed, length))
    blocks = bl.pack(docs, key, text, "passage_blocks")
    total = bl.total_bytes(blocks)
    parts = bl.parts_for(blocks, 0.3 * total)
    one = bl.answered(blocks, bl.held(bl.ask(blocks, passages.ask_anchors, "shared", parts)))
    found = bl.ask(one, passages.ask_windows, "earlier", bl.parts_for(blocks, total))
    two = one.join(bl.matched(bl.held(found), 1), "block", "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in bl.blocks_of(batches):
            gone = passages.marked(block)
            n = len(block.ids)
            left = ~gone
            yield pa.RecordBatch.from_arrays([
                pa.array(block.ids, pa.int64()),
                pa.array(words.sums(np.ones(len(gone)), passages.docs, n)),
                pa.array(words.sums(gone, passages.docs, n)),
                joined(block.data, passages.starts[left], passages.ends[left], passages.docs[left], n)
                .cast(pa.string()),
            ], names=["id", "n_words", "n_removed", "kept"])

    out = two.mapInArrow(apply, "id BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING")
    return out.withColumnRenamed("id", key)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table, with a digest of what is left of it."""
    out = remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT r, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS x
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM doc WHERE len(w) >= 50)),
first AS (SELECT x, min(doc_id) AS f FROM win GROUP BY x),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 50)) AS place FROM win JOIN first USING (x) WHERE f < doc_id),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM doc),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS k FROM word ANTI JOIN gone USING (r, place) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""
