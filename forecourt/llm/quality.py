"""Quality rules: plain counts, and repetition read from a suffix array of words.

One pass, no shuffle.  For each document the words that start a repeat are
suffix-sorted by prefix doubling (many documents at a time, never across two),
the longest common prefixes of neighbours give the LCP interval each suffix lies
deepest in, and so the longest repeat that starts at each word.  A repeat that
only continues the one from the word before is not maximal and adds nothing.
The spans of the maximal repeats are united; a document is rejected where they
cover too large a share of its words, or where the longest repeat does.

Defined cases: a null or empty text has no words, so it fails the base rules;
repeated rows are judged one by one; columns of the input that are named like an
output column are replaced by it, others may have any name; a very long text is
judged whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm import staging, words

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
REPEAT_WINDOW = 3
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Limits:
    """A repeat counts from `least` words on; shares are of the document's words."""

    least: int = 10
    covered: float = 0.3
    longest: float = 0.2


OUTPUTS = [
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("covered_words", T.LongType()),
    T.StructField("longest_repeat", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_APART = np.uint64(0xA24BAED4963EE407)


def _within(values: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Values made different between documents."""
    return words.mix(values ^ (docs.astype(np.uint64) + np.uint64(1)) * _APART)


def _tied(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change)[:-1] > 0


def longest_repeats(values: np.ndarray, docs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, lengths): the words at which a repeat of `least` words or more
    starts within its document, and the length of the longest one there."""
    n = len(values)
    at = np.arange(max(0, n - least + 1))
    at = at[docs[at] == docs[at + least - 1]]
    keys = _within(words.grams(values, least)[at], docs[at]) if len(at) else np.zeros(0, np.uint64)
    tied = _tied(keys)
    places = at[tied]
    if not len(places):
        return places, places
    # Suffixes are sorted from every word near a repeat, so that those that share
    # part of what follows one stand together; all other words have ranks of their own.
    near = np.bincount(places, minlength=n + 1) - np.bincount(np.minimum(places + 3 * least, n), minlength=n + 1)
    near = np.flatnonzero(np.cumsum(near)[:-1] > 0)
    rank = -np.arange(1, n + 1)
    keys = _within(values[near], docs[near])
    order = np.argsort(keys)
    rank[near[order]] = np.cumsum(np.concatenate([[0], keys[order][1:] != keys[order][:-1]]))
    levels, reach = [], 1
    while True:
        levels.append((reach, rank))
        first, second = rank[near], _rank_at(rank, near + reach, near, docs)
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        if new.all():
            break
        rank = rank.copy()
        rank[near[order]] = np.cumsum(new) - 1
        reach *= 2
    suffixes = near[order]
    one, other = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(one), np.int64)
    for reach, rank in reversed(levels):
        same = _rank_at(rank, one + common, one, docs) == _rank_at(rank, other + common, other, docs)
        common[same] += reach
    deepest = np.maximum(np.append(common, 0), np.append(0, common))
    starts = np.zeros(n, bool)
    starts[places] = True
    return suffixes[starts[suffixes]], deepest[starts[suffixes]]


def _rank_at(rank: np.ndarray, at: np.ndarray, origin: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The rank at a place, or one that only this origin has where the document has ended."""
    inside = at < len(rank)
    held = np.where(inside, at, 0)
    inside &= docs[held] == docs[origin]
    return np.where(inside, rank[held], -len(rank) - 1 - origin)


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> list[np.ndarray]:
    """The output columns for some documents."""
    n = len(offsets) - 1
    starts, ends = words.spans(data, offsets, words.SPACED)
    docs = words.owner(starts, offsets)
    values = words.fingerprints(data, starts, ends)
    n_words = words.sums(np.ones(len(docs)), docs, n)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    member = words.SPACED[data]
    word_chars = per_text(member & ((data & 0xC0) != 0x80))
    n_symbols = per_text(_SYMBOL[data])

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    filled = np.concatenate([[0], np.cumsum(member)])
    worded = filled[line_ends] > filled[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_docs = words.owner(line_starts, offsets)
    keys = _within(words.fingerprints(data, line_starts, line_ends), line_docs)
    order = np.argsort(keys, kind="stable")
    again = order[1:][keys[order][1:] == keys[order][:-1]]
    n_dup_lines = words.sums(np.ones(len(again)), line_docs[again], n)

    at = np.arange(max(0, len(values) - REPEAT_WINDOW + 1))
    at = at[docs[at] == docs[at + REPEAT_WINDOW - 1]]
    grams = words.grams(values, REPEAT_WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
    twice = at[_tied(_within(grams, docs[at]))]
    n_repeat = words.sums(_covered(twice, REPEAT_WINDOW, len(values)), docs, n)

    places, lengths = longest_repeats(values, docs, limits.least)
    covered = words.sums(_covered(places, lengths, len(values)), docs, n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, docs[places], lengths)

    failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED_PERCENT * n_words)
    kept = ~failed & (covered <= limits.covered * n_words) & (longest <= limits.longest * n_words)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, covered, longest, failed, kept]


def judge(docs: DataFrame, text: str = "text", limits: Limits = Limits(), carry: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in `carry`) with the counts and the verdict."""
    held = docs.select(*[staging.quoted(c) for c in carry]) if carry is not None else \
        staging.without(docs, [f.name for f in OUTPUTS])
    rows = docs.select(
        F.struct(F.lit(True).alias("is"), F.struct(*[staging.quoted(c) for c in held.columns]).alias("row")).alias("held")
        if held.columns else F.struct(F.lit(True).alias("is")).alias("held"),
        staging.quoted(text).cast("string").alias("body"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(1))
            found = [measure(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], limits)
                     for a, b in words.portions(offsets)]
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns], names=["held", *[f.name for f in OUTPUTS]])

    judged = rows.mapInArrow(apply, T.StructType([rows.schema["held"], *OUTPUTS]))
    return judged.select(*(["held.row.*"] if held.columns else []), *[f.name for f in OUTPUTS])


def keep(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of docs that pass, with all their columns."""
    whole = docs.select(F.struct(*[staging.quoted(c) for c in docs.columns]).alias("row"), staging.quoted(text).alias("text"))
    return judge(whole, limits=limits, carry=["row"]).filter("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table with its counts and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, carry=["doc_id"])
