"""Hard negatives, vector duplicates and word runs against brute force, and their defined cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import covertree, hardneg, periodic, vectors, words

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rows STRING, id STRING, `group` STRING, n STRING, part STRING"


def vector_rows(rows):
    return [(i, v, label, "mine", "mine", "mine", "mine", "mine") for i, v, label in rows]


def made_vectors(rng, n=900, width=16, labels=4):
    """Unit vectors with families of near copies, exact copies and a hot label."""
    held = []
    centres = rng.normal(size=(6, width))
    for i in range(n):
        if i % 3 == 0:
            v = centres[rng.integers(6)] + rng.normal(size=width) * rng.choice([0.02, 0.1, 0.2])
            label = 1
        else:
            v, label = rng.normal(size=width), int(rng.integers(labels))
        v = (v / np.linalg.norm(v)).astype(np.float32).tolist()
        held.append((i, v, label))
    held += [(n + i, held[3][1], 1) for i in range(20)]
    return held


ODD = [
    (None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5000, None, 1), (5001, [1.0, None], 1), (5002, [float("nan"), 1.0], 1),
    (5003, [float("inf"), 1.0], 1), (5004, [0.0, 0.0], 1), (5005, [0.0, 0.0], 1), (5006, [], 1), (5007, [1.0, 0.0], None),
    (5008, [2.0, 0.0], 1), (5008, [2.0, 0.0], 1), (5009, [-0.0, 3.0], 1), (5010, [0.0, 3.0], 1), (5011, [1.0, 0.0, 0.0], 1),
    (5012, [1.0, 0.0], 2), (-7, [1.0, 0.05], 1), (5100, [0.5, 0.5], 2), (5100, [0.5, 0.5], 2), (5200, [1e30, 1.0], 9),
]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, least):
    n = len(rows)
    able = [label is not None and usable(v) and any(v) for _, v, label in rows]
    links = [set() for _ in range(n)]
    for a in range(n):
        for b in range(a):
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if able[a] and able[b] and p == q and len(x) == len(y):
                x, y = np.array(x, np.float64), np.array(y, np.float64)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        least_id = min(ids, default=None)
        out.append((rows[a][0], len(links[a]), least_id, rows[a][0] == least_id))
    return sorted(out, key=repr)


def found_links(spark, rows, least=0.98):
    df = spark.createDataFrame(vector_rows(rows), VECTORS).repartition(3)
    out = covertree.group(df, least=least)
    assert out.columns == ["id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=repr)


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_vector_duplicates_equal_brute_force(spark, monkeypatch):
    # Small blocks: every label has several, with pivots.
    monkeypatch.setattr(covertree, "BLOCK", 60)
    rows = as_floats(made_vectors(np.random.default_rng(5)) + ODD)
    want = brute_links(rows, 0.98)
    assert sum(1 for r in want if r[1]) > 100
    assert found_links(spark, rows) == want


def test_vector_duplicates_of_nothing(spark):
    assert found_links(spark, []) == []
    assert found_links(spark, [(1, None, 1), (2, [0.0], 1)]) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("least", [0.3, 0.9, 0.98, 1.0])
def test_cover_trees_find_the_pairs_of_all(least):
    rng = np.random.default_rng(7)
    raw = np.concatenate([
        rng.normal(size=(150, 8)), *(rng.normal(size=8) + rng.normal(size=(60, 8)) * s for s in (1e-9, 0.01, 0.1, 0.3)),
        np.tile(rng.normal(size=8), (20, 1)) * rng.uniform(1, 9, (20, 1))])
    points = covertree.unit(raw)
    tree, order = covertree.grow(points)
    assert sorted(order.tolist()) == list(range(len(raw)))
    for i in range(len(tree.begins)):
        mine = points[order[tree.begins[i]: tree.ends[i]]]
        assert covertree.distances(mine @ mine[0]).max() <= tree.radii[i] + 1e-7
    cell = {"a_classes": list(range(len(raw))), "a_copies": [1] * len(raw), "a_body": raw[order].tobytes(),
            **{f"a_{c}": getattr(tree, c) for c in ("begins", "ends", "radii", "children", "grown")}}
    side = covertree.Side(cell, "a")
    got = covertree.links(side, side, least)
    dots = points[order] @ points[order].T
    clear = np.abs(dots - least) > 1e-9
    assert (got == (dots >= least))[clear].all()


def test_parts_of_a_link_matrix():
    linked = np.zeros((5, 6), bool)
    linked[[0, 0, 3, 4, 4], [1, 2, 2, 5, 0]] = True
    rows, columns = covertree.parts(linked)
    assert rows.tolist() == [0, -1, -1, 0, 4] and columns.tolist() == [4, 0, 0, -1, -1, 4]


def brute_negatives(rows):
    held = [(i, [int(math.floor(256 * x)) for x in v], label) for i, v, label in rows if label is not None and usable(v)]
    last = float("inf")
    out = []
    for a, (i, x, label) in enumerate(held):
        if i is None or i % 100:
            continue
        scored = [(-min(max(sum(p * q for p, q in zip(x, y, strict=True)), 1 - 2**63), 2**63 - 1), last if j is None else j, b, other == label)
                  for b, (j, y, other) in enumerate(held) if b != a and len(y) == len(x)]
        best = sorted(s[:3] for s in scored if s[3])[:5]
        for s, j, _ in best:
            low = sorted(t[:2] for t in scored if not t[3] and 30 * -s <= 100 * -t[0] <= 90 * -s)[:10]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(low, 1)]
    return sorted((tuple(None if x == last else x for x in r) for r in out), key=repr)


def found_negatives(spark, rows):
    df = spark.createDataFrame(vector_rows(rows), VECTORS).repartition(3)
    return sorted((tuple(r) for r in hardneg.mine(df, F.col("id") % 100 == 0).collect()), key=repr)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    # Several blocks and batches of anchors.
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 100)
    monkeypatch.setattr(hardneg, "BATCH_ANCHORS", 4)
    rows = as_floats(made_vectors(np.random.default_rng(6)) + ODD)
    want = brute_negatives(rows)
    assert len(want) > 200
    assert found_negatives(spark, rows) == want


def test_ties_of_hard_negatives(spark):
    rows = [(100 * i, [1.0, 1.0], 1) for i in range(3)] + [(1000 + i, [0.5, 0.5], 2) for i in range(15)]
    got = found_negatives(spark, rows)
    assert got == brute_negatives(rows)
    assert {r[3] for r in got} == set(range(1000, 1010)) and len(got) == 3 * 2 * 10


def test_hard_negatives_of_nothing(spark):
    assert found_negatives(spark, []) == []
    assert found_negatives(spark, [(100, [1.0], 1), (200, [-1.0], 1), (3, [-0.5], 2), (300, None, 3)]) == []


def test_scores_beyond_double_precision_are_exact():
    columns = np.array([[3e15 + 2, 1.0], [7.0, 5.0]])
    block = hardneg.Block({"rows": [0, 1], "ids": [1, 2], "labels": [1, 1], "body": columns.tobytes(), "width": 2})
    at, scores = hardneg.scan(block, np.array([1001.0, 3.0]), np.arange(2), hardneg.Positives(5))
    assert scores.tolist() == [(3 * 10**15 + 2) * 1001 + 21, 1016]
    block = hardneg.Block({"rows": [0], "ids": [1], "labels": [1], "body": np.array([[1e30]]).tobytes(), "width": 1})
    for sign in (1, -1):
        at, scores = hardneg.scan(block, np.array([sign * 256.0]), np.arange(1), hardneg.Positives(5))
        assert scores.tolist() == [sign * (2**63 - 1)]


def test_vectors_by_width():
    column = pa.array([[1, 2], None, [3, None], [4], [], [5, 6]], pa.list_(pa.float32())).slice(0, 6)
    got = [(rows.tolist(), m.tolist()) for rows, m in vectors.by_width(column)]
    assert got == [([4], [[]]), ([3], [[4.0]]), ([0, 5], [[1.0, 2.0], [5.0, 6.0]])]


def brute_runs(text, least=12):
    n, found = len(text), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and text[i] == text[i + q]:
                i += 1
            if i - start >= q and i - start + q >= least:
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, q, m) for (s, m), q in found.items())


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=25), st.integers(1, 9), st.integers(0, 120)), min_size=1, max_size=5),
       st.sampled_from([2, 5, 12]))
def test_runs_equal_brute_force(made, least):
    texts = [head + [(head or [0])[i % min(p, len(head) or 1)] for i in range(tail)] for head, p, tail in made]
    ids = np.array([x for t in texts for x in t], np.int64)
    docs = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = list(zip(*(c.tolist() for c in periodic.runs_of(ids, docs, len(texts), least)), strict=True))
    assert got == [(d, s, m, q) for d, t in enumerate(texts) for s, q, m in brute_runs(t, least)]


def test_many_pairs_are_extended_in_portions(monkeypatch):
    monkeypatch.setattr(periodic, "_PAIRS", 50)
    rng = random.Random(3)
    texts = [[rng.randrange(3) for _ in range(40)] * 6, [0] * 200, list(range(30)) * 3]
    ids = np.array([x for t in texts for x in t], np.int64)
    docs = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = list(zip(*(c.tolist() for c in periodic.runs_of(ids, docs, 3)), strict=True))
    assert got == [(d, s, m, q) for d, t in enumerate(texts) for s, q, m in brute_runs(t)]


def test_runs_of_odd_documents(spark):
    long = " ".join(f"w{i % 997}x{i % 89}" for i in range(60_000)) + " end" * 50
    rows = [(1, None, "mine"), (2, "", "mine"), (3, " \t\n", "mine"), (None, "a b " * 9, "mine"), (5, "a b " * 9, "mine"),
            (5, "a b " * 9, "mine"), (6, long, "mine"), (7, "é x " * 12, "mine")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, runs STRING").repartition(3)
    out = {}
    for r in periodic.find_runs(docs).collect():
        out.setdefault(r.id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert out[1] == out[2] == out[3] == [(0, [], "")]
    assert out[None] * 2 == out[5] == [(18, [(0, 18, 2)], "a b")] * 2
    assert out[6][0][:2] == (60_050, [(60_000, 50, 1)]) and out[6][0][2] == long[: -4 * 49]
    assert out[7] == [(12, [(0, 12, 1)], "é x")]
    empty = docs.filter("doc_id > 99")
    assert periodic.find_runs(empty).count() == periodic.repeat_tails(empty).count() == 0


def test_tails_are_made_periodic(spark):
    import zlib

    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40))) for i in range(60)] + [(None, "a b"), (3, None)],
                                 "doc_id BIGINT, text STRING")
    got = sorted(map(tuple, periodic.repeat_tails(docs).collect()), key=repr)
    want = [(None, "a b"), (3, None)]
    for i in range(60):
        held = [f"w{j}" for j in range(40)]
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0:
            a, p = h // 10 % 40, 1 + (40 - h // 10 % 40) // (3 + h // 10 % 8)
            held = [held[k] if k < a else held[a + (k - a) % p] for k in range(40)]
        want.append((i, " ".join(held)))
    assert got == sorted(want, key=repr)


def test_word_numbers_tell_words_apart_that_share_a_polynomial_sum():
    """The Thue-Morse strings: sums modulo a power of two cannot tell them apart."""
    one, other = "a", "b"
    for _ in range(11):
        one, other = one + other, other + one
    data, offsets = words.flat(pa.array([" ".join([one, other] * 12)], pa.string()))
    n_words, runs, collapsed = periodic.measure(data, offsets, 12)
    assert runs.to_pylist() == [[{"start": 0, "length": 24, "period": 2}]] and collapsed.to_pylist() == [f"{one} {other}"]
