"""Every query of the training-data operators on the small data, against brute force or its SQL twin."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry_points
from forecourt.llm import catalogue, mixing, tokens

SMALL = entry_points.SMALL
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "pages", "embeddings"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def of(name):
        if name not in held:
            held[name] = catalogue.REGISTERED[name](spark, SMALL).collect()
        return held[name]

    return of


@pytest.fixture(scope="module")
def docs(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_sql_twin(name, result, duck):
    rows = result(name)
    columns = sorted(rows[0].__fields__)
    twin = duck.sql(catalogue.ORACLES[name])
    assert sorted(twin.columns) == columns
    at = [twin.columns.index(c) for c in columns]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in rows))) == sorted(
        map(repr, (tuple(r[i] for i in at) for r in twin.fetchall())))


def test_urls(result, duck):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    want = {}
    for page, url in duck.sql("SELECT page_id, url FROM pages").fetchall():
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [r for r in rules if path.startswith("/" + r.split("/", 1)[1])
               and ("." + host).endswith("." + r.split("/", 1)[0])]
        want[page] = (host, path, max(fit, key=len) if fit else None)
    got = result("op1_url_filter")
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == want
    assert all(r.verdict == rules[r.rule] for r in got if r.rule)
    assert {r.verdict for r in got if not r.rule} <= {"allow", "block"}


def test_mix(result, docs, duck):
    rows = result("op2_entropy_mix")
    source = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    total = Counter()
    for doc, text in docs.items():
        total[source[doc]] += len(SPACED.findall(text))
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    full, everything = set(), sum(total.values())
    while True:
        level = (everything - sum(3 * total[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 3 * total[s]}
        if not more:
            break
        full |= more
    taken = Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r.size == len(SPACED.findall(docs[r.doc_id])) and r.source_size == total[s]
        assert r.target == pytest.approx(3 * total[s] if s in full else weight[s] * level, rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
    target = {source[r.doc_id]: r.target for r in rows}
    assert len(rows) == len(docs)
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 60)


def test_quality(result, docs):
    got = {r.doc_id: r for r in result("op4_quality_rules")}
    assert got.keys() == docs.keys()
    for doc, text in docs.items():
        words = SPACED.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if SPACED.search(line):
                dup += line in seen
                seen.add(line)
        grams = defaultdict(list)
        for i in range(len(words) - 2):
            grams[tuple(words[i:i + 3])].append(i)
        repeated = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
        longest = defaultdict(list)
        for i in range(len(words) - 9):
            longest[tuple(words[i:i + 10])].append(i)
        covered = {j for at in longest.values() if len(at) > 1 for i in at for j in range(i, i + 10)}
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_tokens(result, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.public_vocabulary())
    got = {r.doc_id: r for r in result("op5_token_files")}
    assert got.keys() == docs.keys()
    start = 0
    for doc in sorted(docs):
        ids = library.encode(docs[doc], add_special_tokens=False).ids + [1]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_html(result, duck):
    got = {r.page_id: r for r in result("op8_html_text")}
    for page, url, html in duck.sql("SELECT * FROM pages").fetchall():
        import html as codec

        article = re.search(r"(?s)<article>(.*?)(</article>|$)", html)[1]
        want = codec.unescape(" ".join(re.sub(r"</?(p|h1|br)>", " ", article).split()))
        want = " ".join(re.sub(r"</?b>", "", want).split())
        assert (got[page].url, got[page].text, got[page].n_chars) == (url, want, len(want))


def test_suffixes(result, docs):
    got = {r.doc_id: r for r in result("op9_suffix_dedup")}
    raw = {d: t.encode() for d, t in docs.items()}
    counts = Counter(b[i:i + 200] for b in raw.values() for i in range(len(b) - 199))
    for doc, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if counts[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_passages(result, docs):
    got = {r.doc_id: r for r in result("op10_passage_dedup")}
    split = {d: SPACED.findall(t) for d, t in docs.items()}
    first = {}
    for doc in sorted(split):
        for i in range(len(split[doc]) - 49):
            first.setdefault(tuple(split[doc][i:i + 50]), doc)
    for doc, words in split.items():
        gone = set()
        for i in range(len(words) - 49):
            if first[tuple(words[i:i + 50])] < doc:
                gone.update(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        r = got[doc]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (
            len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_near_duplicate_stage_equals_brute_force_at_80(spark, docs):
    import corpus_pipeline

    twenty = [f"t{i}" for i in range(24)]
    texts = docs | {10**9: " ".join(twenty), 10**9 + 1: " ".join([*twenty, *"abcd"]),  # 20 of 24, 0.83
                    10**9 + 2: " ".join([*twenty[1:], *"efghij"])}  # 19 of 26
    sets, root = {}, {d: d for d in texts}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = defaultdict(list)
    for doc, text in texts.items():
        found = SPACED.findall(text.translate(lower))
        sets[doc] = {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()
        for shingle in sets[doc]:
            holders[shingle].append(doc)

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    both = Counter((a, b) for held in holders.values() for a in held for b in held if a < b)
    between_limits = 0
    for (a, b), n in both.items():
        union = len(sets[a]) + len(sets[b]) - n
        between_limits += 80 * union <= 100 * n < 85 * union
        if 100 * n >= 80 * union and top(a) != top(b):
            one, other = sorted((top(a), top(b)))
            root[other] = one
    table = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    left = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, table, SMALL)
    assert between_limits and sorted(r.doc_id for r in left.collect()) == sorted(d for d in root if top(d) == d)


def test_pipeline_agrees_with_its_operators(spark, result, docs):
    import corpus_pipeline

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, table, SMALL)
    kept = {r.doc_id for r in result("op4_quality_rules") if r.kept}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == table.columns
    single = stages["near-duplicates"](spark, good, SMALL)
    groups = catalogue.neardup.group(good).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted(r.id for r in groups if r.kept)
    clean = stages["benchmark decontamination"](spark, single, SMALL)
    dirty = {r.doc_id for r in result("op3_decontaminate") if r.contaminated}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - dirty
    mix = {r.id: r.copies for r in mixing.mix(clean).collect()}
    out = Counter(r.doc_id for r in stages["mixing"](spark, clean, SMALL).collect())
    assert out == Counter({d: c for d, c in mix.items() if c})
    rows = result("pipeline")
    assert Counter(r.doc_id for r in rows) == out
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
