"""Operators 11 to 13 against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.llm import lloyd, queries, run_index, spelling

SF = "/root/testdata/sf0.001"


def lloyd_by_brute_force(rows, clusters, rounds, scale, dims):
    """rows: (vec_id, vector or None). Python integers throughout."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    name = lambda i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(((name(i), v) for i, v in kept))][:clusters]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        now = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, now, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    now, out = assign(), Counter()
    for (i, _), (c, d) in zip(kept, now, strict=True):
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out[(i, c, d, sum(e for b, e in now if b == c), sum(e for _, e in now), digest)] += 1
    return out


def test_lloyd(spark):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.integers(-3, 3, 3) / 4 + rng.normal(0, 0.2, 3)).astype("f4").tolist()) for i in range(200)]
    rows += [(7, rows[3][1]), (7, rows[4][1]), (7, rows[4][1]), (None, [0.5, 0.5, 0.5]), (900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 2.0]), (905, [float("-inf"), 0.0, 1.0])]
    schema = "vec_id bigint, embedding array<float>, cluster string"
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], schema)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for clusters, rounds in ((5, 0), (5, 3), (40, 5), (500, 2)):
        got = lloyd.cluster(df, clusters, rounds, 64, 3)
        assert got.columns == columns
        want = lloyd_by_brute_force(rows, clusters, rounds, 64, 3)
        assert Counter(tuple(r) for r in got.collect()) == want
        assert Counter(tuple(r) for r in lloyd.cluster(df.repartition(7), clusters, rounds, 64, 3).collect()) == want
    assert lloyd.cluster(df.limit(0), 5, 2, 64, 3).count() == 0
    assert lloyd.cluster(df.where("vec_id > 899"), 5, 2, 64, 3).count() == 0


def test_lloyd_ties_and_large_components(spark):
    # equal vectors, all at the same distance from both ends: the smaller number; one centroid gets nothing and stays
    rows = [(i, [float(i % 2), 0.0]) for i in range(8)] + [(9, [0.5, 0.0])] * 3
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert Counter(tuple(r) for r in lloyd.cluster(df, 4, 3, 8, 2).collect()) == lloyd_by_brute_force(rows, 4, 3, 8, 2)
    v = np.array([[3 << 20, -5], [-(3 << 20), 7]])
    number, distance = lloyd.nearest(v, v[::-1])
    assert number.tolist() == [1, 0] and distance.tolist() == [0, 0]
    assert lloyd.nearest(v[:1], v[1:])[1].tolist() == [(6 << 20) ** 2 + 144]
    with pytest.raises(OverflowError):
        lloyd.quantized(pd.DataFrame({"embedding": [[1e30, 0.0]]}), 2, 256)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def variants_by_brute_force(rows, every, least_chars, least, times):
    import re

    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_spelling(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    odd = [(1, None), (1, ""), (1, "12 !"), (None, "Straßenbahn STRAßenbahn straßenbahns ÀÉ×÷ÿabcd àé×÷ÿabcd"), (5, "remember " * 4000 + "remembr " * 40 + "rememb " * 3), (5, "remembe remembe 日本language language")]
    for rows, least_chars in ((docs, 7), (odd, 4), (docs[:40] + odd, 5)):
        df = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id bigint, text string, n bigint, word string")
        got = spelling.variants(df, least_chars=least_chars)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == variants_by_brute_force(rows, 31, least_chars, 2, 10)
    assert spelling.variants(df.limit(0)).count() == 0 and spelling.variants(df.where("text is null")).count() == 0


def test_spelling_finds_every_edit(spark):
    rng = np.random.default_rng(5)
    letters = "abcdeé×ÿ"
    words = {"".join(rng.choice(list(letters[:3]), n)) for n in rng.integers(3, 7, 300)}
    for w in list(words)[:60]:
        at, c = int(rng.integers(len(w))), letters[rng.integers(8)]
        words |= {w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w + c, c + w}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(df).collect()]
    want = {tuple(sorted((a, b))) for a in words for b in words if one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want
    # chains of forms, each ten times as frequent as the one before
    text = "abcdefgh " * 2 + "abcdefghi " * 20 + "abcdefghij " * 200 + "abcdefghijk " * 2000
    chain = spelling.variants(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), every=10**9)
    assert {(r.word, r.root) for r in chain.collect()} == {("abcdefgh" + "ijk"[:i], "abcdefghijk") for i in range(4)}


def dedup_by_brute_force(rows, window):
    """rows: (doc_id, text), in corpus order."""
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        removed = np.zeros(len(b), bool)
        for p in range(len(b) - window + 1):
            w = b[p : p + window]
            if w in seen:
                removed[p : p + window] = True
            seen.add(w)
        spans = int((removed & ~np.append(False, removed[:-1])).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~removed].tobytes()
        out.append((i, len(b), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus_order(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    return [(r.doc_id, r.text) for r in sorted(keyed, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))]


@pytest.mark.parametrize("heavy", [4096, 1])
def test_run_index(spark, heavy):
    rng = np.random.default_rng(13)
    words = ["alpha", "beta", "gamma", "délta", "日本", "x", "\n\n", "\0"]
    sentence = lambda n: " ".join(rng.choice(words, n)) + " " + str(rng.integers(10**6))
    parts = [sentence(int(n)) for n in rng.integers(2, 40, 12)]
    rows = [(int(i), " ".join(sentence(5) if rng.random() < 0.4 else parts[rng.integers(12)] for _ in range(rng.integers(1, 12)))) for i in rng.permutation(80)]
    rows += [(200, None), (201, ""), (202, "short"), (203, "z" * 700), (204, "ab" * 400 + "c"), (205, "z" * 99), (206, "z" * 100), (None, rows[3][1]), (None, parts[0] * 3), (7, rows[5][1]), (rows[6][0], rows[6][1]), (300, rows[8][1]), (300, rows[8][1]), (300, rows[8][1])]
    rows += [(400, parts[2] * 300), (401, "".join(chr(int(c)) for c in rng.integers(97, 123, 60_000)))]
    ordered = corpus_order(spark, rows)
    df = spark.createDataFrame([(i, t, True, "x", 3) for i, t in rows], "doc_id bigint, text string, none boolean, h string, start int").repartition(5)
    for window, gram in ((100, 16), (40, 8)):
        got = run_index.dedup(df, window, gram, texts=False, shard_bytes=5000, heavy=heavy)
        assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        assert Counter(tuple(r) for r in got.collect()) == dedup_by_brute_force(ordered, window)
    full = run_index.dedup(df, 40, 8, heavy=heavy).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in full) == dedup_by_brute_force(ordered, 40)
    for r in full:
        assert len(r.spans) == r.n_spans and sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert run_index.dedup(df.limit(0)).count() == 0


def test_run_index_on_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = corpus_order(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = Counter(tuple(r) for r in queries.op13_run_index(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == dedup_by_brute_force(rows, 100) and sum(r[2] for r in got) > 0


def test_long_texts_are_read_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(run_index, "_CHUNK", 333)
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 100, 3000).astype(np.uint8)).decode()
    buf = np.frombuffer((text + text[:50] + text[500:1500]).encode(), np.uint8)
    offsets = np.array([0, 3000, 3050, 4050])
    start, count, anchor = run_index.passages(buf, offsets, 100, 16)
    own = [s + i for s, n in zip(start, count, strict=True) for i in range(n)]
    assert own == [*range(2901), *range(3050, 3951)]
    of = dict(zip(own, np.repeat(anchor, count), strict=True))
    assert all(of[500 + i] == of[3050 + i] for i in range(901))


def test_run_index_matches_suffix_array():
    rng = np.random.default_rng(4)
    for _ in range(20):
        texts = [bytes(rng.integers(0, 3, int(n)).astype(np.uint8)) for n in rng.integers(1, 40, 12)]
        texts += [texts[0], texts[3] + texts[4], texts[3] + texts[4]]
        index = run_index.RunIndex(np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])))
        suffixes = sorted((t[i:] + b"", k, i) for k, t in enumerate(texts) for i in range(len(t) + 1))
        length, before = index.statistics()
        place = lambda k, i: int(index.base[k]) + i
        for (a, k, i), (b, m, j) in zip(suffixes, suffixes[1:], strict=False):
            common = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert length[place(m, j)] == common and before[place(m, j)] == place(k, i)
        assert len(index.rows) <= index.n and (np.diff(index.rows) > 0).all()
        seen = set()
        for k, t in enumerate(texts):
            for i in range(len(t) - 4):
                assert index.repeated(5)[place(k, i)] == (t[i : i + 5] in seen)
                seen.add(t[i : i + 5])
