"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import bpe, components, katz, langid, near_dup, order_minhash, packing, quality, queries, token_orc, topk, toxicity
from tidewell.llm._arrays import Tokens

SF = "/root/testdata/sf0.001"
WORD, BYTE = queries.tokenizer_path("word_bpe_49k.json"), queries.tokenizer_path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "Don't  we'LL\n\nx's 12² ", "<|endoftext|>hi <|endoftext|>", "日本語 です x", "ab " * 9000, "z" * 5000, "same text here", "same text here"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 7) for i, t in enumerate(ODD)] + [(None, "no id", None, None, 1), (3, "an id again", "en", "s", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n bigint")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_bpe(spark, odd, docs):
    lib = library(BYTE)
    for df in (odd, docs):
        texts = Counter((t or "") for (t,) in df.select("text").collect())
        got = bpe.encode(df, BYTE)
        assert got.count() == sum(texts.values())
        want = Counter()
        for t, n in texts.items():
            ids = lib.encode(t, add_special_tokens=False).ids
            want[(len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += n
        assert Counter((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want
        assert Counter(r.text for r in bpe.decode(got, BYTE).collect()) == texts
    assert bpe.encode(odd.limit(0), BYTE).count() == 0


def test_token_orc(spark, odd, tmp_path):
    lib, out = library(WORD), str(tmp_path / "orc")
    token_orc.write_tokens(odd, out, WORD)
    tokens = token_orc.read_tokens(spark, out)
    rows = token_orc.with_starts(token_orc.token_digests(tokens), tokens).collect()
    want = sorted([(r.doc_id, r.text) for r in odd.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (doc_id, text), r in zip(want, sorted(rows, key=lambda r: r.start), strict=True):
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokens.where("doc_id = 5").count() == 1


def test_best_cuts():
    rng = np.random.default_rng(3)
    for _ in range(50):
        at = np.append(0, np.cumsum(rng.integers(1, 9, 12)))
        cost, w = rng.integers(0, 4, len(at)), 9

        def price(i, j):
            n = int(at[j] - at[i])
            return math.inf if n > w else (0 if n in (4, 8) else w - n) + int(cost[j]) + 1

        best = [0] + [math.inf] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + price(i, j) for i in range(j))
        cuts = [0, *packing.best_cuts(at, cost, w, shortest=4, each=1)]
        assert sum(price(a, b) for a, b in zip(cuts, cuts[1:], strict=False)) == best[-1]


def test_pack(spark, odd):
    lib = library(WORD)
    rows = packing.pack(odd.where("doc_id is not null and text <> 'an id again' or doc_id <> 3"), WORD, window=64, block=3000).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, own in by_doc.items():
        own.sort(key=lambda r: r.start)
        ids = [x for r in own for x in r.ids]
        assert ids == [*lib.encode(ODD[i] or "", add_special_tokens=False).ids, 1]
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1]) and {r.doc_tokens for r in own} == {len(ids)}
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in own)
    assert len(by_doc) == len(ODD)
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1]) and sum(r.length for r in own) <= 64
    assert packing.pack(odd.limit(0), WORD).count() == 0


def test_tokens():
    texts = [b"", b" a  b\n", b"x" * 10, b"one two " * 300_000]
    t = Tokens(texts)
    assert np.diff(t.offsets).tolist() == [0, 2, 1, 600_000]
    assert len(set(t.hash.tolist())) == 5


def katz_by_brute_force(texts, order):
    """texts: id -> words and an end. The recursion as it is written, over counters."""
    counts = [Counter() for _ in range(order)]
    for i, w in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            padded = ["<s>"] * (order - 1) + w
            for j in range(order - 1, len(padded)):
                for n in range(order):
                    counts[n][tuple(padded[j - n : j + 1])] += 1
    d = [katz.discounts([sum(v == k for v in c.values()) for k in range(1, 7)]) for c in counts]
    kept = lambda n, c: c - 0.5 if c > 5 else d[n][c] * c
    total = sum(counts[0].values())
    after, freed = [Counter() for _ in range(order)], [Counter() for _ in range(order)]
    for n in range(order):
        for g, c in counts[n].items():
            after[n][g[:-1]] += c
            freed[n][g[:-1]] += c - kept(n, c)
    taken = [None] * order

    def prob(h, w):
        n = len(h)
        c = counts[n].get((*h, w), 0)
        if n == 0:
            return (kept(0, c) if c else freed[0][()]) / total
        if c:
            return kept(n, c) / after[n][h]
        lower = prob(h[1:], w)
        return lower * freed[n][h] / after[n][h] / (1 - taken[n][h]) if after[n][h] else lower

    for n in range(1, order):
        taken[n] = Counter()
        for g in counts[n]:
            taken[n][g[:-1]] += prob(g[1:-1], g[-1])
    return counts, total, after, prob


@pytest.mark.parametrize("order,parts,more", [(1, 1, {}), (2, 4, {}), (3, 16, {}), (4, 1, {}), (2, 8, {"direct": 0, "coarse": 2}), (3, 4, {"direct": 0, "coarse": 4})])
def test_katz(spark, docs, order, parts, more, monkeypatch):
    if more:  # several chunks and bundles
        monkeypatch.setattr(katz, "BUNDLE", 4)
        docs = docs.repartition(3)
    rows = {r.doc_id: r for r in katz.score(docs, order=order, chunk_tokens=5000 - 4000 * bool(more), parts=parts, **more).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    counts, total, after, prob = katz_by_brute_force(texts, order)
    one = {g[0]: c for g, c in counts[0].items()}
    for i, w in texts.items():
        padded = ["<s>"] * (order - 1) + w
        want = sum(math.log10(prob(tuple(padded[j : j + order - 1]), x)) for j, x in enumerate(w))
        assert rows[i].score == pytest.approx(want, rel=1e-9)
        assert rows[i].base_score == pytest.approx(sum(math.log10((one.get(x, 0) + 0.1) / (total + 0.1 * (len(one) + 1))) for x in w), rel=1e-9)
        assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (len(w), sum(x in one for x in w), total)
    for h in list(after[order - 1])[:4]:  # the probabilities after a history sum to 1
        assert sum(prob(h, w) for w in one) + prob(h, "unheard") == pytest.approx(1)


def test_katz_on_odd_rows(spark, odd):
    rows = katz.score(odd.withColumn("chunk", F.lit(1)).withColumn("held", F.lit("x")), order=3).collect()
    assert len(rows) == odd.count() and katz.score(odd.limit(0)).count() == 0
    by = {r.doc_id: r for r in rows if r.doc_id not in (3, None)}
    assert by[0].n_tokens == by[1].n_tokens == by[2].n_tokens == 1 and by[0].score == by[1].score
    assert by[9].score == by[10].score  # repeats
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    lone = katz.score(spark.createDataFrame([(i, "a b") for i in held], "doc_id bigint, text string")).collect()
    assert len(lone) == len(held) and all((r.score, r.base_score, r.train_tokens, r.n_known, r.held_out) == (0, 0, 0, 0, True) for r in lone)


def test_katz_chunk_numbers_of_late_partitions(spark):
    rows = katz.chunks(spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id bigint, text string").coalesce(1), 10, 100)
    late = rows.withColumn("chunk", F.col("chunk") + F.lit(5000 << 32))
    answers = katz.counted(katz.requests(late, 2, 2))
    model = katz.Model([[7, 4, 2, 1, 1, 0, 0, 0], [7, 6, 5, 1, 0, 0, 0, 0]])
    scored = katz.evaluated(late, answers, model, 2, 2)
    assert {r.chunk for r in scored.collect()} == {5000 << 32}
    assert katz.backed_off(scored).schema.simpleString() == "struct<chunk:bigint,row:int,extra:double>"


def test_order_minhash(spark, docs, odd):
    for df in (docs, odd):
        rows = sorted([(r.doc_id, r.text or "") for r in df.collect()], key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
        rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        got = Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in order_minhash.fingerprints(df, ranges=5).collect())
        want = Counter()
        for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
            half = len(t) // 2
            want[(i, len(t), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest())] += 1
        assert got == want
    sign = lambda t: order_minhash.signature(order_minhash.code_points(t))
    a, b = "the quick brown fox jumps over the lazy dog " * 3, "a wholly different line of words " * 4
    assert order_minhash.likeness(sign(a), sign(a)) == 1 > order_minhash.likeness(sign(a), sign(a.replace("lazy", "calm"))) > order_minhash.likeness(sign(a), sign(b))
    assert order_minhash.fingerprints(odd.limit(0)).count() == 0


def test_near_dup(spark, docs, odd):
    def brute(df, width):
        rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in df.collect()]
        sets = {i: {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set()) for i, w in rows}
        root = {i: i for i in sets}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a in sets:
            for b in sets:
                if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
        return {i: (len(s), find(i)) for i, s in sets.items()}

    base = [f"w{j}" for j in range(60)]
    rng = np.random.default_rng(1)
    copies = []
    for i in range(300):  # a group of near copies, of which many are less alike than the threshold
        w = list(base)
        for j in rng.choice(60, int(rng.integers(0, 7)), replace=False):
            w[j] = f"x{i}_{j}"
        copies.append((i, " ".join(w)))
    group = spark.createDataFrame(copies, "doc_id bigint, text string")
    for df, width in ((docs, 2), (docs, 5), (group, 2)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, width).collect()}
        assert got == brute(df, width)
    rows = near_dup.near_duplicates(odd, 2).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == len(ODD) + 1 and by[10].component_id == 9 and not by[10].kept and by[0].kept and by[0].n_shingles == 0
    assert near_dup.near_duplicates(odd.limit(0)).count() == 0
    assert {r.doc_id for r in near_dup.first_of_each(odd).collect()} == {None, *range(len(ODD))} - {10}


def test_near_dup_at_a_third(spark):
    words = lambda i, own: " ".join([f"s{i}x{j}" for j in range(150)] + [f"{own}{i}x{j}" for j in range(150)])  # noqa: E731  150 of 450 in common
    pairs = spark.createDataFrame([(2 * i + k, words(i, "ab"[k])) for i in range(40) for k in range(2)], "doc_id bigint, text string")
    got = near_dup.near_duplicates(pairs, width=1, percent=30).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: d - d % 2 for d in range(80)}


def test_components(spark):
    n = 40
    path = spark.range(1, n).select(F.col("id").alias("hi"), (F.col("id") - 1).alias("lo"))
    assert {(r.node, r.root) for r in components.components(path).collect()} == {(i, 0) for i in range(1, n)}


def test_topk(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[17], x[18], x[200] = x[16], x[16], x[16]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000, None), (1100, [1.0, None] * 4), (1200, [math.nan] * 8), (None, [0.0] * 8), (1300, [])]
    got = topk.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), block=64, queries=2).collect()
    q = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    for i in range(0, 400, 100):
        score = q @ q[i]
        best = [j for j in np.lexsort((np.arange(400), -score)) if j != i][:10]
        own = sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)
        assert [(r.rank, r.vec_id, r.score) for r in own] == [(k + 1, j, score[j]) for k, j in enumerate(best)]
    assert len(got) == 40
    assert topk.search(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_classifiers(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    for module, label, least in ((quality, "quality", 0.9), (toxicity, "toxic", 0.9)):
        model = module.fit(docs, labels)
        rows = module.score(docs, model).join(labels, "doc_id").where(held)
        assert rows.where(F.col("predicted") == F.col(label)).count() >= least * rows.count()
        got = module.score(odd, model)
        assert got.count() == odd.count() and got.where("score is null or score < 0 or score > 1").count() == 0
        none = module.fit(odd.limit(0), labels.limit(0))
        assert module.score(odd, none).count() == odd.count()
        assert module.accepted(odd, model).columns == odd.columns
    model = langid.fit(docs)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert rows.where("lang = lang_pred").count() >= 0.95 * rows.count()
    assert {r.lang_pred for r in langid.predict(odd, model).where("doc_id in (0, 1, 2)").collect()} == {"und"}
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(odd.limit(0))).collect()} == {"und"}


def test_factors_learn_pairs():
    rng = np.random.default_rng(2)
    sample = []
    for i in range(3000):
        own = {k for k in (1, 2) if rng.random() < 0.5}
        sample.append((int(own == {1, 2}), i, np.array(sorted(own | {int(rng.integers(10, 60))}), np.uint64)))
    model = toxicity.factorize(sample)
    find = lambda ids: toxicity.Sparse(model.keys).find(np.array(ids, np.uint64))[1]
    assert model.raw(find([1, 2])) > 0 > max(model.raw(find([1])), model.raw(find([2])))


def test_factors_learn_pairs_of_weak_terms():
    rng = np.random.default_rng(3)

    def draw(n):  # toxic: one of 40 insults and one of 40 groups; clean: only one of the two
        out = []
        for i in range(n):
            insult, group, only = rng.integers(1, 41), rng.integers(41, 81), rng.integers(2)
            out.append((i % 2, i, np.array([insult, group] if i % 2 else [(insult, group)[only]], np.uint64)))
        return out

    sample, held = draw(6000), draw(1000)
    model = toxicity.factorize(sample)
    assert model.keys.tolist() == list(range(1, 81))
    wrong = sum((model.raw(toxicity.Sparse(model.keys).find(own)[1]) >= 0) != y for y, _, own in held)
    assert wrong <= 50


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept.count(), stage(spark, kept, "/root/testdata/sf0.01")
        assert kept.columns == docs.columns and 0.7 * before < kept.count() <= before
    packed = corpus_pipeline.STAGES[3][1](spark, kept, "/root/testdata/sf0.01")
    assert packed.select("doc_id").distinct().count() == kept.count()


def components_by_brute_force(rows, width):
    sets = {i: {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set()) for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def template_rows():
    """Rows that share a template but are not alike: short ones, and long ones of which half is the same."""
    half = " ".join(f"t{j}" for j in range(70))
    short = [(i, f"one two three four five own{i}") for i in range(150)]
    return short + [(1000 + i, f"{half} " + " ".join(f"o{i}x{j}" for j in range(70))) for i in range(60)]


def near_groups():
    """Chains, stars and copies of which many two are less alike than the threshold."""
    rng = np.random.default_rng(4)
    base, rows = [f"w{j}" for j in range(90)], []
    for i in range(120):
        w = list(base)
        for j in rng.choice(90, int(rng.integers(0, 9)), replace=False):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    chain = [f"c{j}" for j in range(40)]
    rows += [(500 + i, " ".join(chain[i : i + 30])) for i in range(10)]
    rows += [(600 + i, "exact copy of one and the same text") for i in range(50)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"few": 2, "pivots": 1, "members": 16, "room": 4000}])
def test_near_dup_groups(spark, sizes):
    rows = template_rows() + near_groups()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df, 2, **sizes).collect()}
    assert got == components_by_brute_force(rows, 2)


def test_near_dup_lists_of_templates(spark):
    """Templates make no candidates: neither lists, for small sets, nor members that go on to full sets, for large ones."""
    rows = spark.createDataFrame(template_rows(), "doc_id bigint, text string")
    scanned = near_dup.sketches(rows, 2, 64).where("n > 0")
    classes = scanned.groupBy("n", "s1", "s2", "c").agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch"))
    index = near_dup.listed(classes, 64, 80)
    pairs = index.where("n < 64").groupBy("v", "m").agg(F.max("small").alias("pairs"), F.count("*").alias("k")).where("pairs and k > 1")
    assert pairs.count() == 0
    large = classes.where("n > 64").select(F.lit(1).cast("bigint").alias("p"), "c", "n", F.col("c").alias("label"))
    assert near_dup._alive(large, classes, 64, 80, 16).count() == 0


def test_first_of_each_is_by_row(spark):
    same, other = "a b c d e f g h", "p q r s t u v w"
    rows = [(1, same, "x"), (2, same, "y"), (2, other, "z"), (None, same, "n"), (None, "lone text without id here", "o"), (None, "lone text without id here", "o"), (5, "", "e"), (6, None, "f"), (7, other, "g"), (7, other, "g")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n string")
    got = Counter(tuple(r) for r in near_dup.first_of_each(df).collect())
    assert got == Counter([(1, same, "x"), (2, other, "z"), (None, "lone text without id here", "o"), (5, "", "e"), (6, None, "f")])
    assert {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(df).collect()} == {(1, 1), (2, 1), (None, 1), (None, None), (5, 5), (6, 6), (7, 2)}
    clash = df.withColumnsRenamed({"n": "sketch"}).withColumn("c", F.lit(1)).withColumn("row", F.lit("r")).withColumn("likely", F.lit(False))
    assert near_dup.first_of_each(clash).columns == clash.columns and near_dup.first_of_each(clash).count() == 5
    assert near_dup.first_of_each(df.limit(0)).count() == 0


def test_components_of_a_star_and_nothing(spark):
    star = spark.range(1, 3000).select(F.col("id").alias("hi"), F.lit(0).cast("bigint").alias("lo"))
    more = star.unionAll(spark.range(1, 50).select((F.col("id") + 5000).alias("hi"), (F.col("id") + 100).alias("lo"))).unionAll(star.limit(5))
    got = components.components(more).collect()
    assert len(got) == 2999 + 49 and {r.root for r in got} == {0}
    assert components.components(star.limit(0)).count() == 0


@pytest.mark.parametrize("kind,most", [("together", 20), ("xor", 60)])
def test_factors_learn_what_no_term_says_alone(kind, most):
    """Two terms that are equally frequent in both classes: toxic is both together, or exactly one of them."""
    rng = np.random.default_rng(6)

    def draw(n):
        out = []
        for i in range(n):
            a, b, y = int(rng.integers(2)), int(rng.integers(2)), i % 2
            if kind == "together":
                a, b = (a, a) if y else (a, 1 - a)
            else:
                y = int(a != b)
            own = {k for k, there in ((1, a), (2, b)) if there} | set(rng.integers(100, 2000, 12).tolist())
            out.append((y, i, np.array(sorted(own), np.uint64)))
        return out

    model, held = toxicity.factorize(draw(6000)), draw(1000)
    assert sum((model.raw(toxicity.Sparse(model.keys).find(own)[1]) >= 0) != y for y, _, own in held) <= most


def test_factor_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(8)
    model = toxicity.FactorModel(np.arange(1, 9).astype(np.uint64), rng.normal(size=8), rng.normal(size=(8, 3)), 0.3)
    own = np.array([0, 2, 3, 7])
    pairs = sum(float(model.factors[a] @ model.factors[b]) for a in own for b in own if a < b)
    assert model.raw(own) == pytest.approx(0.3 + model.weights[own].sum() + pairs)


def test_ftrl_step_by_step():
    rng = np.random.default_rng(9)
    sample = [(int(rng.integers(2)), i, np.array(sorted(set(rng.integers(1, 12, 4).tolist())), np.uint64)) for i in range(80)]
    alpha, beta, l1, l2 = 0.1, 1.0, 0.5, 1.0
    z, n = Counter(), Counter()

    def weight(k):
        free = 0.0 if k == "bias" else l1
        return 0.0 if abs(z[k]) <= free else -(z[k] - math.copysign(free, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for _ in range(2):
        for y, _, own in sample:
            keys = [*own.tolist(), "bias"]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for k in keys:
                sigma = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha
                z[k] += g - sigma * w[k]
                n[k] += g * g
    model = quality.ftrl(sample, alpha, beta, l1, l2, epochs=2, least=1)
    want = {k: weight(k) for k in range(1, 12) if weight(k)}
    assert dict(zip(model.keys.tolist(), model.weights, strict=True)) == pytest.approx(want) and model.bias == pytest.approx(weight("bias"))


def test_classifiers_on_long_texts_ties_and_clashing_names(spark):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(200)], "doc_id bigint, quality int, toxic int")
    text = lambda i: ("good words here " if i % 2 else "bad slur group ") * (30000 if i in (0, 1) else 3)
    rows = [(i, text(i), 1.0, "x") for i in range(200)] + [(7, text(8), 2.0, "y"), (None, None, 3.0, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double, y string")
    for module in (quality, toxicity):
        model = module.fit(docs, labels)
        got = module.score(docs, model).collect()
        assert len(got) == 202 and len({r.score for r in got if r.doc_id is not None and r.doc_id > 1 and r.doc_id % 2 == 0}) == 1
        kept = module.accepted(docs, model)
        assert kept.columns == docs.columns and kept.count() == sum((r.score >= 0.3) if module is quality else (r.score < 0.5) for r in got)


def test_sorted_lists_are_read_until_outsiders_cannot_qualify():
    rng = np.random.default_rng(11)
    x = np.floor(1024 * rng.normal(size=(500, 6)) * np.array([8, 4, 2, 1, 0.5, 0.1])).astype(np.int64)
    x[7] = x[6]  # a tie
    lists = topk.SortedLists(x)
    assert not any(np.array_equal(v, x) for v in vars(lists).values())  # there is nothing to look a vector up in
    q = x[:20]
    k = np.full(20, 5)
    rows, scores, (stopped, read) = lists.top(q, k)
    want = q @ x.T
    for j in range(20):
        assert set(np.argsort(-want[j], kind="stable")[:5].tolist()) <= set(rows[j].tolist())
        assert scores[j].tolist() == want[j, rows[j]].tolist()
    assert stopped < 1 and stopped <= read
    # until shortly before the stop, more than k vectors could still qualify
    for j in range(3):
        d = [d for d in lists.depths() if d / 500 < stopped][-1]
        best, worst = np.empty(500), np.empty(500)
        rank = np.argsort(np.argsort(x, 0, kind="stable"), 0, kind="stable")
        for i in range(500):
            seen = np.where(q[j] >= 0, rank[i] >= 500 - d, rank[i] < d)
            last = np.where(q[j] >= 0, lists.values[500 - d], lists.values[d - 1])
            low = np.where(q[j] >= 0, lists.values[0], lists.values[-1])
            best[i], worst[i] = (np.where(seen, x[i], last) * q[j]).sum(), (np.where(seen, x[i], low) * q[j]).sum()
        if (best >= np.sort(worst)[-5]).sum() > 5:
            break
    else:
        raise AssertionError("reading went on for nothing")


def test_topk_beyond_doubles(spark):
    big = [(0, [1e6, 1.0]), (1, [1e6, 2.0]), (2, [9e5, 5e5]), (3, [float("inf"), 0.0]), (100, [-1e6, 7.0])]
    df = spark.createDataFrame(big, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1)).withColumn("block", F.lit(0))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(df).collect()}
    q = {i: [int(math.floor(1024 * x)) for x in v] for i, v in big if i != 3}
    for i in (0, 100):
        best = sorted(((sum(a * b for a, b in zip(q[i], q[j], strict=True)), -j) for j in q if j != i), reverse=True)
        assert [got[i, n + 1] for n in range(3)] == [(-j, s) for s, j in best]
    with pytest.raises(Exception, match="64 bits"):
        topk.search(spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id bigint, embedding array<double>")).collect()


def test_topk_of_repeated_ids(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(df).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 512 * 1024), (0, 2, 1, 512 * 1024)]  # the smallest vector of the id asks; both rows of 1 answer


def test_order_minhash_by_brute_force(spark):
    """Tuples of the l smallest numbered k-mers of each hash function, in the order of the text."""
    rng = np.random.default_rng(13)
    words = ["alpha", "beta", "gamma", "delta", "ab", "a"]
    texts = {i: " ".join(rng.choice(words, int(rng.integers(0, 40)))) for i in range(30)} | {40: "short", 41: "", 42: "aaaaaaaaaaaaaaaa", 43: "日本" * 9}

    def tuples(text):
        x = order_minhash.code_points(text)
        k = min(6, len(x))
        if not k:
            return np.zeros(64, np.uint32)
        numbered, seen = [], Counter()
        for i in range(len(x) - k + 1):
            gram = tuple(x[i : i + k].tolist())
            numbered.append((gram, seen[gram]))
            seen[gram] += 1
        hashes = order_minhash.numbered_kmers(x)
        by = {}
        for key, h in zip(numbered, hashes.tolist(), strict=True):
            assert by.setdefault(key, h) == h  # one hash a numbered k-mer
        assert len(set(hashes.tolist())) == len(by)
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        out = []
        for m in range(64):
            rank = low * order_minhash._ODD[m] + order_minhash._ADD[m]
            picked = sorted(np.argsort(rank, kind="stable")[: min(2, len(rank))].tolist())
            value = np.zeros(1, np.uint64)
            for i in picked:
                value = order_minhash.mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + 1])
            out.append(max(int(value[0] >> np.uint64(32)), 1))
        return np.array(out, np.uint32)

    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in order_minhash.fingerprints(df, ranges=4).collect()}
    ring = sorted(texts, reverse=True)
    for i, j in zip(ring, ring[1:] + ring[:1], strict=True):
        a, b = texts[i], texts[j]
        half = len(a) // 2
        own, edited, following = tuples(a), tuples(a[: len(a) - half] + b[:half]), tuples(b)
        assert got[i].fingerprint == own.astype(">u4").tobytes().hex() and got[i].edited_fingerprint == edited.astype(">u4").tobytes().hex()
        assert got[i].near_edited == (own == edited).mean() and got[i].near_next == (own == following).mean()


def test_langid_by_brute_force(spark):
    """Smoothed TF-IDF over all training texts, cosine to the nearest centroid, rejection far from all."""
    rng = np.random.default_rng(14)
    kinds = {"aa": "abcde", "bb": "vwxyz", "日": "日本語中文"}
    rows = [(i, " ".join("".join(rng.choice(list(kinds[k]), 4)) for _ in range(12)), k) for i, k in enumerate(list(kinds) * 40)]
    rows += [(1000, "日本 abc" * 20000, None), (1001, "qqqq kkkk qkqk " * 9, None), (1002, "12 !", None), (1003, None, "aa"), (1004, "", "aa")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("key", F.lit(1)).withColumn("share", F.lit(0))
    model = langid.fit(docs)
    train = [t for i, t, k in rows if k and t and zlib.crc32(str(i).encode()) % 4 != 2]
    table = np.stack([langid.profile(t)[0] for t in train])
    idf = np.log((1 + len(train)) / (1 + (table > 0).sum(0))) + 1
    assert model.idf == pytest.approx(idf, rel=1e-5)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t, k in rows:
        x = np.log1p(langid.profile(t)[0]) * idf if t else np.zeros(4096)
        if not x.any():
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0, True)
            continue
        cosine = (model.centres / np.linalg.norm(model.centres, axis=1, keepdims=True)) @ (x / np.linalg.norm(x))
        assert got[i].score == pytest.approx(max(cosine.max(), 0), abs=1e-4) and got[i].lang_pred == model.langs[int(cosine.argmax())]
        if k:
            assert got[i].lang_pred == k
    assert got[1001].rejected and sum(got[i].rejected for i, _, k in rows if k) <= 3
    many = spark.createDataFrame([(i, chr(0x4E00 + i % 450) * 5, f"l{i % 450:03d}") for i in range(1800)], "doc_id bigint, text string, lang string")
    assert len(set(langid.fit(many, clusters=1).langs)) == 450  # no language is left out
    few = langid.fit(many, clusters=1, max_all=100)
    assert len(set(few.langs)) == 450
    assert langid.fit(spark.createDataFrame([(None, "same text", "x")] * 500, "doc_id bigint, text string, lang string"), max_each=5).langs


def test_profile_counts_letters():
    counts, n = langid.profile("Ab b")
    assert n == 3 and counts.sum() == 3 + 5 + 4  # letters, then pairs and triples with the spaces around
    assert langid.profile("a" * 10)[1] == 10 and langid.profile("日本")[1] == 2 and langid.profile("1 !")[1] == 0


def test_long_texts_are_cut_before_lone_spaces():
    from tidewell.llm import _arrays, _bpe

    rng = np.random.default_rng(15)
    texts = [b"".join(rng.choice([b"word", b" ", b"  ", b"\n", b" x", b"\n\n "], 400)) for _ in range(20)] + [b" " * 300, b"y" * 300, b"a \n b" * 60]
    for lone in (False, True):
        parts: dict[int, list[bytes]] = {}
        for docs, held in _arrays.pieces(texts, 50, lone):
            for d, x in zip(docs.tolist(), held, strict=True):
                parts.setdefault(d, []).append(x)
        for i, text in enumerate(texts):
            assert b"".join(parts[i]) == text
            for x, y in zip(parts[i], parts[i][1:], strict=False):
                assert y[:1] in (b" ", b"\n") and (not lone or (y[:1] == b" " and x[-1:] not in b" \n" and y[1:2] not in b" \n"))
    lib, enc = library(BYTE), _bpe.CutBPE(BYTE)
    long = ["one  two\n\n three   four " * 40 + " end", "z" * 700, "\n \n" * 300 + "x"]
    whole = _bpe._byte_pieces
    try:
        _bpe._byte_pieces = lambda t: whole(t, 64)
        flat, counts = enc.encode(long)
    finally:
        _bpe._byte_pieces = whole
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [lib.encode(t, add_special_tokens=False).ids for t in long]


def test_decode_of_nulls_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [72, None, -1, 10**8])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(rows, BYTE).collect()}
    assert got[1] is None and got[2] == "" and got[3] == library(BYTE).decode([72], skip_special_tokens=False)


def test_pack_null_and_repeated_keys(spark, odd):
    """Null keys come first, rows of one key in the order of their texts; nothing is lost or joined."""
    lib = library(WORD)
    rows = packing.pack(odd.coalesce(1).withColumn("start", F.lit(1)), WORD, window=64).collect()
    by_seq, want = {}, sorted([(r.doc_id, r.text) for r in odd.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        by_seq.setdefault(r.sequence_id, []).append(r)
    pieces = [r for own in by_seq.values() for r in own]
    texts, at = [], 0
    for doc_id, text in want:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        got = []
        while len(got) < len(ids):
            r = pieces[at]
            assert (r.doc_id, r.start, r.doc_tokens) == (doc_id, len(got), len(ids))
            got += r.ids
            at += 1
        texts.append(got == ids)
    assert all(texts) and at == len(pieces)


def scanned(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_token_orc_stripes_index_and_bloom_filter(spark, tmp_path):
    import glob

    import pyarrow.orc as orc

    out = str(tmp_path / "orc")
    docs = spark.range(0, 12000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string"), F.lit(" and more words")).alias("text")).coalesce(1)
    token_orc.write_tokens(docs, out, WORD, stripe_bytes=1 << 16)
    files = glob.glob(out + "/*.orc")
    assert sum(orc.ORCFile(f).nstripes for f in files) > len(files) and all(orc.ORCFile(f).row_index_stride == 1000 for f in files)
    tokens = token_orc.read_tokens(spark, out)
    n, seen = scanned(tokens.where("doc_id = 8000"))
    assert n == 1 and seen <= 1000  # the row index skips other strides
    n, seen = scanned(tokens.where("doc_id = 8001"))
    assert n == 0 and seen == 0  # between a stride's ends, but not in its Bloom filter


def test_pipeline_by_brute_force(spark, tmp_path, labels):
    """The stages on nulls, repeats, clashing names and a table without rows."""
    import corpus_pipeline

    sf = str(tmp_path)
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    extra = spark.createDataFrame([(5000, None, None, None, None), (None, "no id here at all today", "en", "s", 3), (5001, "twin text of some six words", "en", "s", 1), (5001, "twin text of some six words", "en", "s", 1), (5002, "twin text of some six words", "en", "s", 1), (5003, "", "en", "s", 0)], base.schema)
    docs = base.unionAll(extra).withColumn("score", F.lit(7)).withColumn("c", F.col("n_chars"))
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    kept = docs
    for (_, stage), module, keep in zip(corpus_pipeline.STAGES[:2], (toxicity, quality), (lambda s: s < 0.5, lambda s: s >= 0.3), strict=True):
        score = module.fit(kept, spark.read.parquet(f"{sf}/labels.parquet")).scorer()
        want = Counter(tuple(r) for r in kept.collect() if keep(score([r.text])[0]))
        after = stage(spark, kept, sf)
        assert rows(after) == want and after.columns == docs.columns
        kept = after
    single = stage(spark, kept, sf)
    first: dict = {}
    listed = sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    find = components_by_brute_force([(i, (r.text or "").lower()) for i, r in enumerate(listed)], 5)
    for i, r in enumerate(listed):
        first.setdefault(find[i], r)
    deduped = corpus_pipeline.STAGES[2][1](spark, single, sf)
    assert rows(deduped) == Counter(tuple(r) for r in first.values())
    packed = corpus_pipeline.run(spark, sf)
    lib = library(WORD)
    want = Counter((r.doc_id, len(lib.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in first.values())
    got: dict = Counter()
    for r in packed.collect():
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == {k: k[1] * n for k, n in want.items()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_near_dup_where_one_set_fits_its_sketch(spark):
    """A set that fits into its sketch, within one that doesn't: the larger's sketch lacks common values."""
    rows = []
    for i in range(60):
        own = [f"p{i}x{j}" for j in range(80)]
        size = 64 + i % 3
        rows += [(2 * i, " ".join(own[:size])), (2 * i + 1, " ".join(own[: size * 5 // 4]))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=1).collect()
    assert {r.doc_id: r.component_id for r in got} == components_by_brute_force(rows, 1) == {d: d - d % 2 for d in range(120)}


@pytest.mark.parametrize("sizes", [{}, {"few": 2, "pivots": 1, "members": 16, "room": 3000}])
def test_near_dup_of_random_groups(spark, sizes):
    """Copies, cut, edited and lengthened, of texts around the sketch's size, with words that many share."""
    r, rows = np.random.default_rng(21), []
    for c in range(30):
        base = [f"c{c}w{j}" for j in range(int(r.choice([3, 5, 9, 12, 30, 48, 51, 52, 55, 63, 64, 65, 66, 75, 80, 120])))]
        for _ in range(int(r.integers(2, 15))):
            p = r.choice([0.0, 0.03, 0.08, 0.12, 0.2])
            w = [f"z{r.integers(0, 40)}" if r.random() < p else x for x in base]
            w = w[: int(len(w) * r.uniform(0.7, 1))] if r.random() < 0.4 else w
            w += [f"tail{r.integers(0, 30)}" for _ in range(int(r.integers(0, max(1, len(base) // 4))))] if r.random() < 0.3 else []
            rows.append((3 * len(rows) + 1, " ".join(w)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 1, **sizes).collect()
    assert {x.doc_id: x.component_id for x in got} == components_by_brute_force(rows, 1)


def wide_template_texts(n, copies):
    """Texts of 260 shared and 140 own words; the first `copies` have a near copy each (20 words of 400 differ)."""
    shared = [f"t{j}" for j in range(260)]
    text = lambda i, k=0: " ".join(shared + [f"w{i}x{j}" + ("y" if k and j < 20 else "") for j in range(140)])
    return [(i, text(i)) for i in range(n)] + [(10_000 + i, text(i, 1)) for i in range(copies)]


def test_near_dup_wide_templates_are_not_dealt(spark, monkeypatch):
    """Of texts that share a template of 65 %, only near copies are dealt to blocks, however many texts there are."""
    dealt, original = [], near_dup._dealt

    def counted(members, size, room):
        out = original(members, size, room)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "_dealt", counted)
    for n in (150, 300):
        rows = spark.createDataFrame(wide_template_texts(n, 25), "doc_id bigint, text string").repartition(4)
        dealt.clear()
        got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(rows, 1, few=2, pivots=1, members=32).collect()}
        assert got == {i: i for i in range(n)} | {10_000 + i: i for i in range(25)}
        assert len(dealt) == 2 and max(dealt) <= 400  # a pair that pivots have not joined makes a few rows, a text that is like no other none


def test_near_dup_larger_sketches_lose_no_link(spark):
    """Sets beyond the larger sketch, and pairs around the threshold, with labels of their own."""
    r, rows = np.random.default_rng(8), []
    for i in range(40):
        base = [f"b{i}x{j}" for j in range(int(r.integers(60, 900)))]
        rows += [(2 * i, base), (2 * i + 1, base[: int(len(base) * r.uniform(0.8, 0.9))] if i % 2 else [*base, *[f"z{i}y{j}" for j in range(int(len(base) * 0.2))]])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    classes = near_dup.staged(near_dup.sketches(docs, 1, 64).groupBy("n", "s1", "s2", "c").agg(F.min("doc_id").alias("first")), "classes")
    for wide in (256, 1024):
        again = near_dup._listed_again(classes.select("c", "n", F.col("c").alias("label")), docs, classes, 1, 80, wide)
        met = {(x, y) for members in again.join(classes, "c").groupBy("p").agg(F.collect_list("first").alias("m")).collect() for x in members.m for y in members.m}
        sets = dict(rows)
        need = [(2 * i, 2 * i + 1) for i in range(40) if 100 * len(set(sets[2 * i]) & set(sets[2 * i + 1])) >= 80 * len(set(sets[2 * i]) | set(sets[2 * i + 1]))]
        assert len(need) > 20 and (wide < 1024 or set(need) <= met)
        assert not {(x, y) for x, y in met if x // 2 != y // 2}


def test_ring_of_many_ranges(spark):
    """Thousands of ranges make no larger plan, and every document meets the next one."""
    ids = np.random.default_rng(3).permutation(6000) * 7
    rows = [(int(i), f"t{i}") for i in ids] + [(700, "a"), (700, "b"), (None, "n1"), (None, "n0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    sizes = []
    for ranges in (8, 5000):
        ring = order_minhash.in_ring(df, ranges)
        sizes.append(len(ring._jdf.queryExecution().optimizedPlan().toString()))
        got = [tuple(r) for r in ring.collect()]
        parts = {}
        for part, ghost, doc_id, text in got:
            parts.setdefault(part, ([], []))[ghost].append((doc_id, text))
        key = lambda r: (r[0] is None, -(r[0] or 0), r[1])
        whole = sorted(rows, key=key)
        assert [r for p in sorted(parts) for r in sorted(parts[p][0], key=key)] == whole and len(parts) >= 0.6 * ranges
        for p in parts:
            following = sorted(parts[(p + 1) if p + 1 in parts else 0][0], key=key)[0]
            assert following in parts[p][1] and {r[0] for r in parts[p][1]} == {following[0]}
    assert abs(sizes[0] - sizes[1]) < 50
    assert order_minhash.fingerprints(df, ranges=5000).count() == len(rows)


def test_factorization_step_by_step():
    """The training against its formulas, term by term and factor by factor, in plain Python."""
    r = np.random.default_rng(9)
    names = np.sort(r.integers(1, 1 << 60, 7).astype(np.uint64))
    sample = [(int(y), 0, np.sort(r.choice(names, int(n), replace=False))) for y, n in zip(r.integers(0, 2, 14), r.integers(1, 7, 14), strict=True)]
    sample[0], sample[1] = (0, *sample[0][1:]), (1, *sample[1][1:])
    model = toxicity.factorize(sample, most=3, factors=2, least=2, epochs=3)
    held = [k for k in names.tolist() if sum(k in own.tolist() for _, _, own in sample) >= 2]
    assert model.keys.tolist() == held
    strong = set(toxicity.informative(sample, 2, 3).tolist())
    first = np.random.Generator(np.random.PCG64(11)).normal(0, 0.01, (len(held), 2))
    w, v, b = dict.fromkeys(held, 0.0), {k: first[i].tolist() for i, k in enumerate(held)}, 0.0
    gw, gv, gb = {k: 1e-6 if k in strong else 10.0 for k in held}, {k: [1e-4 if k in strong else 1.0] * 2 for k in held}, 1e-6
    heft = [len(sample) / (2 * sum(y == c for y, *_ in sample)) for c in (0, 1)]
    for turn in range(6):
        for y, _, own in sample:
            terms = [k for k in own.tolist() if k in w and (turn >= 3 or k in strong)]
            pairs = sum(sum(v[i][f] * v[j][f] for f in range(2)) for a, i in enumerate(terms) for j in terms[:a])
            g = (1 / (1 + math.exp(-(b + sum(w[k] for k in terms) + pairs))) - y) * heft[y]
            gb += g * g
            b -= 0.2 * g / math.sqrt(gb)
            total = [sum(v[k][f] for k in terms) for f in range(2)]
            for k in terms:
                gw[k] += g * g
                step = 0.2 / math.sqrt(gw[k])
                x = w[k] - step * g
                w[k] = math.copysign(max(abs(x) - step * 1e-3, 0), x)
                for f in range(2):
                    dv = g * (total[f] - v[k][f]) + 1e-3 * v[k][f]
                    gv[k][f] += dv * dv
                    v[k][f] -= 0.25 * 0.2 * dv / math.sqrt(gv[k][f] + 1e-2)
    assert np.allclose(model.weights, [w[k] for k in held]) and np.allclose(model.factors, [v[k] for k in held]) and abs(model.bias - b) < 1e-9
    own = np.array([0, 2, len(held) - 1])
    pair = sum(float(model.factors[i] @ model.factors[j]) for a, i in enumerate(own) for j in own[:a])
    assert abs(model.raw(own) - (model.bias + model.weights[own].sum() + pair)) < 1e-12
