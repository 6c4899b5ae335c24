"""Near-dedup, decontamination, embeddings, WARC, components and the pipeline."""

import gzip
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from credal.llm import components, decontam, embed_dedup, minhash, warc
from credal.llm.common import shared_path, shingle_hashes, word_hashes

random.seed(11)
VOCAB = ["".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(400)]


def words(n):
    return [random.choice(VOCAB) for _ in range(n)]


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 200), (200, 300), (5, 5), (None, 3), (7, 6)] \
        + [(1000, 2000 + i) for i in range(300)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == union_find({x for e in real for x in e}, real)
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_word_hashes_follow_the_word_rule():
    texts = ["A b\x0bc", "a  B\tC ", "", "é x", "a\x1cb", "a b c"]
    raw = [t.encode() for t in texts]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    h, off = word_hashes(data, at)
    assert np.diff(off).tolist() == [3, 3, 0, 2, 1, 3]
    assert h[0:3].tolist() == h[3:6].tolist() == h[off[5]:].tolist()
    small, soff = word_hashes(data, at, chunk=2)
    assert small.tolist() == h.tolist() and soff.tolist() == off.tolist()


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [np.unique(base[:1000]), np.unique(np.concatenate([base[:900], rng.integers(0, 2**63, 100).astype(np.uint64)])),
            base[:1], base[:3], np.empty(0, np.uint64)]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    s = minhash.sketches(np.concatenate(sets), at)
    assert (s[:4] != minhash._EMPTY).all() and (s[4] == minhash._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 900 / 1100) < 0.12
    alone = minhash.sketches(sets[1], np.array([0, len(sets[1])]))
    assert (alone[0] == s[1]).all()


def test_minhash_against_brute_force(spark):
    texts = [None, "", " \t", "one", "ONE ", "one two", "one two three", "One two  three"]
    for _ in range(6):
        base = words(150)
        for _ in range(12):
            t = list(base)
            for _ in range(random.randint(0, 8)):
                t[random.randrange(150)] = random.choice(VOCAB)
            texts.append(" ".join(t))
    texts += ["same text again and again"] * 30 + [" ".join(words(20_000))]
    ids = list(range(10, 10 + len(texts)))
    ids[3], ids[0] = 10**12, None
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)],
                                 "doc_id long, text string, n_shingles int, cid string")

    def shingles(t, k=3):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}

    sets = {i: shingles(t) for i, t in zip(ids, texts) if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = union_find(sets, links)
    rows = minhash.near_duplicates(docs, 3, 85, 100).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(sets[r.doc_id])), r
            assert r.kept == (r.doc_id == r.component_id)
    assert 1 < len({want[i] for i in want}) < len(texts)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minhash_of_ids_with_several_texts(spark):
    texts = [" ".join(words(60)) for _ in range(24)]
    rows = [(i % 12, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == \
        Counter([(i % 12, i % 12) for i in range(24)] + [(100 + i, i % 12) for i in range(24)])


def test_blocks_find_all_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**60, 100).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(100) < rng.choice([0, .05, .2]), rng.integers(0, 2**60, 100).astype(np.uint64), base))
            for _ in range(60)]
    comp = np.array([i if i > 5 else 0 for i in range(60)])
    found = minhash.linked_pairs(sets, comp, 85, 100)
    true = [(int(comp[a]), int(comp[b])) for a in range(60) for b in range(a)
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    nodes = set(comp.tolist())
    assert union_find(nodes, [(int(comp[a]), int(comp[b])) for a, b in found]) == union_find(nodes, true)


# 7 -------------------------------------------------------------------------------
def test_decontamination_against_brute_force(spark):
    items = [" ".join(words(n)) for n in (12, 20, 20, 45)] + ["two words", None, "...", "Solo"]
    clean = lambda: " ".join(words(80))
    noisy = items[3].split()
    noisy[1] = "zzz"
    texts = [clean() + " " + items[0].upper() + ", " + clean(), items[1], " ".join(noisy[:44]), clean(), None, "",
             "here are Two-words indeed", clean() + " " + " ".join(noisy) + " " + clean(), " ".join(items[2].split()[:18]),
             clean() + " solo. " + clean(), " ".join(items[3].split()[:20]) + " " + clean(),
             (items[1] + " ") * 400]
    docs = spark.createDataFrame([(None if i == 1 else i, t, 1, "z") for i, t in enumerate(texts)],
                                 "doc_id long, text string, m int, item string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")

    import re
    tokens = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    def brute(t, item):
        w, q = tokens(t), tokens(item)
        k = min(5, len(q))
        if not q or len(w) < k:
            return 0.0
        bag = lambda x: Counter(tuple(x[i: i + k]) for i in range(len(x) - k + 1))
        b, best = bag(q), 0.0
        for s in range(max(1, len(w) - len(q) + 1)):
            a = bag(w[s: s + len(q)])
            inter = sum((a & b).values())
            best = max(best, inter / (sum(a.values()) + sum(b.values()) - inter))
        return best

    want = {(None if i == 1 else i, j): s for i, t in enumerate(texts) for j, it in enumerate(items)
            if (s := brute(t, it)) >= 0.8}
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert (0, 0) in got and (7, 3) in got and (10, 3) not in got and (6, 4) in got
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == \
        sorted(i for i in range(len(texts)) if i != 1 and not any(k[0] == i for k in want))
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), bench).count() == 0


def test_blocks_hold_every_fingerprint_within_radius(spark):
    rows = []
    for i in range(300):
        f = random.getrandbits(64)
        g = f
        for b in random.sample(range(64), decontam.RADIUS):
            g ^= 1 << b
        rows.append((f - (1 << 63), g - (1 << 63)))
    df = spark.createDataFrame(rows, "f long, g long")
    shared = F.size(F.array_intersect(decontam.blocks_of("f", decontam.RADIUS), decontam.blocks_of("g", decontam.RADIUS)))
    assert df.where(shared == 0).count() == 0


# 8 -------------------------------------------------------------------------------
def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 32))
    near = []
    for c in (0.951, 0.96, 0.98):
        for b in base[:40]:
            y = rng.normal(size=32)
            u = b / np.linalg.norm(b)
            y -= (y @ u) * u
            near.append(c * u + np.sqrt(1 - c * c) * y / np.linalg.norm(y))
    vectors = [*base, *near, *([base[0]] * 20), base[1] * 7.5]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31]
    rows += [(1000 + i, b) for i, b in enumerate(bad)] + [(None, base[2].tolist()), (2000, [1.0, 2.0]), (2001, [2.0, 4.0])]
    out = {r.vec_id: r for r in embed_dedup.embedding_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(out) == len(rows)
    v = np.array(vectors)
    v /= np.linalg.norm(v, axis=1)[:, None]
    links = (v @ v.T >= 0.95) & ~np.eye(len(v), dtype=bool)
    found = sum(out[i].n_links for i in range(len(v)))
    assert 0.9 * links.sum() <= found <= links.sum()
    comp = union_find(range(len(v)), list(zip(*np.nonzero(links))))
    assert np.mean([out[i].component_id == comp[i] for i in range(len(v))]) >= 0.95
    assert all(out[1000 + i].n_links == 0 and out[1000 + i].kept for i in range(len(bad)))
    assert out[2001].component_id == 2000 and out[2000].n_links == 1 and out[None].component_id is None
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert embed_dedup.embedding_duplicates(empty).count() == 0


def test_embeddings_of_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[:1000] = np.sqrt(0.965) * v[0] + np.sqrt(0.035) * v[1000:2000]
    v /= np.linalg.norm(v, axis=1)[:, None]
    order = rng.permutation(len(v))
    v = v[order]
    links = (v @ v.T >= 0.95) & ~np.eye(len(v), dtype=bool)
    assert links.sum() > 500_000
    out = {r.vec_id: r for r in embed_dedup.embedding_duplicates(spark.createDataFrame(
        [(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")).collect()}
    assert sum(r.n_links for r in out.values()) >= 0.99 * links.sum()
    assert all(out[i].n_links <= n for i, n in enumerate(links.sum(axis=1)))
    assert sum(not out[i].kept for i in np.flatnonzero(order < 1000).tolist()) == 999


# 4 -------------------------------------------------------------------------------
@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_round_trip(spark, compression):
    big = "<p>" + "é" * 700 + "WARC/1.1\r\n\r\n</p>"
    pages = [(1, "http://a/\r\nX: y", big), (5, "http://b", big), (3, None, big), (None, "u", big), (7, "u", None),
             (8, "u", ""), (9, "u", "small"), (10, "u", "small"), (5, "again", big)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, record_type string")
    path = shared_path(spark, "w")
    got = sorted(warc.archive_pages(df, path, compression).collect(), key=str)
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        revisit = h == big and i != 5
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
    assert Counter(tuple(r) for r in got) == Counter(want)
    read = spark.read.format("warc").load(path)
    only = read.where((F.col("record_type") == "revisit") & F.col("refers_to").isNotNull())
    assert only.count() == 3 and "record_type" in only._jdf.queryExecution().toString()
    heads = spark.read.format("warc").option("payload", "false").load(path)
    assert heads.where("payload is not null").count() == 0 and heads.count() == len(pages)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none, None, compression).count() == 0


def test_warc_skips_blocks_of_other_records():
    rows = [{"record_type": "response", "record_id": f"urn:page:{i}", "payload": b"x" * 200_000,
             "payload_digest": hashlib.sha1(b"x").hexdigest()} for i in range(5)]
    data = b"".join(warc.record_bytes(r) for r in rows)

    class Raw(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Raw.taken += len(out)
            return out

    keep = warc.Predicate()
    from pyspark.sql.datasource import EqualTo
    assert keep.take(EqualTo(("record_id",), "urn:page:3")) and not keep.take(EqualTo(("payload_bytes",), 3))
    got = list(warc.records(warc._Reading(Raw(data), len(data)), keep))
    assert [r["record_id"] for r in got] == ["urn:page:3"] and len(got[0]["payload"]) == 200_000
    assert Raw.taken < 0.75 * len(data)
    with pytest.raises(ValueError):
        list(warc.records(warc._Reading(io.BytesIO(data[:-100_000]), len(data) - 100_000)))
    assert len(list(warc.records(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data))), None, True, False))) == 5


# pipeline ------------------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline as P
    passage = " ".join(words(30))
    near = words(120)
    close = list(near)
    close[60] = "changed"
    rows = [(i, " ".join(words(60)), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, "12345 ...", "en", "s0"), (101, None, None, None), (102, " ".join(near), "en", "s1"),
             (103, " ".join(close), "en", "s2"), (104, " ".join(words(30)) + " " + passage, "en", "s0"), (102, " ".join(near), "en", "s1")]
    folder = shared_path(spark, "in")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text")) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, passage)], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = [{100, 101}, {103}, {104}]
    left = {r[0] for r in rows}
    for (name, stage), out in zip(P.STAGES[:3], gone):
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns, name
        ids = [r.doc_id for r in got.collect()]
        left -= out
        assert set(ids) == left, name
        docs = got
    assert sorted(ids) == sorted(left)
    final = P.run(spark, folder).collect()
    assert {r.doc_id for r in final} <= left and len(final) >= 40
    assert sorted(r.start for r in final)[0] == 0 and sum(r.n_tokens for r in final) == max(r.start + r.n_tokens for r in final)
    assert shingle_hashes(np.empty(0, np.uint64), np.array([0, 0]), 5)[0].size == 0


def test_deduplicated_judges_rows_of_one_id_by_their_texts(spark):
    b = words(80)
    rows = [(3, " ".join(b), "x"), (5, " ".join(words(80)), "y"), (5, " ".join([*b, "more"]), "z"), (5, " ".join([*b, "more"]), "w"),
            (None, " ".join(b), "n"), (7, None, "m"), (8, "", "e"), (9, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, grp string")
    got = minhash.deduplicated(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.grp) for r in got.collect()) == [(0, "n"), (3, "x"), (5, "y"), (7, "m"), (8, "e"), (9, "e")]
    assert minhash.deduplicated(df.where("false")).count() == 0


def test_pipeline_stages_of_odd_rows(spark):
    """Nulls, repeats, ties, clashing extra columns, a very long text and no rows."""
    import corpus_pipeline as P
    folder = shared_path(spark, "odd")
    passage = " ".join(words(30))
    spark.createDataFrame([(0, passage)], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    long = " ".join(words(200_000))
    rows = [(i, " ".join(words(60)), "en", "s", "k") for i in range(30)] + [
        (None, " ".join(words(60)), "en", None, "k"), (1, None, None, None, None), (2, "", "en", "s", "k"), (3, long, "en", "s", "k"),
        (4, "a b", "en", "s", "k"), (4, "a b", "en", "s", "k")]
    schema = "doc_id long, text string, lang string, source string, score string"
    docs = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text")).withColumn("grp", F.lit(1)).withColumn("length", F.lit("x"))
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns, name
        left = [(r.doc_id, r.text) for r in got.collect()]
        assert (3, long) in left and any(i is None for i, _ in left), name
        n = [len([x for x in left if x == row]) for row in ((1, None), (2, ""), (4, "a b"))]
        assert n == {"language_id": [0, 0, 2], "near_dedup": [1, 1, 1], "decontamination": [1, 1, 2]}.get(name, n), name
        assert stage(spark, docs.where("false"), folder).count() == 0, name
    final = P.STAGES[-1][1](spark, docs, folder)
    assert final.count() == len(rows) and P.STAGES[-1][1](spark, docs.where("false"), folder).count() == 0
