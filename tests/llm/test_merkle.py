"""Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest

from credal.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, tree int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, add=0):
    vals = [r[0], r[1], r[2], r[3] if r[3] is None else r[3] + add, r[4]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def tree(level):
    """All levels of a list of digests."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def climb(levels, k, digest):
    sibs = []
    for level in levels[:-1]:
        other = k ^ 1
        if other < len(level):
            sibs.append(level[other])
            digest = h(digest, level[other]) if other > k else h(level[other], digest)
        else:
            digest = h(digest)
        k //= 2
    return sibs, digest


def brute(rows):
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    trees = []
    for _, group in groupby(sorted(rows, key=key), key):
        group = sorted(group, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((group, tree([leaf(r) for r in group])))
    top = tree([t[-1][0] for _, t in trees])
    out = []
    for k, (group, levels) in enumerate(trees):
        for i, r in enumerate(group):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            s1, d = climb(levels, i, leaf(r, 1) if tampered else leaf(r))
            s2, d = climb(top, k, d)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], h(*s1, *s2), d, d == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


def some_rows(n, langs, rng):
    return [(rng.choice([None, k, k, k]), rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, k, 2 ** 63 - 1]),
             rng.choice([None, "", "text", "längerer Text " * 5])) + ("x", 1) for k in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, ["en"]), (17, ["en"]), (33, [None, "en"]), (300, ["en"]),
                                      (200, ["", None, "en", "é", "z", "~"]), (150, [str(k) for k in range(60)])])
@pytest.mark.parametrize("limit", [merkle.BROADCAST_NODES, 1])
def test_manifest(spark, n, langs, limit):
    rows = some_rows(n, langs, random.Random(n))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # rows with equal ids, and so equal keys, are ordered by their leaves
    assert result(merkle.manifest(df, limit)) == brute(rows)


def test_manifest_of_no_rows_and_equal_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(df).count() == 0
    rows = [(1, "a", "en", 3, "abc", "x", 1)] * 5
    assert result(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert spark.conf.get(merkle.LIMIT) == "1000000"


def test_tampered_leaf_without_count_stays(spark):
    hit = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 0)
    rows = [(hit, "a", "en", None, "abc", "x", 1), (hit + 100, "a", "en", 3, "abc", "x", 1)]
    got = {r.doc_id: r.verified for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[hit] is True
