"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from credal.llm import align as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = ["Hello world", "", None, " ", "  two  spaces ", "a\n\n  b\tc \n d", "é à naïve façade", "日本語 テキスト 中文",
         "\U0001f600 smile \U0001f468‍\U0001f469‍\U0001f467", "<s> plain </s> <unk> <|endoftext|> <0x41>",
         "holds ▁ mark", "▁", "\x00 null", "x" * 5000, "word " * 3000, "a  b  c　 d\u0085 e", "don't they'll I've",
         "123 4567 3.14", " private �", "ﬁ Å é ́ x", "\r\n\r\n line \x0b\x0c", "Hello world"]


def brute(texts):
    """Whole texts, one byte at a time; links by comparing every pair of ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    names = {v: k for k, v in a.get_vocab().items()}
    visible = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table = {chr(v): v for v in visible}
    extra = 256
    for v in range(256):
        if v not in visible:
            table[chr(extra)] = v
            extra += 1
    rows, count = [], Counter()
    for t in texts:
        want = (" " + (t or "")).encode()
        ta = [(i, bytes(table[c] for c in names[i])) for i in a.encode(want.decode(), add_special_tokens=False).ids]
        tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in b.encode(t or "")]
        if not t or b"".join(x for _, x in ta) != want or b"".join(x for _, x in tb) != want:
            rows.append(None)
            continue

        def spans(tokens):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            return out

        sa, sb = spans(ta), spans(tb)
        first = 0
        links = []
        for i, s, e in sa:                               # ranges that ended before stay behind
            while sb[first][2] <= s:
                first += 1
            k = first
            while k < len(sb) and sb[k][1] < e:
                links.append((i, sb[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        def grouped(s):
            out = {c: [] for c in cuts}
            k = 0
            for i, _, e in s:
                while cuts[k] < e:
                    k += 1
                out[cuts[k]].append(str(i))
            return out
        ga, gb = grouped(sa), grouped(sb)
        text = ";".join(",".join(ga[c]) + "|" + ",".join(gb[c]) for c in cuts)
        rows.append((len(sa), len(sb), len(cuts), links, hashlib.sha256(text.encode()).hexdigest()))
        count.update(links)
    best = {}
    for (i, j), n in count.items():
        best[j] = max(n, best.get(j, 0))
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (r[0], r[1], r[2], len(r[3]), sum(count[x] == best[x[1]] for x in r[3]), sum(count[x] for x in r[3]), r[4])
            for r in rows]


def result(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("chunk", [64, A.CHUNK_BYTES])
def test_align_equals_whole_text_encoding(spark, chunk):
    rng = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", " ", "é", "日", " ", "'s", ".", "7", "\U0001f600", "　", "Z", "́", "\t", ".", "\n\n", "|", "$$", "é."]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(300)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, chunk string").repartition(3)
    got, want = result(A.align(df, *PATHS, chunk)), brute(texts)
    assert got == want
    assert sum(w[0] > 0 for w in want) > 250 and any(w[0] == 0 for w in want[3:])


def test_align_of_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    texts = [r.text for r in rows.collect()]
    assert result(A.align(rows, *PATHS)) == brute(texts)


def test_align_null_and_repeated_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    got = A.align(df, *PATHS).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_a, r.count_sum) for r in got) == \
        [(False, 1, 2, 6), (False, 1, 2, 6), (False, 2, 0, 0), (True, 0, 2, 6)]
    assert A.align(df.where("false"), *PATHS).count() == 0


def test_chunk_rows_hold_pairs_only(spark):
    """What Spark moves of a chunk does not grow with its documents; the rest is in one file a task."""
    from pyspark.sql import functions as F
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(2)
    chunks = A._chunks(docs, *PATHS, 40_000).persist()
    arrays = [c for c, kind in chunks.dtypes if kind.startswith(("array", "binary"))]
    assert chunks.count() > 2 and chunks.select("file").distinct().count() == 2
    assert chunks.select(F.max(F.greatest(*[F.coalesce(F.octet_length(c) if k == "binary" else F.size(c), F.lit(0))
                                            for c, k in chunks.dtypes if c in arrays]))).first()[0] <= 10
    chunks.unpersist()
    got = A.align(docs, *PATHS, 40_000)
    assert sorted(r.doc_id for r in got.collect()) == list(range(5000))
    assert set(result(got)) == set(brute(["one two three"] * 5000))


def test_refined_spans_of_shared_characters():
    # three byte-fallback pieces carry an empty or the whole span of one character
    import numpy as np
    assert A.refined(np.array([2, 2, 2, 5]), np.array([2, 1, 1, 1])).tolist() == [2, 3, 4, 5]
    assert A.refined(np.array([3, 4, 4, 6]), np.array([3, 1, 1, 1])).tolist() == [3, 4, 5, 6]


def test_pool_is_emptied_and_filled_anew(monkeypatch):
    import pyarrow as pa
    tool = A.Aligner(*PATHS)
    texts = pa.array(TEXTS)
    want = tool.chunk(texts)
    monkeypatch.setattr(A, "POOL_UNITS", 5)
    again = tool.chunk(texts)
    assert again["digests"] == want["digests"] and again["sums"].tolist() == want["sums"].tolist()
