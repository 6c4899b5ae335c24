"""Token shards, language ID, substring dedup, mixing, token counts, toxicity."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from credal.llm import langid, mixing, substring, tokens_out, toxicity, viterbi
from credal.llm.common import shared_path
from credal.llm.queries import tokenizer_path

WORD_BPE = tokenizer_path("word_bpe_49k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " \n\t", "Hello, world. don't we'll.,x", "naïve É À l'été ﬁne İstanbul ΑΣ. ß", "日本語。 text 1234 ①②.",
       "x" * 5000, "word. " * 3000, "<|endoftext|> áb é.", "…—word—. .,.", "Hello, world. don't we'll.,x"]
SCHEMA = "doc_id long, text string, source string, start string, th string, size string, copies int"


def frame(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(i if ids is None else ids[i], t, None if sources is None else sources[i], "s", "t", "z", i)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# 1 -------------------------------------------------------------------------------
def test_token_shards_round_trip(spark):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(WORD_BPE)
    ids = [None, 5, 5, 3, 9, 1, 2, 8, 7, 4, 3]
    path = shared_path(spark, "t")
    manifest = tokens_out.write_token_shards(frame(spark, ODD, ids), path, WORD_BPE, 1, shard_rows=4)
    assert manifest.count() > 1
    got = [tuple(r) for r in tokens_out.read_token_shards(spark, path, manifest, with_ids=True)
           .orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32", "ids").collect()]
    want = Counter((i, tuple(tk.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in zip(ids, ODD))
    assert Counter((r[0], tuple(r[4])) for r in got) == want
    at = 0
    for doc_id, start, n, crc, tokens in got:
        assert start == at and n == len(tokens) and crc == zlib.crc32(np.array(tokens, "<u4").tobytes())
        at += n
    keys = [-1 if r[0] is None else r[0] for r in got]
    assert keys == sorted(keys)
    some = tokens_out.read_token_shards(spark, path, manifest, wanted=[5, 8]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 8]


def test_token_shards_of_nothing(spark):
    assert tokens_out.token_output(frame(spark, []), WORD_BPE, 1).count() == 0


def test_encoder_equals_whole_text_encoding():
    from tokenizers import Tokenizer
    tk, enc = Tokenizer.from_file(WORD_BPE), tokens_out.WordEncoder(WORD_BPE, None)
    random.seed(1)
    texts = ODD + ["".join(random.choice("ab.,'éßÀ1—́ \n") for _ in range(40)) for _ in range(500)]
    flat, at = enc.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert flat[at[i]: at[i + 1]].tolist() == tk.encode(t or "", add_special_tokens=False).ids


def test_shard_reads_frames_on_request_and_checks_them(tmp_path):
    path = tmp_path / "s.zst"
    with open(path, "wb") as f:
        w = tokens_out.ShardWriter(f, np.dtype("<u2"))
        for i in range(50):
            w.add(i, np.full(5000, i, np.uint16))
        w.close()
    size = path.stat().st_size
    with open(path, "rb") as f:
        s = tokens_out.Shard.open(f, size)
        assert len(s.frames) > 2
        read = []
        s.frame, frame_of = lambda k: read.append(k) or frame_of(k), s.frame
        assert [(d, len(x), int(x[0])) for _, d, x in s.documents([7])] == [(7, 5000, 7)] and len(read) == 1
    import zstandard
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(path.read_bytes())
    assert len(plain) == 50 * 5000 * 2
    raw = bytearray(path.read_bytes())
    with open(path, "rb") as f:
        k, packed, _ = 0, *tokens_out.Shard.open(f, size).frames[0][:2]
    raw[packed // 2] ^= 0xFF
    path.write_bytes(raw)
    with open(path, "rb") as f, pytest.raises(Exception):
        tokens_out.Shard.open(f, size).frame(0)


# 2 -------------------------------------------------------------------------------
def brute_vector(text, dim=langid.DIM, seed=langid.SEED):
    one = lambda c: np.random.default_rng([seed, ord(c)]).integers(0, 2, dim, dtype=np.int8) * 2 - 1
    out = np.zeros(dim)
    clean = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    for w in clean.split():
        w = f" {w} "
        for i in range(len(w) - 2):
            a, b, c = (one(x).astype(int) for x in w[i: i + 3])
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


def test_language_against_brute_force(spark):
    train = [("the cat sat on the mat and the dog", "en"), ("le chat est sur la table et le chien", "fr"),
             ("der hund und die katze sind im haus", "de"), (None, "en"), ("nothing", None)] * 2
    rows = spark.createDataFrame(train, "text string, lang string")
    protos = langid.fit_prototypes(rows)
    assert sorted(protos) == ["de", "en", "fr"]
    for lang, p in protos.items():
        want = sum(brute_vector(t) for t, x in train if x == lang and t)
        assert np.allclose(p, want)
    texts = ["The dog sat.", "la table, le chat!", "Das haus und der hund", None, "", "123 ... 4", "Ω", "mat " * 5000]
    docs = frame(spark, texts).select("doc_id", "text", "start")
    got = {r.doc_id: r for r in langid.predict_language(docs, protos).collect()}
    for i, t in enumerate(texts):
        v = brute_vector(t or "")
        if not np.any(v):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cos = {x: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for x, p in protos.items()}
        best = max(sorted(cos), key=cos.get)
        assert got[i].lang_pred == best and got[i].score == pytest.approx(max(0, cos[best]), abs=2e-5)
    assert langid.fit_prototypes(rows.limit(0)) == {}
    assert {r.lang_pred for r in langid.predict_language(docs, {}).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    from credal.llm.queries import QUERIES, table
    out = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    docs = table("/root/testdata/sf0.01", spark, "documents").select("doc_id", "lang")
    right = out.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.99


# 3 -------------------------------------------------------------------------------
def test_substring_dedup_against_brute_force(spark):
    long = "One two three four five six seven. Eight nine ten eleven twelve thirteen fourteen."
    texts = [long, "Pasted in a line " + long + " and more", "ONE  two three four five six\tseven.\nshort line\nshort line",
             None, "", "short line", long + "\n" + long, "x " * 4000, " \n ", long]
    ids = [4, 3, 9, 1, 2, 5, 6, 7, 8, None]
    got = {r.doc_id: r for r in substring.substring_dedup(frame(spark, texts, ids)).collect()}
    assert len(got) == len(texts)
    seen, want = set(), {i: [] for i in ids}
    for i, t in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0)):
        for begin, end, n, digest in substring.units_of(t or "", "sentence"):
            if n >= substring.MIN_WORDS:
                if digest in seen:
                    want[i].append((begin, end))
                seen.add(digest)
    for i, t in zip(ids, texts):
        assert [tuple(s) for s in got[i].removed] == want[i], i
        assert got[i].text == (t if not want[i] else substring.cut_spans(t, want[i]))
        assert got[i].removed_chars == sum(b - a for a, b in want[i]) and got[i].n_removed == len(want[i])
    assert want[None] == [] and len(want[6]) >= 3 and len(want[3]) == 1
    assert substring.substring_dedup(frame(spark, [])).count() == 0


def test_substring_dedup_of_short_sentences(spark):
    line = "Stop!! Go on. Who is there? Nobody.\nTwo words. The end."
    dense = "ALPHA!! BETA!! GAMMA!! DELTA!! EPSILON!! ZETA!! ETA!!"
    texts = [line, "A new start. " + line.replace("\n", " ") + " Or not.", dense, dense, "Go on. Who is there? Yes.",
             "Ha. " * 20, "Stop!! Go on."]
    got = {r.doc_id: r for r in substring.substring_dedup(frame(spark, texts)).collect()}
    assert [got[i].n_removed for i in range(len(texts))] == [0, 6, 0, 7, 0, 14, 0]
    assert got[1].text.split() == "A new start. Or not.".split() and got[3].text == ""
    assert got[5].text.split() == ["Ha."] * 6
    for i, t in enumerate(texts):
        assert got[i].removed_chars == sum(s.end - s.begin for s in got[i].removed)
        words = [t[s.begin:s.end] for s in got[i].removed]
        assert all(w.strip() == w and w for w in words)


# 5 -------------------------------------------------------------------------------
def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = {s: w[s] for s in names if s not in capped}
        left = total - sum(capped.values())
        target = {s: left * w[s] / sum(rest.values()) for s in rest} if rest else {}
        over = [s for s in target if target[s] > epochs * sizes[s]]
        if not over:
            return target | capped
        capped |= {s: epochs * sizes[s] for s in over}


def test_mixing_targets_and_counts(spark):
    random.seed(2)
    sources = [random.choice(["hot"] * 6 + ["a", "b", "ü", None, "empty"]) for _ in range(1500)]
    texts = [None if s == "empty" else "w " * random.randint(0, 60) for s in sources]
    docs = frame(spark, texts, [None if i % 50 == 0 else i // 2 for i in range(1500)], sources)
    rows = [r.asDict() for r in mixing.mix_plan(docs).collect()]
    assert len(rows) == 1500
    sizes = Counter()
    for s, t in zip(sources, texts):
        sizes[s] += len((t or "").split())
    target = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 61 for s in sizes) and sum(taken.values()) <= sum(sizes.values())
    again = [r.asDict() for r in mixing.mix_plan(docs.repartition(5)).collect()]
    key = lambda r: tuple(str(v) for v in r.values())
    assert sorted(rows, key=key) == sorted(again, key=key)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix_plan(docs.limit(0)).count() == 0


# 6 -------------------------------------------------------------------------------
def test_viterbi_counts_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer, models, normalizers
    pieces, byte_fallback = viterbi.read_pieces(PIECES)
    assert byte_fallback and not {"<s>", "</s>", "<unk>", "<0x41>"} & {p for p, _ in pieces}
    low = min(s for _, s in pieces)
    known = [("<unk>", 0.0), *pieces, *[(f"<0x{b:02X}>", low - 100) for b in range(256)]]
    tk = Tokenizer(models.Unigram([(p, float(s)) for p, s in known], 0, True))
    tk.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts = [t for t in ODD if "<" not in (t or "")] + ["  a  b ", "\n", "▁a b", "😀😀 x", "a\n\nb \n c"]
    got = {r.doc_id: r.n_tokens for r in viterbi.token_counts(frame(spark, texts), PIECES).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (len(tk.encode(t, add_special_tokens=False).ids) if t else 0), t


def best_path(text, scores, unknown):
    """Fewest-surprise pieces of a text: (score, tokens), the longest last piece on ties."""
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            if best[start] and piece in scores:
                got = (best[start][0] + scores[piece], best[start][1] + 1)
                if best[end] is None or got[0] > best[end][0]:
                    best[end] = got
        if text[end - 1] not in scores and (best[end] is None or best[end - 1][0] + unknown > best[end][0]):
            best[end] = (best[end - 1][0] + unknown, best[end - 1][1] + len(text[end - 1].encode()))
    return best[-1][1]


def test_viterbi_takes_control_and_byte_strings_as_text(spark):
    pieces, _ = viterbi.read_pieces(PIECES)
    scores = dict(pieces)
    unknown = min(scores.values()) - viterbi.UNKNOWN_PENALTY
    texts = ["ab<s>", "x<0x41>y", "</s> <unk> <0x0A>", "<s><s>", "a <s> b <0xFF>日<0x00>"]
    got = [r.n_tokens for r in viterbi.token_counts(frame(spark, texts), PIECES).orderBy("doc_id").collect()]
    assert got == [best_path("▁" + t.replace(" ", "▁"), scores, unknown) for t in texts]
    assert got[0] == 4 and got[1] >= 7


def test_viterbi_of_one_very_long_word_stays_small():
    import tracemalloc
    counter = viterbi.UnigramCounter(*viterbi.read_pieces(PIECES))
    word = "abcdefghij" * 30_000
    tracemalloc.start()
    n = counter.count(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == counter.path("▁" + word) and peak < 20 << 20


def test_viterbi_ties_and_unknowns():
    from tokenizers import Tokenizer, models
    random.seed(3)
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("bb", -1.5), ("c▁c", -2.0)]
    tk = Tokenizer(models.Unigram(pieces, 0, False))
    counter = viterbi.UnigramCounter(pieces)
    assert not counter.by_word and not counter.bytes
    for _ in range(400):
        text = "".join(random.choice("abcx▁") for _ in range(random.randint(1, 14)))
        assert counter.path(text) == len(tk.encode(text, add_special_tokens=False).ids), text


# 10 ------------------------------------------------------------------------------
def test_network_gradients():
    net = {k: v.astype(np.float64) for k, v in toxicity.new_network(3).items()}
    flat, at, words = toxicity.word_ids(pa.array(["you are a clown and a fool", "nice day"]))
    feats = toxicity.word_features(words)
    row, start = toxicity.windows(at)
    index = toxicity.window_words(flat, at, row, start, len(words))
    live, y, w = index < len(words), np.array([1.0, 0.0]), np.ones(2)

    def loss():
        logit = toxicity.forward(net, toxicity.projections(net, toxicity.inputs(net, *feats)), index, live)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, logit, -logit)))))

    grad = toxicity.gradients(net, feats, index, live, y, w)
    rng = np.random.default_rng(0)
    for k in ("fU", "bU", "fW", "bc", "look", "out", "bias"):
        for _ in range(3):
            i = tuple(rng.integers(0, n) for n in net[k].shape)
            old, eps = net[k][i], 1e-2
            net[k][i] = old + eps
            up = loss()
            net[k][i] = old - eps
            down = loss()
            net[k][i] = old
            assert grad[k][i] == pytest.approx((up - down) / (2 * eps), abs=3e-4, rel=0.05), (k, i)


def test_toxicity_learns_and_scores_whole_texts(spark):
    random.seed(5)
    vocab = "sun moon river table walk green stone bread".split()
    calm = [" ".join(random.choice(vocab) for _ in range(30)) for _ in range(360)]
    texts = [c if i % 2 else c[:80] + f" idiot{'s' * (i % 3)} " + c[80:] for i, c in enumerate(calm)]
    labels = [1 - i % 2 for i in range(360)]
    net = toxicity.fit(texts[:300], labels[:300])
    far = " ".join(calm) + " "
    docs = frame(spark, [far, far + "idiots " + far, None, "", " \n", *texts[300:]]).select("doc_id", "text", "start")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, net).collect()}
    assert got[1].predicted == 1 and got[1].score > got[0].score
    assert [got[i].score for i in (2, 3, 4)] == [0.0] * 3 and len(got) == 65
    assert np.mean([got[5 + i].predicted == labels[300 + i] for i in range(60)]) >= 0.95
    assert toxicity.fit([], [])["bias"][0] == 0 and toxicity.fit(["a"], [1])["bias"][0] > 0


def test_toxicity_sample_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (1, "you idiot"), (2, "fine day"), (3, None), (None, "idiot"), (4, "unlabelled"),
                                  (5, "x" * 9000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (2, None), (5, 1), (2, 7)], "doc_id long, toxic int")
    got, want = toxicity.fit_toxicity(docs, labels), toxicity.fit(["you idiot", "fine day"], [1, 0])
    same = toxicity.fit(["fine day", "you idiot"], [0, 1])
    assert any(all(np.array_equal(got[k], x[k]) for k in got) for x in (want, same))
    assert toxicity.fit_toxicity(docs.limit(0), labels)["bias"][0] == 0


def test_windows_cover_everything():
    for n in (1, 7, 8, 9, 56, 57, 200):
        row, start = toxicity.windows(np.array([0, 0, n]))
        covered = {p for s in start for p in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and set(row.tolist()) == {1}


def plain_score(net, words):
    """The highest score over all windows, one word and one unit at a time."""
    def sig(x):
        return 1 / (1 + math.exp(-x))

    h, best = toxicity.HIDDEN, -math.inf
    for start in range(max(1, len(words) - toxicity.WINDOW + 1)):
        part = words[start: start + toxicity.WINDOW]
        rows, grams, firsts = toxicity.word_features(part)
        ends = [*firsts[1:], len(grams)]
        xs = [list(net["words"][rows[i]]) + [sum(net["chars"][g][k] for g in grams[firsts[i]:ends[i]]) / (ends[i] - firsts[i])
                                             for k in range(toxicity.CHAR_DIM)] for i in range(len(part))]
        states = [[] for _ in part]
        for side in "fb":
            w, u, c, state = net[side + "W"], net[side + "U"], net[side + "c"], [0.0] * h
            for t in range(len(part)) if side == "f" else reversed(range(len(part))):
                p = [sum(xs[t][i] * w[i][k] for i in range(len(xs[t]))) + c[k] for k in range(3 * h)]
                z = [sig(p[k] + sum(state[i] * u[i][k] for i in range(h))) for k in range(h)]
                r = [sig(p[h + k] + sum(state[i] * u[i][h + k] for i in range(h))) for k in range(h)]
                new = [math.tanh(p[2 * h + k] + sum(r[i] * state[i] * u[i][2 * h + k] for i in range(h))) for k in range(h)]
                state = [s + z[k] * (new[k] - s) for k, s in enumerate(state)]
                states[t] += state
        look = [math.exp(sum(a * b for a, b in zip(net["look"], s))) for s in states]
        pooled = [sum(a * s[k] for a, s in zip(look, states)) / sum(look) for k in range(2 * h)]
        best = max(best, sig(sum(a * b for a, b in zip(net["out"], pooled)) + net["bias"][0]))
    return best


def test_every_window_is_scored():
    rng = random.Random(9)
    net = {k: v * 3 for k, v in toxicity.new_network(4).items()}
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(50)]
    texts = [" ".join(rng.choices(vocab, k=n)) for n in (0, 1, 3, 7, 8, 9, 20, 33)] + [None, "..."]
    got = toxicity.score_texts(net, *toxicity.word_ids(pa.array(texts, pa.string())))
    for t, g in zip(texts, got):
        words = [w.strip(" \t.,;:!?\"'()[]{}<>|*_-") for w in (t or "").split()]
        assert g == pytest.approx(plain_score(net, words) if any(words) else 0.0, abs=2e-5), t
    # stretches of windows give what one stretch gives
    texts = pa.array([" ".join(rng.choices(vocab, k=300)) for _ in range(5)])
    flat, at, words = toxicity.word_ids(texts)
    old, toxicity.CHUNK = toxicity.CHUNK, 13
    try:
        small = toxicity.score_texts(net, flat, at, words)
    finally:
        toxicity.CHUNK = old
    assert small == pytest.approx(toxicity.score_texts(net, flat, at, words), abs=1e-5)


def test_toxic_passage_is_found_at_every_offset():
    rng = random.Random(6)
    vocab = "sun moon river table walk green stone bread".split()
    calm = [rng.choices(vocab, k=40) for _ in range(300)]
    insult = ["utter", "idiot", "fool"]
    texts = [" ".join(c if i % 2 else c[:15] + insult + c[15:]) for i, c in enumerate(calm)]
    net = toxicity.fit(texts, [1 - i % 2 for i in range(300)])
    long = rng.choices(vocab, k=120)
    planted = pa.array([" ".join(long[:k] + insult + long[k:]) for k in range(121)] + [" ".join(long)])
    got = toxicity.score_texts(net, *toxicity.word_ids(planted))
    assert (got[:-1] >= 0.5).all() and got[-1] < 0.5


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "you there", 9.0, "x", 3)], "doc_id long, text string, score double, lang_pred string, predicted int")
    got = toxicity.score_toxicity(docs, toxicity.new_network()).first()
    assert got.doc_id == 1 and got.lang_pred == "x" and 0 <= got.score <= 1 and got.predicted in (0, 1)
    got = langid.predict_language(docs, langid.fit_prototypes(docs.selectExpr("text", "'en' as lang"))).first()
    assert (got.lang_pred, got.predicted) == ("en", 3) and got.score > 0.9


def test_score_floor_parts_unlearned_scripts_from_learned_texts(spark):
    rng = random.Random(8)
    syllables = {"en": ["the", "ing", "and", "re", "on"], "de": ["der", "sch", "und", "ei", "te"]}
    def text(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(n))
    train = spark.createDataFrame([(text(x, 60), x) for x in syllables for _ in range(60)], "text string, lang string")
    prototypes = langid.fit_prototypes(train)
    floor = langid.score_floor(train, prototypes)
    odd = ["".join(rng.choices(a + "  ", k=400)) for a in ("абвгдежзиклмноп", "αβγδεζηθικλμνξ", "bcdfghjklmnpqrstvwxz") for _ in range(10)]
    clean = [text(x, n) for x in syllables for n in (1, 2, 40, 300)]
    docs = frame(spark, odd + clean).select("doc_id", F.length("text").alias("n"), "text")
    kept = {r.doc_id for r in langid.predict_language(docs, prototypes).where(langid.in_learned_language(F.col("n"), floor)).collect()}
    assert kept == set(range(len(odd), len(odd) + len(clean)))
    assert langid.score_floor(train.limit(0), prototypes) == 3 / langid.DIM ** 0.5


def test_added_tokens_in_any_letter_case():
    """Texts that hold an added token's string are encoded as the library does."""
    from tokenizers import Tokenizer
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", " ", "  ", "word", "Word", "a.", "\n",
             "<|", "|>", "é", "x<|endoftext|>y"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(600)]
    tk, enc = Tokenizer.from_file(WORD_BPE), tokens_out.WordEncoder(WORD_BPE, 1)
    ids, at = enc.encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k]: at[k + 1]].tolist() == [*tk.encode(t, add_special_tokens=False).ids, 1], t
