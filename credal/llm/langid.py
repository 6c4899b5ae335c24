"""Language identification by hyperdimensional profiles.

Every letter has a random ±1 vector (drawn from its code point and a seed, so
any alphabet works). A trigram is bound from its letters' vectors, the first
permuted twice, the second once, by elementwise product. A document's vector
is the sum of its trigrams' (words are lower-cased, anything but letters
parts them, and a word is taken with one blank on either side); a language's
prototype is the sum over its training documents. The prediction is the
prototype of largest cosine.

Bundling is linear: training counts trigrams per language in Spark and turns
each distinct trigram into a vector once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credal.llm.common import row_slices, small_batches

DIM = 1024
SEED = 7
BLANK = 32
UNDEFINED = "und"
JUDGED_CHARS = 100
BATCH_CHARS = 1 << 19


class Letters:
    """Code point → letter number (0: not a letter, 1: blank), grown as met."""

    def __init__(self):
        self.table = np.full(0x110000, -1, np.int32)
        self.points: list[int] = [0, BLANK]

    def number(self, points: np.ndarray) -> np.ndarray:
        got = self.table[points]
        if (got < 0).any():
            for p in np.unique(points[got < 0]).tolist():
                low = chr(p).lower()
                if not chr(p).isalpha() or not low[0].isalpha():
                    self.table[p] = 0
                    continue
                q = ord(low[0])
                if self.table[q] < 0:
                    self.table[q] = len(self.points)
                    self.points.append(q)
                self.table[p] = self.table[q]
            got = self.table[points]
        return got


def letter_vectors(points: list[int], dim: int = DIM, seed: int = SEED) -> np.ndarray:
    """A ±1 row per code point, the same in every process."""
    out = np.empty((len(points), dim), np.int8)
    for i, p in enumerate(points):
        out[i] = np.random.default_rng([seed, p]).integers(0, 2, dim, dtype=np.int8) * 2 - 1
    return out


def bind(trigrams: np.ndarray, dim: int = DIM, seed: int = SEED) -> np.ndarray:
    """``trigrams`` (n, 3) code points → (n, dim) ±1 rows: ρ²(a) · ρ(b) · c."""
    points, where = np.unique(trigrams, return_inverse=True)
    where = where.reshape(trigrams.shape)
    v = letter_vectors(points.tolist(), dim, seed)
    return (np.roll(v, 2, axis=1)[where[:, 0]] * np.roll(v, 1, axis=1)[where[:, 1]] * v[where[:, 2]]).astype(np.float32)


def trigram_counts(texts: list[str | None], letters: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, trigram number, ...)`` of all trigrams of a batch: row numbers,
    indices into the distinct trigrams, and those as (n, 3) code points."""
    joined = "\n".join(t or "" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    num = letters.number(points).astype(np.int64)
    # blanks: a non-letter next to a letter; a run of them is one blank
    num[num == 0] = 1
    keep = np.ones(len(num), bool)
    keep[1:] = (num[1:] != 1) | (num[:-1] != 1)
    row = np.repeat(np.arange(len(texts)), lengths)[: len(num)]
    first = np.zeros(len(num), bool)
    first[(np.cumsum(lengths) - lengths)[np.cumsum(lengths) - lengths < len(num)]] = True
    keep |= first                       # every row keeps a blank of its own at a start
    num, row = num[keep], row[keep]
    # a blank before the first letter of every row
    at = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.empty(0, np.int64)
    num, row = np.insert(num, at, 1), np.insert(row, at, row[at])
    num, row = np.append(num, 1), np.append(row, -1)
    a, b, c = num[:-2], num[1:-1], num[2:]
    ok = (b != 1) & (row[:-2] == row[1:-1]) & ((row[1:-1] == row[2:]) | (c == 1))
    size = len(letters.points)
    code = (a[ok] * size + b[ok]) * size + c[ok]
    row = row[1:-1][ok]
    if size ** 3 <= 1 << 24:
        present = np.flatnonzero(np.bincount(code, minlength=1))
        index = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
        index[present] = np.arange(len(present))
        which = index[code] if len(code) else code
    else:
        present, which = np.unique(code, return_inverse=True)
    pts = np.array(letters.points, np.int64)
    tri = np.stack([pts[present // size // size], pts[present // size % size], pts[present % size]], axis=1)
    return row, which, tri


def _batches(texts: list[str | None]):
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    yield from row_slices(sizes, BATCH_CHARS)


def fit_prototypes(train: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """``train(text, lang)`` → language → prototype. All given rows count.

    Tasks count trigrams per language, Spark sums the counts by (language,
    trigram), tasks turn those into vectors and Spark sums them by (language,
    coordinate): ``dim`` whole numbers per language reach the driver. Rows with
    a null text or language are left out; no rows give no prototypes.
    """
    small_batches(train.sparkSession)

    def count(batches):
        letters = Letters()
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: dict[tuple, int] = {}
            names = sorted(set(langs))
            code = {x: i for i, x in enumerate(names)}
            for a, b in _batches(texts):
                row, which, tri = trigram_counts(texts[a:b], letters)
                of = np.fromiter((code[x] for x in langs[a:b]), np.int64, b - a)
                n = np.bincount(of[row] * len(tri) + which, minlength=len(names) * len(tri)).reshape(len(names), -1)
                for i, j in zip(*np.nonzero(n)):
                    key = (names[i], *tri[j].tolist())
                    out[key] = out.get(key, 0) + int(n[i, j])
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), *[pa.array(x, pa.int32()) for x in cols[1:]],
                     pa.array(list(out.values()), pa.int64())], ["lang", "a", "b", "c", "n"])

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            tri = np.stack([batch.column(i).to_numpy() for i in (1, 2, 3)], axis=1) if batch.num_rows else None
            n = batch.column(4).to_numpy().astype(np.float64)
            for a in range(0, batch.num_rows, 4096):
                vectors = bind(tri[a: a + 4096], dim, seed)
                for lang in sorted(set(langs[a: a + 4096])):
                    of = langs[a: a + 4096] == lang
                    sums[lang] = sums.get(lang, 0) + n[a: a + 4096][of] @ vectors[of]
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim, pa.string()), pa.array(np.arange(dim, dtype=np.int32)),
                                              pa.array(v.astype(np.int64))], ["lang", "i", "n"])

    counts = train.where("text is not null and lang is not null").select("text", "lang") \
        .mapInArrow(count, "lang string, a int, b int, c int, n long") \
        .groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n"))
    total = counts.mapInArrow(bundle, "lang string, i int, n long").groupBy("lang", "i").agg(F.sum("n").alias("n")).toPandas()
    return {str(lang): part.sort_values("i")["n"].to_numpy(np.float64) for lang, part in total.groupby("lang")}


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``docs(doc_id, text, ...)`` → all given columns but the text, then
    ``lang_pred`` and ``score``: the largest cosine, cut to 0..1.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when nothing was learned. Whole texts count, however long; ties go to
    the language first in code-point order; a given column named as a result is
    replaced by it; repeated rows stay and no rows give none.
    """
    names = sorted(prototypes)
    units = [prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-12) for x in names]
    matrix = np.stack(units, axis=1).astype(np.float32) if names else np.zeros((dim, 0), np.float32)
    fields = [f for f in docs.schema if f.name.lower() not in ("text", "lang_pred", "score")]
    others = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string", "score double"])

    def predict(batches):
        letters = Letters()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lang, score = [UNDEFINED] * len(texts), [0.0] * len(texts)
            for a, b in _batches(texts):
                row, which, tri = trigram_counts(texts[a:b], letters)
                if not len(row) or not names:
                    continue
                vectors = bind(tri, dim, seed)
                order = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                rows = row[order]
                for k in range(0, len(rows), 64):
                    lo = order[k]
                    hi = order[k + 64] if k + 64 < len(order) else len(row)
                    local = np.searchsorted(rows[k: k + 64], row[lo:hi])
                    m = len(rows[k: k + 64])
                    counts = np.bincount(local * len(tri) + which[lo:hi], minlength=m * len(tri)).reshape(m, -1)
                    used = np.flatnonzero(counts.any(axis=0))
                    v = counts[:, used].astype(np.float32) @ vectors[used]
                    cos = (v @ matrix) / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
                    best = cos.argmax(axis=1)
                    for i, r in enumerate(rows[k: k + 64].tolist()):
                        lang[a + r] = names[best[i]]
                        score[a + r] = round(float(min(1.0, max(0.0, cos[i, best[i]]))), 6)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(others))], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*others, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in [*others, "text"]]).mapInArrow(predict, schema)


def score_floor(train: DataFrame, prototypes: dict[str, np.ndarray], share: float = 0.001, dim: int = DIM,
                seed: int = SEED) -> float:
    """The score below which a text of ``JUDGED_CHARS`` characters or more is in
    none of the learned languages: half of what all but ``share`` of such rows of
    ``train(text)`` reach, and at least three deviations of the cosine of
    unrelated vectors. Shorter texts have too few trigrams to be judged."""
    long = train.where(F.length("text") >= JUDGED_CHARS).select("text")
    low = predict_language(long, prototypes, dim, seed).agg(F.percentile_approx("score", share, 10000)).first()[0]
    return max(3 / dim ** 0.5, (low or 0.0) / 2)


def in_learned_language(length: Column, floor: float) -> Column:
    """Condition on ``lang_pred`` and ``score`` of a text of ``length`` characters."""
    return (F.col("lang_pred") != UNDEFINED) & ((length < JUDGED_CHARS) | (F.col("score") >= floor))
