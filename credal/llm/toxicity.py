"""Toxicity scores from a bidirectional gated recurrent network.

A word's input is a hashed word embedding beside the mean embedding of its
hashed character trigrams. Two gated recurrent units read a window of
``WINDOW`` words from either side, attention pools their states, and a logistic
unit scores the window. A document's score is that of its highest window; there
is a window at every word that has ``WINDOW`` words from there on, and one for a
shorter text. All of them are scored: a step of the recurrence runs for all
windows of a stretch at once, on slices of the words' projections, and attention
needs only two numbers of each state.

Training is plain numpy on the driver, on a bounded sample of labelled rows:
at most ``SAMPLE`` per class, of at most ``SAMPLE_CHARS`` characters, chosen by a
hash of the id. As only the document is labelled, an epoch trains on each
document's highest window so far (random ones at first), among windows at every
``TRAIN_STRIDE``-th word. Scoring is one pass
over the documents; the network's few hundred kilobytes go to each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import mix64, row_slices, small_batches, stored

WINDOW, TRAIN_STRIDE = 8, 4
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 16
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 13
SAMPLE, SAMPLE_CHARS = 3000, 8000
EPOCHS, WARM, BATCH, RATE = 14, 5, 128, 0.01
TEXT_BYTES = 2 << 20
CHUNK = 4096


# inputs --------------------------------------------------------------------------
def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Flat word numbers, row offsets and the distinct words of a batch: lower
    case, white space parts words, outer punctuation is dropped."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = words.flatten().dictionary_encode()
    bare = pc.utf8_trim(flat.dictionary, " \t.,;:!?\"'()[]{}<>|*_-").dictionary_encode()
    index = bare.indices.to_numpy(zero_copy_only=False)[flat.indices.to_numpy(zero_copy_only=False)] \
        if len(flat) else np.empty(0, np.int64)
    offsets = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    distinct = bare.dictionary.to_pylist()
    if "" in distinct:                      # bare punctuation, and what splitting leaves at the edges
        real = index != distinct.index("")
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        index = index[real]
    return index.astype(np.int64), offsets, distinct


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash row of each word, hash rows of its character trigrams (with edge
    marks), and where each word's trigrams begin."""
    marked = [f"\x02{w}\x03".encode() for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked) + b"\0\0", np.uint8).astype(np.uint64)
    starts = np.cumsum(size) - size
    tri = mix64(data[:-2] | data[1:-1] << np.uint64(8) | data[2:] << np.uint64(16), 5)
    n = np.maximum(size - 2, 1)                        # an empty word keeps one
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    grams = (tri[at] % np.uint64(CHAR_ROWS)).astype(np.int64)
    pos = np.arange(len(data) - 2, dtype=np.uint64) - np.repeat(starts, size).astype(np.uint64)
    letters = mix64(data[:-2] + (pos << np.uint64(8)), 6)
    whole = np.add.reduceat(letters, starts) if len(words) else np.empty(0, np.uint64)
    return (mix64(whole, 7) % np.uint64(WORD_ROWS)).astype(np.int64), grams, np.cumsum(n) - n


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and first position of the windows to train on; the last one ends with the text."""
    row, start = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b <= a:
            continue
        s = list(range(a, max(a + 1, b - WINDOW + 1), TRAIN_STRIDE))
        if s[-1] + WINDOW < b:
            s.append(b - WINDOW)
        row += [i] * len(s)
        start += s
    return np.array(row, np.int64), np.array(start, np.int64)


def window_words(flat: np.ndarray, offsets: np.ndarray, row: np.ndarray, start: np.ndarray, pad: int) -> np.ndarray:
    """(windows, WINDOW) word numbers; ``pad`` past the end of the text."""
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[row + 1][:, None]
    return np.where(inside, flat[np.minimum(at, max(0, len(flat) - 1))], pad)


# network -------------------------------------------------------------------------
def new_network(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, h = WORD_DIM + CHAR_DIM, HIDDEN

    def init(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = {"words": init(WORD_ROWS, WORD_DIM, scale=0.1), "chars": init(CHAR_ROWS, CHAR_DIM, scale=0.1),
           "look": init(2 * h, scale=0.3), "out": init(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
    for side in "fb":
        net[side + "W"] = init(d, 3 * h, scale=d ** -0.5)
        net[side + "U"] = init(h, 3 * h, scale=h ** -0.5)
        net[side + "c"] = np.zeros(3 * h, np.float32)
    return net


def inputs(net, words, grams, starts):
    """(n, WORD_DIM + CHAR_DIM) inputs of the distinct words."""
    if not len(words):
        return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
    n = np.diff(np.append(starts, len(grams)))
    chars = np.add.reduceat(net["chars"][grams], starts, axis=0) / n[:, None]
    return np.concatenate([net["words"][words], chars], axis=1).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(net, side, proj, live, keep=None):
    """States (steps, n, h) of one direction. ``proj`` (steps, n, 3h)."""
    steps, n, _ = proj.shape
    h, u = HIDDEN, net[side + "U"]
    state = np.zeros((n, h), np.float32)
    out = np.empty((steps, n, h), np.float32)
    order = range(steps) if side == "f" else range(steps - 1, -1, -1)
    for t in order:
        gates = _sigmoid(proj[t, :, : 2 * h] + state @ u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(proj[t, :, 2 * h:] + (r * state) @ u[:, 2 * h:])
        nxt = state + live[t][:, None] * z * (new - state)
        if keep is not None:
            keep[t] = (state, z, r, new)
        state = nxt
        out[t] = state
    return out


def forward(net, proj, index, live, tape=None):
    """Logits of windows ``index`` (n, WINDOW); ``proj`` per direction holds the
    distinct words' projections and a last row for padding."""
    live = np.ascontiguousarray(live.T.astype(np.float32))
    keeps = ({}, {}) if tape is not None else (None, None)
    states = np.concatenate([_run(net, s, proj[s][index.T], live, k) for s, k in zip("fb", keeps)], axis=2)
    look = states @ net["look"] + (live - 1) * 1e9
    look = np.exp(look - look.max(axis=0))
    attention = look * live
    attention /= np.maximum(attention.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", attention, states)
    if tape is not None:
        tape.update(keeps=keeps, states=states, attention=attention, pooled=pooled, live=live)
    return pooled @ net["out"] + net["bias"][0]


def projections(net, x):
    out = {}
    for s in "fb":
        p = x @ net[s + "W"] + net[s + "c"]
        out[s] = np.concatenate([p, np.zeros((1, p.shape[1]), np.float32)]).astype(np.float32)
    return out


def gradients(net, features, index, live, label, weight):
    """Loss gradients of a batch by back-propagation through time."""
    words, grams, starts = features
    used, local = np.unique(index, return_inverse=True)
    local = local.reshape(index.shape)
    real = used[used < len(words)]
    ends = np.append(starts, len(grams))[real + 1] if len(real) else np.empty(0, np.int64)
    n = ends - starts[real]
    sub = np.repeat(starts[real] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    w, g, s = words[real], grams[sub], np.cumsum(n) - n
    x = inputs(net, w, g, s)
    proj = projections(net, x)
    tape: dict = {}
    logit = forward(net, proj, local, live, tape)
    h = HIDDEN
    d_logit = ((_sigmoid(logit) - label) * weight / len(label)).astype(np.float32)
    grad = {"out": tape["pooled"].T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_pool = d_logit[:, None] * net["out"]
    states, attention = tape["states"], tape["attention"]
    d_att = np.einsum("nh,tnh->tn", d_pool, states)
    d_look = attention * (d_att - (attention * d_att).sum(axis=0))
    grad["look"] = np.einsum("tn,tnh->h", d_look, states)
    d_states = attention[:, :, None] * d_pool + d_look[:, :, None] * net["look"]
    dx = np.zeros_like(x)
    for k, side in enumerate("fb"):
        u, keep = net[side + "U"], tape["keeps"][k]
        d_u = np.zeros_like(u)
        d_proj = np.zeros((len(used) + (len(real) == len(used)), 3 * h), np.float32)
        carry = np.zeros((index.shape[0], h), np.float32)
        d_all = np.empty((WINDOW, index.shape[0], 3 * h), np.float32)
        for t in (range(WINDOW - 1, -1, -1) if side == "f" else range(WINDOW)):
            state, z, r, new = keep[t]
            m = tape["live"][t][:, None]
            d = d_states[t, :, k * h: (k + 1) * h] + carry
            d_new = d * m * z * (1 - new * new)
            d_z = d * m * (new - state) * z * (1 - z)
            back = d_new @ u[:, 2 * h:].T
            d_r = back * state * r * (1 - r)
            carry = d * (1 - m * z) + back * r + d_z @ u[:, :h].T + d_r @ u[:, h: 2 * h].T
            d_u[:, :h] += state.T @ d_z
            d_u[:, h: 2 * h] += state.T @ d_r
            d_u[:, 2 * h:] += (r * state).T @ d_new
            d_all[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        flat = local.T.reshape(-1)
        for c in range(3 * h):
            d_proj[:, c] = np.bincount(flat, d_all[:, :, c].reshape(-1), minlength=len(d_proj))
        d_proj = d_proj[: len(real)]
        grad[side + "U"], grad[side + "W"], grad[side + "c"] = d_u, x.T @ d_proj, d_proj.sum(axis=0)
        dx += d_proj @ net[side + "W"].T
    d_words, d_chars = np.zeros_like(net["words"]), np.zeros_like(net["chars"])
    np.add.at(d_words, w, dx[:, :WORD_DIM])
    np.add.at(d_chars, g, np.repeat(dx[:, WORD_DIM:] / np.maximum(n, 1)[:, None], n, axis=0))
    return grad | {"words": d_words, "chars": d_chars}


def fit(texts: list[str], labels: list[int], seed: int = 1) -> dict[str, np.ndarray]:
    """The trained network. Without rows of both labels it is constant: its
    bias is that of the only label, or 0 without any."""
    net = new_network(seed)
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net["out"][:] = 0
        net["bias"][:] = 0 if not labels else (6 if labels[0] else -6)
        return net
    flat, offsets, words = word_ids(pa.array(texts, pa.string()))
    features = word_features(words)
    row, start = windows(offsets)
    index = window_words(flat, offsets, row, start, len(words))
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    m = {k: np.zeros_like(v) for k, v in net.items()}
    v = {k: np.zeros_like(v) for k, v in net.items()}
    step = 0
    for epoch in range(EPOCHS):
        score = rng.random(len(row)) if epoch < WARM else score_windows(net, features, index)
        order = np.lexsort((score, row))
        last = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True))
        chosen = order[last]
        if epoch < WARM:                       # a second random window of each row
            chosen = np.concatenate([chosen, order[np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))]])
        rng.shuffle(chosen)
        for a in range(0, len(chosen), BATCH):
            pick = chosen[a: a + BATCH]
            got = gradients(net, features, index[pick], index[pick] < len(words), y[row[pick]], weight[row[pick]])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, g in got.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                net[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)) \
                    .astype(np.float32)
    return net


def score_windows(net, features, index) -> np.ndarray:
    """Scores of windows, ``CHUNK`` at a time."""
    proj = projections(net, inputs(net, *features))
    out = np.empty(len(index), np.float32)
    for a in range(0, len(index), CHUNK):
        part = index[a: a + CHUNK]
        out[a: a + CHUNK] = _sigmoid(forward(net, proj, part, part < len(features[0])))
    return out


def _sweep(net, side, proj) -> np.ndarray:
    """(steps, 2, n): attention logit and score of one direction's state at every
    step of ``n`` windows in a row, from the projections (3h, n + WINDOW - 1) of
    their words."""
    h, n = HIDDEN, proj.shape[1] - WINDOW + 1
    part = slice(0, h) if side == "f" else slice(h, 2 * h)
    read = np.stack([net["look"][part], net["out"][part]]).astype(np.float32)
    u_gates, u_new = (np.ascontiguousarray(net[side + "U"][:, c].T) for c in (slice(0, 2 * h), slice(2 * h, 3 * h)))
    out = np.empty((WINDOW, 2, n), np.float32)
    state, gates, new = np.zeros((h, n), np.float32), np.empty((2 * h, n), np.float32), np.empty((h, n), np.float32)
    for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
        x = proj[:, t: t + n]
        np.matmul(u_gates, state, out=gates)
        gates += x[: 2 * h]
        np.negative(gates, out=gates)
        np.minimum(gates, 30, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        gates[h:] *= state
        np.matmul(u_new, gates[h:], out=new)
        new += x[2 * h:]
        np.tanh(new, out=new)
        new -= state
        new *= gates[:h]
        state += new
        np.matmul(read, state, out=out[t])
    return out


def score_texts(net, flat: np.ndarray, offsets: np.ndarray, words: list[str]) -> np.ndarray:
    """The highest window's score of every row (0 without words), from
    :func:`word_ids`."""
    out = np.zeros(len(offsets) - 1)
    if not len(flat):
        return out
    proj = projections(net, inputs(net, *word_features(words)))
    sizes = np.diff(offsets)
    # windows at all words; those that run into the next row are left out of the maxima
    logits = np.full(len(flat) + 1, -np.inf, np.float32)
    for a in range(0, len(flat) - WINDOW + 1, CHUNK):
        span = flat[a: a + CHUNK + WINDOW - 1]
        both = [_sweep(net, s, np.ascontiguousarray(proj[s][span].T)) for s in "fb"]
        look, score = both[0][:, 0] + both[1][:, 0], both[0][:, 1] + both[1][:, 1]
        look -= look.max(axis=0)
        np.exp(look, out=look)
        logits[a: a + look.shape[1]] = (look * score).sum(axis=0) / look.sum(axis=0) + net["bias"][0]
    full = np.flatnonzero(sizes >= WINDOW)
    if len(full):
        ends = np.stack([offsets[full], offsets[full + 1] - WINDOW + 1], axis=1).reshape(-1)
        out[full] = _sigmoid(np.maximum.reduceat(logits, ends)[::2].astype(np.float64))
    short = np.flatnonzero((sizes > 0) & (sizes < WINDOW))
    for k in range(0, len(short), CHUNK):
        rows = short[k: k + CHUNK]
        index = window_words(flat, offsets, rows, offsets[rows], len(words))
        out[rows] = _sigmoid(forward(net, proj, index, index < len(words)))
    return out


# Spark jobs ----------------------------------------------------------------------
def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
                 sample_chars: int = SAMPLE_CHARS) -> dict[str, np.ndarray]:
    """``docs(doc_id, text)``, ``labels(doc_id, toxic)`` → network. Rows with a null
    id, text or label do not count, nor labels other than 0 and 1. At most
    ``sample`` rows per label and ``sample_chars`` characters per row reach the
    driver: the first by a hash of the id, equal rows counting once.

    The sample is drawn on ids and text hashes; only the drawn rows' texts move.
    """
    small_batches(docs.sparkSession)
    at = docs.where(F.length("text") <= sample_chars).select("doc_id", F.xxhash64("text").alias("th"))
    rows = at.join(labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")),
                   "doc_id").distinct().withColumn("h", F.xxhash64("doc_id"))
    drawn = [rows.where(F.col("toxic") == t).orderBy("h", "doc_id", "th").limit(sample) for t in (1, 0)]
    drawn = stored(drawn[0].union(drawn[1]), "sample")
    # at most 2 * sample rows of ids and hashes
    got = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).join(F.broadcast(drawn), ["doc_id", "th"]) \
        .dropDuplicates(["doc_id", "th", "toxic"]).select("doc_id", "text", "toxic", "h").toPandas() \
        .sort_values(["h", "doc_id", "text", "toxic"], kind="stable")
    return fit(got["text"].tolist(), got["toxic"].astype(int).tolist())


def score_toxicity(docs: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    """``docs(doc_id, text, ...)`` → the given columns but the text, then
    ``score`` (0..1, the highest window's) and ``predicted`` (score >= 0.5). Every
    window of the whole text, however long, is scored; a null or wordless text
    scores 0. Equal texts score alike, ties need no rule, repeated rows stay; a
    given column named as a result is replaced by it; no rows give none."""
    small_batches(docs.sparkSession)
    fields = [f for f in docs.schema if f.name.lower() not in ("text", "score", "predicted")]
    others = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["score double", "predicted int"])

    def score(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            out = np.zeros(batch.num_rows)
            for a, b in row_slices(sizes, TEXT_BYTES):
                out[a:b] = score_texts(net, *word_ids(text.slice(a, b - a)))
            out = np.round(out, 6)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(others))], pa.array(out), pa.array((out >= 0.5).astype(np.int32))],
                [*others, "score", "predicted"])

    columns = [F.col(f"`{c}`") for c in [*others, "text"]]
    return docs.select(*columns).mapInArrow(score, schema)
