"""Substring dedup by hashing lines, sentences and runs of short ones.

A text is cut into units: lines, and within a line sentences (after ``.``, ``!``
or ``?`` and white space), so that a passage pasted into a line is still met by
its sentences. Units of fewer than ``min_words`` words repeat by chance; they
count in runs of neighbours, on into the next line, that together reach it: from
each short unit the shortest run forward and the shortest backward. So every
unit of a repeated passage of at least ``min_words`` words is met. Runs are
normalised (lower case, white space collapsed) and hashed to 128 bits; digests
are grouped globally, the occurrence that ranks first (by document id, then
position) stays and the units of all others are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import small_batches, stored

MIN_WORDS = 6
UNIT = {"line": re.compile(r"[^\n]+"),
        "sentence": re.compile(r"[^\n]+?(?:[.!?](?=\s)|(?=\n)|\Z)"),
        "paragraph": re.compile(r"(?:[^\n]|\n(?!\s*\n))+")}


def _split(text: str, unit: str):
    """``(begin, end, words, normalised text)`` of every unit."""
    for m in UNIT[unit].finditer(text):
        s = m.group()
        words = s.lower().split()
        if not words:
            continue
        begin = m.start() + len(s) - len(s.lstrip())
        yield begin, m.start() + len(s.rstrip()), len(words), " ".join(words)


def units_of(text: str, unit: str):
    """``(begin, end, words, digest)`` of every unit: offsets of the unit
    without outer white space, in characters."""
    for begin, end, n, norm in _split(text, unit):
        yield begin, end, n, xxhash.xxh3_128_intdigest(norm)


def runs_of(text: str, unit: str, min_words: int):
    """``(begin, end, digest)`` of every unit of at least ``min_words`` words
    and, from every shorter one, of the shortest run of units forward and
    backward that has as many."""
    units = list(_split(text, unit))
    spans = {}
    for i, (_, _, n, _) in enumerate(units):
        if n >= min_words:
            spans[i, i] = None
            continue
        for step in (1, -1):
            j, total = i, n
            while total < min_words and 0 <= j + step < len(units):
                j += step
                total += units[j][2]
            if total >= min_words:
                spans[min(i, j), max(i, j)] = None
    for i, j in spans:
        norm = units[i][3] if i == j else " ".join(u[3] for u in units[i: j + 1])
        yield units[i][0], units[j][1], xxhash.xxh3_128_intdigest(norm)


def _runs(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for i, th, text in zip(ids, hashes, batch.column(2).to_pylist()):
                for begin, end, digest in runs_of(text or "", unit, min_words):
                    out.append((i, th, begin, end, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
                if len(out) > 20_000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    def _batch(out):
        cols = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          ["doc_id", "th", "begin", "end", "d1", "d2"])

    return docs.mapInArrow(cut, "doc_id long, th long, begin int, end int, d1 long, d2 long")


def repeated_spans(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs(doc_id, text)`` → ``doc_id, text_hash, begin, end`` of every repeated
    run, by original character offsets; what a run shares with its own first
    occurrence is left out.

    Ids order ascending, null first; among rows of one id the text hash decides;
    rows equal in both are one document whose units count once. Null, empty and
    unitless texts give nothing, as does an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       F.col("text").cast("string").alias("text")).where("text is not null")
    runs = stored(_runs(rows, unit, min_words), "runs")
    placed = runs.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "doc_id", "th", "begin", "end")
    return placed.mapInArrow(_later, "doc_id long, text_hash long, begin int, end int")


def _later(batches):
    """Of runs sorted by digest and place, those after the first of their digest;
    only the group's first and the last row are held from batch to batch."""
    held = np.empty((0, 7), np.int64)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = batch.column("doc_id")
        cols = [batch.column("d1"), batch.column("d2"), ids.is_valid().cast(pa.int64()), ids.fill_null(0),
                batch.column("th"), batch.column("begin"), batch.column("end")]
        rows = np.concatenate([held, np.stack([np.asarray(c).astype(np.int64) for c in cols], axis=1)])
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        start = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        same = np.zeros(len(rows), bool)              # rows equal in id and text are one document
        same[1:] = (rows[1:] == rows[:-1]).all(axis=1)
        keep = ~new & ~same
        keep[:len(held)] = False
        first, out = rows[start[keep]], rows[keep]
        own = (out[:, 2:5] == first[:, 2:5]).all(axis=1)
        begin = np.where(own, np.maximum(out[:, 5], first[:, 6]), out[:, 5])
        held = rows[[start[-1], -1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[:, 3], pa.int64(), mask=out[:, 2] == 0), pa.array(out[:, 4]), pa.array(begin.astype(np.int32)),
             pa.array(out[:, 6].astype(np.int32))], ["doc_id", "text_hash", "begin", "end"])


def covered_units(text: str, runs: list, unit: str) -> list[tuple[int, int]]:
    """``(begin, end)`` of the units of ``text`` that lie whole in one of the runs."""
    reach, at, out = -1, 0, []
    runs = sorted(runs)
    for begin, end, _, _ in _split(text, unit):
        while at < len(runs) and runs[at][0] <= begin:
            reach = max(reach, runs[at][1])
            at += 1
        if end <= reach:
            out.append((begin, end))
    return out


def cut_spans(text: str, spans: list) -> str:
    """``text`` without the spans; a line or gap left empty by a cut goes, too."""
    out, at = [], 0
    for begin, end in sorted(spans):
        out.append(text[at:begin])
        at = end
        if (not out[-1] or out[-1][-1].isspace()) and at < len(text) and text[at].isspace():
            at += 1
    out.append(text[at:])
    return "".join(out)


def substring_dedup(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, removed`` (array of
    ``begin, end`` offsets into the original text, ascending), ``n_removed``,
    ``removed_chars`` and ``text``, the rest. A null text stays null."""
    small_batches(docs.sparkSession)
    spans = repeated_spans(docs, unit, min_words).groupBy("doc_id", "text_hash") \
        .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("removed")) \
        .select(F.col("doc_id").alias("sid"), F.col("text_hash").alias("sth"), "removed")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("th"))
    both = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")), "left") \
        .select("doc_id", F.coalesce("removed", F.array().cast("array<struct<begin:int,end:int>>")).alias("removed"), "text")

    def clean(batches):
        for batch in batches:
            texts, spans_ = batch.column(2), [[(x["begin"], x["end"]) for x in s] for s in batch.column(1).to_pylist()]
            out, gone = texts.to_pylist(), np.zeros(len(spans_), np.int64)
            for i, s in enumerate(spans_):
                if s:
                    spans_[i] = s = covered_units(out[i], s, unit)
                    gone[i] = sum(end - begin for begin, end in s)
                    out[i] = cut_spans(out[i], s)
            removed = pa.array([[{"begin": begin, "end": end} for begin, end in s] for s in spans_], batch.schema.field(1).type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), removed, pa.array([len(s) for s in spans_], pa.int32()), pa.array(gone),
                 pa.array(out, pa.string())], ["doc_id", "removed", "n_removed", "removed_chars", "text"])

    return both.mapInArrow(clean, "doc_id long, removed array<struct<begin:int,end:int>>, n_removed int, "
                                  "removed_chars long, text string")
