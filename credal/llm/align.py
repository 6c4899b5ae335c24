"""Alignment of two tokenizers over the bytes of whole texts.

Both tokenizers read a text with one space before it. A token's byte range is
taken from the library's own spans: character offsets of the ``tokenizers``
library, begin and end of the pieces in sentencepiece's proto. Those spans are
coarse where tokens share a multibyte character (both carry the whole
character, and byte-fallback pieces an empty or a whole one); there the ranges
are refined with the lengths of the tokens' decoded bytes. Where tokens of both
end at one byte, a group ends.

Neither tokenizer merges across certain places (a space after a character that is
no white space; a line end or ASCII sign after an ASCII letter or digit; the
character after a single line end): the first splits there before it merges,
the second has no piece that goes on over them, which is checked on its
vocabulary when it is loaded. Texts are cut there into units, and each distinct
unit is aligned once; the counts and groups of a text are those of its units in
order. Units that are not known yet are encoded joined to one text, as the
same places part them there.

Links, pairs of overlapping tokens, are counted over the whole corpus without
a row per document and pair: a chunk of documents (``CHUNK_BYTES`` of text) is
one row with its distinct pairs and their counts. The pairs are exploded and
summed, the sums are joined back to the chunks' distinct pairs, and each
chunk's sums travel to it once. So no table of pairs is broadcast or held by
one task, at whatever size; a pair that every document holds is one row per
chunk. Texts are read once. What a chunk keeps of its documents and units, some
10 MB, is not moved by Spark: a task writes it to a file of its own in the shared
folder, the chunk's row says where, and the task that gets the chunk's sums reads
it back, one chunk at a time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import open_fs, row_slices, shared_path, small_batches, stored, text_bytes

CHUNK_BYTES = 4 << 20
POOL_UNITS = 250_000
SPACE_MARK = "▁"

_LETTER_SIGN = re.compile(r"[0-9A-Za-z][!-/:-@\[-`{-~]")
_WORD, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN[0x21:0x7F] = True
_SIGN &= ~_WORD

_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_CHUNK = "chunk long, file string, at long, size long, pairs array<bigint>, counts array<bigint>"


def byte_level() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from U+0100 on, in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Aligns units with tokenizer A (a ``tokenizers`` file, byte level) and B (a
    sentencepiece model), and keeps at most about ``POOL_UNITS`` of them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_level()
        bytes_a = [b""] * (1 + max(self.a.get_vocab(with_added_tokens=True).values()))
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            known = [letters.get(c) for c in token]
            bytes_a[i] = token.encode() if None in known else bytes(known)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                   for i, p in enumerate(pieces)]
        #: units may be cut where no piece of B goes on
        self.cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in plain)
        self.fine = self.cuts and not any("\n" in p or _LETTER_SIGN.search(p) for p in plain)
        self.table_a, self.table_b = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        #: ids as text with what follows: "," within a group, "|" after its A ids, ";" after its B ids
        self.names = pa.array([f"{i}{c}" for n, end in ((len(bytes_a), "|"), (len(bytes_b), ";"))
                               for i in range(n) for c in (",", end)], pa.large_binary())
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.sums = np.empty((0, 4), np.int64)
        self.good = np.empty(0, bool)
        self.texts = pa.array([], pa.large_binary())
        self.link_at, self.link_pairs = np.zeros(1, np.int64), np.empty(0, np.int64)

    # spans -----------------------------------------------------------------------
    def spans(self, text: str) -> tuple[np.ndarray, ...] | None:
        """Ids and end bytes of both tokenizers' tokens; ``text`` begins with a
        space. None if the tokens' bytes are not the text's."""
        data = np.frombuffer(text.encode(), np.uint8)
        e = self.a.encode(text, add_special_tokens=False)
        p = self.b.encode(text[1:], return_type="proto").pieces          # B adds the space
        ia, ib = np.array(e.ids, np.int64), np.array([q.id for q in p], np.int64)
        if not (len(ia) and len(ib) and _same(self.table_a.take(pa.array(ia)), data)
                and _same(self.table_b.take(pa.array(ib)), data)):
            return None
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))     # bytes of the characters
        ea = refined(at[np.array([end for _, end in e.offsets], np.int64)], self.size_a[ia])
        return ia, ea, ib, refined(np.array([q.end for q in p], np.int64) + 1, self.size_b[ib])

    def aligned(self, units: list[str]) -> tuple | None:
        """Sums, group texts, links per unit and pairs of units joined to one
        text; None if that has other bytes than its tokens."""
        got = self.spans("".join(units))
        if got is None:
            return None
        ia, ea, ib, eb = got
        n, sa, sb = len(units), ea - self.size_a[ia], eb - self.size_b[ib]
        ends = np.cumsum([len(u.encode()) for u in units])
        cuts = np.intersect1d(ea, eb, assume_unique=True)
        ga, gb, unit = np.searchsorted(cuts, ea), np.searchsorted(cuts, eb), np.searchsorted(ends, cuts)
        # every A token with the B tokens that begin before its end and end after its begin
        first = np.searchsorted(eb, sa, side="right")
        size = np.searchsorted(sb, ea) - first
        a_of = np.repeat(np.arange(len(ia)), size)
        b_of = np.arange(len(a_of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        of = [unit[ga], unit[gb], unit, unit[ga][a_of]]
        sums = np.stack([np.bincount(x, minlength=n) for x in of], axis=1)
        # texts of the groups
        entry = np.concatenate([ia * 2 + np.append(ga[1:] != ga[:-1], True),
                                2 * len(self.table_a) + ib * 2 + np.append(gb[1:] != gb[:-1], True)])
        group = np.concatenate([ga, gb])
        order = np.lexsort((np.repeat([0, 1], [len(ia), len(ib)]), group))
        named = self.names.take(pa.array(entry[order]))
        at = np.frombuffer(named.buffers()[1], np.int64)[: len(named) + 1]
        begin = np.searchsorted(unit[group[order]], np.arange(n + 1))
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at[begin].copy()), named.buffers()[2]])
        return sums, texts, sums[:, 3], ia[a_of] << 32 | ib[b_of]

    def _add(self, units: list[str]) -> None:
        """Align units and add them to the pool: joined those after which a space is
        a cut, the others one by one."""
        joined, places, alone = [], {}, []
        for u in units:
            c = ord(u[-1])
            if not (0x20 < c < 0x7F or 0xC0 <= c < 0x1000 or c >= 0x4000) or len(u) > 4096:
                alone.append(u)
                continue
            joined += _before(u)
            places[u] = len(joined)
            joined.append(u)
        found = []
        whole = self.aligned(joined) if places else None
        if whole is None:
            alone = units
        else:
            found.append((list(places), _part(whole, np.array(list(places.values()))), True))
        for u in alone:
            before = _before(u)
            got = self.aligned([*before, u])
            empty = np.zeros((1, 4), np.int64), pa.array([b""], pa.large_binary()), np.zeros(1, np.int64), np.empty(0, np.int64)
            found.append(([u], empty if got is None else _part(got, np.array([len(before)])), got is not None))
        for names, _, _ in found:
            for u in names:
                self.index[u] = len(self.index)
        sums, texts, n_links, pairs = zip(*[part for _, part, _ in found])
        self.sums = np.concatenate([self.sums, *sums])
        self.texts = pa.concat_arrays([self.texts, *texts])
        self.link_at = np.concatenate([self.link_at, self.link_at[-1] + np.cumsum(np.concatenate(n_links))])
        self.link_pairs = np.concatenate([self.link_pairs, *pairs])
        self.good = np.concatenate([self.good, np.repeat([fits for _, _, fits in found], [len(x) for x, _, _ in found])])

    # chunks ----------------------------------------------------------------------
    def units(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Units of all rows, and the n + 1 offsets of the rows in them."""
        texts = pc.fill_null(texts, "")
        data, offsets = text_bytes(pc.if_else(pc.equal(pc.binary_length(texts), 0), "",
                                              pc.binary_join_element_wise(" ", texts, "")))
        n = len(data)
        begin = np.zeros(n + 1, bool)
        if self.cuts and n:
            begin[1:n] = (data[1:] == 0x20) & closed(data)[:-1]
            begin[offsets[1:] - 1] = False                # B has no token for a last space by itself
        if self.fine and n > 2:
            word, sign, line = _WORD[data], _SIGN[data], data == 0x0A
            begin[1:n] |= (sign[1:] & word[:-1]) | (line[1:] & (word | sign)[:-1])
            begin[2:n] |= word[2:] & line[1:-1] & (word | sign)[:-2]
        begin[offsets] = True
        starts = np.flatnonzero(begin[:n])
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, n).astype(np.int64)),
                                                pa.py_buffer(np.ascontiguousarray(data)))
        return flat.dictionary_encode(), np.searchsorted(starts, offsets).astype(np.int64)

    def chunk(self, texts: pa.Array) -> dict:
        """Counts, groups and pairs of a chunk of texts."""
        if len(self.good) > POOL_UNITS:
            self.reset()
        coded, at = self.units(texts)
        words = coded.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.index]
        for a in range(0, len(fresh), 8192):
            self._add(fresh[a: a + 8192])
        of = np.fromiter((self.index[w] for w in words), np.int64, len(words))   # local → pool
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

        def per_row(values):
            total = np.concatenate([[0], np.cumsum(values)])
            return total[at[1:]] - total[at[:-1]]

        fits = per_row(~self.good[of][index]) == 0
        sizes = np.where(fits, np.diff(at), 0)
        index = index[np.repeat(fits, np.diff(at))]                              # misfits keep no units
        at = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.stack([per_row(self.sums[of, k][index]) for k in range(4)], axis=1)
        joined = self.texts.take(pa.array(of[index]))
        raw = joined.buffers()
        text = memoryview(raw[2]) if len(joined) and raw[2] is not None else b""
        ends = np.frombuffer(raw[1], np.int64)[: len(joined) + 1][at] if len(joined) else np.zeros(len(at), np.int64)
        digests = [hashlib.sha256(text[a: b - 1]).hexdigest() if b > a else ""
                   for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        # distinct pairs, their counts, and which of them each distinct unit holds
        n_links = np.diff(self.link_at)[of]
        link_at = np.concatenate([[0], np.cumsum(n_links)]).astype(np.int64)
        place = np.arange(link_at[-1]) - np.repeat(link_at[:-1], n_links) + np.repeat(self.link_at[:-1][of], n_links)
        used = np.bincount(index, minlength=len(of))
        pairs, links = np.unique(self.link_pairs[place], return_inverse=True)
        counts = np.bincount(links, np.repeat(used, n_links), minlength=len(pairs)).astype(np.int64)
        return {"sums": sums, "digests": digests, "unit_at": at.astype(np.int64), "units": index.astype(np.int32),
                "link_at": link_at, "links": links.astype(np.int32), "pairs": pairs, "counts": counts}


def closed(data: np.ndarray) -> np.ndarray:
    """Bytes that end a character which is surely no white space. Characters led
    by C2, E1, E2 and E3, some of them white space, count as open."""
    ok = (data > 0x20) & (data < 0x7F)
    cont = (data & 0xC0) == 0x80
    for back in (1, 2, 3):
        lead = np.zeros_like(data)
        lead[back:] = data[:-back]
        width = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        ok |= cont & (lead >= 0xC3) & ~np.isin(lead, (0xE1, 0xE2, 0xE3)) & (width == back + 1)
    return ok


def refined(coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """End bytes of tokens: the spans', and where a span isn't as wide as the
    token's bytes, the place its bytes lead to."""
    return np.where(np.diff(coarse, prepend=0) == sizes, coarse, np.cumsum(sizes))


def _before(unit: str) -> list[str]:
    """Units that may come before one that doesn't begin with a space."""
    return [] if unit[0] == " " else [" a", "\n"] if unit[0].isalnum() else [" a"]


def _part(got: tuple, at: np.ndarray) -> tuple:
    """The units at the places ``at`` of an alignment."""
    sums, texts, n_links, pairs = got
    start, size = (np.cumsum(n_links) - n_links)[at], n_links[at]
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    return sums[at], texts.take(pa.array(at)), size, pairs[place]


def _same(tokens: pa.Array, data: np.ndarray) -> bool:
    """Are the tokens' bytes, joined, these bytes?"""
    at, raw = np.frombuffer(tokens.buffers()[1], np.int64), tokens.buffers()[2]
    return at[len(tokens)] == len(data) and np.array_equal(np.frombuffer(raw, np.uint8)[: len(data)], data)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker, kept from task to task with its pool."""
    return Aligner(path_a, path_b)


def _packed(columns: dict[str, pa.Array]) -> pa.Buffer:
    """Arrays of one chunk, compressed."""
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                                        for v in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue()


def _unpacked(data: pa.Buffer) -> dict[str, pa.Array]:
    batch = next(iter(pa.ipc.open_stream(data)))
    return {name: batch.column(k).flatten() for k, name in enumerate(batch.schema.names)}


def _chunks(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int) -> DataFrame:
    """A row per chunk of documents; the rest of it lies in ``file`` from byte ``at`` on."""
    folder = shared_path(docs.sparkSession, "chunk-files")

    def run(batches):
        tool = aligner(path_a, path_b)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        store, top = open_fs(folder)
        name = f"{task}-{uuid.uuid4().hex}"             # another attempt writes another file
        sink, held, size, done = None, [], 0, 0

        def flush():
            nonlocal sink, held, size, done
            if sink is None:
                store.create_dir(top, recursive=True)
                sink = store.open_output_stream(f"{top}/{name}")
            table = pa.Table.from_batches(held)
            held, size = [], 0
            got = tool.chunk(table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string()))
            kept = {"doc_id": table.column("doc_id").combine_chunks().cast(pa.int64())}
            kept |= {c: pa.array(got["sums"][:, k]) for k, c in enumerate(_COUNTS)}
            kept |= {"groups_sha256": pa.array(got["digests"], pa.string())}
            kept |= {c: pa.array(got[c]) for c in ("unit_at", "units", "link_at", "links")}
            data, at = _packed(kept), sink.tell()
            sink.write(data)
            row = {"chunk": pa.array([task << 32 | done]), "file": pa.array([name]), "at": pa.array([at]), "size": pa.array([data.size])}
            row |= {c: pa.array([got[c]], pa.list_(pa.int64())) for c in ("pairs", "counts")}
            done += 1
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        try:
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False) + 16
                for a, b in row_slices(sizes, chunk_bytes):
                    if held and size + int(sizes[a:b].sum()) > chunk_bytes:
                        yield flush()
                    held.append(batch.slice(a, b - a))
                    size += int(sizes[a:b].sum())
            if held:
                yield flush()
        finally:
            if sink is not None:
                sink.close()

    return docs.mapInArrow(run, _CHUNK).withColumn("file", F.concat(F.lit(f"{folder}/"), "file"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, count, best`` of the whole corpus: its links, and whether no pair
    of the same B id has more."""
    counts = stored(chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
                    .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # a row per id of B's vocabulary at most
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), b == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs(doc_id long, text)`` → a row for every row: ``doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum`` (longs), ``groups_sha256``.

    Null and empty texts, and texts whose tokens' bytes are not the text with a
    space before it, count zeros and ``''``, and none of their links. Null and
    repeated ids are rows of their own, equal texts count each time, pairs tied
    for a B id's highest count are all best. Other columns are ignored, no rows
    give none. A text is never cut short: a long one is a chunk of its own.
    """
    small_batches(docs.sparkSession)
    chunks = stored(_chunks(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                            path_a, path_b, chunk_bytes), "chunks")
    scored = chunks.select("chunk", F.posexplode("pairs").alias("i", "pair")).join(pair_counts(chunks), "pair") \
        .groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("i", "count", "best"))).alias("scores"))
    whole = chunks.drop("pairs", "counts").join(scored, "chunk", "left")

    def total(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                store, path = open_fs(batch.column("file")[k].as_py())
                with store.open_input_file(path) as file:
                    file.seek(batch.column("at")[k].as_py())
                    flat = _unpacked(file.read_buffer(batch.column("size")[k].as_py()))
                unit_at, units, link_at, links = (flat[c].to_numpy() for c in ("unit_at", "units", "link_at", "links"))
                scores = batch.column("scores").slice(k, 1).flatten()
                out = []
                for part in ("best", "count"):
                    of_pair = scores.field(part).to_numpy(zero_copy_only=False).astype(np.int64) if len(scores) else \
                        np.empty(0, np.int64)
                    of_link = np.concatenate([[0], np.cumsum(of_pair[links])])
                    of_unit = of_link[link_at[1:]] - of_link[link_at[:-1]]
                    run = np.concatenate([[0], np.cumsum(of_unit[units])])
                    out.append(pa.array(run[unit_at[1:]] - run[unit_at[:-1]], pa.int64()))
                yield pa.RecordBatch.from_arrays([flat["doc_id"], *[flat[c] for c in _COUNTS], *out, flat["groups_sha256"]],
                                                 ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    return whole.mapInArrow(total, "doc_id long, " + ", ".join(f"{c} long" for c in [*_COUNTS, "n_best", "count_sum"])
                            + ", groups_sha256 string")
