"""Token-id shards: independent zstandard frames with a trailing seek table.

A shard holds whole documents in ascending id order. Layout::

    zstd frame 0 | zstd frame 1 | ... | index (skippable frame) | seek table (skippable frame)

* a frame holds the ids of consecutive documents, little-endian ``uint16`` or
  ``uint32``; a document never spans frames; each frame decompresses alone;
* the index (magic 0x184D2A50) is zstd-compressed: a JSON line ``{"dtype",
  "frames": documents per frame}``, then int64 doc ids, a null mask and int64
  token counts;
* the seek table is that of the public zstd seekable format (magic 0x184D2A5E,
  footer 0x8F92EAB1): per frame its compressed size, decompressed size and the
  low 32 bits of the XXH64 of its content.

So any zstd tool can decompress a shard front to back, and a reader of single
documents fetches the tail, then only the frames it needs.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from credal.llm.common import open_fs, pieces, row_slices, shared_path, small_batches, stored

INDEX_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
SHARD_ROWS = 4096
FRAME_IDS = 1 << 16
BATCH_BYTES = 4 << 20
CACHE_WORDS = 600_000


# encoding ------------------------------------------------------------------------
class _Restart(Exception):
    """The short way differs from a full encoding; encode the batch anew without it."""


class WordEncoder:
    """Whole-text encoding through the tokenizers library, one call per
    distinct word.

    For a tokenizer that drops white space and never merges across it, the ids
    of a text are those of its white-space-separated words in order; a run of
    letters followed by a full stop or comma splits there, too. Words are found,
    dictionary-encoded and looked up by Arrow, unseen ones are encoded by the
    library, and the ids of a batch are gathered from the pool of known words. The pool
    is emptied when it passes ``CACHE_WORDS`` words, so memory stays bounded.

    A word of lower-case letters is one pre-token. If the tokenizer's stages,
    asked once, leave such words whole, its characters' forms are taken from
    them per character and only the merges run per word; of every call's words
    some are compared with a full encoding, and a difference ends the short way.
    Texts that hold an added token's string, in any letter case, are encoded whole.
    """

    def __init__(self, path: str, end_id: int | None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else "<u4")
        self.end_id = end_id
        self.added = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self._reset()
        self.forms: dict[int, str | None] = {}
        self.direct = all(self._stages(w) == [w] for w in ("word", "abcxyz", "internationalisation"))

    def _stages(self, text: str) -> list[str]:
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text]

    def _form(self, word: str) -> str | None:
        """The word as the merges see it; None if it needs all stages."""
        if not (self.direct and word.isalpha()):
            return None
        if word.isascii():
            return word
        if not unicodedata.is_normalized("NFC", word):
            return None
        for c in set(word):
            if ord(c) not in self.forms:
                got = self._stages(c) if unicodedata.category(c) == "Ll" and c.lower() == c else []
                self.forms[ord(c)] = got[0] if len(got) == 1 else None
            if self.forms[ord(c)] is None:
                return None
        return word.translate(self.forms)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of the words as bytes, by the library."""
        pack, code = struct.pack, "H" if self.dtype.itemsize == 2 else "I"
        merge, rest, out = self.tokenizer.model.tokenize, [], []
        for k, w in enumerate(words):
            form = w if self.direct and w.isascii() and w.isalpha() else self._form(w)
            if form is None:
                rest.append(k)
                out.append(b"")
            else:
                ids = [t.id for t in merge(form)]
                out.append(pack(f"<{len(ids)}{code}", *ids))
        probe = range(0, len(words), max(1, len(words) // 64))
        rest += [k for k in probe if out[k]]
        for a in range(0, len(rest), 2048):
            part = rest[a: a + 2048]
            got = self.tokenizer.encode_batch_fast([words[k] for k in part], add_special_tokens=False)
            for k, e in zip(part, got):
                ids = pack(f"<{len(e.ids)}{code}", *e.ids)
                if out[k] and out[k] != ids:
                    self.direct = False
                    raise _Restart
                out[k] = ids
        return out

    def _reset(self) -> None:
        """An empty pool: entry 0 is the empty word, entry 1 the end of a text."""
        end = np.array([] if self.end_id is None else [self.end_id], self.dtype).tobytes()
        self.words, self.ids = pa.array(["", None], pa.string()), pa.array([b"", end], pa.binary())

    def _find(self, words: pa.Array) -> np.ndarray:
        """Pool entries of distinct words; unseen ones are encoded first."""
        found = pc.index_in(words, value_set=self.words).to_numpy(zero_copy_only=False)
        unseen = np.isnan(found) if found.dtype.kind == "f" else np.zeros(len(found), bool)
        out = np.where(unseen, 0, found).astype(np.int64)
        if unseen.any():
            fresh = words.filter(pa.array(unseen))
            ids = self._ids(fresh.to_pylist())
            out[unseen] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
            self.ids = pa.concat_arrays([self.ids, pa.array(ids, pa.binary())])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows (end id appended to each) and row offsets."""
        try:
            return self._mixed(texts)
        except _Restart:
            self._reset()
            return self._mixed(texts)

    def _mixed(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Added tokens are found in a text as it is written, before any stage, so a
        text that holds one in any letter case is encoded whole by the library."""
        texts = pc.fill_null(texts, "")
        lower, special = pc.ascii_lower(texts), np.zeros(len(texts), bool)
        for token in self.added:
            special |= pc.match_substring(lower, token).to_numpy(zero_copy_only=False)
        if not special.any():
            return self._encode(texts)
        ids, at = self._encode(pc.if_else(pa.array(special), "", texts))
        end = [] if self.end_id is None else [self.end_id]
        rows = [ids[at[k]: at[k + 1]] for k in range(len(texts))]
        for k in np.flatnonzero(special).tolist():
            got = self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
            rows[k] = np.array(got + end, self.dtype)
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        flat = words.flatten().dictionary_encode()
        if len(self.words) > CACHE_WORDS:
            self._reset()
        # a letter and then one full stop or comma: two pieces
        tail = pc.match_substring_regex(flat.dictionary, "[a-z][.,]$")
        body = pc.if_else(tail, pc.utf8_slice_codeunits(flat.dictionary, 0, -1), flat.dictionary).dictionary_encode()
        mark = pc.if_else(tail, pc.utf8_slice_codeunits(flat.dictionary, -1), "").dictionary_encode()
        first = self._find(body.dictionary)[body.indices.to_numpy(zero_copy_only=False)] if len(body) else np.empty(0, np.int64)
        second = self._find(mark.dictionary)[mark.indices.to_numpy(zero_copy_only=False)] if len(mark) else first
        # pool entries in order: two for every word, the end mark after every row
        offsets = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = (offsets - offsets[0]) * 2
        index = flat.indices.to_numpy(zero_copy_only=False)
        entries = np.insert(np.stack([first[index], second[index]], axis=1).reshape(-1), offsets[1:], 1)
        got = self.ids.take(pa.array(entries))
        raw = got.buffers()
        ids = np.frombuffer(raw[2], self.dtype) if len(got) and raw[2] is not None else np.empty(0, self.dtype)
        ends = np.frombuffer(raw[1], np.int32)[: len(got) + 1] // self.dtype.itemsize
        return ids[: ends[-1]], ends[offsets + np.arange(len(offsets))]


@lru_cache(maxsize=1)
def word_encoder(path: str, end_id: int | None) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task with its pool."""
    return WordEncoder(path, end_id)


# shard files ---------------------------------------------------------------------
def _skippable(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


class ShardWriter:
    """Writes one shard to a file object; holds one frame's ids at a time."""

    def __init__(self, out, dtype: np.dtype, level: int = 1):
        self.out, self.dtype = out, np.dtype(dtype)
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int] = []           # documents per frame
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.size_held = 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        if self.n_held and self.size_held + len(tokens) > FRAME_IDS:
            self._flush()
        self.held.append(tokens.astype(self.dtype, copy=False))
        self.ids.append(doc_id)
        self.counts.append(len(tokens))
        self.n_held += 1
        self.size_held += len(tokens)

    def _flush(self) -> None:
        raw = np.concatenate(self.held).tobytes()
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.docs.append(self.n_held)
        self.held, self.n_held, self.size_held = [], 0, 0

    def close(self) -> None:
        if self.n_held:
            self._flush()
        head = json.dumps({"dtype": self.dtype.str, "frames": self.docs}).encode() + b"\n"
        null = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        body = head + ids.tobytes() + null.tobytes() + np.array(self.counts, "<i8").tobytes()
        self.out.write(_skippable(INDEX_MAGIC, self.zstd.compress(body)))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0x80, SEEK_FOOTER)
        self.out.write(_skippable(SEEK_MAGIC, table))


@dataclass
class Shard:
    """An opened shard: its seek table and index. Reads frames on request."""
    file: object
    dtype: np.dtype
    at: np.ndarray           # first byte of every frame
    frames: list             # (compressed, decompressed, checksum)
    first: np.ndarray        # first document of every frame, and their number
    doc_ids: list
    counts: np.ndarray

    @classmethod
    def open(cls, file, size: int) -> Shard:
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_FOOTER or not flags & 0x80:
            raise ValueError("not a shard: no seek table with checksums at its end")
        length = 8 + 12 * n + 9
        file.seek(size - length)
        head, _ = struct.unpack("<II", file.read(8))
        if head != SEEK_MAGIC:
            raise ValueError("damaged seek table")
        frames = list(struct.iter_unpack("<III", file.read(12 * n)))
        at = np.concatenate([[0], np.cumsum([f[0] for f in frames], dtype=np.int64)]).astype(np.int64)
        file.seek(int(at[-1]))
        head, k = struct.unpack("<II", file.read(8))
        if head != INDEX_MAGIC:
            raise ValueError("damaged index")
        line, _, body = zstandard.ZstdDecompressor().decompress(file.read(k)).partition(b"\n")
        meta = json.loads(line)
        docs = sum(meta["frames"])
        ids = np.frombuffer(body, "<i8", docs)
        null = np.frombuffer(body, np.uint8, docs, 8 * docs)
        counts = np.frombuffer(body, "<i8", docs, 9 * docs)
        first = np.concatenate([[0], np.cumsum(meta["frames"], dtype=np.int64)]).astype(np.int64)
        return cls(file, np.dtype(meta["dtype"]), at, frames, first,
                   [None if z else i for i, z in zip(ids.tolist(), null)], counts)

    def frame(self, k: int) -> np.ndarray:
        """Ids of frame ``k``; raises if its content is not what was written."""
        size, plain, check = self.frames[k]
        self.file.seek(int(self.at[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(size), max_output_size=plain)
        if len(raw) != plain or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: checksum differs")
        return np.frombuffer(raw, self.dtype)

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, int | None, np.ndarray]]:
        """``(position, doc_id, ids)`` of all or the ``wanted`` ids' documents;
        only frames that hold one are decompressed."""
        want = None if wanted is None else set(wanted)
        for k in range(len(self.frames)):
            a, b = int(self.first[k]), int(self.first[k + 1])
            hit = range(a, b) if want is None else [j for j in range(a, b) if self.doc_ids[j] in want]
            if not hit:
                continue
            ids = self.frame(k)
            ends = np.cumsum(self.counts[a:b])
            for j in hit:
                yield j, self.doc_ids[j], ids[ends[j - a] - self.counts[j]: ends[j - a]]


# Spark jobs ----------------------------------------------------------------------
def write_token_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                       shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Encode every text of ``docs(doc_id, text)`` whole and write shards below
    ``path``; returns the stored manifest ``(shard, file, docs, tokens)`` in
    which ``shard`` numbers the files in ascending id order.

    A null text is empty (the end id only); null ids come first; rows with one
    id are separate documents, ordered by text hash; an empty table writes no
    shard. A task writes to names of its own attempt and the manifest, written
    by Spark's commit protocol, names those that count: a lost or repeated task
    leaves at most an unnamed file.
    """
    spark = docs.sparkSession
    small_batches(spark, 1500)
    n = pieces(docs.select("doc_id").count(), shard_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text")) \
        .repartitionByRange(n, F.asc_nulls_first("doc_id"), "th") \
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "th").select("doc_id", "text")

    def write(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        encoder = word_encoder(tokenizer, end_id)
        fs, folder = open_fs(path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.ids.zst"
        writer = out = None
        docs_n = tokens = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for a, b in row_slices(sizes, BATCH_BYTES):
                part = batch.slice(a, b - a)
                if writer is None:
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    writer = ShardWriter(out, encoder.dtype)
                ids, offsets = encoder.encode(part.column(1))
                for j, doc_id in enumerate(part.column(0).to_pylist()):
                    writer.add(doc_id, ids[offsets[j]: offsets[j + 1]])
                docs_n += len(part)
                tokens += len(ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "docs": [docs_n], "tokens": [tokens]})

    return stored(rows.mapInArrow(write, "shard long, file string, docs long, tokens long"), "shards")


def read_token_shards(spark: SparkSession, path: str, manifest: DataFrame,
                      wanted: Sequence[int] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of the shards: ``doc_id, start, n_tokens, ids_crc32, shard``
    (and ``ids``, an array, on request). ``start`` counts the ids of all
    documents before it in all shards. With ``wanted`` ids, only frames that
    hold one are read and decompressed; every frame read is checked."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))
    # one row per file: the window above sorts the manifest only; one file a task from here
    files = files.repartition(pieces(manifest.count(), 1), "shard").select("shard", "file", "base")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long" \
        + (", ids array<int>" if with_ids else "")

    def read(batches):
        fs, folder = open_fs(path)
        for batch in batches:
            for row in batch.to_pylist():
                where = f"{folder}/{row['file']}"
                with fs.open_input_file(where) as file:
                    shard = Shard.open(file, file.size())
                    starts = row["base"] + np.cumsum(shard.counts) - shard.counts
                    out: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", "shard")}
                    if with_ids:
                        out["ids"] = []
                    for j, doc_id, ids in shard.documents(wanted):
                        out["doc_id"].append(doc_id)
                        out["start"].append(int(starts[j]))
                        out["n_tokens"].append(len(ids))
                        out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        out["shard"].append(row["shard"])
                        if with_ids:
                            out["ids"].append(ids.astype(np.int32))
                    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return files.mapInArrow(read, schema)


def token_output(docs: DataFrame, tokenizer: str, end_id: int | None, path: str | None = None) -> DataFrame:
    """Write shards and read them back: the digest of what the files hold."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    return read_token_shards(spark, path, write_token_shards(docs, path, tokenizer, end_id))
