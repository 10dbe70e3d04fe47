"""Token ids in binary files: bit-plane shuffling, zstandard per plane, a chunk index.

A file holds the documents of one range of ids in ascending order. Its ids are cut into blocks of a
fixed size; a block is transposed into bit planes (all lowest bits, all second bits, ...), and each plane
is compressed on its own, so that the seldom used high bits cost next to nothing. Layout, little-endian:

    8 bytes   magic
    blocks    per plane one zstandard frame, back to back
    index     zstandard frame: one row of INDEX per block, then one row of ENTRY per document
    footer    FOOTER: where the index begins, its size, blocks, documents, ids, CRC-32 of the index

A block is read with one range request, and the index names the blocks of a document.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import id_and_text, slices, split_words
from tallymart.session import materialise, new_path

# Fixed values of the file format.
MAGIC = b"TMPLANE1"
FOOTER = struct.Struct("<QQQQQI")
MOST_PLANES = 32
INDEX = np.dtype([("at", "<u8"), ("ids", "<u4"), ("sizes", "<u4", MOST_PLANES)])
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_tokens", "<u8")])

END_ID = 1
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``pool[s : s + n]`` of all starts and lengths, back to back."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return pool[:0]
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


class WordTokenizer:
    """The ``tokenizers`` library, asked once per distinct word.

    For a tokenizer that drops white space and never joins what white space separates, a text's ids are
    its words' ids back to back. Closing punctuation after an ASCII letter or digit is a token run of its
    own, and ASCII words are lower-cased by the tokenizer anyway; both make for fewer distinct words.
    """

    MOST_WORDS = 800_000  # memory of the memo; it starts anew beyond that
    CLOSING = ".,;:!?"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for words that its normalizer and its split leave alone, the same without those two steps
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.plain = None
        if normal.normalize_str(LETTERS) == LETTERS and [w for w, _ in split.pre_tokenize_str(LETTERS)] == [LETTERS]:
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.mark = (self.tokenizer.encode("!", add_special_tokens=False).ids or [-1])[0]
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.pool, self.starts, self.lengths = array("I"), array("Q"), array("I")

    def _ask(self, words: list[str], plain: bool) -> tuple[list[int], np.ndarray]:
        """Ids of ``words`` back to back, and how many each has."""
        if plain or not any("!" in w for w in words):
            # one text with a lone mark between the words is twice as fast as a list of words
            tokenizer = self.plain if plain else self.tokenizer
            ids = tokenizer.encode_batch_fast([" ! ".join(words)], add_special_tokens=False)[0].ids
            marks = np.array(ids) == self.mark
            if marks.sum() == len(words) - 1:
                owner = np.cumsum(marks)[~marks]
                return [i for i in ids if i != self.mark], np.bincount(owner, minlength=len(words))
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return found.ids, np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))

    def _ids(self, words: list[str]) -> np.ndarray:
        """Places of ``words`` in the pool."""
        if len(self.known) > self.MOST_WORDS:
            self._forget()
        known = self.known
        new = [w for w in words if w not in known]
        plain = [w for w in new if self.plain and w.isascii() and w.isalpha() and w.islower()]
        other = [w for w in new if not (self.plain and w.isascii() and w.isalpha() and w.islower())]
        for part, is_plain in [(some[at : at + 1000], some is plain) for some in (plain, other) for at in range(0, len(some), 1000)]:
            ids, lengths = self._ask(part, is_plain)
            begin = len(self.pool)
            self.pool.extend(ids)
            self.starts.extend((begin + np.cumsum(lengths) - lengths).tolist())
            self.lengths.extend(lengths.tolist())
            known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))
        return np.fromiter((known[w] for w in words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` and how many each text has."""
        words, first = split_words(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        core = pc.ascii_rtrim(distinct, characters=self.CLOSING)
        core = pc.if_else(pc.match_substring_regex(core, "[A-Za-z0-9]$"), core, distinct)
        tail_at = pc.binary_length(core).to_numpy(zero_copy_only=False)
        char_at = pc.utf8_length(core).to_numpy(zero_copy_only=False)
        whole = pc.binary_length(distinct).to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(core, "^[A-Za-z0-9]+$")
        core = pc.if_else(plain, pc.ascii_lower(core), core).dictionary_encode()
        closed = np.flatnonzero(whole > tail_at)
        tails = [w[n:] for w, n in zip(distinct.take(pa.array(closed)).to_pylist(), char_at[closed].tolist(), strict=True)]
        words = core.dictionary.to_pylist()
        keys = list(dict.fromkeys(words + tails))
        at = self._ids(keys)
        cores = at[: len(words)][core.indices.to_numpy(zero_copy_only=False)]
        place = dict(zip(keys[len(words) :], at[len(words) :].tolist(), strict=True))
        starts, lengths = np.array(self.starts, np.int64), np.array(self.lengths, np.int64)
        # of each distinct word: the ids of its core, then those of its closing punctuation
        parts = np.zeros((len(distinct), 2), np.int64)
        sizes = np.zeros((len(distinct), 2), np.int64)
        parts[:, 0], sizes[:, 0] = starts[cores], lengths[cores]
        if tails:
            ends = np.fromiter((place[t] if t in place else self.known[t] for t in tails), np.int64)
            parts[closed, 1], sizes[closed, 1] = starts[ends], lengths[ends]
        pool = _gather(np.array(self.pool, np.uint32), parts.ravel(), sizes.ravel())
        n = sizes.sum(1)
        at, codes = np.cumsum(n) - n, coded.indices.to_numpy(zero_copy_only=False)
        ids = _gather(pool, at[codes], n[codes])
        upto = np.r_[0, np.cumsum(n[codes])]
        return ids, np.diff(upto[first])


@functools.lru_cache(2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _planes(ids: np.ndarray, level: int) -> list[bytes]:
    """The bit planes of a block, lowest bit first, each compressed; none above the highest bit in use."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    top = int(ids.max()).bit_length() if len(ids) else 0
    return [squeeze(np.packbits((ids >> np.uint32(b)) & np.uint32(1), bitorder="little").tobytes()) for b in range(top)]


def _unplanes(frames: list[bytes], n: int) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    open_ = zstandard.ZstdDecompressor().decompress
    for b, frame in enumerate(frames):
        bits = np.unpackbits(np.frombuffer(open_(frame), np.uint8), count=n, bitorder="little")
        ids |= bits.astype(np.uint32) << np.uint32(b)
    return ids


class PlaneWriter:
    """Writes one file; memory is one block, the index and 17 bytes per document."""

    def __init__(self, out, block: int, level: int):
        self.out, self.block, self.level = out, block, level
        self.index: list[tuple] = []
        self.entries: list[np.ndarray] = []
        self.rest: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.at = out.write(MAGIC)

    def add(self, entries: np.ndarray, ids: np.ndarray) -> None:
        self.entries.append(entries)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            ids = np.concatenate(self.rest)
            whole = len(ids) // self.block * self.block
            for at in range(0, whole, self.block):
                self._flush(ids[at : at + self.block])
            self.rest, self.waiting = [ids[whole:].copy()], len(ids) - whole

    def _flush(self, ids: np.ndarray) -> None:
        frames = _planes(ids, self.level)
        sizes = [len(f) for f in frames]
        self.index.append((self.at, len(ids), sizes + [0] * (MOST_PLANES - len(sizes))))
        self.out.write(b"".join(frames))
        self.at += sum(sizes)
        self.n_ids += len(ids)

    def close(self) -> tuple[int, int]:
        """Documents and ids written."""
        if self.waiting:
            self._flush(np.concatenate(self.rest))
        entries = np.concatenate(self.entries) if self.entries else np.zeros(0, ENTRY)
        body = zstandard.ZstdCompressor().compress(np.array(self.index, INDEX).tobytes() + entries.tobytes())
        self.out.write(body)
        self.out.write(FOOTER.pack(self.at, len(body), len(self.index), len(entries), self.n_ids, zlib.crc32(body)))
        self.out.close()
        return len(entries), self.n_ids


class PlaneReader:
    """Reads one file: its documents from the index, its ids block by block."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(0)
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token id planes")
        source.seek(size - FOOTER.size)
        at, length, blocks, docs, self.n_ids, crc = FOOTER.unpack(source.read(FOOTER.size))
        source.seek(at)
        body = source.read(length)
        if zlib.crc32(body) != crc:
            raise ValueError("the index is damaged")
        body = zstandard.ZstdDecompressor().decompress(body)
        self.index = np.frombuffer(body, INDEX, blocks)
        self.entries = np.frombuffer(body, ENTRY, docs, blocks * INDEX.itemsize)

    def block(self, k: int) -> np.ndarray:
        row = self.index[k]
        sizes = row["sizes"][row["sizes"] > 0]
        self.source.seek(int(row["at"]))
        data = self.source.read(int(sizes.sum()))
        ends = np.cumsum(sizes)
        return _unplanes([data[e - n : e] for e, n in zip(ends, sizes, strict=True)], int(row["ids"]))

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """doc_id, number of ids and their CRC-32 as little-endian 32-bit integers, in file order."""
        block, at, k = np.zeros(0, "<u4"), 0, 0
        for entry in self.entries:
            missing, crc = int(entry["n_tokens"]), 0
            while missing:
                if at == len(block):
                    block, at, k = self.block(k).astype("<u4", copy=False), 0, k + 1
                step = min(missing, len(block) - at)
                crc = zlib.crc32(block[at : at + step].tobytes(), crc)
                at, missing = at + step, missing - step
            yield int(entry["doc_id"]) if entry["has_id"] else None, int(entry["n_tokens"]), crc


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


WRITTEN = "path string, first_id long, n_docs long, n_ids long"


def write_planes(docs: DataFrame, path: str, tokenizer_path: str, block: int = 1 << 16, level: int = 3, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write their ids, ``end_id`` after each document, below ``path``.

    One file per range of ids; files and rows in them follow doc_id (null first, repeated ids by text).
    Returns the stored list of files: path, first_id, n_docs, n_ids and start, the ids in the files before.
    A lost task's file has a name of its own and is not in that list.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for part in slices(batches, "text", 16 << 20):
            if out is None:
                system, folder = _filesystem(path)
                system.create_dir(folder, recursive=True)
                name = f"{folder}/ids-{uuid.uuid4().hex}.tmplane"
                out = PlaneWriter(system.open_output_stream(name), block, level)
                first = part.column("doc_id")[0].as_py()
            ids, counts = _tokenizer(tokenizer_path).encode(part.column("text"))
            ends = np.cumsum(counts)
            known = pc.is_valid(part.column("doc_id")).to_numpy(zero_copy_only=False)
            entries = np.zeros(part.num_rows, ENTRY)
            entries["doc_id"] = pc.fill_null(part.column("doc_id"), 0).to_numpy(zero_copy_only=False)
            entries["has_id"], entries["n_tokens"] = known, counts + 1
            out.add(entries, np.insert(ids, ends, end_id).astype(np.uint32))
        if out is not None:
            n_docs, n_ids = out.close()
            where = f"{path.rstrip('/')}/{name.rsplit('/', 1)[-1]}"
            yield pa.RecordBatch.from_pydict({"path": [where], "first_id": [first], "n_docs": [n_docs], "n_ids": [n_ids]}, pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ranged = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = materialise(ranged.mapInArrow(write, WRITTEN), "plane-files")
    # a window over one row per file
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_planes(files: DataFrame) -> DataFrame:
    """Per document of the listed files: doc_id, start, n_tokens, ids_crc32. One task per file reads block by block."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _filesystem(row["path"])
                with system.open_input_file(name) as source:
                    rows, start = [], row["start"]
                    for doc_id, n, crc in PlaneReader(source).documents():
                        rows.append((doc_id, start, n, crc))
                        start += n
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    n = max(1, files.count())
    return files.select("path", "start").repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def planes_of(spark: SparkSession, docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` to files below ``path`` (a new folder in the shared folder by default) and read them back.

    A null text is an empty one and has the end id only; an empty table gives no rows and no files.
    """
    return read_planes(write_planes(docs, path or new_path(spark, "planes"), tokenizer_path))
