"""Which features of a document occur in other documents too, and in how many.

Features are 64-bit hashes. A run of documents deals out its features by their leading bits, one packed block
per bucket: sorted 48-bit fingerprints as differences in byte planes, with the document of each, about five
bytes a feature. A bucket counts the documents of each fingerprint exactly, and tells every document which of
its features it shares. The number of buckets follows the number of features, so a bucket has one size at any
scale, and a feature that all documents have comes once per document and is one count.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tallymart.llm.shared import mix64, slices

FINGERPRINT_BITS = 48
PER_BUCKET = 1_000_000
RUN_BYTES = 16 << 20

_FRAME = struct.Struct("<QQQ")


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    # mixed, as chosen hashes (the least of a window, say) crowd and buckets go by leading bits
    return mix64(hashes) >> np.uint64(64 - FINGERPRINT_BITS)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of 64-bit integers, byte by byte."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = data.reshape(width, n).T
    return out.view("<u8").ravel()


def _pack(prints: np.ndarray, owner: np.ndarray, ids: np.ndarray) -> bytes:
    """Sorted fingerprints, the place of each one's document in ``ids``, and ``ids``."""
    width = max(1, (int(owner.max()).bit_length() + 7) // 8)
    body = _planes(np.diff(prints, prepend=np.uint64(0)), 6) + _planes(owner.astype(np.uint64), width) + ids.astype("<i8").tobytes()
    return _FRAME.pack(len(prints), width, len(ids)) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, m = _FRAME.unpack_from(block)
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(block[_FRAME.size :]), np.uint8)
    prints = np.cumsum(_unplanes(body[: 6 * n], n, 6))
    owner = _unplanes(body[6 * n : (6 + width) * n], n, width)
    ids = body[(6 + width) * n :].view("<i8")
    return prints, ids[owner.astype(np.int64)]


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.append(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)) if len(keys) else np.zeros(1, np.int64)


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``values`` (64-bit) cut at ``bounds`` as an array of binary values."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def shared_features(docs: DataFrame, emit: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], expected: int) -> DataFrame:
    """Per document (doc_id, unique and not null) the features it shares: doc_id, tokens (a binary value).

    ``emit`` gives the hashes of a batch of ``docs`` (doc_id, text, ...) and the row of each; ``expected`` is
    about how many there are. A binary value holds little-endian 64-bit tokens: above the 48-bit fingerprint a
    byte that grows with the number of documents that have it, so that tokens sort from rare to frequent.
    """
    bits = max(0, math.ceil(math.log2(max(1, expected) / PER_BUCKET)))
    shift = np.uint64(FINGERPRINT_BITS - bits)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in slices(batches, "text", RUN_BYTES):
            hashes, owner = emit(run)
            if not len(hashes):
                continue
            prints, ids = fingerprint(hashes), run.column("doc_id").to_numpy()
            order = np.argsort(prints)
            prints, owner = prints[order], owner[order]
            bounds = _runs(prints >> shift)
            blocks = [_pack(prints[a:b], owner[a:b], ids) for a, b in zip(bounds, bounds[1:], strict=False)]
            for at in range(0, len(blocks), 64):
                own = [int(prints[a] >> shift) for a in bounds[:-1][at : at + 64]]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(own, pa.int64()), "block": pa.array(blocks[at : at + 64], pa.binary())})

    def count(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(b) for b in blocks]
        prints, ids = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.lexsort((ids, prints))
        prints, ids = prints[order], ids[order]
        once = np.r_[True, (prints[1:] != prints[:-1]) | (ids[1:] != ids[:-1])]
        prints, ids = prints[once], ids[once]
        bounds = _runs(prints)
        held = np.repeat(np.diff(bounds), np.diff(bounds))
        keep = held > 1
        prints, ids, held = prints[keep], ids[keep], held[keep]
        grade = np.minimum(255, np.floor(8 * np.log2(held))).astype(np.uint64) if len(held) else held.astype(np.uint64)
        tokens = prints | grade << np.uint64(FINGERPRINT_BITS)
        # documents are dealt out again, many to a row
        part = mix64(ids.astype(np.uint64)) % np.uint64(1 << bits)
        order = np.argsort(part, kind="stable")
        part, ids, tokens = part[order], ids[order], tokens[order]
        bounds = _runs(part)
        if len(part):
            own = pa.array(part[bounds[:-1]].astype(np.int64))
            yield pa.RecordBatch.from_arrays([own, binaries(ids, bounds), binaries(tokens, bounds)], ["part", "ids", "tokens"])

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks = None, []
        for batch in batches:  # sorted by bucket
            for own, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), strict=True):
                if own != bucket and blocks:
                    yield from count(blocks)
                    blocks = []
                bucket = own
                blocks.append(block)
        if blocks:
            yield from count(blocks)

    def gather(rows: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        ids = np.frombuffer(b"".join(r[0] for r in rows), "<i8")
        order = np.argsort(ids, kind="stable")
        ids, tokens = ids[order], np.frombuffer(b"".join(r[1] for r in rows), "<u8")[order]
        bounds = _runs(ids)
        for at in range(0, len(bounds) - 1, 5_000):
            some = bounds[at : at + 5_001]
            yield pa.RecordBatch.from_arrays([pa.array(ids[some[:-1]]), binaries(tokens[some[0] : some[-1]], some - some[0])], ["doc_id", "tokens"])

    def by_document(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:  # sorted by part
            for own, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "ids", "tokens")), strict=True):
                if own != part and rows:
                    yield from gather(rows)
                    rows = []
                part = own
                rows.append(tuple(row))
        if rows:
            yield from gather(rows)

    dealt = docs.mapInArrow(deal, "bucket long, block binary")
    told = dealt.repartition(1 << bits, "bucket").sortWithinPartitions("bucket").mapInArrow(tell, "part long, ids binary, tokens binary")
    return told.repartition(1 << bits, "part").sortWithinPartitions("part").mapInArrow(by_document, "doc_id long, tokens binary")


def joined(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of an array of binary values, back to back, and where each row's begin."""
    rows = tokens.to_pylist()
    return np.frombuffer(b"".join(rows), "<u8"), np.r_[0, np.cumsum([len(x) // 8 for x in rows], dtype=np.int64)]
