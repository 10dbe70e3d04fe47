"""SentencePiece encoding and decoding as a max-plus scan over chunks.

An encoding is the best path through the lattice of all pieces that match the text. For a unigram model a
piece weighs its score. For a BPE model every weight is zero, but a piece may follow another only if merging
the two alone leaves them as they are (else minus infinity); then exactly one path is left, and it is the one
that the merges produce. Either way the encoding is a product of max-plus matrices.

A text is cut into chunks. The state at a cut is the last piece that begins before it and how far it reaches
beyond; a chunk's transfer matrix gives the best weight from every state at its left cut to every state at
its right cut. Matrices are combined associatively, in blocks and then over blocks, which tells every cut's state;
each chunk is then traced back on its own. Where no piece of the vocabulary can span a cut, as between words,
there is one state, the matrix is a number, and the chunk's pieces depend on its text only, so that frequent
words are looked up.
"""

from __future__ import annotations

import codecs
import functools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import id_and_text, slices
from tallymart.session import materialise, tune

# Fixed values of SentencePiece models: the escaped space, and the number of the BPE model type.
SPACE = "▁"
BPE = 2

CHUNK_CHARS = 1 << 16
RUN_BYTES = 2 << 20  # texts encoded at a time
BLOCK_CHUNKS = 64

State = tuple[int, int]  # how far the last piece reaches beyond the cut, and that piece (-1: does not matter)
OPEN: State = (0, -1)
Matrix = dict[State, dict[State, float]]


codecs.register_error("replace each byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = (varint(at)) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


def _option(model: bytes, spec: int, number: int, default: int) -> int:
    """An integer of the model's trainer (2) or normalizer (3) specification."""
    inner = next((v for n, v in _fields(model) if n == spec), b"")
    return next((v for n, v in _fields(inner) if n == number), default)


def combine(left: Matrix, right: Matrix) -> Matrix:
    """Max-plus product."""
    out: Matrix = {}
    for s, row in left.items():
        best: dict[State, float] = {}
        for t, w in row.items():
            for u, v in right.get(t, {}).items():
                if w + v > best.get(u, float("-inf")):
                    best[u] = w + v
        if best:
            out[s] = best
    return out


class Pieces:
    """A SentencePiece model: its vocabulary, the lattice of a text, and best paths through it."""

    # bounds of the two memos of one worker; each keeps what was used last, and the generation before that
    WORD_BYTES = 24 << 20
    MOST_PAIRS = 150_000  # 130 bytes each

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            self._read(file.read())

    @classmethod
    def of(cls, model: bytes) -> Pieces:
        import sentencepiece

        made = cls.__new__(cls)
        made.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        made._read(model)
        return made

    def _read(self, model: bytes) -> None:
        sp = self.library
        self.bpe = _option(model, 2, 3, 1) == BPE
        self.prefix = bool(_option(model, 3, 3, 1))
        n = sp.get_piece_size()
        self.ids, self.scores, self.bytes = {}, [0.0] * n, [-1] * 256
        self.shown: list[bytes] = [b""] * n  # what a piece adds to decoded text
        for k in range(n):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                value = int(piece[3:5], 16)
                self.bytes[value], self.shown[k] = k, bytes([value])
            elif sp.is_unknown(k):
                self.shown[k] = " ⁇ ".encode()
            elif not sp.is_control(k):
                if not sp.is_unused(k):
                    self.ids[piece] = k
                self.scores[k], self.shown[k] = sp.get_score(k), piece.replace(SPACE, " ").encode()
        self.unknown = sp.unk_id()
        self.strings = {k: p for p, k in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.lowest = min((self.scores[k] for k in self.ids.values()), default=0.0) - 10  # the library's penalty of an unknown character
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # the same as a table over the characters that pieces join; 0 is any other
        chars = sorted({c for pair in self.joined for c in pair})
        self.char = np.zeros(0x110000, np.int16 if len(chars) < 32_000 else np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.spans = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in self.joined:
            self.spans[self.char[ord(a)], self.char[ord(b)]] = True
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.word_bytes = 0
        self.pairs: dict[int, bool] = {}  # by first * n + second
        self.older_pairs: dict[int, bool] = {}
        self.n = n
        # beginnings of pieces: the piece that a path may use, or -2
        self.heads = {p[:n]: -2 for p in self.ids for n in range(1, len(p))}
        self.heads |= {p: k for p, k in self.ids.items() if not self.bpe or len(p) == 1 or self._whole(k)}
        sizes = np.array([len(b) for b in self.shown], np.int64)
        self.pool, self.pool_size = np.frombuffer(b"".join(self.shown), np.uint8), sizes
        self.pool_start = np.cumsum(sizes) - sizes

    def merged(self, text: str) -> list[str]:
        """BPE by its merges: the best pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = float("-inf"), -1
            for k in range(len(parts) - 1):
                piece = self.ids.get(parts[k] + parts[k + 1])
                if piece is not None and self.scores[piece] > best:
                    best, at = self.scores[piece], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, first: int, second: int) -> bool:
        """Whether a BPE encoding can have ``second`` right after ``first``; -1 stands for any other text."""
        if not self.bpe or first < 0 or second < 0:
            return True
        key = first * self.n + second
        known = self.pairs.get(key)
        if known is None:
            known = self.older_pairs.get(key)
            if known is None:
                a, b = self.strings[first], self.strings[second]
                known = self.merged(a + b) == [a, b]
            if len(self.pairs) >= self.MOST_PAIRS:
                self.older_pairs, self.pairs = self.pairs, {}
            self.pairs[key] = known
        return known

    def _steps(self, text: str, at: int, end: int) -> Iterator[tuple[int, int, float]]:
        """Pieces that begin at ``at``: where they end, id (-1: one character without a piece), weight."""
        ids, bpe = self.ids, self.bpe
        single = False
        for stop in range(at + 1, min(end, at + self.longest) + 1):
            piece = ids.get(text[at:stop])
            if piece is not None:
                single = single or stop == at + 1
                # of a BPE vocabulary, only what its own merges produce
                if not bpe or stop == at + 1 or self._whole(piece):
                    yield stop, piece, 0.0 if bpe else self.scores[piece]
        if not single:
            yield at + 1, -1, 0.0 if bpe else self.lowest

    @functools.cache  # noqa: B019  (as many entries as the vocabulary)
    def _whole(self, piece: int) -> bool:
        return self.merged(self.strings[piece]) == [self.strings[piece]]

    def states(self, text: str, cut: int) -> list[State]:
        """All states at a cut: pieces that begin before it and reach it or beyond."""
        if cut == 0 or text[cut - 1 : cut + 1] not in self.joined and cut < len(text):
            return [OPEN]
        found = {
            (stop - cut, piece if self.bpe else -1)
            for at in range(max(0, cut - self.longest), cut)
            for stop, piece, _ in self._steps(text, at, len(text))
            if stop >= cut
        }
        return sorted(found)

    def paths(self, text: str, start: int, end: int, entries: list[State], sources: bool) -> dict:
        """Best weights from every entry state at ``start`` to where pieces that begin before ``end`` first reach it.

        Per exit state a dict of weights by entry; with ``sources`` (one entry) each node's way back as well.
        """
        reached: dict[int, dict[int, dict[State, float]]] = {}
        back: dict[tuple[int, int], tuple[int, int, int] | None] = {}
        for entry in entries:
            reached.setdefault(start + entry[0], {}).setdefault(entry[1], {})[entry] = 0.0
            back[start + entry[0], entry[1]] = None
        exits: dict[State, dict[State, float]] = {}
        for at in range(start, end):
            here = reached.pop(at, None)
            if not here:
                continue
            for stop, piece, weight in self._steps(text, at, len(text)):
                key = piece if self.bpe else -1
                for last, weights in here.items():
                    if not self.follows(last, piece):
                        continue
                    there = reached.setdefault(stop, {}).setdefault(key, {})
                    for entry, w in weights.items():
                        if w + weight > there.get(entry, float("-inf")):
                            there[entry] = w + weight
                            if sources:
                                back[stop, key] = (at, last, piece)
        for at, here in reached.items():
            # beyond a cut that nothing spans, the last piece does not matter
            safe = at == end and (end == len(text) or text[end - 1 : end + 1] not in self.joined)
            for last, weights in here.items():
                row = exits.setdefault(OPEN if safe else (at - end, last), {})
                for entry, w in weights.items():
                    row[entry] = max(w, row.get(entry, float("-inf")))
        return {"exits": exits, "back": back}

    def best(self, text: str, start: int, end: int, entry: State, leave: State | None = None) -> list[int]:
        """The pieces of the best path from ``entry`` at ``start`` to ``leave`` at ``end`` (None: an open end)."""
        if start == end:
            return []
        found = self.paths(text, start, end, [entry], True)
        leave = OPEN if leave is None else leave
        back = found["back"]
        if leave == OPEN:  # the last piece is whichever got there; of a BPE model there is only one
            at, ends = end, [n for n in back if n[0] == end]
            node = (at, self._best_end(text, start, end, entry, ends))
        else:
            node = (end + leave[0], leave[1])
        ids: list[int] = []
        while back[node] is not None:
            at, last, piece = back[node]
            ids += [piece] if piece >= 0 else self._fallback(text[at])
            node = (at, last)
        return ids[::-1]

    def _best_end(self, text: str, start: int, end: int, entry: State, ends: list[tuple[int, int]]) -> int:
        if len(ends) != 1:
            raise AssertionError(f"{len(ends)} ways to encode {text[start:end][:80]!r}")
        return ends[0][1]

    def _fallback(self, char: str) -> list[int]:
        """The byte pieces of a character without a piece, last first; the unknown piece if there are none."""
        ids = [self.bytes[b] for b in char.encode()]
        return [self.unknown] if min(ids) < 0 else ids[::-1]

    def word(self, text: str) -> tuple[int, ...]:
        """The pieces of a text between two cuts that no piece spans."""
        known = self.words.get(text)
        if known is None:
            known = self.older_words.get(text) or tuple(self._short(text))
            if len(text) <= 64:
                self.word_bytes += 220 + 2 * len(text) + 8 * len(known)
                if self.word_bytes > self.WORD_BYTES:
                    self.older_words, self.words, self.word_bytes = self.words, {}, 0
                self.words[text] = known
        return known

    def _short(self, text: str) -> list[int]:
        """Best path through a short text; in BPE a prefix has one path at most, so its last piece is all there is to keep."""
        if not self.bpe:
            return self.best(text, 0, len(text), OPEN)
        n, heads, pieces, longest = len(text), self.heads, self.n, self.longest
        last, size = [-1] * (n + 1), [0] * (n + 1)
        size[0] = 1
        for at in range(n):
            if not size[at]:
                continue
            before, single, pairs = last[at] if at else -1, False, self.pairs
            for stop in range(at + 1, min(n, at + longest) + 1):
                piece = heads.get(text[at:stop])
                if piece is None:
                    break
                if piece >= 0:
                    single = single or stop == at + 1
                    good = before < 0 or pairs.get(before * pieces + piece)
                    if good or good is None and self.follows(before, piece):
                        last[stop], size[stop] = piece, stop - at
            if not single:
                last[at + 1], size[at + 1] = -1, 1
        out: list[int] = []
        while n:
            out += [last[n]] if last[n] >= 0 else self._fallback(text[n - 1])
            n -= size[n]
        return out[::-1]

    def parts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All texts cut wherever no piece spans the cut, and where each text's parts begin."""
        data = "".join(texts)
        code = np.frombuffer(data.encode("utf-32-le"), np.uint32)
        upto = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
        cut = np.ones(len(code) + 1, bool)
        if len(code):
            char = self.char[code]
            cut[1:-1] = ~self.spans[char[:-1], char[1:]]
            cut[upto] = True
        places = np.flatnonzero(cut) if len(code) else np.zeros(1, np.int64)
        width = np.ones(len(code) + 1, np.uint8)
        width[0] = 0
        for more in (0x7F, 0x7FF, 0xFFFF):
            width[1:] += code > more
        offsets = pa.py_buffer(np.cumsum(width, dtype=np.int64)[places])
        parts = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, offsets, pa.py_buffer(data.encode())])
        return parts, np.searchsorted(places, upto)

    def escaped(self, text: str) -> str:
        return self.library.normalize(text) if text else ""

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (none null) and where each text's begin."""
        flat, first = self.parts([self.escaped(t) for t in texts.to_pylist()])
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        coded = flat.dictionary_encode()
        ids = [self.word(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter((i for some in ids for i in some), np.int32, int(sizes.sum()))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[codes]
        return ranges(pool, (np.cumsum(sizes) - sizes)[codes], n), np.r_[0, np.cumsum(n)][first]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """The texts of lists of ids laid end to end; every byte that is no UTF-8 becomes a replacement character."""
        sizes = self.pool_size[ids]
        data = ranges(self.pool, self.pool_start[ids], sizes)
        ends = np.r_[0, np.cumsum(sizes)][first]
        cut = ends[:-1].copy()
        if self.prefix:  # the space that encoding puts first
            some = np.flatnonzero(ends[1:] > ends[:-1])
            cut[some] += (data[ends[:-1][some]] == 0x20) & (ids[first[:-1][some]] != self.bytes[0x20])
        raw = data.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace each byte") for a, b in zip(cut.tolist(), ends[1:].tolist(), strict=True)], pa.string())

    # chunks of a giant text

    def transfer(self, left: str, body: str, right: str) -> Matrix:
        """The transfer matrix of ``body`` between the texts around it (as long as the longest piece, or to the end)."""
        text, start, end = left + body + right, len(left), len(left) + len(body)
        entries = self.states(text, start)
        cuts = self._inner_cuts(text, start, end)
        if not cuts:
            return _turned(self.paths(text, start, end, entries, False)["exits"])
        first, last = cuts[0], cuts[-1]
        out = _turned(self.paths(text, start, first, entries, False)["exits"])
        if not self.bpe:
            middle = sum(self._weight(text, a, b) for a, b in zip(cuts, cuts[1:], strict=False))
            out = {s: {t: w + middle for t, w in row.items()} for s, row in out.items()}
        return combine(out, _turned(self.paths(text, last, end, [OPEN], False)["exits"]))

    def _weight(self, text: str, start: int, end: int) -> float:
        return self.paths(text, start, end, [OPEN], False)["exits"][OPEN][OPEN]

    def _inner_cuts(self, text: str, start: int, end: int) -> list[int]:
        """The cuts inside a chunk that no piece spans, away from its start."""
        parts, _ = self.parts([text[start:end]])
        at = start + np.r_[0, np.cumsum(pc.utf8_length(parts).to_numpy(zero_copy_only=False))]
        return [int(k) for k in at if start + self.longest < k < end]

    def trace(self, left: str, body: str, right: str, entry: State, leave: State) -> list[int]:
        """The pieces that begin in ``body``, from its state to the next chunk's."""
        text, start, end = left + body + right, len(left), len(left) + len(body)
        if entry[0] >= len(body):
            return []  # a piece from before spans the chunk
        cuts = self._inner_cuts(text, start, end)
        if not cuts:
            return self.best(text, start, end, entry, leave)
        ids = self.best(text, start, cuts[0], entry)
        for a, b in zip(cuts, cuts[1:], strict=False):
            ids += self.word(text[a:b])
        return ids + self.best(text, cuts[-1], end, OPEN, leave)


def _turned(exits: dict[State, dict[State, float]]) -> Matrix:
    out: Matrix = {}
    for leave, row in exits.items():
        for entry, w in row.items():
            out.setdefault(entry, {})[leave] = w
    return out


def ranges(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``pool[s : s + n]`` of all starts and lengths, back to back."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return pool[:0]
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


@functools.lru_cache(2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _to_json(matrix: Matrix) -> str:
    return json.dumps([[s, [[t, w] for t, w in row.items()]] for s, row in matrix.items()])


def _from_json(text: str) -> Matrix:
    return {tuple(s): {tuple(t): w for t, w in row} for s, row in json.loads(text)}


def _onward(states: dict[State, float], matrix: Matrix) -> dict[State, float]:
    return combine({OPEN: states}, matrix).get(OPEN, {})


def _way(start: State, leave: State, matrices: list[Matrix]) -> list[State]:
    """The states before each of a row of matrices on the best way from ``start`` to ``leave``."""
    before = [{start: 0.0}]
    for m in matrices:
        before.append(_onward(before[-1], m))
    way, at = [], leave
    for states, m in zip(before[-2::-1], matrices[::-1], strict=True):
        at = max((s for s in states if at in m.get(s, {})), key=lambda s: (states[s] + m[s][at], s))
        way.append(at)
    return way[::-1]


ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"


def _encoded(doc_id: pa.Array, ids: np.ndarray, first: np.ndarray, decoded: pa.Array) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_arrays([doc_id, pa.array(np.diff(first)), lists, decoded], ["doc_id", "n_tokens", "ids", "decoded"])


def encode_chunks(texts: DataFrame, model_path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Per row of ``texts`` (key, text; keys are unique, texts not empty): key and ids, chunk by chunk across tasks."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "text")), strict=True):
                text, side = model.escaped(text), model.longest
                starts = range(0, len(text), chunk_chars)
                for k, a in enumerate(starts):
                    b = min(len(text), a + chunk_chars)
                    parts = (key, k, k // BLOCK_CHUNKS, text[max(0, a - side) : a], text[a:b], text[b : b + side])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in zip(parts, (pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3), strict=True)],
                        ["key", "k", "block", "left", "body", "right"],
                    )

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            found = [_to_json(model.transfer(*x)) for x in zip(*(batch.column(c).to_pylist() for c in ("left", "body", "right")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "k", "block")), pa.array(found, pa.string())], ["key", "k", "block", "matrix"])

    def product(group):
        whole = functools.reduce(combine, map(_from_json, group.sort_values("k")["matrix"]))
        return group.head(1)[["key", "block"]].assign(matrix=_to_json(whole))

    def over_blocks(group):
        group = group.sort_values("block")
        way = _way(OPEN, OPEN, [_from_json(m) for m in group["matrix"]])
        return group[["key", "block"]].assign(entry=[json.dumps(s) for s in way], leave=[json.dumps(s) for s in [*way[1:], OPEN]])

    def in_block(group):
        group = group.sort_values("k")
        entry, leave = (tuple(json.loads(group[c].iloc[0])) for c in ("entry", "leave"))
        way = _way(entry, leave, [_from_json(m) for m in group["matrix"]])
        return group[["key", "k"]].assign(entry=[json.dumps(s) for s in way], leave=[json.dumps(s) for s in [*way[1:], leave]])

    def trace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("left", "body", "right", "entry", "leave"))
            ids = [model.trace(a, b, c, tuple(json.loads(s)), tuple(json.loads(t))) for a, b, c, s, t in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), pa.array(ids, pa.list_(pa.int32()))], ["key", "k", "ids"])

    chunks = materialise(texts.mapInArrow(cut, "key string, k long, block long, left string, body string, right string").repartition("key", "k"), "piece-chunks")
    matrices = materialise(chunks.mapInArrow(measure, "key string, k long, block long, matrix string"), "piece-matrices")
    blocks = matrices.groupBy("key", "block").applyInPandas(product, "key string, block long, matrix string")
    cuts = blocks.groupBy("key").applyInPandas(over_blocks, "key string, block long, entry string, leave string")
    ways = matrices.join(cuts, ["key", "block"]).groupBy("key", "block").applyInPandas(in_block, "key string, k long, entry string, leave string")
    traced = chunks.join(ways, ["key", "k"]).select("key", "k", "left", "body", "right", "entry", "leave").mapInArrow(trace, "key string, k long, ids array<int>")
    return traced.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))


def encode_documents(docs: DataFrame, model_path: str, chunk_chars: int = CHUNK_CHARS, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids, decoded (the text that the ids give).

    Texts of up to ``chunk_chars`` are one chunk and need no shuffle; longer ones are scanned in chunks, equal
    ones once. A null or empty text has no ids and decodes to an empty text.
    """
    tune(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for part in slices(batches, "text", RUN_BYTES):
            ids, first = model.encode(part.column("text"))
            yield _encoded(part.column("doc_id"), ids, first, model.decode(ids, first))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in (b.slice(k, 16) for b in batches for k in range(0, b.num_rows, 16)):  # long texts
            lists = batch.column("ids")
            first = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            yield _encoded(batch.column("doc_id"), ids, first, model.decode(ids, first))

    short = rows.filter(F.length("text") <= chunk_chars).mapInArrow(encode, ENCODED)
    giant = rows.filter(F.length("text") > chunk_chars).withColumn("key", F.sha2("text", 256))
    giant = materialise(giant, "giant-texts")
    ids = encode_chunks(giant.groupBy("key").agg(F.first("text").alias("text")), model_path, chunk_chars)
    long = giant.select("doc_id", "key").join(ids, "key").select("doc_id", "ids").mapInArrow(decode, ENCODED)
    return short.unionByName(long)
