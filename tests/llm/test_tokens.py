"""SentencePiece, token planes, pseudonyms: against the libraries, and exact round trips."""

import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallymart.llm import bitplanes, pieces, pseudonyms
from tallymart.llm.queries import PIECE_MODEL, WORD_TOKENIZER


def odd_texts(n, seed=5):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        kind = r.random()
        if kind < 0.3:
            out.append("".join(r.choice("ab the ing \n▁é漢 .") for _ in range(r.randint(0, 40))))
        elif kind < 0.6:
            out.append("".join(r.choice("aaabe rst") for _ in range(r.randint(0, 60))))
        elif kind < 0.8:
            out.append(" ".join(r.choice(["hello", "the", "antidisestablish", "  ", "\x00", "😀", "aaaaaaaa", "==", "\t\t", "DON'T", "x1.5!"]) for _ in range(r.randint(0, 12))))
        else:
            out.append("".join(chr(r.choice([r.randint(32, 126), r.randint(160, 1000), r.randint(0x4E00, 0x4EFF)])) for _ in range(r.randint(0, 30))))
    return out


def as_unigram(model: bytes) -> bytes:
    """The same vocabulary as a unigram model: the trainer's model type is 1."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    spec = next(v for n, v in pieces._fields(model) if n == 2)
    changed = spec.replace(b"\x18\x02", b"\x18\x01", 1)
    return model.replace(b"\x12" + varint(len(spec)) + spec, b"\x12" + varint(len(changed)) + changed, 1)


@pytest.fixture(scope="module")
def models():
    with open(PIECE_MODEL, "rb") as file:
        return pieces.load(PIECE_MODEL), pieces.Pieces.of(as_unigram(file.read()))


def in_chunks(model, text, size):
    text, side = model.escaped(text), model.longest
    parts = [(text[max(0, a - side) : a], text[a : a + size], text[a + size : a + size + side]) for a in range(0, len(text), size)]
    matrices = [model.transfer(*p) for p in parts]
    way = pieces._way(pieces.OPEN, pieces.OPEN, matrices)
    return sum((model.trace(*p, a, b) for p, a, b in zip(parts, way, [*way[1:], pieces.OPEN], strict=True)), [])


def test_pieces_equal_the_library(models):
    texts, model = odd_texts(1500), models[0]
    ids, first = model.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == model.library.encode(texts)
    assert model.decode(ids, first).to_pylist() == [model.library.decode(x) for x in model.library.encode(texts)]


def test_bytes_that_are_no_text_decode_as_in_the_library(models):
    r, model = random.Random(3), models[0]
    lists = [[r.choice([r.choice(model.bytes), r.randrange(len(model.scores))]) for _ in range(r.randint(1, 8))] for _ in range(3000)]
    first = np.r_[0, np.cumsum([len(x) for x in lists])]
    found = model.decode(np.array([i for x in lists for i in x]), first).to_pylist()
    assert found == [model.library.decode(x) for x in lists]


def test_memos_are_bounded(models, monkeypatch):
    """Whatever is forgotten, the ids stay the library's."""
    with open(PIECE_MODEL, "rb") as file:
        model = pieces.Pieces.of(file.read())
    monkeypatch.setattr(model, "WORD_BYTES", 2000, raising=False)
    monkeypatch.setattr(model, "MOST_PAIRS", 5, raising=False)
    texts = odd_texts(300, 11)
    ids, first = model.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == model.library.encode(texts)
    assert len(model.words) < 20 and len(model.pairs) <= 5 and len(model.older_pairs) <= 5


def test_unigram_paths_are_best(models):
    """No path through the lattice weighs more, by a plain recursion over all of them."""
    model = models[1]
    assert models[0].bpe and not model.bpe

    def best(text):
        if not text:
            return 0.0
        steps = [(n, model.ids.get(text[:n])) for n in range(1, len(text) + 1)]
        return max(model.scores[k] + best(text[n:]) for n, k in steps if k is not None)

    for text in ("thethe", "a the in", "aaabe rst", "ing   the", "x.y,z", "antidise"):
        ids, _ = model.encode(pa.array([text]))
        assert sum(model.scores[k] for k in ids) == pytest.approx(best(model.escaped(text)))
        assert model.decode(ids, np.array([0, len(ids)])).to_pylist() == [text]


@pytest.mark.parametrize("size", [1, 3, 7, 20, 50])
def test_chunks_make_no_difference(models, size):
    for model in models:
        for text in odd_texts(150, size):
            if text:
                found, whole = in_chunks(model, text, size), model.encode(pa.array([text]))[0].tolist()
                if model.bpe:
                    assert found == whole == model.library.encode(text)
                else:  # paths of one weight may be told apart differently
                    assert model.library.decode(found) == model.library.decode(whole)
                    assert sum(model.scores[k] for k in found) == pytest.approx(sum(model.scores[k] for k in whole))


def test_products_of_matrices_are_associative(models):
    text = models[0].escaped("thethetheinginging" * 4)
    parts = [(text[max(0, a - 16) : a], text[a : a + 6], text[a + 6 : a + 22]) for a in range(0, len(text), 6)]
    a, b, c, *_ = (models[1].transfer(*p) for p in parts)
    left, right = pieces.combine(pieces.combine(a, b), c), pieces.combine(a, pieces.combine(b, c))
    assert {s: {t: round(w, 3) for t, w in row.items()} for s, row in left.items()} == {s: {t: round(w, 3) for t, w in row.items()} for s, row in right.items()}


def test_encode_documents(awkward, nothing, models):
    found = pieces.encode_documents(awkward, PIECE_MODEL, chunk_chars=500).collect()  # several chunks and blocks
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r.doc_id, r.text or "")
    assert len(found) == awkward.count()
    for r in found:
        assert r.ids == models[0].library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded == models[0].library.decode(r.ids)
    assert pieces.encode_documents(nothing, PIECE_MODEL).count() == 0


def test_word_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_TOKENIZER)
    texts = [*odd_texts(600, 8), "don't WE'LL Σας ΟΔΟΣ. H̱x <|endoftext|> <|ENDOFTEXT|> İstanbul!?!? 12.5,", None]
    ids, counts = bitplanes.WordTokenizer(WORD_TOKENIZER).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


class Sink(io.BytesIO):
    def close(self):
        pass


def test_planes_round_trip():
    r = np.random.default_rng(1)
    for n, top, block in ((0, 1, 8), (1, 2**32, 8), (1000, 50_000, 64), (64, 1, 64)):
        ids = r.integers(0, top, n, dtype=np.uint32)
        sink = Sink()
        writer = bitplanes.PlaneWriter(sink, block, 3)
        entries = np.zeros(2, bitplanes.ENTRY)
        entries["doc_id"], entries["has_id"], entries["n_tokens"] = [7, 9], 1, [n // 3, n - n // 3]
        writer.add(entries, ids)
        assert writer.close() == (2, n)
        reader = bitplanes.PlaneReader(pa.BufferReader(sink.getvalue()))
        back = np.concatenate([reader.block(k) for k in range(len(reader.index))] or [ids])
        assert back.tolist() == ids.tolist()
        data = ids.astype("<u4")
        assert list(reader.documents()) == [(7, n // 3, zlib.crc32(data[: n // 3].tobytes())), (9, n - n // 3, zlib.crc32(data[n // 3 :].tobytes()))]
    with pytest.raises(ValueError):
        bitplanes.PlaneReader(pa.BufferReader(b"x" * 100))


def test_token_files(spark, awkward, nothing):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_TOKENIZER)
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.text or ""))
    found = sorted(bitplanes.planes_of(spark, awkward, WORD_TOKENIZER).collect(), key=lambda r: r.start)
    start = 0
    for r, given in zip(found, rows, strict=True):
        ids = [*whole.encode(given.text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (given.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert bitplanes.planes_of(spark, nothing, WORD_TOKENIZER).count() == 0


def test_permutation():
    for n in (1, 2, 3, 7, 100, 1000):
        image = [pseudonyms.permute(b"k", "t", n, x) for x in range(n)]
        assert sorted(image) == list(range(n)) and (n == 1 or all(a != b for a, b in enumerate(image)))
        assert [pseudonyms.permute(b"k", "t", n, y, back=True) for y in image] == list(range(n))


def test_formats_and_links():
    names = pseudonyms.Pseudonyms(b"k")
    text, found = names.replace("4929583550668540 4929-5835-5066-8540 +1 (389) 555-5010 389-555-5010 2024-02-29 123-45-6789 GB82 WEST 1234 5698 7654 32 a.b9@x.org 10.0.0.1")
    kinds = [f["kind"] for f in found]
    assert kinds == ["card", "card", "phone", "phone", "iso_date", "ssn", "iban", "email", "ip"]
    assert all(text[f["start"] : f["end"]] == f["pseudonym"] for f in found)
    cards = [re.sub(r"\D", "", f["pseudonym"]) for f in found[:2]]
    assert cards[0] == cards[1] and pseudonyms.luhn_digit(cards[0][:-1]) == cards[0][-1]
    phones = [re.sub(r"\D", "", f["pseudonym"])[-10:] for f in found[2:4]]
    assert phones[0] == phones[1]
    assert pseudonyms.iban_number(found[6]["pseudonym"].replace(" ", "")) % 97 == 1
    for clean in ("Version 2.0, January 2004", "4929583550668541", "2024-02-30", "300.1.1.1", "666-12-1234", ""):
        assert names.replace(clean) == (clean, [])
    assert pseudonyms.Pseudonyms(b"other").replace("10.0.0.1")[0] != names.replace("10.0.0.1")[0]


def test_phones_of_every_area():
    names = pseudonyms.Pseudonyms(b"k")
    given = ["+1 (017) 555-7713", "+1 (132) 555-1352", "389-099-5010", "000 000 0000", "(199) 199-9999", "+1 (389) 555-5010"]
    for phone in given:
        text, found = names.replace(f"call {phone}.")
        new = found[0]["pseudonym"]
        assert [f["kind"] for f in found] == ["phone"] and text == f"call {new}." and new != phone
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", phone)
        old, changed = (re.sub(r"\D", "", p)[-10:] for p in (phone, new))
        assert (old[0] < "2", old[3] < "2") == (changed[0] < "2", changed[3] < "2")
    assert len({names.replace(p)[0] for p in given}) == len(given)


@pytest.mark.parametrize("kind,text,private", [
    ("card", "card 4111 1111 1111 1111 12/27", "4111 1111 1111 1111"),
    ("card", "order 5 4111 1111 1111 1111 ok", "4111 1111 1111 1111"),
    ("card", "order 5-4111-1111-1111-1111 ok", "4111-1111-1111-1111"),
    ("card", "order 12345 4111 1111 1111 1111 12", "4111 1111 1111 1111"),
    ("card", "378282246310005 1234", "378282246310005"),
    ("card", "tel +49 30 1234567 4111 1111 1111 1111", "4111 1111 1111 1111"),
    ("abroad", "tel +49 30 1234567 4111 1111 1111 1111", "+49 30 1234567"),
    ("ssn", "7 123-45-6789 2222", "123-45-6789"),
    ("iban", "BE68 5390 0754 7034 PAID", "BE68 5390 0754 7034"),
    ("iban", "BE68 5390 0754 7034 PAID TODAY", "BE68 5390 0754 7034"),
    ("iban", "AB13 BE68 5390 0754 7034 OK", "BE68 5390 0754 7034"),
    ("email", "an josé.garcia@x.com", "josé.garcia@x.com"),
    ("email", "an jose\u0301.garcia@x.com", "jose\u0301.garcia@x.com"),
    ("email", "an ПЁТР@x.com", "ПЁТР@x.com"),
])
def test_private_data_within_longer_matches(kind, text, private):
    names = pseudonyms.Pseudonyms(b"k")
    new, found = names.replace(text)
    alone = names.replace(private)[1][0]
    assert alone["kind"] == kind and alone["pseudonym"] != private
    assert (kind, alone["pseudonym"]) in [(f["kind"], f["pseudonym"]) for f in found]
    assert private not in new and all(new[f["start"] : f["end"]] == f["pseudonym"] for f in found)


def test_tables_of_numbers_stay():
    table = " ".join(str(k % 7) for k in range(19))
    for clean in (f"{table} x", "card ٤١١١١١١١١١١١١١١١ 1", "tel ٣٨٩-٥٥٥-٥٠١٠ 1"):
        assert pseudonyms.Pseudonyms(b"k").replace(clean) == (clean, [])


def test_pseudonymised_documents(awkward, nothing):
    old = {(r.doc_id, r.text) for r in awkward.collect()}
    new = pseudonyms.pseudonymise(awkward, b"k")
    assert new.schema == awkward.schema
    changed = {(r.doc_id, r.text) for r in new.collect()} - old
    assert [i for i, _ in changed] == [17]
    text = next(iter(changed))[1]
    assert not any(x in text for x in ("joe.doe7@", "555-5010", "4929583550668540", "1987-03-21"))
    report = pseudonyms.pseudonym_report(awkward, b"k")
    assert {r.kind for r in pseudonyms.links(report).collect()} == {"email", "phone", "card", "iso_date"}
    assert pseudonyms.pseudonymise(nothing, b"k").count() == 0


def test_public_files_are_where_they_say():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_MODEL
    assert io.open(PIECE_MODEL, "rb").read(1)
