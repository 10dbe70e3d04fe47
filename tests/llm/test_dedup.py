"""Exact byte strings, near copies and fingerprints against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import jaccard_join, repetition, simhash, suffix_dedup

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def removed_by_brute_force(rows, width=50):
    first, out = {}, {}
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - width + 1):
            first[data[p : p + width]] = min(i, first.get(data[p : p + width], i))
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if first[data[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone, strict=True) if not g)).hexdigest())
    return out


def components_by_brute_force(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(ASCII_LOWER).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    comp = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and 100 * len(a & b) >= 75 * len(a | b) and comp[i] != comp[j]:
                low, high = sorted((comp[i], comp[j]))
                comp = {k: low if c == high else c for k, c in comp.items()}
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_suffix_array():
    r = random.Random(4)
    for _ in range(200):
        data = np.array([r.choice([0, 1, 2, 250, 255][: r.randint(1, 5)]) for _ in range(r.randint(1, 60))], np.uint8)
        text = data.tobytes()
        found = [text[i:] for i in suffix_dedup.two_stage_suffix_array(data, 64)]
        assert found == sorted(found)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_byte_strings(awkward, small, hot):
    for docs in (small, awkward):
        given = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
        found = suffix_dedup.dedup_report(docs, suffix_dedup.DedupRule(hot=hot)).collect()
        expected = removed_by_brute_force(given)
        assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(i for i, _ in given)
        for r in found:
            if r.doc_id is not None:
                assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id
            else:
                assert (r.n_removed, r.n_spans) == (0, 0)


def test_near_copies(awkward, small):
    for docs in (small, awkward):
        given = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
        found = jaccard_join.link_documents(docs).collect()
        expected = components_by_brute_force(given)
        assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(i for i, _ in given)
        for r in found:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id) == expected[r.doc_id], r.doc_id
    kept = jaccard_join.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {None} | {i for i, (_, c) in expected.items() if c == i}


def test_family_of_near_copies(spark):
    """Edits of one text link through it, though not to each other; a chain is one component."""
    r = random.Random(1)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(60):
        words = list(base)
        for place in r.sample(range(200), r.randint(1, 6)):
            words[place] = f"v{r.random()}"
        texts.append(" ".join(words))
    chain = [" ".join(f"c{k}" for k in range(12 * step, 12 * step + 150)) for step in range(12)]
    rows = list(enumerate([*texts, " ".join(base), *chain]))
    found = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_brute_force(rows)


def test_template_that_cannot_link_makes_no_pairs(spark, monkeypatch):
    verified, counts = jaccard_join._verified, []
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *more: counts.append(pairs.count()) or verified(pairs, *more))
    base = " ".join(f"w{k}" for k in range(164))  # 160 of 200 shingles are shared, 172 would have to be
    rows = [(i, base + "".join(f" v{i}x{k}" for k in range(40))) for i in range(30)]
    found = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_brute_force(rows) == {i: (200, i) for i in range(30)}
    assert counts and sum(counts) == 0, counts


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(110)] + [(k, k + 1) for k in range(300, 340)]
    found = {x.node: x.comp for x in jaccard_join.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    comp = {i: i for p in pairs for i in p}
    for a, b in pairs:
        low, high = sorted((comp[a], comp[b]))
        comp = {k: low if c == high else c for k, c in comp.items()}
    assert found == {k: c for k, c in comp.items() if any(k in p and p[0] != p[1] for p in pairs)}


def test_fingerprints(awkward, small):
    for docs in (small, awkward):
        rows = sorted((r for r in docs.collect()), key=lambda r: (r.doc_id is not None, r.doc_id, r.text or ""))
        found = collections.defaultdict(list)
        for r in simhash.fingerprint_report(docs).collect():
            found[r.doc_id].append(r)
        prints = {}
        for k, r in enumerate(rows):
            text, after = r.text or "", rows[(k + 1) % len(rows)].text or ""
            digest = hashlib.sha256(simhash.edit(text, after).encode()).hexdigest()
            mine = [f for f in found[r.doc_id] if f.edited_sha256 == digest]
            assert mine and mine[0].n_chars == len(text)
            assert prints.setdefault(text, mine[0].fingerprint) == mine[0].fingerprint
        all_prints = [(r.doc_id, bytes.fromhex(r.fingerprint)) for some in found.values() for r in some]
        for some in found.values():
            for r in some:
                if r.doc_id is not None and r.doc_id % 20 == 0:
                    mine = np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8)
                    near = sum(int(np.bitwise_count(mine ^ np.frombuffer(p, np.uint8)).sum()) <= 3 for _, p in all_prints) - 1
                    assert r.n_near == near


def test_near_fingerprint_classes(spark):
    r = random.Random(7)
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(r.choice(words) for _ in range(200)) for _ in range(30)]
    for k in range(0, 30, 2):  # near copies with one to eight words replaced, and copies of those
        some = texts[k].split()
        for at in r.sample(range(200), 1 + k // 4):
            some[at] = "other"
        texts += [" ".join(some)] * 2
    rows = simhash.fingerprint_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), every=2).collect()
    prints = {x.doc_id: np.frombuffer(bytes.fromhex(x.fingerprint), np.uint8) for x in rows}
    counts = collections.Counter(x.fingerprint for x in rows)
    wider = 0
    for x in rows:
        if x.doc_id % 2:
            assert x.near is None
            continue
        far = {y.fingerprint: int(np.bitwise_count(prints[x.doc_id] ^ prints[y.doc_id]).sum()) for y in rows}
        assert [tuple(c) for c in x.near] == sorted((d, f, counts[f]) for f, d in far.items() if d <= 15)
        wider += sum(3 < c.distance for c in x.near)
    assert wider > 10


def longest_by_brute_force(codes, shortest):
    out = []
    for i in range(len(codes)):
        best = 0
        for j in range(len(codes)):
            k = 0
            while i != j and max(i, j) + k < len(codes) and codes[i + k] == codes[j + k]:
                k += 1
            best = max(best, k)
        out.append(best if best >= shortest else 0)
    return out


def test_longest_repeats():
    r = random.Random(3)
    for _ in range(200):
        docs = [[r.randint(0, r.choice([1, 2, 5])) for _ in range(r.randint(0, 25))] for _ in range(3)]
        shortest = r.randint(1, 6)
        owner = np.repeat(np.arange(3), [len(d) for d in docs])
        found = repetition.longest_repeats(np.array(sum(docs, []), np.int64), owner, shortest).tolist()
        assert found == sum((longest_by_brute_force(d, shortest) for d in docs), [])


def test_quality_counts(awkward, small, nothing):
    for docs in (small, awkward):
        texts = collections.defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append(r.text)
        for r in repetition.quality_report(docs).collect():
            text = texts[r.doc_id][0] or ""
            words = text.encode().split()
            grams = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
            inside = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
            lines = [x for x in text.split("\n") if x.encode().split()]
            assert r.n_words == len(words)
            assert r.word_chars == sum(len(w.decode()) for w in words)
            assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
            assert r.n_dup_lines == len(lines) - len(set(lines))
            assert r.n_repeat_words == len(inside)
            assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
            assert not (r.kept and r.base_failed)
    repeated = pa.array([" ".join([*(f"u{k}" for k in range(60)), *(f"p{k}" for k in range(40)), "x", *(f"p{k}" for k in range(40))])])
    found = repetition.measure(repeated)
    assert (found["covered_words"][0], found["longest_repeat"][0]) == (80, 40)
    assert repetition.keep_good(awkward).columns == awkward.columns
    assert repetition.keep_good(nothing).count() == 0
