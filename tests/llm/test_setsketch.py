"""Sketches and their near copies against sets and brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import setsketch

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
RULE = setsketch.SketchRule()


def components_by_brute_force(rows, width=3, percent=85):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(ASCII_LOWER).split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    comp = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and comp[i] != comp[j] and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((comp[i], comp[j]))
                comp = {k: low if c == high else c for k, c in comp.items()}
    return {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


def sketch_of(*sets):
    first = np.r_[0, np.cumsum([len(x) for x in sets])]
    return setsketch.sketches(np.concatenate([np.asarray(x, np.uint64) for x in sets]), first, RULE)


def test_sketches_merge_and_do_not_depend_on_chunks(monkeypatch):
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 2**63, n, dtype=np.uint64) for n in (5_000, 40_000))
    one, two, both, empty = sketch_of(a, b, np.r_[a, b], [])
    assert (setsketch.merged(one, two) == both).all() and not empty.any()
    monkeypatch.setattr(setsketch, "CHUNK", 37)
    assert (sketch_of(a, [], b[:10], []) == np.stack([one, empty, sketch_of(b[:10])[0], empty])).all()


@pytest.mark.parametrize("similarity", [0.3, 0.6, 0.85, 0.95])
def test_likelihood_finds_the_similarity(similarity):
    """Estimates of 200 pairs of different sizes lie around the truth; pairs at the limit are never beyond doubt."""
    r = np.random.default_rng(int(similarity * 100))
    errors, doubtless = [], 0
    for _ in range(200):
        both = int(r.integers(50, 400))
        rest = int(both / similarity) - both
        cut = int(r.integers(0, rest + 1)) if similarity < 0.9 else rest // 2
        all_ = r.integers(0, 2**63, both + rest, dtype=np.uint64)
        a, b = sketch_of(all_[: both + cut], np.r_[all_[:both], all_[both + cut :]])
        n_a, n_b = both + cut, both + rest - cut
        grid = np.minimum(n_a / n_b, n_b / n_a) * np.linspace(0, 1, 400)
        found = setsketch.log_likelihood((a > b).sum(), (a < b).sum(), (a == b).sum(), n_a, n_b, grid, RULE.base)
        errors.append(grid[found.argmax()] - both / (both + rest))
        doubtless += int(setsketch.beyond_doubt(a[None], b[None], np.array([n_a]), np.array([n_b]), RULE)[0])
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    assert doubtless == 0 if similarity >= 0.85 else doubtless > 180 or similarity > 0.5


def test_bands_meet_at_the_limit():
    """Of 2,000 pairs at the limit all agree in a band."""
    r = np.random.default_rng(5)
    pairs = []
    for _ in range(2_000):
        all_ = r.integers(0, 2**63, 100, dtype=np.uint64)
        pairs += [all_[:92], np.r_[all_[:85], all_[92:]]]  # 85 of 100
    bands = sketch_of(*pairs).reshape(2_000, 2, RULE.bands, RULE.rows)
    assert (bands[:, 0] == bands[:, 1]).all(axis=2).any(axis=1).all()


def check(docs, rows):
    found = setsketch.near_copies(docs).collect()
    expected = components_by_brute_force(rows)
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(i for i, _ in rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == expected[r.doc_id], r.doc_id
        else:
            assert r.component_id is None and r.kept
    return expected


def test_near_copies(awkward, small, nothing):
    for docs in (small, awkward):
        expected = check(docs, [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])
    kept = setsketch.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {None} | {i for i, x in expected.items() if x[2]}
    assert setsketch.near_copies(nothing).count() == 0


def test_families_and_chains(spark):
    """Edits of one text that link only through it or in a chain, and a family below the limit."""
    r = random.Random(1)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(60):
        words = list(base)
        for place in r.sample(range(200), r.randint(1, 8)):
            words[place] = f"v{r.random()}"
        texts.append(" ".join(words))
    chain = [" ".join(f"c{k}" for k in range(10 * step, 10 * step + 170)) for step in range(12)]
    below = [" ".join([*(f"t{k}" for k in range(90)), *(f"u{i}x{k}" for k in range(14))]) for i in range(30)]
    rows = list(enumerate([*texts, " ".join(base), *chain, *below, *texts[:5], "one", "ONE", "two words", ""]))
    expected = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)
    assert len({c for _, c, _ in expected.values()}) < 60


def edits(r, words, n, mark):
    """``words`` with n of them replaced."""
    words = list(words)
    for place in r.sample(range(len(words)), n):
        words[place] = f"{mark}{r.random()}"
    return words


def test_family_below_the_limit_is_not_listed_by_pairs(spark, monkeypatch):
    """Edits of one text that meet in bands and do not link: less than a third of all 1,326 pairs is compared at the end."""
    r, counts = random.Random(7), []
    base = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(edits(r, base, 8, f"x{k}y"))) for k in range(50)]
    rows += [(200 + k, " ".join(edits(r, rows[k][1].split(), 2, f"z{k}y"))) for k in range(2)]
    likely = setsketch._likely
    monkeypatch.setattr(setsketch, "_likely", lambda pairs, *rest: counts.append(pairs.count()) or likely(pairs, *rest))
    expected = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert sum(not kept for _, _, kept in expected.values()) == 2 and counts[-1] < 1_326 / 3


def test_differences_decide_the_links(spark):
    """g and the common differences tell for every two sets of a family whether they link, whichever its core."""
    r = random.Random(11)
    base = [f"w{k}" for k in range(60)]
    sets = [set(edits(r, base, r.randint(0, 9), "x")[: r.randint(50, 60)]) | set(r.sample([f"y{k}" for k in range(6)], r.randint(0, 3))) for _ in range(40)]
    ids = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    sets = [np.sort(np.array([ids[x] for x in s])) for s in sets]
    here = spark.createDataFrame([(7, k, len(s), k, 3 * k % 7) for k, s in enumerate(sets)], "key long, doc long, n long, comp long, central long")
    whole = spark.createDataFrame([(k, s.astype("<u8").tobytes()) for k, s in enumerate(sets)], "doc long, elements binary")
    found = {x.doc: x for x in setsketch._differences(here, whole, RULE).collect()}
    linked = {(i, j) for i in found for j in found if i < j and 100 * len(both := np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j]) - len(both))}
    assert linked and len(linked) < 700 and {x.fam for x in found.values()} == {0}
    assert linked == {(i, j) for i in found for j in found if i < j and 370 * len({*found[i].d} & {*found[j].d}) >= found[i].g + found[j].g}


def test_families_at_the_limit(spark):
    """Sets of different sizes around several cores, some of them linked to each other only, against brute force."""
    r, rows = random.Random(3), []
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(80)]
        cores = [edits(r, base, 5, f"f{family}c") for _ in range(3)]
        rows += [" ".join(edits(r, r.choice(cores), r.randint(0, 4), "e")[: r.randint(72, 80)]) for _ in range(40)]
    rows = list(enumerate(rows))
    expected = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)
    assert 3 < len({c for _, c, _ in expected.values()}) < 120


def test_one_id_with_two_texts_is_one_document(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (1, "short"), (2, text), (3, "short"), (None, text)]
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in setsketch.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, 58): (1, True), (1, 1): (1, True), (2, 58): (1, False), (3, 1): (3, True), (None, 58): (None, True)}


def test_shingles_of_long_and_short_texts():
    hashes, first = setsketch.shingle_sets(pa.array(["a b c d a b c", "A B", None, " ", "a b"]), 3)
    assert np.diff(first).tolist() == [4, 1, 0, 0, 1]
    assert hashes[first[1]] == hashes[first[4]]
