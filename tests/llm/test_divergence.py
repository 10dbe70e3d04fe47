"""The divergence audit against a plain version, and shares beyond what 64 bits hold."""

import collections
import re

import pytest

from tallymart.llm import divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def by_brute_force(rows, least=10, top=10):
    """Rows are (lang, source, text)."""
    docs = collections.defaultdict(lambda: collections.defaultdict(int))
    counts = collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang, source].update(found)
        for term in set(found):
            docs[lang][term] += 1
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in counts if g == lang)

        def share(per, kept=kept):
            total = sum(per[t] for t in kept)
            return {t: 1 + 10**9 * (per[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = share(sum((counts[lang, s] for s in sources), collections.Counter()))
        own = {s: share(counts[lang, s]) for s in sources}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("rule", [divergence.DivergenceRule(), divergence.DivergenceRule(block=2, run_terms=5), divergence.DivergenceRule(least_docs=2, top=3, block=3)])
def test_audit(awkward, small, rule):
    for docs in (awkward, small):
        found = [tuple(r) for r in divergence.audit(docs, rule).collect()]
        expected = by_brute_force([(r.lang, r.source, r.text) for r in docs.collect()], rule.least_docs, rule.top)
        assert len(found) == len(set(found)) and set(found) == expected


def test_ties_at_the_tenth_place_go_by_utf8(spark):
    """All terms of a source fall into one cell; capital and other letters, a lone source, a source without terms."""
    words = ["Zebra", "apple", "\u00e9t\u00e9", "\uffee", "\U0001f600", "MIX\u00c4", *(f"w{chr(97 + k)}" for k in range(12))]
    rows = [("en", "one", " ".join(words))] * 10 + [("en", "two", "common words")] * 30 + [("en", None, "1 2 3"), ("de", "one", None), (None, None, "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = [tuple(r) for r in divergence.audit(docs).collect()]
    assert set(found) == by_brute_force(rows)
    listed = sorted((r[5], r[3]) for r in found if r[:3] == ("en", "one", "term"))
    assert [t for _, t in listed] == sorted((w.translate(LOWER) for w in words), key=str.encode)[:10]
    assert {r[:5] for r in found if r[0] == "en" and r[1] == ""} == {("en", "", "pair", s, v) for *_, s, v, _ in (r for r in found if r[1] == "")}


def test_shares_are_exact(spark):
    n, total, terms = 70_000_000_000_123, 900_000_000_000_777, 12_345_678
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    share = row.select(divergence._share(row["n"], row["total"], row["terms"])).first()[0]
    assert share == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_audit_of_nothing(nothing, spark):
    assert divergence.audit(nothing).count() == 0
    clash = spark.createDataFrame([("en", "a", "x", 1, "t", 2)], "lang string, source string, text string, n int, term string, place int")
    assert divergence.audit(clash).count() == 0
