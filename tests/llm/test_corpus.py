"""Mixing, toxicity, main texts, the pipeline, and every query on empty and awkward tables."""

import collections
import random
import tracemalloc

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from tallymart.llm import jaccard_join, mixing, pieces, pseudonyms, repetition, shared, suffix_dedup, toxicity, wrappers
from tallymart.llm.queries import ORACLES, PIECE_MODEL, QUERIES, TEST_KEY


def test_mix(awkward, nothing):
    rows = mixing.mix_report(awkward).collect()
    assert len(rows) == awkward.count()
    per = collections.defaultdict(list)
    for r in rows:
        per[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
    total = sum(r.size for r in rows)
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(per, key=lambda s: (s is None, s or "")))}
    targets, open_, left = {}, set(per), total
    while True:  # reshare by weight until none is above three times its size
        shares = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = {s for s in open_ if shares[s] > 3 * per[s][0].source_size}
        if not above:
            targets |= shares
            break
        targets |= {s: 3.0 * per[s][0].source_size for s in above}
        left -= sum(targets[s] for s in above)
        open_ -= above
    for s, own in per.items():
        assert own[0].source_size == sum(r.size for r in own)
        assert own[0].target == pytest.approx(targets[s])
        taken = sum(r.taken for r in own)
        assert taken <= own[0].target + 1e-6 and own[0].target - taken <= max(r.size for r in own)
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_report(nothing).count() == mixing.mix(nothing).count() == 0


def test_maximal_segments():
    def split(s, a, b):
        best = max(((sum(s[i:j]), -i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        return split(s, a, -best[1]) + [(-best[1], best[2])] + split(s, best[2], b)

    r = random.Random(1)
    for _ in range(200):
        s = [r.choice([-3, -2, -1, 1.5, 2, 4, 0.25]) + r.random() * 1e-3 for _ in range(r.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(s)] == split(s, 0, len(s))


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored, model = toxicity.score_toxicity(docs, labels)
    rows = scored.filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.97 and found > 0.8
    assert all(0 <= r.score <= 1 for r in rows)
    assert len(model.scores) <= toxicity.ToxicityRule().max_terms


def test_toxicity_odd_input(spark, awkward, nothing):
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 1, 0), (None, 1, 1), (5, 1, None), (0, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(awkward, labels)[0].collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(awkward, labels.limit(0))[0].count() == awkward.count()
    assert toxicity.score_toxicity(nothing, labels)[0].count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side</aside><div id="sidebar"><p>More</p></div>
<article><header><h1>Head {n}</h1><span>by someone</span></header><p>First&nbsp;para &lt;{n}&gt;
  goes <b>on</b>.<p>Second<br>line{extra}<form><input><button>Send</button></form><div class="ad">Buy</div><ul><li>One {n}<li>Two</ul></article>
<section class="comments"><h2>Comments</h2><div class="comment">Nice!</div></section><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    pages = [(k, f"https://www.example.com/{k}", PAGE.format(n=k, extra="" if k % 2 else "</p><table><tr><td>c1<td>c2</table>")) for k in range(12)]
    pages += [(50, "http://other.example.org/x", "<div class=menu>M</div><p>Just a text"), (51, None, None), (52, "nohost", ""), (53, "http://deep.example.org", "<div>" * 3000 + "deep" + "</div>" * 3000), (0, *pages[0][1:])]
    found = {r.page_id: r for r in wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for k in range(12):
        table = [] if k % 2 else ["c1", "c2"]
        assert found[k].text.split("\n") == [f"Head {k}", f"First para <{k}> goes on.", "Second line", *table, f"One {k}", "Two"], found[k].text
        assert found[k].n_chars == len(found[k].text)
    assert [found[k].text for k in (50, 51, 52, 53)] == ["Just a text", "", "", "deep"]


def test_main_text_of_mixed_templates(spark):
    forms = ["<nav>N</nav><article><p>text {k}</p></article>", "<main><p>text {k}</p></main>", "<div class=content><p>text {k}</p></div>", "<p>text {k}</p>", "<article> <img></article><p>text {k}</p>"]
    for url in ("https://mixed.example.org/", None):
        pages = [(k, url, f"<html><body>{forms[k % len(forms)].format(k=k)}<footer>F</footer></body></html>") for k in range(15)]
        found = wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
        assert {r.page_id: r.text for r in found} == {k: f"text {k}" for k in range(15)}


def test_text_of_one_page_is_not_the_hosts(spark):
    once = {2: "<blockquote>quoted</blockquote>", 4: "<table><tr><td>cell</table>", 6: "<h3>Part</h3>", 7: "<p class=note>noted</p>"}
    pages = [(k, "https://plain.example.org/", f"<html><body><p>text {k}</p>{once.get(k, '')}<div>All rights</div></body></html>") for k in range(12)]
    pages += [(12, "https://plain.example.org/", None), (13, "https://plain.example.org/", " ")]
    pages += [(k, "https://twice.example.org/", f"<p>text {k}</p>{'<h3>same</h3><h3>same</h3><h3>same</h3>' if k == 21 else ''}") for k in range(20, 23)]
    found = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    more = {2: ["quoted"], 4: ["cell"], 6: ["Part"], 7: ["noted"], 21: ["same"] * 3}
    assert found == {k: "\n".join([f"text {k}", *more.get(k, [])]) if k not in (12, 13) else "" for k in found}


def test_wrappers_align():
    one = wrappers.wrapper_of(wrappers.parse("<ul><li>a<li>b</ul><p>x</p>"))
    two = wrappers.wrapper_of(wrappers.parse("<ul><li>c</ul><h2>t</h2><p>x</p>"))
    assert wrappers.as_pattern(wrappers.align(one, two)) == '<> <ul> (<li> #slot </>)+ </> (<h2> "t" </>)? <p> "x" </> </>'


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    for t in ("documents", "pages", "labels", "conversations"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


# beyond SQL: tested against brute force, the libraries or held-out labels
ROWS_ONLY = {
    "op1_sentencepiece", "op2_html", "op3_pii", "op4_suffix_dedup", "op5_quality_rules", "op6_fingerprints", "op7_toxicity",
    "op8_jaccard_join", "op10_token_planes", "op12_conversation_repair",
}


def test_which_queries_have_no_twin():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = collections.Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    assert collections.Counter(tuple(row[c] for c in columns) for row in df.collect()) == expected


def test_pipeline(spark):
    """Every stage against what its parts say about the same rows, the last against the library."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = {r.doc_id for r in repetition.quality_report(docs).collect() if r.kept}
    one = corpus_pipeline.quality_rules(spark, docs, "")
    assert {r.doc_id for r in one.collect()} == good and one.columns == docs.columns
    first = {r.doc_id for r in jaccard_join.link_documents(one).collect() if r.doc_id == r.component_id}
    two = corpus_pipeline.near_copies(spark, one, "")
    assert {r.doc_id for r in two.collect()} == first and two.columns == docs.columns
    three = corpus_pipeline.private_data(spark, two, "")
    names = pseudonyms.Pseudonyms(TEST_KEY)
    texts = {r.doc_id: names.replace(r.text)[0] for r in two.collect()}
    assert {r.doc_id: r.text for r in three.collect()} == texts and three.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix_report(three).collect()}
    library = pieces.load(PIECE_MODEL).library
    found = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect():
        found[r.doc_id].append(r.ids)
    assert {i: len(x) for i, x in found.items()} == {i: n for i, n in copies.items() if n}
    assert all(ids == library.encode(texts[i]) for i, some in found.items() for ids in some)
    assert suffix_dedup.dedup_report(docs).count() == docs.count()


class InThisProcess:
    """Batches that stand for a frame whose tasks run here."""

    columns, schema = ["text"], None

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, work, schema):
        return list(work(iter(self.batches)))


def test_quality_rules_take_bounded_memory(monkeypatch):
    r = random.Random(8)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 7))) for _ in range(5_000)]
    texts = [" ".join(r.choices(words, k=r.choice([20, 400]))) for _ in range(4_000)]
    batch, released = pa.RecordBatch.from_pydict({"text": texts}), []
    assert batch.nbytes > 4 << 20
    monkeypatch.setattr(shared, "release_memory", lambda: released.append(True))
    tracemalloc.start()
    try:
        kept = repetition.keep_good(InThisProcess(batch))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 64 << 20  # of one run, not of the batch
    assert released == [True]  # for the stages after it
    assert [x for part in kept for x in part.column("text").to_pylist()] == [x for x in texts if x.count(" ") > 50]
