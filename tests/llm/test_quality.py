import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from habitra.llm import html_extract, html_train, quality_fm, quality_rules
from habitra.llm.queries import OP10_SQL, op9_quality


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines)


def test_measurements(spark, odd, docs):
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a b c", "a a a a", "a b", "a b c d a b c", "x\n\nx\n x\n\x0bx", "#*$%&|<> \r\n    z", "a\x1cb c"], 1000)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(extra)
    texts = sorted(((r.doc_id, *brute_rules(r.text)) for r in rows.collect()), key=str)
    got = sorted((tuple(r)[:7] for r in quality_rules.ledger(rows).collect()), key=str)
    assert got == texts


def test_rules_native(docs):
    plan = docs.sparkSession._jvm.PythonSQLUtils.explainString(quality_rules.apply_policy(quality_rules.ledger(docs))._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_policies_and_ablations(docs, none):
    rows = quality_rules.ledger(docs)
    local = [(r.failed, r) for r in rows.collect()]
    mask = quality_rules.mask_of("v1")
    assert quality_rules.apply_policy(rows).where("kept").count() == sum(not f & mask for f, _ in local) == quality_rules.keep(docs).count()
    for r in quality_rules.ablations(rows).collect():
        bit = quality_rules.mask_of((r.rule,))
        assert r.n_failed == sum(bool(f & bit) for f, _ in local)
        assert r.n_only == sum(f & mask == bit for f, _ in local)
        assert r.n_kept_without == sum(not f & mask & ~bit for f, _ in local)
    assert quality_rules.ledger(none).count() == 0 and quality_rules.keep(none).count() == 0


def test_rules_keep_good_texts(spark, sf, docs):
    good = docs.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id").where(F.size(F.split("text", r"\\s+")) >= 52)
    lost = good.count() - quality_rules.keep(good).count()
    assert lost <= 0.02 * good.count()


def test_rules_sql(sf, docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(OP10_SQL).fetchall()}
    rows = quality_rules.apply_policy(quality_rules.ledger(docs)).collect()
    base = quality_rules.mask_of("base")
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, bool(r.failed & base), r.kept) for r in rows} == want


def test_classifier_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    machine = quality_fm.fit(docs, labels)
    rows = quality_fm.score(docs, machine).join(labels, "doc_id").where(quality_fm.is_held_out(F.col("doc_id"))).collect()
    right = [(r.score >= quality_fm.THRESHOLD) == (r.quality == 1) for r in rows]
    assert len(right) > 60 and np.mean(right) >= 0.95
    assert not [r for r in rows if r.quality == 1 and r.score < quality_fm.THRESHOLD]
    again = quality_fm.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(machine.vectors, again.vectors) and machine.bias == again.bias


def test_held_out_rows_never_train(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_fm.is_held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_fm.fit(docs, labels), quality_fm.fit(docs, flipped)
    assert np.array_equal(a.linear, b.linear)


def test_pairs_identity():
    g = np.random.default_rng(0)
    n = 10 + quality_fm.N_STATS
    fm = quality_fm.FactorisationMachine(0.1, g.normal(size=n), g.normal(size=(n, 3)), np.zeros(quality_fm.N_STATS), np.ones(quality_fm.N_STATS))
    x = np.abs(g.normal(size=(4, n))) / 3
    z = fm._standard(x)
    slow = [0.1 + r @ fm.linear + sum(r[i] * r[j] * (fm.vectors[i] @ fm.vectors[j]) for i in range(n) for j in range(i)) for r in z]
    assert np.allclose(fm.score(x), 1 / (1 + np.exp(-np.clip(slow, -30, 30))))


def test_classifier_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, "a"), (1, None, "a"), (2, 0, "b"), (None, 1, "c"), (8, 5, "c")], "doc_id long, quality int, text string")
    rows = quality_fm.score(odd, quality_fm.fit(odd, labels)).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    blank = quality_fm.fit(none, labels.limit(0))
    assert {r.score for r in quality_fm.score(odd, blank).collect()} == {0.5}
    assert quality_fm.score(none, blank).count() == 0
    assert quality_fm.keep(odd, blank, 0.4).columns == odd.columns and quality_fm.keep(odd, blank, 0.4).count() == 9


def test_classifier_reads_metadata(spark):
    """Texts that say nothing, and labels that follow a number's size and a name; nulls, NaN and clashing names."""
    rows = [(i, "the same text", 10.0 if i % 2 else 90.0, "x" if i % 3 else "y", "f") for i in range(200)]
    rows += [(1000, "the same text", None, None, None), (1001, None, float("nan"), "unseen", "f"), (1002, "", float("inf"), "x", "f"), (1003, "", -5.0, "x", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, x double, `a b` string, fields string")
    labels = spark.createDataFrame([(i, int(i % 2 or i % 3 == 0)) for i in range(200)], "doc_id long, quality int")
    machine = quality_fm.fit(df, labels, metadata=("x", "a b"))
    got = {r.doc_id: r.score for r in quality_fm.score(df, machine).collect()}
    assert all((got[i] > 0.5) == bool(i % 2 or i % 3 == 0) for i in range(200)) and len(got) == 204
    kept = quality_fm.keep(df, machine, 0.5)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= 0.5}
    assert quality_fm.score(df.limit(0), quality_fm.fit(df.limit(0), labels, metadata=("x",))).count() == 0
    assert [r[0] for r in df.where("doc_id in (0, 1000, 1003)").orderBy("doc_id").select(quality_fm.fields(df, ("x", "a b"))).collect()] == [["x:6", "a b=y"], [], ["x:-2", "a b=x"]]


def test_query_is_as_good_with_metadata(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    rows = op9_quality(spark, d).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert not [r for r in rows if r.quality == 1 and not r.predicted]


def test_labeller_on_new_pages():
    blocks, pages = html_train.accuracy(html_extract.Labeller.load(), 120, seed=12345)
    assert blocks >= 0.99 and pages >= 0.9


def test_main_text(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(rows).collect()}
    wrong = 0
    for r in rows.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html_extract.html.unescape(re.sub(r"</?[a-z][^>]*>", " " if x == "br" else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        wrong += got[r.page_id] != "\n\n".join(x for x in parts if x)
    assert len(got) == 250 and wrong <= 2


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("", []),
        ("just text &amp; more", ["just text & more"]),
        ("<p>a<b>b</b> c<br>d<p>e &lt;f&gt; \n\t g", ["ab c d", "e <f> g"]),
        ("<head><title>t</title></head><body><script>x='<p>no</p>'</script><!-- <p>no --><p>yes", ["yes"]),
        ("<p title='a > b' class=\"x\">q</p><p class=unclosed'quote>r</p>", ["q", "r"]),
        ("<ul><li>one<li>two</ul><select><option>no</select>tail <", ["one", "two", "tail <"]),
        ("a < b and <3 & c", ["a < b and <3 & c"]),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in html_extract.blocks(page)] == texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='a'>", "</div>", "<a href=x>", "</a>", "<", ">", "'", '"', "text ", "&amp;", "<!--", "-->", "<script>", "</script>", "<br>", "\n", "é"]), max_size=30))
def test_any_markup_parses(parts):
    for b in html_extract.blocks("".join(parts)):
        assert b.text and b.text == " ".join(b.text.split())


def test_pages_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "y"), (None, "u", "<p>" * 3000 + "a b", "z"), (2, "u", "<article>" + "<p>Some words stand here, and more.</p>" * 4000 + "</article><footer>© all rights</footer>", "z")], "page_id long, url string, html string, text string")
    got = html_extract.extract(rows).collect()
    assert len(got) == 4 and [r.text for r in got if r.page_id == 1] == ["", ""]
    assert got[3].text.count("\n\n") == 3999
    assert html_extract.extract(rows.limit(0)).count() == 0


def test_nothing_of_a_page_is_cut():
    """Long attributes, many classes, deep paths: all names count, in linear time."""
    import time

    (block,) = html_extract.blocks('<body><div class="' + " " * 30_000 + " ".join(f"c{k}" for k in range(40)) + ' comments"><p>Some words')
    assert block.path[:2] == ("body", "div") and ".comments" in block.path and block.path.count(".c") == 40
    began = time.perf_counter()
    deep = html_extract.blocks("<div class=x>some words" * 22_000)  # half a megabyte, nothing closed
    net = html_extract.Labeller.load()
    x = net.inputs(deep)
    assert len(deep) == 22_000 and time.perf_counter() - began < 20
    for k in (0, 1, 7, 500):
        assert np.allclose(x[k, : html_extract.PATH_DIM], net.w["path"][html_extract.path_buckets(deep[k])].mean(0), atol=1e-4)


def test_a_head_without_an_end():
    texts = lambda page: [b.text for b in html_extract.blocks(page)]
    assert texts("<head><title>x</title><meta charset=utf-8><article><p>One.<p>Two.") == ["One.", "Two."]
    assert texts("<p>One.<svg><g>unseen</g></svg><p>Two.<select><option>Three.<p>Four.") == ["One.", "Two.", "Three.", "Four."]
