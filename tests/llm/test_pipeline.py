import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from habitra.llm import quality_fm, quality_rules, suffix_dedup
from habitra.llm.common import materialise

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(materialise(f(spark, out[-1], SF), name))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    for s in stages[1:5]:
        assert s.dtypes == stages[0].dtypes
    counts = [s.count() for s in stages[:5]]
    assert counts == sorted(counts, reverse=True) and counts[4] == counts[3]


def test_filters_equal_their_rules(spark, stages):
    machine = quality_fm.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), metadata=("n_chars",))
    want = {r.doc_id for r in quality_fm.score(stages[0], machine).where(F.col("score") >= 0.7).collect()}
    assert {r.doc_id for r in stages[1].collect()} == want
    kept = {r.doc_id for r in quality_rules.apply_policy(quality_rules.ledger(stages[1])).where("kept").collect()}
    assert {r.doc_id for r in stages[2].collect()} == kept


def test_filters_keep_good_documents(spark, stages):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert not good - {r.doc_id for r in stages[1].collect()}
    long = {r.doc_id for r in quality_rules.ledger(stages[0]).where("n_words >= 50").collect()}  # shorter ones fail the base rules
    assert len((good & long) - {r.doc_id for r in stages[2].collect()}) <= 0.01 * len(good)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_copies_go(stages):
    """Against all pairs: no near copy stays beside its like, and nothing goes without one."""
    before = sorted((r.doc_id, shingles(r.text)) for r in stages[2].select("doc_id", "text").collect())
    kept = {r.doc_id for r in stages[3].collect()}
    index = {}
    for doc, s in before:
        for x in s:
            index.setdefault(x, []).append(doc)
    sets = dict(before)
    pairs = {(a, b) for docs in index.values() if 1 < len(docs) < 200 for i, a in enumerate(docs) for b in docs[i + 1 :]}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs}
    assert not [p for p, j in like.items() if j >= 0.8 and p[0] in kept and p[1] in kept]
    near = {x for p, j in like.items() if j >= 0.8 for x in p}
    assert {d for d, _ in before} - kept <= near


def test_repeats_go(stages):
    first = {}
    kept = {r.doc_id: r for r in stages[4].collect()}
    for r in sorted(stages[3].collect(), key=lambda r: r.doc_id):
        text = r.text.encode()
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if first.setdefault(text[p : p + 50], r.doc_id) < r.doc_id:
                gone[p : p + 50] = b"\1" * 50
        edges = np.flatnonzero(np.diff(np.frombuffer(bytes(gone), np.uint8), prepend=0, append=0)).reshape(-1, 2).tolist() if text else []
        want = suffix_dedup.without(text, suffix_dedup.whole_characters(text, edges)).decode()
        assert kept[r.doc_id].text == want and kept[r.doc_id].n_chars == len(want)


def test_packing_takes_all(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4].collect()}
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_odd_rows_and_nothing(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (2, "", None, "a", None), (None, "a b c " * 60, "en", None, 360), (3, "Some plain words stand in a row here. " * 3, "en", "a", 114)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, f in corpus_pipeline.STAGES:
            docs = materialise(f(spark, docs, str(tmp_path)), "odd")
            docs.count()


def test_entry_lives_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['habitra.llm'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; q = e.queries(); assert 'chip_features_wide' in q and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    subprocess.run([sys.executable, "-c", code % str(ROOT)], check=True)
