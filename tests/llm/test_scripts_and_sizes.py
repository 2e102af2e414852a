"""Sentence ends of many scripts, sizes by which work is dealt, encoders that differ, and accuracy on held-out rows."""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers
import pytest

from geomill.llm import bpe, exact_dedup, language_id, line_clean, quality_rules, source_mix

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.01"
ENDS = {
    "hi": "यह एक छोटा सा वाक्य है।", "ar": "هل هذه جملة قصيرة من اللغة؟", "ur": "یہ ایک چھوٹا سا جملہ ہے۔", "hy": "Սա մի կարճ նախադասություն է։", "am": "ይህ አጭር አረፍተ ነገር ነው።",
    "th": "นี่คือ ประโยค สั้น ๆ ภาษาไทย", "my": "ဒါက တို တောင်း သော ဝါကျ ပါ။", "km": "នេះ គឺ ជា ប្រយោគ ខ្លី។", "el": "Είναι μια μικρή πρόταση;", "en": "This is one short sentence.", "ja": "これ は 短い 文 です。",
}


@pytest.mark.parametrize("lang", sorted(ENDS))
def test_sentence_ends_of_scripts(lang):
    line = ENDS[lang]
    assert not line_clean.line_fails(line, len(line.split()))
    if lang != "th":
        assert line_clean.line_fails(line[:-1], len(line.split()))
    if lang not in ("th", "el"):  # a Greek question ends like a clause elsewhere
        assert not line_clean.line_fails(line + " " + line[:-1], 40)  # a long line in which a sentence ends


def test_documents_of_scripts_are_kept(spark):
    rows = [(k, "\n".join(f"{n} {ENDS[lang]}" for n in range(40))) for k, lang in enumerate(sorted(ENDS))]
    got = line_clean.line_figures(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.kept or r.base_failed} == {k for k, _ in rows} and sum(r.n_removed_lines for r in got) == 0


def test_encoders_that_differ(monkeypatch):
    model = bpe.Bpe(PATH)
    texts = [f"text {k} of the batch" for k in range(200)]
    want = [model.library(t) for t in texts]
    assert [i.tolist() for i in model.encode_all(texts)] == want
    monkeypatch.setattr(model, "encode", lambda t: np.array([1, 2], model.dtype))
    assert [i.tolist() for i in model.encode_all(texts)] == want
    # a batch whose first text agrees is found out by its sample
    monkeypatch.setattr(model, "encode", lambda t: np.array(want[0] if t == texts[0] else [3], model.dtype))
    assert [i.tolist() for i in model.encode_all(texts)] == want
    assert model.encode_all([]) == []


def test_snapshot_keeps_its_number_of_buckets(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(k, f"text {k % 40}") for k in range(60)], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup, "PER_BUCKET", 8)
    exact_dedup.build_snapshot(docs.filter("doc_id < 40")).save(str(tmp_path / "s"))
    monkeypatch.setattr(exact_dedup, "PER_BUCKET", 1000)
    snapshot = exact_dedup.load_snapshot(spark, str(tmp_path / "s"))
    assert snapshot.n_buckets == 5
    assert sum(r.kept for r in exact_dedup.exact_dedup(docs.filter("doc_id >= 40"), snapshot).collect()) == 40


def test_mix_is_dealt_by_size(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "x" * 100, "a" if k % 3 else "b") for k in range(300)], "doc_id long, text string, source string")
    few = source_mix.mix_sources(docs)
    monkeypatch.setattr(source_mix, "PER_TASK", 1000)
    many = source_mix.mix_sources(docs)
    assert few.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and many.rdd.getNumPartitions() >= 20
    key = lambda df: sorted((r.doc_id, r._copy, r._shuffle_key) for r in df.collect())
    assert key(few) == key(many)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in language_id.op8_language_id(spark, SF_DIR).collect() if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert len(rows) > 100 and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in quality_rules.op9_quality_rules(spark, SF_DIR).collect() if r.held_out and label.get(r.doc_id) is not None]
    assert len(rows) > 20 and sum(r.predicted == label[r.doc_id] for r in rows) >= 0.9 * len(rows)
