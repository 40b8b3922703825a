"""Bounds of memory and of the words' cost that the check found missed."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm import nbest, winnowing
from panelcast.llm.pieces import load


def test_an_encoder_remembers_no_more_than_it_is_told_and_finds_the_same():
    v = load(nbest.MODEL)
    small, large = nbest.Encoder(v, 4, 20), nbest.Encoder(v, 4)
    texts = [" ".join(f"w{i}x{k} the house, {k * i}" for k in range(9)) for i in range(40)]
    assert [small.segment(t) for t in texts] == [large.segment(t) for t in texts]
    for memo in (small.best, small.more, small.part):
        assert len(memo) <= 20 and len(memo.old) <= 20


def test_the_pipeline_bounds_its_encoders(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(nbest, "report", lambda docs, **k: asked.update(k))
    corpus_pipeline.encoding(spark, None, "")
    assert asked["remembered"] < nbest.CHUNKS


def test_words_are_cut_not_extracted_and_are_the_contracts(spark):
    texts = ["", " ", "a", ",a", "a,", "..A b-C9..", "Él É0 ÀB c d", "x\x7fy\x80z\x00\n", "😀Z 😀", "İK ſ", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words, count = winnowing.words_of(F.col("text")), winnowing.word_count(F.col("text"))
    got = {r["text"]: (r["w"], r["n"]) for r in df.select("text", words.alias("w"), count.alias("n")).collect()}
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for t in texts:
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(upper))
        assert got[t] == (want, len(want)), t
    plan = df.select(words, count)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
