"""The pipeline's stages on awkward rows, and each against what it must do."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from murmuration.llm import queries

SF = "/root/testdata/sf0.001"
#: Large enough to learn from.
LABELLED = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdefghijk") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    long = [" ".join(draw.choice(words) for _ in range(300)) for _ in range(12)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    near = long[0].split()
    near[150] = "changed"
    rows = [(i, t) for i, t in enumerate(long)] + [
        (20, " ".join(near)), (21, long[1]), (21, long[1]), (22, None), (23, ""), (24, None), (None, long[2]), (None, "nothing else"),
        (25, f"{long[3][:700]} {item} and more"), (26, "short"), (27, "x" * 3000), (28, f"start {long[4][100:400]} end")]
    return spark.createDataFrame([(i, t, "en", "src", -1, 1, "k", 2) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row_of_stage int, k1 string, spans int")


def _ids(df) -> set:
    return {(r.doc_id, r.text) for r in df.collect()}


def test_stages_keep_the_columns_and_take_empty_tables(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), SF)
        assert out.count() == 0, name
        if name != "best_fit_packing":
            assert out.schema.simpleString() == docs.schema.simpleString()


def test_near_duplicates(spark, docs):
    kept = [(r.doc_id, r.text) for r in STAGES["simhash_near_dedup"](spark, docs, SF).collect()]
    ids = [i for i, _ in kept]
    assert 0 in ids and 20 not in ids  # one word changed
    assert ids.count(1) == 1 and 21 not in ids  # copies, and repeated rows
    assert 2 in ids and len([t for i, t in kept if i is None]) == 1  # the id that is not null stays
    assert 22 in ids and 23 not in ids and 24 not in ids  # texts without words
    assert {3, 4, 5, 6, 7, 8, 9, 10, 11, 25, 26, 27, 28} <= set(ids)


def test_repeats_are_cut(spark, docs):
    cut = {r.doc_id: r for r in STAGES["suffix_array_dedup"](spark, docs, SF).collect() if r.doc_id not in (None, 21)}
    assert cut[28].text == "start  end" and cut[28].n_chars == len(cut[28].text)
    assert cut[22].text is None and cut[22].n_chars == -1 and cut[26].text == "short" and cut[27].text == ""
    assert cut[5].n_chars == len(cut[5].text) > 500


def test_leaks(spark, docs):
    before, after = _ids(docs), _ids(STAGES["benchmark_decontamination"](spark, docs, SF))
    assert {i for i, _ in before - after} == {25}


def test_toxic_documents_go(spark, docs):
    given = spark.read.parquet(f"{LABELLED}/documents.parquet").select("doc_id", "text")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LABELLED}/labels.parquet").where("toxic is not null").collect()}
    kept = {r.doc_id for r in STAGES["toxicity"](spark, given, LABELLED).collect()}
    toxic, clean = {i for i, t in labels.items() if t}, {i for i, t in labels.items() if not t}
    # From some forty toxic texts not all words can be learnt.
    assert len(toxic & kept) < 0.5 * len(toxic) and len(clean & kept) >= 0.98 * len(clean)
    empty = docs.where("coalesce(text, '') = ''")
    after = _ids(STAGES["toxicity"](spark, given.unionAll(empty.select("doc_id", "text")), LABELLED))
    assert {(22, None), (23, ""), (24, None)} <= after


def test_texts_without_characters_stay_where_most_texts_are_toxic(spark, tmp_path):
    spark.read.parquet(f"{LABELLED}/labels.parquet").withColumn("toxic", 1 - F.col("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    given = spark.read.parquet(f"{LABELLED}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame([(-5, None), (-6, "")], "doc_id long, text string"))
    assert {(-5, None), (-6, "")} <= _ids(STAGES["toxicity"](spark, given, str(tmp_path)))


def test_near_duplicates_do_not_depend_on_the_executors_alive(spark, tmp_path, monkeypatch):
    """Parallelism, which decides how files become partitions, changes between the stage's reads."""
    path = f"{tmp_path}/docs"
    spark.read.parquet(f"{SF}/documents.parquet").repartition(13).write.parquet(path)
    expected = sorted(r.doc_id for r in STAGES["simhash_near_dedup"](spark, spark.read.parquet(path), SF).collect())
    groups = corpus_pipeline.similar.groups

    def then_more(*args):
        found = groups(*args)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 9)
        return found

    monkeypatch.setattr(corpus_pipeline.similar, "groups", then_more)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", 2)
    try:
        found = sorted(r.doc_id for r in STAGES["simhash_near_dedup"](spark, spark.read.parquet(path), SF).collect())
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert found == expected


def test_run_packs_what_is_left(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    total = {}
    for r in found:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert found and max(total.values()) <= queries.SEQUENCE
    assert len({(r.doc_id, r.piece) for r in found}) == len(found)
