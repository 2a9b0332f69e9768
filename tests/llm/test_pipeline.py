"""Registered queries against SQL, and the pipeline against plain versions of its stages."""

import weakref

import brute
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import compare, connect
from eventloom.llm import packing, queries, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_one_query_for_each_operator():
    names = sorted(queries.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert {*names, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    assert compare(spark, duck, name, SF) == ""


def docs_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    names = docs.columns
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.quality_rules, stages.near_dedup, stages.suffix_dedup, stages.decontamination, stages.packing_stage
    ]
    good = stages.quality_rules(spark, docs, SF)
    kept = {r.doc_id for r in good.collect()}
    base = {d for d, t in docs_of(docs) if not brute.quality(t)[-1]}
    assert kept <= base and len(kept) > 0.8 * len(base)

    one = stages.near_dedup(spark, good, SF)
    assert sorted((r.doc_id for r in one.collect()), key=repr) == brute.kept_of_similar(docs_of(good))

    plain = stages.suffix_dedup(spark, one, SF).cache()
    assert brute.ordered(docs_of(plain)) == brute.ordered(brute.without_repeats(docs_of(one)))
    assert plain.where("n_chars != length(text)").count() == 0

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = stages.decontamination(spark, plain, SF).cache()
    judged = brute.leaks(docs_of(plain), items)
    assert {d for d, *_ in docs_of(clean)} == {d for d, n, hit, *_ in judged if hit <= 0.5 * n}
    untouched = {d for d, _, hit, *_ in judged if not hit}
    before = dict(docs_of(plain))
    assert all(before[d] == t for d, t in docs_of(clean) if d in untouched)
    for stage in (good, one, plain, clean):
        assert stage.columns == names

    pieces = stages.packing_stage(spark, clean, SF).collect()
    whole = {r.doc_id: r.doc_tokens for r in pieces}
    assert set(whole) == {d for d, _ in docs_of(clean)}
    assert sum(r.length for r in pieces) == sum(whole.values())


def test_run_gives_the_last_stage(spark):
    assert "ids_crc32" in corpus_pipeline.run(spark, SF).columns


def test_packing_stage_leaves_no_words_behind(spark):
    texts = [f"word{n} Übung, tail{n % 7}. " * 40 for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id").cache()
    kept = sorted(map(tuple, packing.pack(docs, remembered=1 << 14).collect()))
    assert sorted(map(tuple, packing.pack(docs, remembered=1 << 14, outlives=False).collect())) == kept
    with open(packing.default_tokenizer(), encoding="utf-8") as definition:
        encoder = packing.Encoder(definition.read())
    list(encoder.encode([texts[0].encode()]))
    held = weakref.ref(encoder)
    encoder.forget()
    del encoder
    assert held() is None  # gone without a collection of cycles


def test_stages_hand_rows_over_in_small_batches(spark):
    docs = spark.range(64).selectExpr("id AS doc_id", "repeat('x', 1000000) AS text").coalesce(1)
    before = spark.conf.get(stages.BATCH_BYTES, None)
    try:
        spark.conf.unset(stages.BATCH_BYTES)
        stages.quality_rules(spark, docs, SF)
        sizes = docs.mapInArrow(
            lambda batches: (pa.record_batch({"n": [batch.nbytes]}) for batch in batches), "n long"
        ).collect()
        assert max(row.n for row in sizes) <= 6_000_000 and len(sizes) > 10
        spark.conf.set(stages.BATCH_BYTES, "16m")
        stages.quality_rules(spark, docs, SF)
        assert spark.conf.get(stages.BATCH_BYTES) == "16m"
    finally:
        spark.conf.unset(stages.BATCH_BYTES) if before is None else spark.conf.set(stages.BATCH_BYTES, before)
