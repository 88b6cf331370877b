"""The stages one by one, each against what its operator decides, and as a whole."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from curbline.llm import labelled, packing, quality, setsketch, toxicity
from curbline.llm.frames import parted_by_ids, stored, table

SF = "/root/testdata/sf0.001"


def test_stages_filter_and_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stored(stage(spark, docs, SF), f"test-{name}")
        assert got.columns == docs.columns and 0 < got.count() <= docs.count()
        kept, rows = {r.doc_id for r in got.collect()}, docs.collect()
        assert all(r in set(rows) for r in got.collect())
        if name == "toxicity":
            grammar = toxicity.fit(docs, labels)
            scores = docs.select("doc_id", toxicity.score(F.col("text"), grammar).alias("s")).collect()
            assert kept == {r.doc_id for r in scores if r.s < 0.7}
        elif name == "quality":
            model = quality.fit(docs, labels)
            scores = docs.select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()
            assert kept == {r.doc_id for r in scores if r.s >= 0.7}
        else:
            assert kept == {r.doc_id for r in setsketch.near_duplicates(docs, 80).where("kept").collect()}
        docs = got
    packed = corpus_pipeline.pack(spark, docs, SF)
    total = packing.lengths(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).agg(F.sum("length")).first()[0]
    assert packed.agg(F.sum("length")).first()[0] == total
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_one_row_of_each_group_stays(spark, odd_docs, odd_texts):
    got = corpus_pipeline.drop_near_duplicates(spark, odd_docs, SF)
    assert got.columns == odd_docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i, _ in odd_texts if i is not None})
    assert ids.count(None) == sum(i is None for i, _ in odd_texts)


@pytest.mark.parametrize("labels", [[], [(i, 0, 0) for i in range(30)], [(i, i % 2, 0) for i in range(4)], [(10_000 + i, i % 2, 0) for i in range(60)]])
def test_quality_without_evidence_keeps_all_rows(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, f"text {i}. " * (i + 1)) for i in range(30)], "doc_id long, text string")
    assert sorted(corpus_pipeline.drop_poor(spark, docs, str(tmp_path)).collect()) == sorted(docs.collect())


def test_toxic_labels_alone_drop_no_clean_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"plain text {i}") for i in range(60)], "doc_id long, text string")
    docs.selectExpr("doc_id", "1 quality", "1 toxic").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 60


def test_the_sample_is_chosen_among_labels_of_the_documents(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    got = labelled.fit_sample(docs, labels, "quality", 4, 2, rows=20).collect()
    assert len(got) == 20 and all(r.text == f"text {r.doc_id}" and r.label == r.doc_id % 2 for r in got)


def test_an_empty_table_stays_empty(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def shuffled(plan: str) -> list[str]:
    """What is below each hash shuffle of a plan."""
    lines = [line for line in plan.splitlines() if "#" in line]
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    found = []
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
            found.append("\n".join(lines[at:end]))
    return found


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_texts_that_stay_are_not_shuffled(spark, no_broadcast, capsys):
    texts = [(i, " ".join(f"w{i * 31 + k}" for k in range(40))) for i in range(500)]
    docs = stored(spark.createDataFrame([*texts, *((1000 + i, t) for i, t in texts[:20])], "doc_id long, text string"), "docs")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    left.explain()
    of_texts = [part for part in shuffled(capsys.readouterr().out) if "text#" in part]
    assert of_texts and all("LeftSemi" in part for part in of_texts)
    assert sorted(map(tuple, left.collect())) == texts


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 24])
def test_rows_are_parted_by_ids(spark, no_broadcast, with_clashes, bits):
    rows = with_clashes(spark.createDataFrame([(i if i % 50 else None, str(i)) for i in range(2000)], "`a.b` long, mark string"))
    ids = spark.createDataFrame([(i,) for i in [None, *range(1, 4000, 200), 5_000_000_000]], "word long")
    few, rest = parted_by_ids(rows, "a.b", ids, bits)
    assert few.columns == rest.columns == rows.columns
    few, rest = ([r.mark for r in part.select("mark").collect()] for part in (few, rest))
    assert sorted(few + rest, key=int) == [str(i) for i in range(2000)]
    assert {str(i) for i in range(1, 2000, 200)} <= set(few)
    assert len(few) < {64: 2000, 1 << 10: 200, 1 << 24: 60}[bits]
