import os

import pytest
from pyspark.sql import functions as F

from textloom.operators import clean
from textloom.sources import articles as A
from textloom.sources import results as R

ENTITY = (
    '[{"Label": "City Open", "Type": "O", "WikidataId": "Q1234", "Confidence": 1.0, '
    '"OccurrenceOffsets": [0, 7], "SurfaceForms": ["City Open"]}]'
)


@pytest.fixture
def news(tmp_path):
    lines = [
        ["N1", "sports", "tennis", 'City "Open" winners', "Some pictures.", "u", ENTITY, ""],
        ["N2", "sports", "tennis", '"quoted ""in"" title"', '"two\nlines"', "u", "[]", ""],
        ["N3", "music", "pop", "NA", "abstract", "u", "", ""],
        ["N4", "music", "pop", "title", "", "u", "null", ""],
    ]
    path = tmp_path / "train_small"
    path.mkdir()
    (path / "news.tsv").write_text("\n".join("\t".join(x) for x in lines) + "\n")
    return tmp_path


def test_missing_values_quotes_and_line_breaks(spark, news):
    df = A.read_articles(spark, A.split_path(str(news), "train"))
    rows = {r["id"]: r for r in df.collect()}
    assert df.columns == A.ARTICLE_COLUMNS
    assert rows["N1"]["title"] == 'City "Open" winners'
    assert rows["N2"]["title"] == 'quoted "in" title'
    assert rows["N2"]["abstract"] == "two\nlines"
    assert rows["N3"]["title"] is None and rows["N4"]["abstract"] is None
    assert [r["id"] for r in clean.working_table(df).orderBy("id").collect()] == ["N1", "N2"]


def test_splits_by_size_and_missing_split(spark, news):
    with pytest.raises(FileNotFoundError, match="validation"):
        A.load_splits(spark, str(news))
    os.makedirs(news / "validation_small")
    os.link(news / "train_small" / "news.tsv", news / "validation_small" / "news.tsv")
    train, test = A.load_splits(spark, str(news))
    assert train.count() == test.count() == 4
    with pytest.raises(ValueError):
        A.split_path(str(news), "dev")


def test_entities_become_rows(spark, news):
    df = A.read_articles(spark, A.split_path(str(news), "train"))
    rows = {r["id"]: r for r in A.entity_rows(df).collect()}
    assert len(rows) == 4
    assert rows["N1"]["label"] == "City Open" and rows["N1"]["occurrence_offsets"] == [0, 7]
    assert rows["N3"]["label"] is None


def test_results_are_appended(spark, tmp_path):
    path = str(tmp_path / "results")
    R.write_results(R.result_rows(spark, [("a", 0.5, 0.4, 0.1)]), path)
    R.write_results(R.result_rows(spark, [("b", 0.6, 0.5, 0.2)]), path)
    assert {r["model"] for r in R.read_results(spark, path).collect()} == {"a", "b"}


def test_merge_has_no_separator_unless_given(spark):
    df = spark.createDataFrame([(1, "ends", "Starts")], "id int, title string, abstract string")
    assert clean.merge_text(df).first()["text"] == "endsStarts"
    assert clean.merge_text(df, separator=" ").first()["text"] == "ends Starts"


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = [("1", "music", "s", "t", "a", "u", "e", "e")]
    spark.createDataFrame(rows, A.ARTICLE_SCHEMA).write.parquet(path)
    df = clean.working_table(spark.read.parquet(path), ["music", "sports"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(category" in plan and "IsNotNull(title)" in plan
    assert "url" not in plan.split("ReadSchema")[1]


def test_split_keeps_copies_together(spark):
    df = spark.range(1000).withColumn("text", (F.col("id") % 100).cast("string"))
    split = clean.hash_split(df, fraction=0.8)
    assert split.groupBy("text").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert 0.65 < split.filter("split = 'train'").count() / 1000 < 0.95


def test_whole_split_takes_every_hash(spark):
    df = spark.range(70000).withColumn("text", F.col("id").cast("string"))
    assert clean.hash_split(df, fraction=1.0).filter("split = 'test'").count() == 0
