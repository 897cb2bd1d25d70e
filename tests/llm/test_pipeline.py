"""The pipeline's stages on planted and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from synonymy.sources.shared import clear

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents, labels and a benchmark that hold what each stage should catch."""
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(words, n))
    item = text(40)
    rows = [(i, text(60)) for i in range(300)]
    rows += [(1000 + i, text(30) + " slurword otherslur " + text(10)) for i in range(60)]
    copy = text(80)
    rows += [(2000, copy), (2001, copy), (2002, copy + " tail"), (2003, copy.replace(copy.split()[40], "edit", 1))]
    rows += [(3000, text(20) + " " + item + " " + text(20)), (3001, item)]
    rows += [(4000, "reach me at jane@mail.example.org or 10.1.2.3 today")]
    rows += [(5000, None), (5001, ""), (5002, " \t"), (None, "no id here at all for this one"), (None, None), (6000, "one text"), (6000, "another text of the same id"), (6000, "one text")]
    folder = str(tmp_path_factory.mktemp("tables"))
    d = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    d.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labelled = [(i, 0, int(i >= 1000)) for i, _ in rows if i is not None and i < 2000]
    spark.createDataFrame(labelled, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


def test_stages_catch_what_is_planted(spark, tables):
    d = spark.read.parquet(f"{tables}/documents.parquet")
    every = ids(d)
    got = ids(STAGES["toxicity"](spark, d, tables))
    assert got == [i for i in every if i is None or not 1000 <= i < 2000]
    got = ids(STAGES["near_duplicates"](spark, d, tables))
    assert got == sorted({i for i in every if i is not None} - {2001, 2002, 2003}) + [None, None]
    assert ids(STAGES["decontamination"](spark, d, tables)) == [i for i in every if i not in (3000, 3001)]
    clean = STAGES["personal_data"](spark, d, tables)
    assert ids(clean) == every and clean.columns == d.columns
    r = clean.where("doc_id = 4000").first()
    assert r.text == "reach me at [EMAIL] or [IP] today" and r.n_chars == len(r.text)
    assert clean.where("doc_id = 5000").first().text is None


def test_run_keeps_what_no_stage_rejects(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    want = {i for i in ids(spark.read.parquet(f"{tables}/documents.parquet")) if i is not None and not 1000 <= i < 2000 and i not in (2001, 2002, 2003, 3000, 3001)}
    rows = got.collect()
    assert {r.doc_id for r in rows if r.doc_id is not None} == want and any(r.doc_id is None for r in rows)
    clear(spark)


def test_stages_take_empty_tables(spark, tables):
    none = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, tables).count() == 0, name
