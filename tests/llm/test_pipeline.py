"""The pipeline against its stages' rules on documents made for each of them."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from visitry.llm import bpe
from visitry.llm.catalog import ORACLES, QUERIES, vocabulary_path


def folder_of(spark, path, docs, labels, items):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, extra string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, tmp_path):
    rnd = random.Random(13)
    word = lambda: rnd.choice(["the", "of", "and", "river", "tree", "light"]) + str(rnd.randrange(500)) * (rnd.random() < 0.6)
    good = {k: " ".join(word() for _ in range(80)) for k in range(200)}
    junk = {1000 + k: " ".join(word() + "***" for _ in range(80)) for k in range(60)}
    item = " ".join(word() for _ in range(30))
    more = {2000: good[3], 2001: good[4] + " ", 2002: good[5] + " " + item, 2003: " ".join(word() for _ in range(80)) + " mail a.b@c.org now", 2004: None}
    more[2005] = more[2003].replace("river", "stream")
    docs = [(i, t, "en", "s", len(t or ""), "x") for i, t in {**good, **junk, **more}.items()]
    labels = [(k, 1, 0) for k in good] + [(k, 0, 0) for k in junk]
    path = folder_of(spark, tmp_path, docs, labels, [(1, item)])
    frame = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, frame = frame.columns, stage(spark, frame, path)
        assert frame.columns == before
        kept[name] = {r["doc_id"]: r for r in frame.collect()}
    assert set(kept["quality"]) & set(junk) == set() and set(good) <= set(kept["quality"])
    assert set(kept["quality"]) - set(kept["near_duplicates"]) >= {2000, 2001} and set(good) <= set(kept["near_duplicates"])
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {2002}
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    row = kept["personal_data"][2003]
    assert row["text"].endswith(" mail <EMAIL> now") and row["n_chars"] == len(row["text"]) and row["extra"] == "x"
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(last) == set(kept["personal_data"])
    encoder = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()))
    for i, r in last.items():
        assert encoder.decode(r["ids"]) == (kept["personal_data"][i]["text"] or "") and r["n_tokens"] == len(r["ids"])


def test_empty_documents(spark, tmp_path):
    path = folder_of(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, path).collect() == []


def test_near_copies_go(spark, tmp_path):
    """Copies of 200 words with one or two words changed are near copies; texts of their own are not."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(4000)}"
    own = {k: [word() for _ in range(200)] for k in range(60)}
    rows = [(k, " ".join(t)) for k, t in own.items()]
    for k in range(60):
        for copy, changed in ((1, 1), (2, 2), (3, 2)):
            t = list(own[k])
            for place in rnd.sample(range(200), changed):
                t[place] = word()
            rows.append((1000 * copy + k, " ".join(t)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, `a.b` string")
    kept = corpus_pipeline.near_duplicates(spark, docs.withColumn("later", docs["doc_id"]), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60)) and kept.columns == [*docs.columns, "later"]


def test_names_of_any_kind_pass_through(spark, tmp_path):
    docs = [(k, f"the quick river of light number {k} and a tree", "en", "s", 9, "x") for k in range(30)]
    path = folder_of(spark, tmp_path, docs, [(k, k % 2, 0) for k in range(30)], [(1, "no such passage is in any of these texts at all")])
    frame = spark.read.parquet(f"{path}/documents.parquet").withColumnsRenamed({"extra": "a.b"}).withColumn("added", F.lit("kept")).withColumn("__added", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, frame = frame.columns, stage(spark, frame, path)
        assert frame.columns == before
        assert {r["added"] for r in frame.select("added").collect()} <= {"kept"}


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
