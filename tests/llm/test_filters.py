"""Quality, decontamination and the pipeline as a whole."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelens.llm import decontaminate, weak_quality
from tests.llm.docs import SCHEMA, documents, frame, words

SF_DIR = "/root/testdata/sf0.01"


def test_em_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(40_000) < 0.2
    right = np.array([0.95, 0.8, 0.7])
    votes = np.where(rng.random((40_000, 3)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((40_000, 3)) < 0.3] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post, known, prior = weak_quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(prior - 0.2) < 0.03
    assert np.allclose(known[:, 1, 2] / known[:, 1, 1:].sum(axis=1), right, atol=0.06)
    # The posterior of a pattern by Bayes' rule from the true accuracies.
    for p, got in zip(patterns, post, strict=True):
        like = [np.prod([1.0 if v < 0 else (r if v == c else 1 - r) for v, r in zip(p, right, strict=True)]) for c in (0, 1)]
        assert abs(got - 0.2 * like[1] / (0.2 * like[1] + 0.8 * like[0])) < 0.12


def test_scorer_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    model = weak_quality.fit(docs, labels.where(~held))
    assert min(model.accuracies["quality"].values()) > 0.6
    got = weak_quality.scored(docs, model).select("doc_id", "bad_quality", "bad_toxic").join(labels.where(held), "doc_id").toPandas()
    toxic, found = got["toxic"] == 1, got["bad_toxic"] >= 0.5
    assert found[toxic].mean() > 0.93 and found[~toxic].mean() < 0.01
    poor, found = got["quality"] == 0, got["bad_quality"] >= 0.5
    assert found[poor].mean() > 0.85 and found[~poor].mean() < 0.02


def test_quality_of_hard_cases(spark):
    docs = frame(spark).withColumn("bad_toxic", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(0, 1, 0), (0, None, 1), (None, 0, 0), (3, 0, None)], none.schema)
    for labels in (none, some):
        got = weak_quality.judgements(docs, labels)
        assert got.count() == len(documents()) and got.where("rejected is null").count() == 0
        assert weak_quality.judgements(docs.limit(0), labels).count() == 0
    assert weak_quality.accepted(docs, some).columns == ["doc_id", "text", "lang", "source", "n_chars"]


ITEM = "So Anna has 5 km to walk before Peter sees 7 cats near the old river bank today"
TEXTS = {
    1: ITEM,
    2: "Prose before. So Maria has 9 miles to walk before John Smith sees 8 cats near the old river bank today, and after.",
    3: "So the boy has a long way to walk before noon and sees cats near his house today",
    4: "",
    5: None,
    6: "THE!! OLD!! RIVER!! BANK!! TODAY!! " * 5,
    7: words(random.Random(1), 3000),
    8: "Old river bank today",
}


def test_templates(spark):
    docs = spark.createDataFrame([*TEXTS.items(), (2, TEXTS[2]), (None, ITEM)], "doc_id bigint, text string").withColumn("id", F.lit("clash"))
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (None, ITEM)], "item_id bigint, text string")
    got = decontaminate.leak_digest(docs, items).collect()
    assert sorted((r["doc_id"] or 0) for r in got if r["contaminated"]) == [0, 1, 2, 2] and len(got) == 10
    assert all(r["item_ids"] == ([1] if r["contaminated"] else []) for r in got)
    assert decontaminate.leak_digest(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.leak_digest(docs.limit(0), items).count() == 0
    assert decontaminate.without_leaks(docs, items).columns == docs.columns


def test_slots_must_be_consistent(spark):
    item = "take 3 red stones and put 3 red stones near 4 big trees"
    texts = ["take 7 red stones and put 7 red stones near 9 big trees", "take 7 red stones and put 8 red stones near 9 big trees"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.leak_digest(docs, items).collect()}
    assert got == {0: True, 1: False}


def test_names_that_open_sentences(spark):
    item = "Anna bought 5 red apples today. Peter ate 3 of them quickly. Maria took the rest home again."
    other = item.replace("Anna", "Olga").replace("Peter", "Ivan").replace("Maria", "Nina").replace("5", "8")
    mixed = "He said this. " + other + " And so on."
    one_name = item.replace("Anna", "Olga").replace("Peter", "Olga")  # two names of the item stand for one: still each for one
    texts = {1: item, 2: mixed, 3: one_name, 4: "Anna bought a house today. Peter ate well. Maria took a walk."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.leak_digest(docs, items).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False}


def test_short_and_dense_items(spark):
    items = {1: "Who wrote Hamlet?", 2: "What is 12 + 5 * 3 - 4 / 2?", 3: "", 4: "...", 5: "Solve x"}
    texts = {
        10: "Before. who wrote HAMLET, they ask", 11: "Who wrote it? Hamlet", 12: "so what is 12 + 5 * 3 - 4 / 2 then", 13: "what is 12 + 5 * 3 - 4 / 9",
        14: "Who wrote", 15: None, 16: "we solve X here", 17: "Hamlet " * 3000,
    }
    docs = spark.createDataFrame([*texts.items(), (None, "Who wrote Hamlet")], "doc_id bigint, text string")
    rows = spark.createDataFrame([*items.items(), (6, None), (1, items[1])], "item_id bigint, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.leak_digest(docs, rows).collect()}
    assert got == {10: [1], 11: [], 12: [2], 13: [], 14: [], 15: [], 16: [5], 17: [], None: [1]}


def test_parameterised_items_by_brute_force(spark):
    """Items with other numbers and names are found, wherever the names stand; other texts are not."""
    rng = random.Random(9)
    people = ["Anna", "Boris", "Carla", "Dmitri", "Eva", "Farid", "Greta", "Hugo"]
    frames = [
        "{0} has {a} coins and gives {b} of them to {1}. {1} then buys a very small red kite for {a} coins.",
        "A train leaves at {a} hours and {0} walks {b} km to meet it. {0} is late by {a} minutes today.",
        "{0} paints {a} doors each week. How many doors does {0} paint together with {1} within {b} weeks?",
    ]
    made = [(k, f, rng.sample(people, 2), rng.sample(range(2, 90), 2)) for k, f in enumerate(frames * 4)]
    items = [(k, f.format(*n, a=v[0], b=v[1])) for k, f, n, v in made[:3]]
    docs = [(k, "Some prose goes first. " + f.format(*n, a=v[0], b=v[1]) + " " + words(rng, 20)) for k, f, n, v in made]
    docs += [(100 + k, words(rng, 60)) for k in range(20)]
    got = decontaminate.leak_digest(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {i: ([i % 3] if i < 100 else []) for i, _ in docs}


def test_leaks_against_search(spark):
    docs, items = (pd.read_parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.leak_digest(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    found = {r["doc_id"] for r in got.where("contaminated").collect()}
    assert found == {i for i, t in zip(docs["doc_id"], docs["text"], strict=True) if any(x in t for x in items["text"])}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
    kept = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "ids").toPandas()
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").merge(kept, how="left", on="doc_id", indicator=True)
    stays = labels["_merge"] == "both"
    assert stays[labels["toxic"] == 1].mean() < 0.1 and stays[labels["quality"] == 0].mean() < 0.1
    assert kept["doc_id"].is_unique and len(kept) > 600


@pytest.mark.parametrize("rows", [documents(), []])
def test_pipeline_stages_on_hard_cases(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("rid", F.lit(1))
    path = str(tmp_path / "documents")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert set(out.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}, name
        assert out.count() <= len(rows)
    assert "ids" in corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).columns
    kept = corpus_pipeline.STAGES[1][1](spark, docs, SF_DIR).collect()
    assert sum(r["doc_id"] == 7000 for r in kept) <= 1
