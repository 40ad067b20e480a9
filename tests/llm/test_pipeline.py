"""The pipeline's stages, each on what its predecessor kept, and the queries that SQL can express."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from compare import connect, differences  # noqa: E402
from test_texts import WORD, cut, near_truth  # noqa: E402

import corpus_pipeline  # noqa: E402
from fleetspan.llm.queries import oracle_sql, queries  # noqa: E402
from fleetspan.plans.shared import staged  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracles(spark, sf_dir, name):
    errors, _ = differences(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name])
    assert not errors


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs = staged(stage(spark, docs, FOLDER), name)
        if name != "encoding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {name: [(r["doc_id"], r["text"]) for r in df.collect()] for name, df in kept.items() if name != "encoding"}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = {i for i, _ in rows["quality"]}
    assert sum(labels[i] == 0 for i in good if i in labels) <= 3 and sum(q == 1 for i, q in labels.items() if i not in good) <= 3
    truth = near_truth(rows["quality"], 5)
    assert Counter(i for i, _ in rows["near_dedup"]) == Counter({i: 1 for i, _, _, own in truth if own})
    want = Counter((i, " ".join(k)) for (i, _), (_, k) in zip(rows["near_dedup"], cut([t for _, t in rows["near_dedup"]], 35), strict=True))
    assert Counter((i, " ".join(WORD.findall(t or ""))) for i, t in rows["substring_dedup"]) == want
    assert {i for i, _ in rows["mixing"]} <= {i for i, _ in rows["substring_dedup"]}
    assert max(Counter(i for i, _ in rows["mixing"]).values()) <= 3
    assert kept["encoding"].count() == len(rows["mixing"])


def test_awkward_documents(spark, awkward, nothing):
    for df in (awkward, nothing):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, FOLDER), name)
            assert name == "encoding" or docs.columns == df.columns


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 50
