"""The pipeline stage by stage, and all queries of the subpackage over the given tables."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from compare import connect, duck_rows, spark_rows
from llm_path import cases
from test_llm_texts import _without_repeats
from test_llm_vectors import _groups, _simhash

import __spark_entry__ as driver
import corpus_pipeline
from feedloom.llm import mixing, quality_mil
from feedloom.llm.queries import ORACLES, QUERIES
from feedloom.plans.staging import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outcome(spark):
    """Documents before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF), "tested"))
    return out


def _rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_keep_the_columns(outcome):
    assert len(corpus_pipeline.STAGES) == 5
    for df in outcome[:-1]:
        assert df.dtypes == outcome[0].dtypes
    assert all(r.n_chars == len(r.text) for r in outcome[4].collect())


def test_rejected_documents_go(spark, outcome):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality_mil.report(outcome[0], labels).collect()}
    kept = {i for i, _, _ in _rows(outcome[1])}
    assert kept == {i for i, p in scores.items() if p}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    assert len(good & kept) >= 0.97 * len(good)


def test_repeated_lines_go(outcome):
    before, after = _rows(outcome[1]), _rows(outcome[2])
    assert sorted((i, t) for i, t, _ in after) == [r[:2] for r in sorted(_without_repeats([r[:2] for r in before]))]


def test_one_of_each_group_stays(outcome):
    before = sorted(_rows(outcome[2]))
    groups = _groups([_simhash(t) for _, t, _ in before])
    assert sorted(r[0] for r in _rows(outcome[3])) == sorted(before[g][0] for g in set(groups))


def test_the_mix_repeats_documents(outcome):
    times = Counter(i for i, _, _ in _rows(outcome[4]))
    for r in mixing.mixed_sizes(outcome[3]).collect():
        assert r.taken == times[r.doc_id] * r.size


def test_the_mix_is_encoded(outcome):
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i, text, _ in _rows(outcome[4]):
        ids = own.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, outcome[5].collect())) == sorted(expected)


def test_run_is_the_stages(spark, outcome):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, outcome[5].collect()))


def test_stages_take_awkward_and_empty_documents(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for rows in (cases.awkward(), []):
        docs = cases.frame(spark, rows).select(*columns)
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, SF), "tested")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (docs.count() > 0) == bool(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    expected_columns, expected = duck_rows(connect(SF), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_all_queries_are_registered():
    names = [n for n in driver.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_its_whole_table(spark, name):
    found = QUERIES[name](spark, SF)
    table = "pages" if name.startswith("op9") else "documents"
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
