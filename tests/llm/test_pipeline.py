from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from riskflow.llm.exact_dedup import exact_duplicates
from riskflow.llm.mixing import mix_sources
from riskflow.llm.packing import pack_documents
from riskflow.llm.simhash import near_duplicates
from riskflow.llm.toxicity import score_toxicity, train
from riskflow.session import materialize
from riskflow.sources import read_table


@pytest.fixture(scope="module")
def stages(spark):
    """The input and what each stage makes of it."""
    frames = [read_table(spark, SMALL, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SMALL), "stage"))
    return frames


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_each_stage_applies_its_operator(spark, stages):
    docs, clean, distinct, apart, mixed, packed = stages
    model = train(docs, read_table(spark, SMALL, "labels"))
    assert ids(clean) == ids(score_toxicity(docs, model).filter("predicted = 0"))
    assert ids(distinct) == ids(exact_duplicates(clean).filter("kept"))
    leaders = near_duplicates(distinct).filter("doc_id = component_id")
    assert ids(apart) == ids(leaders)
    assert ids(mixed) == ids(apart)
    order = [r.doc_id for r in sorted(mix_sources(apart).collect(), key=lambda r: (r.slot, r.place))]
    files = sorted(path.removeprefix("file://") for path in mixed.inputFiles())
    assert [i for path in files for i in pq.read_table(path).column("doc_id").to_pylist()] == order
    assert set(ids(packed)) == set(ids(mixed))
    assert len(clean.collect()) < len(docs.collect()) and len(distinct.collect()) < len(clean.collect())


def test_run_equals_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = Counter(map(tuple, corpus_pipeline.run(spark, SMALL).select(columns).collect()))
    assert whole == Counter(map(tuple, stages[-1].select(columns).collect()))
    assert pack_documents(stages[-2], corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).count() == whole.total()


def test_run_leaves_only_what_stages_keep(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("riskflow.session.scratch_dir", lambda spark: str(tmp_path))
    corpus_pipeline.run(spark, SMALL).count()
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    names = [name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES[:-1]]
    assert all(left.count(name) == 1 for name in names)
    assert not {"units", "places", "sources", "offsets"} & set(left)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", "s", 5)]])
def test_stages_on_empty_and_null_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), "stage")
    assert docs.select("doc_id").distinct().count() == len(set(r[0] for r in rows))
