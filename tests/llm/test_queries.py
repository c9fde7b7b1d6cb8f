"""The registered corpus queries and the pipeline on the smallest tables."""

import numpy as np
import public_tokenizers

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import SMALLEST
from oracle import compare, connect
from test_rows import groups_brute


def test_mixing_matches_sql(spark):
    name = "op8_mixing"
    frame = entry_points.queries()[name](spark, str(SMALLEST))
    assert compare(frame, connect(str(SMALLEST)), entry_points.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    names = set(entry_points.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against a plain version on what it was given."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    given = docs.collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_files"]
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(SMALLEST)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        frames.append((given, docs.collect()))
        assert name == "token_files" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        given = frames[-1][1]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALLEST}/labels.parquet").collect()}
    (before, after) = frames[0]
    left = {r.doc_id for r in after}
    clean = [r.doc_id for r in before if toxic.get(r.doc_id) == 0]
    assert set(after) <= set(before) and np.mean([i in left for i in clean]) > 0.9
    (before, after) = frames[1]
    groups = groups_brute([(r.doc_id, r.text) for r in before], 5, (80, 100))
    assert sorted(r.doc_id for r in after) == [i for i, _, _, kept in groups if kept]
    items = [r.text for r in spark.read.parquet(f"{SMALLEST}/benchmark.parquet").collect()]
    (before, after) = frames[2]
    left = {r.doc_id for r in after}
    leaked = {r.doc_id for r in before if any(t in r.text for t in items)}
    assert leaked and not leaked & left and left <= {r.doc_id for r in before}
    (before, after) = frames[3]
    assert set(after) <= set(before)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    (before, after) = frames[4]
    assert sorted((r.doc_id, r.n_tokens) for r in after) == sorted((r.doc_id, len(plain.encode(r.text, add_special_tokens=False).ids) + 1) for r in before)
    assert sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)
