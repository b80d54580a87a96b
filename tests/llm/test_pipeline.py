from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from asset_catalog.llm import langid, mixing, registered, sentencepieces, simhash, toxicity
from tests.llm.test_simhash import brute_components, brute_print

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage made of what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(corpus_pipeline.stored(stage(spark, made[-1], SF_DIR), name))
    return made


def test_names_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mix", "pieces"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_return_documents(steps):
    for made in steps[1:-1]:
        assert made.dtypes == steps[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    machine = toxicity.learn(steps[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    expected = {r.doc_id for r in toxicity.score_toxicity(steps[0], machine).collect() if r.score < 0.5}
    assert {r.doc_id for r in steps[1].collect()} == expected and len(expected) < steps[0].count()
    clean = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 0").select("doc_id")
    assert clean.join(steps[1], "doc_id", "left_anti").count() == 0


def test_documents_in_a_known_language_stay(steps):
    automata = langid.learn(steps[1])
    named = langid.identify(steps[1], automata).join(steps[1].select("doc_id", "lang"), "doc_id").collect()
    gone = {r.doc_id for r in named if r.lang_pred == "und" or (r.lang in automata.languages and r.lang != r.lang_pred and r.score >= 0.2)}
    assert {r.doc_id for r in steps[2].collect()} == {r.doc_id for r in named} - gone and len(gone) < 5


def test_one_of_each_group_stays(steps):
    prints = {r.doc_id: brute_print(r.text) for r in steps[2].collect()}
    components = brute_components(prints)
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(set(components.values()))


def test_mix_takes_what_was_planned(steps):
    plan = {r.doc_id: r for r in mixing.mix(steps[3]).collect()}
    rows = Counter()
    for r in steps[4].withColumn("words", mixing.word_count(F.col("text"))).collect():
        rows[r.doc_id] += r.words
    assert rows == Counter({k: r.taken for k, r in plan.items() if r.taken})
    taken, target = Counter(), {}
    for r in plan.values():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(0 <= target[s] - taken[s] < 1 for s in target)


def test_pieces_are_lossless(steps):
    assert steps[5].count() == steps[4].count()
    assert steps[5].where("not lossless").count() == 0
    assert steps[5].columns == ["doc_id", "n_pieces", "ids_md5", "text_md5", "lossless"]


def test_run_applies_the_stages(spark, steps):
    rows = lambda frame: Counter(map(tuple, frame.collect()))
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(steps[-1])


def test_stages_on_messy_rows(spark, messy, nothing, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (messy, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, str(tmp_path))
            assert kept.columns == docs.columns
            kept.collect()
    assert sentencepieces.round_trip(nothing, sentencepieces.load()).count() == 0
    assert simhash.kept_documents(messy).count() > 0


EXPECTED = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_source_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op8_simhash_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_lm_score": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double", "n_bytes": "bigint", "bits_per_byte": "double"},
    "op10_sentencepiece": {"doc_id": "bigint", "n_pieces": "bigint", "ids_md5": "string", "text_md5": "string", "lossless": "boolean"},
    "op11_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op12_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op13_merkle": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_returns_its_columns_for_every_row(spark, sf_dir, name):
    rows = registered.QUERIES[name](spark, sf_dir)
    assert dict(rows.dtypes) == EXPECTED[name]
    got = rows.collect()
    if name == "op6_nearest":
        assert len(got) == 20 * 25
        return
    table, key = ("embeddings", "vec_id") if name.startswith("op5") else ("documents", "doc_id")
    assert sorted(r[0] for r in got) == sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())
    folds = {"op1": (5, 0), "op3": (3, 1), "op4": (5, 0), "op9": (7, 2)}
    if (fold := folds.get(name.split("_")[0])) is not None:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in got)


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    held = duckdb.connect()
    for table in ("documents", "embeddings"):
        held.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = registered.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    expected = held.sql(registered.ORACLES[name]).select(*columns).fetchall()
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(expected)
