"""The corpus queries against their SQL twins, brute force, or held-out accuracy."""

import zlib

import pytest

import corpus_pipeline
from flowtables.llm.suite import CORPUS_QUERIES, CORPUS_SQL
from tests.checking import compare, connection
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connection(FOLDER) as opened:
        yield opened


def rows(df, *key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def documents(spark, folder=FOLDER):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(CORPUS_SQL))
def test_twin(spark, con, name):
    assert compare(CORPUS_QUERIES[name](spark, FOLDER), con, CORPUS_SQL[name]) == []


def test_near_dedup_by_brute_force(spark):
    docs = documents(spark)
    found = {
        r.doc_id: (r.n_shingles, r.component_id, r.kept)
        for r in CORPUS_QUERIES["op4_near_dedup"](spark, FOLDER).collect()
    }
    assert found == brute.near_groups({d["doc_id"]: d["text"] for d in docs}, 85)


def test_quality_rules_by_brute_force(spark):
    docs = documents(spark)
    found = rows(CORPUS_QUERIES["op2_quality_rules"](spark, FOLDER), "doc_id")
    wanted = brute.quality_rules(docs)
    assert {k[0]: v for k, v in found.items()} == {r["doc_id"]: r for r in wanted}
    assert any(not r["kept"] and not r["base_failed"] for r in wanted)


def test_language_accuracy_on_held_out(spark):
    folder = "/root/testdata/sf0.01"
    lang = {d["doc_id"]: d["lang"] for d in documents(spark, folder)}
    found = CORPUS_QUERIES["op1_language_id"](spark, folder).collect()
    assert len(found) == len(lang) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.99 * len(held)


def test_quality_accuracy_on_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    quality = {r.doc_id: r.quality for r in labels}
    found = CORPUS_QUERIES["op3_quality_classifier"](spark, folder).collect()
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id in quality]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held) and len(held) > 50
    assert sum(r.predicted == quality[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    benchmark = {
        r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    }
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.asDict() for r in docs.collect()}
        out = stage(spark, docs, FOLDER)
        if number < 4:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = {r.doc_id: r.asDict() for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if number == 0:
            quality = {
                r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
            }
            known = [i for i in before if i in quality]
            assert sum((i in after) == quality[i] for i in known) >= 0.95 * len(known)
        elif number == 1:
            dropped = brute.recurring_lines({i: d["text"] for i, d in before.items()})
            wanted = {
                i: "\n".join(x for k, x in enumerate(d["text"].split("\n")) if (i, k) not in dropped)
                for i, d in before.items()
            }
            assert {i: d["text"] for i, d in after.items()} == {
                i: t for i, t in wanted.items() if t.split() or t == before[i]["text"]
            }
            assert all(d["n_chars"] == len(d["text"]) for d in after.values())
        elif number == 2:
            groups = brute.near_groups({i: d["text"] for i, d in before.items()}, 80)
            assert set(after) == {i for i, g in groups.items() if g[2]}
        elif number == 3:
            found = brute.contaminated({i: d["text"] for i, d in before.items()}, benchmark)
            assert set(after) == set(before) - {i for i, _ in found}
        else:
            assert sum(d["taken"] for d in after.values()) > 0
            assert all(d["taken"] <= 3 * d["size"] for d in after.values())
            for source in {d["source"] for d in before.values()}:
                mine = [d for d in after.values() if d["source"] == source]
                assert abs(sum(d["taken"] for d in mine) - mine[0]["target"]) < 1


def test_pipeline_runs_as_a_query(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "text", "taken"} <= set(out.columns) and out.count() > 0
