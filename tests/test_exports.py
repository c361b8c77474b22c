"""Documents: read from folders, flattened, written and read again."""

import textwrap

import pytest
from pyspark.sql import functions as F

from flowtables.schemas import TABLES
from flowtables.session import cut, scratch_path
from flowtables.sources import exports

ROOT = """
name: root
dependencies:
  org.acme:
    acme-nar:
      '2.10':
        Fetch: org.acme.Fetch
        Fetch#1: org.other.Fetch
controllers:
- name: Pool
  type: Pool
  id: s1
  comment: shared
  properties:
    Size: 0500
components:
- name: Fetch
  type: Fetch
  id: p1
  position: 12,-7
  properties:
    Service: s1
    Empty: ''
    Flag: yes
  scheduling:
    concurrentTasks: 4
  styles:
    font-size: 14px
  advanced:
    policy: USE_CLONE
    rules:
    - name: first
      conditions:
      - ${a:equals("1")}
      - ${b:equals("2")}
      actions:
        z: last
        a: first
    - name: second
- type: FUNNEL
  id: f1
  position: 1,2
  inputs:
  - source: p1
    from:
    - ok
    - fail
    position:
    - 3,4
    properties:
      zIndex: 7
      labelIndex: 0
      prioritizers:
      - Oldest
      - Attribute
  - source: g1
- name: Inner
  type: process_group
  id: g1
  template: inner.yaml
  inputs:
  - source: f1
    to: In
- name: Far
  type: REMOTE_PROCESS_GROUP
  id: r1
  remotePorts:
  - name: In
    type: INPUT_PORT
    maxConcurrentTasks: 3
    useCompression: true
    batchDuration: 10s
  - name: Out
    type: OUTPUT_PORT
"""
INNER = "name: inner\ncomponents:\n- name: In\n  type: INPUT_PORT\n  id: i1\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("exports")
    for workspace in ("w1", "w2"):
        (base / workspace).mkdir()
        (base / workspace / "root.yaml").write_text(textwrap.dedent(ROOT))
    (base / "w1" / "inner.yaml").write_text(INNER)
    (base / "w1" / "broken.yaml").write_text("name: [unclosed\n")
    (base / "w1" / "list.yaml").write_text("- not\n- a template\n")
    (base / "w1" / "nameless.yaml").write_text("components: []\n")
    (base / "w1" / "notes.txt").write_text("ignored")
    (base / "w1" / "deeper").mkdir()
    (base / "w1" / "deeper" / "more.yaml").write_text(INNER)
    return str(base)


@pytest.fixture(scope="module")
def documents(spark, folder):
    return exports.read_exports(spark, folder + "/*").cache()


@pytest.fixture(scope="module")
def tables(documents):
    return exports.to_tables(documents)


def one(df, where):
    rows = df.where(where).collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_files(documents):
    files = {(r["workspace"], r["file"]): r["error"] is None for r in documents.collect()}
    assert files == {
        ("w1", "root.yaml"): True, ("w2", "root.yaml"): True, ("w1", "inner.yaml"): True,
        ("w1", "broken.yaml"): False, ("w1", "list.yaml"): False,
        ("w1", "nameless.yaml"): False,
    }


def test_table_columns(tables):
    for name, schema in TABLES.items():
        assert [(f.name, f.dataType) for f in tables[name].schema.fields] == [
            (f.name, f.dataType) for f in schema.fields
        ], name


def test_flat_tables(tables):
    counts = {name: df.where("workspace = 'w1'").count() for name, df in tables.items()}
    assert counts == {
        "templates": 2, "dependencies": 2, "controllers": 1, "components": 5, "properties": 6,
        "edges": 3, "remote_ports": 2, "rules": 2,
    }
    w1 = "workspace = 'w1' AND "
    fetch = one(tables["components"], w1 + "id = 'p1'")
    assert (fetch["kind"], fetch["x"], fetch["y"], fetch["policy"]) == ("PROCESSOR", 12.0, -7.0, "USE_CLONE")
    group = one(tables["components"], w1 + "id = 'g1'")
    assert (group["kind"], group["child_template"]) == ("PROCESS_GROUP", "inner")
    # scalars keep their spelling
    assert one(tables["properties"], w1 + "key = 'Size'")["value"] == "0500"
    assert one(tables["properties"], w1 + "key = 'Flag'")["value"] == "yes"
    assert one(tables["dependencies"], w1 + "name = 'Fetch#1'")["version"] == "2.10"
    edge = one(tables["edges"], w1 + "source_id = 'p1'")
    assert edge["relationships"] == ["ok", "fail"] and edge["bends"] == ["3,4"]
    assert (edge["settings"]["zIndex"], edge["settings"]["labelIndex"]) == (7, 0)
    assert edge["settings"]["prioritizers"] == ["Oldest", "Attribute"]
    bare = one(tables["edges"], w1 + "source_id = 'g1'")
    assert bare["relationships"] == [] and bare["settings"] is None
    port = one(tables["remote_ports"], w1 + "name = 'In'")
    assert (port["max_tasks"], port["compression"], port["batch_count"], port["batch_duration"]) == (3, True, None, "10s")
    rule = one(tables["rules"], w1 + "rule_no = 1")
    assert rule["conditions"] == ['${a:equals("1")}', '${b:equals("2")}']
    assert rule["actions"] == {"z": "last", "a": "first"}


def bag(df):
    """Rows without empties: written documents do not keep them; maps sorted."""

    def plain(value):
        if isinstance(value, dict):
            return sorted(value.items())
        if hasattr(value, "asDict"):
            return [plain(v) for v in value]
        return None if value in ("", []) else value

    rows = df.where("value <> ''") if "value" in df.columns else df
    if "type" in df.columns and "kind" in df.columns:
        # a reserved kind is written in upper case
        rows = rows.withColumn("type", F.when(F.col("kind") == "PROCESSOR", F.col("type")).otherwise(F.col("kind")))
    if "x" in df.columns:
        rows = rows.withColumn("comment", F.nullif("comment", F.lit("")))
    return sorted(repr([plain(v) for v in r]) for r in rows.collect())


@pytest.mark.parametrize("page_rows", [10_000, 2])
def test_round_trip(spark, tables, page_rows):
    written = cut(exports.to_documents(tables, page_rows=page_rows))
    pages = {(r["workspace"], r["template"], r["page"]) for r in written.collect()}
    assert len(pages) == written.count()
    if page_rows > 2:
        assert pages == {("w1", "root", 0), ("w1", "inner", 0), ("w2", "root", 0)}
    else:
        assert len(pages) > 3
    texts = written.withColumn("file", F.col("template"))
    again = exports.to_tables(exports.read_exports_json(texts))
    for name in TABLES:
        assert bag(again[name]) == bag(tables[name]), name


@pytest.mark.parametrize("page_rows", [10_000, 2])
def test_written_yaml(spark, tables, page_rows):
    path = scratch_path(spark, "written")
    documents = cut(exports.to_documents(tables, page_rows=page_rows))
    exports.write_exports(exports.to_yaml(documents), path)
    files = exports.read_written(spark, path)
    assert files.count() == documents.count() and files.where("error is not null").count() == 0
    again = exports.to_tables(files)
    for name in TABLES:
        assert bag(again[name]) == bag(tables[name]), name


def test_odd_names_and_nameless_elements(spark, tmp_path):
    folder = tmp_path / "my flow+%20"
    folder.mkdir()
    text = "name: t\ncomponents:\n- id: c1\n  properties: {a: b}\ncontrollers:\n- id: s1\n"
    (folder / "a b+c.yaml").write_text(text)
    docs = exports.read_exports(spark, str(folder))
    assert (docs.first()["workspace"], docs.first()["file"]) == ("my flow+%20", "a b+c.yaml")
    found = exports.to_tables(docs)
    assert found["components"].first()["id"] == "c1" and found["controllers"].first()["id"] == "s1"
    path = scratch_path(spark, "odd")
    exports.write_exports(exports.to_yaml(exports.to_documents(found)), path)
    again = exports.to_tables(exports.read_written(spark, path))
    for name in TABLES:
        assert bag(again[name]) == bag(found[name]), name


def test_document_text(spark, tables):
    import json

    row = exports.to_documents(tables).where("workspace = 'w1' AND template = 'root'").first()
    doc = json.loads(row["json"])
    assert list(doc) == ["name", "dependencies", "controllers", "components"]
    fetch = doc["components"][0]
    assert list(fetch) == ["name", "type", "id", "position", "properties", "styles", "scheduling", "advanced"]
    assert fetch["properties"] == {"Flag": "yes", "Service": "s1"}
    assert list(fetch["advanced"]["rules"][0]["actions"]) == ["a", "z"]
    assert [c["id"] for c in doc["components"]] == ["p1", "f1", "g1", "r1"]
    assert "remotePorts" not in fetch and "inputs" not in fetch


def test_many_documents_in_few_splittable_files(spark, tmp_path):
    n = 100_000
    documents = spark.range(n).select(
        F.lit("w").alias("workspace"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("template"),
        F.lit(0).cast("bigint").alias("page"),
        F.format_string('{"name":"t%d","components":[{"name":"--- # x\\n--- # y","type":"T"}]}', "id").alias("json"),
    )
    path = f"{tmp_path}/many"
    exports.write_exports(documents, path)
    (tmp_path / "many" / "plain.yaml").write_text("name: plain\n")
    files = [f for f in (tmp_path / "many").iterdir() if f.name.startswith("part-")]
    assert 0 < len(files) <= 50
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        found = exports.read_exports(spark, path).cache()
        assert found.rdd.getNumPartitions() > len(files)
        assert found.where("error is null").count() == n + 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.select("file").distinct().count() == n + 1
    assert {r.workspace for r in found.select("workspace").distinct().collect()} == {"w", "many"}
    names = found.where("file <> 'plain.yaml'").select(F.col("doc.components")[0]["name"].alias("n")).distinct()
    assert [r.n for r in names.collect()] == ["--- # x\n--- # y"]


def test_written_yaml_is_one_stream(spark, tmp_path):
    import yaml

    rows = [("w", "a", 0, 'name: a\nx: "--- # {}"\n'), ("w", "b", 1, "name: b\n\n")]
    frame = spark.createDataFrame(rows, "workspace string, template string, page bigint, yaml string")
    exports.write_exports(frame.coalesce(1), f"{tmp_path}/s")
    texts = [f.read_text() for f in (tmp_path / "s").iterdir() if f.name.startswith("part-")]
    assert sorted(d["name"] for t in texts for d in yaml.safe_load_all(t)) == ["a", "b"]
    found = exports.read_written(spark, f"{tmp_path}/s").collect()
    assert sorted((r.file, r.doc.name, r.error) for r in found) == [("a.0.yaml", "a", None), ("b.1.yaml", "b", None)]


def test_yaml_is_written_in_several_tasks(spark):
    small = spark.range(40).coalesce(1).selectExpr(
        "'w' AS workspace", "string(id) AS template", "0L AS page", "'{\"name\":\"t\"}' AS json"
    )
    written = exports.to_yaml(small)
    assert {r["yaml"] for r in written.collect()} == {"name: t\n"}
    assert written.count() == 40
    assert len(written.groupBy(F.spark_partition_id()).count().collect()) > 1
