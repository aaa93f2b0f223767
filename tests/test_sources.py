"""Scans and sinks: broken lines and where they are, both shapes of documents, digits, order, and what reaches the scan."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.operators import scope
from pulseframe.sources import documents, json_lines, landing, sinks

SCHEMA = T.StructType().add("a", T.LongType()).add("b", T.StringType()).add("c", T.ArrayType(T.LongType()))
LINES = [
    '{"a": 1, "b": "x", "c": [1, 2]}', "", "   ", '{"a": "2", "b": null}', '{"a": 3', "[1]", "[]", "7", '"text"', "null", '{"a": 4} {"a": 5}', "{'a': 6}", '{"a": "six", "b": 7}',
    '\t{"a": 8, "other": {"deep": 1}}\t', '{"a": 9}]', "{}", '{"a": 10, "b": "é\\n"}', '{"a": NaN}',
]


@pytest.fixture(scope="module")
def lines(tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    (folder / "one.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (folder / "two.jsonl").write_text('{"a": 20}\nbroken', encoding="utf-8")
    (folder / "none.jsonl").write_text("", encoding="utf-8")
    return f"file://{folder}"


@pytest.mark.parametrize("block", ["128m", "64", "17"])
def test_permissive_lines(spark, lines, block):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        records, errors = json_lines.read_permissive(spark, lines, SCHEMA)
        rows = sorted((tuple(r) for r in records.collect()), key=str)
        found = sorted((r.path.rsplit("/", 1)[-1], r.line, r.error) for r in errors.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == sorted(
        [(1, "x", [1, 2]), (2, None, None), (None, "7", None), (8, None, None), (None, None, None), (10, "é\n", None), (20, None, None)], key=str
    )
    bad, other = "malformed JSON", "not an object"
    assert found == [
        *[("one.jsonl", n, e) for n, e in ((5, bad), (6, other), (7, other), (8, other), (9, other), (10, other), (11, bad), (12, bad), (15, bad), (18, bad))],
        ("two.jsonl", 2, bad),
    ]


def test_strict_lines_name_the_file(spark, lines, tmp_path):
    with pytest.raises(Exception, match="Invalid JSON at .*jsonl: "):
        json_lines.read_strict(spark, lines, SCHEMA).collect()
    rows = spark.createDataFrame([(1, "x\ny", [1]), (None, None, None)], SCHEMA)
    assert json_lines.write_lines(rows, f"file://{tmp_path}/out") == 2
    back = json_lines.read_strict(spark, f"file://{tmp_path}/out", SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert spark.read.text(f"file://{tmp_path}/out").filter("value like '%null%'").count() == 1
    assert json_lines.write_lines(rows.limit(0), f"file://{tmp_path}/none") == 0
    assert json_lines.read_permissive(spark, f"file://{tmp_path}/none", SCHEMA)[0].count() == 0


def written(tmp_path, *texts):
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
    return f"file://{tmp_path}"


def test_metric_lists_of_both_shapes(spark, tmp_path):
    path = written(tmp_path, '[{"itemid": "1", "key": "k"},\n {"itemid": 2}]', ' {"metrics": [{"itemid": "3"}], "items": [{"itemid": "no"}]}', '{"items": [\n{"itemid": "4"}]}', "[]", "{\"items\": []}")
    assert sorted(r.itemid for r in documents.read_metric_list(spark, path).collect()) == ["1", "2", "3", "4"]
    for text in ('{"other": []}', "7", '"x"', '{"metrics": 5}', "{"):
        folder = tmp_path / f"bad{abs(hash(text))}"
        folder.mkdir()
        with pytest.raises(Exception, match="Neither a list"):
            documents.read_metric_list(spark, written(folder, text)).collect()


def test_inventory_and_its_rules(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    path = written(
        good, '{"generated_at": "t", "hosts": [\n{"hostid": "1", "host": "", "name": "A", "inventory": {"os": "x"}, "metrics": [{"itemid": "11", "categories": ["cpu"]}, {"itemid": "12"}]}, {"hostid": "2"}]}',
        '{"hosts": [{"hostid": "3", "host": "h", "name": "n", "metrics": [{"itemid": "13"}]}]}', "{}",
    )
    hosts = documents.read_inventory(spark, path)
    assert sorted(r.hostid for r in hosts.collect()) == ["1", "2", "3"]
    assert sorted((r.hostid, r.host, r.itemid, r.categories) for r in documents.flatten_items(hosts).collect()) == [("1", "A", "11", ["cpu"]), ("1", "A", "12", None), ("3", "h", "13", None)]
    assert sorted(tuple(r) for r in documents.item_index(hosts).collect()) == [("1", "", "A", "11"), ("1", "", "A", "12"), ("3", "h", "n", "13")]
    with pytest.raises(ValueError, match="Duplicate itemid detected.*11"):
        documents.item_index(hosts.unionByName(hosts.filter("hostid = '1'")))
    bad = tmp_path / "bad"
    bad.mkdir()
    with pytest.raises(Exception, match="Not an inventory"):
        documents.read_inventory(spark, written(bad, "[1]")).collect()


def test_roles_are_unique(spark):
    listed = spark.createDataFrame([("switch", "1"), ("router", "2"), (None, "3")], "role string, hostid string")
    assert sorted(map(tuple, documents.role_index(listed).collect())) == [("1", "switch"), ("2", "router")]
    with pytest.raises(ValueError, match="multiple roles"):
        documents.role_index(listed.unionByName(spark.createDataFrame([("router", "1")], listed.schema)))
    with pytest.raises(ValueError, match="listed twice"):
        documents.role_index(listed.unionByName(listed))
    scope.require_none(listed.limit(0), "nothing")


def test_twelve_digits_as_python_writes_them(spark):
    rng = random.Random(6)
    some = [0.0, -0.0, 1.0, -1.0, 0.1, 1e-4, 9.9999e-5, 9.99999999999e-5, 999999999999.4, 999999999999.6, 1e12, 123456789012.0, 1e300, 2.3e-308, 1.7976931348623157e308, math.nan, math.inf, -math.inf, 100.0, 1200000.0]
    some += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-20, 25) for _ in range(3000)] + [float(rng.randrange(-10**14, 10**14)) for _ in range(500)]
    some += [x for x in (struct.unpack("d", rng.randbytes(8))[0] for _ in range(1500)) if not math.isnan(x)]
    # a shortest text of 13 digits that ends in 5 is rounded half up here; subnormal numbers show their shortest text
    some = [x for x in some if not 0 < abs(x) < 2.3e-308]
    some = [x for x in some if len(digits := f"{x!r}".split("e")[0].replace(".", "").strip("-0")) != 13 or digits[-1] != "5"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(some)] + [(-1, None)], "k long, x double").repartition(3)
    got = {r.k: r.t for r in rows.select("k", sinks.significant(F.col("x")).alias("t")).collect()}
    assert got.pop(-1) is None
    assert [(x, got[k]) for k, x in enumerate(some) if got[k] != f"{x:.12g}"] == []


def test_matrix_and_report(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 0.1, "no"), (-2.5, 1e20, "no")], "a double, b double, c string")
    assert sinks.write_matrix(rows, ["b", "a"], f"file://{tmp_path}/m") == 2
    text = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert sorted(text.split()) == sorted(["b,a"] * text.count("b,a") + ["0.1,1", "1e+20,-2.5"])
    sinks.write_report(spark.createDataFrame([(1, None)], "n long, t string"), f"file://{tmp_path}/r")
    assert "".join(p.read_text() for p in (tmp_path / "r").glob("part-*")) == '{"n":1,"t":null}\n'


def test_files_are_in_order(spark, tmp_path):
    ids = [str(k) for k in range(120)] + ["x1", "x10", "x2", None]
    rows = spark.createDataFrame([(i, k % 7) for k, i in enumerate(ids * 5)], "hostid string, t long").repartition(5)
    sinks.write_ordered(rows, [*sinks.numeric_first("hostid"), F.asc("t")], f"file://{tmp_path}/o", 8)
    files = sorted((tmp_path / "o").glob("part-*.parquet"))
    back = [tuple(r) for f in files for r in spark.read.parquet(f"file://{f}").collect()]
    assert len(files) > 4 and len(back) == len(ids) * 5
    assert back == sorted(back, key=lambda r: (r[0] is None, not (r[0] or "").isdigit(), int(r[0]) if (r[0] or "").isdigit() else 0, r[0] or "", r[1]))


def test_landing_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", k, str(k / 2)) for k in range(100)] + [("a", 5, "n/a"), ("b", 5, "1"), ("z", 5, "1")], "itemid string, clock long, value string").write.parquet(f"file://{tmp_path}/p")
    identity = ", ".join(f"{c} string" for c in landing.IDENTITY)
    items = spark.createDataFrame([("a", "0", *"1234567"), ("b", "4", *"1234567")], f"itemid string, value_type string, {identity}")
    found = landing.land_history(spark.read.parquet(f"file://{tmp_path}/p"), items, 5, 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(clock,5)" in plan and "LessThanOrEqual(clock,7)" in plan
    assert sorted(((r.itemid, r.clock, r.timestamp, r.value) for r in found.collect()), key=str) == sorted(
        [("a", 5, "1970-01-01T00:00:05+00:00", None), ("a", 5, "1970-01-01T00:00:05+00:00", 2.5), ("a", 6, "1970-01-01T00:00:06+00:00", 3.0), ("a", 7, "1970-01-01T00:00:07+00:00", 3.5)], key=str
    )
