"""One XML document from many tasks, read by Spark and by a standard parser."""

import xml.etree.ElementTree as ET

import pytest
from conftest import rows

from lexis.session import scratch_path
from lexis.sources.xml import XSI, export_xml_document, read_xml, row_xml

ROWS = [(1, "plain", 1.5), (2, None, None), (3, "", 0.0), (4, "a < b & c > d \"q\" 'q' ]]>", 1.0),
        (5, "two\nlines\r\nand\ttab", None), (6, " spaces ", 2.0), (7, "ж 😀 é", 3.0)]
SCHEMA = "id long, text string, x double"


def read(path):
    return open(path.removeprefix("file:").replace("///", "/"), "rb").read()


def test_one_document_from_many_tasks(spark):
    df = spark.createDataFrame(ROWS * 30, SCHEMA).repartition(5)
    path = scratch_path(spark, "doc") + ".xml"
    for _ in range(2):                                     # the second replaces the first
        export_xml_document(df, path, "students")
    root = ET.fromstring(read(path))
    assert root.tag == "students" and len(root) == len(ROWS) * 30
    found = []
    for row in root:
        v = {c.tag: None if c.get(f"{{{XSI}}}nil") == "true" else c.text or "" for c in row}
        found.append((int(v["id"]), v["text"], None if v["x"] is None else float(v["x"])))
    assert sorted(found, key=repr) == sorted(ROWS * 30, key=repr)
    some = [r for r in ROWS if r[0] not in (3, 5)]         # Spark's reader: an empty element is null, see below
    got = read_xml(spark, path, df.schema).where("id not in (3, 5)")
    assert sorted(map(tuple, got.distinct().collect()), key=repr) == sorted(some, key=repr)


def test_characters_that_xml_cannot_hold(spark):
    path = scratch_path(spark, "odd") + ".xml"
    export_xml_document(spark.createDataFrame([(1, "a\x00b\x0bc￾", 0.0)], SCHEMA), path, "r")
    assert ET.fromstring(read(path))[0][1].text == "a�b�c�"


def test_empty_table_and_names(spark):
    path = scratch_path(spark, "empty") + ".xml"
    export_xml_document(spark.createDataFrame([], SCHEMA), path, "r")
    assert len(ET.fromstring(read(path))) == 0
    with pytest.raises(ValueError, match="element name"):
        row_xml(spark.range(1).withColumnRenamed("id", "two words"))
    with pytest.raises(ValueError, match="element name"):
        export_xml_document(spark.range(1), path, "a b")


def test_a_failed_export_leaves_the_document(spark):
    from pyspark.sql import functions as F
    path = scratch_path(spark, "kept") + ".xml"
    export_xml_document(spark.range(3), path, "r")
    before = read(path)
    with pytest.raises(Exception, match="no more"):
        export_xml_document(spark.range(3).select(F.raise_error(F.lit("no more")).cast("string").alias("id")), path, "r")
    assert read(path) == before
    assert rows(spark.range(3)) == [(0,), (1,), (2,)]
