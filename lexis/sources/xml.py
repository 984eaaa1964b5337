"""XML export and import.

Layout: ``<rootTag><row><col>value</col>...</row></rootTag>``. ``export_xml``
uses Spark's built-in source: a file for each task, a NULL as
``<col nil="true"/>`` (that writer accepts no namespace prefix).
``export_xml_document`` makes one document of any number of tasks' rows, with
the schema-instance namespace and ``<col xsi:nil="true"/>``. ``read_xml`` reads
both.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_xml(df: DataFrame, path: str, root_tag: str, row_tag: str = "row",
               explicit_nulls: bool = True, single_file: bool = False,
               mode: str = "overwrite") -> None:
    """Write ``df`` as XML, one file per task (each with its own root).

    ``single_file`` funnels the rows through one task: only for small
    final exports.
    """
    out = df
    if explicit_nulls:
        cols = []
        for f in df.schema.fields:
            c = F.col(f.name)
            nil = F.struct(F.lit("true").alias("_nil"), F.lit(None).cast(f.dataType).alias("_VALUE"))
            val = F.struct(F.lit(None).cast("string").alias("_nil"), c.alias("_VALUE"))
            cols.append(F.when(c.isNull(), nil).otherwise(val).alias(f.name))
        out = df.select(*cols)
    if single_file:
        out = out.coalesce(1)
    (out.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
        .mode(mode).save(path))


# The namespace of nil, and what XML 1.0 has no character for.
XSI = "http://www.w3.org/2001/XMLSchema-instance"
NO_CHARACTER = r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{FFFE}\x{FFFF}]"
_NAME = re.compile(r"[A-Za-z_][\w.-]*\Z")


def _escaped(text: Column) -> Column:
    """Text as element content; characters that XML cannot hold are U+FFFD,
    a carriage return is a reference (parsers would make it a line feed)."""
    t = F.regexp_replace(text, NO_CHARACTER, "\ufffd")
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#xD;")):
        t = F.replace(t, F.lit(raw), F.lit(ref))
    return t


def row_xml(df: DataFrame, row_tag: str = "row") -> DataFrame:
    """(value): every row of ``df`` as an element, columns in their order."""
    for name in (row_tag, *df.columns):
        if not _NAME.match(name):
            raise ValueError(f"{name!r} is no element name")
    parts = [F.lit(f"<{row_tag}>\n")]
    for f in df.schema.fields:
        value = _escaped(F.col(f.name).cast("string"))
        parts.append(F.when(F.col(f.name).isNull(), F.lit(f'  <{f.name} xsi:nil="true"/>\n'))
                      .otherwise(F.concat(F.lit(f"  <{f.name}>"), value, F.lit(f"</{f.name}>\n"))))
    return df.select(F.concat(*parts, F.lit(f"</{row_tag}>\n")).alias("value"))


def export_xml_document(df: DataFrame, path: str, root_tag: str, row_tag: str = "row") -> None:
    """Write ``df`` as one XML document, the file ``path`` (replaced if it is
    there): all rows under one root, in the order of the partitions.

    Tasks write their rows as text; the parts are then joined in one pass of
    the file system, in buffers of fixed size, beside ``path``, and the whole is
    renamed into place. A failed task or join leaves ``path`` as it was.
    """
    if not _NAME.match(root_tag):
        raise ValueError(f"{root_tag!r} is no element name")
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    draft = f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"
    place, parts, whole = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, draft, f"{draft}.xml"))
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        row_xml(df, row_tag).write.text(draft)
        names = sorted(s.getPath().getName() for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-"))
        out = fs.create(whole, True)
        try:
            out.write(f'<{root_tag} xmlns:xsi="{XSI}">\n\n'.encode())
            for name in names:
                part = fs.open(jvm.org.apache.hadoop.fs.Path(f"{draft}/{name}"))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                finally:
                    part.close()
            out.write(f"</{root_tag}>\n".encode())
        finally:
            out.close()
        fs.delete(place, True)
        if not fs.rename(whole, place):
            raise RuntimeError(f"cannot rename {draft}.xml to {path}")
    finally:
        fs.delete(parts, True)
        fs.delete(whole, False)


def read_xml(spark: SparkSession, path: str, schema: T.StructType, row_tag: str = "row",
             explicit_nulls: bool = True) -> DataFrame:
    """Read rows written by either export (or any flat row/column XML) into
    ``schema``; elements with ``nil="true"``, whatever its prefix, become NULL."""
    if not explicit_nulls:
        return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    wrapped = T.StructType([
        T.StructField(f.name, T.StructType([T.StructField("_nil", T.StringType()),
                                            T.StructField("_VALUE", f.dataType)]))
        for f in schema.fields])
    raw = (spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true")
                .option("ignoreSurroundingSpaces", "false").schema(wrapped).load(path))
    return raw.select(*[
        F.when(F.col(f"{f.name}._nil") == "true", F.lit(None).cast(f.dataType))
         .otherwise(F.col(f"{f.name}._VALUE")).alias(f.name)
        for f in schema.fields])
