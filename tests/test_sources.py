"""Page extraction with both layouts, XML round trip, stop-word files, sinks."""

from conftest import SF001, rows
from pyspark.sql import types as T

from lexis.session import scratch_path
from lexis.sources.corpus import table
from lexis.sources.pages import SITE_ARTICLE, SITE_LINKS, extract_articles, extract_links
from lexis.sources.stopwords import read_stop_words, stop_word_list
from lexis.sources.tables import append_new, collector, stamp
from lexis.sources.xml import export_xml, read_xml


def listing_html():
    heads = [f'<h3 class="entry-title"><a href="https://site/{i}"><span>Title {i}</span></a></h3>'
             for i in range(28)]
    heads.insert(3, '<h3 class="entry-title"><a href="http://site/plain"><span>skip</span></a></h3>')
    heads.insert(5, '<h3 class="entry-title"><a href="https://site/nospan">No span</a></h3>')
    heads.append('<h3 class="entry-title"><a href="https://site/0"><span>Again</span></a></h3>')
    heads += ['<h3 class="entry-title"><a href="https://site/late"><span>Late</span></a></h3>'] * 2
    return "<html><body><script>var s='<h3 class=\"entry-title\">'</script>" + "".join(heads) + \
        "</body></html>"


def test_site_layout_links(spark):
    pages = spark.createDataFrame([(1, "https://site/", listing_html())],
                                  "page_id long, url string, html string")
    got = extract_links(pages, SITE_LINKS).orderBy("pos").collect()
    assert len(got) == 30                                   # first 30 only
    assert got[0].href == "https://site/0" and got[0].title == "Title 0"
    assert all(r.href.startswith("https://") for r in got)  # http:// link skipped
    nospan = [r for r in got if r.href.endswith("nospan")][0]
    assert nospan.title == "No span"                        # own text when no span
    assert [r.href for r in got].count("https://site/0") == 2   # repeats kept


def test_site_layout_article(spark):
    html = ('<div class="bdaia-post-content"><p>Para <b>one</b></p><p>Two &amp;lt; three<br>four'
            '<p>  Five&nbsp;six </p><p></p></div><div class="tagcloud"><a rel="tag" href="#">tagA</a>'
            '<a href="#">notag</a><a href="#" rel="tag">tag&amp;B</a></div>')
    pages = spark.createDataFrame([(1, "https://site/1", html)], "page_id long, url string, html string")
    titles = spark.createDataFrame([("https://site/1", "From listing")], "url string, title string")
    r = extract_articles(pages, SITE_ARTICLE, titles).collect()[0]
    assert r.content == "Para one Two &lt; three four Five six"
    assert r.keywords == "tagA;tag&B"
    assert r.title == "From listing"


def test_fixture_pages_unclosed_paragraphs(spark):
    art = extract_articles(table(spark, SF001, "pages"))
    r = art.orderBy("page_id").first()
    assert r.title and "<" not in r.content and r.keywords.count(";") >= 3


def test_xml_round_trip_with_nulls(spark):
    df = spark.createDataFrame([("id-1", "Anna", "Smith", "g1"), ("id-2", "Bo", "Li", None)],
                               "id string, name string, surname string, mygroup string")
    path = scratch_path(spark, "t-xml")
    export_xml(df, path, root_tag="students", single_file=True)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert "<students>" in text and '<mygroup nil="true"/>' in text
    back = read_xml(spark, path, df.schema)
    assert rows(back) == rows(df)


def test_xml_reads_plain_export_layout(spark, tmp_path):
    f = tmp_path / "students.xml"
    f.write_text('<students xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">\n\n<row>\n'
                 '  <id>0f0e</id>\n  <name>Anna</name>\n  <surname>Smith</surname>\n'
                 '  <mygroup>g-1</mygroup>\n</row>\n\n</students>\n', encoding="utf-8")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name", "surname", "mygroup")])
    got = read_xml(spark, str(f), schema, explicit_nulls=False).collect()
    assert [tuple(r) for r in got] == [("0f0e", "Anna", "Smith", "g-1")]


def test_stop_word_file(spark, tmp_path):
    f = tmp_path / "stop.txt"
    f.write_text("﻿c\nи\nпотому что\n\nтак\n", encoding="utf-8")
    assert stop_word_list(spark, str(f)) == sorted(["c", "и", "так"])
    assert read_stop_words(spark, str(f)).count() == 3


def test_collector_stamp_and_insert_or_ignore(spark):
    who = collector(spark, "Anna", "Smith", None)
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    st = stamp(docs, who).collect()
    assert len({r.collector_id for r in st}) == 1 and len(st[0].collector_id) == 32
    path = scratch_path(spark, "t-append")
    append_new(spark, docs, path, ["doc_id"])
    append_new(spark, docs.union(docs), path, ["doc_id"])
    assert spark.read.parquet(path).count() == 2
