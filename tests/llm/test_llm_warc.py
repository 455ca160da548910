from __future__ import annotations

import base64
import hashlib
from html.parser import HTMLParser

import pytest

from plateflow.llm import warc
from plateflow.llm.frames import table

DATE = "2001-01-01T00:00:00Z"
PAGES = [
    (1, "http://a.example/x", "<html lang='de'><title>A &amp; B</title><p>one<br>two <b>three</b><script>var x='</p>';</script><a href=/l>l</a></html>"),
    (1, "http://a.example/x", "<html lang='de'><title>A &amp; B</title><p>one<br>two <b>three</b><script>var x='</p>';</script><a href=/l>l</a></html>"),
    (2, None, "<!-- x <p> -->t\u00e4xt &eacute;&#33;<style>p{}"), (3, "http://b.example/", None), (4, "u", ""),
    (5, "http://c.example/\n", "plain\r\n\r\ntext <p"), (None, "http://d.example/", "<p>" + "word " * 50000 + "</p>"),
]
SCHEMA = "page_id long, url string, html string"


def digest(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(PAGES, SCHEMA).repartition(3).select("*", F.lit("own").alias("block"), F.lit("own").alias("k0"))


def test_linked_records(spark, pages):
    sources = {r.page_id: r for r in warc.responses(pages, DATE).collect()}
    got = warc.flatten(warc.derive(warc.responses(pages, DATE), keep=["page_id"]), keep=["page_id"]).collect()
    assert len(got) == 2 * len(PAGES)
    for kind in ("metadata", "conversion"):
        for r in (x for x in got if x.warc_type == kind):
            source = {h.name: h.value for h in sources[r.page_id].headers}
            partner = {x.record_id for x in got if x.page_id == r.page_id and x.warc_type != kind}
            assert r.refers_to == source["WARC-Record-ID"] and r.warc_date == DATE
            assert {r.concurrent_to} == partner
            assert r.block_digest == digest(r.block) and r.content_length == len(r.block.encode())
            if kind == "metadata":
                assert f"source-payload-digest: {source['WARC-Payload-Digest']}\r\n" in r.block
                assert f"source-block-digest: {source['WARC-Block-Digest']}\r\n" in r.block
                assert "source-header: Content-Type: text/html; charset=utf-8\r\n" in r.block
            else:
                assert r.source_payload_digest == source["WARC-Payload-Digest"]
    texts = {r.page_id: r.block for r in got if r.warc_type == "conversion"}
    assert texts[1] == "A & B\none\ntwo threel" and texts[2] == "t\u00e4xt \u00e9!" and texts[3] == texts[4] == ""
    assert texts[5] == "plain\ntext" and len(texts[None]) == 5 * 50000 - 1
    about = next(r.block for r in got if r.warc_type == "metadata" and r.page_id == 1)
    assert "title: A & B\r\nlanguage: de\r\n" in about and "outlink: /l\r\n" in about


def test_files_round_trip(spark, pages, tmp_path):
    records = warc.responses(pages, DATE)
    whole = records.unionByName(warc.derive(records), allowMissingColumns=True).select("headers", "block")
    warc.write(whole, str(tmp_path / "w"))
    back = warc.read(spark, str(tmp_path / "w"))
    assert sorted(map(str, back.collect())) == sorted(map(str, whole.collect()))
    assert warc.derive(back).count() == 2 * len(PAGES)


def test_a_wrong_length_fails(spark, pages, tmp_path):
    from pyspark.sql import functions as F

    broken = warc.responses(pages.limit(1), DATE).withColumn("block", F.concat("block", F.lit("!")))
    warc.write(broken, str(tmp_path / "w"), compression="none")
    with pytest.raises(Exception, match="as long as it states"):
        warc.read(spark, str(tmp_path / "w")).collect()


def test_nothing(spark, pages):
    assert warc.derive(warc.responses(pages.limit(0), DATE)).collect() == []
    odd = spark.createDataFrame([(None, "x"), ([], None), ([("WARC-Type", "response")], None), ([("WARC-Type", None)], "y")],
                                f"headers {warc.HEADERS}, block string")
    assert warc.derive(odd).count() == 2


class Plain(HTMLParser):
    """The words of a page by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style")
        self.parts.append(" " if tag in warc.BLOCKS else "")

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style")
        self.parts.append(" " if tag in warc.BLOCKS else "")

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def test_text_against_the_standard_parser(spark, data_dir):
    for r in table(spark, data_dir, "pages").collect():
        parser = Plain()
        # Markup that the end cuts off is no text.
        page = r.html[:r.html.rfind("<")] if r.html.rfind("<") > r.html.rfind(">") else r.html
        parser.feed(page)
        parser.close()
        assert warc.plain(r.html)[0].split() == "".join(parser.parts).split(), r.page_id
