"""Links of stored pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.functions import urls
from gossamr.session import ship

#: The anchor tags that the quick extraction finds.
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
#: Entities that the quick extraction replaces, & last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href, link) for each quoted, non-empty href of an anchor tag, in document order.

    A native pass of regular expressions: markup in comments and scripts counts as well. pos counts from 0.
    """
    both = F.zip_with(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)), lambda a, b: F.when(a != "", a).otherwise(b))
    hrefs = pages.select("page_id", "url", F.posexplode(F.filter(both, lambda x: x != "")).alias("pos", "href"))
    text = F.col("href")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    hrefs = hrefs.withColumn("href", text)
    return hrefs.withColumn("link", urls.resolve(F.col("url"), F.col("href")))


class _Anchors(HTMLParser):
    def __init__(self, honor_base: bool):
        super().__init__(convert_charrefs=True)
        self.honor_base, self.base, self.hrefs, self.in_body = honor_base, None, [], False

    def handle_starttag(self, tag, attrs):
        href = dict(reversed(attrs)).get("href")
        if tag == "a" and href:
            self.hrefs.append(href)
        elif tag == "base" and href and self.honor_base and self.base is None and not self.in_body:
            self.base = href
        elif tag == "body":
            self.in_body = True

    handle_startendtag = handle_starttag


def extract_html(pages: DataFrame, honor_base: bool = False) -> DataFrame:
    """As extract(), by a tolerant HTML parser; comments and scripts hold no links. honor_base: resolve against <base>."""
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("base", T.StringType())])

    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                if html:
                    anchors = _Anchors(honor_base)
                    anchors.feed(html)
                    anchors.close()
                    out += [(page_id, url, pos, href, anchors.base) for pos, href in enumerate(anchors.hrefs)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)], names=schema.names)

    ship(pages.sparkSession)
    found = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, schema)
    base = F.when(F.col("base").isNotNull(), urls.resolve(F.col("url"), F.col("base"))).otherwise(F.col("url"))
    return found.withColumn("link", urls.resolve(base, F.col("href"))).drop("base")
