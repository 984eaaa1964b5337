"""Articles and links out of raw web pages (page_id, url, html).

Every step is a column expression on the page row: no parser library, no
Python worker, no shuffle. Selectors are arguments; two presets exist: the
layout of the driver's ``pages`` fixture and the layout of the news site the
ranking being matched was built on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.html import (Sel, clean, first, inner_first, inners, let, links, marked, paragraphs,
                                  text)
from lexis.sources.corpus import spread

# Links taken per listing page.
LINKS_PER_PAGE = 30


@dataclass(frozen=True)
class ArticleSpec:
    container: Sel                      # the article body, may occur several times
    paragraph: str = "p"                # paragraph tag inside the container
    title: Sel | None = None            # first match anywhere in the page
    keyword_container: Sel | None = None
    keyword_link: Sel = Sel("a")
    keyword_sep: str = ";"
    paragraph_sep: str = " "


@dataclass(frozen=True)
class LinkSpec:
    container: Sel                      # e.g. a heading holding the link
    link: Sel                           # attribute selector, e.g. a[href^=https://]
    title: Sel | None = None            # element inside the link holding the title
    limit: int = LINKS_PER_PAGE


# --- fixed values: the two page layouts ------------------------------------
# Fixture pages: <article> with <h1> and <p>s, links in <nav>.
FIXTURE_ARTICLE = ArticleSpec(container=Sel("article"), title=Sel("h1"),
                              keyword_container=Sel("nav"), keyword_link=Sel("a"))
FIXTURE_LINKS = LinkSpec(container=Sel("nav"), link=Sel("a", attr="href", op="^=", value="/"))
# News-site layout: body in div.bdaia-post-content p, tags in div.tagcloud a[rel=tag],
# listing links in h3.entry-title a[href^=https://] with the title in a span.
SITE_ARTICLE = ArticleSpec(container=Sel("div", cls="bdaia-post-content"),
                           keyword_container=Sel("div", cls="tagcloud"),
                           keyword_link=Sel("a", attr="rel", value="tag"))
SITE_LINKS = LinkSpec(container=Sel("h3", cls="entry-title"),
                      link=Sel("a", attr="href", op="^=", value="https://"), title=Sel("span"))
# ---------------------------------------------------------------------------


def extract_links(pages: DataFrame, spec: LinkSpec = FIXTURE_LINKS) -> DataFrame:
    """(page_id, url, pos, href, title): links of a listing page in page
    order, the first ``spec.limit`` only.

    Link and title come from the same element; a link without the title
    element falls back to the link's own text.
    """
    found = F.slice(links(clean(F.col("html")), spec.link, within=spec.container), 1, spec.limit)
    rows = spread(pages, "page_id").select("page_id", "url", F.posexplode(found).alias("pos", "a"))
    inner = F.col("a.inner")
    own = text(inner)
    title = own if spec.title is None else F.coalesce(
        F.nullif(text(inner_first(inner, spec.title)), F.lit("")), own)
    return rows.select("page_id", "url", "pos", F.col("a.href").alias("href"), title.alias("title"))


def extract_articles(pages: DataFrame, spec: ArticleSpec = FIXTURE_ARTICLE,
                     titles: DataFrame | None = None) -> DataFrame:
    """(page_id, url, title, content, keywords), one row per page.

    content: texts of all paragraphs of all containers joined by a space;
    keywords: texts of the tag links joined by ';'. ``titles`` (url, title,
    and page_id and pos for their order), e.g. from ``extract_links`` on the
    listing page, overrides the title; of a repeated link the first title wins.
    """
    def fields(page):
        paras = F.flatten(F.transform(inners(page, spec.container), lambda c: paragraphs(c, spec.paragraph)))
        if spec.keyword_container is not None:
            kw = F.transform(inners(page, spec.keyword_link, spec.keyword_container), text)
            keywords = F.array_join(F.filter(kw, lambda s: s != ""), spec.keyword_sep)
        else:
            keywords = F.lit("")
        title = text(first(page, spec.title)) if spec.title is not None else F.lit(None).cast("string")
        return F.struct(title.alias("title"), F.array_join(paras, spec.paragraph_sep).alias("content"),
                        keywords.alias("keywords"))

    kinds = [spec.container, spec.title, spec.keyword_container]
    if spec.keyword_container is not None:
        kinds.append(spec.keyword_link)
    out = (spread(pages, "page_id").select("page_id", "url", let(marked(clean(F.col("html")), *kinds), fields).alias("a"))
           .select("page_id", "url", "a.title", "a.content", "a.keywords"))
    if titles is not None:
        # The first title of a url in listing order; AQE turns this into a
        # broadcast join at run time when the listing side proves small.
        order = F.struct(*[c for c in ("page_id", "pos") if c in titles.columns], "title")
        t = titles.groupBy("url").agg(F.min_by("title", order).alias("_t"))
        out = (out.join(t, "url", "left")
                  .withColumn("title", F.coalesce("_t", "title")).drop("_t")
                  .select("page_id", "url", "title", "content", "keywords"))
    return out
