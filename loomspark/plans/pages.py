"""Queries over saved pages, saved responses of interfaces, reports in chunks and findings, and what sinks write."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import documents as D
from ..operators import glossary as L
from ..session import scratch
from ..sources import api as A
from ..sources import sinks as S
from ..sources import tables as B
from .registry import query

# --- pages


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'Dublin ' || page_id WHEN 1 THEN 'Graph' WHEN 2 THEN 'A heading that is long enough to count ' || page_id WHEN 3 THEN 'Short' WHEN 4 THEN 'Second level' END AS title FROM pages""")
def page_titles(t):
    k, i = F.col("page_id") % 6, F.col("page_id").cast("string")
    html = (
        F.when(k == 0, F.concat(F.lit('<meta name="dcterms.title" content=" Dublin '), i, F.lit('"><h1>Other title</h1>')))
        .when(k == 1, '<meta property="og:title" content="Graph"><h1>Other title</h1>')
        .when(k == 2, F.concat(F.lit('<h1 class="x sr-only">Only for readers of the screen, at length</h1><h1>Site name</h1><h1>A heading that is <b>long</b> enough to count '), i, F.lit("</h1>")))
        .when(k == 3, "<h1>Short</h1><h1>Also</h1><h2>Second level</h2>").when(k == 4, "<h1> </h1><h2>Second <i>level</i></h2>").otherwise("<h2>no</h2>")
    )
    return t("pages").select("page_id", X.page_title(html).alias("title"))


@query("""SELECT page_id, 'http://h.org/r/' || page_id || '.pdf http://h.org/a/b/x.PDF?v=1 http://h.org/doc/pdf http://h.org/get?format=pdf http://h.org/a/file https://other.net/y.pdf' AS links FROM pages""")
def document_links_found(t):
    html = F.concat(F.lit('<a class="c" href="/r/'), "page_id", F.lit('.pdf">one</a><a href="b/x.PDF?v=1">two</a><a href="/r/none.html">no</a><a href="//h.org/doc/pdf">3</a><a href="/get?format=pdf">4</a><a href="file" title="Download it.docx">5</a><a href="https://other.net/y.pdf">6</a><a href="b/x.PDF?v=1">again</a>'))
    return t("pages").select("page_id", F.array_join(X.document_links(html, F.lit("http://h.org/a/page?x=1")), " ").alias("links"))


@query("""SELECT page_id, 'http://h.org/p/' || page_id || '/report http://h.org/p/' || page_id || '/about http://h.org/p/' || page_id || '/x1 http://h.org/p/' || page_id || '/x2 http://h.org/p/' || page_id || '/x3' AS links FROM pages""")
def child_pages_found(t):
    at = F.concat(F.lit("/p/"), "page_id")
    hrefs = [F.concat(at, F.lit("/about#top")), F.lit("/p"), F.concat(at, F.lit("/a/b")), F.concat(at, F.lit("/x1?q=2")), F.concat(F.lit("http://h.org"), at, F.lit("/report")), F.concat(F.lit("http://no.org"), at, F.lit("/z")), *[F.concat(at, F.lit(f"/x{k}")) for k in (1, 2, 3, 4)]]
    html = F.concat(*[x for h in hrefs for x in (F.lit('<a href="'), h, F.lit('">t</a>'))])
    return t("pages").select("page_id", F.array_join(X.child_pages(html, F.concat(F.lit("http://h.org"), at, F.lit("?q=1"))), " ").alias("links"))


@query("""SELECT page_id, '2020-01-02' AS date, 'A & B ' || page_id AS author, 'first' AS title, 'Energy' AS sector, '12' AS pages FROM pages""")
def page_cells(t):
    html = F.concat(F.lit('<meta name="Author" content="A &amp; B '), "page_id", F.lit('"><meta name="title" content="first"><meta property="og:title" content="second"><time class="c" datetime="2020-01-02">x</time><dl><dt>Sector:</dt> <dd><b>Energy</b></dd></dl><table><tr><th>Pages</th><td> 12 </td></tr><tr><th>Empty</th><td></td></tr></table>'))
    cells = t("pages").select("page_id", A.meta_cells(html).alias("c"))
    return cells.select("page_id", *[F.col("c")[k].alias(k) for k in ("date", "author", "title", "sector", "pages")])


# --- saved responses


def _responses(t):
    """Pages of 20 parts as three kinds of services answer; the pages from the fourth on repeat earlier items."""
    part = t("part").filter("p_partkey between 1 and 60")
    lowest = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.floor((F.col("p_partkey") - 1) / 20).cast("int").alias("page"))
    rows = lowest.unionByName(lowest.withColumn("page", F.col("page") + 3)).unionByName(lowest.filter("page = 0").withColumn("id", F.col("id") + 1000).withColumn("page", F.lit(6)))
    lists = rows.groupBy("page").agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "name")))).alias("a"), F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("id", "name"))), lambda s: F.struct(s.alias("_source")))).alias("b"))
    k = F.col("page") % 3
    body = F.when(k == 0, F.concat(F.lit('{"results": [{"hits": '), "a", F.lit("}]}"))).when(k == 1, F.concat(F.lit('{"took": 1, "hits": {"hits": '), "b", F.lit("}}"))).otherwise(F.concat(F.lit('{"meta": {"tags": [{"t": 1}]}, "data": {"list": '), "a", F.lit("}}")))
    return lists.select("page", body.alias("body"))


@query("SELECT p_partkey AS id, ((p_partkey - 1) // 20)::INTEGER AS page, p_name AS name FROM part WHERE p_partkey BETWEEN 1 AND 60")
def responses_replayed(t):
    found = A.replay(A.items(_responses(t), "page", "body"), F.get_json_object("item", "$.id").cast("long"))
    return found.select("id", "page", F.get_json_object("item", "$.name").alias("name"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'http://x.org/a' WHEN 1 THEN 'https://s.org/b/' || p_partkey WHEN 2 THEN 'https://s.org/docs/slug' ELSE 'https://s.org/docs/all/' || p_partkey END AS url, 'brand=' || p_brand || ';tags=["x","y"]' AS cells, 'https://s.org/api/d/' || p_partkey || '/f/1 https://s.org/api/d/' || p_partkey || '/f/b2' AS files FROM part""")
def item_addresses(t):
    k, i = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    url = F.when(k == 0, "http://x.org/a").when(k == 1, F.concat(F.lit("/b/"), i)).when(k == 2, " slug").otherwise("")
    item = F.concat(F.lit('{"id": '), i, F.lit(', "url": "'), url, F.lit('", "brand": " '), "p_brand", F.lit('", "tags": ["x", "y"], "none": null, "blank": "", "_score": 1, "files": [{"fid": 1}, {"n": 0}, {"fid": "b2"}]}'))
    rows = t("part").select("p_partkey", item.alias("item"))
    cells = A.item_metadata(F.col("item"), ["url", "id", "files"])
    said = F.array_join(F.transform(F.array_sort(F.map_entries(cells)), lambda e: F.concat_ws("=", e["key"], F.replace(e["value"], F.lit(", "), F.lit(",")))), ";")
    return rows.select("p_partkey", A.item_url(F.get_json_object("item", "$.url"), "https://s.org", "https://s.org/docs/all", F.col("p_partkey")).alias("url"), said.alias("cells"), F.array_join(A.file_urls(F.col("item"), "files", "fid", F.col("p_partkey"), "https://s.org/api/d/{doc_id}/f/{file_id}"), " ").alias("files"))


@query("""SELECT 'https://c.org/' || s_suppkey AS page_url, 'It’s ' || s_name || ' & co' AS title, 'https://c.org/f.pdf https://c.org/g.docx' AS files, '["a","b"]' AS kinds, 3::BIGINT AS cells FROM supplier""")
def cms_records(t):
    item = F.concat(F.lit('{"link": "https://c.org/'), "s_suppkey", F.lit('", "title": {"rendered": "It&rsquo;s '), "s_name", F.lit(' &amp; co"}, "acf": {"skipped": "x", "kinds": ["a", "b"], "name": "n", "files": [{"url": "https:\\/\\/c.org\\/f.pdf"}, {"deep": {"u": "https://c.org/g.docx"}}, {"url": "https://c.org/f.pdf"}], "empty": ""}}'))
    found = A.cms_records(t("supplier").select(item.alias("item")), ["skipped"])
    return found.select("page_url", "title", F.array_join("doc_urls", " ").alias("files"), F.replace(F.col("metadata")["kinds"], F.lit(", "), F.lit(",")).alias("kinds"), F.size("metadata").cast("long").alias("cells"))


@query("SELECT 'http://c/' || c_custkey AS page_url, c_name AS title, c_mktsegment AS segment, 1::BIGINT + (c_nationkey % 2 = 0)::INTEGER AS cells FROM customer WHERE c_custkey % 5 > 0")
def export_records(t):
    export = t("customer").select(F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit(" http://c/"), "c_custkey")).alias("Url"), F.col("c_name").alias("Title"), F.col("c_mktsegment").alias("segment"), F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise(" ").alias("parity"))
    return A.export_records(export, "Url", "Title").select("page_url", "title", F.col("metadata")["segment"].alias("segment"), F.size("metadata").cast("long").alias("cells"))


@query("SELECT 'sitemap' AS strategy, count(*) AS n FROM nation")
def strategy_chain(t):
    nation = t("nation").select("n_nationkey")
    name, df = A.first_strategy({"browser": lambda: nation, "api": lambda: nation.filter("false"), "cms": lambda: nation.limit(0), "sitemap": lambda: nation, "links": lambda: nation.limit(1)}, "api")
    return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("strategy"), "n")


# --- reports

_TITLE = "concat('Report of ', doc_id, ' on things')"


def _reports(t):
    text = F.concat(
        F.lit("# Report of "), "doc_id", F.lit(" on things\nAuditor-General Report No. "), (F.col("doc_id") % 50 + 1).cast("string"), F.lit(" of 2019-20\n\n## Summary\n\n1. The first, see paragraphs 2."), (F.col("doc_id") % 9 + 1).cast("string"),
        F.lit(" to 2.9 of it.\n2. A second without a reference.\n\nRecommendation No. 1 Paragraph 2.5 Do the first thing.\nEntity A response: Agreed.\nEntity B response: noted\n\nRecommendation No. 1 Paragraph 2.5 Short.\n\nRecommendation No. 2 Paragraph 3.1 Do "), "lang", F.lit(".\nEntity A response: Disagreed\n\n## Conclusion\nIt was "),
        F.when(F.col("doc_id") % 3 == 0, "largely effective").when(F.col("doc_id") % 3 == 1, "effective").otherwise("not effective"), F.lit(" in all.\n"),
    )
    return t("documents").select("doc_id", text.alias("text"))


@query("""SELECT doc_id AS doc, 'Report of ' || doc_id || ' on things' AS title, (doc_id % 50 + 1)::VARCHAR AS report_number, '2019-20' AS report_year, CASE doc_id % 3 WHEN 0 THEN 'partly effective' WHEN 1 THEN 'effective' ELSE 'not effective' END AS rating FROM documents""")
def report_metadata(t):
    return D.report_metadata(_reports(t), "doc_id", "text")


@query("""SELECT doc_id AS doc, p AS paragraph, 'Summary' AS subsection, CASE WHEN p = 1 THEN (2001 + doc_id % 9)::INTEGER END AS low, CASE WHEN p = 1 THEN 2009 END AS high, CASE WHEN p = 1 AND doc_id % 9 + 1 <= 5 THEN 1 END AS number FROM documents, (SELECT unnest([1, 2])::INTEGER AS p)""")
def report_findings(t):
    found = D.findings(_reports(t), "doc_id", "text")
    links = D.linked(found, D.recommendations(_reports(t), "doc_id", "text")).select(F.col("doc").alias("d"), F.col("paragraph").alias("p"), "number")
    return found.join(links, (F.col("doc") == F.col("d")) & (F.col("paragraph") == F.col("p")), "left").select("doc", "paragraph", "subsection", "low", "high", "number")


@query("""SELECT doc_id AS doc, n AS number, CASE n WHEN 1 THEN 2005 ELSE 3001 END AS place, CASE n WHEN 1 THEN 'Do the first thing.' ELSE 'Do ' || lang || '.' END AS text, CASE n WHEN 1 THEN 'Entity A=Agreed; Entity B=noted' ELSE 'Entity A=Disagreed' END AS responses FROM documents, (SELECT unnest([1, 2])::INTEGER AS n)""")
def report_recommendations(t):
    found = D.recommendations(_reports(t), "doc_id", "text")
    return found.select("doc", "number", "place", "text", F.array_join(F.transform("responses", lambda r: F.concat_ws("=", r["entity"], r["response"])), "; ").alias("responses"))


@query("""WITH d AS (SELECT doc_id, 'This paragraph of document ' || doc_id || ' is long enough to be kept as a chunk of its own.' AS p FROM documents)
SELECT doc_id AS doc, 1 AS seq, p AS text, 'Key findings' AS section_title, '7' AS page_number, 'key_finding' AS role, '1.1' AS paragraph_id, false AS is_recommendation FROM d UNION ALL SELECT doc_id, 2, p || chr(10) || 'It goes on.', 'Key findings', '8', 'key_finding', '1.2', false FROM d UNION ALL SELECT doc_id, 3, p, 'Recommendations', '8', 'recommendation', '2.1', true FROM d""")
def document_chunks(t):
    p = F.concat(F.lit("This paragraph of document "), "doc_id", F.lit(" is long enough to be kept as a chunk of its own."))
    text = F.concat(F.lit("front matter that is before any heading, so it goes, whatever its length may be\n# Key findings\n<!-- page 7 -->\n"), p, F.lit("\n\nshort\n\n12\n<!-- page 8 -->\n"), p, F.lit("\nIt goes on.\n## Recommendations\n"), p, F.lit("\n### Annex\n"))
    return D.chunks(t("documents").select("doc_id", text.alias("text")), "doc_id", "text").select("doc", "seq", "text", "section_title", "page_number", "role", "paragraph_id", "is_recommendation")


@query("""SELECT n_nationkey AS doc, '<!-- page 3 -->' || chr(10) || chr(10) || '## ' || n_name || chr(10) || chr(10) || '- item[^2]' || chr(10) || chr(10) || 'Some **bold** text & more' || chr(10) || chr(10) || '[^2]: the note' AS markdown FROM nation""")
def blocks_rendered(t):
    rows = [("Page", F.lit("")), ("PageHeader", F.lit("x")), ("SectionHeader", F.concat(F.lit("<h2>"), "n_name", F.lit("</h2>"))), ("ListItem", F.lit("• item<sup>2</sup>")), ("Text", F.lit("<p>Some <b>bold</b> text &amp; more</p>")), ("Footnote", F.lit("<sup>2</sup> the note"))]
    cells = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(kind).alias("block_type"), html.alias("html"), F.lit(3).alias("page"), F.lit(None).cast("int").alias("heading_level")) for k, (kind, html) in enumerate(rows)])
    return D.render_blocks(t("nation").select(F.col("n_nationkey").alias("doc"), F.explode(cells).alias("b")).select("doc", "b.*"))


@query("SELECT n_nationkey AS doc, 2 AS seq FROM nation UNION ALL SELECT n_nationkey, 3 FROM nation")
def blocks_section(t):
    rows = [("SectionHeader", "Preface"), ("SectionHeader", "1. Summary of findings"), ("Text", "a"), ("SectionHeader", "Detail"), ("SectionHeader", "Recommendations"), ("Text", "b")]
    cells = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(kind).alias("block_type"), F.lit(html).alias("html")) for k, (kind, html) in enumerate(rows)])
    return D.section(t("nation").select(F.col("n_nationkey").alias("doc"), F.explode(cells).alias("b")).select("doc", "b.*"), "(?i)summary", "(?i)^recommendations").select("doc", "seq")


# --- what sinks write, read again


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_lines_round_trip(t):
    df = t("customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch(df.sparkSession, "lines")
    S.json_lines(df, path, "c_custkey")
    return B.json_lines(df.sparkSession, path, df.schema)


@query("SELECT p_partkey AS record, CASE WHEN p_size > 40 THEN 'third' WHEN p_size > 20 THEN 'second' ELSE 'first' END AS cluster, CASE WHEN p_size > 40 THEN 3 WHEN p_size > 20 THEN 2 ELSE 1 END AS layer FROM part")
def layers_round_trip(t):
    """Three layers appended, the second of them twice; each record's last one."""
    part = t("part").select(F.col("p_partkey").alias("record"), "p_size")
    path = scratch(part.sparkSession, "layers")
    for layer, name, least in ((1, "first", 0), (2, "wrong", 20), (2, "second", 20), (3, "third", 40)):
        S.append_layer(part.filter(F.col("p_size") > least).select("record", F.lit(name).alias("cluster")), path, layer)
    return L.latest_assignments(part.sparkSession.read.parquet(path)).select("record", "cluster", "layer")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'P' ELSE o_orderstatus END AS status FROM orders UNION ALL SELECT -1, 'new'")
def upserts_round_trip(t):
    rows = t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, "upserts")
    S.upsert(spark, rows, folder, "o_orderkey")
    S.upsert(spark, rows.filter("o_orderkey % 3 = 0").withColumn("status", F.lit("P")).unionByName(spark.createDataFrame([(-1, "new")], "o_orderkey long, status string")), folder, "o_orderkey")
    return S.current(spark, folder)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'two' || chr(10) || 'lines, \"quoted\"' END AS note FROM supplier")
def csv_round_trip(t):
    df = t("supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.lit('two\nlines, "quoted"')).alias("note"))
    path = scratch(df.sparkSession, "csv")
    S.csv(df, path)
    return B.catalogue(df.sparkSession, path)


@query("SELECT n_nationkey AS id, n_name AS tag FROM nation")
def tags_round_trip(t):
    """Tag files, half of them wrapped."""
    spark = t("nation").sparkSession
    one = F.concat(F.lit('"'), "n_nationkey", F.lit('": {"tag": "'), "n_name", F.lit('"}'))
    parts = t("nation").groupBy((F.col("n_nationkey") % 4).alias("k")).agg(F.array_join(F.collect_list(one), ", ").alias("m"))
    path = scratch(spark, "tags")
    body = F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"tags": {'), "m", F.lit("}}"))).otherwise(F.concat(F.lit("{"), "m", F.lit("}")))
    parts.repartition(4, "k").select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return B.tags(spark, path, ["tag"]).select(F.col("id").cast("int").alias("id"), "tag")


@query("""SELECT lower(r_name) AS term FROM region UNION SELECT 'the'""")
def stoplist_round_trip(t):
    spark = t("region").sparkSession
    path = scratch(spark, "stop")
    lines = t("region").select(F.concat(F.lower("r_name"), F.lit("  # a region")).alias("value"))
    lines.unionByName(spark.createDataFrame([("# only a remark",), ("",), ("the",), ("the",)], "value string")).write.text(path)
    return B.stoplist(spark, path)


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')")
def sitemap_round_trip(t):
    spark = t("pages").sparkSession
    path = scratch(spark, "sitemap")
    t("pages").filter("url is not null").select(F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc></url>")).alias("value")).write.text(path)
    found = B.sitemap(spark, path, "https://")
    return t("pages").select("page_id", "url").join(found, "url", "left_semi").select("page_id", "url")
