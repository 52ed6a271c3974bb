import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomspark.functions import text as X
from loomspark.functions import tolerant
from loomspark.functions import values as V
from loomspark.operators import documents as D
from loomspark.operators import graphs as G
from loomspark.operators import measure as M
from loomspark.operators import providers as P
from loomspark.operators import relate as R
from loomspark.sources import sinks, tables
from loomspark.streaming import incremental


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], [*values]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("name,want", [("Alpha Solar Project", "alpha solar"), ("alpha solar (Phase 2)", "alpha solar"), ("The Energy - Study/Trial", "")])
def test_normalise_name(spark, name, want):
    assert one(spark, X.normalise_name(F.col("n")), n=name) == want


def test_text_functions(spark):
    assert one(spark, X.slug(F.col("t")), t="  Hello, World! ") == "hello_world"
    assert one(spark, X.stem(F.col("t")), t="-My File--Name_") == "my_file_name"
    assert one(spark, X.ngrams(F.split(F.col("t"), " "), 3), t="a b c d") == ["a b c", "b c d"]
    assert one(spark, X.ngrams(F.split(F.col("t"), " "), 5), t="a b") == []
    assert one(spark, X.html_text(F.col("t")), t="<p>A <b>bold</b> &amp; <i>it</i><sup>3</sup><script>x<y</script></p>") == "A **bold** & *it*⟦FN:3⟧"
    assert one(spark, X.footnote_number(F.col("t")), t="<p>12 See there</p>") == "12"
    assert one(spark, X.clean_heading(F.col("t")), t="4 **Key  insights and** **implications**") == "4 Key insights and implications"
    assert [one(spark, X.heading_role(F.col("t")), t=t) for t in ("Executive Summary", "Recommendations.", "Background", "Other")] == ["overview", "recommendation", "introduction", ""]
    assert one(spark, X.split_long(F.col("t"), 10), t="One two. Three four. Five.") == ["One two.", "Three four.", "Five."]
    assert one(spark, X.split_long(F.col("t"), 100), t="One two. Three.") == ["One two. Three."]
    assert [tuple(s) for s in one(spark, X.backward_spans(F.col("n"), 10, 2, 12), n=25)] == [(1, 15, 25), (2, 7, 17), (3, 0, 9)]
    source = "x" * 100 + " The quick brown fox jumps. " + "y" * 100
    window = lambda e, h=None: one(spark, X.context_window(F.col("s"), F.lit(e), F.lit(None).cast("int"), F.lit(h).cast("string"), 5, 20), s=source)
    assert window("the QUICK brown fox jumps.") == source[96:132] and window("absent words that are long enough", "The quick brown fox j") == source[96:106]
    assert window("no") == source[:20]
    style = lambda t: one(spark, X.heading_style(F.col("t")), t=t)
    assert style("# A\n## B\n### C") == "markdown" and style("\n".join(f"1.{i} this is a long paragraph of text, is it not; yes." for i in range(12))) == "numbered_para"
    assert style("1.1 First Part\n1.2 Second Part\n2.1 Third Part") == "numbered_section" and style("FIRST PART\nSECOND PART\nTHIRD PART") == "allcaps" and style("plain") == "minimal"


def test_values(spark):
    assert one(spark, V.first_filled(F.col("a"), F.col("b")), a=" ", b="x") == "x"
    assert one(spark, V.split_multi(F.col("a")), a="x, ;y ") == ["x", "y"]
    assert [str(one(spark, V.parse_date(F.col("a")), a=d)) for d in ("2024-02-03", "3/2/2024", "3 February 2024")] == ["2024-02-03"] * 3
    assert one(spark, V.year(F.col("a")), a="in 1899, 2007 or 2011") == 2007
    assert one(spark, V.era(F.col("y"), (2000, 2010)), y=2005) == "2000-2009"
    assert one(spark, V.cosine(F.col("a"), F.col("b")), a=[1.0, 0.0], b=[1.0, 1.0]) == pytest.approx(2**-0.5)


@pytest.mark.parametrize("text,method,value", [
    ('```json\n{"a": 1}\n```', "strict", {"a": 1}),
    ('Here: {"a": {"b": 2}} done', "lenient", {"a": {"b": 2}}),
    ('{"r": [{"a": "}"}, {"b": 2}, {"c":', "recovered", {"_recovered": [{"a": "}"}, {"b": 2}]}),
    ('[{"a": 1}, {bad}, {"b": 2}, {"c', "recovered", {"_recovered": [{"a": 1}, {"b": 2}]}),
    ("nothing", "failed", None), ("", "failed", None), (None, "failed", None),
])
def test_tolerant_json(spark, text, method, value):
    got = spark.createDataFrame([(text,)], "t string").select(tolerant.parse_tolerant(F.col("t")).alias("r")).first().r
    assert got.method == method and (json.loads(got.json) if got.json else None) == value


MARKDOWN = """front matter that is long enough to be a paragraph of its own here

# Executive Summary
<!-- page 3 -->
The first paragraph is long enough to be kept as one, since it has words.
Its second line.

short

12
The second paragraph is also long enough to be kept, and it comes after a page.
## Recommendations
The third paragraph is under recommendations and is long enough to be kept too.
### Annex
""" + "This sentence is repeated to make a paragraph long. " * 100


def test_chunks(spark):
    docs = spark.createDataFrame([("d", MARKDOWN), ("e", "no headings at all but a paragraph that is long enough to be kept whole")], "doc string, text string")
    rows = sorted(D.chunks(docs, "doc", "text").collect(), key=lambda r: (r.doc, r.seq))
    d = [r for r in rows if r.doc == "d"]
    assert d[0].text.endswith("Its second line.") and d[0].page_number == "3" and d[0].role == "overview" and d[0].paragraph_id == "1.1"
    assert d[1].text.startswith("The second") and d[2].is_recommendation and not any("front matter" in r.text or r.text == "short" for r in d)
    assert len(d) == 5 and all(len(r.text) <= 4000 for r in d)
    assert [r.text for r in rows if r.doc == "e"] == ["no headings at all but a paragraph that is long enough to be kept whole"]


REPORT = """# Management of Things
Report No. 12 of 2019-20
# Summary
## Planning
1. Planning was weak. (See paragraphs 2.5 to 2.12)
2. Nothing else.
## Delivery
3. Delivery was late. (See paragraph 3.1)
# Conclusion
The management of things was partly effective overall.
# Recommendations
Recommendation no. 1
Paragraph 2.10
The department should plan.
Department of Things response: Agreed.
Office of Stuff response: Noted.
Recommendation no. 2
Paragraph 3.4
The department should deliver.
Department of Things response: Agreed with qualification.
"""


def test_audit_report(spark):
    docs = spark.createDataFrame([("r", REPORT)], "doc string, text string")
    meta = D.report_metadata(docs, "doc", "text").first()
    assert (meta.title, meta.report_number, meta.report_year, meta.rating) == ("Management of Things", "12", "2019-20", "partly effective")
    found, recs = D.findings(docs, "doc", "text"), D.recommendations(docs, "doc", "text")
    assert [(r.paragraph, r.subsection, r.low, r.high) for r in found.orderBy("pos").collect()] == [(1, "Planning", 2005, 2012), (2, "Planning", None, None), (3, "Delivery", 3001, 3001)]
    got = {r.number: r for r in recs.collect()}
    assert got[1].text == "The department should plan." and [tuple(x) for x in got[1].responses] == [("Department of Things", "Agreed"), ("Office of Stuff", "Noted")]
    assert [tuple(r) for r in D.linked(found, recs).collect()] == [("r", 1, 1)]


def test_blocks(spark):
    rows = [("d", 1, "Page", "", 4, None), ("d", 2, "SectionHeader", "<h2><b>Scope</b></h2>", 4, 2), ("d", 3, "ListItem", "<li>x one</li>", 4, None), ("d", 4, "Footnote", "<p><sup>7</sup> See</p>", 4, None), ("d", 5, "TableOfContents", "<p>toc</p>", 4, None), ("d", 6, "SectionHeader", "<h2>End</h2>", 4, 2), ("d", 7, "Text", "<p>after</p>", 4, None)]
    blocks = spark.createDataFrame(rows, "doc string, seq int, block_type string, html string, page int, heading_level int")
    assert D.render_blocks(blocks).first().markdown == "<!-- page 4 -->\n\n## Scope\n\n- one\n\n[^7]: See\n\n## End\n\nafter"
    assert [r.seq for r in D.section(blocks, "Scope", "End").orderBy("seq").collect()] == [3, 4, 5]


def test_votes_and_sets(spark):
    votes = spark.createDataFrame([("a", v) for v in "xxxyz"] + [("b", v) for v in ["x"] * 7 + ["y"] * 3] + [("c", " ")], "k string, v string")
    got = {r.k: (r.v, r.contested) for r in R.majority(votes, "k", "v").collect()}
    assert got == {"a": ("x", True), "b": ("x", False)}
    layers = [spark.createDataFrame([(1, "a")], "id int, x string"), spark.createDataFrame([(1, "b", 1), (2, "c", 2)], "id int, x string, y int")]
    assert sorted(tuple(r) for r in R.union_first_wins(layers, "id").select("id", "x", "y").collect()) == [(1, "a", None), (2, "c", 2)]
    paths = spark.createDataFrame([("h/a",), ("h/a/b",), ("h/ab",), ("h/c/d",)], "p string")
    assert sorted(r.path for r in R.prefix_dedupe(paths, "p").collect()) == ["h/a", "h/ab", "h/c/d"]


def test_measures(spark):
    same = spark.createDataFrame([(i % 2, i % 2, i // 2 % 2) for i in range(8)], "x int, y int, z int")
    assert M.mutual_information(same, "x", "y").first().nmi == pytest.approx(1) and M.mutual_information(same, "x", "z").first().nmi == pytest.approx(0)
    groups = spark.createDataFrame([(1, "a", "p"), (1, "a", "p"), (1, "a", "q"), (1, "b", "q"), (1, "b", "q")], "g int, a string, b string")
    r = M.pair_jaccard(groups, ["g"], "a", "b").first()
    assert (r.pairs_a, r.pairs_b, r.both, r.jaccard) == (4, 4, 2, pytest.approx(2 / 6))
    ten = spark.createDataFrame([(1, float(i)) for i in range(10)], "g int, x double")
    d = M.describe(ten, ["g"], "x").first()
    assert (d.p10, d.p50, d.p90, d.n) == (1, 5, 9, 10)


def test_graphs(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (40, 60)], "a long, b long")
    got = {r.node: r.component for r in G.components(edges, spark.range(70).withColumnRenamed("id", "node")).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[60] == got[50] == 40 and got[35] == 35
    assert G.indel_ratio("abcd", "abed") == pytest.approx(75) and G.indel_ratio("", "") == 100
    names = spark.createDataFrame([(1, "alpha solar"), (2, "solar alpha"), (3, "beta wind"), (4, "alpha solars")], "id long, n string")
    assert {(r.a, r.b) for r in G.fuzzy_pairs(names, 82, "id", "n").collect()} == {(1, 2), (1, 4), (2, 4)}
    labels = spark.createDataFrame([("r1", 0, "Late delivery schedule"), ("r1", 1, "Weak contract"), ("r2", 0, "Schedule delivery delays")], "run string, position int, name string")
    assert [r.cls for r in G.greedy_classes(labels, "run", "position", "name").orderBy("run").collect()][-1] == 0
    v = pd.DataFrame({"id": [3, 1, 2], "v": [[1.0, 0.0], [0.99, 0.1], [0.0, 1.0]]})
    assert dict(G.average_linkage(v, 0.8).itertuples(index=False)) == {3: 1, 1: 1, 2: 2}


def test_providers(spark):
    prompts = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, prompt string")
    table = prompts.filter("id = '1'").select(F.sha2("prompt", 256).alias("prompt_sha"), F.lit("reply").alias("text"))
    replies = P.replay(prompts, table)
    assert {r.id: r.text for r in replies.collect()} == {"1": "reply", "2": None}
    assert [r.id for r in P.pending(prompts, replies).collect()] == ["2"]

    def call(p):
        if p == "b":
            raise RuntimeError("down")
        return p.upper()

    assert {r.id: (r.text, r.error) for r in P.complete(prompts, call, wait=0).collect()} == {"1": ("A", None), "2": (None, "down")}
    got = spark.createDataFrame([("1", "yes"), ("1", "maybe"), ("9", "no")], "id string, v string")
    assert {r.problem: r.n for r in P.validate(got, prompts, "id", "v", ["yes", "no"]).collect()} == {"missing": 1, "extra": 1, "duplicated": 1, "out_of_vocabulary": 1}
    df = prompts.select(P.render("x {a} {\"k\": {b}}", a=F.col("id"), b=F.col("prompt")).alias("p"))
    assert df.first().p == 'x 1 {"k": a}'
    block = P.record_block(F.lit("7"), F.lit("n"), F.lit("e"), {"occ": F.lit("yes"), "mech": F.lit("no")})
    assert one(spark, block) == "7 | occ\nn\nevidence: e"
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "id int, wave int")
    assert [(w, df.count()) for w, df in P.waves(rows, "id", "wave")] == [(0, 2), (1, 1)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "c.csv").write_text('name,status\n"Alpha, ""A""",Downloaded \nBeta,failed\n')
    assert [r.name for r in tables.manifest(spark, str(tmp_path / "c.csv")).collect()] == ['Alpha, "A"']
    (tmp_path / "p.csv").write_text("project,lead\nAlpha <b>Solar</b>,one\nalpha solar,two\n")
    assert [(r.join_key, r.lead) for r in tables.portfolio(spark, str(tmp_path / "p.csv"), "project").collect()] == [("alpha solar", "two")]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "My-Doc.md").write_text("line\nline")
    assert [(r.doc_id, r.text) for r in tables.documents(spark, str(tmp_path / "docs")).collect()] == [("my_doc", "line\nline")]
    (tmp_path / "recs").mkdir()
    (tmp_path / "recs" / "a.json").write_text('{"records": [{"id": "1"}, {"id": "2"}]}')
    (tmp_path / "recs" / "b.json").write_text('{"records": [')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType())])
    assert sorted((r.doc_id, r.pos, r.id) for r in tables.records(spark, str(tmp_path / "recs"), schema).collect()) == [("a", 0, "1"), ("a", 1, "2")]
    for name, text in (("t1.json", '{"tags": {"x": {"v": "yes"}}}'), ("t2.json", '{"y": {"v": "no"}}')):
        (tmp_path / name).write_text(text)
        assert len(tables.tags(spark, str(tmp_path / name), ["v"]).collect()) == 1
    (tmp_path / "stop.txt").write_text("# all\nTHE # article\n\nAND\n")
    assert {r.term for r in tables.stoplist(spark, str(tmp_path / "stop.txt")).collect()} == {"THE", "AND"}
    (tmp_path / "s.xml").write_text("<urlset><url><loc>http://a/x</loc></url><url><loc> http://b/y </loc></url></urlset>")
    assert [r.url for r in tables.sitemap(spark, str(tmp_path / "s.xml"), "http://a/").collect()] == ["http://a/x"]
    (tmp_path / "page0.json").write_text('{"meta": [{"a": 1}], "hits": [{"id": 1}, {"id": 2}]}')
    spark.dataSource.register(tables.SavedPages)
    items = spark.read.format("saved_pages").option("paths", str(tmp_path / "page0.json")).load().collect()
    assert [json.loads(r.item)["id"] for r in items] == [1, 2]
    assert [r.number for r in spark.range(12).withColumnRenamed("id", "number").filter(tables.doc_range("1-3, 9")).collect()] == [1, 2, 3, 9]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    folder = f"{tmp_path}/table"
    sinks.upsert(spark, df, folder, "id")
    sinks.upsert(spark, spark.createDataFrame([(2, "c"), (3, "d")], "id int, x string"), folder, "id")
    assert sorted(tuple(r) for r in sinks.current(spark, folder).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    log = sinks.audit_log(df, sinks.current(spark, folder), "id", ["x"], "update").collect()
    assert [tuple(r) for r in log] == [(2, "x", "b", "c", "update")]
    assert sinks.markdown_rows(df.limit(1)).first().line == "| 1 | a |"
    for layer in (0, 1, 1):
        sinks.append_layer(df, f"{tmp_path}/layers", layer)
    assert spark.read.parquet(f"{tmp_path}/layers").count() == 4


def test_incremental_refresh_equals_batch(spark, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/out"
    parts = [[(1, "a"), (2, "b")], [(2, "c"), (3, "d")]]
    for part in parts:
        spark.createDataFrame(part, "id int, x string").coalesce(1).write.mode("append").parquet(source)
        incremental.refresh(spark, source, "id int, x string", folder, "id", f"{tmp_path}/checkpoint")
    incremental.refresh(spark, source, "id int, x string", folder, "id", f"{tmp_path}/checkpoint")  # nothing new
    assert sorted(tuple(r) for r in sinks.current(spark, folder).collect()) == [(1, "a"), (2, "c"), (3, "d")] and len(sinks.versions_of(spark, folder)) == 2


def test_registry_stream(spark, tmp_path):
    rows = [("g", "x", 1), ("g", "y", 2), ("g", "x", 3), ("h", "x", 1)]
    spark.createDataFrame(rows, "grp string, item string, position long").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("grp string, item string, position long").parquet(f"{tmp_path}/in")
    out = incremental.registry(stream, "grp", "item", "position")
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("g", "x", 1, 1), ("g", "y", 2, 2), ("h", "x", 1, 1)]


def test_glossary(spark):
    from loomspark.operators import glossary as L

    layers = [spark.createDataFrame([("a", "old"), ("b", "x")], "t string, d string"), spark.createDataFrame([("a", "new", "note")], "term string, definition string, notes string")]
    got = {r.term: (r.definition, r.notes) for r in L.merge_entries([L.verbose(df) for df in layers]).collect()}
    assert got == {"a": ("new", "note"), "b": ("x", None)}
    assigned = spark.createDataFrame([(1, "c1", 0), (1, "c2", 2), (2, "c1", 1)], "record int, cluster string, layer int")
    assert {r.record: r.cluster for r in L.latest_assignments(assigned).collect()} == {1: "c2", 2: "c1"}
    parents = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "parent string")
    themes = spark.createDataFrame([("t1", "p1"), ("t2", "p1"), ("t1", "p2"), ("t1", "p9")], "theme string, parent string")
    assert {(r.problem, r.parent) for r in L.theme_audit(parents, themes).collect()} == {("uncovered", "p3"), ("duplicated", "p1"), ("unknown", "p9")}
    rows = spark.createDataFrame([("A b",), ("c",), ("z",)], "title string")
    files = spark.createDataFrame([("a_b", "/1"), ("c", "/2")], "key string, path string")
    found = L.resolve(rows, [(F.col("title"), files, "key"), (X.slug(F.col("title")), files, "key")], "path")
    assert {r.title: r.path for r in found.collect()} == {"A b": "/1", "c": "/2", "z": None}


def test_excerpts_of_few_words_are_found(spark, tmp_path):
    from loomspark.plans import catalogue

    cjk, url = "文" * 30, "https://example.org/" + "a" * 50
    texts = [f"前{cjk}後", f"see({url})", "x longer-than-twenty characters, yes", "nothing", "one two three four five six"]
    excerpts = [cjk, url, "longer-than-twenty characters", "two three four five six", "too short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(excerpts)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = catalogue.QUERIES["excerpt_window"](spark, str(tmp_path)).collect()
    assert {(r.item_id, r.doc_id) for r in found} == {(0, 0), (1, 1), (2, 2), (3, 4)} and len(found) == 4
