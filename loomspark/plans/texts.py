"""Queries over texts: names, headings, lines, chunks, titles, dates, recovered JSON, rendered prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import tolerant as J
from ..functions import values as V
from ..operators import documents as D
from ..operators import providers as P
from .registry import query

#: Unicode white space for RE2, where Java's (?U)\s is meant.
_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def _without(x: str) -> str:
    for w in X.NAME_STOP:
        x = f"regexp_replace({x}, '\\b{w}\\b', '', 'g')"
    return x


_NAME = "'The ' || p_name || ' (Pilot) - ' || p_type || ' [Phase 2] Project'"


@query(f"""SELECT p_partkey, {_squeeze(_without(f"regexp_replace(lower({_NAME}), '[()\\[\\]\\-–—/]', ' ', 'g')"))} AS name, {_squeeze(f"translate(regexp_replace('<b>' || p_name || '</b> & “' || p_type || '”', '<[^>]+>', '', 'g'), '‘’“”', '''''\"\"')")} AS project,
trim(regexp_replace(regexp_replace(lower(p_brand || ' - ' || p_type), '[- ]', '_', 'g'), '_+', '_', 'g'), '_') AS stem, left(trim(regexp_replace(lower({_NAME}), '[^a-z0-9]+', '_', 'g'), '_'), 60) AS slug, nullif(regexp_extract(p_brand, '#([0-9]+)', 1), '') AS number FROM part""")
def normalised_names(t):
    name = F.concat(F.lit("The "), "p_name", F.lit(" (Pilot) - "), "p_type", F.lit(" [Phase 2] Project"))
    marked = F.concat(F.lit("<b>"), "p_name", F.lit("</b> &amp; “"), "p_type", F.lit("”"))
    return t("part").select("p_partkey", X.normalise_name(name).alias("name"), X.normalise_project(marked).alias("project"), X.stem(F.concat_ws(" - ", "p_brand", "p_type")).alias("stem"), X.slug(name).alias("slug"), X.captured_slug(F.col("p_brand"), "#([0-9]+)").alias("number"))


_HEADINGS = ("**Key Findings**", "executive  summary", "Recommendations.", "Terms of reference", "Chapter one", "__Background__", "Summary and Recommendations", "Conclusions..")
_ROLES = ("key_finding", "overview", "recommendation", "terms_of_reference", "", "introduction", "overview", "conclusion")


@query("SELECT p_partkey, CASE p_partkey % 8 " + " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(_ROLES)) + " END AS role FROM part")
def heading_roles(t):
    heading = F.element_at(F.array(*map(F.lit, _HEADINGS)), (F.col("p_partkey") % 8 + 1).cast("int"))
    return t("part").select("p_partkey", X.heading_role(X.clean_heading(heading)).alias("role"))


def _count(*patterns: str) -> str:
    return "len(list_filter(l, lambda x: " + " AND ".join(f"regexp_matches(x, '{p}')" for p in patterns) + "))"


_LINES = f"list_transform(string_split(text, chr(10)), lambda x: {_strip('x')})"
_SECTIONS = _count("^\\d+\\.\\d+\\s+[A-Z][A-Za-z ,&/()-]{2,80}$")


@query(f"""WITH d AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN repeat('1.2 words here and there.' || chr(10), 12) || text WHEN 1 THEN '# A' || chr(10) || '## B' || chr(10) || '### C' || chr(10) || text WHEN 2 THEN repeat('3.1 Plain Heading' || chr(10), 4) || text WHEN 3 THEN repeat('BIG WORDS' || chr(10), 3) || text ELSE text END AS text FROM documents), x AS (SELECT doc_id, {_LINES} AS l FROM d)
SELECT doc_id, CASE WHEN {_count("^\\d+\\.\\d+\\s")} - {_SECTIONS} >= 10 THEN 'numbered_para' WHEN {_count("^#{1,4}\\s+\\S")} >= 3 THEN 'markdown' WHEN {_SECTIONS} >= 3 THEN 'numbered_section' WHEN {_count("^[A-Z][A-Z0-9 ,&:/()-]{4,}$", "\\S\\s+\\S")} >= 3 THEN 'allcaps' ELSE 'minimal' END AS style FROM x""")
def heading_styles(t):
    k = F.col("doc_id") % 5
    heads = F.when(k == 0, F.repeat(F.lit("1.2 words here and there.\n"), F.lit(12))).when(k == 1, "# A\n## B\n### C\n").when(k == 2, F.repeat(F.lit("3.1 Plain Heading\n"), F.lit(4))).when(k == 3, F.repeat(F.lit("BIG WORDS\n"), F.lit(3))).otherwise("")
    return t("documents").select("doc_id", X.heading_style(F.concat(heads, "text")).alias("style"))


_SKIP = f"""({_strip("x")} = '' OR regexp_matches({_strip("x")}, '(?i)^(\\d{{1,4}}|[ivxlc]{{1,7}}|page\\s+\\d+(\\s+of\\s+\\d+)?)$') OR regexp_matches({_strip("x")}, '(?i)^(©|\\(c\\)\\s|copyright\\b|isbn\\b|issn\\b|[-_=*]{{3,}}$)'))"""


@query(f"""SELECT doc_id, len(list_filter(string_split(text || chr(10) || 'Page 3 of 9' || chr(10) || 'xiv' || chr(10) || '-----', chr(10)), lambda x: {_SKIP})) AS skipped, len(list_filter(list_transform(string_split_regex(text, '\\n[\\s\\x0b]*\\n'), lambda x: {_strip("x")}), lambda p: length(p) >= 50)) AS paragraphs FROM documents""")
def lines_and_paragraphs(t):
    lines = F.split(F.concat("text", F.lit("\nPage 3 of 9\nxiv\n-----")), "\n")
    return t("documents").select("doc_id", F.size(F.filter(lines, X.is_skip_line)).cast("long").alias("skipped"), F.size(X.paragraphs(F.col("text"), 50)).cast("long").alias("paragraphs"))


_MARKED = "regexp_replace(text, '([.])[ ]', '.' || chr(10) || chr(10), 'g')"


@query(f"""WITH RECURSIVE d AS (SELECT doc_id, {_MARKED} AS x FROM documents), s(doc_id, x, "end", chunk) AS (SELECT doc_id, x, length(x), 0 FROM d WHERE length(x) > 2500),
c(doc_id, x, chunk, start, "end") AS (
  SELECT doc_id, x, 1, CASE WHEN k > 0 THEN k + 1 ELSE r END, "end" FROM (SELECT *, CASE WHEN r > 0 THEN coalesce(nullif(length(w) - strpos(reverse(w), chr(10) || chr(10)), length(w)), -10 - greatest(r - 300, 0)) + greatest(r - 300, 0) ELSE 0 END AS k FROM (SELECT *, greatest("end" - 2000, 0) AS r, substr(x, greatest("end" - 2300, 0) + 1, least("end" - 1700, length(x)) - greatest("end" - 2300, 0)) AS w FROM s))
  UNION ALL
  SELECT doc_id, x, chunk + 1, CASE WHEN k > 0 THEN k + 1 ELSE r END, e FROM (SELECT *, CASE WHEN r > 0 THEN coalesce(nullif(length(w) - strpos(reverse(w), chr(10) || chr(10)), length(w)), -10 - greatest(r - 300, 0)) + greatest(r - 300, 0) ELSE 0 END AS k FROM (SELECT doc_id, x, chunk, start + 200 AS e, greatest(start - 1800, 0) AS r, substr(x, greatest(start - 2100, 0) + 1, least(start - 1500, length(x)) - greatest(start - 2100, 0)) AS w FROM c WHERE start > 0 AND start + 200 < "end")))
SELECT doc_id, chunk::INTEGER AS chunk, start::INTEGER AS start, "end"::INTEGER AS "end" FROM c UNION ALL SELECT doc_id, 1, 0, length(x)::INTEGER FROM d WHERE length(x) <= 2500""")
def snapped_chunks(t):
    """Overlapping chunks from the end backwards, their starts moved to a blank line nearby."""
    text = F.regexp_replace("text", "[.] ", ".\n\n")
    return t("documents").select("doc_id", F.explode(X.snapped_spans(text, 2000, 200, 2500, 300)).alias("s")).select("doc_id", "s.*")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Report ' || doc_id WHEN 1 THEN 'My File ' || doc_id ELSE 'Second One' END AS title FROM documents""")
def doc_titles(t):
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.concat(F.lit("\n# Report "), "doc_id", F.lit("\n"), "text")).when(k == 1, F.concat(F.lit("# abc\n## Not this\n"), F.lit("plain"))).otherwise(F.concat(F.lit("# Source PDF\n#   Second One  \n"), F.lit("plain")))
    return t("documents").select("doc_id", X.doc_title(text, F.concat(F.lit("my-file_"), "doc_id", F.lit(".md"))).alias("title"))


@query("""SELECT page_id, 'pdfs/' || CASE WHEN page_id % 2 = 0 THEN 'Annual_Report_Final' ELSE 'Other' END || '/' || left(regexp_replace(regexp_replace(replace('A title: of' || '  page/' || page_id, ' ', '_'), '[/\\\\:>]', '_', 'g'), '_+', '_', 'g'), 100) || '_' || left(md5(url), 6) || '.pdf' AS path FROM pages WHERE url IS NOT NULL""")
def safe_paths(t):
    kind = F.when(F.col("page_id") % 2 == 0, "Annual Report, Final").otherwise("")
    return t("pages").filter("url is not null").select("page_id", X.file_path(F.concat(F.lit("A title: of  page/"), "page_id"), kind, F.col("url")).alias("path"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 90)::VARCHAR WHEN 1 THEN '7' END AS number FROM part")
def footnote_numbers(t):
    k = F.col("p_partkey")
    html = F.when(k % 3 == 0, F.concat(F.lit("<p>text <sup> "), k % 90, F.lit("</sup></p>"))).when(k % 3 == 1, "<p>7 A note</p>").otherwise("<p>no note</p>")
    return t("part").select("p_partkey", X.footnote_number(html).alias("number"))


@query("""SELECT c_custkey, c_name || ' | a/b c | ' || c_mktsegment AS line, 'x;y;' || c_custkey AS parts FROM customer""")
def prompt_lines(t):
    line = X.prompt_line(F.col("c_name"), F.lit("a|b\nc"), F.col("c_mktsegment"))
    parts = F.array_distinct(V.split_multi(F.concat(F.lit(" x; ,y , x;"), F.col("c_custkey"))))
    return t("customer").select("c_custkey", line.alias("line"), F.array_join(F.slice(parts, 1, 3), ";").alias("parts"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m') END AS month, year(o_orderdate)::INTEGER AS year FROM orders")
def dates_parsed(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    said = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "d/M/yyyy")).when(k == 2, F.date_format(d, "d MMMM yyyy")).otherwise(F.concat(F.lit("in "), F.date_format(d, "yyyy"), F.lit(" or so")))
    day = V.parse_date(said)
    return t("orders").select("o_orderkey", day.alias("day"), F.date_format(day, "yyyy-MM").alias("month"), V.year(said).alias("year"))


@query("""WITH w AS (SELECT p_partkey, list_distinct(string_split(p_type, ' ')) AS a, list_distinct(string_split(p_name, ' ')) AS b FROM part) SELECT p_partkey, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE AS jaccard FROM w""")
def token_jaccard(t):
    return t("part").select("p_partkey", X.token_set_jaccard(F.split("p_type", " "), F.split("p_name", " ")).alias("jaccard"))


@query("""SELECT conv_id, turn, 'Chapter ' || (1 + turn % 3) || ': ' || role || ' > part | ' || conv_id || ' ' AS prefix FROM conversations""")
def context_prefixes(t):
    prefix = F.concat(F.lit("Chapter "), 1 + F.col("turn") % 3, F.lit(": "), "role", F.lit(" > part | "), "conv_id", F.lit(" "))
    return t("conversations").select("conv_id", "turn", prefix.alias("prefix"))


# --- replies of a model

@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'strict' WHEN 1 THEN 'lenient' WHEN 2 THEN 'recovered' ELSE 'failed' END AS method, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id END AS id, CASE WHEN event_id % 4 = 2 THEN 2 END::INTEGER AS recovered, event_id % 4 = 2 AS cut FROM events""")
def replies_parsed(t):
    k, i = F.col("event_id") % 4, F.col("event_id").cast("string")
    reply = (
        F.when(k == 0, F.concat(F.lit('Here:\n```json\n{"id": '), i, F.lit(', "t": "a } b"}\n```')))
        .when(k == 1, F.concat(F.lit('So {"id": '), i, F.lit("} it is.")))
        .when(k == 2, F.concat(F.lit('{"records": [{"id": '), i, F.lit(', "t": "x \\" {"}, {"id": 2}, {"id": 3, "t": "cut of')))
        .otherwise("nothing of use")
    )
    parsed = t("events").select("event_id", J.parse_tolerant(reply).alias("p"), J.truncated(F.when(k == 2, "max_tokens").otherwise("end"), F.lit(10), 100).alias("cut"))
    return parsed.select("event_id", "p.method", F.get_json_object("p.json", "$.id").cast("long").alias("id"), F.size(F.from_json(F.get_json_object("p.json", "$._recovered"), "array<struct<id:long>>")).alias("recovered"), "cut").withColumn("recovered", F.when(F.col("recovered") >= 0, F.col("recovered")))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a' || event_id || ',b' WHEN event_id % 3 = 1 THEN 'c' END AS terms FROM events""")
def objects_by_pattern(t):
    """Objects of two known keys out of a reply that is no JSON, and arrays of objects of which those with the keys required stay."""
    k, i = F.col("event_id") % 3, F.col("event_id").cast("string")
    reply = F.when(k == 0, F.concat(F.lit('{"t": "a'), i, F.lit('", "s": "x"} and {"t":"b","s":"y"} and {"t": "cut'))).when(k == 1, 'Sure: [{"t": "c", "s": "z"}, {"t": "lacks s"}] done').otherwise("none")
    pairs = J.pairs_by_pattern(reply, "t", "s")
    return t("events").select("event_id", F.nullif(F.array_join(F.transform(pairs, lambda p: p["t"]), ","), F.lit("")).alias("terms"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'e' || event_id || ',e2' WHEN 1 THEN 'e9' WHEN 2 THEN 'e' || event_id END AS events FROM events""")
def events_blocks(t):
    k, i = F.col("event_id") % 4, F.col("event_id").cast("string")
    reply = (
        F.when(k == 0, F.concat(F.lit("text\n## Events\nsome prose\n```yaml\n- event_id: e"), i, F.lit("\n  event_name: one\n- event_id: e2\n  event_name: two\n```\nmore")))
        .when(k == 1, "**events**\n\n- event_id: e9\n  event_name: 'nine'\n\n## Next\n- event_id: no")
        .when(k == 2, F.concat(F.lit("```yaml\n- record_id: r1\n  event_id: x\n  event_name: y\n```\n```yaml\nevents:\n  - event_id: e"), i, F.lit("\n    event_name: z\n```")))
        .otherwise("no events at all")
    )
    found = J.parse_events(reply)
    return t("events").select("event_id", F.nullif(F.array_join(F.transform(found, lambda m: m["event_id"]), ","), F.lit("")).alias("events"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'R' || event_id || '|R2: b' WHEN 1 THEN 'R' || event_id END AS records, CASE event_id % 3 WHEN 0 THEN 'strict' WHEN 1 THEN 'recovered' ELSE 'none' END AS method FROM events""")
def yaml_records_parsed(t):
    k, i = F.col("event_id") % 3, F.col("event_id").cast("string")
    reply = (
        F.when(k == 0, F.concat(F.lit("```yaml\n- record_id: R"), i, F.lit('\n  note: "x"\n- record_id: R2: b\n  note: plain\n```')))
        .when(k == 1, F.concat(F.lit("```yaml\n- record_id: R"), i, F.lit("\n  note: whole\n- record_id: R9\n  note: \"cut of")))
        .otherwise("No records extracted from this one.")
    )
    found = J.parse_yaml_records(reply)
    ids = F.transform(found["records"], lambda m: m["record_id"])
    return t("events").select("event_id", F.nullif(F.array_join(ids, "|"), F.lit("")).alias("records"), found["method"].alias("method"))


@query("""SELECT p_partkey, 'Use ' || p_brand || ' of kind ' || CASE WHEN p_size > 25 THEN 'large' ELSE 'base' END || ' in en; {other} stays' AS prompt FROM part""")
def prompts_rendered(t):
    layers = [{"kind": F.lit("base"), "lang": F.lit("de"), "name": F.lit("x")}, {"lang": F.lit("en")}, {"kind": F.when(F.col("p_size") > 25, "large")}, {"name": F.col("p_brand")}]
    return t("part").select("p_partkey", P.render_layers("Use {name} of kind {kind} in {lang}; {other} stays", layers).alias("prompt"))


@query("""WITH c AS (SELECT p_brand AS term, p_type AS name, count(*) AS n FROM part GROUP BY ALL), f AS (SELECT *, n / (sum(n) OVER (PARTITION BY term))::DOUBLE AS share, (sum(n) OVER (PARTITION BY name))::DOUBLE / sum(n) OVER () AS base FROM c)
SELECT term, string_agg(name || ' ' || round(share * 100)::BIGINT || '%' || CASE WHEN share >= 0.1 THEN '!' ELSE '' END, ', ' ORDER BY share DESC, name) AS line FROM f WHERE share >= 0.05 AND share / base >= 1.5 GROUP BY term""")
def fingerprint_lines(t):
    part = t("part").select(F.col("p_brand").alias("term"), F.col("p_type").alias("name"))
    cells = part.groupBy("term", "name").agg(F.count("*").alias("n"))
    of_term = part.groupBy("term").agg(F.count("*").alias("tn"))
    of_name = part.groupBy("name").agg(F.count("*").alias("bn"))
    shares = cells.join(of_term, "term").join(of_name, "name").join(F.broadcast(part.agg(F.count("*").alias("all_n")))).select("term", "name", (F.col("n") / F.col("tn")).alias("share"), (F.col("bn") / F.col("all_n")).alias("base"))
    return P.fingerprint_line(shares, 0.05, 0.1)


# --- samples and replies


@query(r"""SELECT doc_id, md5(CASE WHEN length(text) > 1000 THEN text[1:1000] || chr(10) || chr(10) || '[... truncated ...]' ELSE text END) AS content_md5, least(length(text), 1000 + 21)::INTEGER AS chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 20""")
def sample_documents(t):
    """A reproducible sample for a prompt, long texts cut and marked."""
    rows = t("documents").orderBy(F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), "doc_id").limit(20)
    content = X.truncated(F.col("text"), 1000)
    return rows.select("doc_id", F.md5(content).alias("content_md5"), F.length(content).alias("chars"))


@query(r"""SELECT page_id, md5(regexp_replace(regexp_replace(h, '(?is)<table\b.*?</table>', ' ', 'g'), '<[^>]+>', ' ', 'g')) AS text_md5 FROM (SELECT page_id, replace(replace(html, '<h2>', '<TABLE border=1><tr><td>x</td></tr>'), '</h2>', '</table>') AS h FROM pages)""")
def tables_stripped(t):
    html = F.replace(F.replace(F.col("html"), F.lit("<h2>"), F.lit("<TABLE border=1><tr><td>x</td></tr>")), F.lit("</h2>"), F.lit("</table>"))
    return t("pages").select("page_id", F.md5(X.without_tables(html)).alias("text_md5"))


@query(r"""SELECT conv_id, turn, u.pos::INTEGER AS pos, u.angle FROM (SELECT conv_id, turn, unnest([{'pos': 0, 'angle': 'q' || turn}] || CASE turn % 3 WHEN 2 THEN [] ELSE [{'pos': 1, 'angle': 'a"' || turn}, {'pos': 2, 'angle': '7'}] END) AS u FROM conversations)""")
def query_expansion(t):
    plain = F.concat(F.lit('["a\\"'), F.col("turn").cast("string"), F.lit('", 7]'))
    reply = F.when(F.col("turn") % 3 == 0, plain).when(F.col("turn") % 3 == 1, F.concat(F.lit("```json\n"), plain, F.lit("\n```\n"))).otherwise("Sure! Here they are")
    rows = t("conversations").select("conv_id", "turn", F.concat(F.lit("q"), F.col("turn")).alias("q"), reply.alias("r"))
    return P.expanded(rows, F.col("q"), F.col("r")).select("conv_id", "turn", "pos", "angle")


@query(r"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_type IN ('click', 'view') THEN event_type END AS kind, CASE WHEN event_id % 3 <> 0 THEN 'yes' END AS seen,
CASE WHEN event_id % 3 = 0 OR event_type IN ('click', 'view') THEN '' ELSE 'kind=' || event_type END AS invalid, event_id % 3 <> 0 AS parsed FROM events""")
def checked_tags(t):
    body = F.concat(F.lit('{"kind": "'), F.col("event_type"), F.lit('", "seen": "yes", "more": null}'))
    reply = F.when(F.col("event_id") % 3 == 0, "no braces").when(F.col("event_id") % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("I'd say "), body, F.lit(" then")))
    got = P.checked_tags(t("events").select("event_id", reply.alias("reply")), F.col("reply"), {"kind": ["click", "view"], "seen": ["yes", "no"]})
    return got.select("event_id", "kind", "seen", F.array_join(F.transform("invalid", lambda x: F.concat_ws("=", x["axis"], x["value"])), ";").alias("invalid"), "parsed")


@query("SELECT conv_id, turn, run::INTEGER AS run, floor(length(text) / 4) AS tokens, round(floor(length(text) / 4) * 3.0::DOUBLE / 1000000 + 100 * 15.0::DOUBLE / 1000000, 9) AS cost FROM conversations, (SELECT unnest(range(3)) AS run)")
def ensemble_costs(t):
    rows = P.repeated(t("conversations").select("conv_id", "turn", F.floor(F.length("text") / 4).cast("double").alias("tokens")), 3)
    return rows.select("conv_id", "turn", "run", "tokens", F.round(P.reply_cost(F.lit("large"), F.col("tokens"), F.lit(100), {"large": (3.0, 15.0)}), 9).alias("cost"))


@query("""WITH s AS (SELECT l_orderkey AS doc, round(l_quantity / 3, 1) AS size, count(*) AS n, min(l_linenumber * 100000::BIGINT + l_partkey) AS first FROM lineitem WHERE l_linenumber <= 5 AND l_returnflag <> 'A' GROUP BY ALL),
r AS (SELECT doc, size, row_number() OVER (PARTITION BY doc ORDER BY n DESC, first, size) AS k FROM s)
SELECT doc, coalesce(r.size, 11.0::DOUBLE) AS size FROM (SELECT DISTINCT l_orderkey AS doc FROM lineitem) LEFT JOIN (SELECT doc, size FROM r WHERE k = 1) r USING (doc)""")
def body_size(t):
    size = F.round(F.col("l_quantity") / 3 * 10) / 10  # as DuckDB rounds
    text = F.when(F.col("l_returnflag") == "A", " ab ").when(F.col("l_returnflag").isNotNull(), "abc")
    place = F.col("l_linenumber").cast("long") * 100_000 + F.col("l_partkey")
    spans = t("lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), place.alias("pos"), size.alias("size"), text.alias("text"))
    return D.body_size(spans, pages=5, place=F.col("pos"))
