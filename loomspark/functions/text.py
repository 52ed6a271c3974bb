"""Text functions as Column expressions. All patterns switch on Unicode word boundaries ((?U)), whatever the Java version."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# They have to equal those the results are compared with.
ACRONYM = r"(?U)\b([A-Z]{2,8})\b"
INITIALISM = r"(?U)\b((?:[A-Z]\.){2,5}[A-Z]?)\b"
ACRONYM_STOP = (
    "II III IV VI VII VIII IX XI XII XIII XIV XV XVI XVII XVIII XIX XX XXI XXII XXIII XXIV XXV I A THE AND OR BUT NOT OK "
    "PDF DOCX PPT URL HTTP HTTPS HTML CSS PNG JPG GIF TXT DOC XLS XLSX TOC REF ID APP EOF BOF TBC TBD N Y "
    "AM PM AD BC CE BCE GMT UTC EST PST MON TUE WED THU FRI SAT SUN JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC"
).split()
TITLE_STOP_PREFIXES = ("Page ", "Figure ", "Table ", "Section ", "Chapter ", "Appendix ", "Note ", "Reference ")
TITLE_CONNECTORS = ("of", "and", "the", "in", "for", "to", "on", "at", "&", "de", "von", "van")
NAME_STOP = ("project the a and & demonstration demo programme program phase 1 2 3 i ii iii pilot trial study energy power renewable renewables").split()
ROLES = (
    ("overview", r"executive\s+summary|summary(\s+and\s+recommendations)?|overview|key\s+points"),
    ("recommendation", r"recommendations?"),
    ("key_finding", r"key\s+findings?|findings?"),
    ("terms_of_reference", r"terms?\s+of\s+reference"),
    ("conclusion", r"conclusions?|summary\s+of\s+findings?"),
    ("introduction", r"introduction|background"),
)
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&ndash;": "–", "&mdash;": "—", "&rsquo;": "’", "&lsquo;": "‘", "&amp;": "&"}


def title_case_pattern(least: int = 2, most: int = 8) -> str:
    """Runs of ``least`` to ``most`` capitalised words, joined by blanks or by one lower-case connector."""
    word = "[A-Z][a-zA-Z]+"
    joined = rf"\s+(?:(?:{'|'.join(TITLE_CONNECTORS)})\s+)?{word}"
    return rf"(?U)\b({word}(?:{joined}){{{max(least - 1, 1)},{most - 1}}})\b"


def matches(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def strip(text: Column) -> Column:
    """Without surrounding Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def passes_title_filter(surface: Column) -> Column:
    ok = F.length(surface) <= 120
    for p in TITLE_STOP_PREFIXES:
        ok = ok & ~surface.startswith(p)
    return ok


def normalise_name(name: Column, more: tuple[str, ...] = ()) -> Column:
    """Lower case, brackets and dashes to blanks, filler words out (``more``: those of the corpus, such as its country and funder), blanks squeezed."""
    out = F.regexp_replace(F.lower(name), r"[()\[\]\-–—/]", " ")
    for w in (*NAME_STOP, *more):
        out = F.regexp_replace(out, rf"(?U)\b{w}\b", "")
    return squeeze(out)


def normalise_project(name: Column) -> Column:
    """Entities decoded, tags out, quotes folded, blanks squeezed."""
    folded = F.translate(F.regexp_replace(unescape(name), "<[^>]+>", ""), "‘’“”", "''\"\"")
    return squeeze(folded)


def unescape(html: Column) -> Column:
    out = html
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def slug(text: Column, most: int = 60) -> Column:
    return F.left(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(most))


def stem(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(name), "[- ]", "_"), "_+", "_"), F.lit("_"))


def letters3(text: Column, stopwords: tuple[str, ...] = ()) -> Column:
    """Lower-case runs of three and more ASCII letters, repeats kept, stopwords out."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*stopwords)) if stopwords else found


def hyphen_words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z][A-Za-z-]*"), F.lit(0)), F.lower)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often, and within whatever lambda, it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by blanks."""

    def runs(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))

    return once(tokens, runs)


def is_content(gram: Column, stopwords: tuple[str, ...]) -> Column:
    """Neither all stopwords nor all shorter than three characters."""
    return once(F.split(gram, " "), lambda parts: ~F.forall(parts, lambda w: w.isin(*stopwords)) & ~F.forall(parts, lambda w: F.length(w) < 3))


def html_text(html: Column) -> Column:
    """Scripts, styles and comments out, footnote numbers kept as marks, emphasis as Markdown, tags out, entities decoded."""
    out = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1>|<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<sup>\s*(\d+)\s*</sup>", "⟦FN:$1⟧")
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<(i|em)>(.*?)</\1>", r"*$2*"), r"(?s)<(b|strong)>(.*?)</\1>", r"**$2**")
    return strip(unescape(F.regexp_replace(out, "<[^>]+>", "")))


def strip_html(html: Column, most: int | None = 80_000) -> Column:
    """The text of a page, cut at ``most`` characters for a prompt (None: whole)."""
    text = squeeze(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|noscript|svg|nav|footer)\b.*?</\1>|<!--.*?-->", " "), "<[^>]+>", " "))
    return text if most is None else F.left(text, F.lit(most))


def without_tables(text: Column) -> Column:
    """Text without tables and tags, each a blank: what names are looked for in. Places in it are those of the result."""
    return F.regexp_replace(F.regexp_replace(text, r"(?is)<table\b.*?</table>", " "), "<[^>]+>", " ")


#: Fixed value: what follows a text that was cut.
TRUNCATED = "\n\n[... truncated ...]"


def truncated(text: Column, most: int = 30_000) -> Column:
    """A text for a prompt: the first ``most`` characters and a mark of what is left out."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(TRUNCATED))).otherwise(text)


def unfenced(text: Column) -> Column:
    """A reply without the code fence around it."""
    return strip(F.regexp_replace(strip(text), r"(?s)^```[^\n]*\n|\s*```$", ""))


def footnote_number(html: Column) -> Column:
    tagged, leading = F.regexp_extract(html, r"(?i)<sup>\s*(\d+)\s*</sup>", 1), F.regexp_extract(html_text(html), r"^(\d{1,3})\s+.", 1)
    return F.coalesce(F.nullif(tagged, F.lit("")), F.nullif(leading, F.lit("")))


def clean_heading(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, r"(?U)\*\*|__|(?<!\w)\*(?!\s)|(?<!\s)\*(?!\w)", ""))


def heading_role(heading: Column) -> Column:
    """First role whose pattern is the whole heading (closing full stops aside); else empty."""
    clean = F.regexp_replace(strip(heading), r"\.+$", "")
    role = F.lit("")
    for name, pattern in reversed(ROLES):
        role = F.when(clean.rlike(f"(?i)^({pattern})$"), name).otherwise(role)
    return role


def heading_style(text: Column) -> Column:
    """Vote of the lines: numbered paragraphs (10), Markdown, numbered sections, capitals (3 each), else minimal."""
    lines = F.transform(F.split(text, "\n"), strip)

    def count(*patterns: str) -> Column:
        def hit(line: Column) -> Column:
            good = F.lit(True)
            for p in patterns:
                good = good & line.rlike(p)
            return good

        return F.size(F.filter(lines, hit))

    sections = count(r"^\d+\.\d+\s+[A-Z][A-Za-z ,&/()-]{2,80}$")
    paragraphs = count(r"^\d+\.\d+\s") - sections
    capitals = count(r"^[A-Z][A-Z0-9 ,&:/()-]{4,}$", r"\S\s+\S")
    return (
        F.when(paragraphs >= 10, "numbered_para").when(count(r"^#{1,4}\s+\S") >= 3, "markdown")
        .when(sections >= 3, "numbered_section").when(capitals >= 3, "allcaps").otherwise("minimal")
    )


def sentences(text: Column) -> Column:
    """Parts at white space that follows a sentence's end and precedes a capital."""
    return F.split(text, r"(?<=[.!?])\s+(?=[A-Z])")


def split_long(text: Column, most: int = 4000) -> Column:
    """A text over ``most`` characters as fragments of whole sentences, each filled until the next would exceed ``most``."""
    kind = "struct<done:array<string>,now:string,size:int>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now"), F.lit(0).alias("size")).cast(kind)

    def add(acc: Column, s: Column) -> Column:
        over = (acc["size"] + F.length(s) > most) & acc["now"].isNotNull()
        return F.when(over, F.struct(F.array_append(acc["done"], acc["now"]).alias("done"), s.alias("now"), F.length(s).alias("size"))).otherwise(
            F.struct(acc["done"].alias("done"), F.concat_ws(" ", acc["now"], s).alias("now"), (acc["size"] + F.length(s) + 1).cast("int").alias("size")))

    folded = F.aggregate(sentences(text), start, add, lambda acc: F.array_append(acc["done"], acc["now"]))
    return F.when(F.length(text) <= most, F.array(text)).otherwise(folded)


def fix_emphasis(text: Column, rounds: int = 5) -> Column:
    """Blanks just inside emphasis marks out, as Markdown takes such marks for asterisks; again until nothing moves, ``rounds`` times at most."""
    passes = ((r"\*\*[ \t]+([^*\n]+?)\*\*", "**$1**"), (r"\*\*([^*\n]+?)[ \t]+\*\*", "**$1**"), (r"(?<!\*)\*[ \t]+([^*\n]+?)\*(?!\*)", "*$1*"), (r"(?<!\*)\*([^*\n]+?)[ \t]+\*(?!\*)", "*$1*"))

    def once_more(t: Column, _: Column) -> Column:
        for pattern, to in passes:
            t = F.regexp_replace(t, pattern, to)
        return t

    out = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), text, once_more)
    return F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r" +\n", "\n")


def doc_title(text: Column, filename: Column, skip: str = "source pdf") -> Column:
    """The first heading of level one within 30 lines that is longer than five characters and not ``skip``; else the file's name, in words."""
    heads = F.transform(F.slice(F.split(text, "\n"), 1, 30), lambda x: strip(F.regexp_extract(x, r"^#\s+(.+)", 1)))
    found = F.get(F.filter(heads, lambda h: (F.length(h) > 5) & (F.lower(h) != skip)), F.lit(0))
    return F.coalesce(found, F.initcap(F.translate(F.regexp_replace(filename, r"\.md", ""), "-_", "  ")))


def captured_slug(value: Column, pattern: str) -> Column:
    """The pattern's first group (the whole match where it has none), else null: an id that is part of a name or an address."""
    group = 1 if re.compile(pattern).groups else 0
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def file_path(title: Column, kind: Column, url: Column, most: int = 100) -> Column:
    """Where a document is saved: a folder a kind, the title in safe characters, and six digits of its address' md5."""
    folder = F.when(F.coalesce(kind, F.lit("")) == "", "Other").otherwise(F.replace(F.replace(kind, F.lit(", "), F.lit("_")), F.lit(" "), F.lit("_")))
    name = F.left(F.regexp_replace(F.regexp_replace(F.replace(title, F.lit(" "), F.lit("_")), r"[/\\:>]", "_"), "_+", "_"), F.lit(most))
    return F.concat(F.lit("pdfs/"), folder, F.lit("/"), name, F.lit("_"), F.left(F.md5(url), F.lit(6)), F.lit(".pdf"))


def prompt_line(*cells: Column) -> Column:
    """Cells as one line of a prompt: bars and line breaks within them become slashes and blanks."""
    return F.concat_ws(" | ", *[F.translate(F.coalesce(c.cast("string"), F.lit("")), "|\n", "/ ") for c in cells])


def paragraphs(text: Column, least: int = 0) -> Column:
    """Parts between blank lines, without surrounding white space, of ``least`` characters or more."""
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), strip), lambda p: (F.length(p) > 0) & (F.length(p) >= least))


def backward_spans(length: Column, size: int, overlap: int, single: int) -> Column:
    """Overlapping [start, end) spans from the end of a text backwards, for texts without blank lines to snap to."""
    step = size - overlap
    count = F.when(length <= single, 0).otherwise(F.ceil(F.greatest(length - size, F.lit(0)) / step).cast("int"))
    return F.transform(F.sequence(F.lit(0), count), lambda i: F.struct((i + 1).cast("int").alias("chunk"), F.when(length <= single, 0).otherwise(F.greatest(length - size - i * step, F.lit(0))).cast("int").alias("start"), (length - i * step).cast("int").alias("end")))


def context_window(source: Column, excerpt: Column, page: Column, happened: Column, window: int, fallback: int) -> Column:
    """Text around an excerpt's first 60 characters; else after a page's mark; else around the event's first 50; else the start."""
    low, n = F.lower(source), F.length(source)

    def around(needle: Column, size: int, after: Column) -> Column:
        at = F.position(F.lower(F.left(needle, F.lit(size))), low)
        start = F.greatest(at - 1 - window, F.lit(0))
        return F.when((F.length(needle) >= 20) & (at > 0), F.substring(source, start + 1, F.least(n, at - 1 + after) - start))

    mark = F.position(F.concat(F.lit("<!-- page "), page.cast("string"), F.lit(" -->")), source)
    first = F.greatest(mark - 501, F.lit(0))
    paged = F.when(mark > 0, F.substring(source, first + 1, F.least(n, mark - 1 + 2 * window) - first))
    e, h = strip(F.coalesce(excerpt, F.lit(""))), strip(F.coalesce(happened, F.lit("")))
    return F.coalesce(around(e, 60, F.length(e) + window), paged, around(h, 50, F.lit(window)), F.left(source, F.lit(fallback)))


def is_skip_line(line: Column) -> Column:
    """Page numbers, roman numerals, notices of copyright, ISBN lines and rules."""
    return (strip(line) == "") | strip(line).rlike(r"(?i)^(\d{1,4}|[ivxlc]{1,7}|page\s+\d+(\s+of\s+\d+)?)$") | strip(line).rlike(r"(?i)^(©|\(c\)\s|copyright\b|isbn\b|issn\b|[-_=*]{3,}$)")


def token_set_jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)


def page_title(html: Column) -> Column:
    """Dublin Core title, Open Graph title; else the first h1 of five characters and more that is not for screen readers only and, where there are several, not under
    thirty; else the first h1, else the first h2 of more than five characters."""
    bare = lambda x: squeeze(F.regexp_replace(x, "<[^>]+>", ""))
    filled = lambda x: F.nullif(x, F.lit(""))

    def of_headings(heads: Column) -> Column:
        own = F.filter(heads, lambda h: ~F.regexp_extract(h, "(?is)^<h1([^>]*)>", 1).rlike(r'class="([^"]*\s)?(sr-only|visually-hidden)(\s[^"]*)?"') & (F.length(bare(h)) >= 5) & ((F.size(heads) == 1) | (F.length(bare(h)) >= 30)))
        return F.coalesce(bare(F.get(own, F.lit(0))), filled(bare(F.get(heads, F.lit(0)))))

    meta = [filled(F.trim(F.regexp_extract(html, p, 1))) for p in (r'(?is)<meta\s+name="dcterms.title"\s+content="([^"]*)"', r'(?is)<meta\s+property="og:title"\s+content="([^"]*)"')]
    h2 = bare(F.regexp_extract(html, r"(?is)<h2[^>]*>(.*?)</h2>", 1))
    return F.coalesce(*meta, once(F.regexp_extract_all(html, F.lit(r"(?is)<h1[^>]*>.*?</h1>"), F.lit(0)), of_headings), F.when(F.length(h2) > 5, h2))


def links(html: Column) -> Column:
    """Distinct link targets in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1)))


def is_document_link(href: Column, title: Column) -> Column:
    """A PDF by its name, a link to a PDF or Word form of a page, or a title attribute that offers a download."""
    return href.rlike(r"(?i)\.pdf(\?|$)|/pdf$|/word$|format=pdf") | title.rlike(r"(?i)download.*\.(pdf|docx?)$")


def document_links(html: Column, page_url: Column) -> Column:
    """Distinct absolute addresses of the documents a page links to, in order of appearance."""
    tags = F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>'), F.lit(0))
    pairs = F.transform(tags, lambda a: F.struct(F.regexp_extract(a, r'(?is)\shref="([^"]*)"', 1).alias("href"), F.regexp_extract(a, r'(?is)\stitle="([^"]*)"', 1).alias("title")))
    wanted = F.filter(pairs, lambda p: is_document_link(p["href"], p["title"]))
    return F.array_distinct(F.transform(wanted, lambda p: absolute(page_url, p["href"])))


def absolute(base: Column, href: Column) -> Column:
    """A link against the page it stands on: absolute, of the scheme, of the root, a query, a fragment, or beside the page. Dots in paths stay as they are."""
    scheme, root = F.regexp_extract(base, "^([a-z]+:)", 1), F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1)
    page = F.regexp_extract(base, "^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(root, href))
        .when(href == "", base).when(href.startswith("?"), F.concat(page, href)).when(href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href)).otherwise(F.concat(folder, href))
    )


def child_pages(html: Column, page_url: Column, first: tuple[str, ...] = ("report", "draft", "final-report", "final", "interim", "supplement"), most: int = 5) -> Column:
    """Links one level below a page on its own host, without queries, those named as reports first, then in order of appearance; ``most`` of them are to be visited."""

    def below(page: Column) -> Column:
        root, path = F.regexp_extract(page, "^([a-z]+://[^/?#]*)", 1), F.rtrim(url_path(page), F.lit("/"))
        found = F.transform(links(html), lambda h: F.regexp_replace(absolute(page, F.trim(h)), r"[?#].*$", ""))
        rest = lambda u: F.regexp_replace(F.substring(u, F.length(root) + F.length(path) + 1, F.length(u)), "/+$", "")
        near = F.array_distinct(F.filter(found, lambda u: u.startswith(F.concat(root, path, F.lit("/"))) & rest(u).rlike("^/[^/]+$")))
        named = lambda u: F.substring(rest(u), 2, F.length(u)).isin(*first)
        return F.slice(F.concat(F.filter(near, named), F.filter(near, lambda u: ~named(u))), 1, most)

    return once(page_url, below)


def snapped_spans(text: Column, size: int, overlap: int, single: int, reach: int = 2000) -> Column:
    """Overlapping (chunk, start, end) spans from the end of a text backwards; a start goes to just behind the last blank line within ``reach`` of it, if there is one.
    Each span's end is the start before plus ``overlap``; where that gains nothing the walk ends."""

    def walk(t: Column) -> Column:
        kind = "struct<spans:array<struct<chunk:int,start:int,end:int>>,start:int,end:int,go:boolean>"
        first = F.struct(F.array().cast("array<struct<chunk:int,start:int,end:int>>").alias("spans"), F.length(t).alias("start"), F.length(t).alias("end"), F.lit(True).alias("go")).cast(kind)
        steps = F.when(F.length(t) <= single, 0).otherwise(F.ceil(F.length(t) / max(1, size - overlap - reach)).cast("int") + 1)

        def step(acc: Column, k: Column) -> Column:
            end = F.when(F.size(acc["spans"]) == 0, acc["end"]).otherwise(acc["start"] + overlap)
            raw = F.greatest(end - size, F.lit(0))
            low = F.greatest(raw - reach, F.lit(0))
            around = F.substring(t, low + 1, F.least(raw + reach, F.length(t)) - low)
            back = F.locate("\n\n", F.reverse(around))
            snap = F.when((raw > 0) & (back > 0), low + F.length(around) - back - 1).otherwise(0)
            start = F.when(snap > 0, snap + 2).otherwise(raw)
            more = F.array_append(acc["spans"], F.struct((F.size(acc["spans"]) + 1).cast("int").alias("chunk"), start.cast("int").alias("start"), end.cast("int").alias("end")))
            new = F.struct(more.alias("spans"), start.cast("int").alias("start"), end.cast("int").alias("end"), ((start > 0) & (start + overlap < end)).alias("go"))
            return F.when(acc["go"], new.cast(kind)).otherwise(acc)

        whole = F.array(F.struct(F.lit(1).alias("chunk"), F.lit(0).alias("start"), F.length(t).alias("end")))
        return F.when(F.length(t) <= single, whole).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), first, step, lambda acc: acc["spans"]))

    return once(text, walk)
