"""Saved responses of sites' interfaces: items out of pages, addresses of pages and files, records of exports; strategies tried in turn."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import once, unescape
from .sinks import current, upsert, versions_of
from .tables import largest_array

#: Where search services keep their hits; the entries of the second kind hold the item under _source.
HITS, SOURCED = ("$.results[0].hits", "$.hits"), "$.hits.hits"
_ARRAY = "array<string>"


def _largest(bodies: pd.Series) -> pd.Series:
    out = []
    for b in bodies:
        try:
            out.append([json.dumps(x, sort_keys=True) for x in largest_array(json.loads(b))])
        except (TypeError, ValueError):
            out.append([])
    return pd.Series(out, index=bodies.index, dtype=object)


def items(responses: DataFrame, page: str, body: str) -> DataFrame:
    """(page, pos, item): objects of each saved response: hits of a search service, else the largest array of objects in it."""
    found = F.get_json_object(body, SOURCED)
    sourced = F.transform(F.from_json(found, _ARRAY), lambda x: F.get_json_object(x, "$._source"))
    hits = F.coalesce(*[F.from_json(F.get_json_object(body, p), _ARRAY) for p in HITS])
    known = F.when(found.startswith("["), sourced).when(F.size(hits) > 0, hits)
    rows = responses.select(F.col(page).alias("page"), F.col(body).alias("body"), known.alias("known"))
    rest = rows.filter("known is null").select("page", F.posexplode(F.pandas_udf(_largest, _ARRAY)("body")).alias("pos", "item"))
    return rows.filter("known is not null").select("page", F.posexplode("known").alias("pos", "item")).unionByName(rest)


def replay(found: DataFrame, id: Column, most_pages: int = 200) -> DataFrame:
    """Items of pages in order, each id once, up to the first page that adds nothing; pages beyond ``most_pages`` are not asked for."""
    own = found.filter(F.col("page") < most_pages).withColumn("id", id).filter("id is not null")
    first = own.groupBy("id").agg(F.min_by(F.struct("page", "pos", "item"), F.struct("page", "pos")).alias("r")).select("id", "r.*")
    pages = own.select("page").distinct().join(first.groupBy("page").agg(F.count("*").alias("new")), "page", "left")
    stop = pages.agg(F.min(F.when(F.col("new").isNull(), F.col("page"))).alias("stop"))
    return first.join(F.broadcast(stop), F.col("stop").isNull() | (F.col("page") < F.col("stop"))).drop("stop")


def item_url(raw: Column, site: str, landing: str, id: Column) -> Column:
    """Address of an item's page: as it stands, of the site's root, beside the landing page; without one, the id below the landing path."""
    path, folder = landing.removeprefix(site).rstrip("/"), landing.rsplit("/", 1)[0]
    given = F.nullif(F.trim(raw), F.lit(""))
    return F.when(given.startswith("http"), given).when(given.startswith("/"), F.concat(F.lit(site), given)).when(given.isNotNull(), F.concat(F.lit(folder + "/"), given)).otherwise(F.concat(F.lit(f"{site}{path}/"), id.cast("string")))


def item_metadata(item: Column, skip: list[str]) -> Column:
    """Map of an item's filled fields, lists and objects as JSON; without the fields in ``skip`` and those that start with an underscore."""
    cells = F.transform_values(F.from_json(item, "map<string,string>"), lambda k, v: F.trim(v))
    return F.map_filter(cells, lambda k, v: ~k.isin(*skip) & ~k.startswith("_") & v.isNotNull() & (v != ""))


def file_urls(item: Column, files: str, file_id: str, doc_id: Column, pattern: str) -> Column:
    """Addresses of an item's files by a pattern with {doc_id} and {file_id}."""
    ids = F.transform(F.from_json(F.get_json_object(item, f"$.{files}"), _ARRAY), lambda f: F.get_json_object(f, f"$.{file_id}"))
    made = lambda i: F.replace(F.replace(F.lit(pattern), F.lit("{doc_id}"), doc_id.cast("string")), F.lit("{file_id}"), i)
    return F.coalesce(F.transform(F.filter(ids, lambda i: i.isNotNull() & (i != "")), made), F.array().cast(_ARRAY))


def cms_records(found: DataFrame, skip: list[str]) -> DataFrame:
    """(page_url, title, doc_urls, metadata) of items of a content system: titles rendered and escaped, custom fields, downloads nested anywhere in them."""
    text = lambda p: F.get_json_object("item", p)
    urls = F.regexp_extract_all(F.coalesce(text("$.acf"), F.lit("")), F.lit(r'"(https?:[^"\s]+?\.(?:pdf|docx?))"'), F.lit(1))
    plain = F.transform(urls, lambda u: F.replace(u, F.lit("\\/"), F.lit("/")))
    return found.select(text("$.link").alias("page_url"), unescape(F.coalesce(text("$.title.rendered"), text("$.title"))).alias("title"), F.array_distinct(plain).alias("doc_urls"), item_metadata(text("$.acf"), skip).alias("metadata"))


def export_records(export: DataFrame, url: str, title: str) -> DataFrame:
    """(page_url, title, metadata) of a site's CSV export: what is neither the address nor the title is metadata, if it is filled."""
    rest = [c for c in export.columns if c not in (url, title)]
    cells = F.create_map(*[x for c in rest for x in (F.lit(c), F.trim(F.col(c).cast("string")))])
    kept = F.map_filter(cells, lambda k, v: v.isNotNull() & (v != ""))
    return export.filter(F.coalesce(F.trim(F.col(url)), F.lit("")) != "").select(F.trim(F.col(url)).alias("page_url"), F.trim(F.col(title)).alias("title"), kept.alias("metadata"))


def first_strategy(strategies: dict[str, Callable[[], DataFrame]], start: str) -> tuple[str | None, DataFrame | None]:
    """The first strategy, from ``start`` downwards, that finds anything; (None, None) if none does."""
    names = list(strategies)
    for name in names[names.index(start) :]:
        if not (df := strategies[name]()).isEmpty():
            return name, df
    return None, None


def meta_cells(html: Column) -> Column:
    """Map of what a page says of itself: names of meta elements, og: properties, the first time element, and pairs of term and description or of table cells; the first of a name counts."""

    def pairs(h: Column) -> Column:
        def found(pattern: str, name: Column | None = None) -> Column:
            hits = F.regexp_extract_all(h, F.lit(pattern), F.lit(0))
            key = lambda x: name if name is not None else F.lower(F.trim(F.regexp_replace(F.regexp_extract(x, pattern, 1), r":\s*$", "")))
            return F.transform(hits, lambda x: F.struct(key(x).alias("k"), F.trim(unescape(F.regexp_replace(F.regexp_extract(x, pattern, 2), "<[^>]+>", ""))).alias("v")))

        return F.concat(
            found(r'(?is)<(time)[^>]*datetime="([^"]*)"', F.lit("date")), found(r'(?is)<meta\s+name="([^"]+)"\s+content="([^"]*)"'), found(r'(?is)<meta\s+property="og:([^"]+)"\s+content="([^"]*)"'),
            found(r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"), found(r"(?is)<th[^>]*>(.*?)</th>\s*<td[^>]*>(.*?)</td>"),
        )

    def first(all_pairs: Column) -> Column:
        filled = F.filter(all_pairs, lambda p: (p["k"] != "") & (p["v"] != ""))
        names = F.array_distinct(F.transform(filled, lambda p: p["k"]))
        return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), F.get(F.filter(filled, lambda p: p["k"] == n), F.lit(0))["v"].alias("value"))))

    return once(once(html, pairs), first)


def _progress_folder(folder: str, landing: str) -> str:
    return f"{folder}/{hashlib.sha256(landing.encode()).hexdigest()}"


def save_progress(found: DataFrame, folder: str, landing: str, strategy: str, last_page: int, key: str = "page_url") -> None:
    """What a discovery that starts from a landing page has found so far, as one more version; rows replace those with their key."""
    upsert(found.sparkSession, found.withColumns({"strategy": F.lit(strategy), "last_page": F.lit(last_page), "landing_url": F.lit(landing)}), _progress_folder(folder, landing), key)


def load_progress(spark: SparkSession, folder: str, landing: str) -> DataFrame | None:
    """The last finished version for this landing page, None if there is none: other landing pages don't see it, nor does a save that failed."""
    own = _progress_folder(folder, landing)
    return current(spark, own) if versions_of(spark, own) else None


def clear_progress(spark: SparkSession, folder: str, landing: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(_progress_folder(folder, landing))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
