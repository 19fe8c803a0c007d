"""URL filters over redirect equivalence (operator 11).

*Rules* name a host and a path prefix.  A rule fits its host and all subdomains
if the URL's path starts with the rule's; the longest wins (of equally long
ones, allow).  Every URL is looked up by its host's suffixes and its path's
prefixes of the lengths that rules have, as an equi-join, so a URL meets only
rules that fit it, however many rules a host has.

*Aliases.*  Canonical links and meta refreshes of the pages' own markup, and
redirects from a table if one is given, are edges between URLs.  Connected
components over those edges (``components``: large-star and small-star steps,
each a join and an aggregation keyed by node) are groups of aliases.  A URL
without a rule takes its group's decision: allow if a rule allows any alias,
else block if a rule blocks any.  A URL with a rule keeps it, whatever its
aliases are.  Rules also hold for aliases that are no pages of the table.

Edges join URLs without scheme, default port, fragment and letter case of the
host, since those name the same resource.  Links are read outside comments and
scripts; relative ones are resolved against the page's URL.

Only distinct URLs are judged; pages get their verdict by their URL, so a URL
that a third of all pages hold is a hot key on the streamed side only (split by
AQE).

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule, links with nothing and is allowed; empty or null markup holds no
links; a link to a URL without a host is no edge; repeated rows are judged
alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.components import components
from courtline.llm.store import stored, tune

#: (verdict, rule) of the registered query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_TAG = r"(?is)<(?:link|meta)\b[^<>]*+>"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)"
_ATTRIBUTE = re.compile(r"""([a-z][a-z-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def host_of(url: str = "url") -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str = "url") -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: str) -> Column:
    """The name of a URL's resource; null without a host."""
    host = F.regexp_replace(host_of(url), r":(?:80|443)?$", "")
    path = path_of(url)
    query = F.regexp_extract(F.col(url), r"(?s)^[^#]*?://[^#?]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.coalesce(query, F.lit(""))))


def links_of(tags: Sequence[str], url: str) -> list[str]:
    """The URLs that canonical links and meta refreshes among the tags name."""
    out = []
    for tag in tags:
        has = {m[1].lower(): (m[2] or m[3] or m[4] or "").replace("&amp;", "&").strip() for m in _ATTRIBUTE.finditer(tag)}
        to = None
        if tag[1:5].lower() == "link" and "canonical" in has.get("rel", "").lower().split():
            to = has.get("href")
        elif tag[1:5].lower() == "meta" and has.get("http-equiv", "").lower() == "refresh":
            found = re.match(r"""[\d.\s]*[;,]\s*url\s*=\s*['"]?([^'"]*)""", has.get("content", ""), re.I)
            to = found and found[1].strip()
        if to:
            try:
                out.append(urljoin(url, to))
            except ValueError:                                     # not a URL
                continue
    return out


def page_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url) by the markup of pages (url, html)."""
    hinted = pages.filter(F.col("url").isNotNull() & (F.col("html").ilike("%canonical%") | F.col("html").ilike("%refresh%")))
    tags = hinted.select("url", F.regexp_extract_all(F.regexp_replace("html", _HIDDEN, " "), F.lit(_TAG), F.lit(0)).alias("tags"))
    tags = tags.withColumn("tags", F.filter("tags", lambda t: t.ilike("%canonical%") | t.ilike("%refresh%"))).filter(F.size("tags") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(u, to) for u, t in zip(b.column("url").to_pylist(), b.column("tags").to_pylist(), strict=True) for to in links_of(t, u)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*found, strict=True) if found else ((), ()))], ["from_url", "to_url"])

    return tags.mapInArrow(run, "from_url string, to_url string")


def rule_table(df: DataFrame) -> DataFrame:
    """rule, verdict, rule_host, rule_path: one row a rule; a rule that both blocks and allows, allows."""
    one = df.filter("rule is not null and verdict in ('allow', 'block')").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    at = F.instr("rule", "/")
    host = F.when(at > 0, F.expr("substring(rule, 1, instr(rule, '/') - 1)")).otherwise(F.col("rule"))
    path = F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit(""))
    parts = one.select("rule", "verdict", F.lower(host).alias("rule_host"), path.alias("rule_path"))
    return parts.groupBy("rule_host", "rule_path").agg(F.min(F.struct("verdict", "rule")).alias("r")).select("rule_host", "rule_path", "r.rule", "r.verdict")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule that fits each (host, path) of ``urls``: host, path, rule, verdict; those without one are left out."""
    table = rule_table(rules)
    lengths = sorted(r[0] for r in table.select(F.length("rule_path")).distinct().collect())   # as many as path lengths of rules
    if not lengths:
        return urls.sparkSession.createDataFrame([], "host string, path string, rule string, verdict string")
    places = urls.select("host", "path").distinct().filter("host <> ''")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.lit(lengths), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = places.withColumn("rule_host", F.explode(suffixes)).withColumn("rule_path", F.explode(prefixes))
    met = tried.join(table, ["rule_host", "rule_path"])
    best = F.max(F.struct(F.length("rule").alias("size"), (F.col("verdict") == "allow").alias("allows"), "rule", "verdict")).alias("best")
    return met.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, *, redirects: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule (null: none), verdict and decided_by (rule, alias or default) of every page.

    ``rules``: (verdict, rule) pairs, or a table (verdict, rule).
    ``redirects``: a table (from_url, to_url) beside the links in the markup.
    """
    spark = tune(pages.sparkSession)
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, rule string")
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    links = page_links(own)
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("from_url").cast("string").alias("from_url"), F.col("to_url").cast("string").alias("to_url")))
    links = links.filter("from_url is not null and to_url is not null").distinct()
    links = stored(links.withColumn("a", node_of("from_url")).withColumn("b", node_of("to_url")).filter("a is not null and b is not null"), "url-links")
    groups = stored(components(links.filter("a <> b"), "a", "b"), "url-groups")

    # all URLs that are judged: the pages' and those that links name
    known = links.select(F.explode(F.array("from_url", "to_url")).alias("url"))
    urls = own.select("url").filter("url is not null").unionByName(known).distinct()
    urls = urls.select("url", host_of().alias("host"), path_of().alias("path"), node_of("url").alias("node"))
    decided = urls.join(ruled(urls, rules), ["host", "path"], "left")
    decided = stored(decided.join(groups.withColumnRenamed("component", "alias_group"), "node", "left"), "url-rules")
    by_group = decided.filter("alias_group is not null and verdict is not null").groupBy("alias_group").agg(F.min("verdict").alias("group_verdict"))  # allow < block
    judged = decided.join(by_group, "alias_group", "left").select(
        F.col("url").alias("judged"), "host", "path", "rule", F.coalesce("verdict", "group_verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("verdict").isNotNull(), "rule").when(F.col("group_verdict").isNotNull(), "alias").otherwise("default").alias("decided_by"))
    return own.select("page_id", "url").join(judged, F.col("url") == F.col("judged"), "left").select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.coalesce("decided_by", F.lit("default")).alias("decided_by"))
