"""URL filters with redirect equivalence, JVM only.

URLs that lead to each other (redirects and canonical links; on request also
spellings that servers redirect) are one page under several names.  Their connected
components carry a block decision from any name to the names that no rule
fits; an explicit allow has precedence.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, col, materialise
from .components import connected_components

_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ATTRIBUTE = r"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _HOST_PATH, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _HOST_PATH, 2), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``length, allow, rule`` of the longest rule that fits, else null.

    ``rules`` is a list on the driver and becomes a literal of the plan."""
    listed = F.array(*[F.struct(F.lit(len(r.host) + len(r.path)).alias("length"), F.lit(r.verdict == "allow").alias("allow"),
                                F.lit(r.host + r.path).alias("rule"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"))
                       for r in rules])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    return F.array_max(fits)


def canonical_spelling(url: Column) -> Column:
    """One spelling of URLs that differ only in scheme http(s), case of the
    host, default port, fragment, ``utm_`` parameters or a final slash."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    host = F.regexp_replace(host_of(plain), r":(80|443)$", "")
    path = F.regexp_replace(path_of(plain), r"/+$", "")
    query = F.regexp_extract(plain, r"(?s)^[^?]*\?(.*)$", 1)
    query = F.regexp_replace(F.concat(F.lit("&"), query), r"(?s)&utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&+|&+$", "")
    scheme = F.regexp_replace(ascii_lower(F.regexp_extract(plain, r"(?s)^(.*?)://", 1)), "^https?$", "web")
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(
        F.lit("?"), query)).otherwise(""))).otherwise(plain)


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, _ATTRIBUTE.replace("{name}", name), i) for i in (1, 2, 3)]
    return F.trim(F.regexp_replace(F.concat(*found), "&amp;", "&"))


def link_targets(html: Column) -> Column:
    """Targets of canonical links and refresh redirects in a page, as written."""
    body = F.coalesce(html, F.lit(""))
    links = F.filter(F.regexp_extract_all(body, F.lit(r"(?is)<link\s[^>]*>"), F.lit(0)),
                     lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    metas = F.filter(F.regexp_extract_all(body, F.lit(r"(?is)<meta\s[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    moved = F.transform(metas, lambda t: F.trim(F.regexp_replace(F.regexp_extract(
        _attribute(t, "content"), r"(?is)^[^;,]*[;,]\s*(?:url\s*=)?\s*(.*)$", 1), r"^['\"]|['\"]$", "")))
    return F.array_distinct(F.array_remove(F.concat(F.transform(links, lambda t: _attribute(t, "href")), moved), ""))


def without_dots(url: Column) -> Column:
    """The URL with the ``.`` and ``..`` segments of its path resolved."""
    parts = r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$"
    steps = F.split(F.regexp_extract(url, parts, 2), "/")
    # a dot at the end stands for a folder
    steps = F.concat(steps, F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")))
    # the first step is the empty one before the first slash; it stays
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(
        x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x))))
    return F.when(url.rlike(r"(?s)^.*?://[^/?#]*/([^?#]*/)?\.\.?([/?#]|$)"), F.concat(
        F.regexp_extract(url, parts, 1), F.array_join(kept, "/"), F.regexp_extract(url, parts, 3))).otherwise(url)


def absolute(target: Column, base: Column) -> Column:
    """A link target against the URL of its page, without dot segments."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)[^/]*$", 1)
    return without_dots(
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path_of(base), target))
        .when(F.startswith(target, F.lit("#")), F.concat(F.regexp_replace(base, r"(?s)#.*$", ""), target))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html", redirects: DataFrame | None = None, spellings: bool = True) -> DataFrame:
    """Per input row: ``id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the
    rule's; the longest (host and path together) wins, and of equally long
    ones an allow.  A page that no rule fits takes the decision of its
    component: allow if a rule explicitly allows any of its names, else
    block if one is blocked, else allow.  ``redirects`` may give more edges
    as ``from_url, to_url``.  With ``spellings``, URLs of one
    ``canonical_spelling`` are one name; without, only links join URLs.

    A null URL, or one without ``://``, has empty host and path, belongs to
    no component, and is allowed unless a rule for the empty host fits.  A
    null or empty page has no links; a very long one is searched as a whole,
    in its row.  Rows repeated exactly get the same values each; null ids are
    kept.  An empty table gives no rows.  Other columns are not looked at.
    """
    url = col(url_col)
    name = canonical_spelling if spellings else lambda u: u
    best = best_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        F.when(url.contains("://"), name(url)).alias("node")).withColumn("best", best)
    pairs = None
    if html_col is not None:
        found = pages.where(url.contains("://")).select(url.alias("from_url"), F.explode(link_targets(col(html_col))).alias("t"))
        pairs = found.select("from_url", absolute(F.col("t"), F.col("from_url")).alias("to_url"))
    if redirects is not None:
        more = redirects.select("from_url", "to_url")
        pairs = more if pairs is None else pairs.unionByName(more)
    named = rows.where("node IS NOT NULL").select("node", "best")
    roots = None
    if pairs is not None:
        pairs = materialise(pairs.where(F.col("from_url").contains("://") & F.col("to_url").contains("://")).distinct(), "url-links")
        ends = pairs.select(F.explode(F.array("from_url", "to_url")).alias("url"))
        ends = ends.select(name(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"),
                           path_of(F.col("url")).alias("path"))
        named = named.unionByName(ends.select("node", best.alias("best")))
        roots = connected_components(pairs.select(name(F.col("from_url")).alias("u"),
                                                  name(F.col("to_url")).alias("v")))
    decided = (named.where("best IS NOT NULL").groupBy("node")
               .agg(F.max("best.allow").alias("any_allow"), F.max(~F.col("best.allow")).alias("any_block")))
    if roots is not None:
        of_root = (decided.join(roots, "node").groupBy("root")
                   .agg(F.max("any_allow").alias("any_allow"), F.max("any_block").alias("any_block")))
        spread = roots.join(of_root, "root").select("node", "any_allow", "any_block")
        decided = decided.unionByName(spread).groupBy("node").agg(
            F.max("any_allow").alias("any_allow"), F.max("any_block").alias("any_block"))
    blocked = decided.where("any_block AND NOT any_allow").select("node", F.lit(True).alias("blocked"))
    out = rows.join(blocked, "node", "left")
    allow = F.when(F.col("best").isNotNull(), F.col("best.allow")).otherwise(F.col("blocked").isNull())
    return out.select("id", "host", "path", F.col("best.rule").alias("rule"),
                      F.when(allow, "allow").otherwise("block").alias("verdict"))
