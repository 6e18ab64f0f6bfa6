"""Operator 8: URL rules that follow redirects and canonical links.

A rule names a host (with its subdomains) and a path prefix; the longest that fits decides. A page that no rule fits
takes the verdict of its aliases: pages connected by redirects and canonical links form a component; one explicit
allow in it allows all of them, else one block blocks all, else they are allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.operators.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def _after(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The form under which links meet: host and path without scheme, query, fragment and closing slashes."""
    return F.concat(host_of(url), F.regexp_replace(path_of(url), r"/+\z", ""))


#: Tag, attribute that makes it a link, and where its target stands. ``canonical`` may be any word of rel.
LINKS = (
    ("link", r"rel\s*+=\s*+(?:canonical\b|[\"'](?:[^\"'<>]*\s)?canonical[\"'\s])", r"href\s*+=\s*+[\"']?([^\"'\s>]+)"),
    ("meta", r"http-equiv\s*+=\s*+[\"']?refresh", r"url\s*+=\s*+'?([^\"'\s>]+)"),
    ("meta", r"property\s*+=\s*+[\"']og:url", r"content\s*+=\s*+[\"']([^\"']+)"),
)


def links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, target): canonical links (the word among those of rel), meta refreshes and og:url of each page row, made absolute against its url."""
    # A tag ends at the next angle bracket, so each is read once, closed or not; its attributes are looked for in it alone.
    tags = lambda name: F.regexp_extract_all("html", F.lit(rf"(?is)<{name}\b[^<>]*+>"), 0)
    having = lambda name, has, value: F.transform(
        F.filter(tags(name), lambda t: t.rlike(rf"(?is)\b{has}")), lambda t: F.regexp_extract(t, rf"(?is)\b{value}", 1)
    )
    found = F.concat(*(having(*x) for x in LINKS))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.where("url is not null and html is not null").select("page_id", "url", F.explode(found).alias("target")).where("target <> ''")
    scheme = F.regexp_extract("url", r"(?s)^(.*?://)", 1)
    return rows.select(
        "page_id",
        "url",
        F.when(F.col("target").contains("://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(F.regexp_replace(scheme, "//", ""), "target"))
        .when(F.col("target").startswith("/"), F.concat(scheme, host_of(F.col("url")), "target"))
        .otherwise(F.concat(scheme, host_of(F.col("url")), F.regexp_extract(path_of(F.col("url")), r"(?s)^(.*/)?", 1), "target"))
        .alias("target"),
    )


def matched(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, action) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None, *,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``redirects``: further edges (source url, target url) from a crawl log. Equal addresses are one node, whatever their
    number of pages; a target that is no page still connects those that name it. A null url, or one without ``://``, has
    empty host and path, no rule and no alias, and is allowed. A link belongs to the url of its row, so rows with a null id
    link too, and rows with one id and different urls link each for itself; repeated rows are judged alike. Null html has no
    links; html of any length is read once, closed or not. Empty table: no rows. Only the named columns are read.
    """
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.col(html_col).alias("html"))
    judged = base.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn(
        "m", matched(F.col("host"), F.col("path"), rules)
    )
    judged = common.stored(
        judged.select("page_id", "host", "path", "m.rule", "m.action", F.when(F.col("host") != "", F.xxhash64(address(F.col("url")))).alias("node")), "judged"
    )
    made = links(base).select("url", "target")
    if redirects is not None:
        made = made.unionByName(redirects.toDF("url", "target"))
    key = lambda c: F.when(host_of(F.col(c)) != "", F.xxhash64(address(F.col(c))))
    linked = components(made.select(key("url").alias("u"), key("target").alias("v")))
    nodes = judged.where("node is not null").groupBy("node").agg(*(F.max((F.col("action") == a).cast("int")).alias(a) for a in ("allow", "block")))
    nodes = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = nodes.groupBy("component").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    known = nodes.select("node", "component").join(groups, "component")
    spread = F.when(F.col("allow") == 1, "allow").when(F.col("block") == 1, "block").otherwise("allow")
    return judged.join(known, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("action", spread).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
