"""Allow and block rules for urls, carried over to aliases of the same page.  DataFrame functions only.

Redirects and canonical links are edges between urls; their connected components are sets of aliases.  A page without a
rule of its own is blocked if an alias is blocked, unless an alias is allowed by a rule: an allow has precedence.  Pages
without a decision are allowed.

Defined results: a null url, or one without ``://``, has an empty host and path, so no rule fits, and it has no aliases;
null html has no links; repeated pages get the same verdict; relative links are resolved against the page's ``base`` or
url, empty and malformed ones are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.components import components

Rule = tuple[str, str, str]  # verdict, host, path

RULES: list[Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise("")


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict, null if none fits.

    Rules are a parameter of the job, compiled into one expression; the longest is tested first.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


# Scheme, user, host, and what follows.
_PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://)([^/?#@]*@)?([^/?#]+)(.*)$"


def node(url: Column) -> Column:
    """A url without its fragment, which no server sees, scheme and host in lower case; null if it isn't absolute."""
    plain = F.regexp_extract(url, r"^([^#]*)", 1)
    part = lambda n: F.regexp_extract(plain, _PARTS, n)
    return F.when(plain.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/?]"), F.concat(_lower(part(1)), part(2), _lower(part(3)), part(4)))


def _with(value: Column, then) -> Column:
    """``then(value)``, where the value is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _without_dots(url: Column) -> Column:
    """An absolute url with the segments ``.`` and ``..`` of its path taken out."""
    front = F.regexp_extract(url, r"^([^/?#]*//[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[^/?#]*//[^/?#]*([^?#]*)", 1)
    steps = F.split(path, "/")
    dotted = lambda x: (x == ".") | (x == "..")
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", up(acc)).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))),
    )
    kept = F.when(dotted(F.element_at(steps, -1)), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    tail = F.substr(url, F.length(front) + F.length(path) + 1)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(front, F.array_join(kept, "/"), tail)).otherwise(url)


def resolve(target: Column, base: Column) -> Column:
    """The absolute url of a link on a page with the absolute url ``base``; null for an empty link."""
    front = F.regexp_extract(base, r"^([^/?#]*//[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[^/?#]*//[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "^(.*/)", 1))
    full = (
        F.when(target == "", None)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, "^([^/?#]*)", 1), target))
        .when(target.startswith("/"), F.concat(front, target))
        .when(target.startswith("?"), F.concat(front, path, target))
        .when(target.startswith("#"), F.concat(front, path, query, target))
        .otherwise(F.concat(front, folder, target))
    )
    return _with(full, lambda u: F.when(u.contains("://"), _without_dots(u)))


def _written(value: Column) -> Column:
    """An attribute with its ampersands decoded."""
    return F.regexp_replace(value, "(?i)&(?:amp|#0*38|#x0*26);", "&")


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges from pages to the targets of their canonical links and refresh redirects: ``a``, ``b``."""
    tags = F.filter(
        F.regexp_extract_all(F.col(html_col), F.lit(r"(?i)(<(?:link|meta)\b[^>]*>)"), F.lit(1)),
        lambda t: t.rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b|\bhttp-equiv\s*=\s*[\"']?refresh\b"),
    )
    canonical = lambda t: F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    refresh = lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    target = lambda t: _written(F.when(t.rlike("(?i)^<link"), canonical(t)).otherwise(refresh(t)))
    base = _written(F.regexp_extract(F.col(html_col), r"(?i)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    rows = pages.select(node(F.col(url_col)).alias("a"), F.transform(tags, target).alias("to"), base.alias("base"))
    rows = rows.filter("a is not null and size(`to`) > 0")
    base = F.coalesce(_with(resolve(F.col("base"), F.col("a")), node), F.col("a"))
    ends = _with(base, lambda at: F.transform("to", lambda t: _with(resolve(t, at), node)))
    return rows.select("a", F.explode(ends).alias("b")).filter("b is not null and a != b")


def judge(
    pages: DataFrame,
    rules: list[Rule] = RULES,
    links: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every page.

    ``links`` (``a``, ``b``) are further redirects, say from a crawl log; they are added to those in the pages.
    """
    edges = alias_links(pages, url_col, html_col)
    if links is not None:
        edges = edges.unionByName(links.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")).dropna())
    alias = store.stored(components(edges), "aliases")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), node(F.col("url")).alias("node"))
    rule, own = decide(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), own.alias("own"), "node")
    # Decisions on aliases: every node counts, whether or not its page is in the table.
    _, on_node = decide(host_of(F.col("node")), path_of(F.col("node")), rules)
    group = alias.groupBy("component").agg(
        F.max(F.when(on_node == "block", 1).otherwise(0)).alias("blocked"),
        F.max(F.when(on_node == "allow", 1).otherwise(0)).alias("allowed"),
    )
    blocked = group.filter("blocked = 1 and allowed = 0").select("component")
    aliases = alias.join(blocked, "component").select(F.col("node").alias("n"), F.lit("block").alias("passed"))
    out = rows.join(aliases, F.col("node") == F.col("n"), "left")
    verdict = F.coalesce("own", "passed", F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
