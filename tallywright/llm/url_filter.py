"""URL filters whose decisions follow redirects and canonical links.

Rules decide first, the longest that fits a URL. A page without a rule belongs to the component of its
URL over redirect and canonical-link edges: an allowed URL there allows it, else a blocked one
blocks it, else it is allowed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .components import connected_components

# A whole tag, however long; quoted values may hold ">". A quote that is never closed ends at ">".
_TAG = r"""(?is)<(?:link|meta|base)(?=[\s/])(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""
_ATTRIBUTE = r"""(?s)([^\s"'<>/=]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_HIDDEN = r"""(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)"""
_CODE = "&#([xX]?[0-9A-Fa-f]{1,6});?"
# The entities that stand for the characters of markup.
ENTITIES = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and for URLs without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    # only ASCII letters change
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")
    )


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The rule that decides, as struct(rule, verdict), or null.

    ``rules`` holds (host, path prefix, allow or block); a rule fits its host and all subdomains.
    The longest host and path together win; of equally long ones the longer host, then allow.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0]), r[2]))
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in ordered
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments; the first, which is empty, always stays."""

    def step(kept, part):
        shorter = F.slice(kept, F.lit(1), F.greatest(F.lit(1), F.size(kept) - 1))
        return (
            F.when(part == ".", kept).when(part == "..", shorter).otherwise(F.array_append(kept, part))
        )

    parts = F.split(path, "/")
    # a closing dot segment leaves its slash
    ended = F.when(path.rlike(r"/\.\.?$"), F.array_append(parts, F.lit(""))).otherwise(parts)
    plain = F.array_join(F.aggregate(ended, F.array().cast("array<string>"), step), "/")
    return F.when(path.rlike(r"/\.\.?(/|$)"), plain).otherwise(path)


def node(url: Column) -> Column:
    """A URL without scheme, fragment, dot segments and closing slash; null where it names no host."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, r"://[^/?#]*[^?#]*([^#]*)", 1)
    bare = F.regexp_replace(without_dots(path), "/+$", "")
    return F.when(host != "", F.concat(host, bare, query))


def absolute(base: Column, target: Column) -> Column:
    """``target`` as a full URL; relative ones are resolved against the host or folder of ``base``."""
    root = F.regexp_extract(base, r"^([^/?#]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([^/?#]*:)//", 1)
    folder = F.regexp_extract(base, r"^([^/?#]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), target))
        .when(target.startswith("#") | (target == ""), base)
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), target))
    )


def unescaped(value: Column) -> Column:
    """Character references by number, and those of markup by name, as their characters."""

    def character(code):
        hexadecimal = F.lower(code).startswith("x")
        number = F.regexp_replace(code, "^[xX]", "")
        decimal = F.conv(F.regexp_extract(code, "^([0-9]+)$", 1), 10, 16)
        digits = F.lpad(F.when(hexadecimal, number).otherwise(decimal), 8, "0")
        return F.coalesce(F.decode(F.unhex(digits), "UTF-32"), F.lit(""))

    gaps = F.split(value, _CODE, -1)
    codes = F.transform(F.regexp_extract_all(value, F.lit(_CODE), F.lit(1)), character)
    joined = F.array_join(F.zip_with(gaps, codes, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    plain = F.when(value.contains("&#"), joined).otherwise(value)
    for name, character_of in ENTITIES.items():
        plain = F.replace(plain, F.lit(name), F.lit(character_of))
    return F.when(value.contains("&"), plain).otherwise(value)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once a row: a plain column would be copied into every
    expression that names it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def tags_of(pages: DataFrame) -> DataFrame:
    """(url, base, tag, names, values): a row per link and meta tag outside comments and scripts.

    ``names`` are the tag's attributes in lower case, ``values`` theirs as written, ``base`` the target
    of the page's first base tag with one, if any.
    """
    html = F.col("html")
    shown = F.when(html.rlike("(?i)<!--|<script"), F.regexp_replace(html, _HIDDEN, " ")).otherwise(html)
    whole = once(
        pages.where(html.rlike("(?i)canonical|refresh")), "whole", F.regexp_extract_all(shown, F.lit(_TAG), F.lit(0))
    )
    bases = F.filter("whole", lambda t: t.rlike(r"(?is)^<base\s[^>]*href\s*="))
    opened = once(whole, "first", F.get(bases, F.lit(0))).select(
        "url",
        F.regexp_extract_all(F.col("first"), F.lit(_ATTRIBUTE), F.lit(1)).alias("b_names"),
        F.regexp_extract_all(F.col("first"), F.lit(_ATTRIBUTE), F.lit(2)).alias("b_values"),
        F.explode("whole").alias("tag"),
    )
    lowered = lambda names: F.transform(names, lambda n: F.lower(n))
    parts = once(
        opened.where(~F.col("tag").rlike("(?i)^<base")),
        "parts",
        F.struct(
            lowered(F.regexp_extract_all("tag", F.lit(_ATTRIBUTE), F.lit(1))).alias("names"),
            F.regexp_extract_all("tag", F.lit(_ATTRIBUTE), F.lit(2)).alias("values"),
            lowered(F.col("b_names")).alias("b_names"),
        ),
    )
    return once(parts, "base", unescaped(attribute(F.col("parts.b_names"), F.col("b_values"), "href"))).select(
        "url", "base", F.lower(F.regexp_extract("tag", "^<([A-Za-z]+)", 1)).alias("tag"), "parts.names", "parts.values"
    )


def attribute(names: Column, values: Column, name: str) -> Column:
    """The value of the first attribute of that name, without quotes, or null."""
    at = F.array_position(names, name)
    value = F.get(values, (F.nullif(at, F.lit(0).cast("bigint")) - 1).cast("int"))
    return F.regexp_replace(value, "^[\"']|[\"']$", "")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): pages joined to the URLs that their canonical links and refresh redirects name.

    Every such tag counts, however long and in whatever order its attributes are. ``rel`` is a list of
    words; relative targets follow the first ``base`` tag, if there is one.
    """
    own = lambda name: attribute(F.col("names"), F.col("values"), name)
    rel = F.split(F.trim(F.lower(own("rel"))), r"\s+")
    canonical = (F.col("tag") == "link") & F.array_contains(rel, "canonical")
    refresh = (F.col("tag") == "meta") & (F.lower(F.trim(own("http-equiv"))) == "refresh")
    raw = F.when(canonical, own("href")).when(refresh, own("content"))
    found = once(tags_of(pages), "raw", raw).where("raw IS NOT NULL")
    found = once(found, "given", unescaped(F.col("raw")))
    named = F.regexp_extract("given", r"""(?is)^[\s0-9.;,]*+url\s*+=\s*+["']?+([^"']*+)""", 1)
    bare = F.regexp_extract("given", r"""(?is)^\s*+[0-9][0-9.]*+\s*+[;,]\s*+["']?+([^"']*+)""", 1)
    target = F.when(F.col("tag") == "link", F.col("given")).when(named != "", named).otherwise(bare)
    found = once(found, "to", F.regexp_replace(target, r"^\s+|\s+$", "")).where("to != ''")
    found = once(found, "from", F.coalesce(absolute(F.col("url"), F.col("base")), F.col("url")))
    found = once(found, "full", absolute(F.col("from"), F.col("to")))
    ends = found.select(node(F.col("url")).alias("a"), node(F.col("full")).alias("b"))
    return ends.where("a is not null and b is not null and a != b")


def judge_pages(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    redirects: DataFrame | None = None,
) -> DataFrame:
    """Verdict per row of ``pages`` (page_id, url, html).

    ``redirects`` adds observed redirects as (source, target) URLs. Columns: page_id, host, path,
    rule, verdict (allow or block), from_alias (decided by the component). Null urls and urls
    without ``://`` have empty parts, no rule and no aliases, and are allowed. Links in comments and
    scripts do not count. Repeated rows and
    ids are judged one by one; null html has no links; an empty table gives no rows. The rules are
    written into the plan, so they are meant to be a list that a person keeps.
    """
    pages = pages.select("page_id", "url", "html")
    edges = alias_edges(pages)
    if redirects is not None:
        observed = redirects.select(
            node(F.col("source")).alias("a"), node(F.col("target")).alias("b")
        )
        edges = edges.union(observed.where("a is not null and b is not null and a != b"))
    parts = scratch(connected_components(edges), "aliases")
    # a node is host and path, so rules can judge nodes that are no page of the table too
    n_host, n_path = url_parts(F.concat(F.lit("x://"), F.col("node")))
    decided = (
        parts.withColumn("own", rule_for(n_host, n_path, rules)["verdict"])
        .groupBy("component")
        .agg(
            F.max(F.col("own") == "allow").alias("allowed"),
            F.max(F.col("own") == "block").alias("blocked"),
        )
        .where("blocked or allowed")
    )
    of_node = parts.join(decided, "component").select(
        "node", F.when(F.col("allowed"), "allow").otherwise("block").alias("alias_verdict")
    )
    host, path = url_parts(F.col("url"))
    judged = pages.select(
        "page_id", host.alias("host"), path.alias("path"), node(F.col("url")).alias("node")
    ).withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    return judged.join(of_node, "node", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own")["rule"].alias("rule"),
        F.coalesce(F.col("own")["verdict"], "alias_verdict", F.lit("allow")).alias("verdict"),
        (F.col("own").isNull() & F.col("alias_verdict").isNotNull()).alias("from_alias"),
    )
