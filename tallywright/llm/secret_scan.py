"""Secret scans with multipart credential linking.

Strong matches (assignments to a secret's name, access identifiers, long hexadecimal strings) are
always reported. Weak candidates (bare key material, account names, endpoints) are reported only
where a complementary part of a credential stands near them in the same scope, and beside them: no part
confirms what it overlaps, such as key material inside an address. Scopes are the blocks of a text, cut at
blank lines, section headers and closing braces. A strong part confirms within ``REACH`` code points from
the end of one to the start of the other; two weak ones confirm each other within ``WEAK_REACH``.

The interval join runs along each scope's parts in order of place: a candidate needs only the last part
of each role that ends before it, and the first that starts behind it, so a text full of candidates
makes no pairs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, scratch, with_key
from .spans import Kind, digest, find

REACH = 300  # code points between a weak candidate and a strong part
WEAK_REACH = 80  # and between two weak ones

_NAMES = "password|passwd|secret|token|api_?key"
_SET = r"""["']?\x20*+[:=]\x20*+["']?"""
_ACCOUNTS = "user(?:_?name)?|login|account|client_?id|access_?key_?id"
KINDS = [
    Kind(
        "assign",
        rf"(?i:({_NAMES})){_SET}([A-Za-z0-9+/_.=-]+)",
        rf"(?i:{_NAMES}){_SET}[A-Za-z0-9+/_.=-]",
    ),
    Kind("access", "AKIA[A-Z0-9]{12,}+", "AKIA", by_pattern=False),
    Kind("hex", "(?<![0-9a-f])[0-9a-f]{32,}+", "[0-9a-f]{32}"),
    Kind(
        "key_material",
        "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])",
        "[A-Za-z0-9+/_-]{24}",
    ),
    Kind(
        "account",
        rf"(?<![A-Za-z0-9_])(?i:{_ACCOUNTS}){_SET}[A-Za-z0-9@._-]{{3,}}+",
        rf"(?<![A-Za-z0-9_])(?i:{_ACCOUNTS}){_SET}[A-Za-z0-9@._-]{{3}}",
    ),
    Kind(
        "endpoint",
        r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s"'<>]++""",
        "://",
        by_pattern=False,
    ),
]
BASE = ["assign", "access", "hex"]
#: ends of scopes: blank lines, lines that are a [section], lines that begin with a closing brace
BREAK = Kind("break", r"\n(?=[\x20\t\r]*+(?:\n|[}\])]|\[[^\]\n]++\][\x20\t\r]*+(?:\n|$)))", "\n", by_pattern=False)
#: role of each kind in a credential
ROLES = {
    "assign": "secret",
    "hex": "secret",
    "key_material": "secret",
    "access": "identifier",
    "account": "identifier",
    "endpoint": "endpoint",
}
#: roles that confirm a weak candidate
COMPLEMENT = {
    "key_material": ["identifier", "endpoint"],
    "account": ["secret"],
    "endpoint": ["secret"],
}


def candidates(docs: DataFrame) -> DataFrame:
    """Matches that pass their checks. Key material must mix cases and digits and repeat little."""
    found = find(docs, KINDS)
    value = F.regexp_extract("match", KINDS[0].pattern, 2)
    mixed = (
        F.col("match").rlike("[a-z]")
        & F.col("match").rlike("[A-Z]")
        & F.col("match").rlike("[0-9]")
        & (F.size(F.array_distinct(F.split("match", ""))) >= 14)
    )
    return found.where(
        F.when(F.col("kind") == "assign", F.length(value) >= 8)
        .when(F.col("kind") == "key_material", mixed)
        .otherwise(True)
    ).select(KEY, "kind", "start", "stop")


def scoped(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``found`` with the number of its scope in the document; breaks are sought only in documents that
    have a weak candidate, and counted up to the start of each match."""
    weak = found.where(F.col("kind").isin(list(COMPLEMENT)))
    chosen = docs.join(weak.select(KEY).distinct(), KEY, "left_semi")
    breaks = find(chosen, [BREAK]).select(KEY, "kind", "start", "stop")
    in_order = Window.partitionBy(KEY).orderBy("start", F.col("kind") != BREAK.name)
    counted = found.join(weak.select(KEY).distinct(), KEY, "left_semi").union(breaks).withColumn(
        "scope", F.count_if(F.col("kind") == BREAK.name).over(in_order)
    )
    return counted.where(F.col("kind") != BREAK.name)


def linked(parts: DataFrame, reach: int = REACH, weak_reach: int = WEAK_REACH) -> DataFrame:
    """The weak candidates of ``parts`` (__row_key, scope, kind, start, stop) that a complementary part
    confirms."""
    roles = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    named = parts.withColumn("role", F.element_at(roles, F.col("kind"))).withColumn(
        "strong", F.col("kind").isin(BASE)
    )
    # a part is seen where it ends by candidates that start there or later, and the other way round
    seen = F.array(
        F.struct(F.col("stop").alias("before"), F.col("start").alias("behind"), F.lit(True).alias("part")),
        F.struct(F.col("start").alias("before"), F.col("stop").alias("behind"), F.lit(False).alias("part")),
    )
    marks = named.select("*", F.inline(seen))
    forward = Window.partitionBy(KEY, "scope").orderBy("before", ~F.col("part"))
    backward = Window.partitionBy(KEY, "scope").orderBy(F.desc("behind"), ~F.col("part"))

    def gaps(role: str, strong: bool) -> Column:
        of = F.col("part") & (F.col("role") == role) & (F.col("strong") == strong)
        ended = F.max(F.when(of, F.col("stop"))).over(forward)
        begins = F.min(F.when(of, F.col("start"))).over(backward)
        return F.least(F.col("start") - ended, begins - F.col("stop"))

    kinds = sorted({(role, k in BASE) for k, role in ROLES.items()})
    measured = marks.select("*", *[gaps(r, s).alias(f"{r}_{s}") for r, s in kinds])
    confirmed = F.lit(False)
    for kind, needed in COMPLEMENT.items():
        near = [
            F.coalesce(F.col(f"{r}_{s}") <= (reach if s else weak_reach), F.lit(False))
            for r, s in kinds
            if r in needed
        ]
        for one in near:
            confirmed = confirmed | ((F.col("kind") == kind) & one)
    return measured.where(~F.col("part") & confirmed).select(KEY, "kind", "start", "stop")


def secret_scan(docs: DataFrame, reach: int = REACH, weak_reach: int = WEAK_REACH) -> DataFrame:
    """Secrets per row of ``docs`` (doc_id, text).

    Columns: __row_key, doc_id, n_assign, n_access, n_hex, base_sha256, spans. Null and empty texts
    have none. Repeated rows are scanned one by one, and parts link only inside one scope of a row's text. An
    empty table gives no rows. Other columns are not looked at.
    """
    keyed = with_key(docs)
    keyed = keyed.select(KEY, "doc_id", "text")
    found = scratch(candidates(keyed), "candidates")
    near = linked(scoped(found, keyed), reach, weak_reach)
    reported = found.where(F.col("kind").isin(BASE)).union(near)
    return digest(keyed.select(KEY, "doc_id"), reported, [k.name for k in KINDS], BASE)


