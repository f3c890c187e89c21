"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

E-mail and IP addresses, payment cards (Luhn) and international telephone numbers are always
reported once they pass their checks. Account numbers (IBAN, mod 97), national telephone and social
security numbers start from a lower score and are reported where it reaches the threshold, with the
help of words nearby.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, scratch, with_key
from .spans import Kind, digest, find

THRESHOLD = 0.6
CONTEXT_BONUS = 0.35

_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = [
    # a match starts with the run of local characters, or where the last match ended
    Kind(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        by_pattern=False,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
    ),
    Kind(
        "national_phone",
        r"(?<![0-9+().\x20-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        r"[0-9]{3}[\x20.-][0-9]{4}",
    ),
    Kind(
        "ssn",
        "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    ),
]
BASE = ["email", "ip", "card", "phone"]
#: score of a checked match without context
SCORES = {
    "email": 0.95,
    "ip": 0.7,
    "card": 0.8,
    "phone": 0.75,
    "iban": 0.8,
    "national_phone": 0.4,
    "ssn": 0.4,
}
#: words nearby that raise the score
CONTEXT = {
    "email": "e-?mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "national_phone": "phone|tel|call|mobile|fax|contact",
    "ssn": "ssn|social|security|tax",
}


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(d: Column, place: Column) -> Column:
        n = d.cast("int")
        return F.when(place % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    return _sum(F.transform(F.split(F.reverse(digits), ""), value)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without blanks leaves 1 after division by 97."""
    turned = F.split(F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4))), "")

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c >= "A", rest * 100 + letter).otherwise(rest * 10 + F.ascii(c) - 48) % 97

    return F.aggregate(turned, F.lit(0), step) == 1


def checked(found: DataFrame) -> DataFrame:
    """Matches that pass the check of their kind, with a score."""
    match, kind = F.col("match"), F.col("kind")
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    byte = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    checks = {
        "ip": match.rlike(rf"^{byte}(?:\.{byte}){{3}}$"),
        "card": n.between(12, 19) & luhn(digits),
        "phone": n.between(9, 15),
        "iban": mod97(F.replace(match, F.lit(" "), F.lit(""))),
        "ssn": ~match.rlike("^(?:000|666|9)|-00-|0000$"),
    }
    near = F.lower(F.concat_ws(" ", "before", "after"))
    context = reduce(
        lambda c, kv: c.when(kind == kv[0], near.rlike(rf"(?<![a-z])(?:{kv[1]})")),
        CONTEXT.items(),
        F.when(F.lit(False), F.lit(False)),
    )
    valid = reduce(
        lambda c, kv: c.when(kind == kv[0], kv[1]), checks.items(), F.when(F.lit(False), F.lit(False))
    ).otherwise(True)
    base = F.element_at(F.create_map(*[F.lit(x) for kv in SCORES.items() for x in kv]), kind)
    score = F.least(F.lit(1.0), base + F.when(context, CONTEXT_BONUS).otherwise(0.0))
    return found.where(valid).select(KEY, "kind", "start", "stop", score.alias("score"))


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Personal data per row of ``docs`` (doc_id, text).

    Columns: __row_key, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans. Base kinds are
    reported whatever their score. Null and empty texts have none. Repeated rows are scanned one by
    one; an empty table gives no rows. Other columns are not looked at.
    """
    keyed = with_key(docs)
    keyed = keyed.select(KEY, "doc_id", "text")
    found = scratch(checked(find(keyed, KINDS)), "personal")
    reported = found.where(F.col("kind").isin(BASE) | (F.col("score") >= threshold))
    return digest(keyed.select(KEY, "doc_id"), reported, [k.name for k in KINDS], BASE)
