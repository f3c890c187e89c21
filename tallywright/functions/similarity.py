"""Similarity of two strings, 0 to 100, as a native column expression.

The measure is 200 * LCS / (len(a) + len(b)), LCS being the length of the longest common
subsequence. The LCS is counted bit-parallel: one bit per character of the shorter string, one
add-and-mask step per character of the longer one; the unset bits at the end are the LCS. Up to 62
characters fit one BIGINT; longer strings carry over between 62-bit words, so no length is cut off.

Written as SQL text: one parsed expression instead of some hundred calls to build it. ``let`` binds
a value once; an expression used inside a lambda would be evaluated on every step.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 62
_FULL = (1 << _WORD) - 1


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _chars(s: str) -> str:
    return f"transform(sequence(1, length({s})), i -> substr({s}, i, 1))"


def _bits(s: str) -> str:
    """Each character with its own bit."""
    return f"transform({_chars(s)}, (x, i) -> struct(x AS x, shiftleft(1L, i) AS bit))"


# bit mask of the places that hold the character c
_PLACES = "aggregate({bits}, 0L, (m, b) -> if(b.x = c, m | b.bit, m))"
_LOW_BITS = "shiftleft(1L, {n}) - 1L"

_ONE_WORD = "length(p.short) - bit_count({})".format(
    _let(
        "e",
        f"struct({_bits('p.short')} AS bits, {_LOW_BITS.format(n='length(p.short)')} AS full)",
        f"""aggregate({_chars('p.long')}, e.full, (v, c) -> {
            _let("u", f"v & {_PLACES.format(bits='e.bits')}", "((v + u) | (v - u)) & e.full")})""",
    )
)

_WORDS = f"""transform(sequence(0, (length(p.short) - 1) DIV {_WORD}), w -> struct(
    CAST(w AS INT) AS no,
    {_bits(f'substr(p.short, CAST(w AS INT) * {_WORD} + 1, {_WORD})')} AS bits,
    {_LOW_BITS.format(n=f'least({_WORD}, length(p.short) - CAST(w AS INT) * {_WORD})')} AS used))"""

# one character of the longer string: add in every word, the carry goes to the next
_STEP = """aggregate(words, struct(0L AS carry, CAST(array() AS ARRAY<BIGINT>) AS done),
    (acc, w) -> {add}, acc -> acc.done)""".format(
    add=_let(
        "n",
        _let(
            "v",
            "get(state, w.no)",
            f"struct(v AS v, v & {_PLACES.format(bits='w.bits')} AS u)",
        ),
        f"""struct(shiftright(n.v + n.u + acc.carry, {_WORD}) AS carry,
            array_append(acc.done, ((n.v + n.u + acc.carry) & {_FULL}L) | (n.v - n.u)) AS done)""",
    )
)

_MANY_WORDS = _let(
    "words",
    _WORDS,
    f"""aggregate(zip_with(words,
            aggregate({_chars('p.long')}, transform(words, w -> {_FULL}L), (state, c) -> {_STEP}),
            (w, v) -> bit_count(~v & w.used)),
        0, (total, n) -> total + n)""",
)


def lcs_ratio(a: str, b: str) -> Column:
    """Similarity of the columns ``a`` and ``b``; null or empty gives 0, equal strings 100."""
    pair = f"""if(length({a}) <= length({b}), struct({a} AS short, {b} AS long),
                  struct({b} AS short, {a} AS long))"""
    lcs = _let("p", pair, f"if(length(p.short) <= {_WORD}, {_ONE_WORD}, {_MANY_WORDS})")
    return F.expr(f"""CASE
        WHEN {a} IS NULL OR {b} IS NULL OR length({a}) = 0 OR length({b}) = 0 THEN 0.0D
        WHEN {a} = {b} THEN 100.0D
        ELSE 200.0D * {lcs} / (length({a}) + length({b})) END""")
