"""Column expressions reproducing Python string semantics with built-ins.

All of these stay JVM-side (whole-stage codegen); no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.isspace`` accepts (Unicode White_Space plus the
# four ASCII information separators \x1c-\x1f).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Java regex character class for the same set.
WS_CLASS = r"[\p{IsWhite_Space}\x{1c}-\x{1f}]"

# Letters that have case (Python's "cased" property).
CASED_CLASS = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def py_rstrip_chars(c, chars: str) -> Column:
    """Python ``str.rstrip(chars)``."""
    return F.rtrim(col_(c), F.lit(chars))


def collapse_ws(c) -> Column:
    """``re.sub(r"\\s+", " ", s)`` with Python's Unicode whitespace."""
    return F.regexp_replace(col_(c), WS_CLASS + "+", " ")


def py_title(c) -> Column:
    """Python ``str.title()``.

    A word restarts after any uncased character (``joe's`` -> ``Joe'S``),
    unlike ``initcap`` which only restarts after a blank. A blank is put
    after every uncased character, ``initcap`` (lower-case all, title-case
    each character after a blank) runs, and the added blanks are removed
    again. Stays in codegen; titlecase digraphs and ligatures follow Java's
    titlecase mapping like Python's.
    """
    uncased = f"([^{CASED_CLASS}])"
    spaced = F.regexp_replace(col_(c), uncased, "$1 ")
    return F.regexp_replace(F.initcap(spaced), uncased + " ", "$1")


def match_key(c) -> Column:
    """Lower, strip, collapse whitespace; null becomes ''."""
    return F.coalesce(collapse_ws(py_strip(F.lower(col_(c)))), F.lit(""))


def sorted_tokens(c) -> Column:
    """Whitespace tokens sorted by code point and re-joined with one blank.

    Input must already be a :func:`match_key` (single blanks, no edges).
    """
    return F.array_join(F.array_sort(F.split(col_(c), " ")), " ")


def regex_literal(text: str) -> str:
    """Escape a literal for Java / RE2 alternations (both accept these)."""
    out = []
    for ch in text:
        if ch in r"\.^$|?*+()[]{}":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


# ---------------------------------------------------------------------------
# Rule tables as one SQL expression string: a 100-branch CASE built from
# Column objects costs thousands of driver->JVM calls per query; parsed from
# text it is one call. Inputs are column names.
# ---------------------------------------------------------------------------


def sql_lit(v) -> str:
    """Spark SQL literal for a rule value (strings escaped, doubles exact)."""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def contains_any_sql(x: str, tokens) -> str:
    """True iff any token is a substring of ``x``; null -> false."""
    return "coalesce(" + " OR ".join(f"contains({x}, {sql_lit(t)})" for t in tokens) + ", false)"


def first_keyword_sql(x: str, rules) -> str:
    """Value of the first rule whose keyword is a substring of ``x``."""
    return "CASE " + " ".join(f"WHEN contains({x}, {sql_lit(k)}) THEN {sql_lit(v)}" for k, v in rules) + " END"


def lookup_sql(x: str, mapping: dict) -> str:
    """``mapping.get(x)``: unknown and null give null."""
    return f"CASE {x} " + " ".join(f"WHEN {sql_lit(k)} THEN {sql_lit(v)}" for k, v in mapping.items()) + " END"


def any_contains(c, tokens) -> Column:
    """True iff any token is a substring; null input -> False."""
    c = col_(c)
    expr = F.lit(False)
    for tok in tokens:
        expr = expr | F.coalesce(c.contains(tok), F.lit(False))
    return expr


def first_keyword(c, rules) -> Column:
    """Value of the first (keyword, value) rule whose keyword is a substring.

    Rule order decides, not the position in the text. Null -> no match.
    """
    c = col_(c)
    expr = None
    for kw, value in rules:
        cond = c.contains(kw)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr


def literal_map(mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def map_lookup(c, mapping: dict) -> Column:
    """``dict.get(c)``; unknown and null keys give null."""
    return F.try_element_at(literal_map(mapping), col_(c))
