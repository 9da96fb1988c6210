"""Rule tables of any length as one multi-pattern automaton.

A CASE chain scans a text once for every rule. Here the rules are rows of a
table; a task builds an Aho-Corasick automaton of them and walks each text once,
whatever the number of rules. The table is read by the driver, so it is bounded
(``MAX_CHARS``, checked first); a longer one raises.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of all keywords and values together, at most: some 1 GB of automaton in a worker.
MAX_CHARS = 20_000_000


def _bounded(rules: DataFrame, columns: list[str]) -> DataFrame:
    chars = rules.agg(F.sum(sum(F.coalesce(F.length(c), F.lit(0)) for c in columns))).head()[0] or 0
    if chars > MAX_CHARS:
        raise ValueError(f"the rules hold {chars} characters, more than {MAX_CHARS}")
    return rules


def _build(words: dict[str, int]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, number in words.items():
        automaton.add_word(word, (number, len(word)))
    automaton.make_automaton()
    return automaton


def first_rule(text: Column, rules: DataFrame, keyword: str = "keyword", value: str = "value", priority: str = "priority") -> Column:
    """The value of the first rule, by ``priority`` (ties by keyword, then value), whose keyword occurs
    in lower(text). Null text is empty, rules without a keyword are none, '' occurs in every text."""
    rows = rules.filter(F.col(keyword).isNotNull()).select(F.col(keyword).alias("k"), F.col(value).cast("string").alias("v"), F.col(priority).alias("p"))
    ordered = sorted(_bounded(rows, ["k", "v"]).collect(), key=lambda r: (r.p is None, r.p if r.p is not None else 0, r.k, r.v or ""))
    words: dict[str, int] = {}
    for number, row in enumerate(ordered):
        words.setdefault(row.k, number)
    values = [r.v for r in ordered]
    always = words.pop("", len(values))

    @F.pandas_udf("string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _build(words) if words else None

        def one(s):
            best = always
            if automaton is not None:
                best = min((number for _, (number, _) in automaton.iter(s)), default=best)
                best = min(best, always)
            return values[best] if best < len(values) else None

        for batch in batches:
            yield batch.map(one).astype(object)

    return scan(F.coalesce(F.lower(text), F.lit("")))


def fold(s: str) -> str:
    """Case folded one character for one, as case-insensitive patterns compare."""
    if s.isascii():
        return s.lower()
    up = (u if len(u := c.upper()) == 1 else c for c in s)
    return "".join(c.lower()[0] for c in up)


def first_name(text: Column, names: DataFrame, name: str = "name") -> Column:
    """The leftmost place where a name occurs, case aside, as written in ``text``; the longest
    name there. Null where none does, or the text is null. Empty and null names are none."""
    kept = names.filter(F.length(name) > 0).select(F.col(name).alias("k")).distinct()
    words = {fold(r.k): 0 for r in _bounded(kept, ["k"]).collect()}

    @F.pandas_udf("string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _build(words) if words else None

        def one(s):
            if s is None or automaton is None:
                return None
            best = min(((end - n + 1, -n) for end, (_, n) in automaton.iter(fold(s))), default=None)
            return None if best is None else s[best[0] : best[0] - best[1]]

        for batch in batches:
            yield batch.map(one).astype(object)

    return scan(text)
