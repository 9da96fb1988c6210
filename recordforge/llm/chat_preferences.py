"""Preference formatting of chosen and rejected conversations (operator 1, native).

A pair has two lists of turns. Their longest common prefix of turns (equal role
and text) is rendered once as the prompt; what follows on either side is
rendered as a completion with a mask: the character spans of the turns to learn
from, those of the assistant, ``start:length`` from the completion's begin. All
of it is one projection of built-in functions over turn arrays; rows only move
to bring the turns of a conversation together.

A conversation is one record, one row of the result, so its turns meet in one
row by nature; a group of many conversations never does. Null text is empty,
null role is ``none``, a null turn number comes first; turns with equal numbers
are ordered by role and text, and repeated turns stay. Turns without an id belong
to no common conversation: each is one of its own, with a null id. A pair that lacks a side has that side empty. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARN_ROLE = "assistant"


def turn_arrays(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, an array of (turn, role, text). A turn without an id is
    a conversation of its own, so rows without one never meet."""
    named, alone = _named_and_alone(turns, conv_id, turn, role, text)
    return named.unionByName(alone)


def _named_and_alone(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """``turn_arrays`` in two: conversations with an id, and turns without one."""
    one = F.struct(
        F.coalesce(F.col(turn).cast("bigint"), F.lit(-1).cast("bigint")).alias("turn"),
        F.coalesce(F.col(role), F.lit("none")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    turns = turns.select(F.col(conv_id).alias("conv_id"), one.alias("one"))
    named = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    return named, turns.filter(F.col("conv_id").isNull()).select("conv_id", F.array("one").alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that agree in role and text."""
    same = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def render_turn(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render_turn), "")


def mask(turns: Column, learn_role: str = LEARN_ROLE) -> Column:
    """``start:length`` of the text of every turn to learn from, its end mark included, within the rendered turns."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head = F.length(t["role"]) + 5
        body = F.length(t["text"]) + 8
        span = F.concat_ws(":", (acc["at"] + head).cast("string"), (body - 1).cast("string"))
        spans = F.when(t["role"] == learn_role, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + head + body).cast("bigint").alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, zero, step, lambda acc: acc["spans"]), ",")


def format_pairs(pairs: DataFrame, learn_role: str = LEARN_ROLE) -> DataFrame:
    """(pair_id, n_prefix_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) from
    (pair_id, chosen, rejected), arrays of turns; a null side is empty."""
    kind = pairs.schema["chosen"].dataType
    none = F.array().cast(kind)
    pairs = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    pairs = pairs.withColumn("k", common_turns(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(side, F.col("k") + 1, F.greatest(F.size(side) - F.col("k"), F.lit(0)))
    pairs = pairs.select("pair_id", "k", F.slice("c", 1, F.col("k")).alias("p"), rest(F.col("c")).alias("c"), rest(F.col("r")).alias("r"))
    return pairs.select(
        "pair_id",
        F.col("k").alias("n_prefix_turns"),
        render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        mask(F.col("c"), learn_role).alias("chosen_mask"),
        render(F.col("r")).alias("rejected"),
        mask(F.col("r"), learn_role).alias("rejected_mask"),
    )


def swapped_answers(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) for a table of conversations without preferences: a conversation
    is preferred to itself with its last answer replaced by that of its neighbour (ids 2k and
    2k + 1), where it ends. Without such a neighbour the rejected side ends before that answer;
    a conversation without an answer is paired with itself."""
    named, alone = _named_and_alone(turns)
    last = F.element_at(F.filter("turns", lambda t: t["role"] == LEARN_ROLE), -1)
    has = F.exists("turns", lambda t: t["role"] == LEARN_ROLE)
    neighbour = F.col("conv_id").bitwiseXOR(F.lit(1))
    # the join asks this of one side; asked of both, they are one plan, and the turns are shuffled once
    named = named.filter(neighbour.isNotNull()).withColumn("last", F.when(has, last))
    other = named.select(neighbour.alias("_id"), F.col("last")["text"].alias("_text"))
    pairs = named.join(other, F.col("conv_id") == F.col("_id"), "left").drop("_id")
    # turns without an id have no neighbour and stay out of the join
    pairs = pairs.unionByName(alone.withColumns({"last": F.when(has, last), "_text": F.lit(None).cast("string")}))
    size = F.size("turns")
    # the last answer's place: the array is in order, so it is found from the end
    back = F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), LEARN_ROLE)
    before = F.slice("turns", 1, (size - back).cast("int"))
    swap = F.struct(F.col("last")["turn"].alias("turn"), F.lit(LEARN_ROLE).alias("role"), F.col("_text").alias("text"))
    rejected = (
        F.when(F.col("last").isNull(), F.col("turns"))
        .when(F.col("_text").isNull(), before)
        .otherwise(F.concat(before, F.array(swap)))
    )
    return pairs.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'none') AS role, coalesce(text, '') AS text FROM conversations
), convs AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM t WHERE conv_id IS NOT NULL GROUP BY conv_id
  UNION ALL SELECT conv_id, [{'turn': turn, 'role': role, 'text': text}] FROM t WHERE conv_id IS NULL
), last AS (
  SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')[-1] AS at FROM convs
), pairs AS (
  SELECT a.conv_id AS pair_id, a.turns AS c,
         CASE WHEN a.at IS NULL THEN a.turns
              WHEN b.at IS NULL THEN a.turns[1:a.at - 1]
              ELSE list_append(a.turns[1:a.at - 1], {'turn': a.turns[a.at].turn, 'role': 'assistant', 'text': b.turns[b.at].text}) END AS r
  FROM last a LEFT JOIN last b ON xor(a.conv_id, 1) = b.conv_id
), k AS (
  SELECT *, coalesce(list_filter(range(1, greatest(len(c), len(r)) + 1),
         lambda i: i > len(c) OR i > len(r) OR c[i].role <> r[i].role OR c[i].text <> r[i].text)[1] - 1, len(c)) AS k
  FROM pairs
), cut AS (
  SELECT pair_id, k, c[1:k] AS p, c[k + 1:] AS c, r[k + 1:] AS r FROM k
), drawn AS (
  SELECT pair_id, k,
         list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS p,
         list_transform(c, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS c,
         list_transform(r, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS r,
         list_transform(c, lambda t: t.role) AS cr, list_transform(r, lambda t: t.role) AS rr
  FROM cut
)
SELECT pair_id, CAST(k AS INTEGER) AS n_prefix_turns,
       array_to_string(p, '') AS prompt, array_to_string(c, '') AS chosen,
       array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: cr[i] = 'assistant'),
         lambda i: CAST(coalesce(list_sum(list_transform(c[1:i - 1], lambda x: length(x))), 0) + length(cr[i]) + 5 AS BIGINT) || ':' || CAST(length(c[i]) - length(cr[i]) - 6 AS BIGINT)), ',') AS chosen_mask,
       array_to_string(r, '') AS rejected,
       array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: rr[i] = 'assistant'),
         lambda i: CAST(coalesce(list_sum(list_transform(r[1:i - 1], lambda x: length(x))), 0) + length(rr[i]) + 5 AS BIGINT) || ':' || CAST(length(r[i]) - length(rr[i]) - 6 AS BIGINT)), ',') AS rejected_mask
FROM drawn
"""
