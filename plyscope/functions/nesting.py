"""Nested text: a depth automaton over the tokens of one text, in built-in functions.

One pass over a token array keeps the running sum of opening and closing tokens. Only where a
stretch of interest ends is it noted, as a pair of token places, so the cost follows the number of
tokens whatever the nesting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_STATE = "struct<i:int,depth:int,start:int,found:array<struct<first:int,last:int>>>"


def _scan(tokens: Column, opens: Sequence[str], closes: Sequence[str], enters, leaves, start: int) -> Column:
    """The automaton's last state. ``enters(before, after)`` and ``leaves(before, after)`` say at which changes of
    depth a stretch begins (with this token) and ends; ``start`` is the first stretch's first place, or 0."""
    begin = F.from_json(F.lit(f'{{"i":1,"depth":0,"start":{start},"found":[]}}'), _STATE)

    def step(s, token):
        # a closing token without its opening one changes nothing
        depth = F.when(token.isin(*opens), s["depth"] + 1).when(token.isin(*closes), F.greatest(s["depth"] - 1, F.lit(0))) \
            .otherwise(s["depth"])
        ends = leaves(s["depth"], depth)
        return F.struct(
            (s["i"] + 1).alias("i"), depth.alias("depth"),
            F.when(enters(s["depth"], depth), s["i"]).when(ends, F.lit(0)).otherwise(s["start"]).alias("start"),
            F.when(ends & (s["start"] > 0), F.concat(s["found"], F.array(F.struct(s["start"].alias("first"), s["i"].alias("last")))))
             .otherwise(s["found"]).alias("found"))

    return F.aggregate(tokens, begin, step)


def outermost(tokens: Column, opens: Sequence[str], closes: Sequence[str]) -> Column:
    """The tokens outside all nesting, in order, without the opening and closing ones."""
    state = _scan(tokens, opens, closes, lambda a, b: (a > 0) & (b == 0), lambda a, b: (a == 0) & (b > 0), 1)
    # a stretch ends with the opening token; the last one, if open, with the text
    parts = F.transform(state["found"], lambda s: F.slice(tokens, s["first"], s["last"] - s["first"] + 1))
    rest = F.when((state["depth"] == 0) & (state["start"] > 0), F.slice(tokens, state["start"], F.size(tokens))) \
        .otherwise(F.array().cast("array<string>"))
    return F.filter(F.concat(F.flatten(parts), rest), lambda t: ~t.isin(*opens, *closes))


def inside(tokens: Column, opens: Sequence[str], closes: Sequence[str], level: int) -> Column:
    """(text, complete) of each stretch that an opening token brings to ``level``, closing token included;
    a last one that is never closed is not complete."""
    state = _scan(tokens, opens, closes, lambda a, b: (a == level - 1) & (b == level), lambda a, b: (a == level) & (b == level - 1), 0)
    whole = F.transform(state["found"], lambda s: F.struct(
        F.array_join(F.slice(tokens, s["first"], s["last"] - s["first"] + 1), "").alias("text"), F.lit(True).alias("complete")))
    cut = F.when(state["start"] > 0, F.array(F.struct(
        F.array_join(F.slice(tokens, state["start"], F.size(tokens)), "").alias("text"), F.lit(False).alias("complete"))))
    return F.concat(whole, F.coalesce(cut, F.array().cast("array<struct<text:string,complete:boolean>>")))
