"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed in cells of (source, language, topic). Each value of each dimension has a factor, and a cell's sampling
rate is the product of its three, 1 at most. Raking sets the factors in turn: those of a dimension so that the tokens its
values are expected to give meet their targets, cells whose rate is held at 1 included. On the driver it runs for ROUNDS rounds at
least and then until no share is off its target by more than TOLERANCE, for MOST_ROUNDS at most.

A value can't give more tokens than it has, so the budget is lowered until the targets can be met: to the largest part of
all tokens at which, in each dimension, the values that are too scarce for their targets are short by SHORT of the sample
together. Such values are taken whole, and the others of their dimension share what they leave, in proportion to their
targets; so every share is within SLACK of its target. Targets that no rates of the cells' pattern meet (each source in one
language of its own, say) are reported by a warning and by shares(), which names them.

A document is sampled if the hash of its id falls under its cell's rate.

Defined results: null sources, languages and topics are values of their own ('' each); a null text has no tokens; a
document without tokens takes its cell's rate, and the rate of a cell without tokens is 0; rows that repeat an id are
sampled together within a cell; a null id is hashed as ''; targets for values that the table lacks are left out. An empty
table gives an empty result. sample() keeps all columns, also those named as its own. Fits of many cells run as tables;
their rates may differ from the driver's in the last digits, and so in single draws.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import removed, renamed_apart, with_names, written

#: Raking rounds at least and at most.
ROUNDS, MOST_ROUNDS = 40, 60
#: Largest miss of a share that ends the raking.
TOLERANCE = 1e-6
#: Largest difference of a share from its target that counts as met, and the part of the sample by which the scarce values
#: of a dimension may be short of their targets, all together, which leaves something to the fit's own miss.
SLACK = 1e-3
SHORT = 0.99 * SLACK
#: The factor of a value that is taken whole, and the largest of any.
WHOLE = 1e30
#: Cells that the driver fits; more are fitted as tables.
DRIVER_CELLS = 200_000
DIMENSIONS = ("source", "lang", "topic")
#: A marginal's target shares are its token shares to this power, normalised: 1 keeps them, 0 makes all values equal.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
BUDGET = 0.7


def token_estimate(text: str = "text") -> Column:
    """Tokens of a text for weighing: its runs of characters other than white space."""
    return F.expr(rf"cast(if(btrim({text}, ' \t\n\u000B\u000C\r') = '' or {text} is null, 0, size(split(btrim({text}, ' \t\n\u000B\u000C\r'), '[\\x20\\x09-\\x0D]+'))) as bigint)")


def topic_of(text: str = "text") -> Column:
    """A document's topic by its form, where a table has none: mostly numbers, markup, lists of short lines, long or short
    prose."""
    t = f"coalesce({text}, '')"
    digits, symbols = rf"char_length({t}) - char_length(regexp_replace({t}, '[0-9]', ''))", rf"char_length({t}) - char_length(regexp_replace({t}, '[#*$%&|<>{{}}]', ''))"
    lines = rf"char_length({t}) - char_length(replace({t}, '\n', '')) + 1"
    return F.expr(f"case when 20 * ({digits}) > char_length({t}) then 'numbers' when 50 * ({symbols}) > char_length({t}) then 'markup' when 40 * ({lines}) > char_length({t}) then 'lists' when char_length({t}) > 4000 then 'long prose' else 'prose' end")


def annotated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic and tokens of every document."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
        (F.coalesce(F.col(topic_col).cast("string"), F.lit("")) if topic_col else F.lit(None).cast("string")).alias("topic"),
    ).select("doc_id", "source", "lang", F.coalesce("topic", topic_of()).alias("topic"), token_estimate().alias("tokens"))


def _target(cells: DataFrame, d: str, targets: dict[str, dict[str, float]]) -> DataFrame:
    """The values of a dimension, their tokens and their target shares."""
    sums = cells.groupBy(d).agg(F.sum("tokens").alias("sum"))
    if d in targets:
        given = cells.sparkSession.createDataFrame([(str(k), float(v)) for k, v in targets[d].items()], f"{d} string, raw double")
        raw = sums.join(given, d, "left").select(d, "sum", F.coalesce("raw", F.lit(0.0)).alias("raw"))
    else:
        raw = sums.select(d, "sum", F.when(F.col("sum") > 0, F.pow(F.col("sum").cast("double"), TEMPER[d])).otherwise(0.0).alias("raw"))
    whole = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select(d, F.col("sum").cast("double").alias("sum"), (F.col("raw") / whole).alias("share"))


def reach(parts: np.ndarray, shares: np.ndarray, slack: float = SHORT) -> float:
    """The largest budget at which values of these parts of all tokens are short of their shares by no more than the slack.

    The scarcest k values are short by (their shares - their parts / budget), which bounds the budget for each k.
    """
    wanted = shares > 0
    order = np.argsort(parts[wanted] / shares[wanted], kind="stable")
    have, want = np.cumsum(parts[wanted][order]), np.cumsum(shares[wanted][order]) - slack
    return float(np.min(have[want > 0] / want[want > 0], initial=1.0))


def goals(parts: np.ndarray, shares: np.ndarray, budget: float) -> np.ndarray:
    """Parts of all tokens that values give: their shares of the budget, the scarce ones all that they have and the others
    more, in proportion."""
    goal, free = np.minimum(shares * budget, parts), shares > 0
    for _ in range(len(parts)):
        free &= goal < parts
        rest = shares[free].sum()
        if rest <= 0:
            break
        new = goal.copy()
        new[free] = shares[free] * (budget - goal[~free].sum()) / rest
        if (new <= parts).all():
            return new
        goal = np.minimum(new, parts)
    return goal


def _factors(tokens: np.ndarray, rest: np.ndarray, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """For each value the factor that makes its cells, at most whole, give the goal: sum(min(1, factor * rest) * tokens).

    Cells are held at 1 in descending order of `rest`; the factor is that of the first cell that isn't.
    """
    order = np.lexsort((-rest, at))
    value, t, r = at[order], tokens[order], rest[order]
    begin = np.searchsorted(value, np.arange(len(goal) + 1))
    held, free = np.concatenate([[0], np.cumsum(t)]), np.concatenate([np.cumsum((t * r)[::-1])[::-1], [0]])
    full = held[begin[1:]] - held[begin[:-1]]
    out = np.where(goal >= full * (1 - 1e-12), WHOLE, 0.0)
    # Sums within a value, taken from its own cells alone: differences of long running sums would lose small values.
    for v in np.flatnonzero((out == 0) & (goal > 0)).tolist():
        own = slice(begin[v], begin[v + 1])
        before = np.concatenate([[0], np.cumsum(t[own])[:-1]])
        after = np.cumsum((t[own] * r[own])[::-1])[::-1]
        factor = np.divide(goal[v] - before, after, out=np.full(len(after), WHOLE), where=after > 0)
        fits = np.flatnonzero(factor * r[own] <= 1)
        out[v] = min(factor[fits[0]], WHOLE) if len(fits) else WHOLE
    return out


def _warn(rounds: int, miss: float) -> None:
    if miss > SLACK:
        warnings.warn(f"mixture targets are out of reach: after {rounds} rounds a share misses its target by {miss:.3g}", RuntimeWarning, stacklevel=3)


def rates(rows: DataFrame, *, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, rounds: int = ROUNDS, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """source, lang, topic, tokens and rate of every cell. rows: as annotated() gives them.

    targets: shares by dimension and value, normalised; tempered token shares for dimensions that it lacks. budget: the
    part of all tokens to sample at most.
    """
    spark = rows.sparkSession
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    if cells.count() > driver_cells:
        return _rates_as_tables(cells, targets or {}, budget)
    found = cells.orderBy(*DIMENSIONS).collect()
    tokens = np.array([r.tokens for r in found], float)
    total = tokens.sum()
    rate = np.zeros(len(tokens))
    if total > 0:
        codes, shares_, part = {}, {}, {}
        for d in DIMENSIONS:
            values, codes[d] = np.unique([r[d] for r in found], return_inverse=True)
            sums = np.bincount(codes[d], tokens)
            raw = np.array([targets[d].get(v, 0.0) for v in values.tolist()]) if targets and d in targets else np.where(sums > 0, sums, 0) ** TEMPER[d] * (sums > 0)
            shares_[d], part[d] = raw / raw.sum() if raw.sum() > 0 else raw, sums / total
        budget = min(budget, *(reach(part[d], shares_[d]) for d in DIMENSIONS))
        goal = {d: goals(part[d], shares_[d], budget) * total for d in DIMENSIONS}
        factor = {d: np.ones(len(goal[d])) for d in DIMENSIONS}
        done, miss = 0, np.inf
        while done < rounds or (miss > TOLERANCE and done < MOST_ROUNDS):
            for d in DIMENSIONS:
                a, b = (factor[e][codes[e]] for e in DIMENSIONS if e != d)
                factor[d] = _factors(tokens, a * b, codes[d], goal[d])
            done += 1
            rate = np.minimum(1, factor["source"][codes["source"]] * factor["lang"][codes["lang"]] * factor["topic"][codes["topic"]]) * (tokens > 0)
            given = (rate * tokens).sum() or 1.0
            miss = max(np.abs(np.bincount(codes[d], rate * tokens) / given - goal[d] / goal[d].sum()).max() for d in DIMENSIONS)
        _warn(done, miss)
    data = [(r.source, r.lang, r.topic, r.tokens, float(x)) for r, x in zip(found, rate, strict=True)]
    # At most driver_cells short rows: documents stay where they are when they meet their rates.
    return F.broadcast(spark.createDataFrame(data, "source string, lang string, topic string, tokens long, rate double"))


def shares(cells: DataFrame, *, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """dimension, value, target, achieved and reached of every value: its target share, the share of all sampled tokens that
    its rates give it, and whether they differ by no more than SLACK.

    cells: as rates() gives them.
    """
    spent = cells.withColumn("spent", F.col("tokens") * F.col("rate"))
    total = spent.agg(F.sum("spent")).first()[0] or 1.0
    parts = []
    for d in DIMENSIONS:
        own = spent.groupBy(d).agg((F.sum("spent") / total).alias("achieved"))
        reached = F.abs(F.col("achieved") - F.col("share")) <= SLACK
        parts.append(_target(cells, d, targets or {}).join(own, d).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col("share").alias("target"), "achieved", reached.alias("reached")))
    return parts[0].union(parts[1]).union(parts[2])


def _rates_as_tables(cells: DataFrame, targets: dict[str, dict[str, float]], budget: float) -> DataFrame:
    """The same fit with cells, goals and factors as tables; only totals reach the driver.

    A round takes one step towards each factor: what the cells that are held at 1 give is taken from the goal, and the rest
    is shared by the others. The factors of a round are written, those of the round before removed.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    if total <= 0:
        return cells.withColumn("rate", F.lit(0.0))
    wanted = {d: written(_target(cells, d, targets).where("share > 0"), "share") for d in DIMENSIONS}
    budget = min(budget, *(_reach_as_table(wanted[d], total) for d in DIMENSIONS))
    factor = {d: _goals_as_table(wanted[d], d, total, budget) for d in DIMENSIONS}
    done, miss = 0, float("inf")
    while miss > TOLERANCE and done < MOST_ROUNDS:
        misses = []
        for d in DIMENSIONS:
            own = _with_factors(cells, factor)
            held = F.col("rate") >= 1
            tokens = F.col("tokens").cast("double")
            sums = own.groupBy(d).agg(F.sum(F.when(held, tokens).otherwise(0.0)).alias("whole"), F.sum(F.when(~held, tokens * F.col("rate")).otherwise(0.0)).alias("free"), F.sum(tokens * F.least("rate", F.lit(1.0))).alias("given"))
            short = F.col("goal") - F.col("whole")
            scale = F.when((F.col("free") > 0) & (short > 0), short / F.col("free")).otherwise(F.coalesce(F.try_divide(F.col("goal"), F.col("given")), F.lit(1.0)))
            step = F.when(F.col("goal") >= F.col("sum") * (1 - 1e-12), F.lit(WHOLE)).otherwise(F.least(F.col("factor") * scale, F.lit(WHOLE)))
            new = written(factor[d].join(sums, d).select(d, "sum", "goal", step.alias("factor"), (F.abs(F.col("given") - F.col("goal")) / (budget * total)).alias("miss")), f"factor{done}")
            misses.append(new.agg(F.max("miss")).first()[0] or 0.0)
            before, factor[d] = factor[d], new.drop("miss")
            removed(before)
        done, miss = done + 1, max(misses)
    _warn(done, miss)
    return written(_with_factors(cells, factor).select(*DIMENSIONS, "tokens", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), "rate")).otherwise(0.0).alias("rate")), "rates")


def _with_factors(cells: DataFrame, factor: dict[str, DataFrame]) -> DataFrame:
    out = cells
    for d in DIMENSIONS:
        out = out.join(factor[d].select(d, F.col("factor").alias(f"f_{d}")), d, "left").fillna(0.0, [f"f_{d}"])
    return out.withColumn("rate", F.col("f_source") * F.col("f_lang") * F.col("f_topic"))


def _crossing(df: DataFrame, value, goal: float, low: float, high: float) -> float:
    """The largest point, nearly, at which the sum of a rising value is no more than the goal; six passes of 32 points."""
    for _ in range(6):
        points = np.linspace(low, high, 33).tolist()
        sums = df.agg(*[F.sum(value(x)).alias(f"p{i}") for i, x in enumerate(points)]).first()
        at = max((i for i, x in enumerate(sums) if (x or 0.0) <= goal), default=0)
        low, high = points[at], points[min(at + 1, 32)]
    return low


def _reach_as_table(wanted: DataFrame, total: float) -> float:
    return _crossing(wanted, lambda b: F.greatest(F.col("share") - F.col("sum") / (max(b, 1e-12) * total), F.lit(0.0)), SHORT, 0.0, 1.0)


def _goals_as_table(wanted: DataFrame, d: str, total: float, budget: float) -> DataFrame:
    """The tokens that values give, and first factors for the fit."""
    goal = lambda m: F.least(F.col("share") * (m * budget * total), F.col("sum"))
    m = _crossing(wanted, goal, budget * total, 1.0, 2.0)
    return written(wanted.select(d, "sum", goal(m).alias("goal"), F.lit(budget ** (1 / 3)).alias("factor")), "goals")


def draw(id_col: str = "doc_id", seed: str = "mix") -> Column:
    """A number in [0, 1) from the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0


def mixture(docs: DataFrame, *, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, driver_cells: int = DRIVER_CELLS, **columns) -> DataFrame:
    """doc_id, source, lang, topic, tokens, rate and sampled of every document."""
    rows = written(annotated(docs, **columns), "annotated")  # a few bytes a document instead of a second reading of texts
    cells = rates(rows, targets=targets, budget=budget, driver_cells=driver_cells).select(*DIMENSIONS, "rate")
    return rows.join(cells, list(DIMENSIONS), "left").select("doc_id", *DIMENSIONS, "tokens", "rate", (draw() < F.col("rate")).alias("sampled"))


def sample(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None, **options) -> DataFrame:
    """The sampled rows of docs with all their columns."""
    columns = {"id_col": id_col, "text_col": text_col, "source_col": source_col, "lang_col": lang_col, "topic_col": topic_col}
    cells = rates(annotated(docs, **columns), **options).select(F.col("source").alias("__s"), F.col("lang").alias("__l"), F.col("topic").alias("__t"), F.col("rate").alias("__r"))
    rows, names = renamed_apart(docs, "__s", "__l", "__t", "__r", "__source", "__lang", "__topic")
    own = lambda c: F.coalesce(F.col(f"`{names[c]}`").cast("string"), F.lit(""))
    topic = own(topic_col) if topic_col else topic_of(f"cast(`{names[text_col]}` as string)")
    keys = rows.withColumns({"__source": own(source_col), "__lang": own(lang_col), "__topic": topic})
    on = (F.col("__source") == F.col("__s")) & (F.col("__lang") == F.col("__l")) & (F.col("__topic") == F.col("__t")) & (draw(f"`{names[id_col]}`") < F.col("__r"))
    return with_names(keys.join(cells, on, "left_semi"), names)
