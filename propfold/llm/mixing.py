"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language and topic). Raking scales the cell weights to
each target marginal in turn, until no marginal misses its target by more than
``TOLERANCE``; a target that is not given is the tempered one, shares in proportion to
tokens to the power that ``POWERS`` has for it. A cell's rate is its raked share of the
token budget over its tokens, and a document is kept if a number drawn from a hash of its
id lies below its rate.

No cell has more tokens than it has, so the budget is lowered to the largest one at which
every rate is at most 1: the kept tokens then meet the targets, whatever the budget. A
lowered budget is logged, and so are targets that raking cannot meet, as they contradict
each other on the cells at hand (``ROUNDS`` is the bound on its rounds).

Only DataFrame functions. What is shuffled is cells, never documents, however many rows
one source has; the cells go back to the documents by broadcast if a count shows that
they are few, else by a join that adaptive execution can split. No task holds all cells
of a value unless all cells are few.

Null dimensions form a cell value of their own, ``NONE``. A null or empty text has no
tokens; a cell without tokens has rate 1, it costs nothing. Rows of one doc_id share a
draw; rows without one draw by their text. Values that a target does not name keep their
tempered share; targets are normed over the values that occur.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propfold.llm.packing import word_count
from propfold.llm.staging import stage

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 100
TOLERANCE = 1e-6
POWERS = {"source": 0.7, "lang": 1.0, "topic": 1.0}
BUDGET = 0.8
SEED = "mix"
NONE = "(none)"
# Rounds that lower the miss by less than this part have stalled.
STALL = 0.001
# Cells up to this count are broadcast, and held in one task; at some 100 bytes each.
FEW_CELLS = 50_000

log = logging.getLogger(__name__)

# Topics by the first whose marks a text holds, any of them.
TOPICS = {
    "legal": ("icensed under", "the MIT License", "ights reserved", "opyright"),
    "table": (" | ",),
    "markup": ("***", "###", "$$$", "%%%", "&&&"),
    "contact": ("@",),
    "shouting": ("!! ",),
}
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def topic(text: Column) -> Column:
    def holds(marks: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(text, F.lit(mark)) for mark in marks))

    pairs = [(holds(marks), name) for name, marks in TOPICS.items()]
    return reduce(lambda out, p: out.when(*p), pairs[1:], F.when(*pairs[0])).otherwise("prose")


def unit_draw(seed: str) -> Column:
    """A number from 0 to 1 out of the first 52 bits of an MD5."""
    key = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), "text", F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def target_shares(cells: DataFrame, dimension: str, target: dict[str, float] | None, power: float) -> DataFrame:
    """(value, share) of one dimension; the shares add up to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("sum"))
    share = F.pow("sum", F.lit(power))
    if target:
        pairs = [x for name, value in target.items() for x in (F.lit(name), F.lit(float(value)))]
        given = F.element_at(F.create_map(*pairs), F.col(dimension))
        tempered = share / F.lit(sums.agg(F.sum(share)).first()[0] or 1.0)
        share = F.coalesce(given, tempered)
    sums = sums.where("sum > 0").withColumn("share", share)
    total = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.select(dimension, (F.col("share") / F.lit(total)).alias(f"{dimension}_share"))


def total(rows: DataFrame, column: str) -> float:
    return rows.agg(F.sum(column)).first()[0] or 1.0


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], powers: dict[str, float], rounds: int, count: int) -> DataFrame:
    """Cells with tokens, and ``weight``: shares of the total that meet the marginals.

    ``count`` is the number of cells. Up to ``FEW_CELLS`` their marginals are windows. One
    value of a dimension may hold any share of the cells, so of more cells the marginals
    are sums combined on the map side and joined back, and each step is a table of its own.
    """
    rows = cells.where("tokens > 0")
    for d in DIMENSIONS:
        rows = rows.join(target_shares(cells, d, targets.get(d), powers[d]), d)
    rows = rows.withColumn("weight", F.col("tokens") / F.lit(float(total(rows, "tokens"))))
    last = float("inf")
    for _ in range(rounds):
        rows = rows.withColumn("miss", F.lit(0.0))
        for d in DIMENSIONS:
            scaled = F.col("weight") * F.col(f"{d}_share") / F.col("now")
            missed = F.greatest("miss", F.abs(F.col("now") - F.col(f"{d}_share")))
            if count <= FEW_CELLS:
                now = F.sum("weight").over(Window.partitionBy(d))
                rows = rows.repartition(1 + count // 20_000, d).withColumn("now", now)
                rows = rows.withColumns({"miss": missed, "weight": scaled}).drop("now")
                continue
            sums = rows.groupBy(d).agg(F.sum("weight").alias("now"))
            rows = rows.join(sums, d).withColumns({"miss": missed, "weight": scaled}).drop("now")
            rows = stage(rows, "raked")
        if count <= FEW_CELLS:
            rows = stage(rows, "raked")
        # The miss of the marginals that the round met with, before it scaled them.
        miss = rows.agg(F.max("miss")).first()[0] or 0.0
        if miss <= TOLERANCE:
            break
        if miss > last * (1 - STALL):
            log.warning("Targets contradict each other on these cells: a share is missed by %.4f.", miss)
            break
        last = miss
    else:
        log.warning("Raking was stopped after %d rounds, a share was missed by %.6f in the last.", rounds, last)
    return rows.select(*DIMENSIONS, "tokens", "weight")


def described(documents: DataFrame) -> DataFrame:
    """Documents with n_tokens and the three dimensions as mix_source, mix_lang, mix_topic."""
    return documents.withColumns(
        {
            "mix_tokens": word_count(F.col("text")),
            "mix_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
            "mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
            "mix_topic": F.when(F.col("text").isNull(), NONE).otherwise(topic(F.col("text"))),
        }
    )


def cell_table(rows: DataFrame) -> DataFrame:
    return rows.groupBy(
        F.col("mix_source").alias("source"), F.col("mix_lang").alias("lang"), F.col("mix_topic").alias("topic")
    ).agg(F.sum("mix_tokens").alias("tokens"))


def mix(
    documents: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    budget: float = BUDGET,
    powers: dict[str, float] = POWERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """Documents with mix_tokens, mix_source, mix_lang, mix_topic, mix_rate and mix_kept.

    Columns of the input that have one of these names are replaced.
    """
    targets = {"lang": LANGUAGES} if targets is None else targets
    rows = described(documents)
    cells = stage(cell_table(rows), "cells")
    count, tokens = cells.agg(F.count("*"), F.sum("tokens")).first()
    raked = stage(rake(cells, targets, powers, rounds, count), "weights")
    wanted = budget * float(tokens or 0)
    reached = raked.agg(F.min(F.col("tokens") / F.col("weight"))).first()[0]
    reached = wanted if reached is None else min(wanted, reached)
    if reached < wanted:
        log.warning("Token budget lowered from %.0f to %.0f, the most that meets the targets.", wanted, reached)
    rates = raked.withColumn(
        "mix_rate", F.least(F.lit(1.0), F.round(F.col("weight") * F.lit(reached) / F.col("tokens"), 9))
    )
    rates = rates.select(*(F.col(d).alias(f"mix_{d}") for d in DIMENSIONS), "mix_rate")
    rates = stage(rates, "rates")
    rates = F.broadcast(rates) if count <= FEW_CELLS else rates
    return (
        rows.drop("mix_rate", "mix_kept")
        .join(rates, [f"mix_{d}" for d in DIMENSIONS], "left")
        .withColumn("mix_rate", F.coalesce("mix_rate", F.lit(1.0)))
        .withColumn("mix_kept", unit_draw(seed) < F.col("mix_rate"))
    )
