"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked: one dimension
after the other is scaled so that its marginal meets the target shares, for a
fixed number of rounds. A cell's weight is the product of three factors; the
largest becomes probability one and every document is kept with its cell's
calibrated probability, decided by a hash of its id. The kept tokens then meet
the targets in expectation, and no document is ever taken twice.

Everything is a DataFrame expression. Cells and factors stay distributed; a
round is written to the shared folder.

Null sources or languages form a value of their own (``''``). Null and empty
texts weigh nothing and are kept like any document of their cell; a cell of
such texts alone has weight one. Rows that share an id share the decision. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.session import configure, staged

ROUNDS = 5
DIMENSIONS = ["source", "lang", "topic"]
# A cell takes about a hundred bytes: this many fit every executor; more are joined by shuffle.
BROADCAST_CELLS = 200_000
#: Language shares of the registered mixture; a language not named keeps its share of the tokens.
LANGUAGE_SHARES = {"en": 0.6, "de": 0.14, "fr": 0.14, "es": 0.12}
#: Exponent that tempers the shares of sources and topics.
TEMPER = 0.9


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("bigint")


def topic(text: Column) -> Column:
    """A coarse topic from the text's form."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("icense"), "licensed")
        .when(text.contains("@"), "contact")
        .when(text.contains("\n"), "article")
        .otherwise("note")
    )


def draw(doc_id: Column) -> Column:
    """A uniform number in [0, 1) fixed by the id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def targets(cells: DataFrame, dimension: str, shares: dict[str, float] | None, temper: float) -> DataFrame:
    """Target tokens of each value: named shares where given, else tempered shares; they sum to all tokens."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("now"))
    total = sums.agg(F.coalesce(F.sum("now"), F.lit(0.0))).first()[0]
    if shares:
        named = F.lit(None).cast("double")
        for value, share in shares.items():
            named = F.when(F.col(dimension) == value, F.lit(float(share))).otherwise(named)
        raw = F.coalesce(named, F.col("now") / F.lit(total or 1.0))
    else:
        raw = F.pow("now", F.lit(temper))
    priced = sums.select(dimension, F.when(F.col("now") > 0, raw).otherwise(0.0).alias("raw"))
    whole = priced.agg(F.coalesce(F.sum("raw"), F.lit(0.0))).first()[0]
    return priced.select(dimension, (F.col("raw") * (total / (whole or 1.0))).alias("target"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with a column ``weight``; zero targets give zero, empty marginals stay as they are."""
    spark = cells.sparkSession
    out = cells.withColumn("weight", F.lit(1.0))
    for _ in range(rounds):
        for d in DIMENSIONS:
            held = out.groupBy(d).agg(F.sum(F.col("tokens") * F.col("weight")).alias("held"))
            ratio = F.when(F.col("held") > 0, F.col("target") / F.col("held")).otherwise(F.lit(1.0))
            factor = held.join(goals[d], d).select(d, ratio.alias("ratio"))
            out = staged(spark, out.join(factor, d).select(*DIMENSIONS, "tokens", (F.col("weight") * F.col("ratio")).alias("weight")), "raked")
    return out


def _dimensions(docs: DataFrame) -> DataFrame:
    """Each row in a struct ``row``, with its dimensions."""
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        topic(F.coalesce("text", F.lit(""))).alias("topic"),
    )


def _chances(rows: DataFrame, shares: dict[str, dict[str, float]] | None, temper: float, rounds: int) -> DataFrame:
    """The cells' calibrated probabilities, marked for broadcast if there are few enough."""
    spark = rows.sparkSession
    shares = {"lang": LANGUAGE_SHARES} if shares is None else shares
    cells = staged(spark, rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = {d: staged(spark, targets(cells, d, shares.get(d), temper), "targets") for d in DIMENSIONS}
    raked = rake(cells, goals, rounds)
    top = raked.where("tokens > 0").agg(F.max("weight")).first()[0] or 1.0
    chance = F.when(F.col("tokens") > 0, F.col("weight") / F.lit(top)).otherwise(F.lit(1.0))
    chances = staged(spark, raked.select(*DIMENSIONS, F.round(chance, 9).alias("probability")), "chances")
    return F.broadcast(chances) if chances.count() <= BROADCAST_CELLS else chances


def mix(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, source, lang, topic, n_tokens, probability, selected)`` for every row of ``docs``."""
    spark = configure(docs.sparkSession)
    rows = _dimensions(docs).select(
        F.col("row.doc_id").alias("doc_id"), *DIMENSIONS, n_tokens(F.col("row.text")).alias("n_tokens")
    )
    rows = staged(spark, rows, "weights")
    return rows.join(_chances(rows, shares, temper, rounds), DIMENSIONS).select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability", (draw(F.col("doc_id")) < F.col("probability")).alias("selected")
    )


def sample(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps."""
    configure(docs.sparkSession)
    rows = _dimensions(docs)
    weighed = rows.select(*DIMENSIONS, n_tokens(F.col("row.text")).alias("n_tokens"))
    kept = rows.join(_chances(weighed, shares, temper, rounds), DIMENSIONS)
    return kept.where(draw(F.col("row.doc_id")) < F.col("probability")).select("row.*")
