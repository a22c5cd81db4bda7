"""Best representative of each duplicate group (problem 6).

Iterative truth discovery over (group, field, source, value) claims: the
reliability of a source is its share of votes that agree with the value chosen
so far, and a value's support is the weighted sum of its voters.  The two are
alternated until the reliabilities settle.

Where a declared order of trust ranks a source that states the field, that order
chooses: declared rank, then the claim's own confidence, its recency and its id.
(Support contradicts it in places, so votes alone could not give the survivors
that the order asks for.)  In the records built by :func:`surviving_records`
discovery chooses for the fields that only unranked sources state, and every
value carries whether discovery supports it.

Votes are aggregated per (group, field, value, source) before anything else is
shuffled, so a group with very many claims costs what its distinct claims cost,
and no group is ever collected into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.operators.units import stated_values
from oreweave.session import cut_lineage

FIELDS = ("tonnage", "grade", "latitude", "longitude")
#: Rank of sources without a declared one.
UNRANKED = 2**31 - 1
#: Sources up to which their weights travel in the plan; more are joined.
MOST_IN_PLAN = 1000


def field_claims(statements: DataFrame, sources: DataFrame) -> DataFrame:
    """(record_id, field, statement_id, value): every value a statement gives a field.

    Tonnage and grade in common units, null where no unit is known although a
    number is stated; coordinates not null (a NaN is null).
    """
    measured = stated_values(statements, sources).select("record_id", "field", "statement_id", "value")
    placed = [
        statements.where(F.col(c).isNotNull() & ~F.isnan(c) & F.col("record_id").isNotNull()).select(
            F.trim("record_id").alias("record_id"), F.lit(c).alias("field"), "statement_id", F.col(c).alias("value")
        )
        for c in ("latitude", "longitude")
    ]
    return reduce(DataFrame.unionByName, placed, measured)


def claim_order(statements: DataFrame, sources: DataFrame) -> DataFrame:
    """(statement_id, source_key, order): the order of trust of each statement, least is best."""
    ranks = sources.select(F.lower(F.trim("source")).alias("source_key"), "trust_rank").groupBy("source_key").agg(
        F.min("trust_rank").alias("trust_rank")
    )
    confidence = F.col("confidence_score")
    return (
        statements.where(F.col("record_id").isNotNull())
        .select(
            "statement_id",
            F.lower(F.trim("source")).alias("source_key"),
            F.when(confidence.between(0, 1), -confidence).otherwise(F.lit(1.0)).alias("doubt"),
            F.coalesce(-F.unix_micros("reported_at"), F.lit(2**62)).alias("age"),
        )
        .join(ranks, "source_key", "left")
        .select(
            "statement_id",
            "source_key",
            F.struct(
                F.coalesce("trust_rank", F.lit(UNRANKED)).alias("rank"), "doubt", "age", F.col("statement_id").alias("id")
            ).alias("order"),
        )
    )


def surviving_statements(statements: DataFrame, sources: DataFrame, least: int = 2) -> DataFrame:
    """(record_id, field, statement_id): the statement whose value survives, per field.

    Groups with fewer than ``least`` statements and fields that no statement
    gives are left out.  Ties in everything else go to the smaller id.  The
    choice is a min-aggregate that combines on the map side.
    """
    ordered = claim_order(statements, sources)
    sizes = statements.where(F.col("record_id").isNotNull()).groupBy(F.trim("record_id").alias("record_id")).count()
    chosen = (
        field_claims(statements, sources)
        .join(ordered, "statement_id")
        .groupBy("record_id", "field")
        .agg(F.min("order").alias("best"))
    )
    return chosen.join(sizes.where(F.col("count") >= least), "record_id", "left_semi").select(
        "record_id", "field", F.col("best.id").alias("statement_id")
    )


def value_key(value: Column, digits: int = 2) -> Column:
    """The value in so many significant digits."""
    magnitude = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - (digits - 1))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value / magnitude) * magnitude)


def discover_truth(
    claims: DataFrame,
    rounds: int = 20,
    settle: float = 1e-4,
    digits: int = 2,
    prior: float = 0.8,
    weight: float = 10.0,
) -> tuple[DataFrame, DataFrame]:
    """Truth discovery over claims (record_id, field, source_key, value).

    Returns (values, sources): the best-supported value per (record_id, field)
    as (record_id, field, value_key, value, support, share, n_claims), and
    (source_key, reliability, n_votes).  Values that agree in ``digits``
    significant digits vote together.  Reliabilities start at ``prior`` and are
    smoothed by ``weight`` prior votes; a vote weighs the log odds of its source.
    Null sources vote as one source '', null values not at all.  Ties go to the
    smaller value.  Stops when no reliability moves by more than ``settle``.

    The claims are reduced once to a row per group, field and value with its
    voters and written to the checkpoint folder.  A round reads them with the
    weights of the sources in the plan (joined, where there are more than
    MOST_IN_PLAN sources), and shuffles one row per group and field that
    combines on the map side.
    """
    votes = (
        claims.where(F.col("value").isNotNull() & F.col("record_id").isNotNull())
        .groupBy("record_id", "field", value_key(F.col("value"), digits).alias("value_key"), F.coalesce("source_key", F.lit("")).alias("source_key"))
        .agg(F.count("*").alias("n"), F.min("value").alias("value"))
        .groupBy("record_id", "field", "value_key")
        .agg(F.collect_list(F.struct("source_key", "n")).alias("voters"), F.sum("n").alias("n"), F.min("value").alias("value"))
    )
    votes = cut_lineage(votes)
    voters = lambda df, c: df.select(F.explode(c).alias("v")).groupBy("v.source_key").agg(F.sum("v.n").alias("n"))
    trust = cut_lineage(voters(votes, "voters").select("source_key", F.lit(prior).alias("reliability"), F.col("n").alias("n_votes")))
    in_plan = trust.limit(MOST_IN_PLAN + 1).count() <= MOST_IN_PLAN
    odds = F.log(F.col("reliability") / (1 - F.col("reliability"))) + F.lit(5.0)
    chosen = None
    for _ in range(rounds):
        if in_plan:
            known = [x for r in trust.select("source_key", odds.alias("w")).collect() for x in (F.lit(r["source_key"]), F.lit(r["w"]))]
            weights = F.create_map(*known) if known else F.create_map().cast("map<string,double>")
            weighted = votes.withColumn("support", F.aggregate("voters", F.lit(0.0), lambda acc, v: acc + weights[v["source_key"]]))
        else:
            each = votes.select("record_id", "field", "value_key", F.explode("voters").alias("v")).select("record_id", "field", "value_key", "v.source_key")
            support = each.join(trust.select("source_key", odds.alias("w")), "source_key").groupBy("record_id", "field", "value_key").agg(F.sum("w").alias("support"))
            weighted = votes.join(support, ["record_id", "field", "value_key"])
        chosen = weighted.groupBy("record_id", "field").agg(
            F.max_by(F.struct("value_key", "value", "support", "voters"), F.struct(F.col("support"), -F.col("value_key"))).alias("best"),
            F.sum("support").alias("total"),
            F.sum("n").alias("n_claims"),
        )
        won = voters(chosen, "best.voters").withColumnRenamed("n", "won")
        update = cut_lineage(
            trust.select("source_key", F.col("reliability").alias("was"), "n_votes")
            .join(won, "source_key", "left")
            .select(
                "source_key", ((F.coalesce("won", F.lit(0)) + prior * weight) / (F.col("n_votes") + weight)).alias("reliability"), "n_votes", "was"
            )
        )
        moved = update.agg(F.max(F.abs(F.col("reliability") - F.col("was"))).alias("moved")).first()["moved"]
        trust = update.drop("was")
        if moved is None or moved <= settle:
            break
    values = chosen.select(
        "record_id",
        "field",
        F.col("best.value_key").alias("value_key"),
        F.col("best.value").alias("value"),
        F.col("best.support").alias("support"),
        (F.col("best.support") / F.col("total")).alias("share"),
        "n_claims",
    )
    return values, trust


def surviving_records(statements: DataFrame, sources: DataFrame, least: int = 2) -> DataFrame:
    """One record per deposit with at least ``least`` statements, built field by field.

    (record_id, tonnage, grade, latitude, longitude, <field>_statement,
    <field>_agreed): values in common units of the statements that survive, and
    whether truth discovery supports them most (null where the field is not
    stated).  A field that only unranked sources state takes the first, in the
    order of trust, of the statements that discovery supports.
    """
    claims = field_claims(statements, sources).join(claim_order(statements, sources), "statement_id")
    found, _ = discover_truth(claims.select("record_id", "field", "source_key", "value"))
    supported = found.select("record_id", "field", F.col("value_key").alias("won"))
    agrees = F.coalesce(value_key(F.col("value")) == F.col("won"), F.lit(False))
    claim = F.struct("order", "value", agrees.alias("agrees"))
    chosen = (
        claims.join(supported, ["record_id", "field"], "left")
        .groupBy("record_id", "field")
        .agg(F.min(claim).alias("declared"), F.min(F.when(agrees, claim)).alias("backed"))
        .withColumn("pick", F.when(F.col("declared.order.rank") == UNRANKED, F.coalesce("backed", "declared")).otherwise(F.col("declared")))
    )
    sizes = statements.where(F.col("record_id").isNotNull()).groupBy(F.trim("record_id").alias("record_id")).count()
    of = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    rows = chosen.groupBy("record_id").agg(
        *[of(f, "pick.value").alias(f) for f in FIELDS],
        *[of(f, "pick.order.id").alias(f"{f}_statement") for f in FIELDS],
        *[of(f, "pick.agrees").alias(f"{f}_agreed") for f in FIELDS],
    )
    return rows.join(sizes.where(F.col("count") >= least), "record_id", "left_semi")
