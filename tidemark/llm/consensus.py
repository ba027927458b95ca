"""Consensus of votes by a mean-field variational confusion model, computed with group-bys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import HOT_FLOOR, HOT_SHARE, attach_group
from tidemark.session import checkpointed, shuffle_width

#: Dirichlet priors: of the two classes, and of a voter's row (said right, said wrong).
CLASS_PRIOR = (1.0, 1.0)
RIGHT_PRIOR, WRONG_PRIOR = 4.0, 1.0
#: Expected log odds of a vote under the prior rows: digamma(RIGHT_PRIOR) - digamma(WRONG_PRIOR), both whole numbers.
UNKNOWN_GAIN = sum(1 / k for k in range(int(WRONG_PRIOR), int(RIGHT_PRIOR)))
#: Rounds end when no voter's dependence on the label moves by more than this, and after ROUNDS in any case.
SETTLED, ROUNDS = 0.005, 40
#: Up to so many voters are broadcast, at about 60 bytes each.
BROADCAST_VOTERS = 500_000
MIN_VOTES = 20
#: A voter's votes depend on the label if the reliability interval of P(yes | true) - P(yes | false) lies above ABOVE, or
#: its middle above CLEAR, which few votes may spread widely. A voter's own votes move their items' labels, so the
#: difference of a voter who ignores the label is a little above 0.
ABOVE, CLEAR = 0.12, 0.35


def digamma(x: Column) -> Column:
    """The digamma function for x > 0: recurrence up to 6, then the asymptotic series."""
    total, y = F.lit(0.0), x
    for _ in range(6):
        total = total - F.lit(1.0) / y
        y = y + F.lit(1.0)
    i = F.lit(1.0) / (y * y)
    return total + F.log(y) - F.lit(0.5) / y - i * (F.lit(1 / 12) - i * (F.lit(1 / 120) - i * (F.lit(1 / 252) - i * F.lit(1 / 240))))


def psi(x: float) -> float:
    """The digamma function of one number on the driver."""
    total = 0.0
    while x < 6:
        total -= 1 / x
        x += 1
    i = 1 / (x * x)
    return total + math.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i / 240)))


def last_votes(votes: DataFrame) -> DataFrame:
    """(item, voter, vote): of the votes a voter gave on an item the last one; an unknown voter's votes all count."""
    known = (
        votes.filter("vote is not null and extraction_id is not null and voter_hash is not null")
        .groupBy(F.col("extraction_id").alias("item"), F.col("voter_hash").alias("voter"))
        .agg(F.max(F.struct(F.coalesce("created_at", F.lit("0001-01-01").cast("timestamp")).alias("t"), "id", "vote")).alias("last"))
        .select("item", "voter", F.col("last.vote").cast("double").alias("vote"))
    )
    # a vote of an unknown voter that was sent twice has the same id
    unknown = votes.filter("vote is not null and extraction_id is not null and voter_hash is null").select(
        F.col("extraction_id").alias("item"), F.lit(None).cast("string").alias("voter"), F.col("vote").cast("double").alias("vote"), "id"
    )
    return known.unionByName(unknown.distinct().drop("id"))


def place_votes(votes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(votes with ``part``, the items that are split or None), written once in the layout that every round reuses.

    Votes are placed and sorted by (item, part), so a round neither shuffles nor sorts them. Items with more than a
    thousandth of all votes are spread over parts; there are at most a thousand, whatever the data.
    """
    last = checkpointed(last_votes(votes))
    width = shuffle_width(votes.sparkSession)
    limit = max(HOT_FLOOR, int(last.count() * HOT_SHARE))
    hot = checkpointed(last.groupBy("item").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("item", F.lit(True).alias("split")))
    split = hot if hot.limit(1).count() else None
    spread = last.withColumn("split", F.lit(None).cast("boolean")) if split is None else last.join(F.broadcast(split), "item", "left")
    parted = spread.select("item", "voter", "vote", F.when(F.col("split"), F.pmod(F.xxhash64("voter", F.monotonically_increasing_id()), F.lit(width))).otherwise(0).cast("int").alias("part"))
    return checkpointed(parted.repartition(width, "item", "part").sortWithinPartitions("item", "part")), split


def _posterior(placed: DataFrame, split: DataFrame | None, voters: DataFrame | None, n_voters: int, prior: float) -> DataFrame:
    """(item, part, q, n_votes, n_yes) with q = P(label is yes), from every vote's expected log likelihoods under its
    voter's row; ``prior`` are the expected log odds of the classes.

    Nothing can be learned about an unknown voter: their votes have the prior's expectations in every round.
    """
    said = F.col("vote") * 2 - 1
    if voters is None:
        scored = placed.withColumn("gain", said)
    else:
        rated = _rated(placed, voters, n_voters)
        yes, no = F.col("lt1") - F.col("lf1"), F.col("lt0") - F.col("lf0")
        scored = rated.withColumn("gain", F.coalesce(F.when(F.col("vote") > 0, yes).otherwise(no), said * UNKNOWN_GAIN))
    totals = [F.sum("gain").alias("gain"), F.count("*").alias("n_votes"), F.sum("vote").alias("n_yes")]
    items = scored.groupBy("item", "part").agg(*totals)
    if split is not None:
        names = ("gain", "n_votes", "n_yes")
        whole = items.join(F.broadcast(split), "item").groupBy("item").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
        items = items.join(F.broadcast(whole), "item", "left").select("item", "part", *[F.coalesce(f"all_{c}", c).alias(c) for c in names])
    logit = F.greatest(F.least(F.lit(prior) + F.col("gain"), F.lit(35.0)), F.lit(-35.0))
    return items.select("item", "part", (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).alias("q"), "n_votes", "n_yes")


def _rated(placed: DataFrame, voters: DataFrame, n_voters: int) -> DataFrame:
    """Votes with their voter's expectations: BROADCAST_VOTERS voters at most are broadcast, more meet in a join in which
    only those with many votes are."""
    rows = voters.filter("voter is not null").select("voter", "n", "lt1", "lt0", "lf1", "lf0")
    if n_voters <= BROADCAST_VOTERS:
        return placed.join(F.broadcast(rows.drop("n")), "voter", "left")
    return attach_group(placed, rows, ["voter"], "n", "left")


def _voter_rows(placed: DataFrame, items: DataFrame, before: DataFrame | None) -> DataFrame:
    """Dirichlet posteriors of each voter's two rows from the items' posteriors; partial sums combine before the shuffle.

    ``yes_items`` and ``no_items`` add up to the expected items of either class over all voters, unknown ones (a row
    without a voter) included: each vote stands for its share of its item. ``moved`` is how far the voter's dependence
    on the label is from where it was.
    """
    weighed = placed.join(items.select("item", "part", "q", "n_votes"), ["item", "part"])
    q, vote = F.col("q"), F.col("vote")
    counts = weighed.groupBy("voter").agg(
        F.count("*").alias("n"), F.sum(q * vote).alias("t1"), F.sum(q * (1 - vote)).alias("t0"), F.sum((1 - q) * vote).alias("f1"), F.sum((1 - q) * (1 - vote)).alias("f0"),
        F.sum(q / F.col("n_votes")).alias("yes_items"), F.sum((1 - q) / F.col("n_votes")).alias("no_items"),
    )
    a1, a0 = F.col("t1") + RIGHT_PRIOR, F.col("t0") + WRONG_PRIOR
    b1, b0 = F.col("f1") + WRONG_PRIOR, F.col("f0") + RIGHT_PRIOR
    rows = counts.select(
        "*", (a1 / (a1 + a0) - b1 / (b1 + b0)).alias("gap"),
        (digamma(a1) - digamma(a1 + a0)).alias("lt1"), (digamma(a0) - digamma(a1 + a0)).alias("lt0"),
        (digamma(b1) - digamma(b1 + b0)).alias("lf1"), (digamma(b0) - digamma(b1 + b0)).alias("lf0"),
    )
    if before is None:
        return rows.withColumn("moved", F.lit(1.0))
    old = before.select(F.col("voter").alias("old"), F.col("gap").alias("old_gap"))
    return rows.join(old, F.col("voter").eqNullSafe(F.col("old")), "left").withColumn("moved", F.abs(F.col("gap") - F.col("old_gap"))).drop("old", "old_gap")


def fit_votes(votes: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(items with q, voters with their posterior rows) by coordinate ascent, until no voter's dependence on the label
    moves by more than SETTLED, or ``rounds`` are done.

    votes: id, extraction_id, vote, voter_hash, created_at. A round reads the placed votes and writes the voters' rows,
    one per voter. The class row is variational too: with the expected items of either class it has a Dirichlet
    posterior, of which digamma differences are the expected log odds. The first posterior is the plain majority; votes
    of unknown voters weigh as the prior says in later rounds. They have no row.
    """
    placed, split = place_votes(votes)
    voters, prior, n_voters = None, 0.0, 0
    for _ in range(rounds):
        voters = checkpointed(_voter_rows(placed, _posterior(placed, split, voters, n_voters, prior), voters))
        yes, no, moved, n_voters = voters.agg(F.sum("yes_items"), F.sum("no_items"), F.max("moved"), F.count("*")).first()
        prior = float(psi(CLASS_PRIOR[0] + (yes or 0.0)) - psi(CLASS_PRIOR[1] + (no or 0.0)))
        if (moved or 0.0) < SETTLED:
            break
    items = _posterior(placed, split, voters, n_voters, prior)
    return items if split is None else items.dropDuplicates(["item"]), voters.filter("voter is not null")


def item_consensus(votes: DataFrame) -> DataFrame:
    """(extraction_id, label, probability, n_votes, n_yes, agreement): one row per item with a vote.

    ``label`` is null where the model is undecided; a vote of an unknown voter weighs as the prior says. ``agreement`` is
    the item's share of agreeing pairs of votes, null for a single vote. A null vote or item doesn't count; of repeated or changed votes the last does.
    """
    items, _ = fit_votes(votes)
    n, y = F.col("n_votes"), F.col("n_yes")
    pairs = (y * (y - 1) + (n - y) * (n - y - 1)) / (n * (n - 1))
    return items.select(
        F.col("item").alias("extraction_id"), F.when(F.abs(F.col("q") - 0.5) > 1e-9, F.col("q") > 0.5).alias("label"),
        F.col("q").alias("probability"), n.alias("n_votes"), y.cast("bigint").alias("n_yes"), F.when(n > 1, pairs).alias("agreement"),
    )


def krippendorff(votes: DataFrame) -> DataFrame:
    """One row (n_items, n_votes, alpha): Krippendorff's nominal alpha over all items with two votes or more."""
    per_item = last_votes(votes).groupBy("item").agg(F.count("*").alias("n"), F.sum("vote").alias("y")).filter("n > 1")
    observed = F.sum(2 * F.col("y") * (F.col("n") - F.col("y")) / (F.col("n") - 1))
    n, y = F.sum("n"), F.sum("y")
    expected = 2 * y * (n - y) / (n - 1)
    return per_item.agg(F.count("*").alias("n_items"), n.alias("n_votes"), F.when(expected > 0, 1 - observed / expected).alias("alpha"))


def voter_reliability(votes: DataFrame) -> DataFrame:
    """(voter_hash, n_votes, says_yes_if_true, says_yes_if_false, dependence, low, high): one row per known voter.

    ``dependence`` is the difference of the two posterior means: near 0 if the votes don't depend on the label, below
    0 if they go against it. ``low`` and ``high`` bound it at two posterior standard deviations.
    """
    _, voters = fit_votes(votes)
    t, f = F.col("t1") + F.col("t0") + 2, F.col("f1") + F.col("f0") + 2  # a flat prior: the model's own would hide who is unreliable
    yes_true, yes_false = (F.col("t1") + 1) / t, (F.col("f1") + 1) / f
    spread = F.sqrt(yes_true * (1 - yes_true) / (t + 1) + yes_false * (1 - yes_false) / (f + 1))
    gap = yes_true - yes_false
    return voters.select(
        F.col("voter").alias("voter_hash"), F.col("n").alias("n_votes"), yes_true.alias("says_yes_if_true"), yes_false.alias("says_yes_if_false"),
        gap.alias("dependence"), (gap - 2 * spread).alias("low"), (gap + 2 * spread).alias("high"),
    )


def unreliable_voters(votes: DataFrame) -> DataFrame:
    """(voter_hash) of voters with MIN_VOTES votes or more whose votes don't depend on the label, or go against it, by
    their reliability interval."""
    ignores = (F.col("low") < ABOVE) & (F.col("dependence") < CLEAR)
    return voter_reliability(votes).filter((F.col("n_votes") >= MIN_VOTES) & ignores).select("voter_hash")
