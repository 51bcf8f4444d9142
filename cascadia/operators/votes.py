"""Votes on runs: who holds which side, which vote decides, which come too late."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascadia.functions.lists import inline_lists
from cascadia.functions.ordered import previous_value, running_sums

_LISTS = ["approval_voters", "rejection_voters"]
_LIMITS = ["min_approval_count", "min_rejection_count"]
_ORDER = ["ts", "vote_id"]


def vote_sides(votes: DataFrame) -> DataFrame:
    """``execution_id, voter, action``: the side each voter's last vote put them on."""
    return votes.groupBy("execution_id", "voter").agg(
        F.max_by("action", F.struct(*_ORDER)).alias("action")
    )


def voter_union(runs: DataFrame, votes: DataFrame, limit: int | None = None) -> DataFrame:
    """Runs with both voter lists after the votes, sorted and distinct on the side that grew.

    A voter joins the list of their last action and leaves the other. The voter need not
    be among the run's ``voters``. Lists are whole whatever their size; with a ``limit``, more
    voters of one run on one side give a NULL list, and :func:`vote_sides` holds them in long form.
    """
    sides = vote_sides(votes)
    result = runs
    for action, column in (("approve", _LISTS[0]), ("reject", _LISTS[1])):
        lists = inline_lists(
            sides.filter(F.col("action") == action),
            ["execution_id"],
            "voter",
            f"_{action}",
            limit=limit,
        ).withColumnRenamed("n", f"_n_{action}")
        result = result.join(lists, "execution_id", "left")
    none = F.array().cast("array<string>")

    def side(column: str, joined: str, left: str):
        gone = F.when(F.col(f"_n_{left}").isNull(), none).otherwise(F.col(f"_{left}"))
        kept = F.array_except(F.col(column), gone)
        return (
            F.when(
                F.col(f"_n_{joined}").isNotNull(),
                F.array_sort(
                    F.array_union(
                        F.coalesce(F.array_except(F.coalesce(F.col(column), none), gone), none),
                        F.col(f"_{joined}"),
                    )
                ),
            )
            .when(F.col(f"_n_{left}").isNotNull(), kept)
            .otherwise(F.col(column))
        )

    approvals = side(_LISTS[0], "approve", "reject")
    rejections = side(_LISTS[1], "reject", "approve")
    return result.withColumns({_LISTS[0]: approvals, _LISTS[1]: rejections}).select(runs.columns)


class Tally(NamedTuple):
    """Where counting starts, in long form, so that a run may have any number of voters."""

    runs: DataFrame  # execution_id, both minima, n_approve, n_reject
    members: DataFrame  # execution_id, voter, approve, reject: the lists a voter is on


def tally_of(runs: DataFrame) -> Tally:
    """The starting point that a run table's voter lists give."""
    starts = runs.select(
        "execution_id",
        *_LIMITS,
        *[
            F.size(F.array_distinct(F.col(c))).cast("bigint").alias(n)
            for c, n in zip(_LISTS, ("n_approve", "n_reject"), strict=True)
        ],
    )

    def tagged(column: str, side: str):
        return F.transform(
            F.col(column), lambda v: F.struct(v.alias("voter"), F.lit(side).alias("side"))
        )

    # Lists of NULL are left out here; their run has a NULL count and is never decided.
    on = runs.select(
        "execution_id",
        F.explode(F.flatten(F.array_compact(F.array(tagged(_LISTS[0], "approve"), tagged(_LISTS[1], "reject"))))).alias("m"),
    )
    members = on.groupBy("execution_id", F.col("m.voter").alias("voter")).agg(
        F.bool_or(F.col("m.side") == "approve").alias("approve"),
        F.bool_or(F.col("m.side") == "reject").alias("reject"),
    )
    return Tally(starts, members)


def members_after(members: DataFrame, votes: DataFrame) -> DataFrame:
    """The lists' members after the votes: each voter is on the side of their last vote."""
    sides = vote_sides(votes).select(
        "execution_id",
        "voter",
        (F.col("action") == "approve").alias("approve"),
        (F.col("action") == "reject").alias("reject"),
    )
    kept = members.join(sides, ["execution_id", "voter"], "left_anti")
    return kept.select(sides.columns).unionByName(sides)


def _after_each(start: Tally, votes: DataFrame) -> DataFrame:
    """Votes with the sizes of both sides right after each, in range slices whatever their number."""
    sided = previous_value(
        votes.select("execution_id", "voter", "action", *_ORDER),
        ["execution_id", "voter"],
        _ORDER,
        "action",
        "_before",
        sliced=True,
    )
    moved = sided.join(start.members, ["execution_id", "voter"], "left")

    def step(action: str):
        had = F.coalesce(F.col("_before") == action, F.col(action), F.lit(False))
        return (
            F.when((F.col("action") == action) & ~had, 1)
            .when((F.col("action") != action) & had, -1)
            .otherwise(0)
        )

    stepped = moved.select(
        "execution_id", "action", *_ORDER, step("approve").alias("_a"), step("reject").alias("_r")
    )
    summed = running_sums(
        stepped,
        ["execution_id"],
        _ORDER,
        {"_a": "_approve", "_r": "_reject"},
        sliced=True,
    )
    return summed.join(start.runs, "execution_id").select(
        "execution_id",
        "action",
        *_ORDER,
        *_LIMITS,
        (F.col("n_approve") + F.col("_approve")).alias("n_approve"),
        (F.col("n_reject") + F.col("_reject")).alias("n_reject"),
    )


def decisions(start: Tally, votes: DataFrame) -> DataFrame:
    """As :func:`vote_decision`, from a long-form starting point, with the vote's ``ts``."""
    met = (F.col("n_approve") == F.col("min_approval_count")) | (
        F.col("n_reject") == F.col("min_rejection_count")
    )
    return (
        _after_each(start, votes)
        .filter(met)
        .groupBy("execution_id")
        .agg(
            F.min_by(
                F.struct("vote_id", "action", "n_approve", "n_reject", "ts"), F.struct(*_ORDER)
            ).alias("_d")
        )
        .select("execution_id", "_d.*")
    )


def vote_decision(runs: DataFrame, votes: DataFrame) -> DataFrame:
    """The deciding vote per run: the first after which a side has exactly its minimum.

    The decision is that vote's action, whichever side met its minimum. A voter's last
    vote replaces the earlier one; the run's voter lists are where counting starts.
    """
    return decisions(tally_of(runs), votes).drop("ts")


def in_time(decided: DataFrame, votes: DataFrame) -> DataFrame:
    """``vote_id, accepted`` from the result of :func:`decisions`."""
    at = decided.select("execution_id", F.struct(*_ORDER).alias("_at"))
    return votes.join(at, "execution_id", "left").select(
        "vote_id",
        (F.col("_at").isNull() | (F.struct(*_ORDER) <= F.col("_at"))).alias("accepted"),
    )


def late_votes(runs: DataFrame, votes: DataFrame) -> DataFrame:
    """``vote_id, accepted``: votes up to the deciding one are accepted, later ones are not.

    Nor are votes on a run that ``runs`` doesn't have.
    """
    decided = in_time(decisions(tally_of(runs), votes), votes)
    known = votes.join(runs.select("execution_id"), "execution_id", "left_semi").select(
        "vote_id", F.lit(True).alias("_known")
    )
    return decided.join(known, "vote_id", "left").select(
        "vote_id", (F.col("accepted") & F.coalesce("_known", F.lit(False))).alias("accepted")
    )
