"""Many consumers' subject patterns at once, as one hash join.

A pattern has a *shape*: how many tokens, which of them are ``*``, and whether ``>``
ends it. Within a shape a pattern is one key: its tokens with the wild ones masked. So
a subject looks, for each shape of a fitting length, for its own tokens under the same
mask: a walk down the trie of all patterns, level by level, written as equi-joins.
Patterns of one shape cost one key, however many there are, and different subjects
are matched once each, not per event.

Cases as for a single pattern: ``*`` is one token that is not empty, a trailing ``>``
one or more, ``>`` alone any subject but the empty one; a null pattern or subject matches
nothing; a subscriber gets one copy of an event per pattern of theirs that matches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.operators.ordered import is_small, lookup_join
from changefeed.session import settle


def _measured(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df) else df


def matching_patterns(subjects: DataFrame, patterns: DataFrame) -> DataFrame:
    """(subject, pattern): every pattern that matches each different subject."""
    tokens = F.split("pattern", r"\.")
    ends = F.element_at(tokens, -1) == ">"
    fixed = F.when(ends, F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))).otherwise(tokens)
    wild = F.transform(fixed, lambda t: t == "*")
    known = settle(
        patterns.filter("pattern is not null").select("pattern").distinct().select(
            "pattern", ends.alias("ends"), wild.alias("wild"), F.array_join(fixed, ".").alias("key")
        )
    )
    shapes = known.select("ends", "wild").distinct().withColumn("n", F.size("wild"))
    parts = F.split("subject", r"\.")
    size = F.size(parts)
    # a subject of n tokens fits shapes of n tokens, and shorter ones that end in ">"
    rest = F.when(F.element_at(parts, -1) == "", size - 2).otherwise(size - 1)
    lengths = F.concat(
        F.array(F.struct(F.lit(False).alias("ends"), size.alias("n"))),
        F.when(
            rest >= 0,
            F.transform(F.sequence(F.lit(0), rest), lambda n: F.struct(F.lit(True).alias("ends"), n.alias("n"))),
        ).otherwise(F.array()),
    )
    asked = subjects.filter("subject is not null").select("subject").distinct().select(
        "subject", parts.alias("parts"), F.explode(lengths).alias("l")
    )
    masked = F.transform(
        F.slice("parts", 1, F.greatest(F.col("n"), F.lit(0))),
        lambda t, i: F.when(F.get("wild", i), F.when(t != "", "*")).otherwise(t),
    )
    tried = asked.select("subject", "parts", "l.ends", "l.n").join(_measured(shapes), ["ends", "n"]).select(
        "subject", "ends", "wild", masked.alias("m")
    )
    tried = tried.filter(~F.exists("m", lambda t: t.isNull()) & ~(F.col("ends") & (F.size("m") == 0) & (F.col("subject") == "")))
    keyed = tried.select("subject", "ends", "wild", F.array_join("m", ".").alias("key"))
    return keyed.join(_measured(known), ["ends", "wild", "key"]).select("subject", "pattern")


def subscribe(df: DataFrame, subscriptions: DataFrame, address: str = "subject") -> DataFrame:
    """One copy of each row per (subscriber, pattern) whose pattern matches its subject."""
    found = matching_patterns(df.select(F.col(address).alias("subject")), subscriptions)
    wanted = subscriptions.select("subscriber", "pattern").distinct()
    routes = settle(found.join(_measured(wanted), "pattern").withColumnRenamed("subject", address))
    return lookup_join(df, routes, [address]).select(*df.columns, "subscriber", "pattern")
