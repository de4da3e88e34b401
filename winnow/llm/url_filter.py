"""URL filters: a temporal join of captures with dated lists.

List entries are dated: a host is put on a list one day and taken off another.  The entries of a host on a list become
validity intervals, and every capture is evaluated against the intervals that hold at its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADD, REMOVE = "add", "remove"


def host(url: str) -> Column:
    """The host of an absolute URL in lower case, without user and port; null where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    name = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":[0-9]*$", ""))
    return F.nullif(F.regexp_replace(name, r"\.$", ""), F.lit(""))


def domains(name: str) -> Column:
    """A host and the domains above it, down to two labels: a.b.example.com, b.example.com, example.com."""
    labels = F.split(name, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, since, until): from each addition to the next removal; ``until`` is exclusive, null while it holds.

    ``entries`` has list, domain, action ('add' or 'remove') and dated.  Of several actions of one host and list at one
    time, the removal stands.  Repeated additions prolong nothing, removals without an addition say nothing; rows with a
    null in any of the four are ignored.
    """
    known = entries.where("list IS NOT NULL AND domain IS NOT NULL AND action IN ('add', 'remove') AND dated IS NOT NULL")
    days = known.groupBy("list", F.lower("domain").alias("domain"), "dated").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "domain").orderBy("dated")
    turns = days.withColumn("before", F.lag("action").over(order)).where("NOT action <=> before")
    turns = turns.withColumn("until", F.lead("dated").over(order)).where(F.col("action") == ADD)
    return turns.select("list", "domain", F.col("dated").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """All rows and columns of ``captures`` with ``host`` and ``lists``: the names, sorted, of the lists that the host or a
    domain above it is on at the fetch time.

    An interval holds from ``since`` on and before ``until``.  Captures without a host or a fetch time are on no list.  Nothing
    is read of a URL but the host.  Columns named ``host`` or ``lists`` are replaced.

    Captures are first reduced to the distinct pairs of host and time, so a hot host meets each interval once a time and
    not once a capture; the result goes back to the captures by that pair.
    """
    named = captures.drop("host", "lists").withColumn("host", host(url))
    times = named.where(F.col("host").isNotNull() & F.col(fetched).isNotNull()).select("host", F.col(fetched).alias("at")).distinct()
    looked_up = times.select("host", "at", F.explode(domains("host")).alias("domain"))
    held = intervals(entries)
    active = looked_up.join(held, "domain").where("since <= at AND (until IS NULL OR at < until)")
    lists = active.groupBy("host", "at").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    lists = lists.withColumnRenamed("host", "of_host")
    joined = named.join(lists, (F.col("host") == F.col("of_host")) & (F.col(fetched) == F.col("at")), "left")
    none = F.array().cast("array<string>")
    return joined.drop("of_host", "at").withColumn("lists", F.coalesce("lists", none))
