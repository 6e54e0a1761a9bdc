"""Links between the items of index lists, derived from a few leaders' answers.

Pairing all items of a list costs the square of its length, and a group of near
copies fills many lists. So each list is first joined to its leader only; items
that link to a leader form classes. Items of one class are connected already, and
what is left are items of different classes that share a list. There are two ways
to settle those. ``across_leaders`` uses that two items can link only if their
leaders are near enough (triangle inequality): the answers of the leaders rule
out most class pairs, and single items are compared for the others.
The shingle join compares the items of a list block against block inside tasks,
and only pairs that a sketch allows become rows.

The classes that come out are exactly those of comparing every two items that
share a list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .session import written

#: Pairs (a, b) to their measures; pairs that can neither link nor, with a column ``radius``, come within that of it may be left out.
Measure = Callable[[DataFrame], DataFrame]
#: (lists, first classes, links to leaders) -> links (a, b) between classes.
Across = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


def grouped_lists(lists: DataFrame) -> DataFrame:
    """(key, item, kind, leader) of the lists with at least two items.

    ``lists`` has (key long, item long, kind int): two items are compared if
    they share a key and not both have kind 1. The leader of a list is its
    smallest item of kind 0; lists without one are dropped. The window runs
    along the sorted rows of a key and holds none of them back, so a list may be
    longer than memory.
    """
    run = Window.partitionBy("key").orderBy("kind", "item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    led = lists.select("key", "item", "kind", F.first("item").over(run).alias("leader"), F.first("kind").over(run).alias("k"))
    return led.filter("k = 0 and item != leader").drop("k")


def link_classes(lists: DataFrame, measure: Measure, across: Across, name: str) -> DataFrame:
    """(node, component) of every item that links to another one; the component is its smallest item.

    ``measure`` takes pairs (a, b) and returns (a, b, distance double, linked
    boolean, span double): the distance of a metric, whether the two link, and
    the largest distance at which items of these sizes link.
    """
    near = written(grouped_lists(lists), f"{name}-lists")
    pairs = near.select(F.col("leader").alias("a"), F.col("item").alias("b")).distinct()
    stars = written(measure(pairs).filter("linked").select("a", "b", "distance"), f"{name}-stars")
    first = written(components(stars.select("a", "b")), f"{name}-classes")
    more = written(across(near, first, stars), f"{name}-links")
    # Classes are joined through their smallest items: one short edge for each item.
    own = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(own.unionByName(more))


def mixed_lists(near: DataFrame, first: DataFrame, name: str) -> DataFrame:
    """(key, item, kind, class) of the lists whose items are of several classes."""
    rows = near.select("key", "item", "kind").unionByName(
        near.select("key", F.col("leader").alias("item"), F.lit(0).alias("kind")).distinct()
    )
    rows = rows.join(first.withColumnRenamed("node", "item"), "item", "left").select(
        "key", "item", "kind", F.coalesce("component", "item").alias("class")
    )
    mixed = rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo != hi").select("key")
    return written(rows.join(mixed, "key"), f"{name}-mixed")


def across_leaders(measure: Measure, prune: Callable[[Column, Column, Column], Column], name: str) -> Across:
    """Compare the leaders of classes first, then the items of those that can link.

    ``prune(distance, radius, span)`` is true where no item within ``radius`` in
    total of the two leaders can link.
    """

    def run(near: DataFrame, first: DataFrame, stars: DataFrame) -> DataFrame:
        return _across(mixed_lists(near, first, name), stars, measure, prune, name)

    return run


def _across(mixed, stars, measure, prune, name) -> DataFrame:
    """Links (a, b) between items of different classes that share a list."""
    led = stars.groupBy(F.col("b").alias("item")).agg(F.min(F.struct(F.col("a").alias("head"), "distance")).alias("s"))
    led = led.select("item", "s.head", "s.distance")
    rows = written(
        mixed.join(led, "item", "left").select(
            "key", "item", "kind", "class", F.coalesce("head", "item").alias("head"), F.coalesce("distance", F.lit(0.0)).alias("radius")
        ),
        f"{name}-led",
    )
    heads = rows.groupBy("key", "class", "head").agg(F.max("radius").alias("radius"), F.min("kind").alias("kind"))
    heads = heads.select("key", "class", "head", "radius", "kind")
    x, y = heads.alias("x"), heads.alias("y")
    met = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.class") < F.col("y.class")) & (F.col("x.kind") + F.col("y.kind") < 2))
        .groupBy(F.col("x.head").alias("a"), F.col("y.head").alias("b"))
        .agg(F.max(F.col("x.radius") + F.col("y.radius")).alias("radius"))
    )
    met = written(met, f"{name}-heads")
    left = (
        measure(met)
        .join(met, ["a", "b"])
        .filter(F.col("linked") | ~prune(F.col("distance"), F.col("radius"), F.col("span")))
    )
    left = written(left.select("a", "b", "linked", "radius"), f"{name}-left")
    open_ = left.filter("radius > 0 and not linked").select(F.col("a").alias("head_a"), F.col("b").alias("head_b"))
    p, q = rows.alias("p"), rows.alias("q")
    pairs = (
        p.join(open_, F.col("p.head") == F.col("head_a"))
        .join(q, (F.col("p.key") == F.col("q.key")) & (F.col("q.head") == F.col("head_b")) & (F.col("p.kind") + F.col("q.kind") < 2))
        .select(F.col("p.item").alias("a"), F.col("q.item").alias("b"))
        .distinct()
    )
    found = measure(pairs).filter("linked").select("a", "b")
    return left.filter("linked").select("a", "b").unionByName(found).distinct()
