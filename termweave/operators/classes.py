"""Order-dependent merges per key, and class hierarchies.

Folds need the rows of a key in order. A value that was seen before changes nothing (it is contained, or its class is covered), so rows
are first reduced to the first occurrence of each value, with partial aggregation; what is gathered per key is its distinct
values: sources of a label, classes of an instance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .graph import closure

THING = "owl:Thing"
# Classes of interest, in order of precedence.
INTERESTING = ("dbpo:Person", "dbpo:PopulatedPlace", "dbpo:SportsTeam", "dbpo:Organisation")


def append_unless_contained(values: Column) -> Column:
    """``v1|v2``: each value is appended unless the text so far holds it as a substring."""
    return F.aggregate(F.slice(values, 2, 2**30), F.get(values, F.lit(0)), lambda acc, v: F.when(acc.contains(v), acc).otherwise(F.concat(acc, F.lit("|"), v)))


def merge_label_info(rows: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """Per key each of ``values`` folded by ``append_unless_contained`` in ``order``. Null values count as ''."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.coalesce(F.col(v).cast("string"), F.lit("")).alias("v")) for i, v in enumerate(values)])
    firsts = rows.select(*keys, order, F.explode(pairs).alias("_p")).groupBy(*keys, "_p.i", "_p.v").agg(F.min(order).alias("_at"))
    folded = firsts.groupBy(*keys, "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "v"))), lambda x: x["v"]).alias("vs")).select(*keys, "i", append_unless_contained(F.col("vs")).alias("t"))
    return folded.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("t"))).alias(v) for i, v in enumerate(values)])


def class_maps(properties: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(canonical, interesting, super), each (cls, to), from (property, orig, mapped) rows. A property is known by its local name, whatever its prefix."""
    local = F.substring_index("property", ":", -1)
    part = lambda p: properties.filter(local == p).select(F.col("orig").alias("cls"), F.col("mapped").alias("to"))
    return part("hasCanonicalUri"), part("hasInterestingClass"), part("hasSuperClass")


def class_info(canonical: DataFrame, interesting: DataFrame, supers: DataFrame) -> DataFrame:
    """_c (a class as written), c (canonical), i (its class of interest or ''), up (all classes above it): as many values as its hierarchy is deep."""
    up = supers.groupBy("cls").agg(F.collect_set("to").alias("up"))
    info = canonical.select(F.col("cls").alias("_c"), F.col("to").alias("c")).join(interesting.select(F.col("cls").alias("c"), F.nullif(F.col("to"), F.lit(THING)).alias("i")), "c", "left").join(up.withColumnRenamed("cls", "c"), "c", "left")
    return info.select("_c", "c", F.coalesce("i", F.lit("")).alias("i"), F.coalesce("up", F.array().cast("array<string>")).alias("up"))


def specific_classes(rows: DataFrame, canonical: DataFrame, interesting: DataFrame, supers: DataFrame, uri: str = "uri", cls: str = "cls", order: str = "line_no") -> DataFrame:
    """uri, specific, interesting: ``|`` lists folded in order.

    A class is made canonical (unknown ones are ignored). Against the classes so far, left to right: equal, or one of them lies below it:
    done; it lies below one of them: takes its place, done; otherwise it is appended. Its interesting class (owl:Thing counts as none) is
    appended if the list changed and lacks it. ``supers`` must be closed under superclass of superclass.
    """
    info = class_info(canonical, interesting, supers)
    known = rows.select(F.col(uri).alias("uri"), F.col(cls).alias("_c"), F.col(order).alias("_o")).groupBy("uri", "_c").agg(F.min("_o").alias("_o")).join(info, "_c")
    items = F.array_sort(F.collect_list(F.struct("_o", "c", "i", "up")))
    g = known.groupBy("uri").agg(items.alias("xs"))
    cell = lambda x: F.struct(x["c"].alias("c"), x["up"].alias("up"))
    head = F.get("xs", F.lit(0))
    start = F.struct(F.array(cell(head)).alias("s"), F.when(head["i"] == "", F.array().cast("array<string>")).otherwise(F.array(head["i"])).alias("i"))

    def step(acc: Column, x: Column) -> Column:
        covers = lambda e: (e["c"] == x["c"]) | F.array_contains(e["up"], x["c"])
        at = F.array_position(F.transform(acc["s"], lambda e: covers(e) | F.array_contains(x["up"], e["c"])), True)
        hit = F.try_element_at(acc["s"], F.when(at > 0, at).otherwise(F.lit(1)).cast("int"))
        stay = (at > 0) & covers(hit)
        new = F.when(at == 0, F.concat(acc["s"], F.array(cell(x)))).otherwise(F.transform(acc["s"], lambda e, k: F.when(k + 1 == at, cell(x)).otherwise(e)))
        more = (x["i"] != "") & ~F.array_contains(acc["i"], x["i"])
        return F.when(stay, acc).otherwise(F.struct(new.alias("s"), F.when(more, F.concat(acc["i"], F.array(x["i"]))).otherwise(acc["i"]).alias("i")))

    done = g.select("uri", F.aggregate(F.slice(F.col("xs"), 2, 2**30), start, step).alias("r"))
    return done.select("uri", F.array_join(F.transform("r.s", lambda e: e["c"]), "|").alias("specific"), F.array_join("r.i", "|").alias("interesting"))


def ontology_mapping(subclass: DataFrame, equivalent: DataFrame, prefix: str = "dbpo:", interesting: tuple[str, ...] = INTERESTING) -> DataFrame:
    """(property, orig, mapped) rows for every class: canonical URI, interesting class, superclasses.

    canonical: an equivalent class of interest; else the smallest of the equivalent classes with ``prefix`` and itself if it has it; else none,
    and the class is dropped. interesting: the first of the list that is the class or above it, else owl:Thing. superclasses: the canonical
    ones strictly above, and owl:Thing. Equivalence is read in both directions.
    """
    eq = equivalent.select("a", "b").unionByName(equivalent.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    names = subclass.select(F.explode(F.array("a", "b")).alias("c")).unionByName(eq.select(F.col("a").alias("c"))).distinct()
    own = names.select("c", F.col("c").alias("e")).unionByName(eq.select(F.col("a").alias("c"), F.col("b").alias("e")))
    order = F.create_map(*[F.lit(x) for kv in ((c, i) for i, c in enumerate(interesting)) for x in kv])
    picked = own.groupBy("c").agg(F.min_by("e", F.when(F.col("e") != F.col("c"), F.try_element_at(order, F.col("e")))).alias("best"), F.max(F.when(F.col("e") != F.col("c"), F.try_element_at(order, F.col("e")))).alias("has"), F.min(F.when(F.col("e").startswith(prefix), F.col("e"))).alias("least"))
    canon = staged(picked.select("c", F.when(F.col("has").isNotNull(), F.col("best")).otherwise(F.col("least")).alias("u")).filter(F.col("u").isNotNull()))
    up = closure(subclass.select("a", "b"), "a", "b").filter("a <> b")
    above = staged(up.join(canon.select(F.col("c").alias("b"), F.col("u").alias("bu")), "b").select(F.col("a").alias("c"), "bu").distinct())
    mine = canon.select("c", F.col("u").alias("bu")).unionByName(above)
    first = mine.select("c", F.try_element_at(order, F.col("bu")).alias("k")).groupBy("c").agg(F.min("k").alias("k"))
    back = F.create_map(*[F.lit(x) for kv in enumerate(interesting) for x in kv])
    inter = canon.join(first, "c").select(F.lit("map:hasInterestingClass").alias("property"), F.col("u").alias("orig"), F.coalesce(F.try_element_at(back, F.col("k")), F.lit(THING)).alias("mapped"))
    sup = canon.join(above, "c").filter("u <> bu").select(F.lit("map:hasSuperClass").alias("property"), F.col("u").alias("orig"), F.col("bu").alias("mapped"))
    thing = canon.select(F.lit("map:hasSuperClass").alias("property"), F.col("u").alias("orig"), F.lit(THING).alias("mapped"))
    return canon.select(F.lit("map:hasCanonicalUri").alias("property"), F.col("c").alias("orig"), F.col("u").alias("mapped")).unionByName(inter).unionByName(sup).unionByName(thing).distinct()
