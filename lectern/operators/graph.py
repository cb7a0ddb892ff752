"""Graph operators: containment, neighbours, exact hops, closures, cycles, locations, curriculum order."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators.components import strong
from lectern.operators.fixpoint import dropped, ranked, stored, union

LEVELS = ("section", "chapter", "book", "subject_stage", "subject")


def structure(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of book, chapter and section from a section index.

    sections: book, book_name, chapter, chapter_title, section (null: the chapter's own file), section_title, ord.
    The first title of a chapter, and the first row of a section id, win.
    """
    first = lambda c: F.min_by(c, "ord")
    books = sections.groupBy(F.col("book").alias("id")).agg(first("book_name").alias("name"), F.min("ord").alias("ord")).withColumn("label", F.lit("Book"))
    chapters = sections.groupBy(F.col("chapter").alias("id")).agg(first("chapter_title").alias("name"), F.min("ord").alias("ord"), first("book").alias("up")).withColumn("label", F.lit("Chapter"))
    parts = sections.where("section IS NOT NULL").groupBy(F.col("section").alias("id")).agg(first("section_title").alias("name"), F.min("ord").alias("ord"), first("chapter").alias("up")).withColumn("label", F.lit("Section"))
    below = chapters.unionByName(parts)
    nodes = books.unionByName(below.drop("up")).select("id", "label", "name", "ord")
    edges = below.select(F.col("id").alias("source"), F.col("up").alias("target"), F.lit("is_part_of").alias("type"))
    return nodes, edges


def ancestors(part_of: DataFrame, depth: int = 2) -> DataFrame:
    """(node, ancestor, distance) up to ``depth`` steps along is_part_of (source, target)."""
    step = part_of.select(F.col("source").alias("node"), F.col("target").alias("ancestor")).distinct()
    out = now = step.withColumn("distance", F.lit(1))
    up = step.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("next"))
    for d in range(2, depth + 1):
        now = now.join(up, "ancestor").select("node", F.col("next").alias("ancestor"), F.lit(d).alias("distance"))
        out = out.unionByName(now)
    return out.groupBy("node", "ancestor").agg(F.min("distance").alias("distance"))


def neighbours(edges: DataFrame, symmetric: tuple[str, ...] = ("relates_to", "is_a", "prerequisites_for")) -> DataFrame:
    """(node, other): pairs joined by an edge of the types, in both directions."""
    e = edges.where(F.col("type").isin(*symmetric))
    both = e.select(F.col("source").alias("node"), F.col("target").alias("other")).unionByName(e.select(F.col("target").alias("node"), F.col("source").alias("other")))
    return both.where("node <> other").distinct()


def exact_hops(pairs: DataFrame, starts: DataFrame, hops: int = 2) -> DataFrame:
    """(query, node): nodes whose shortest distance from the query's start set is exactly ``hops``.

    pairs: (node, other), both directions; starts: (query, node).
    """
    # queries are bits of blocks of 63, those of one least neighbour side by side, so that rows of a hub's queries move as one
    starts = stored(starts.select("query", "node").where("query IS NOT NULL AND node IS NOT NULL").distinct())
    pairs = stored(pairs)
    near = starts.join(pairs, "node", "left").groupBy("query").agg(F.min("other").alias("_near"))
    asked = stored(ranked(near, "_near", "query").select("query", F.floor(F.col("n") / 63).alias("_block"), (F.col("n") % 63).cast("int").alias("_bit")))
    together = lambda rows: rows.groupBy("_block", "node").agg(F.bit_or("_bits").alias("_bits"))
    seen = frontier = stored(together(starts.join(asked, "query").select("_block", "node", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit")).alias("_bits"))))
    for _ in range(hops):
        step = together(frontier.join(pairs, "node").select("_block", F.col("other").alias("node"), "_bits"))
        before = seen.withColumnRenamed("_bits", "_seen")
        new = step.join(before, ["_block", "node"], "left").withColumn("_bits", F.col("_bits").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0).cast("long")))))
        frontier = stored(new.where("_bits <> 0").select("_block", "node", "_bits"))
        seen = together(seen.unionByName(frontier))
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = F.call_function("shiftright", F.col("_bits"), F.col("_bit")).bitwiseAND(F.lit(1)) == 1
    # few rows give many pairs: as many tasks as there are, however small their input
    return frontier.repartition(tasks, "_block").join(asked, "_block").where(there).select("query", "node")


def closure(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(source, target): all pairs joined by a path; (x, x) only on a cycle.

    Nodes of plain chains are numbered along them, and their pairs come from one join within blocks of a chain, so that
    no pair is moved. Of all other edges, after round k, ``now`` has the paths of up to 2**k edges and ``step`` those of
    just 2**k.
    """
    edges = stored(edges.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL").distinct())
    chains, now = chained(edges)
    pairs = along(chains)
    step, size = now, now.count()
    if not size:
        return pairs
    joined = lambda a, b: a.alias("a").join(b.alias("b"), F.col("a.target") == F.col("b.source")).select(F.col("a.source").alias("source"), F.col("b.target").alias("target"))
    for _ in range(rounds):
        after = stored(now.unionByName(joined(now, step)).distinct())
        grown = after.count()
        longer = stored(joined(step, step).distinct()) if grown > size else None
        for table in {id(now): now, id(step): step}.values():
            dropped(table)
        if longer is None:
            return pairs.unionByName(after)
        now, size, step = after, grown, longer
    raise RuntimeError(f"closure did not settle in {rounds} rounds")


def to_ends(links: DataFrame) -> DataFrame:
    """(node, end, left): the last node of each node's chain and the edges to it; links have one edge a node in and out at most. Rings have no end and are left out.

    Round k knows the 2**k edges after each node, so a chain of n nodes takes log n rounds.
    """
    more = links.select(F.col("source").alias("to"), F.lit(True).alias("more"))
    one = links.select(F.col("source").alias("node"), F.col("target").alias("to"), F.lit(1).cast("long").alias("left"))
    last = links.select(F.col("target").alias("to")).join(more, "to", "left_anti").select(F.col("to").alias("node"), "to", F.lit(0).cast("long").alias("left"), F.lit(True).alias("done"))
    parts = [stored(one.join(more, "to", "left").select("node", "to", "left", F.col("more").isNull().alias("done")).unionByName(last))]
    before, open_ = None, parts[-1].where("NOT done").count()
    while open_ and open_ != before:
        now = union([p.where("done") for p in parts] + [parts[-1].where("NOT done")])
        ahead = now.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("left").alias("_left"), F.col("done").alias("_done"))
        parts.append(stored(parts[-1].where("NOT done").join(ahead, "to").select("node", F.col("_to").alias("to"), (F.col("left") + F.col("_left")).alias("left"), F.col("_done").alias("done"))))
        before, open_ = open_, parts[-1].where("NOT done").count()
    return union([p.where("done") for p in parts]).select("node", F.col("to").alias("end"), "left")


def chained(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((node, end, left) of chains that no other edge touches, the edges of all other nodes), both stored; edges: distinct (source, target)."""
    ends = lambda end: edges.select(F.col(end).alias("node"))
    many = ends("source").groupBy("node").count().unionByName(ends("target").groupBy("node").count()).where("count > 1").select("node")
    many = stored(many.unionByName(edges.where("source = target").select(F.col("source").alias("node"))).distinct())
    as_ = lambda rows, name: rows.withColumnRenamed("node", name)
    plain = stored(edges.join(as_(many, "source"), "source", "left_anti").join(as_(many, "target"), "target", "left_anti").select("source", "target"))
    at = stored(to_ends(plain))
    beside = edges.join(as_(many, "source"), "source", "left_semi").select(F.col("target").alias("node")).unionByName(edges.join(as_(many, "target"), "target", "left_semi").select(F.col("source").alias("node")))
    touched = at.join(beside.distinct(), "node", "left_semi").select("end").distinct()
    at = stored(at.join(touched, "end", "left_anti").select("node", "end", "left"))
    return at, stored(edges.join(as_(at.select("node"), "source"), "source", "left_anti").select("source", "target"))


def along(chains: DataFrame, block: int = 4096) -> DataFrame:
    """(source, target): all pairs of a chain's nodes (node, end, left), made by pairs of blocks of it; only the nodes are moved, once for each block of their chain."""
    tasks = int(chains.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = chains.withColumn("b", F.floor(F.col("left") / block))
    top = at.groupBy("end").agg(F.max("b").alias("top"))
    early = at.select("end", F.col("node").alias("source"), F.col("left").alias("far"), F.col("b").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), "b")).alias("j"))
    late = at.join(top, "end").select("end", F.col("node").alias("target"), F.col("left").alias("near"), F.col("b").alias("j"), F.explode(F.sequence("b", "top")).alias("i"))
    by = ["end", "i", "j"]
    # few rows give many pairs: as many tasks as there are, however small their input
    return early.repartition(tasks, *by).join(late.repartition(tasks, *by), by).where("far > near").select("source", "target")


def reachable(edges: DataFrame, starts: DataFrame, merge_after: int = 8) -> DataFrame:
    """(query, node): nodes at the end of a path of one edge or more from a start of the query; starts: (query, node).

    Each round goes on from what the round before found first, so the work is that of the pairs asked for and not of
    the whole graph's closure.
    """
    step = stored(edges.select(F.col("source").alias("node"), F.col("target").alias("next")).where("node IS NOT NULL AND next IS NOT NULL").distinct())
    onward = lambda rows: rows.join(step, "node").select("query", F.col("next").alias("node")).distinct()
    parts = [stored(onward(starts.select("query", "node")))]
    while not parts[-1].isEmpty():
        new = stored(onward(parts[-1]).join(union(parts), ["query", "node"], "left_anti"))
        if len(parts) == merge_after:  # few tables, however long the paths
            merged = stored(union(parts))
            for table in parts:
                dropped(table)
            parts = [merged]
        parts.append(new)
    return union(parts)


def cycles(edges: DataFrame, longest: int | None = None, most: int = 200) -> DataFrame:
    """(cycle, length): simple cycles of 2 to ``longest`` nodes (None: of any length), from their least node on, the first ``most`` by it.

    A strongly connected component with one edge a node is one cycle: its nodes are numbered from the least one on. In
    others paths grow along edges, without a bound until none is open; their number can grow exponentially where such
    nodes have many edges.
    """
    at = stored(strong(edges))
    inside = edges.select("source", "target").where("source <> target").distinct()
    inside = inside.join(at.withColumnsRenamed({"node": "source", "component": "c"}), "source").join(at.withColumnsRenamed({"node": "target", "component": "d"}), "target")
    inside = stored(inside.where("c = d").select("source", "target", "c"))
    branched = stored(inside.groupBy("source", "c").count().where("count > 1").select("c").distinct())
    # without the edge back to its least node a ring is a chain
    ring = to_ends(stored(inside.join(branched, "c", "left_anti").where("target <> c").select("source", "target")))
    nodes = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("at"), "node"))), lambda r: r.node)
    out = ring.groupBy("end").agg(nodes.alias("path")).select("path")
    if longest is not None:
        out = out.where(F.size("path") <= longest)
    e = stored(inside.join(branched, "c", "left_semi").select("source", "target"))
    paths = e.where("source < target").select(F.col("source").alias("start"), F.array("source", "target").alias("path"), F.col("target").alias("source"))
    for length in count(2) if not e.isEmpty() else ():
        out = out.unionByName(paths.join(e, "source").where("target = start").select("path"))
        if length == longest:
            break
        grown = paths.join(e, "source").where((F.col("target") > F.col("start")) & ~F.array_contains("path", F.col("target")))
        paths = grown.select("start", F.concat("path", F.array("target")).alias("path"), F.col("target").alias("source"))
        if longest is None:
            paths = stored(paths)
            if paths.isEmpty():
                break
    found = out.select(F.array_join("path", ">").alias("cycle"), F.size("path").cast("long").alias("length"))
    return found.orderBy("cycle").limit(most)


def on_cycle(edges: DataFrame) -> DataFrame:
    """(node): nodes that reach themselves, self loops aside."""
    return strong(edges).select("node")


def locations(nodes: DataFrame, appears_in: DataFrame, part_of: DataFrame) -> DataFrame:
    """(node_id, level, value): sections, chapters, books, codes, subjects and subject:stage of each node, from its own id, where it appears, and what contains that.

    Levels are worked out once for each place, not for each node that appears there.
    """
    up = ancestors(part_of).select(F.col("node").alias("at"), F.col("ancestor").alias("value"))
    label = nodes.where(F.col("label").isin("Section", "Chapter", "Book")).select(F.col("id").alias("value"), "label")
    own = nodes.select(F.col("id").alias("node_id"), F.col("id").alias("at"))
    at = own.unionByName(appears_in.select(F.col("source").alias("node_id"), F.col("target").alias("at"))).distinct()
    code, subject = ids.book_code(F.col("value")), ids.subject(F.col("value"))
    coded = lambda df: df.withColumns({"code": code, "subj": subject}).where("code <> ''").withColumn("x", F.array(F.struct(F.lit("book_code").alias("level"), F.col("code").alias("value")), F.struct(F.lit("subject").alias("level"), F.col("subj").alias("value")), F.struct(F.lit("subject_stage").alias("level"), F.concat_ws(":", "subj", ids.stage(F.col("code"))).alias("value"))))
    shown = lambda df: df.join(label, "value").select("at", F.lower("label").alias("level"), "value").unionByName(coded(df).select("at", F.explode("x").alias("x")).select("at", "x.*"))
    # places are those that contain something or are one; ids of all other nodes give codes of their own
    places = appears_in.select(F.col("target").alias("at")).unionByName(part_of.select(F.col("source").alias("at"))).unionByName(label.select(F.col("value").alias("at"))).distinct()
    of = shown(places.select("at", F.col("at").alias("value")).unionByName(up.join(places, "at", "left_semi").select("at", "value"))).distinct()
    lists = of.groupBy("at").agg(F.collect_list(F.struct("level", "value")).alias("x"))
    of_id = coded(at.where("node_id = at").withColumn("value", F.col("at"))).select("node_id", F.explode("x").alias("x")).select("node_id", "x.*")
    of_place = at.join(lists, "at").select("node_id", F.explode("x").alias("x")).select("node_id", "x.*")
    return of_place.unionByName(of_id).distinct()


def pool(locations_: DataFrame, nodes: DataFrame, anchors: DataFrame, level: str, labels: tuple[str, ...], salts: int = 1) -> DataFrame:
    """(query, node): nodes of the labels that share a place of the level with any anchor (query, node).

    Only pairs of queries with several places can repeat and are made distinct; those of all others are not moved. With
    few places that most rows share, ``salts`` deals a place's queries to as many tasks.
    """
    here = locations_.where(F.col("level") == level).select("node_id", "value").distinct()
    places = anchors.join(here, anchors["node"] == here["node_id"]).select("query", "value").distinct()
    places = stored(places.withColumn("many", F.count("*").over(Window.partitionBy("query")) > 1))
    others = here.join(nodes.where(F.col("label").isin(*labels)).select(F.col("id").alias("node_id")).distinct(), "node_id")
    once = places.where("NOT many").withColumn("salt", F.pmod(F.xxhash64("query"), F.lit(salts)))
    spread = others.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    by = ["value", "salt"]
    if salts > 1:  # few rows give many pairs: tasks are not merged by the size of their input
        tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        once, spread = once.repartition(tasks, *by), spread.repartition(tasks, *by)
    single = once.join(spread, by).select("query", F.col("node_id").alias("node"))
    return single.unionByName(places.where("many").join(others, "value").select("query", F.col("node_id").alias("node")).distinct())


def dealt(rows: DataFrame, members: DataFrame, by: list[str], values: int | None = None) -> DataFrame:
    """rows (query, by...) joined with members (by...), which give many pairs from few rows.

    A value's queries are dealt to several tasks, the more the fewer ``values`` there are (None: each to all tasks), and
    tasks are not merged by the size of their input.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = tasks if values is None else max(1, min(tasks, 4 * tasks // max(values, 1)))
    salt = F.pmod(F.xxhash64("query"), F.lit(salts)).cast("int").alias("_salt")
    keys = [*by, "_salt"]
    each = members.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.select("*", salt).repartition(tasks, *keys).join(each.repartition(tasks, *keys), keys).drop("_salt")


def in_scope(places: DataFrame, later: bool = False) -> DataFrame:
    """(node, other): places (node, scope, key) of one scope whose key is less, or with ``later`` greater."""
    other = places.select(F.col("node").alias("other"), "scope", F.col("key").alias("other_key"))
    compare = F.col("other_key") > F.col("key") if later else F.col("other_key") < F.col("key")
    return places.join(other, "scope").where(compare).select("node", "other")


def as_of(asks: DataFrame, places: DataFrame) -> DataFrame:
    """asks (id, scope, key) with ``place``, the nearest place (place, scope, key) of the scope whose key is less; null where there is none.

    Of places of one key the largest counts. Both tables are sorted together by ranges of (scope, key): within a range the last
    place before is carried along, and each range's last place of a scope goes to the ranges after it. There is no self
    join, and a scope with most rows is shared by many tasks.
    """
    kind = lambda df, is_ask: df.select("scope", "key", F.lit(is_ask).alias("is_ask"), (F.col("id") if is_ask == 0 else F.lit(None).cast(asks.schema["id"].dataType)).alias("id"), (F.col("place") if is_ask else F.lit(None).cast(places.schema["place"].dataType)).alias("place"))
    both = kind(asks, 0).unionByName(kind(places, 1))  # an ask comes before the places of its key
    order = ("scope", "key", "is_ask", "place", "id")
    placed = stored(both.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    latest = F.last("place", ignorenulls=True)
    own = latest.over(Window.partitionBy("part", "scope").orderBy("key", "is_ask", "place", "id").rowsBetween(Window.unboundedPreceding, -1))
    ends = placed.groupBy("scope", "part").agg(F.max_by("place", F.when(F.col("is_ask") == 1, F.struct("key", "place"))).alias("end"))
    before = F.last("end", ignorenulls=True).over(Window.partitionBy("scope").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(F.col("scope").alias("_scope"), F.col("part").alias("_part"), before.alias("_before"))
    rows = placed.withColumn("_own", own).where("is_ask = 0").join(carried, F.col("scope").eqNullSafe(F.col("_scope")) & (F.col("part") == F.col("_part")))
    return rows.select("id", "scope", "key", F.coalesce("_own", "_before").alias("place"))


def previous(places: DataFrame, count: int = 3) -> DataFrame:
    """(node, other, steps): the ``count`` places before each in its scope, the nearest with steps 1."""
    before = F.collect_list("node").over(Window.partitionBy("scope").orderBy("key", "node").rowsBetween(-count, -1))
    rows = places.withColumn("before", before).select("node", F.posexplode(F.reverse("before")).alias("at", "other"))
    return rows.select("node", "other", (F.col("at") + 1).alias("steps"))


def earliest(places: DataFrame) -> DataFrame:
    """(node, place) with the least key of each node's places (node, place, key)."""
    return places.groupBy("node").agg(F.min_by("place", F.struct("key", "place")).alias("place"))
