"""Dimension building and lookup joins.

No join here carries a broadcast hint: a dimension derived from a large table
(areas from customers) is not small at scale. Spark broadcasts a side only
after checking its size (``autoBroadcastJoinThreshold`` at plan time, AQE's
threshold on the runtime size) and otherwise falls back to a sort-merge join,
where AQE's skew handling splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import AREA_DIMENSION_COLUMNS
from ..session import materialize
from . import slices

TASK_ROWS = 250_000      # nodes of a tree that meet in one task, about


def flatten_hierarchy(tree: DataFrame, id_col: str = "id", name_col: str = "name",
                      parent_col: str = "pid", level_col: str | None = None,
                      levels: tuple[int, int, int] = (1, 2, 3)) -> DataFrame:
    """Area -> city -> province (J2): inner, so nodes without a grandparent vanish.

    Output: areaid, aname, cid, city, proid, province. Where the tree has a
    ``level_col``, each role reads its own level only (``levels``: province, city,
    area), one scan per level. Without it every node may be any of the three, so
    the tree is joined to itself twice. Spark broadcasts the upper levels when
    it finds them small.
    """
    def role(level: int) -> DataFrame:
        return tree.where(F.col(level_col) == level) if level_col else tree

    province, city, area = (role(level) for level in levels)
    city = city.select(F.col(id_col).alias("cid"), F.col(name_col).alias("city"),
                       F.col(parent_col).alias("_province_id"))
    province = province.select(F.col(id_col).alias("proid"), F.col(name_col).alias("province"))
    area = area.select(F.col(id_col).alias("areaid"), F.col(name_col).alias("aname"),
                       F.col(parent_col).alias("_city_id"))
    upper = city.join(province, F.col("_province_id") == F.col("proid"))
    return area.join(upper, F.col("_city_id") == F.col("cid")).select(*AREA_DIMENSION_COLUMNS)


def _behind(rows: DataFrame, there: DataFrame, tasks: int, most: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``there`` (``_id``, one row each) on ``_up``, in ``tasks`` tasks.

    Rows that are done (``_up`` NULL) would all be one key and do not take part. A node behind more than a
    thousandth of the rows (a thousand nodes at most, ``slices.heavy_groups``) goes to its rows instead.
    """
    columns = [c for c in there.columns if c != "_id"]
    none = [F.lit(None).cast(there.schema[c].dataType).alias(c) for c in ("_id", *columns)]
    done, going = rows.where("_up is null"), rows.where("_up is not null")
    heavy = slices.heavy_groups(going.select("_up"), "_up", most).select(F.col("_up").alias("_heavy"))
    few = materialize(there.join(F.broadcast(heavy), F.col("_id") == F.col("_heavy"), "left_semi"))
    taken = F.broadcast(few.select(F.col("_id").alias("_taken")))
    rest = going.join(taken, F.col("_up") == F.col("_taken"), "left_anti").repartition(tasks, "_up")
    met = rest.join(there.repartition(tasks, "_id"), F.col("_up") == F.col("_id"), "left")
    return (met.unionByName(going.join(F.broadcast(few), F.col("_up") == F.col("_id")))
            .unionByName(done.select("*", *none)))


def ancestors(tree: DataFrame, id_col: str = "id", name_col: str = "name", parent_col: str = "pid",
              task_rows: int = TASK_ROWS) -> DataFrame:
    """The way up from every node, at any depth (J2): id, name, depth (1 for a root), root, path
    (structs id, name from the root down to the node) and ``cyclic``.

    Parent doubling: a round joins what is known of 2^k levels with what is known of the node
    there, so a tree of depth d takes log2(d) rounds. A node whose parent is not in the table is a
    root. Where the way up meets a node twice it ends: such nodes are ``cyclic``, with NULL depth,
    root and path, and are found in the round that first goes around their cycle. Identifiers
    are unique. About ``task_rows`` nodes meet in a task, however many nodes a tree has.
    """
    known = tree.select(F.col(id_col).alias("id"), F.col(name_col).alias("name"), F.col(parent_col).alias("_up"))
    tasks = max(known.sparkSession.sparkContext.defaultParallelism, -(-known.count() // task_rows))
    upper = known.select(F.col("id").alias("_id"), F.struct("id", "name").alias("_n"))
    # chain: the ancestors nearest first; _up: the node behind them, NULL at the root
    step = materialize(_behind(known, upper, tasks).select(
        "id", "name", F.when(F.col("_id").isNotNull(), F.array("_n")).otherwise(F.array().cast(
            f"array<{_type(known, 'id', 'name')}>")).alias("chain"), F.col("_id").alias("_up")))
    around = F.size(F.array_distinct(F.transform("chain", lambda c: c["id"]))) < F.size("chain")
    around = around | F.exists("chain", lambda c: c["id"] == F.col("id"))
    lost = None
    while not step.where("_up is not null").isEmpty():
        there = step.select(F.col("id").alias("_id"), F.col("chain").alias("_more"), F.col("_up").alias("_next"))
        step = materialize(_behind(step, there, tasks).select(
            "id", "name", F.concat("chain", F.coalesce("_more", F.array().cast(step.schema["chain"].dataType)))
            .alias("chain"), F.col("_next").alias("_up"), F.col("_up").alias("_was")))
        # the node behind the chain may already be a lost one: then the way up is lost too
        gone = step.where(around).select("id", "name")
        if lost is not None:
            into = step.join(lost.select(F.col("id").alias("_gone")), F.col("_was") == F.col("_gone")).select("id", "name")
            gone = gone.unionByName(into).distinct()
        lost = materialize(gone if lost is None else lost.unionByName(gone).distinct())
        step = step.drop("_was").join(lost.select("id"), "id", "left_anti")
    whole = F.concat(F.reverse("chain"), F.array(F.struct("id", "name")))
    found = step.select("id", "name", F.size(whole).alias("depth"), whole[0]["name"].alias("root"), whole.alias("path"),
                        F.lit(False).alias("cyclic"))
    if lost is None:
        return found
    return found.unionByName(lost.select("id", "name", *[F.lit(None).cast(found.schema[c].dataType).alias(c)
                                                         for c in ("depth", "root", "path")],
                                         F.lit(True).alias("cyclic")))


def _type(df: DataFrame, *columns: str) -> str:
    return "struct<" + ", ".join(f"{c}: {df.schema[c].dataType.simpleString()}" for c in columns) + ">"


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_col`` (last duplicate wins).

    ``row_number`` = 1 is also applied on the map side, so a hot key costs one row
    per task. Rows of equal order are told apart by their other columns.
    """
    others = [F.col(c).desc() for c in df.columns if c not in (key, order_col)]
    newest = Window.partitionBy(key).orderBy(F.col(order_col).desc(), *others)
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           how: str = "inner", latest_by: str | None = None) -> DataFrame:
    """Fact rows enriched with their dimension row.

    ``latest_by`` names the column that orders a dimension whose keys may repeat:
    the last row of a key counts, so no fact is doubled. A dimension with unique
    keys does without.
    """
    if latest_by is not None:
        dim = latest_per_key(dim, dim_key, latest_by)
    return fact.join(dim, fact[fact_key] == dim[dim_key], how)


def lookup_missing(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   streaming: bool = False) -> DataFrame:
    """Fact rows without a dimension row (the J3 audit).

    Streams cannot ``left_anti``; a left outer join with a NULL test is used.
    """
    if not streaming:
        return fact.join(dim, fact[fact_key] == dim[dim_key], "left_anti")
    marked = dim.select(F.col(dim_key).alias("_dim_key"), F.lit(True).alias("_hit"))
    return (fact.join(marked, fact[fact_key] == F.col("_dim_key"), "left")
            .where(F.col("_hit").isNull()).drop("_dim_key", "_hit"))
