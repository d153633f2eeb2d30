"""What a later publication of a period changed, cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.functions.period import publication_order
from arealens.operators.selection import bounded_broadcast, staged

SOURCE_COLUMN = "source_url"


def publications(rows: DataFrame, scope) -> DataFrame:
    """(scope columns, source_url, place, of): the publications of every scope (such as
    geography and period) in their order, ``place`` from 1 of ``of``."""
    once = rows.select(*scope, SOURCE_COLUMN).distinct().withColumn("_o", publication_order())
    own = Window.partitionBy(*scope)
    return once.select(*scope, SOURCE_COLUMN, F.row_number().over(own.orderBy("_o")).alias("place"),
                       F.count(F.lit(1)).over(own).cast("int").alias("of"))


def _placed(rows: DataFrame, known: DataFrame, scope) -> DataFrame:
    """Rows with the place of their publication; the few publications are broadcast
    where their size is proven, so no row is shuffled on a handful of periods."""
    pubs = known.select(*[F.col(c).alias(f"_p_{c}") for c in (*scope, SOURCE_COLUMN)], "place", "of")
    on = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in (*scope, SOURCE_COLUMN)]
    return rows.join(bounded_broadcast(pubs), on).drop(*[f"_p_{c}" for c in (*scope, SOURCE_COLUMN)])


def latest_cells(rows: DataFrame, scope=("month_date",)) -> DataFrame:
    """Rows of the last publication of every scope: cells that it leaves out are gone."""
    return _placed(rows, staged(publications(rows, list(scope))), list(scope)).filter("place = of").drop("place", "of")


def revised_cells(rows: DataFrame, cell, values=("value",), scope=("month_date",)) -> DataFrame:
    """Every cell of every publication against the publication before it in its scope.

    ``rows``: rows of all publications with ``source_url``; ``scope``: what a
    publication covers (period, or geography and period); ``cell``: columns
    that name a cell within it; ``values``: what may change.  Result: scope,
    cell, ``source_url``, ``place`` (the publication's, from 1), ``status``
    (``inserted``, ``changed``, ``same``, or ``withdrawn``: in the publication
    before but not in this one), and each value before (``old_<value>``) and
    now.  Cells of a first publication are inserted.  NULL equals NULL, in
    names and values.  A cell that a publication repeats counts once, with its
    largest values.

    One shuffle, on whole cells: a group holds a row per publication of its
    period, however many cells or periods there are.
    """
    scope, cell, values = list(scope), list(cell), list(values)
    known = staged(publications(rows, scope))
    placed = _placed(rows, known, scope)
    one = placed.groupBy(*scope, *cell, SOURCE_COLUMN, "place", "of").agg(F.max(F.struct(*values)).alias("now"))
    own = Window.partitionBy(*scope, *cell).orderBy("place")
    seen = one.select("*", F.lag("place").over(own).alias("before"), F.lag("now").over(own).alias("old"),
                      F.lead("place").over(own).alias("after"))
    follows = F.coalesce(F.col("before") == F.col("place") - 1, F.lit(False))
    status = (F.when(~follows, F.lit("inserted"))
               .when(F.col("old").eqNullSafe(F.col("now")), F.lit("same")).otherwise(F.lit("changed")))
    here = F.struct(F.col("place").alias("place"), status.alias("status"), F.when(follows, F.col("old")).alias("old"),
                    F.col("now").alias("now"))
    gone = F.when((F.col("place") < F.col("of")) & (F.coalesce(F.col("after"), F.lit(0)) != F.col("place") + 1),
                  F.struct((F.col("place") + 1).alias("place"), F.lit("withdrawn").alias("status"),
                           F.col("now").alias("old"), F.lit(None).cast(one.schema["now"].dataType).alias("now")))
    events = seen.select(*scope, *cell, F.explode(F.filter(F.array(here, gone), lambda e: e.isNotNull())).alias("e"))
    named = bounded_broadcast(known.select(
        *[F.col(c).alias(f"_p_{c}") for c in scope], F.col("place").alias("_p_place"), SOURCE_COLUMN))
    on = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in scope] + [F.col("e.place") == F.col("_p_place")]
    return events.join(named, on).select(
        *scope, *cell, SOURCE_COLUMN, F.col("e.place").alias("place"), F.col("e.status").alias("status"),
        *[F.col(f"e.old.{v}").alias(f"old_{v}") for v in values], *[F.col(f"e.now.{v}").alias(v) for v in values])
