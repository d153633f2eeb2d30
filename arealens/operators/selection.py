"""Block selections, parameter checks and size-checked broadcasts."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values: parameter domains accepted by the area queries. ---------
SUPPORTED_YEARS = (2011, 2016)
SEIFA_INDEX_TYPES = ("IRSD", "IEO", "IER", "IRSAD")
SEIFA_MEASURES = ("SCORE", "RWAD", "RWSD", "RWSP", "RWSR", "RWAR", "RWAP", "URP")
# ---------------------------------------------------------------------------

# A literal IN list is pushed into the Parquet scan; beyond this many ids the
# list becomes a (driver-sized, hence bounded) broadcast relation instead.
MAX_INLINE_IDS = 1000
# Largest relation ``bounded_broadcast`` will ship to every executor.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
# Rows that one task groups or sorts where ``dealt`` sizes the tasks.
ROWS_PER_TASK = 500_000


def quoted(name: str) -> F.Column:
    """Column by its literal name (dots, spaces and backticks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_list(values) -> list:
    if values is None:
        return []
    if isinstance(values, (str, int, float)):
        return [values]
    return list(values)


def check_members(name: str, values, allowed) -> list:
    """Every value must be in ``allowed``; raises ``ValueError`` otherwise.
    Numbers and their text form are treated alike ("2016" == 2016)."""
    vals = as_list(values)
    if not vals:
        raise ValueError(f"'{name}' needs at least one value")
    allowed_txt = {str(a) for a in allowed}
    bad = [v for v in vals if str(v) not in allowed_txt]
    if bad:
        raise ValueError(f"'{name}' should be one of {', '.join(map(str, allowed))}; got {bad}")
    return vals


def block_ids(blocks: Iterable) -> list[str]:
    """Block ids are text; numbers are converted."""
    return [str(b) for b in as_list(blocks)]


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after proving the relation small: one job over at
    most ``max_rows + 1`` rows counts them and sums their size as JSON text
    (a stand-in for their width).  Above either bound the relation is left to
    the planner: shuffle join, turned into a broadcast by AQE if the measured
    shuffle size is small, skew-split otherwise.

    Nothing is cached: a cached relation would be substituted for every later
    identical plan and could hide rows that arrive afterwards.  The probe runs
    when the plan is built, so operators using it (selection frames, sheet
    layouts) start one small job before the caller's action.
    """
    probe = (df.limit(max_rows + 1)
               .select(F.octet_length(F.to_json(F.struct(*[quoted(c) for c in df.columns]))).alias("b"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("bytes"))
               .first())
    n, size = probe["n"], probe["bytes"] or 0
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, where the
    session names one: later uses (a size probe, several outputs) read that
    instead of the sources again.  Without a folder ``df`` stays as it is."""
    return df.checkpoint(eager=True) if df.sparkSession.sparkContext.getCheckpointDir() else df


def dealt(df: DataFrame, *keys: str, rows: int | None = None, per_task: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as its rows ask for, always more
    than the session's shuffle partitions: what a task groups, joins or sorts by
    these keys then stays the same size as tables grow.  ``rows``: their number
    where the caller knows it, else they are counted.  Rows of one task stay as
    they are, without a shuffle."""
    per_task = per_task or ROWS_PER_TASK
    rows = df.count() if rows is None else rows
    if rows <= per_task:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one more than the session's: a join's exchange on these keys into as many
    # partitions would stand in for this one, and be coalesced
    return df.repartition(max(math.ceil(rows / per_task), least + 1), *[quoted(k) for k in keys])


def select_blocks(concord: DataFrame, blocks, block_col: str = "block_id") -> tuple[DataFrame, list[str]]:
    """Keep concordance rows of the selected blocks.

    ``blocks`` is either
      * an iterable of ids: one selection; small lists become an ``IN`` filter
        that reaches the Parquet scan, long ones a semi-join, broadcast up to
        ``MAX_BROADCAST_ROWS`` ids (the list lives on the driver, so its size
        is known);
      * a DataFrame with ``block_id`` and optionally ``selection_id``: many
        selections answered in one job.  It is broadcast when a count shows
        it small (the concordance is then never shuffled for this join);
        otherwise it is a shuffle join that AQE may still turn into a
        broadcast from measured sizes, with skewed partitions split.
    Returns the filtered concordance and the extra grouping columns
    (``["selection_id"]`` or ``[]``).
    """
    if isinstance(blocks, DataFrame):
        sel = blocks.withColumn(block_col, F.col(block_col).cast("string"))
        if "selection_id" in sel.columns:
            sel = bounded_broadcast(sel.select("selection_id", block_col).distinct())
            return concord.join(sel, block_col, "inner"), ["selection_id"]
        sel = bounded_broadcast(sel.select(block_col).distinct())
        return concord.join(sel, block_col, "left_semi"), []
    ids = block_ids(blocks)
    if not ids:
        raise ValueError("no blocks selected")
    if len(ids) <= MAX_INLINE_IDS:
        return concord.filter(F.col(block_col).isin(ids)), []
    spark = concord.sparkSession
    distinct_ids = sorted(set(ids))
    sel = spark.createDataFrame([(i,) for i in distinct_ids], f"{block_col} string")
    if len(distinct_ids) <= MAX_BROADCAST_ROWS:  # size known on the driver
        sel = F.broadcast(sel)
    return concord.join(sel, block_col, "left_semi"), []
