"""Secret scan with multipart credential linking, in DataFrame functions only.

Three base kinds (``assign``, ``access``, ``hex``) are always reported.  Weak
candidates are reported only when a complementary part lies within ``scope``
code points of them:

* ``ident``  (a user or client identifier) next to a secret part,
* ``opaque`` (a long mixed-case token without a name) next to an identifier
  or an endpoint,
* ``endpoint`` (a URL with a host) next to a secret part.

Secret parts are ``assign``, ``hex`` and ``opaque``; identifiers are
``access`` and ``ident``.  The link is an interval join: a weak candidate's
interval, widened by ``scope``, and the parts are dealt to buckets of
``scope`` code points of one text, and meet in their buckets.  Parts of one
kind don't overlap and have a minimal length, so a bucket holds a bounded
number of them, however many a text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, prefix, small, text_key

# The base patterns as given, letters of the names in either case.
_NAMES = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])")
ASSIGN = _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak kinds of the method.
IDENT = (r"\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)"
         r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.+-]{3,}""")
OPAQUE = r"[A-Za-z0-9+/]{40,}={0,2}"
ENDPOINT = r"https?://[A-Za-z0-9.-]{4,}(?::[0-9]{1,5})?"

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "ident", "opaque", "endpoint")
_SECRET, _IDENTITY = ("assign", "hex", "opaque"), ("access", "ident")
#: Weak kind -> kinds that complete it.
COMPLETES = {"ident": _SECRET, "opaque": (*_IDENTITY, "endpoint"), "endpoint": _SECRET}
_SPAN = "array<struct<start:int,order:int,stop:int>>"
BROADCAST_ROWS = 200_000
RUN = 64  # spans of a text that are replaced in one piece of it


def _spans(text: Column, pattern: str, order: int, keep=None) -> Column:
    """Array of (start, order, stop) of the pattern's matches, in code points.

    The pieces between matches come from ``split`` and the matches from
    ``regexp_extract_all``: both walk the same leftmost matches, and the
    lengths add up to offsets.
    """
    empty = F.array().cast(_SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(F.split(text, pattern, -1), found, lambda gap, hit: F.struct(
        F.coalesce(F.length(gap), F.lit(0)).alias("gap"),
        F.coalesce(F.length(hit), F.lit(0)).alias("len"),
        (F.lit(True) if keep is None else F.coalesce(keep(hit), F.lit(False))).alias("keep")))

    def placed(parts: Column) -> Column:
        before = prefix(F.transform(parts, lambda x: x["gap"] + x["len"]), F.lit(0), lambda a, b: a + b)
        spans = F.zip_with(parts, before, lambda x, at: F.when(x["keep"] & (x["len"] > 0), F.struct(
            (at + x["gap"]).alias("start"), F.lit(order).alias("order"), (at + x["gap"] + x["len"]).alias("stop"))))
        return F.filter(spans, lambda s: s.isNotNull()).cast(_SPAN)

    folded = let(lengths, placed)
    return F.when(text.rlike(pattern), folded).otherwise(empty)


def _written(spans: Column) -> Column:
    """``kind:start:stop`` by start, then kind in the listed order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["order"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, scope: int = 200, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Spans of secrets in every text.

    One row per document row: id, ``key`` (digest of the text), ``base`` and
    ``spans`` (arrays of start, order in ``KINDS``, stop; code points, end
    exclusive), ``spans_text``.  Null texts count as empty and have no spans;
    null ids are kept; repeated rows are repeated; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def long_value(hit: Column) -> Column:
        return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6

    def mixed(hit: Column) -> Column:
        return hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")

    slim = cut(docs.select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
        F.concat(_spans(text, ASSIGN, 0, long_value), _spans(text, ACCESS, 1),
                 _spans(text, HEX, 2)).alias("base"),
        F.concat(_spans(text, IDENT, 3), _spans(text, OPAQUE, 4, mixed),
                 _spans(text, ENDPOINT, 5)).alias("weak")))

    parts = (slim.filter((F.size("weak") > 0) & (F.size("base") + F.size("weak") > 1))
             .select("key", F.explode(F.concat("base", "weak")).alias("s")).distinct()
             .select("key", "s.*"))

    def buckets(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))

    sides = F.create_map(*[x for k, kinds in COMPLETES.items() for x in (
        F.lit(KINDS.index(k)), F.array(*[F.lit(KINDS.index(c)) for c in kinds]))])
    weak = (parts.filter(F.col("order") >= len(BASE))
            .select("key", "start", "order", "stop", sides[F.col("order")].alias("needs"),
                    buckets(F.greatest(F.lit(0), F.col("start") - scope), F.col("stop") + scope).alias("bucket")))
    other = parts.select("key", F.col("start").alias("o_start"), F.col("order").alias("o_order"),
                         F.col("stop").alias("o_stop"), buckets(F.col("start"), F.col("stop")).alias("bucket"))
    linked = (weak.join(other, ["key", "bucket"])
              .filter(F.array_contains("needs", F.col("o_order"))
                      & (F.col("o_start") <= F.col("stop") + scope)
                      & (F.col("o_stop") >= F.col("start") - scope))
              .select("key", F.struct("start", "order", "stop").alias("s")).distinct()
              .groupBy("key").agg(F.collect_list("s").alias("linked")))
    return (slim.join(small(cut(linked), BROADCAST_ROWS // 4), "key", "left")
            .select(F.col("id").alias(id_col), "key", F.array_sort("base").alias("base"),
                    F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN)))).alias("spans"))
            .withColumn("spans_text", _written(F.col("spans"))))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of ``scan_secrets``: one row per document row."""
    def count(order: int) -> Column:
        return F.size(F.filter("base", lambda s: s["order"] == order)).cast("long")

    found = scan_secrets(docs, id_col=id_col, text_col=text_col)
    return found.select(id_col, *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                        F.col("spans_text").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; same rows and columns.

    Spans are merged where they overlap.  Texts without a span, and null
    texts, come back unchanged.
    """
    names = docs.columns
    keyed = docs.withColumn("__key", text_key(F.col(text_col)))
    spans = (scan_secrets(docs, id_col=id_col, text_col=text_col).filter(F.size("spans") > 0)
             .select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
             .dropDuplicates(["__key"]))
    text, zero = F.col(text_col), F.lit(0)
    # what every span leaves before it: from the farthest end so far to its start
    reach = prefix(F.transform("__spans", lambda s: s["stop"]), zero, F.greatest)
    left = F.filter(F.zip_with("__spans", reach, lambda s, at: F.when(
        s["start"] >= at, F.struct(at.alias("from"), s["start"].alias("to")))), lambda x: x.isNotNull())

    def joined_up(parts: Column) -> Column:
        """Text of the parts, each before a mark; a run of parts is cut out of the text first, so
        that places are counted from its start."""
        def run(i: Column) -> Column:
            own = F.slice(parts, i, RUN)
            first, last = F.get(own, F.lit(0))["from"], F.element_at(own, -1)["to"]
            return let(F.struct(F.substring(text, first + 1, last - first).alias("text"), first.alias("first")), lambda r: F.array_join(
                F.transform(own, lambda x: F.concat(F.substring(r["text"], x["from"] - r["first"] + 1, x["to"] - x["from"]), F.lit(mark))), ""))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.size(parts), F.lit(RUN)), run), "")

    end = F.array_max(F.transform("__spans", lambda s: s["stop"]))
    clean = F.concat(let(left, joined_up), F.substring(text, end + 1, F.lit(2**31 - 1)))
    joined = keyed.join(small(cut(spans), BROADCAST_ROWS // 4), "__key", "left")
    return joined.withColumn(text_col, F.when(F.col("__spans").isNotNull(), clean).otherwise(text)).select(*names)
