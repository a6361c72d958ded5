"""The operators applied to the driver's test tables (events, orders, lineitem, ...).

The test tables hold no registry documents, so each recipe maps one operator
onto data of the same shape, derived by Spark from the given tables:

* timeline: ``events`` numbered per user by time (``entry_number``);
* histories: events of one type, valid from their own entry to the next entry
  of that type *or* an ``error`` (an error ending is an orphan, reopened by H1);
* order documents: one JSON string per order, with nested shipments, lines and
  share-issue-like lists, built from ``orders`` and ``lineitem``.

Every recipe reads whole tables; none filters ids or caps rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.documents import contains_marker, parse_date, parse_int, parse_json, rewrite_keys
from ..operators.asof import AsOfSpec, interval_chain, interval_join, start_match_chain, start_match_join
from ..operators.history import Field, HistorySpec, distinct_starts, explode_history, reopen_orphans
from ..operators.layout import materialize
from ..operators.ranking import first_per_key, latest_per_key
from ..session import fresh_path
from ..sources.tables import read_clustered, read_table, write_table

USER = ["user_id"]
ORDER = ["o_orderkey"]
TIMELINE_COLS = ["user_id", "event_id", "ts", "event_type", "entry_number"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- timeline and histories


_MID = "__strata_mid"


def number_within_key(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order)`` without a per-key task.

    A range sort on ``(key, *order)`` splits a heavy key over many partitions;
    ``monotonically_increasing_id`` then grows with the global order and is dense
    within each partition. The ids are written once to the shared folder (so every
    consumer sees the same ids), each (key, partition) run gets its count and first
    id, and a row's number is the rows of its key in earlier partitions plus its
    place in the run. ``order`` must make rows unique within the key.
    """
    ordered = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    tagged = materialize(ordered.withColumn(_MID, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(_MID), 33).alias("__strata_part")
    runs = tagged.groupBy(key, part).agg(F.count("*").alias("__strata_n"), F.min(_MID).alias("__strata_first"))
    earlier = Window.partitionBy(key).orderBy("__strata_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__strata_before", F.coalesce(F.sum("__strata_n").over(earlier), F.lit(0)))
    joined = tagged.withColumn("__strata_part", part).join(runs, [key, "__strata_part"])
    number = (F.col("__strata_before") + F.col(_MID) - F.col("__strata_first") + 1).cast("int")
    return joined.select(*df.columns, number.alias(name))


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered 1..n per user in (ts, event_id) order."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return number_within_key(ev, "user_id", ["ts", "event_id"], "entry_number")


def event_history(tl: DataFrame, kind: str, closer: str = "error") -> DataFrame:
    """Intervals of ``kind`` events: [own entry, next ``kind``-or-``closer`` entry).

    The marked events are ranked per user and each is joined to the one ranked
    next, an equi-join on ``(user, rank)``.
    """
    marks = tl.where(F.col("event_type").isin(kind, closer)).select("user_id", "event_id", "value", "event_type", "entry_number")
    ranked = number_within_key(marks, "user_id", ["entry_number"], "__strata_rank")
    successors = ranked.select(
        "user_id", (F.col("__strata_rank") - 1).alias("__strata_rank"), F.col("entry_number").alias("valid_to_entry")
    )
    own = ranked.where(F.col("event_type") == kind)
    return own.join(successors, ["user_id", "__strata_rank"], "left").select(
        "user_id", "event_id", "value", F.col("entry_number").alias("valid_from_entry"), "valid_to_entry"
    )


def click_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_history(timeline(spark, sf_dir), "click")


# ---------------------------------------------------------------- order documents

# Schema of the derived order documents, parsed back with from_json.
LINE_DDL = (
    "line STRING, part BIGINT, supplier BIGINT, quantity DOUBLE, shipped STRING, until STRING, issued STRING"
)
ORDER_DOC_DDL = (
    "header STRUCT<key: BIGINT, customer: BIGINT, status: STRING, placed: STRING>, "
    f"shipments ARRAY<STRUCT<flag: STRING, lines: ARRAY<STRUCT<{LINE_DDL}>>>>, "
    f"items ARRAY<STRUCT<{LINE_DDL}>>, "
    "issues ARRAY<STRUCT<series: ARRAY<STRUCT<name: STRING, since: STRING>>, "
    "counts: ARRAY<STRUCT<count: STRING, since: STRING>>, "
    "preferences: ARRAY<STRUCT<pref: STRING, since: STRING>>>>"
)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, raw_json)``: one document per order (orders without lines have no arrays).

    Lines are collected per order (a group is one order's lines - bounded by the
    order, never by the table) and split by return flag inside that list.
    """
    li = table(spark, sf_dir, "lineitem")
    line = F.struct(
        F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"),
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("shipped"),
        (F.col("l_linenumber") + 2).cast("string").alias("until"),
        (F.col("l_partkey") % 3).cast("string").alias("issued"),
    )
    # one aggregation per order; the per-flag grouping happens inside the order's (bounded) list
    per_order = li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_returnflag").alias("flag"), line.alias("line"))).alias("flagged")
    )
    flags = F.array_distinct(F.transform(F.col("flagged"), lambda x: x["flag"]))
    shipments = F.transform(flags, lambda f: F.struct(
        f.alias("flag"),
        F.transform(F.filter(F.col("flagged"), lambda x: x["flag"] == f), lambda x: x["line"]).alias("lines"),
    ))

    def issue(s):
        lines = s["lines"]
        return F.struct(
            F.transform(lines, lambda x: F.struct(
                F.concat(F.lit("S"), x["part"].cast("string")).alias("name"), x["issued"].alias("since")
            )).alias("series"),
            F.transform(lines, lambda x: F.struct(
                x["supplier"].cast("string").alias("count"), x["issued"].alias("since")
            )).alias("counts"),
            F.transform(lines, lambda x: F.struct(
                F.concat(s["flag"], x["line"]).alias("pref"), x["issued"].alias("since")
            )).alias("preferences"),
        )

    orders = table(spark, sf_dir, "orders")
    doc = F.struct(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.col("o_custkey").alias("customer"),
            F.col("o_orderstatus").alias("status"),
            F.date_format("o_orderdate", "dd.MM.yyyy").alias("placed"),
        ).alias("header"),
        shipments.alias("shipments"),
        F.transform(F.col("flagged"), lambda x: x["line"]).alias("items"),
        F.transform(shipments, issue).alias("issues"),
    )
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left").select(
        "o_orderkey", F.to_json(doc).alias("raw_json")
    )


def parsed_orders(spark: SparkSession, sf_dir: str, stage: bool = False) -> DataFrame:
    """Parsed order documents; ``stage`` writes them once to the shared folder for
    queries that read several branches (each branch then scans only its column)."""
    parsed = parse_json(order_documents(spark, sf_dir), "raw_json", ORDER_DOC_DDL)
    return materialize(parsed) if stage else parsed


LINE_FIELDS = (
    Field("part_key", "part"),
    Field("quantity", "quantity"),
    Field("ship_date", "shipped", kind="date"),
)
ITEMS = HistorySpec("items", ("items",), LINE_FIELDS, start="line")
ITEMS_OUTER = HistorySpec("items_outer", ("items",), LINE_FIELDS, outer=True, start="line")
LINES_NESTED = HistorySpec("lines", ("shipments", "lines"), LINE_FIELDS, start="line")
LINES_NESTED_OUTER = HistorySpec("lines_outer", ("shipments", "lines"), LINE_FIELDS, outer=True, start="line")
AMENDMENTS = HistorySpec("amendments", ("shipments", "lines"), (Field("part_key", "part"),), start="line", end="until")
SERIES = HistorySpec("series", ("issues", "series"), (Field("series_name", "name"),), outer=True, start="since")
COUNTS = HistorySpec("counts", ("issues", "counts"), (Field("shares_in_series", "count"),), outer=True, start="since")
PREFERENCES = HistorySpec(
    "preferences", ("issues", "preferences"), (Field("preference_info", "pref"),), outer=True, start="since"
)


def _explode(spark, sf_dir, spec: HistorySpec, stage: bool = False) -> DataFrame:
    return explode_history(parsed_orders(spark, sf_dir, stage), spec, carry=ORDER)


# ---------------------------------------------------------------- queries (one per operator)


def q_source_filter(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/events.parquet", source_filter=F.col("event_type") == "purchase")


def q_table_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "nation")
    write_table(table(spark, sf_dir, "nation"), path)
    return read_table(spark, path)


def q_clustered_scan(spark, sf_dir):
    return read_clustered(spark, f"{sf_dir}/orders.parquet", ["o_custkey"], ["o_custkey", "o_orderdate"], 8)


def q_rename_project(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("source_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("segment"),
    )


def q_nested_project(spark, sf_dir):
    d = parsed_orders(spark, sf_dir)
    return d.select(
        "o_orderkey",
        F.col("data.header.customer").alias("customer_key"),
        F.col("data.header.status").alias("status"),
        parse_date(F.col("data.header.placed")).alias("placed"),
    )


def q_dialect_flag(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", contains_marker("html", 'lang="fr"').alias("is_foreign"))


# Rules of the dialect test on events.props: first make a foreign key, then normalise it back.
# A specific rule precedes the generic one, so "kValueForeign" becomes "k", not "kValue".
FOREIGN_RULES = [(r'"k"\s*:', '"kValueForeign":')]
NORMALISE_RULES = [(r'"kValueForeign"\s*:', '"k":'), (r'"([a-zA-Z]+)Foreign"\s*:', '"$1":')]


def q_dialect_normalise(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", rewrite_keys("props", FOREIGN_RULES).alias("foreign_props"))
    return ev.select(
        "event_id",
        "foreign_props",
        contains_marker("foreign_props", "Foreign").alias("is_foreign"),
        rewrite_keys("foreign_props", NORMALISE_RULES).alias("props"),
    )


def q_json_parse(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_json(ev, "props", "k INT", into="parsed").select("event_id", F.col("parsed.k").alias("k"))


def q_date_parse(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("txt"))
    return o.select("o_orderkey", parse_date("txt").alias("order_date"))


def q_safe_cast_int(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        parse_int(F.substring_index("o_orderpriority", "-", 1), on_error="null").alias("priority_rank"),
        parse_int("o_orderstatus", on_error="null").alias("status_code"),
    )


def q_explode_history(spark, sf_dir):
    return _explode(spark, sf_dir, ITEMS)


def q_explode_nested(spark, sf_dir):
    return _explode(spark, sf_dir, LINES_NESTED)


def q_explode_outer_history(spark, sf_dir):
    return _explode(spark, sf_dir, ITEMS_OUTER)


def q_explode_outer_nested(spark, sf_dir):
    return _explode(spark, sf_dir, LINES_NESTED_OUTER)


def q_distinct_starts(spark, sf_dir):
    return distinct_starts(click_history(spark, sf_dir), USER)


def q_dedupe_first(spark, sf_dir):
    return first_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"])


def q_latest_per_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", tie_break=["o_orderkey"])


def q_reopen_orphans(spark, sf_dir):
    return reopen_orphans(click_history(spark, sf_dir), USER)


def _asof_base(tl: DataFrame) -> DataFrame:
    return tl.select(*TIMELINE_COLS)


def q_asof_interval(spark, sf_dir):
    tl = timeline(spark, sf_dir)
    hist = reopen_orphans(event_history(tl, "click"), USER)
    return interval_join(_asof_base(tl), hist, ["value"], keys=USER)


def q_asof_prefixed(spark, sf_dir):
    tl = timeline(spark, sf_dir)
    hist = reopen_orphans(event_history(tl, "click"), USER)
    return interval_join(_asof_base(tl), hist, ["event_id", "value"], prefix="click", keys=USER)


def _issue_lists(spark, sf_dir):
    d = parsed_orders(spark, sf_dir, stage=True)
    return [explode_history(d, s, carry=ORDER) for s in (SERIES, COUNTS, PREFERENCES)]


def q_start_match_join(spark, sf_dir):
    series, counts, _ = _issue_lists(spark, sf_dir)
    return start_match_join(series, counts, ["shares_in_series"], keys=ORDER)


def q_issue_chain(spark, sf_dir):
    series, counts, prefs = _issue_lists(spark, sf_dir)
    specs = [AsOfSpec(counts, ("shares_in_series",)), AsOfSpec(prefs, ("preference_info",))]
    return start_match_chain(series, specs, keys=ORDER)


def q_amendments(spark, sf_dir):
    return reopen_orphans(_explode(spark, sf_dir, AMENDMENTS, stage=True), ORDER)


HISTORY_KINDS = ("click", "view", "signup")


def q_full_history(spark, sf_dir):
    tl = timeline(spark, sf_dir)
    specs = [
        AsOfSpec(reopen_orphans(event_history(tl, kind), USER), ("event_id", "value"), kind) for kind in HISTORY_KINDS
    ]
    return interval_chain(_asof_base(tl), specs, keys=USER)


def q_current_info(spark, sf_dir):
    full = q_full_history(spark, sf_dir)
    return latest_per_key(full, USER, "entry_number", tie_break=[f"{k}_event_id" for k in HISTORY_KINDS])


QUERIES = {
    "source_filter": q_source_filter,
    "table_roundtrip": q_table_roundtrip,
    "clustered_scan": q_clustered_scan,
    "rename_project": q_rename_project,
    "nested_project": q_nested_project,
    "dialect_flag": q_dialect_flag,
    "dialect_normalise": q_dialect_normalise,
    "json_parse": q_json_parse,
    "date_parse": q_date_parse,
    "safe_cast_int": q_safe_cast_int,
    "explode_history": q_explode_history,
    "explode_nested": q_explode_nested,
    "explode_outer_history": q_explode_outer_history,
    "explode_outer_nested": q_explode_outer_nested,
    "distinct_starts": q_distinct_starts,
    "dedupe_first": q_dedupe_first,
    "latest_per_key": q_latest_per_key,
    "reopen_orphans": q_reopen_orphans,
    "asof_interval": q_asof_interval,
    "asof_prefixed": q_asof_prefixed,
    "start_match_join": q_start_match_join,
    "issue_chain": q_issue_chain,
    "amendments": q_amendments,
    "full_history": q_full_history,
    "current_info": q_current_info,
}
