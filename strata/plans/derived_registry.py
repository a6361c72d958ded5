"""Registry documents derived by Spark from ``orders`` and ``lineitem``.

The driver's tables hold no registry documents, so the whole registry pipeline
(bronze -> silver -> gold) runs on documents built from them, over whole tables:

* entity = order (``company_krs`` = zero-padded order key, source id = 2 x key);
  orders with status ``F`` also get a stale copy with a higher source id, which
  bronze must drop; priority ``1-...`` orders are written in the foreign dialect;
* registry entries = the order's lines (entry number = line number, so
  duplicates occur as they do in the data);
* history ``j`` takes the lines selected by rule ``j``; an interval runs from its
  line to the next line (by number) that is selected by the same rule or is a
  return (``l_returnflag = 'R'``) - a return ending has no successor and is an
  orphan for H1 to reopen;
* share issues and statute positions are grouped per return flag (nested arrays).

The oracle evaluates the SQL texts of rules and values directly on the tables. Spark
evaluates those of the rules; the values are computed from the lines in Arrow
batches, as the texts say. So the documents, the JSON round trip, dialect folding,
explode, repair and joins are all checked.
A group is always one order's lines: bounded by the order, not the table.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import contains_marker, rewrite_keys
from ..operators.layout import materialize
from ..session import fresh_path
from . import registry as R

CLOSER = "l_returnflag = 'R'"
STATUTE_RULE = len(R.HISTORIES)  # rule index of the statute positions
FOREIGNISE_RULES = (
    (r'"danePodmiotu":', '"danePodmiotuZagranicznego":'),
    (r'"siedzibaIAdres":', '"siedzibaIAdresPodmiotuZagranicznego":'),
)
STALE_DOCUMENT = '{"odpis":{}}'


def rule_sql(j: int) -> str:
    return f"(l_partkey + {j}) % 8 = 0"


def value_sql(key: str, j: int, i: int) -> str:
    """SQL text of the value stored under JSON ``key`` (field ``i`` of history ``j``)."""
    leaf = key.rsplit(".", 1)[-1]
    if leaf in R.BOOLEAN_KEYS:
        return f"(l_suppkey + {j + i}) % 2 = 0"
    return f"concat('{leaf}-', CAST((l_partkey + l_suppkey * {j + i + 1}) % 97 AS STRING))"


TIMELINE_SQL = {
    "opis": "concat(l_returnflag, l_linestatus)",
    "numerWpisu": "CAST(l_linenumber AS STRING)",
    "oznaczenieSaduDokonujacegoWpisu": "concat('SR', CAST(l_suppkey AS STRING))",
    "sygnaturaAktSprawyDotyczacejWpisu": "concat('P', CAST(l_partkey AS STRING))",
}
ISSUE_START_SQL = "CAST(l_partkey % 3 AS STRING)"
ISSUE_SQL = {
    "nazwaSeriiAkcji": "concat('S', CAST(l_partkey AS STRING))",
    "liczbaAkcjiWSerii": "CAST(l_suppkey AS STRING)",
    "czyAkcjeUprzywilejowaneLiczbaAkcjiRodzajUprzywilejowania": "concat(l_returnflag, CAST(l_linenumber AS STRING))",
}
STATUTE_KEY = "zawarcieZmianaUmowyStatutu"


#: What the documents need of a line; lines stand in this order inside an order, by descending number.
LINE_COLUMNS = ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
#: One bit per rule that selects the line, and the closer's bit above them: each is tested once per line.
LINE_RULES_SQL = " + ".join(
    f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END"
    for bit, rule in enumerate([*[rule_sql(j) for j in range(STATUTE_RULE + 1)], CLOSER])
)


def _struct_type(pairs: Mapping[str, T.DataType]) -> T.StructType:
    """Struct type from dotted keys: ``{"a.b": x, "c": y}`` -> ``struct<a: struct<b: x>, c: y>``."""
    heads: dict = {}
    for key, dtype in pairs.items():
        head, _, rest = key.partition(".")
        if rest:
            heads.setdefault(head, {})[rest] = dtype
        else:
            heads[head] = dtype
    return T.StructType([T.StructField(k, _struct_type(v) if isinstance(v, dict) else v) for k, v in heads.items()])


def _interval_type(keys: Sequence[str]) -> T.StructType:
    leaves = {k: T.BooleanType() if k.rsplit(".", 1)[-1] in R.BOOLEAN_KEYS else T.StringType() for k in keys}
    return _struct_type({**leaves, R.START_KEY: T.StringType(), R.END_KEY: T.StringType()})


def _document_type() -> T.StructType:
    parts: dict[str, T.DataType] = {
        f"{R.SECTION}.{path}": T.ArrayType(_interval_type([k for _, k in fields])) for _, path, fields, _ in R.HISTORIES
    }
    statute = T.StructType([T.StructField("pozycja", T.ArrayType(_interval_type([STATUTE_KEY])))])
    parts[f"{R.SECTION}.umowaStatut.informacjaOZawarciuZmianieUmowyStatutu"] = T.ArrayType(statute)
    issued = {k: T.ArrayType(_struct_type({k: T.StringType(), R.START_KEY: T.StringType()})) for k in ISSUE_SQL}
    parts[f"{R.SECTION}.emisjeAkcji"] = T.ArrayType(_struct_type(issued))
    parts[R.TIMELINE_PATH] = T.ArrayType(_struct_type(dict.fromkeys([*TIMELINE_SQL, "dataWpisu"], T.StringType())))
    return _struct_type(parts)


def _document(lines: Column) -> Column:
    """The document of an order as a struct, made of whole batches of orders at a time in Arrow: an expression over
    the array of lines would be interpreted line by line, history by history. The function brings all it needs
    along, so that workers import nothing of this package."""
    rules = [(f"{R.SECTION}.{path}", [k for _, k in fields]) for _, path, fields, _ in R.HISTORIES]
    section, timeline_path, start_key, end_key = R.SECTION, R.TIMELINE_PATH, R.START_KEY, R.END_KEY
    booleans, statute_rule, statute_key = R.BOOLEAN_KEYS, STATUTE_RULE, STATUTE_KEY
    series_key, count_key, preference_key = ISSUE_SQL
    leaf_texts: dict = {}

    def made(lines):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        no_lines, orders = pc.is_null(lines), len(lines)
        flat = lines.flatten()
        number, part, supp, flag, status, day, bits = flat.flatten()
        count, row = len(flat), np.repeat(np.arange(orders), sizes)
        at, row_start = np.arange(count), np.repeat(np.cumsum(sizes) - sizes, sizes)

        def known(values):
            return pc.is_valid(values).to_numpy(zero_copy_only=False)

        def ints(values):
            return pc.fill_null(values.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)

        def some(places, found):
            return pa.array(places, pa.int64(), mask=~found)

        def joined(*texts):
            return pc.binary_join_element_wise(*texts, "")

        def struct(pairs):
            heads: dict = {}
            for key, values in pairs.items():
                head, _, rest = key.partition(".")
                if rest:
                    heads.setdefault(head, {})[rest] = values
                else:
                    heads[head] = values
            return pa.StructArray.from_arrays([struct(v) if isinstance(v, dict) else v for v in heads.values()], list(heads))

        def lists(of, total, elements, missing=None):
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=total))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), elements, mask=missing)

        n, n_known, n_text, rule_bits = ints(number), known(number), number.cast(pa.string()), ints(bits)
        part_text, supp_text = part.cast(pa.string()), supp.cast(pa.string())
        # lines stand by descending number, without a number last: the first line of every run of equal numbers
        new = np.ones(count, bool)
        new[1:] = (row[1:] != row[:-1]) | (n[1:] != n[:-1]) | (n_known[1:] != n_known[:-1])
        run_start = np.maximum.accumulate(np.where(new, at, 0)) if count else at

        def value(key, shift, picked):
            leaf, of_supp = key.rsplit(".", 1)[-1], supp.take(picked)
            if leaf in booleans:
                return pc.equal(pc.bit_wise_and(pc.add_checked(of_supp.cast(pa.int64()), shift), 1), 0)
            x = pc.add_checked(part.take(picked).cast(pa.int64()), pc.multiply_checked(of_supp.cast(pa.int64()), shift + 1))
            if leaf not in leaf_texts:
                leaf_texts[leaf] = [f"{leaf}-{r}" for r in range(-96, 97)]
            return pa.array(leaf_texts[leaf], pa.string()).take(some(np.fmod(ints(x), 97) + 96, known(x)))

        def intervals(j, keys, lines_at):
            """Each ends at the smallest larger number of a line that the rule selects or that closes; without a number
            of its own, at the smallest of all."""
            ending = ((rule_bits & (1 << j | 1 << statute_rule + 1)) != 0) & n_known
            last = np.concatenate([[-1], np.maximum.accumulate(np.where(ending, at, -1))]) if count else np.array([-1])
            end = last[np.where(n_known[lines_at], run_start[lines_at], lines_at + 1)]
            picked = pa.array(lines_at, pa.int64())
            values = {k: value(k, j + i, picked) for i, k in enumerate(keys)}
            ends = n_text.take(some(end, end >= row_start[lines_at]))
            return struct({**values, start_key: n_text.take(picked), end_key: ends})

        parts = {}
        for j, (path, keys) in enumerate(rules):
            selected = np.flatnonzero(rule_bits & (1 << j))
            parts[path] = lists(row[selected], orders, intervals(j, keys, selected), no_lines)

        # groups: the lines of an order by flag, flags in the order of their first lines; no line has the flag NULL
        codes = flag.dictionary_encode()
        code = pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        _, first, which = np.unique(row * (len(codes.dictionary) + 1) + code, return_index=True, return_inverse=True)
        by_group = np.argsort(first[which], kind="stable")
        firsts = np.sort(first)
        group = np.searchsorted(firsts, first[which])
        flagged = by_group[code[by_group] > 0]
        in_statute = flagged[(rule_bits[flagged] & (1 << statute_rule)) != 0]

        def grouped(pairs):
            return lists(row[firsts], orders, struct(pairs), no_lines)

        positions = lists(group[in_statute], len(firsts), intervals(statute_rule, [statute_key], in_statute))
        parts[f"{section}.umowaStatut.informacjaOZawarciuZmianieUmowyStatutu"] = grouped({"pozycja": positions})
        picked = pa.array(flagged, pa.int64())
        thirds = np.fmod(ints(part.take(picked)), 3) + 2
        start = pa.array([str(r) for r in range(-2, 3)]).take(some(thirds, known(part.take(picked))))
        issued = {series_key: joined("S", part_text), count_key: supp_text, preference_key: joined(flag, n_text)}
        parts[f"{section}.emisjeAkcji"] = grouped({
            k: lists(group[flagged], len(firsts), struct({k: texts.take(picked), start_key: start}))
            for k, texts in issued.items()
        })

        days = day.dictionary_encode()
        dates = []
        for d in days.dictionary.cast(pa.int32()).to_pylist():
            year, month, of_month = str(np.datetime64(d, "D")).rsplit("-", 2)
            year = int(year) if int(year) > 0 else 1 - int(year)
            dates.append(f"{of_month}.{month}.{'+' if year > 9999 else ''}{year:04}")
        parts[timeline_path] = lists(row, orders, struct({
            "opis": joined(flag, status),
            "numerWpisu": n_text,
            "oznaczenieSaduDokonujacegoWpisu": joined("SR", supp_text),
            "sygnaturaAktSprawyDotyczacejWpisu": joined("P", part_text),
            "dataWpisu": pa.array(dates, pa.string()).take(days.indices),
        }), no_lines)
        return struct(parts)

    return F.arrow_udf(made, _document_type())(lines)


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, krs_number)`` of the source rows, one or two per order, with what :func:`document_text` is made of.

    The lines of an order are one array of narrow structs: only these are shuffled, grouped and joined. All that a
    document holds besides is computed from the array, row by row, so that no wide row is in a sort or a buffer.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", *LINE_COLUMNS[:-1], F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.expr(LINE_RULES_SQL).alias("l_rules"),
    )
    # dealt by order before the aggregate: nothing is combined, and sorted, before the shuffle
    per_order = lines.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(*LINE_COLUMNS, "l_rules")), asc=False).alias("lines")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    key, krs = F.col("o_orderkey"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("krs_number")
    foreign = F.col("o_orderpriority").startswith("1").alias("foreign")
    # ids are computed before the join with the lines, and columns only named after it: Catalyst then moves a filter
    # on the ids below that join
    current = orders.select((key * 2).alias("id"), krs, key, foreign, F.lit(False).alias("stale"))
    current = current.join(per_order, current.o_orderkey == per_order.l_orderkey, "left")
    stale = orders.where(F.col("o_orderstatus") == "F").select(
        (key * 2 + 1).alias("id"), krs, key, foreign, F.lit(True).alias("stale")
    )
    names = ["id", "krs_number", "foreign", "stale", "lines"]
    return current.select(*names).unionByName(stale.select(*names[:-1]), allowMissingColumns=True)


def document_text() -> Column:
    """The JSON text of a row of :func:`source_rows`."""
    text = F.to_json(_document(F.col("lines")))
    text = F.when(F.col("foreign"), rewrite_keys(text, FOREIGNISE_RULES)).otherwise(text)
    return F.when(F.col("stale"), F.lit(STALE_DOCUMENT)).otherwise(text)


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, krs_number, raw_data)`` source rows, one or two per order."""
    return source_rows(spark, sf_dir).select("id", "krs_number", document_text().alias("raw_data"))


def bronze_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`registry.bronze` of :func:`raw_documents`, with the texts of the kept rows only."""
    return R.bronze(source_rows(spark, sf_dir), json_col=document_text())


# ------------------------------------------------------------------ queries


#: The staged parse is read once or twice: its some 70 short text columns are not worth a dictionary each.
PLAIN = {"parquet.enable.dictionary": "false"}


def parsed_documents(
    spark: SparkSession, sf_dir: str, stage: bool = True, names: Collection[str] | None = None, path: str | None = None
) -> DataFrame:
    """Bronze + dialect folding + parse; staged once in the shared folder like :func:`registry.run`.

    Without the stage every silver branch of a gold plan would rebuild and re-parse
    the documents; with it each branch scans only its own nested column. With ``names`` only the arrays
    of these silver tables are kept.
    """
    parsed = R.normalise(bronze_documents(spark, sf_dir))
    if names is not None:
        parsed = R.narrowed(parsed, names)
    return materialize(parsed, path, options=PLAIN) if stage else parsed


def silver_tables(
    spark: SparkSession, sf_dir: str, stage: bool = True, names: Collection[str] | None = None
) -> dict[str, DataFrame]:
    return R.silver(None, parsed=parsed_documents(spark, sf_dir, stage, names), names=names)


def full_history_tie_break() -> list[str]:
    return [c for c in FULL_HISTORY_COLUMNS if c not in ("company_krs", "entry_number")]


def q_registry_bronze(spark, sf_dir):
    b = bronze_documents(spark, sf_dir)
    return b.select("source_id", "company_krs", contains_marker("raw_json", R.FOREIGN_MARKER).alias("is_foreign"))


def q_registry_timeline(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["registry"]


def q_registry_address(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["address"]


def q_registry_identifiers(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["identifiers"]


def q_registry_opp_status(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["has_opp_status"]


def q_registry_statute(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["statute_change"]


def q_registry_share_units(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["total_shares_units"]


def q_registry_share_series(spark, sf_dir):
    return silver_tables(spark, sf_dir, stage=False)["share_issues_series_name"]


def q_registry_full_history(spark, sf_dir):
    names = R.FULL_HISTORY_TABLES
    path = fresh_path(spark, "parsed")
    parsed = parsed_documents(spark, sf_dir, names=names, path=path)
    tables, repaired = R.silver(None, parsed=parsed, names=names), R.repaired_in_documents(parsed)
    return R.full_history(tables, repaired=repaired, hashed=R.fits_hashed(spark, path))


def q_registry_shares_issues(spark, sf_dir):
    return R.shares_issues(silver_tables(spark, sf_dir, names=R.SHARES_ISSUES_TABLES))


def q_registry_amendments(spark, sf_dir):
    return R.amendments(silver_tables(spark, sf_dir, names=["statute_change"]))


def q_registry_current_info(spark, sf_dir):
    names = R.FULL_HISTORY_TABLES
    path = fresh_path(spark, "parsed")
    parsed = parsed_documents(spark, sf_dir, names=names, path=path)
    tables, repaired = R.silver(None, parsed=parsed, names=names), R.repaired_in_documents(parsed)
    return R.current_info_direct(tables, full_history_tie_break(), repaired, R.fits_hashed(spark, path))


QUERIES = {
    "registry_bronze": q_registry_bronze,
    "registry_timeline": q_registry_timeline,
    "registry_address": q_registry_address,
    "registry_identifiers": q_registry_identifiers,
    "registry_opp_status": q_registry_opp_status,
    "registry_statute": q_registry_statute,
    "registry_share_units": q_registry_share_units,
    "registry_share_series": q_registry_share_series,
    "registry_full_history": q_registry_full_history,
    "registry_shares_issues": q_registry_shares_issues,
    "registry_amendments": q_registry_amendments,
    "registry_current_info": q_registry_current_info,
}

#: The silver tables whose query has a name of its own above.
_NAMED = {
    "registry", "address", "identifiers", "has_opp_status", "statute_change", "total_shares_units",
    "share_issues_series_name",
}


def _silver_query(table: str):
    def query(spark, sf_dir):
        return silver_tables(spark, sf_dir, stage=False)[table]

    return query


SILVER = [s.name for s in R.silver_specs() if s.name not in _NAMED]
QUERIES |= {f"registry_{name}": _silver_query(name) for name in SILVER}


# ------------------------------------------------------------------ oracle SQL (DuckDB)


def _out_columns(j: int) -> list[tuple[str, str]]:
    """(silver column, value SQL) of history ``j``."""
    _, _, fields, _ = R.HISTORIES[j]
    return [(col, value_sql(key, j, i)) for i, (col, key) in enumerate(fields)]


FULL_HISTORY_COLUMNS = list(R.TIMELINE_OUTPUT) + [
    f"{prefix}_{c}" if prefix else c for _, cols, prefix in R.GOLD_JOINS for c in cols
]


def _ctes() -> str:
    n = STATUTE_RULE + 1
    rules = ", ".join(f"{rule_sql(j)} AS k{j}" for j in range(n))
    ends = ", ".join(f"min(CASE WHEN k{j} OR closer THEN l_linenumber END) OVER w AS e{j}" for j in range(n))
    parts = [
        "company AS (SELECT o_orderkey, 2 * o_orderkey AS source_id, "
        "lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS company_krs, o_orderpriority FROM orders)",
        f"lines0 AS (SELECT l.*, c.source_id, c.company_krs, {rules}, {CLOSER} AS closer "
        "FROM lineitem l JOIN company c ON c.o_orderkey = l.l_orderkey)",
        f"lines AS (SELECT *, {ends} FROM lines0 "
        "WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))",
        "tl AS (SELECT source_id, company_krs, concat(l_returnflag, l_linestatus) AS description, "
        "CAST(l_shipdate AS DATE) AS entry_date, l_linenumber AS entry_number, "
        "concat('SR', CAST(l_suppkey AS STRING)) AS court_designation, "
        "concat('P', CAST(l_partkey AS STRING)) AS case_file_designation FROM lines)",
    ]
    for j, (name, _, _, outer) in enumerate(R.HISTORIES):
        cols = _out_columns(j)
        body = ", ".join(f"{v} AS {c}" for c, v in cols)
        sql = (f"SELECT source_id, company_krs, {body}, l_linenumber AS valid_from_entry, "
               f"e{j} AS valid_to_entry FROM lines WHERE k{j}")
        if outer:
            nulls = ", ".join(f"NULL AS {c}" for c, _ in cols)
            sql += (f" UNION ALL SELECT c.source_id, c.company_krs, {nulls}, NULL, NULL FROM company c "
                    f"WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.l_orderkey = c.o_orderkey AND l.k{j})")
        parts.append(f"h{j} AS ({sql})")
        parts.append(_repaired(f"h{j}", f"r{j}", [c for c, _ in cols]))
    statute = value_sql(STATUTE_KEY, STATUTE_RULE, 0)
    parts.append(
        f"hs AS (SELECT source_id, company_krs, {statute} AS change_or_amendment_of_statue_agreement, "
        f"l_linenumber AS valid_from_entry, e{STATUTE_RULE} AS valid_to_entry FROM lines WHERE k{STATUTE_RULE})"
    )
    parts.append(_repaired("hs", "rs", ["change_or_amendment_of_statue_agreement"]))
    for alias, (key, col) in zip("scp", zip(ISSUE_SQL, ("series_name", "shares_in_series", "preference_info"))):
        parts.append(
            f"issue_{alias} AS (SELECT source_id, company_krs, {ISSUE_SQL[key]} AS {col}, "
            f"CAST(l_partkey % 3 AS INTEGER) AS valid_from_entry, CAST(NULL AS INTEGER) AS valid_to_entry FROM lines "
            f"UNION ALL SELECT c.source_id, c.company_krs, NULL, NULL, NULL FROM company c "
            "WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.l_orderkey = c.o_orderkey))"
        )
    return "WITH " + ",\n".join(parts)


def _repaired(src: str, dst: str, cols: list[str]) -> str:
    payload = ", ".join(f"h.{c}" for c in cols)
    return (
        f"{dst} AS (SELECT h.source_id, h.company_krs, {payload}, h.valid_from_entry, "
        f"CASE WHEN EXISTS (SELECT 1 FROM {src} s WHERE s.company_krs = h.company_krs "
        "AND s.valid_from_entry = h.valid_to_entry) THEN h.valid_to_entry END AS valid_to_entry "
        f"FROM {src} h)"
    )


def _full_history_sql() -> str:
    index = {name: j for j, (name, _, _, _) in enumerate(R.HISTORIES)}
    select = [f"tl.{c}" for c in R.TIMELINE_OUTPUT]
    joins = []
    for table_name, cols, prefix in R.GOLD_JOINS:
        a = f"r{index[table_name]}"
        select += [f"{a}.{c} AS {prefix + '_' + c if prefix else c}" for c in cols]
        joins.append(
            f"LEFT JOIN {a} ON {a}.company_krs = tl.company_krs AND {a}.valid_from_entry <= tl.entry_number "
            f"AND ({a}.valid_to_entry IS NULL OR {a}.valid_to_entry > tl.entry_number)"
        )
    return f"SELECT {', '.join(select)} FROM tl\n" + "\n".join(joins)


def oracle_sql() -> dict[str, str]:
    ctes = _ctes()
    full = _full_history_sql()
    tie = ", ".join(f"{c} DESC NULLS LAST" for c in full_history_tie_break())
    units = {name: j for j, (name, _, _, _) in enumerate(R.HISTORIES)}["total_shares_units"]
    index = {name: j for j, (name, _, _, _) in enumerate(R.HISTORIES)}
    address = index["address"]
    source = {name: f"h{j}" for name, j in index.items()}
    source |= {"share_issues_shares_in_series": "issue_c", "share_issues_preference_info": "issue_p"}
    return {f"registry_{name}": f"{ctes}\nSELECT * FROM {source[name]}" for name in SILVER} | {
        "registry_bronze": "SELECT 2 * o_orderkey AS source_id, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS company_krs, "
        "o_orderpriority LIKE '1%' AS is_foreign FROM orders",
        "registry_timeline": f"{ctes}\nSELECT * FROM tl",
        "registry_address": f"{ctes}\nSELECT * FROM h{address}",
        "registry_identifiers": f"{ctes}\nSELECT * FROM h{index['identifiers']}",
        "registry_opp_status": f"{ctes}\nSELECT * FROM h{index['has_opp_status']}",
        "registry_statute": f"{ctes}\nSELECT * FROM hs",
        "registry_share_units": f"{ctes}\nSELECT * FROM h{units}",
        "registry_share_series": f"{ctes}\nSELECT * FROM issue_s",
        "registry_full_history": f"{ctes}\n{full}",
        "registry_shares_issues": f"{ctes}\nSELECT s.source_id, s.company_krs, s.series_name, s.valid_from_entry, "
        "s.valid_to_entry, c.shares_in_series, p.preference_info FROM issue_s s "
        "LEFT JOIN issue_c c ON c.company_krs = s.company_krs AND c.valid_from_entry = s.valid_from_entry "
        "LEFT JOIN issue_p p ON p.company_krs = s.company_krs AND p.valid_from_entry = s.valid_from_entry",
        "registry_amendments": f"{ctes}\nSELECT * FROM rs",
        "registry_current_info": f"{ctes}\nSELECT * FROM ({full}) f QUALIFY row_number() OVER "
        f"(PARTITION BY company_krs ORDER BY entry_number DESC NULLS LAST, {tie}) = 1",
    }
