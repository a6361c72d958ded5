"""The entity-registry pipeline: raw documents -> one per entity -> 21 tables -> gold outputs.

* bronze (T1): rename the source columns, keep one document per entity;
* silver (T2): fold the foreign dialect into the domestic one, parse once with
  the fixed schema, explode the timeline and 20 histories (spec-driven);
* gold (T3-T6): repair orphaned interval ends, attach 16 histories to the
  timeline with the interval as-of join, rebuild share issues by start match,
  and take the latest row per entity.

Everything is lazy; :func:`run` materialises the outputs.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import contains_marker, parse_json, rewrite_keys
from ..operators.asof import BIN_ROWS, AsOfSpec, interval_chain, start_match_chain
from ..operators.history import Field, HistorySpec, explode_history, reopen_orphans
from ..operators.layout import cluster, materialize
from ..operators.ranking import first_per_key_late, latest_per_key
from ..session import fresh_path, staging, stored_bytes
from ..sources.tables import read_table, write_table

KEY = "company_krs"
SOURCE_ID = "source_id"
CARRY = (SOURCE_ID, KEY)

# ------------------------------------------------------------------ fixed values
# JSON keys of the registry documents and the dialect rewrite rules. These must
# equal the keys used by the source documents; they are data, not logic.
START_KEY = "nrWpisuWprow"  # entry number that opens a value
END_KEY = "nrWpisuWykr"  # entry number that removes it
TIMELINE_PATH = "odpis.naglowekP.wpis"
SECTION = "odpis.dane.dzial1"
FOREIGN_MARKER = "danePodmiotuZagranicznego"
DIALECT_RULES = (
    (r'"siedzibaIAdresPodmiotuZagranicznego"\s*:', '"siedzibaIAdres":'),
    (r'"([a-zA-Z]+)Zagranicznego"\s*:', '"$1":'),
)
# every dialect rule above matches only text that contains this suffix
FOREIGN_KEY_SUFFIX = 'Zagranicznego"'
ENTRY_DATE_FORMAT = "dd.MM.yyyy"

ADDRESS_KEYS = (
    ("country", "kraj"),
    ("street", "ulica"),
    ("house_number", "nrDomu"),
    ("flat_number", "nrLokalu"),
    ("post_office", "poczta"),
    ("postal_code", "kodPocztowy"),
    ("city", "miejscowosc"),
)
HEADQUARTERS_KEYS = (
    ("country", "kraj"),
    ("municipality", "gmina"),
    ("county", "powiat"),
    ("city", "miejscowosc"),
    ("voivodeship", "wojewodztwo"),
)

# (silver table, path under SECTION, ((output column, JSON key), ...), explode_outer)
HISTORIES = (
    ("names", "danePodmiotu.nazwa", (("company_name", "nazwa"),), False),
    ("identifiers", "danePodmiotu.identyfikatory",
     (("nip_number", "identyfikatory.nip"), ("regon_number", "identyfikatory.regon")), False),
    ("legal_form", "danePodmiotu.formaPrawna", (("legal_form", "formaPrawna"),), False),
    ("has_opp_status", "danePodmiotu.czyPosiadaStatusOPP", (("has_opp_status", "czyPosiadaStatusOPP"),), False),
    ("business_with_others", "danePodmiotu.czyProwadziDzialalnoscZInnymiPodmiotami",
     (("does_conduct_business_with_other_entities", "czyProwadziDzialalnoscZInnymiPodmiotami"),), False),
    ("address", "siedzibaIAdres.adres", ADDRESS_KEYS, False),
    ("headquarters", "siedzibaIAdres.siedziba", HEADQUARTERS_KEYS, False),
    ("webpage", "siedzibaIAdres.adresStronyInternetowej", (("webpage", "adresStronyInternetowej"),), False),
    ("email", "siedzibaIAdres.adresPocztyElektronicznej", (("email", "adresPocztyElektronicznej"),), False),
    ("electronic_bae_delivery", "siedzibaIAdres.adresDoDoreczenElektronicznychWpisanyDoBAE",
     (("electronic_bae_delivery", "adresDoDoreczenElektronicznychWpisanyDoBAE"),), False),
    ("main_hq_address", "siedzibaIAdres.siedzibaIAdresZakladuGlownego",
     ADDRESS_KEYS + (("voivodeship", "wojewodztwo"),), False),
    ("time_entity_created", "pozostaleInformacje.informacjaOCzasieNaJakiZostalUtworzonyPodmiot",
     (("time_for_which_entity_was_created", "czasNaJakiUtworzonyZostalPodmiot"),), False),
    ("share_capital_amount", "kapital.wysokoscKapitaluZakladowego",
     (("currency", "waluta"), ("share_capital_amount", "wartosc")), False),
    ("total_shares_units", "kapital.lacznaLiczbaAkcjiUdzialow",
     (("total_number_of_shares_units", "lacznaLiczbaAkcjiUdzialow"),), True),
    ("single_share_value", "kapital.wartoscJednejAkcji",
     (("currency", "waluta"), ("single_share_value", "wartosc")), True),
    ("paid_in_capital_part", "kapital.czescKapitaluWplaconegoPokrytego",
     (("currency", "waluta"), ("paid_in_capital_amount", "wartosc")), True),
)
# Nested histories: (silver table, outer path, inner key, ((column, key), ...), explode_outer, has end)
NESTED_HISTORIES = (
    ("statute_change", "umowaStatut.informacjaOZawarciuZmianieUmowyStatutu", "pozycja",
     (("change_or_amendment_of_statue_agreement", "zawarcieZmianaUmowyStatutu"),), False, True),
    ("share_issues_series_name", "emisjeAkcji", "nazwaSeriiAkcji",
     (("series_name", "nazwaSeriiAkcji"),), True, False),
    ("share_issues_shares_in_series", "emisjeAkcji", "liczbaAkcjiWSerii",
     (("shares_in_series", "liczbaAkcjiWSerii"),), True, False),
    ("share_issues_preference_info", "emisjeAkcji", "czyAkcjeUprzywilejowaneLiczbaAkcjiRodzajUprzywilejowania",
     (("preference_info", "czyAkcjeUprzywilejowaneLiczbaAkcjiRodzajUprzywilejowania"),), True, False),
)
TIMELINE_KEYS = (
    ("description", "opis"),
    ("entry_date", "dataWpisu"),
    ("entry_number", "numerWpisu"),
    ("court_designation", "oznaczenieSaduDokonujacegoWpisu"),
    ("case_file_designation", "sygnaturaAktSprawyDotyczacejWpisu"),
)
# Gold: (silver table, columns attached to the timeline, output prefix), in join order.
GOLD_JOINS = (
    ("names", ("company_name",), None),
    ("identifiers", ("nip_number", "regon_number"), None),
    ("legal_form", ("legal_form",), None),
    ("has_opp_status", ("has_opp_status",), None),
    ("business_with_others", ("does_conduct_business_with_other_entities",), None),
    ("address", tuple(c for c, _ in ADDRESS_KEYS), "address"),
    ("headquarters", tuple(c for c, _ in HEADQUARTERS_KEYS), "headquarters"),
    ("webpage", ("webpage",), None),
    ("email", ("email",), None),
    ("electronic_bae_delivery", ("electronic_bae_delivery",), None),
    ("main_hq_address", tuple(c for c, _ in ADDRESS_KEYS) + ("voivodeship",), "mainHeadquarters"),
    ("time_entity_created", ("time_for_which_entity_was_created",), None),
    ("share_capital_amount", ("currency", "share_capital_amount"), "shareCapitalAmount"),
    ("total_shares_units", ("total_number_of_shares_units",), None),
    ("single_share_value", ("currency", "single_share_value"), "singleShareValue"),
    ("paid_in_capital_part", ("currency", "paid_in_capital_amount"), "paidInCapitalPart"),
)
TIMELINE_OUTPUT = ("source_id", "company_krs", "entry_number", "entry_date", "court_designation", "case_file_designation")
BOOLEAN_KEYS = ("czyPosiadaStatusOPP", "czyProwadziDzialalnoscZInnymiPodmiotami")
# ------------------------------------------------------------------ end of fixed values


# ------------------------------------------------------------------ document schema


def _s(fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def _leaf(key: str) -> T.DataType:
    return T.BooleanType() if key in BOOLEAN_KEYS else T.StringType()


def _payload_type(keys: Sequence[str]) -> list[tuple[str, T.DataType]]:
    """Struct fields for JSON keys; dotted keys become nested structs."""
    out: dict[str, list[str] | None] = {}
    for key in keys:
        head, _, rest = key.partition(".")
        if rest:
            out.setdefault(head, []).append(rest)
        else:
            out[head] = None
    return [(k, _s(_payload_type(v)) if v else _leaf(k)) for k, v in out.items()]


def _interval_array(keys: Sequence[str], with_end: bool = True) -> T.ArrayType:
    bounds = [(START_KEY, T.StringType())] + ([(END_KEY, T.StringType())] if with_end else [])
    return T.ArrayType(_s(_payload_type(keys) + bounds))


def _insert(tree: dict, path: str, value: T.DataType | Column) -> None:
    *parents, leaf = path.split(".")
    for p in parents:
        tree = tree.setdefault(p, {})
    tree[leaf] = value


def _build(tree: dict) -> T.StructType:
    return _s([(k, _build(v) if isinstance(v, dict) else v) for k, v in tree.items()])


def document_schema() -> T.StructType:
    """The parse schema, assembled from the history table above (one source of truth)."""
    tree: dict = {}
    for _, path, fields, _ in HISTORIES:
        _insert(tree, f"{SECTION}.{path}", _interval_array([k for _, k in fields]))
    issues: dict[str, T.DataType] = {}
    for name, path, inner, fields, _, has_end in NESTED_HISTORIES:
        inner_type = _interval_array([k for _, k in fields], with_end=has_end)
        if path == "emisjeAkcji":
            issues[inner] = inner_type
        else:
            _insert(tree, f"{SECTION}.{path}", T.ArrayType(_s([(inner, inner_type)])))
    _insert(tree, f"{SECTION}.emisjeAkcji", T.ArrayType(_s(list(issues.items()))))
    _insert(tree, TIMELINE_PATH, T.ArrayType(_s([(k, T.StringType()) for _, k in TIMELINE_KEYS])))
    return _build(tree)


# ------------------------------------------------------------------ silver specs


def _fields(pairs) -> tuple[Field, ...]:
    return tuple(Field(col, key) for col, key in pairs)


def silver_specs() -> list[HistorySpec]:
    """The timeline and 20 history specs (21 silver tables)."""
    timeline_fields = tuple(
        Field(col, key, kind={"entry_date": "date", "entry_number": "int"}.get(col, "raw"), fmt=ENTRY_DATE_FORMAT)
        for col, key in TIMELINE_KEYS
    )
    specs = [HistorySpec("registry", (TIMELINE_PATH,), timeline_fields)]
    for name, path, fields, outer in HISTORIES:
        specs.append(HistorySpec(name, (f"{SECTION}.{path}",), _fields(fields), outer, START_KEY, END_KEY))
    for name, path, inner, fields, outer, has_end in NESTED_HISTORIES:
        specs.append(HistorySpec(
            name, (f"{SECTION}.{path}", inner), _fields(fields), outer, START_KEY, END_KEY if has_end else None
        ))
    return specs


# ------------------------------------------------------------------ stages


def bronze(
    raw: DataFrame,
    id_col: str = "id",
    key_col: str = "krs_number",
    json_col: str | Column = "raw_data",
    keep: str = "first",
) -> DataFrame:
    """Canonical names (P1), then one document per entity by source id (H3, Q2). A pass over ids and keys
    runs at once; the documents themselves are then only filtered (:func:`first_per_key_late`).

    Where the text is derived, ``json_col`` may be a column over ``raw``: it is computed for the kept rows
    only, and what a hashed filter moves is what the text is made of and not the text."""
    named = [F.col(id_col).alias(SOURCE_ID), F.col(key_col).alias(KEY)]
    if isinstance(json_col, str):
        renamed = raw.select(*named, F.col(json_col).alias("raw_json"))
        return first_per_key_late(renamed, [KEY], [SOURCE_ID], keep=keep)
    renamed = raw.select(*named, *[c for c in raw.columns if c not in (id_col, key_col)])
    kept = first_per_key_late(renamed, [KEY], [SOURCE_ID], keep=keep)
    return kept.select(SOURCE_ID, KEY, json_col.alias("raw_json"))


def normalise(bronze_df: DataFrame) -> DataFrame:
    """Foreign-dialect flag (X1, Q3), key rewrite (H4), typed parse (X3) into ``data``.

    The regex rewrite runs only on documents containing the rules' common suffix;
    for all others it could not match, so the result is the same and most
    (domestic) documents skip the regex scan.
    """
    text = F.col("raw_json")
    rewritten = F.when(contains_marker(text, FOREIGN_KEY_SUFFIX), rewrite_keys(text, DIALECT_RULES)).otherwise(text)
    flagged = bronze_df.withColumn("is_foreign", contains_marker("raw_json", FOREIGN_MARKER)).withColumn(
        "raw_json", rewritten
    )
    return parse_json(flagged, "raw_json", document_schema(), into="data")


def silver(
    bronze_df: DataFrame,
    on_error: str = "fail",
    parsed: DataFrame | None = None,
    names: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """The 21 silver tables, lazily. Pass ``parsed`` to reuse a materialised parse, and ``names`` where it
    is :func:`narrowed` to these tables."""
    doc = parsed if parsed is not None else normalise(bronze_df)
    specs = [spec for spec in silver_specs() if names is None or spec.name in names]
    return {spec.name: explode_history(doc, spec, carry=CARRY, on_error=on_error) for spec in specs}


def narrowed(parsed: DataFrame, names: Collection[str]) -> DataFrame:
    """Parsed documents with only those arrays of ``data`` that the silver tables ``names`` are exploded from:
    a staged copy for a few tables does not write the others' columns."""
    paths = dict.fromkeys(spec.path[0] for spec in silver_specs() if spec.name in names)
    tree: dict = {}
    for path in paths:
        _insert(tree, path, F.col(f"data.{path}"))

    def built(node: dict) -> Column:
        return F.struct(*[(built(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return parsed.select(*[c for c in parsed.columns if c != "data"], built(tree).alias("data"))


def repair_histories(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """H1 on every history (not the timeline). Typed-NULL-end tables have nothing to repair."""
    closed = {s.name for s in silver_specs() if s.is_history and s.end is not None}
    return {n: (reopen_orphans(df, [KEY]) if n in closed else df) for n, df in tables.items() if n != "registry"}


def repaired_in_documents(parsed: DataFrame, on_error: str = "fail") -> dict[str, DataFrame]:
    """The 16 gold histories of parsed documents with H1 applied while they are exploded: no join, no shuffle.

    Only for documents that are one per entity (bronze output): then all intervals of an entity stand in one
    array. Silver tables read back, or several documents per entity, take :func:`repair_histories`.
    """
    wanted = {name for name, _, _ in GOLD_JOINS}
    return {
        spec.name: explode_history(parsed, spec, carry=CARRY, on_error=on_error, repair_keys=[KEY])
        for spec in silver_specs()
        if spec.name in wanted
    }


def current_info_direct(
    tables: Mapping[str, DataFrame],
    tie_break: Sequence[str] = (),
    repaired: Mapping[str, DataFrame] | None = None,
    hashed: bool = False,
) -> DataFrame:
    """T6 without the full history, one row per key in every intermediate.

    The latest full-history row of an entity can only come from its timeline rows with the highest entry
    number (NULL only when all are NULL, as in ``DESC NULLS LAST``), combined with the intervals of each
    history that cover that entry. The combinations are a product, and the largest of a product in
    ``tie_break`` order has the largest timeline row and the largest row of each history, each by its own
    columns in that order: they are chosen before the join, so 16 fan-outs never multiply. Same result as
    :func:`current_info` over :func:`full_history` whenever ``tie_break`` makes the order total.

    The histories are stacked (:func:`_stacked`) and meet the last entries in one join; one aggregate over the
    key chooses all 16 rows. A join and an aggregate per history would run in one stage, as all have the same
    key, and each task would hold some 50 sort buffers at once. With ``hashed`` (see :func:`fits_hashed`) the last
    entries, one narrow row per key, are a hash table there: only the intervals that cover them are sorted.
    """
    repaired = repair_histories(tables) if repaired is None else repaired
    timeline = tables["registry"].select(*TIMELINE_OUTPUT)
    out = latest_per_key(timeline, [KEY], "entry_number", [c for c in tie_break if c in TIMELINE_OUTPUT])
    entry, key = F.col("__strata_last"), F.col("__strata_key")
    last = timeline.groupBy(F.col(KEY).alias("__strata_key")).agg(F.max("entry_number").alias("__strata_last"))
    last = last.hint("shuffle_hash") if hashed else last
    start, end = F.col("valid_from_entry"), F.col("valid_to_entry")
    stacked, slots = _stacked([(repaired[table], cols) for table, cols, _ in GOLD_JOINS])
    covering = stacked.join(last, (F.col(KEY) == key) & (start <= entry) & (end.isNull() | (end > entry)))
    best, found = [], []
    for i, (table, cols, prefix) in enumerate(GOLD_JOINS):
        at = dict(zip(AsOfSpec(repaired[table], cols, prefix).output_names(), slots[i]))
        ordered = [c for c in tie_break if c in at]
        ordered += [c for c in at if c not in ordered]
        fields = ", ".join(f"{at[c]} AS `{c}`" for c in ordered)
        # NULLs are smallest: last
        best.append(F.expr(f"max(struct({fields})) FILTER (WHERE {_HISTORY} = {i})").alias(f"__strata_best{i}"))
        found += [F.col(f"__strata_best{i}.{c}").alias(c) for c in at]
    top = covering.groupBy("__strata_key").agg(*best).select("__strata_key", *found)
    return out.join(top, out[KEY] == top["__strata_key"], "left").drop("__strata_key")


_HISTORY = "__strata_history"


def _stacked(histories: Sequence[tuple[DataFrame, Sequence[str]]]) -> tuple[DataFrame, list[list[str]]]:
    """The rows of all histories in one table (key, interval, number of the history, values), and per history
    the columns that hold its values. Values of one type share columns, so a row is as wide as the widest history."""
    slots: list[list[str]] = []
    types: dict[str, T.DataType] = {}
    kinds: dict[T.DataType, int] = {}
    for df, cols in histories:
        used: dict[T.DataType, int] = {}
        slots.append([])
        for dtype in [df.schema[c].dataType for c in cols]:
            used[dtype] = used.get(dtype, 0) + 1
            slots[-1].append(f"__strata_value{kinds.setdefault(dtype, len(kinds))}_{used[dtype]}")
            types[slots[-1][-1]] = dtype
    parts = []
    for i, (df, cols) in enumerate(histories):
        held = {slot: F.col(c) for slot, c in zip(slots[i], cols)}
        values = [held.get(slot, F.lit(None).cast(dtype)).alias(slot) for slot, dtype in types.items()]
        parts.append(df.select(KEY, "valid_from_entry", "valid_to_entry", F.lit(i).alias(_HISTORY), *values))
    return reduce(DataFrame.union, parts), slots


@dataclass(frozen=True)
class GoldOutputs:
    full_history: DataFrame
    shares_issues: DataFrame
    amendments: DataFrame
    current_info: DataFrame


def full_history(
    tables: Mapping[str, DataFrame],
    bin_rows: int = BIN_ROWS,
    repaired: Mapping[str, DataFrame] | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Timeline (6 columns) with the 16 repaired histories attached, 43 columns. ``repaired`` takes
    histories repaired already (:func:`repaired_in_documents`); otherwise each is repaired by a join. ``hashed``
    as in :func:`interval_chain` (see :func:`fits_hashed`)."""
    repaired = repair_histories(tables) if repaired is None else repaired
    base = tables["registry"].select(*TIMELINE_OUTPUT)
    specs = [AsOfSpec(repaired[t], cols, prefix) for t, cols, prefix in GOLD_JOINS]
    return interval_chain(base, specs, keys=[KEY], at="entry_number", bin_rows=bin_rows, hashed=hashed)


#: Staged bytes of parsed documents per shuffle partition up to which their histories are joined by hash tables.
HASH_BYTES = 32 * 1024**2


def fits_hashed(spark, staged: str) -> bool:
    """Whether the histories of the parsed documents staged at ``staged`` (one per entity, so no key holds more than
    a document) are small enough in every shuffle partition for hash tables, by the size of the files."""
    return stored_bytes(spark, staged) <= HASH_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions"))


#: The silver tables that gold's outputs read.
FULL_HISTORY_TABLES = ("registry", *[name for name, _, _ in GOLD_JOINS])
SHARES_ISSUES_TABLES = ("share_issues_series_name", "share_issues_shares_in_series", "share_issues_preference_info")


def shares_issues(tables: Mapping[str, DataFrame]) -> DataFrame:
    """T4: series names start-matched with share counts and preferences."""
    return start_match_chain(
        tables["share_issues_series_name"],
        [
            AsOfSpec(tables["share_issues_shares_in_series"], ("shares_in_series",)),
            AsOfSpec(tables["share_issues_preference_info"], ("preference_info",)),
        ],
        keys=[KEY],
    )


def amendments(tables: Mapping[str, DataFrame]) -> DataFrame:
    """T5: statute changes with repaired interval ends."""
    return reopen_orphans(tables["statute_change"], [KEY])


def current_info(full: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest full-history row per entity (H2); ``tie_break`` fixes fan-out ties (Q6)."""
    return latest_per_key(full, [KEY], "entry_number", tie_break=tie_break)


def gold(
    tables: Mapping[str, DataFrame],
    bin_rows: int = BIN_ROWS,
    tie_break: Sequence[str] = (),
    stage_path: str | None = None,
    stage: bool = True,
    current_from: str = "full",
    repaired: Mapping[str, DataFrame] | None = None,
    fmt: str = "parquet",
    hashed: bool = False,
) -> GoldOutputs:
    """T3-T6. With ``stage`` the full history is written once (published at ``stage_path``, or a copy in the
    shared folder) and its export and current info read that copy (L3/L4). ``current_from="latest"``
    computes current info with :func:`current_info_direct` instead (joins only the
    latest timeline rows; cheaper when the full history fans out a lot)."""
    full = full_history(tables, bin_rows, repaired, hashed)
    if stage and stage_path:
        write_table(full, stage_path, fmt, overwrite_schema=True)
        full = read_table(full.sparkSession, stage_path, fmt)
    elif stage:
        full = materialize(full)
    if current_from == "full":
        current = current_info(full, tie_break)
    elif current_from == "latest":
        current = current_info_direct(tables, tie_break, repaired, hashed)
    else:
        raise ValueError("current_from must be 'full' or 'latest'")
    return GoldOutputs(full, shares_issues(tables), amendments(tables), current)


# ------------------------------------------------------------------ job


def write_tables(
    jobs: Mapping[str, tuple[DataFrame, str]], fmt: str, concurrent_jobs: int, atomic: bool | None = None
) -> None:
    """Write independent tables; ``concurrent_jobs`` of them are submitted at once.

    Only job submission runs in driver threads - each write is an ordinary
    distributed job - so small tables no longer leave the cluster idle in turn.
    The first failure is raised after all submitted writes finish.
    """

    def write(item):
        df, path = item
        write_table(df, path, fmt, overwrite_schema=True, atomic=atomic)

    if concurrent_jobs <= 1:
        for item in jobs.values():
            write(item)
        return
    with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
        for future in [pool.submit(write, item) for item in jobs.values()]:
            future.result()


def write_silver(
    tables: Mapping[str, DataFrame],
    root: str,
    num_partitions: int | None = None,
    fmt: str = "parquet",
    concurrent_jobs: int = 4,
    clustered: bool = False,
) -> None:
    """Silver layout (L1, O1): clustered by entity, sorted by entry within each file. With ``clustered``
    the documents the tables are exploded from lie clustered already: the explodes are narrow, so the
    tables are only sorted, without a shuffle (``num_partitions`` then caps the files)."""
    jobs = {}
    for name, df in tables.items():
        order = "entry_number" if name == "registry" else "valid_from_entry"
        if clustered:
            laid = (df.coalesce(num_partitions) if num_partitions else df).sortWithinPartitions(KEY, order)
        else:
            laid = cluster(df, num_partitions, [KEY], [KEY, order])
        jobs[name] = (laid, f"{root}/{name}")
    write_tables(jobs, fmt, concurrent_jobs)


def read_silver(spark, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {s.name: read_table(spark, f"{root}/{s.name}", fmt) for s in silver_specs()}


def run_bronze(raw: DataFrame, out_root: str, fmt: str = "parquet", keep: str = "first") -> str:
    path = f"{out_root}/bronze"
    with staging(raw.sparkSession):
        write_table(bronze(raw, keep=keep), path, fmt, overwrite_schema=True)
    return path


def stage_documents(spark, out_root: str, fmt: str = "parquet") -> str:
    """Bronze parsed once into a staged copy clustered by entity (one shuffle), for use inside a ``staging`` block."""
    staged = fresh_path(spark, "parsed")
    documents = cluster(read_table(spark, f"{out_root}/bronze", fmt), None, [KEY])
    write_table(normalise(documents), staged, fmt, atomic=False)
    return staged


def run_silver(
    spark,
    out_root: str,
    fmt: str = "parquet",
    on_error: str = "fail",
    num_partitions: int | None = None,
    staged: str | None = None,
) -> None:
    """All 21 silver tables from one staged parse, each branch reading only its nested column. Without
    ``staged`` the copy is made here and deleted afterwards."""
    with staging(spark):
        path = staged or stage_documents(spark, out_root, fmt)
        tables = silver(None, on_error, parsed=spark.read.format(fmt).load(path))
        write_silver(tables, f"{out_root}/silver", num_partitions, fmt, clustered=True)


def run_gold(
    spark,
    out_root: str,
    fmt: str = "parquet",
    bin_rows: int = BIN_ROWS,
    tie_break: Sequence[str] = (),
    on_error: str = "fail",
    staged: str | None = None,
) -> dict[str, str]:
    """Gold from the silver tables. With the ``staged`` parse of bronze the histories come from it, repaired
    as they are exploded; without, silver is read back and repaired by joins. Same rows."""
    paths = {n: f"{out_root}/gold/{n}" for n in ("full_history", "shares_issues", "amendments", "current_info")}
    with staging(spark):
        repaired = repaired_in_documents(spark.read.format(fmt).load(staged), on_error) if staged else None
        tables = read_silver(spark, f"{out_root}/silver", fmt)
        hashed = staged is not None and fits_hashed(spark, staged)
        out = gold(tables, bin_rows, tie_break, paths["full_history"], repaired=repaired, fmt=fmt, hashed=hashed)
        jobs = {name: (getattr(out, name), path) for name, path in paths.items() if name != "full_history"}
        write_tables(jobs, fmt, concurrent_jobs=3)
    return paths


def run(
    raw: DataFrame,
    out_root: str,
    fmt: str = "parquet",
    on_error: str = "fail",
    bin_rows: int = BIN_ROWS,
    tie_break: Sequence[str] = (),
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Bronze -> silver -> gold over ``raw`` (id, krs_number, raw_data), writing every layer."""
    spark = raw.sparkSession
    run_bronze(raw, out_root, fmt)
    with staging(spark):
        staged = stage_documents(spark, out_root, fmt)
        run_silver(spark, out_root, fmt, on_error, num_partitions, staged)
        return run_gold(spark, out_root, fmt, bin_rows, tie_break, on_error, staged)
