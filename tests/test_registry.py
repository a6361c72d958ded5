from __future__ import annotations

import datetime as dt

import pytest

from strata.plans import registry as R
from strata.sources.tables import read_table
from tests.conftest import rows
from tests.registry_fixtures import ENTRIES_9, document, raw_rows

RAW = "id long, krs_number string, raw_data string"

FULL_HISTORY_COLUMNS = [
    "source_id", "company_krs", "entry_number", "entry_date", "court_designation", "case_file_designation",
    "company_name", "nip_number", "regon_number", "legal_form", "has_opp_status",
    "does_conduct_business_with_other_entities",
    "address_country", "address_street", "address_house_number", "address_flat_number", "address_post_office",
    "address_postal_code", "address_city",
    "headquarters_country", "headquarters_municipality", "headquarters_county", "headquarters_city",
    "headquarters_voivodeship",
    "webpage", "email", "electronic_bae_delivery",
    "mainHeadquarters_country", "mainHeadquarters_street", "mainHeadquarters_house_number",
    "mainHeadquarters_flat_number", "mainHeadquarters_post_office", "mainHeadquarters_postal_code",
    "mainHeadquarters_city", "mainHeadquarters_voivodeship",
    "time_for_which_entity_was_created",
    "shareCapitalAmount_currency", "shareCapitalAmount_share_capital_amount",
    "total_number_of_shares_units",
    "singleShareValue_currency", "singleShareValue_single_share_value",
    "paidInCapitalPart_currency", "paidInCapitalPart_paid_in_capital_amount",
]


@pytest.fixture(scope="module")
def layers(spark):
    raw = spark.createDataFrame(raw_rows(), RAW)
    b = R.bronze(raw)
    tables = R.silver(b)
    return b, tables, R.gold(tables, tie_break=["company_name", "address_street"], stage=False)


def test_bronze_keeps_lowest_source_id(layers):
    b, _, _ = layers
    assert rows(b, "company_krs", "source_id") == [
        ("0000000001", 10), ("0000000002", 30), ("0000000003", 40), ("0000000004", 50)
    ]


def test_silver_has_21_tables_with_reference_columns(layers):
    _, tables, _ = layers
    assert len(tables) == 21
    assert tables["registry"].columns == [
        "source_id", "company_krs", "description", "entry_date", "entry_number", "court_designation",
        "case_file_designation",
    ]
    assert tables["address"].columns == [
        "source_id", "company_krs", "country", "street", "house_number", "flat_number", "post_office",
        "postal_code", "city", "valid_from_entry", "valid_to_entry",
    ]
    for name, df in tables.items():
        if name != "registry":
            assert df.columns[:2] == ["source_id", "company_krs"]
            assert df.columns[-2:] == ["valid_from_entry", "valid_to_entry"]
            assert str(df.schema["valid_to_entry"].dataType) == "IntegerType()"


def test_timeline_parsing(layers):
    _, tables, _ = layers
    reg = rows(tables["registry"].where("company_krs = '0000000001'"), "entry_number", "entry_date")
    assert reg[0] == (1, dt.date(2020, 1, 1)) and len(reg) == 9


def test_foreign_dialect_equals_domestic_twin(layers):
    _, tables, gold = layers
    for name, df in tables.items():
        cols = [c for c in df.columns if c not in ("source_id", "company_krs")]
        assert rows(df.where("company_krs = '0000000001'"), *cols) == rows(
            df.where("company_krs = '0000000002'"), *cols
        ), name
    cols = FULL_HISTORY_COLUMNS[2:]
    f = gold.full_history
    assert rows(f.where("company_krs = '0000000001'"), *cols) == rows(f.where("company_krs = '0000000002'"), *cols)


def test_flag_and_value_text_untouched(spark):
    raw = spark.createDataFrame(raw_rows(), RAW)
    parsed = R.normalise(R.bronze(raw))
    flags = dict(rows(parsed, "company_krs", "is_foreign"))
    assert flags == {"0000000001": False, "0000000002": True, "0000000003": False, "0000000004": True}
    names = R.silver(None, parsed=parsed)["names"]
    assert rows(names.where("company_krs = '0000000004'"), "company_name") == [('Firma "danePodmiotuZagranicznego" SA',)]


def test_malformed_document(layers):
    _, tables, gold = layers
    bad = "company_krs = '0000000003'"
    assert tables["names"].where(bad).count() == 0  # explode drops
    assert tables["registry"].where(bad).count() == 0
    outer = rows(tables["total_shares_units"].where(bad), "total_number_of_shares_units", "valid_from_entry")
    assert outer == [(None, None)]  # explode_outer keeps one null row
    assert rows(gold.shares_issues.where(bad), "series_name", "shares_in_series", "preference_info") == [(None, None, None)]


def test_full_history_shape_and_values(layers):
    _, _, gold = layers
    f = gold.full_history
    assert f.columns == FULL_HISTORY_COLUMNS
    one = f.where("company_krs = '0000000001'")
    by_entry = {}
    for r in one.collect():
        by_entry.setdefault(r["entry_number"], []).append(r)
    assert [r["company_name"] for r in by_entry[1]] == ["Alpha"]
    assert [r["company_name"] for r in by_entry[3]] == ["Beta"]  # chain: end 3 replaced at 3
    assert by_entry[1][0]["has_opp_status"] is None and by_entry[2][0]["has_opp_status"] is True
    assert {r["address_street"] for r in by_entry[4]} == {"Short"}
    # capital [1, 6) has no successor -> reopened, still valid at 9
    assert {r["shareCapitalAmount_share_capital_amount"] for r in by_entry[9]} == {"5000"}
    assert by_entry[9][0]["total_number_of_shares_units"] is None  # only a null row, never matches
    assert len(by_entry) == 9 and all(len(v) == 1 for v in by_entry.values())


def test_orphan_fans_out(spark):
    doc = document(ENTRIES_9, names=[("Old", 1, 5), ("New", 8, None)])
    raw = spark.createDataFrame([(1, "K", doc)], RAW)
    full = R.gold(R.silver(R.bronze(raw)), stage=False).full_history
    got = rows(full, "entry_number", "company_name")
    assert got.count((9, "New")) == 1 and got.count((9, "Old")) == 1  # entry 9 -> two rows
    assert (6, "Old") in got and (4, "Old") in got


def test_share_issues_same_entry_cross_product(layers):
    _, _, gold = layers
    one = gold.shares_issues.where("company_krs = '0000000001'")
    assert one.columns == [
        "source_id", "company_krs", "series_name", "valid_from_entry", "valid_to_entry", "shares_in_series",
        "preference_info",
    ]
    assert one.count() == 8


def test_amendments_repaired(layers):
    _, _, gold = layers
    got = rows(gold.amendments.where("company_krs = '0000000001'"), "change_or_amendment_of_statue_agreement",
               "valid_from_entry", "valid_to_entry")
    assert got == [("changed", 5, None), ("founded", 1, 5)]


def test_current_info_one_row_per_entity(layers):
    _, _, gold = layers
    cur = gold.current_info
    assert cur.columns == FULL_HISTORY_COLUMNS
    got = rows(cur, "company_krs", "entry_number")
    assert got == [("0000000001", 9), ("0000000002", 9), ("0000000004", 1)]


def test_bad_numbers_strict_and_lenient(spark):
    doc = document([(1, "31.02.2020")], names=[("X", "", None)])
    raw = spark.createDataFrame([(1, "K", doc)], RAW)
    b = R.bronze(raw)
    with pytest.raises(Exception):
        R.silver(b)["names"].collect()
    with pytest.raises(Exception):
        R.silver(b)["registry"].collect()
    lenient = R.silver(b, on_error="null")
    assert rows(lenient["names"], "company_name", "valid_from_entry") == [("X", None)]
    assert rows(lenient["registry"], "entry_date") == [(None,)]


def test_run_writes_all_layers(spark, tmp_path):
    raw = spark.createDataFrame(raw_rows(), RAW)
    paths = R.run(raw, str(tmp_path / "out"), tie_break=["company_name", "address_street"])
    back = {k: read_table(spark, v) for k, v in paths.items()}
    assert back["full_history"].columns == FULL_HISTORY_COLUMNS
    assert back["current_info"].count() == 3
    assert len(list((tmp_path / "out" / "silver").iterdir())) == 21


def test_suffix_guard_keeps_reference_rewrite(spark):
    # only the seat section is foreign: no dialect flag, but the keys are still folded
    doc = document(ENTRIES_9[:1], address=[("Main", "Gdansk", 1, None)]).replace(
        '"siedzibaIAdres":', '"siedzibaIAdresPodmiotuZagranicznego" :'
    )
    assert "siedzibaIAdresPodmiotuZagranicznego" in doc
    parsed = R.normalise(R.bronze(spark.createDataFrame([(1, "K", doc)], RAW)))
    assert rows(parsed, "is_foreign") == [(False,)]
    assert rows(R.silver(None, parsed=parsed)["address"], "street") == [("Main",)]


def test_current_info_direct_equals_top1_of_full_history(spark, layers):
    _, tables, gold = layers
    tie = [c for c in FULL_HISTORY_COLUMNS if c not in ("company_krs", "entry_number")]
    via_full = R.current_info(gold.full_history, tie)
    direct = R.current_info_direct(tables, tie_break=tie)
    assert direct.columns == FULL_HISTORY_COLUMNS
    assert rows(direct) == rows(via_full)
    # all entry numbers NULL (lenient parse): the NULL rows are the latest, as with DESC NULLS LAST
    doc = document([(1, "01.01.2020")], names=[("X", 1, None)]).replace('"numerWpisu": "1"', '"numerWpisu": "x"')
    t = R.silver(R.bronze(spark.createDataFrame([(1, "K", doc)], RAW)), on_error="null")
    assert rows(R.current_info_direct(t, tie_break=tie), "entry_number") == [(None,)]


def test_current_info_direct_keeps_rows_without_a_key_and_several_documents_per_key(spark):
    from tests.registry_fixtures import document

    docs = [
        (1, "A", document([(1, "01.01.2020"), (100, "02.01.2020")], names=[("Old", 1, None)])),
        (2, "A", document([(1, "01.01.2020"), (5, "02.01.2020")], names=[("New", 3, None)])),
        (3, None, document([(1, "01.01.2020"), (2, "01.01.2021")], names=[("No key", 1, None)])),
    ]
    parsed = R.normalise(
        spark.createDataFrame(docs, "source_id long, company_krs string, raw_json string")
    )
    tables = R.silver(None, parsed=parsed)
    tie = ["company_name"]
    got, want = R.current_info_direct(tables, tie), R.current_info(R.full_history(tables), tie)
    assert got.columns == want.columns and rows(got) == rows(want) and want.count() == 2


def test_repair_inside_documents_equals_the_join(spark):
    import random

    draw = random.Random(7)
    docs = []
    for i in range(40):  # empty, short and long histories; ends with, without and before a start; repeats
        n = draw.choice([0, 1, 2, 5, 40])
        spans = [(f"n{j}", draw.randint(1, 30), draw.choice([None, draw.randint(1, 30)])) for j in range(n)]
        docs.append((i, None if i % 9 == 0 else f"K{i}", document(ENTRIES_9, names=spans, units=spans or None)))
    docs += [(90, "bad", "{"), (91, "void", None)]
    parsed = R.normalise(spark.createDataFrame(docs, "source_id long, company_krs string, raw_json string"))
    tables = R.silver(None, parsed=parsed)
    got, want = R.repaired_in_documents(parsed), R.repair_histories(tables)
    assert set(got) == {name for name, _, _ in R.GOLD_JOINS}
    for name in ("names", "total_shares_units", "address"):
        assert got[name].dtypes == want[name].dtypes and rows(got[name]) == rows(want[name]), name
    assert "Join" not in got["names"]._jdf.queryExecution().executedPlan().toString()


def test_repair_inside_a_long_document_is_not_quadratic(spark):
    n = 60_000  # an array_contains per element would take minutes
    doc = document([(1, "01.01.2020")], names=[(f"n{i}", 2 * i, 2 * i + 2 - i % 2) for i in range(n)])
    parsed = R.normalise(spark.createDataFrame([(1, "K", doc)], "source_id long, company_krs string, raw_json string"))
    got = R.repaired_in_documents(parsed)["names"].where("valid_to_entry IS NOT NULL")
    assert got.count() == n // 2


def test_full_history_from_documents_repairs_without_exchanges(spark):
    """Per history one exchange to the occupied nodes and one to the bins, besides three of the timeline;
    the join form of the repair adds two for each."""
    from strata.plans import derived_registry as D

    parsed = D.parsed_documents(spark, "/root/testdata/sf0.001")
    tables = R.silver(None, parsed=parsed)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counts = [
            sum("Exchange hashpartitioning" in line and "Reused" not in line for line in plan.splitlines())
            for plan in (
                R.full_history(tables, repaired=r)._jdf.queryExecution().executedPlan().toString()
                for r in (R.repaired_in_documents(parsed), None)
            )
        ]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert counts[0] <= 2 * len(R.GOLD_JOINS) + 3 and counts[1] == counts[0] + 2 * len(R.GOLD_JOINS)


def test_current_info_has_one_row_per_key_in_every_join(spark, layers):
    """Several intervals cover the last entry in three histories: they never multiply."""
    n = 12
    many = [(f"N{i:02}", 1, None) for i in range(n)]
    doc = document([(1, "01.01.2020"), (2, "02.01.2020")], names=many, address=[(f"S{i}", "C", 1, None) for i in range(n)])
    tables = R.silver(R.bronze(spark.createDataFrame([(1, "K", doc), (2, "L", doc)], RAW)))
    tie = [c for c in FULL_HISTORY_COLUMNS if c not in ("company_krs", "entry_number")]
    direct = R.current_info_direct(tables, tie_break=tie)
    assert rows(direct) == rows(R.current_info(R.full_history(tables), tie))
    got = direct.collect()
    assert len(got) == 2 and {r["company_name"] for r in got} == {"N11"} and {r["address_street"] for r in got} == {"S9"}
    # a history's largest row per key is found below the join that attaches it
    plan = direct._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max(struct(") == len(R.GOLD_JOINS)


def test_current_info_sorts_little_in_one_stage(spark, layers):
    """All histories meet the last entries in one join: the buffers a task sorts do not grow with their number."""
    _, tables, _ = layers
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        direct = R.current_info_direct(tables, tie_break=["company_name"], repaired=R.repair_histories(tables))
        plan = direct._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("Union")]  # what runs on the stacked rows
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert above.count("SortMergeJoin") <= 2 and above.count("Sort [") <= 3


def test_derived_texts_are_computed_above_every_join_and_aggregate(spark):
    """What is shuffled, sorted and grouped are narrow lines and ids; the texts are made of the kept rows."""
    from strata.plans import derived_registry as D

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plan = D.q_registry_bronze(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    below = plan[plan.index("Join") :]
    assert "StructsToJson" in plan and "StructsToJson" not in below and below.count("LeftAnti") == 2
    assert plan.index("LeftOuter") < plan.index("LeftAnti")  # ids are dropped before the lines are joined
