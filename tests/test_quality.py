"""Contracts: schema set equality, null checks, quarantine, generation."""

import pytest

from wareloom.operators import quality as Q
from wareloom.plans import fixtures as FX


@pytest.fixture(scope="module")
def table(spark, sf):
    return FX.contract_table(spark, sf)


def test_shuffled_contract_passes_schema(spark, table):
    Q.check_schema(table, Q.contract_from_records(spark, FX.contract_variants()["shuffled"]))


@pytest.mark.parametrize("variant", ["type_changed", "column_missing", "column_extra"])
def test_bad_contracts_fail(spark, table, variant):
    with pytest.raises(Q.ContractError):
        Q.check_schema(table, Q.contract_from_records(spark, FX.contract_variants()[variant]))


def test_null_check_names_the_column(spark, table):
    with pytest.raises(Q.ContractError, match="required column id"):
        Q.check_nulls(table, Q.contract_from_records(spark, FX.SAMPLE_CONTRACT))


def test_null_check_any_declared_option(spark):
    d = spark.createDataFrame([(1, None)], "a int, b string")
    c = Q.contract_from_records(spark, [{"COLUMN_NAME": "a", "DATA_TYPE": "int"},
                                        {"COLUMN_NAME": "b", "DATA_TYPE": "varchar", "NAs": True}])
    Q.check_nulls(d, c)  # NAs true = NULL allowed (documented intent)
    with pytest.raises(Q.ContractError):
        Q.check_nulls(d, c, any_declared=True)  # the coded behaviour: any declared NAs is checked


def test_quarantine_splits(spark, table):
    good, bad = Q.quarantine(table, Q.contract_from_records(spark, FX.SAMPLE_CONTRACT))
    assert good.count() + bad.count() == table.count()
    assert bad.where("id IS NOT NULL").count() == 0


def test_contract_json_roundtrip(spark, table, tmp_path):
    c = Q.generate_contract(table, ["id"])
    Q.write_contract(c, str(tmp_path / "c"))
    back = Q.contract_from_json(spark, str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))
    text = '[{"COLUMN_NAME":"id","DATA_TYPE":"int", "NAs": false},{"COLUMN_NAME":"x","DATA_TYPE":"varchar"}]'
    assert Q.contract_from_json(spark, text).count() == 2


def test_report_statuses(spark, table):
    rep = {r["column_name"]: r["status"] for r in
           Q.schema_report(table, Q.contract_from_records(spark, FX.contract_variants()["type_changed"])).collect()}
    assert rep["latitude"] == "type_mismatch"
    assert rep["id"] == "null_violation"
    assert rep["address"] == "ok"
