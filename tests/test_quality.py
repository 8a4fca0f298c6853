import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.parsing import parse_as
from sedimenta.operators import quality
from sedimenta.plans.specs import SPECS, WIDE_SPECS, TableSpec, select_names


def parsed(spark, values, dtype, coded=False):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [row[0] for row in df.select(parse_as(F.col("v"), dtype, coded)).collect()]


def test_text(spark):
    assert parsed(spark, [" a ", "", "  ", None, "A b"], T.StringType()) == ["a", None, None, None, "A b"]
    assert parsed(spark, [" Tier2 ", ""], T.StringType(), coded=True) == ["tier2", None]


def test_booleans(spark):
    values = ["True", " t ", "1", "YES", "y", "f", "0", "no", "N", "False", "x", "", None]
    assert parsed(spark, values, T.BooleanType()) == [True] * 5 + [False] * 5 + [None] * 3


def test_integers(spark):
    values = ["12", "12.0", "12.9", "-1.9", " 7 ", "+5", ".5", "12.", "1e3", "-", "99999999999", "abc", "", None]
    assert parsed(spark, values, T.IntegerType()) == [12, 12, 12, -1, 7, 5, 0, 12] + [None] * 6
    assert parsed(spark, ["99999999999"], T.LongType()) == [99999999999]


def test_decimals_and_dates(spark):
    assert parsed(spark, ["10.005", "1234567.89", "x"], T.DecimalType(8, 2)) == [Decimal("10.01"), None, None]
    values = ["2024", "2024-1-5", "2024-13-01", "2024-01-01 10:00:00", "31/12/2024"]
    assert parsed(spark, values, T.DateType()) == [dt.date(2024, 1, 1), dt.date(2024, 1, 5), None, dt.date(2024, 1, 1), None]
    assert parsed(spark, ["2024-01-01 10:00:05", "agora"], T.TimestampNTZType()) == [dt.datetime(2024, 1, 1, 10, 0, 5), None]


SPEC = TableSpec(
    "exemplo",
    {"id": T.IntegerType(), "nome": T.StringType(), "tipo": T.StringType(), "inicio": T.DateType(), "fim": T.DateType()},
    key="id",
    required=("nome", "inicio"),
    allowed={"tipo": ("a", "b")},
    ordered=(("fim", "inicio"),),
)


def rows(spark, data):
    return spark.createDataFrame(data, "id string, nome string, tipo string, inicio string, fim string")


def test_reasons_in_rule_order(spark):
    df = rows(
        spark,
        [
            (None, "", "z", "2024-02-01", "2024-01-01"),
            ("1", "x", " A ", "2024-01-01", "2024-01-01"),
            ("2", "x", None, "2024-01-01", None),
            ("3", "x", "b", "sem data", "2024-01-01"),
        ],
    )
    found = quality.evaluate_quality(quality.standardize(df, SPEC), SPEC)
    assert [row[quality.REASON] for row in found.collect()] == [
        "pk_nula:id; nulo_obrigatorio:nome; dominio_invalido:tipo; temporal_invalido:fim<inicio",
        None,
        None,
        "nulo_obrigatorio:inicio",
    ]


def test_clean_rows_are_those_without_a_reason(spark):
    df = quality.standardize(
        rows(spark, [("1", None, "a", None, None), ("2", "x", "q", "2024-01-01", None), ("3", "x", None, "2024-01-01", None)]),
        SPEC,
    )
    valid, quarantine = quality.split_valid_quarantine(quality.evaluate_quality(df, SPEC))
    assert quality.clean_rows(df, SPEC).collect() == valid.collect()
    assert [r.id for r in valid.collect()] == [3]
    assert [r.id for r in quarantine.collect()] == [1, 2]


def test_deduplicate_keeps_the_smallest_row_whatever_the_partitioning(spark):
    data = [("1", "b", "a", "2024-01-01", None), ("1", "b", None, "2024-01-01", None), ("1", "c", None, "2023-01-01", None)]
    df = quality.standardize(rows(spark, data), SPEC)
    for n in (1, 3):
        kept = quality.deduplicate(df.repartition(n), SPEC).collect()
        assert [tuple(r) for r in kept] == [(1, "b", None, dt.date(2024, 1, 1), None)]


def test_report_adds_up_with_a_hot_key(spark):
    """A third of the rows are copies of one key, another part is rejected."""
    hot = F.when(F.col("n") % 3 == 0, F.lit(7)).otherwise(F.col("n"))
    df = spark.range(30_000).select(F.col("id").alias("n")).select(
        hot.cast("string").alias("id"),
        F.when(F.col("n") % 10 == 1, F.lit("")).otherwise(F.lit("x")).alias("nome"),
        F.lit("a").alias("tipo"),
        F.lit("2024-01-01").alias("inicio"),
        F.lit(None).cast("string").alias("fim"),
    )
    found = quality.evaluate_quality(quality.standardize(df, SPEC), SPEC)
    got = quality.table_report(found, SPEC).first()
    assert got.lidos == 30_000 == got.validos + got.quarentena + got.duplicados
    assert got.validos == quality.deduplicate(quality.valid_rows(found), SPEC).count()


def test_typed_columns_pass_and_keep_is_carried(spark):
    df = spark.createDataFrame(
        [(1, " P ", "2024-01-01", 5)], "id_plataforma int, nome string, _extraction_date string, sobra int"
    )
    out = quality.standardize(df, SPECS["plataformas"], keep=("_extraction_date", "_faltante"))
    assert [tuple(r) for r in out.collect()] == [(1, "P", "2024-01-01")]
    assert out.columns == ["id_plataforma", "nome", "_extraction_date"]


def test_wide_specs_change_keys_and_timestamps_only():
    for name, spec in SPECS.items():
        for column, dtype in spec.columns.items():
            wide = WIDE_SPECS[name].columns[column]
            if column.startswith("id_"):
                assert wide == T.LongType()
            elif dtype == T.TimestampType():
                assert wide == T.TimestampNTZType()
            else:
                assert wide == dtype


def test_unknown_names_are_errors():
    assert select_names(SPECS, ["doacoes", "jogos"]) == ["jogos", "doacoes"]
    with pytest.raises(ValueError, match="xyz"):
        select_names(SPECS, ["xyz"])
