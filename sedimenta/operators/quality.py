"""Standardising, rule checks, quarantine and deduplication, all driven by a TableSpec."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.parsing import as_text, clean_code, clean_text, parse_as
from sedimenta.plans.specs import TableSpec

REASON = "_motivo_rejeicao"


def as_bronze(df: DataFrame) -> DataFrame:
    """Every column as the text the landing files hold."""
    return df.select(*[as_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def standardize(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the spec's columns, cleaned and typed, then those of ``keep`` that exist.

    Text columns are parsed. Columns a typed source already delivers are only checked against the
    target type, so typed loads pay nothing for the text rules.
    """
    given = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for name, target in spec.columns.items():
        col, coded = F.col(name), name in spec.allowed
        if isinstance(given.get(name), T.StringType):
            col = parse_as(col, target, coded)
        elif isinstance(target, T.StringType):
            col = (clean_code if coded else clean_text)(col.cast("string"))
        elif given.get(name) != target:
            col = col.try_cast(target)
        columns.append(col.alias(name))
    columns += [F.col(name) for name in keep if name in given]
    return df.select(*columns)


def rules(spec: TableSpec) -> list[tuple[str, Column]]:
    """(reason, broken) pairs in report order: key, required, allowed values, date order.

    ``broken`` is never NULL: allowed-value and date-order rules pass where a side is missing.
    """
    checks = [(f"pk_nula:{spec.key}", F.col(spec.key).isNull())]
    for name in spec.required:
        checks.append((f"nulo_obrigatorio:{name}", F.col(name).isNull()))
    for name, values in spec.allowed.items():
        checks.append((f"dominio_invalido:{name}", F.col(name).isNotNull() & ~F.col(name).isin(*values)))
    for later, earlier in spec.ordered:
        both = F.col(later).isNotNull() & F.col(earlier).isNotNull()
        checks.append((f"temporal_invalido:{later}<{earlier}", both & (F.col(later) < F.col(earlier))))
    return checks


def evaluate_quality(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the reasons a row is rejected for, joined by '; ', NULL for a clean row."""
    reasons = [F.when(broken, F.lit(reason)) for reason, broken in rules(spec)]
    return df.withColumn(REASON, F.nullif(F.concat_ws("; ", *reasons), F.lit("")))


def any_broken(spec: TableSpec) -> Column:
    """Whether some rule rejects the row; never NULL, and no reason text is made."""
    return reduce(or_, [broken for _, broken in rules(spec)])


def evaluate_strict(bronze: DataFrame, spec: TableSpec, raw: str | None = None) -> DataFrame:
    """Standardised rows of a text table with the rules' reasons and, after them, ``cast_invalido:<column>`` for every
    value that is there but cannot be read as its type. ``raw`` names a column for the row as it was, as JSON."""
    typed = spec.columns.items()
    unread = [
        F.when(clean_text(F.col(n)).isNotNull() & parse_as(F.col(n), t, False).isNull(), F.lit(f"cast_invalido:{n}"))
        for n, t in typed
        if not isinstance(t, T.StringType)
    ]
    given = bronze.withColumns(
        {"_unread": F.nullif(F.concat_ws("; ", *unread), F.lit("")), "_raw": F.to_json(F.struct(*spec.columns))}
    )
    found = evaluate_quality(standardize(given, spec, keep=("_unread", "_raw")), spec)
    reasons = F.nullif(F.concat_ws("; ", REASON, "_unread"), F.lit(""))
    checked = found.withColumn(REASON, reasons).drop("_unread")
    return checked.withColumnRenamed("_raw", raw) if raw else checked.drop("_raw")


def rejected_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows some rule rejects, with their reasons: these are written out for them alone."""
    return evaluate_quality(df.where(any_broken(spec)), spec)


def clean_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows no rule rejects, as plain predicates that reach the scan; no reason text is made."""
    return df.where(~any_broken(spec))


def valid_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col(REASON).isNull()).drop(REASON)


def quarantined_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col(REASON).isNotNull())


def split_valid_quarantine(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_rows(evaluated), quarantined_rows(evaluated)


def deduplicate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: the smallest over all other columns, NULL first, so reruns keep the same row.

    As an aggregate it combines copies before the shuffle: a key with a third of all rows leaves
    each map task as one row.
    """
    others = [name for name in df.columns if name != spec.key]
    if not others:
        return df.distinct()
    kept = df.groupBy(spec.key).agg(F.min(F.struct(*others)).alias("_kept"))
    return kept.select(*[F.col(n) if n == spec.key else F.col(f"_kept.{n}").alias(n) for n in df.columns])


def deduplicate_isolated(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of ``deduplicate``, for stored rows of which few share their key: only those are compared.

    Keys are counted first, in a hash aggregate over the key alone. Rows whose key is theirs alone pass by an anti-join,
    unsorted and unaggregated; the rows of the other keys, combined before the shuffle, give their smallest. ``df`` is
    read three times, so it should be a stored table.
    """
    repeated = df.groupBy(spec.key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(spec.key)
    alone = df.join(repeated, spec.key, "left_anti")
    shared = df.join(repeated, spec.key, "left_semi")
    return alone.select(*df.columns).unionByName(deduplicate(shared.select(*df.columns), spec))


def refine(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Bronze or typed source rows to (silver, quarantine)."""
    typed = standardize(df, spec, keep)
    return deduplicate(clean_rows(typed, spec), spec), rejected_rows(typed, spec)


def table_report(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """One row of counts from one pass over standardised rows: read = valid + quarantined + duplicates."""
    # The verdict is made once a row; keys are counted as groups, combined before the shuffle.
    judged = typed.select(F.col(spec.key).alias("_key"), any_broken(spec).alias("_broken"))
    keyed = judged.select(F.when(~F.col("_broken"), F.col("_key")).alias("_key"), "_broken")
    keys = keyed.groupBy("_key", "_broken").agg(F.count(F.lit(1)).alias("_rows"))

    def rows(broken):
        return F.coalesce(F.sum(F.when(broken, F.col("_rows"))), F.lit(0))

    broken = F.col("_broken")
    counts = keys.agg(
        rows(F.lit(True)).alias("lidos"), rows(broken).alias("quarentena"), F.count_if(~broken).alias("validos")
    )
    return counts.select(
        F.lit(spec.name).alias("tabela"),
        "lidos",
        "validos",
        "quarentena",
        (F.col("lidos") - F.col("quarentena") - F.col("validos")).alias("duplicados"),
    )


def quality_report(typed: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_report(df, specs[name]) for name, df in typed.items()])
