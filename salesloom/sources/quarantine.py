"""Dead letters: what typing a delivery could not use, kept with its reason.

A line without as many fields as the header, or without a value in a column the row can't
do without, is quarantined as a whole; any other value that does not type is NULL in
the row that stays, as the cleaning stage has it, and leaves a letter too.  So rows in
are rows kept plus rows quarantined, and nothing goes without a trace.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.sources.ingest import CORRUPT, IngestError, read_text_csv

# fixed values: columns without which a row of an extract says nothing
REQUIRED: Mapping[str, Sequence[str]] = {
    "produtos": ("sku",), "pedidos": ("pedido_id", "cliente_id", "data_pedido"),
    "itens_pedido": ("pedido_id", "sku", "quantidade"), "pagamentos": ("pedido_id", "valor"),
    "estoque": ("sku", "data_snapshot", "saldo"), "clientes": ("cliente_id",),
    "vendedores": ("vendedor_id",), "carteira": ("carteira_id", "cliente_id", "vendedor_id"),
    "oportunidades": ("oportunidade_id", "cliente_id"), "visitas": ("visita_id", "cliente_id", "data_visita"),
}

FIELDS, MISSING, UNTYPED = "fields", "missing", "untyped"  # reasons
SOURCE = "_source"


def read_lines(
    spark: SparkSession, store: Store, path: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Every line of an extract as text, with the file it is from and, if it has not the
    fields of the header, the line itself; stored, as two readers of text may differ.

    The header of ``path`` (the first, of several) gives the order of the columns and has
    to name all of ``columns``.
    """
    header = read_text_csv(spark, path if isinstance(path, str) else path[0]).columns
    if set(columns) - set(header):
        raise IngestError(f"{path} lacks {sorted(set(columns) - set(header))}")
    schema = ", ".join(f"`{c}` string" for c in [*header, CORRUPT])
    lines = (
        spark.read.option("header", "true").option("escape", '"').option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    )
    return store.scratch(lines.select("*", F.col("_metadata.file_path").alias(SOURCE)))


def _judged(lines: DataFrame, typed: Mapping[str, Column], required: Sequence[str]) -> DataFrame:
    """Add ``_letters``, an array of (column, raw, reason, whole)."""
    def filled(c: str) -> Column:
        return F.coalesce(F.trim(F.col(c)) != "", F.lit(False))

    def letter(column: Column, raw: Column, reason: str, whole: bool) -> Column:
        return F.struct(column.alias("column"), raw.alias("raw"), F.lit(reason).alias("reason"),
                        F.lit(whole).alias("whole"))

    broken = F.col(CORRUPT).isNotNull()
    found = [F.when(broken, letter(F.lit(None).cast("string"), F.col(CORRUPT), FIELDS, True))]
    for c in dict.fromkeys([*required, *typed]):
        if c in required:
            found.append(F.when(~broken & ~filled(c), letter(F.lit(c), F.col(c), MISSING, True)))
        if c in typed:
            found.append(F.when(~broken & filled(c) & typed[c].isNull(),
                                letter(F.lit(c), F.col(c), UNTYPED, c in required)))
    return lines.withColumn("_letters", F.array_compact(F.array(*found)))


def split(lines: DataFrame, typed: Mapping[str, Column], required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows kept, letters): ``source``, ``line``, ``column``, ``raw``, ``reason``, ``whole``.

    ``line`` is the row as JSON; ``whole`` tells whether it is quarantined.  A quarantined
    row may have several letters.
    """
    judged = _judged(lines, typed, required)
    columns = [c for c in lines.columns if c not in (CORRUPT, SOURCE)]
    kept = judged.where(~F.exists("_letters", lambda x: x["whole"])).select(*columns)
    letters = judged.where(F.size("_letters") > 0).select(
        F.col(SOURCE).alias("source"), F.to_json(F.struct(*columns)).alias("line"), F.inline("_letters"))
    return kept, letters


def balance(lines: DataFrame, typed: Mapping[str, Column], required: Sequence[str]) -> DataFrame:
    """column, reason, whole, count of letters; and rows in, kept and quarantined under their names.

    One pass over the lines; letters are counted before anything is shuffled.
    """
    judged = _judged(lines, typed, required)
    whole = F.exists("_letters", lambda x: x["whole"])
    count = F.struct(F.lit("").alias("column"), F.lit("").alias("raw"), F.lit("rows in").alias("reason"),
                     F.lit(False).alias("whole"))
    state = F.struct(F.lit("").alias("column"), F.lit("").alias("raw"), F.when(whole, "rows quarantined").otherwise(
        "rows kept").alias("reason"), F.lit(False).alias("whole"))
    return judged.select(F.inline(F.concat("_letters", F.array(count, state)))).groupBy(
        F.coalesce("column", F.lit("")).alias("column"), "reason").agg(F.count(F.lit(1)).alias("n"))
