"""Structure files: one record per molecule, the properties behind the structure block."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaprep.session import spread
from qaprep.sources.tables import per_file_cap

# Property name -> (column, type) of the compound table.
COMPOUND_PROPERTIES: dict[str, tuple[str, str]] = {
    "PUBCHEM_COMPOUND_CID": ("cid", "decimal(20,0)"),
    "PUBCHEM_CACTVS_COMPLEXITY": ("complexity", "float"),
    "PUBCHEM_CACTVS_HBOND_ACCEPTOR": ("hba", "int"),
    "PUBCHEM_CACTVS_HBOND_DONOR": ("hbd", "int"),
    "PUBCHEM_CACTVS_ROTATABLE_BOND": ("rotatable_bonds", "int"),
    "PUBCHEM_CACTVS_TPSA": ("tpsa", "float"),
    "PUBCHEM_XLOGP3": ("logp", "float"),
    "PUBCHEM_MONOISOTOPIC_WEIGHT": ("monoisotopic_mass", "double"),
    "PUBCHEM_EXACT_MASS": ("exact_mass", "double"),
    "PUBCHEM_MOLECULAR_FORMULA": ("formula", "string"),
    "PUBCHEM_MOLECULAR_WEIGHT": ("molecular_weight", "double"),
    "PUBCHEM_TOTAL_CHARGE": ("charge", "int"),
    "PUBCHEM_HEAVY_ATOM_COUNT": ("num_atoms", "int"),
    "PUBCHEM_ATOM_DEF_STEREO_COUNT": ("num_def_stereo", "int"),
    "PUBCHEM_ATOM_UDEF_STEREO_COUNT": ("num_undef_stereo", "int"),
    "PUBCHEM_BOND_DEF_STEREO_COUNT": ("num_def_double", "int"),
    "PUBCHEM_BOND_UDEF_STEREO_COUNT": ("num_undef_double", "int"),
    "PUBCHEM_ISOTOPIC_ATOM_COUNT": ("num_isotopic_atoms", "int"),
    "PUBCHEM_COMPONENT_COUNT": ("fragments", "int"),
    "PUBCHEM_CACTVS_TAUTO_COUNT": ("num_tautomers", "int"),
    "PUBCHEM_CACTVS_COMPLEXITY_ATOM_COUNT": ("num_complexity", "int"),
    "PUBCHEM_IUPAC_OPENEYE_NAME": ("iupac_openeye", "string"),
    "PUBCHEM_IUPAC_CAS_NAME": ("iupac_cas", "string"),
    "PUBCHEM_IUPAC_NAME": ("iupac", "string"),
    "PUBCHEM_IUPAC_SYSTEMATIC_NAME": ("iupac_systematic", "string"),
    "PUBCHEM_IUPAC_TRADITIONAL_NAME": ("iupac_traditional", "string"),
    "PUBCHEM_OPENEYE_ISO_SMILES": ("smiles", "string"),
}

# Property name -> (column, SQL type) of the database table. The two identifier
# properties keep separate columns.
SQL_PROPERTIES: dict[str, tuple[str, str]] = {
    "PUBCHEM_COMPOUND_CID": ("cid", "INTEGER"),
    "PUBCHEM_CACTVS_COMPLEXITY": ("complexity", "REAL"),
    "PUBCHEM_CACTVS_HBOND_ACCEPTOR": ("hba", "REAL"),
    "PUBCHEM_CACTVS_HBOND_DONOR": ("hbd", "REAL"),
    "PUBCHEM_CACTVS_ROTATABLE_BOND": ("rotatable_bonds", "INTEGER"),
    "PUBCHEM_IUPAC_NAME": ("iupac_name", "VARCHAR(2047)"),
    "PUBCHEM_IUPAC_INCHI": ("inchi", "VARCHAR(2047)"),
    "PUBCHEM_IUPAC_INCHIKEY": ("inchi_key", "VARCHAR(2047)"),
    "PUBCHEM_XLOGP3": ("logp", "REAL"),
    "PUBCHEM_EXACT_MASS": ("exact_mass", "REAL"),
    "PUBCHEM_MOLECULAR_FORMULA": ("formula", "VARCHAR(2047)"),
    "PUBCHEM_MOLECULAR_WEIGHT": ("exact_mw", "REAL"),
    "PUBCHEM_SMILES": ("isomeric_smiles", "VARCHAR(2047)"),
    "PUBCHEM_CACTVS_TPSA": ("tspa", "REAL"),
    "PUBCHEM_MONOISOTOPIC_WEIGHT": ("mono_mass", "REAL"),
    "PUBCHEM_TOTAL_CHARGE": ("charge", "INTEGER"),
    "PUBCHEM_HEAVY_ATOM_COUNT": ("num_atoms", "INTEGER"),
    "PUBCHEM_ATOM_DEF_STEREO_COUNT": ("num_def_stereo", "INTEGER"),
    "PUBCHEM_ATOM_UDEF_STEREO_COUNT": ("num_undef_stereo", "INTEGER"),
    "PUBCHEM_BOND_DEF_STEREO_COUNT": ("num_def_double", "INTEGER"),
    "PUBCHEM_BOND_UDEF_STEREO_COUNT": ("num_undef_double", "INTEGER"),
    "PUBCHEM_ISOTOPIC_ATOM_COUNT": ("num_isotopic", "INTEGER"),
    "PUBCHEM_COMPONENT_COUNT": ("fragments", "INTEGER"),
}
_SPARK_TYPES = {"INTEGER": "int", "REAL": "float", "VARCHAR(2047)": "string"}
# Without its line end: a file may have either one, which is then left at the head of the next record.
RECORD_END = "$$$$"
_PROPERTY = r"(?m)^>[^\n]*<([^>\n]+)>[^\n]*\n((?:[^\n]++\n?+)*+)"


def lenient_cast(value: Column, kind: str) -> Column:
    """Text to a typed value; what does not parse is null. Booleans: ``true`` or ``1``."""
    if kind == "boolean":
        return F.lower(value).isin("true", "1")
    if kind in ("float", "double"):
        # a Java type letter behind the digits is not part of a number
        value = F.when(~value.rlike(r"[0-9.][dDfF]\s*$"), value)
    if kind.startswith("decimal"):
        value = F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), value)
    return value if kind == "string" else value.try_cast(kind)


def rename_properties(names: Column, values: Column, properties: Mapping[str, tuple[str, str]]) -> list[Column]:
    """One typed column per known property; an absent one is null."""
    at = lambda tag: F.get(values, (F.array_position(names, F.lit(tag)) - 1).cast("int"))
    return [lenient_cast(at(tag), kind).alias(column) for tag, (column, kind) in properties.items()]


def sql_properties() -> dict[str, tuple[str, str]]:
    return {tag: (column, _SPARK_TYPES[kind]) for tag, (column, kind) in SQL_PROPERTIES.items()}


def compound_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.DataType.fromDDL(t)) for c, t in COMPOUND_PROPERTIES.values()])


def sdf_records(spark: SparkSession, path: str | list[str], recursive: bool = False, pattern: str = "*.sdf") -> DataFrame:
    """Raw records as ``value``, with either line end in the file. Plain files are split by Spark, ``.gz``
    files are one split each. ``pattern``: names read in nested folders."""
    reader = spark.read.option("lineSep", RECORD_END)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    records = reader.text(path).withColumn("value", F.replace("value", F.lit("\r\n"), F.lit("\n")))
    return records.filter(F.contains("value", F.lit("M  END")))


def parse_sdf(records: DataFrame, properties: Mapping[str, tuple[str, str]] = COMPOUND_PROPERTIES) -> DataFrame:
    found = records.select(
        F.regexp_extract_all("value", F.lit(_PROPERTY), 1).alias("_names"),
        F.transform(
            F.regexp_extract_all("value", F.lit(_PROPERTY), 2), lambda v: F.rtrim(v, F.lit("\r\n"))
        ).alias("_values"),
    )
    return found.select(*rename_properties(F.col("_names"), F.col("_values"), properties))


def sdf_source(
    spark: SparkSession,
    path: str | list[str],
    max_records: int | None = None,
    recursive: bool = False,
    properties: Mapping[str, tuple[str, str]] = COMPOUND_PROPERTIES,
    pattern: str = "*.sdf",
) -> DataFrame:
    """Compound table from structure files; ``max_records`` counts per file. A few compressed files
    are spread over the cores ahead of parsing."""
    records = sdf_records(spark, path, recursive, pattern)
    records = per_file_cap(records, max_records) if max_records else spread(records)
    return parse_sdf(records, properties)
