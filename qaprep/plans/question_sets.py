"""Question sets: named transforms that add the answer columns of a set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.functions import rings as R
from qaprep.functions import smiles as S
from qaprep.functions.text import as_text
from qaprep.operators.filters import answers_valid, nonblank, replace_answers, require_columns
from qaprep.operators.isomers import isomer_questions

# Answer columns that must come with the input, as no column expression gives them.
SUPPLIED = ("kekulized_smiles_atom_map", "hybridization_indices")
# Columns that answers are computed from, when the table has them.
ANSWER_INPUTS = ("rings", "ring_is_aromatic", "num_def_stereo", "num_undef_stereo", "num_def_double")
SCALAR_ELEMENTS = {
    "carbon": "C", "nitrogen": "N", "oxygen": "O", "sulfur": "S", "phosphorus": "P", "chlorine": "Cl", "fluorine": "F",
}


def answer_json(pairs: dict[str, Column]) -> Column:
    """``{"name": value, ...}`` with the blanks Python's ``json.dumps`` writes; arrays allowed."""
    parts: list[Column] = [F.lit("{")]
    for i, (name, value) in enumerate(pairs.items()):
        parts += [F.lit(f'{", " if i else ""}"{name}": '), value.cast("string")]
    return F.concat(*parts, F.lit("}"))


def json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items.cast("array<string>"), ", "), F.lit("]"))


def json_nested(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, json_list), ", "), F.lit("]"))


def scalar_counts(smiles: Column | S.Scan, kekulized: Column | S.Scan | None = None) -> dict[str, Column]:
    """Single-number answers, by the names the templates use; bonds from the Kekule form, if there is one."""
    charge, bond = S.charge_counts(smiles), S.bond_counts(smiles if kekulized is None else kekulized)
    counts = {f"{name}_count": S.element_count(smiles, e) for name, e in SCALAR_ELEMENTS.items()}
    return counts | {
        "ring_count": S.ring_count(smiles),
        "double_bond_count": bond["double_bonds"],
        "triple_bond_count": bond["triple_bonds"],
        "non_hydrogen_bond_count": bond["non_hydrogen_bonds"],
        "positive_formal_charge_count": charge["positive"],
        "negative_formal_charge_count": charge["negative"],
    }


def property_answers(df: DataFrame, smiles: S.Scan, links: Column) -> dict[str, Column]:
    """The answer columns this table has the inputs for; ``links`` are the bonds the chain reads."""
    formula = F.col("formula")
    # a supplied Kekule form has the bonds the count is about
    kekulized = S.scan(F.col("kekulized_smiles")) if "kekulized_smiles" in df.columns else smiles
    bond, charge = S.bond_counts(kekulized), S.charge_counts(smiles)
    hill = S.hill_formula(S.formula_counts(formula), charge["net"])
    answers = {
        "longest_chain": answer_json({"longest_carbon_chain": json_list(R.longest_chain(smiles, links))}),
        "hydrogen_count": F.when(smiles.valid, S.hydrogen_count(formula)).otherwise(F.lit(0)),
        "heavy_atom_count": S.heavy_atom_count(smiles),
        "net_formal_charge": charge["net"],
        "kekulized_smiles": smiles.text,
        "element_counts": answer_json({e: S.element_count(smiles, e) for e in S.ELEMENTS}),
        "bond_counts": answer_json({n: bond[n] for n in ("all_bonds", "double_bonds", "triple_bonds")}),
        "molecular_formula": F.when(smiles.valid, hill).otherwise(""),
    }
    if "kekulized_smiles" in df.columns:
        answers["kekulized_smiles"] = F.col("kekulized_smiles")
    if "rings" in df.columns:
        flags = F.col("ring_is_aromatic") if "ring_is_aromatic" in df.columns else None
        sizes = R.ring_size_counts(F.col("rings"), flags)
        names = ["total_rings", "aromatic_rings", "five_membered_rings", "six_membered_rings"]
        answers["sorted_rings"] = answer_json({"rings": json_nested(R.sort_rings(F.col("rings")))})
        answers["ring_counts"] = answer_json({n: sizes[n] for n in names if flags is not None or n != "aromatic_rings"})
    if {"num_def_stereo", "num_undef_stereo", "num_def_double"} <= set(df.columns):
        stereo = R.stereo_summary(F.col("num_def_stereo"), F.col("num_undef_stereo"), F.col("num_def_double"))
        answers["stereo_summary"] = answer_json({n: stereo[n] for n in ("stereocenters", "stereo_bonds")})
    return answers | {name: F.col(name) for name in SUPPLIED if name in df.columns}


def _with_answers(df: DataFrame, scalars: bool) -> DataFrame:
    """All answers as text; rows with an empty or an unknown one are dropped. Only a null name is the
    text ``None``, as in a stringified list, and stays.

    Computed answers are numbers or JSON. They are empty for a row that does not parse or has no formula,
    and null where an input is null or the bonds of an aromatic text are not known: testing that, the
    name and the supplied columns comes to the same, before anything is computed.
    """
    require_columns(df, ["smiles", "formula", "iupac"])
    supplied = [c for c in ("kekulized_smiles", *SUPPLIED) if c in df.columns]
    table, smiles = S.with_scan(df)
    known = smiles.valid & F.col("formula").rlike("[A-Z]") & answers_valid(["iupac", *supplied])
    for name in (c for c in (*supplied, *ANSWER_INPUTS) if c in df.columns):
        known &= F.col(name).isNotNull()
    if "kekulized_smiles" in df.columns:
        kekulized = F.col("kekulized_smiles")
        known &= S.parsable(kekulized) & ~S.is_aromatic_text(kekulized)
    else:
        known &= ~S.is_aromatic_text(smiles)
    table = table.filter(known)
    table = table.withColumn("_links", S.bonds(smiles.text))
    answers = property_answers(df, smiles, F.col("_links"))
    if scalars:
        answers |= scalar_counts(smiles, F.col("kekulized_smiles") if "kekulized_smiles" in df.columns else None)
    answers["iupac_name"] = F.col("iupac")
    named = replace_answers(table, {name: as_text(value) for name, value in answers.items()})
    return named.drop("_links", *S.SCAN_COLUMNS)


def molecular_properties(df: DataFrame) -> DataFrame:
    """The property answers and the name."""
    return _with_answers(df, scalars=False)


def property_counts(df: DataFrame) -> DataFrame:
    """Property answers, the single-number answers next to them, and the name."""
    return _with_answers(df, scalars=True)


def iupac_naming(df: DataFrame) -> DataFrame:
    """Rows with a name, and the name as the answer."""
    require_columns(df, ["iupac"])
    return replace_answers(nonblank(df, "iupac"), {"iupac_name": F.col("iupac")})


def structure(df: DataFrame) -> DataFrame:
    """Isomer multiple choice; needs ``connectivity_key`` and ``alt_smiles`` next to the structure."""
    require_columns(df, ["cid", "smiles", "formula", "connectivity_key", "alt_smiles"])
    usable = df.withColumn("connectivity_key", F.when(S.parsable(F.col("smiles")), F.col("connectivity_key")))
    answers = isomer_questions(usable)
    return df.drop(*[c for c in answers.columns if c != "cid"]).join(answers, "cid")


QUESTION_SETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "all_properties": property_counts,
    "iupac_naming": iupac_naming,
    "molecular_properties": molecular_properties,
    "structure": structure,
}


def question_set(name: str) -> Callable[[DataFrame], DataFrame]:
    if name not in QUESTION_SETS:
        raise ValueError(f"unknown question set: {name}")
    return QUESTION_SETS[name]
