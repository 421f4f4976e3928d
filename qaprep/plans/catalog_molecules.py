"""Registered queries: columns from SMILES, formulas and ring arrays, and the question sets.

The SQL works from how the molecules were put together, not from the scanning expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions import rings as R
from qaprep.functions import smiles as S
from qaprep.plans import fixtures as X
from qaprep.plans import question_sets as Q
from qaprep.plans.registry import query

M = X.MOLECULES
_if = lambda value: f"CASE WHEN valid THEN {value} ELSE 0 END"
# atoms by construction: the counted elements without hydrogen, one more when deuterium is written
_HEAVY = "n_c + n_n + n_o + n_p + n_s + n_cl + n_f"
_LABEL = "CASE WHEN starts_with(smiles, '[2H]') THEN 1 ELSE 0 END"
_SALT = "CASE WHEN contains(smiles, '.') THEN 1 ELSE 0 END"


def _marks(text: str, mark: str) -> str:
    return f"((length({text}) - length(replace({text}, '{mark}', ''))) // {len(mark)})"


_RINGS = f"({_marks('smiles', 'c1ccccc1')} + {_marks('smiles', 'C1CCCCC1')} + {_marks('smiles', 'C%12CCC%12')})"
_AROMATIC = "contains(smiles, 'c1ccccc1')"


@query(
    "smiles_tokens",
    M + r"""SELECT cid, CAST(i - 1 AS INT) AS pos, t[i] AS token, CASE WHEN starts_with(t[i], '[') OR regexp_full_match(t[i], '[A-Za-z]+') THEN 'atom'
      WHEN regexp_full_match(t[i], '%?[0-9]+') THEN 'closure' WHEN t[i] = '.' THEN 'dot' WHEN t[i] IN ('(', ')') THEN 'branch' ELSE 'bond' END AS kind
      FROM (SELECT cid, t, unnest(generate_series(1, len(t))) AS i
        FROM (SELECT cid, regexp_extract_all(smiles, '\[[^\]]+\]|Br|Cl|%[0-9][0-9]|[A-Za-z0-9=#().]') AS t FROM molecules))""",
)
def smiles_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return S.smiles_tokens(X.molecules_spread(spark, folder))


@query(
    "element_counts",
    M + f"""SELECT cid, {', '.join(f'{_if("n_" + e.lower())} AS {e.lower()}_atoms' for e in S.ELEMENTS)} FROM molecules""",
)
def element_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = X.molecules(spark, folder).select("cid", S.element_counts(F.col("smiles")).alias("n"))
    return counts.select("cid", *[F.col(f"n.{e}").alias(f"{e.lower()}_atoms") for e in S.ELEMENTS])


@query("heavy_atom_count", M + f"SELECT cid, {_if(_HEAVY)} AS heavy_atoms FROM molecules")
def heavy_atom_count(spark: SparkSession, folder: str) -> DataFrame:
    return X.molecules(spark, folder).select("cid", S.heavy_atom_count(F.col("smiles")).alias("heavy_atoms"))


@query(
    "charge_counts",
    M + f"""SELECT cid, {_if(_marks('smiles', '[N+]'))} AS positive, {_if(_marks('smiles', '[O-]'))} AS negative, {_if('net_charge')} AS net FROM molecules""",
)
def charge_counts(spark: SparkSession, folder: str) -> DataFrame:
    charges = X.molecules(spark, folder).select("cid", S.charge_counts(F.col("smiles")).alias("c"))
    return charges.select("cid", "c.positive", "c.negative", "c.net")


_LINKS = f"({_RINGS} - 1 - {_SALT})"


@query(
    "bond_counts",
    M + f"""SELECT cid, {_if(f'{_HEAVY} + {_LABEL} + {_LINKS}')} AS all_bonds,
      CASE WHEN valid AND {_AROMATIC} THEN NULL ELSE {_if(_marks('smiles', '='))} END AS double_bonds,
      {_if(_marks('smiles', '#'))} AS triple_bonds, {_if(f'{_HEAVY} + {_LINKS}')} AS non_hydrogen_bonds,
      valid AND {_AROMATIC} AS aromatic_input FROM molecules""",
)
def bond_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = X.molecules(spark, folder).select("cid", S.bond_counts(F.col("smiles")).alias("b"))
    return counted.select("cid", "b.*")


@query("ring_count", M + f"SELECT cid, {_if(_RINGS)} AS rings FROM molecules")
def ring_count(spark: SparkSession, folder: str) -> DataFrame:
    return X.molecules(spark, folder).select("cid", S.ring_count(F.col("smiles")).alias("rings"))


@query(
    "formula_counts",
    M + " UNION ALL ".join(
        f"SELECT cid, '{e}' AS element, CAST(n_{e.lower()} AS INT) AS n FROM molecules WHERE n_{e.lower()} > 0" for e in X.ELEMENT_ORDER
    ),
)
def formula_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = S.formula_counts(F.col("formula"))
    return X.molecules(spark, folder).select("cid", F.explode(counts).alias("element", "n"))


@query("hydrogen_count", M + "SELECT cid, n_h AS hydrogens FROM molecules")
def hydrogen_count(spark: SparkSession, folder: str) -> DataFrame:
    return X.molecules(spark, folder).select("cid", S.hydrogen_count(F.col("formula")).alias("hydrogens"))


@query("molecular_formula", M + "SELECT cid, formula AS molecular_formula FROM molecules")
def molecular_formula(spark: SparkSession, folder: str) -> DataFrame:
    """Built again from counts that were shuffled into another order and the charge in the SMILES."""
    backwards = F.array_join(F.reverse(F.regexp_extract_all("formula", F.lit("([A-Z][a-z]?[0-9]*)"), 1)), "")
    charge = F.aggregate(S.atom_charges(F.col("smiles")), F.lit(0), lambda a, c: a + c)
    text = S.hill_formula(S.formula_counts(backwards), charge)
    return X.molecules(spark, folder).select("cid", text.alias("molecular_formula"))


@query(
    "stereo_summary",
    M + "SELECT cid, CAST(num_def_stereo + num_undef_stereo AS BIGINT) AS stereocenters, CAST(num_def_double AS BIGINT) AS stereo_bonds FROM molecules",
)
def stereo_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = R.stereo_summary(F.col("num_def_stereo"), F.col("num_undef_stereo"), F.col("num_def_double"))
    return X.molecules(spark, folder).select("cid", summary.alias("s")).select("cid", "s.*")


@query(
    "sort_rings",
    M + """, each AS (SELECT cid, unnest(rings) AS ring FROM molecules),
      texts AS (SELECT cid, list_max(ring) AS hi, list_min(ring) AS lo, array_to_string(list_sort(ring), ' ') AS t FROM each)
      SELECT m.cid, coalesce(string_agg(t, '|' ORDER BY hi, lo, t), '') AS rings FROM molecules m LEFT JOIN texts USING (cid) GROUP BY m.cid""",
)
def sort_rings(spark: SparkSession, folder: str) -> DataFrame:
    text = lambda r: F.array_join(r.cast("array<string>"), " ")
    rings = R.sort_rings(F.col("rings"))
    return X.molecules(spark, folder).select("cid", F.array_join(F.transform(rings, text), "|").alias("rings"))


@query(
    "ring_size_counts",
    M + """, each AS (SELECT cid, len(unnest(rings)) AS size, unnest(ring_is_aromatic) AS flag FROM molecules)
      SELECT m.cid, count(size) AS total_rings, count(*) FILTER (WHERE size = 5) AS five_membered_rings, count(*) FILTER (WHERE size = 6) AS six_membered_rings,
        count(*) FILTER (WHERE flag) AS aromatic_rings, count(*) FILTER (WHERE flag AND size = 5) AS aromatic_five_membered_rings,
        count(*) FILTER (WHERE flag AND size = 6) AS aromatic_six_membered_rings
      FROM molecules m LEFT JOIN each USING (cid) GROUP BY m.cid""",
)
def ring_size_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = R.ring_size_counts(F.col("rings"), F.col("ring_is_aromatic"))
    return X.molecules(spark, folder).select("cid", counts.alias("n")).select("cid", "n.*")


@query(
    "fused_ring_count",
    M + """, each AS (SELECT cid, unnest(rings) AS ring, unnest(generate_series(1, len(rings))) AS no FROM molecules),
      fused AS (SELECT DISTINCT a.cid, a.no FROM each a JOIN each b ON a.cid = b.cid AND a.no <> b.no AND len(list_intersect(a.ring, b.ring)) >= 2)
      SELECT m.cid, count(f.no) AS fused_rings FROM molecules m LEFT JOIN fused f USING (cid) GROUP BY m.cid""",
)
def fused_ring_count(spark: SparkSession, folder: str) -> DataFrame:
    return X.molecules(spark, folder).select("cid", R.fused_ring_count(F.col("rings")).alias("fused_rings"))


def _unit_graph_sql() -> str:
    """Bonds inside each chain unit (first atom 0) and the atom the next unit hangs on, as values."""
    inner = {
        "[C@H](O)": [(0, 1, "", False)], "C(=O)": [(0, 1, "=", False)], "C(F)": [(0, 1, "", False)], "C(Cl)": [(0, 1, "", False)],
        "C=C": [(0, 1, "=", False)], "C#C": [(0, 1, "#", False)],
        "c1ccccc1": [(i, i + 1, "", False) for i in range(5)] + [(0, 5, "", True)],
        "C1CCCCC1": [(i, i + 1, "", False) for i in range(5)] + [(0, 5, "", True)],
        "C%12CCC%12": [(i, i + 1, "", False) for i in range(3)] + [(0, 3, "", True)],
        "[N+](C)(C)": [(0, 1, "", False), (0, 2, "", False)],
        "C(C(=O)[O-])": [(0, 1, "", False), (1, 2, "=", False), (1, 3, "", False)],
        "P(=O)(O)": [(0, 1, "=", False), (0, 2, "", False)],
    }
    last = {"C=C": 1, "C#C": 1, "c1ccccc1": 5, "C1CCCCC1": 5, "C%12CCC%12": 3}
    units = ", ".join(
        f"({i}, {sum(u[1]) - u[1][1]}, {last.get(u[0], 0)})" for i, u in enumerate(X.UNITS, start=1)
    )
    bonds = ", ".join(
        f"({i}, {a}, {b}, '{o}', {str(r).lower()})" for i, u in enumerate(X.UNITS, start=1) for a, b, o, r in inner.get(u[0], [])
    )
    return f"units(unit, size, last) AS (VALUES {units}), unit_bonds(unit, a, b, o, r) AS (VALUES {bonds})"


_GRAPH = M.rstrip() + f""", {_unit_graph_sql()},
      placed AS (SELECT cid, place, instr('0123456789abcdef', substr(md5(CAST(cid AS VARCHAR)), CAST(place AS INT), 1)) AS unit
        FROM (SELECT cid, unnest(generate_series(1, n_units)) AS place FROM molecules WHERE valid)),
      ends AS (SELECT cid, 0 AS place, 1 AS size, 0 AS last, 0 AS unit FROM molecules WHERE valid
        UNION ALL SELECT cid, n_units + 1, 1, 0, 0 FROM molecules WHERE valid),
      chain AS (SELECT cid, place, size, last, unit FROM placed JOIN units USING (unit) UNION ALL SELECT * FROM ends),
      numbered AS (SELECT c.cid, place, last, unit, {_LABEL} + coalesce(sum(size) OVER (PARTITION BY c.cid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
        FROM chain c JOIN molecules m USING (cid)),
      linked AS (SELECT cid, lag(first + last) OVER (PARTITION BY cid ORDER BY place) AS a, first AS b FROM numbered),
      bonds AS (
        SELECT cid, CAST(a AS INT) AS a, CAST(b AS INT) AS b, '' AS bond_order, false AS ring_closure FROM linked WHERE a IS NOT NULL
        UNION ALL SELECT n.cid, CAST(n.first + u.a AS INT), CAST(n.first + u.b AS INT), u.o, u.r FROM numbered n JOIN unit_bonds u USING (unit)
        UNION ALL SELECT cid, 0, 1, '', false FROM molecules WHERE valid AND starts_with(smiles, '[2H]'))
"""


@query("bond_table", _GRAPH + "SELECT cid, a, b, bond_order, ring_closure FROM bonds")
def bond_table(spark: SparkSession, folder: str) -> DataFrame:
    return S.bond_table(X.molecules_spread(spark, folder))


# carbons outside rings inside each unit; the end atoms are carbons too
_OPEN = {"C": [0], "[C@H](O)": [0], "C(=O)": [0], "C(F)": [0], "C(Cl)": [0], "C=C": [0, 1], "C#C": [0, 1], "[N+](C)(C)": [1, 2], "C(C(=O)[O-])": [0, 1]}
_OPEN_SQL = ", ".join(f"({i}, {at})" for i, u in enumerate(X.UNITS, start=1) for at in _OPEN.get(u[0], [])) + ", (0, 0)"
# all walks over open carbons. Of equally long ones the first is that with the lowest start, then with the
# lowest turning point (an atom's number is above that of the atom it is bonded to), then with the lowest end
_CHAINS = _GRAPH.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""", unit_open(unit, place_in) AS (VALUES {_OPEN_SQL}),
      open_atoms AS (SELECT n.cid, n.first + u.place_in AS atom FROM numbered n JOIN unit_open u USING (unit)),
      steps AS (
        SELECT k.cid, k.a AS x, k.b AS y FROM bonds k JOIN open_atoms p ON p.cid = k.cid AND p.atom = k.a JOIN open_atoms q ON q.cid = k.cid AND q.atom = k.b
        UNION ALL SELECT k.cid, k.b, k.a FROM bonds k JOIN open_atoms p ON p.cid = k.cid AND p.atom = k.a JOIN open_atoms q ON q.cid = k.cid AND q.atom = k.b),
      walks AS (
        SELECT cid, atom AS here, -1 AS came, [atom] AS path FROM open_atoms
        UNION ALL SELECT w.cid, s.y, w.here, list_append(w.path, s.y) FROM walks w JOIN steps s ON s.cid = w.cid AND s.x = w.here AND s.y <> w.came),
      chains AS (SELECT cid, list_sort(arg_min(path, [-len(path), path[1], list_min(path), here])) AS path FROM walks GROUP BY cid)
"""


@query(
    "longest_chain",
    _CHAINS + """SELECT m.cid, smiles, coalesce(array_to_string(list_transform(path, lambda x: CAST(x + 1 AS BIGINT)), ' '), '') AS chain
      FROM molecules m LEFT JOIN chains c USING (cid)""",
)
def longest_chain(spark: SparkSession, folder: str) -> DataFrame:
    linked = X.molecules_spread(spark, folder).select("cid", "smiles", R.chain_bonds(F.col("smiles")).alias("links"))
    chain = R.longest_chain(F.col("smiles"), F.col("links"))
    return linked.select("cid", "smiles", F.array_join(chain.cast("array<string>"), " ").alias("chain"))


@query("longest_chain_length", _CHAINS + "SELECT m.cid, coalesce(len(path), 0) AS chain_length FROM molecules m LEFT JOIN chains c USING (cid)")
def longest_chain_length(spark: SparkSession, folder: str) -> DataFrame:
    linked = X.molecules_spread(spark, folder).select("cid", "smiles", R.chain_bonds(F.col("smiles")).alias("links"))
    chain = R.longest_chain(F.col("smiles"), F.col("links"))
    return linked.select("cid", F.size(chain).alias("chain_length"))


@query(
    "property_set",
    _CHAINS + f"""SELECT cid, '{{"longest_carbon_chain": [' || coalesce(array_to_string(list_transform(c.path, lambda x: CAST(x + 1 AS BIGINT)), ', '), '') || ']}}' AS longest_chain, CAST(n_h AS VARCHAR) AS hydrogen_count, CAST({_HEAVY} AS VARCHAR) AS heavy_atom_count, CAST(net_charge AS VARCHAR) AS net_formal_charge,
      smiles AS kekulized_smiles, coalesce(rings, '') AS sorted_rings,
      '{{"total_rings": ' || len(rings_list) || ', "aromatic_rings": ' || len(list_filter(ring_is_aromatic, lambda x: x)) || ', "five_membered_rings": ' ||
        len(list_filter(rings_list, lambda x: len(x) = 5)) || ', "six_membered_rings": ' || len(list_filter(rings_list, lambda x: len(x) = 6)) || '}}' AS ring_counts,
      '{{"all_bonds": ' || ({_HEAVY} + {_LABEL} + {_LINKS}) || ', "double_bonds": ' || {_marks('smiles', '=')} || ', "triple_bonds": ' || {_marks('smiles', '#')} || '}}' AS bond_counts,
      '{{"C": ' || n_c || ', "N": ' || n_n || ', "O": ' || n_o || ', "P": ' || n_p || ', "S": ' || n_s || ', "Cl": ' || n_cl || ', "F": ' || n_f || '}}' AS element_counts,
      '{{"stereocenters": ' || (num_def_stereo + num_undef_stereo) || ', "stereo_bonds": ' || num_def_double || '}}' AS stereo_summary,
      formula AS molecular_formula, coalesce(iupac, 'None') AS iupac_name
      FROM (SELECT m.* REPLACE ('{{"rings": [' || coalesce(r.texts, '') || ']}}' AS rings), m.rings AS rings_list FROM molecules m LEFT JOIN (
        SELECT cid, string_agg('[' || array_to_string(list_sort(ring), ', ') || ']', ', ' ORDER BY list_max(ring), list_min(ring)) AS texts
        FROM (SELECT cid, unnest(rings) AS ring FROM molecules) GROUP BY cid) r USING (cid)) LEFT JOIN chains c USING (cid)
      WHERE valid AND NOT {_AROMATIC} AND (iupac IS NULL OR trim(iupac) <> '')""",
)
def property_set(spark: SparkSession, folder: str) -> DataFrame:
    """Every answer column."""
    answered = Q.question_set("molecular_properties")(X.molecules_table(spark, folder))
    return answered.select(
        "cid", "longest_chain", "hydrogen_count", "heavy_atom_count", "net_formal_charge", "kekulized_smiles", "element_counts", "sorted_rings",
        "ring_counts", "bond_counts", "stereo_summary", "molecular_formula", "iupac_name",
    )


@query(
    "question_set",
    M + f"""SELECT cid, CAST(n_c AS VARCHAR) AS carbon_count, CAST({_RINGS} AS VARCHAR) AS ring_count,
      CAST({_marks('smiles', '#')} AS VARCHAR) AS triple_bond_count, CAST({_HEAVY} + {_LINKS} AS VARCHAR) AS non_hydrogen_bond_count,
      CAST({_marks('smiles', '=')} AS VARCHAR) AS double_bond_count, {', '.join(f"CAST(n_{e.lower()} AS VARCHAR) AS {n}_count" for n, e in Q.SCALAR_ELEMENTS.items() if e != 'C')},
      CAST({_marks('smiles', '[N+]')} AS VARCHAR) AS positive_formal_charge_count, CAST({_marks('smiles', '[O-]')} AS VARCHAR) AS negative_formal_charge_count
      FROM molecules WHERE valid AND NOT {_AROMATIC} AND (iupac IS NULL OR trim(iupac) <> '')""",
)
def all_properties(spark: SparkSession, folder: str) -> DataFrame:
    answered = Q.question_set("all_properties")(X.molecules_table(spark, folder))
    return answered.select("cid", *Q.scalar_counts(F.lit("C")))


@query("iupac_naming", M + "SELECT cid, smiles, iupac, iupac AS iupac_name FROM molecules WHERE trim(iupac) <> ''")
def iupac_naming(spark: SparkSession, folder: str) -> DataFrame:
    return Q.question_set("iupac_naming")(X.molecules(spark, folder).select("cid", "smiles", "iupac"))
