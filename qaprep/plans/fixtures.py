"""Test views derived from the given tables, written once for Spark and once for DuckDB.

Molecules come from ``part``: the hex digits of md5(p_partkey) choose up to eight chain units, so
text, formula and charge are known by construction and the number of molecules grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qaprep.session import spread, write_through

# Chain unit, its C H N O P S Cl F counts, its charge.
UNITS = [
    ("C", (1, 2, 0, 0, 0, 0, 0, 0), 0),
    ("[C@H](O)", (1, 2, 0, 1, 0, 0, 0, 0), 0),
    ("O", (0, 0, 0, 1, 0, 0, 0, 0), 0),
    ("N", (0, 1, 1, 0, 0, 0, 0, 0), 0),
    ("C(=O)", (1, 0, 0, 1, 0, 0, 0, 0), 0),
    ("S", (0, 0, 0, 0, 0, 1, 0, 0), 0),
    ("C(F)", (1, 1, 0, 0, 0, 0, 0, 1), 0),
    ("C(Cl)", (1, 1, 0, 0, 0, 0, 1, 0), 0),
    ("C=C", (2, 2, 0, 0, 0, 0, 0, 0), 0),
    ("C#C", (2, 0, 0, 0, 0, 0, 0, 0), 0),
    ("c1ccccc1", (6, 4, 0, 0, 0, 0, 0, 0), 0),
    ("C1CCCCC1", (6, 10, 0, 0, 0, 0, 0, 0), 0),
    ("C%12CCC%12", (4, 6, 0, 0, 0, 0, 0, 0), 0),
    ("[N+](C)(C)", (2, 6, 1, 0, 0, 0, 0, 0), 1),
    ("C(C(=O)[O-])", (2, 1, 0, 2, 0, 0, 0, 0), -1),
    ("P(=O)(O)", (0, 1, 0, 2, 1, 0, 0, 0), 0),
]
ELEMENT_ORDER = ("C", "H", "N", "O", "P", "S", "Cl", "F")
MAX_UNITS = 8


class Dialect:
    """The few spellings in which the two engines differ."""

    def __init__(self, name: str):
        self.spark = name == "spark"

    def pick(self, values: list, index: str) -> str:
        items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        return f"element_at(array({items}), {index})" if self.spark else f"list_extract([{items}], {index})"

    def array(self, items: list[str]) -> str:
        return f"array({', '.join(items)})" if self.spark else f"[{', '.join(items)}]"

    def countdown(self, high: str, low: str) -> str:
        return f"sequence({high}, {low}, -1)" if self.spark else f"generate_series({high}, {low}, -1)"

    def head(self, items: str, n: str) -> str:
        return f"slice({items}, 1, {n})" if self.spark else f"list_slice({items}, 1, {n})"


def digit(place: int) -> str:
    """Hex digit of the row's md5 as 1 to 16."""
    return f"instr('0123456789abcdef', substr(h, {place}, 1))"


def per_unit(d: Dialect, values: list, empty: str, joiner: str) -> str:
    parts = [f"CASE WHEN k >= {i} THEN {d.pick(values, digit(i))} ELSE {empty} END" for i in range(1, MAX_UNITS + 1)]
    return joiner.join(parts)


def molecules_select(dialect: str, source: str = "part") -> str:
    d = Dialect(dialect)
    smiles = per_unit(d, [u[0] for u in UNITS], "''", " || ")
    totals = []
    for i, e in enumerate(ELEMENT_ORDER):
        ends = {"C": "2 + ", "H": "6 + CASE WHEN salt THEN 2 ELSE 0 END + ", "O": "CASE WHEN salt THEN 1 ELSE 0 END + "}
        totals.append(f"{ends.get(e, '')}{per_unit(d, [u[1][i] for u in UNITS], '0', ' + ')} AS n_{e.lower()}")
    charge = per_unit(d, [u[2] for u in UNITS], "0", " + ")
    number = lambda n: f"CASE WHEN {n} = 1 THEN '' ELSE CAST({n} AS STRING) END"
    part = lambda e: f"CASE WHEN n_{e.lower()} = 0 THEN '' ELSE '{e}' || {number('n_' + e.lower())} END"
    hill = " || ".join(part(e) for e in ("C", "H", "Cl", "F", "N", "O", "P", "S"))
    rings = d.array([d.countdown(f"{digit(20 + r)} + 4 + {digit(24 + r)} % 2", digit(20 + r)) for r in range(3)])
    flags = d.array([f"{digit(28 + r)} > 8" for r in range(3)])
    counts = ", ".join(f"CAST(n_{e.lower()} AS BIGINT) AS n_{e.lower()}" for e in ELEMENT_ORDER)
    return f"""
SELECT cid, iupac, smiles, smiles || ' ' AS alt_smiles,
  {hill} || CASE WHEN net = 0 THEN '' WHEN net > 0 THEN '+' || {number('net')} ELSE '-' || {number('(-net)')} END AS formula,
  upper(substr(md5(replace(smiles, '@', '')), 1, 14)) AS connectivity_key,
  num_atoms, CAST(net AS BIGINT) AS net_charge, valid, k AS n_units, brand, kind,
  num_def_stereo, num_undef_stereo, num_def_double, rings, ring_is_aromatic, {counts}
FROM (
  SELECT cid, num_atoms, brand, kind, k, NOT broken AS valid,
    CASE WHEN substr(h, 20, 1) = '0' THEN NULL WHEN substr(h, 20, 1) = '1' THEN '' WHEN substr(h, 20, 1) = '2' THEN '  '
         WHEN substr(h, 20, 1) = '3' THEN 'None' ELSE name END AS iupac,
    CASE WHEN labelled THEN '[2H]' ELSE '' END || 'C' || {smiles} || 'C' || CASE WHEN salt THEN '.O' ELSE '' END
      || CASE WHEN broken THEN '(' ELSE '' END AS smiles,
    {', '.join(totals)}, {charge} AS net,
    CAST(cid % 4 AS INT) AS num_def_stereo, num_atoms % 3 AS num_undef_stereo, CAST(cid % 2 AS INT) AS num_def_double,
    {d.head(rings, 'num_atoms % 4')} AS rings, {d.head(flags, 'num_atoms % 4')} AS ring_is_aromatic
  FROM (
    SELECT p_partkey AS cid, p_name AS name, p_size AS num_atoms, p_brand AS brand, p_type AS kind,
      md5(CAST(p_partkey AS STRING)) AS h, 1 + p_size % {MAX_UNITS} AS k,
      substr(md5(CAST(p_partkey AS STRING)), 17, 1) = '0' AS labelled,
      substr(md5(CAST(p_partkey AS STRING)), 18, 1) = '0' AS salt,
      substr(md5(CAST(p_partkey AS STRING)), 19, 1) = '0' AS broken
    FROM {source}) AS keyed) AS built"""


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_out(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table ahead of heavy work per row: a few files must not mean a few tasks."""
    table = read(spark, folder, name)
    return spread(table.select(*columns) if columns else table)


def molecules(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(molecules_select("spark", "{part}"), part=read(spark, folder, "part"))


def molecules_spread(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(molecules_select("spark", "{part}"), part=spread_out(spark, folder, "part"))


def molecules_table(spark: SparkSession, folder: str) -> DataFrame:
    """The view as a written table, for plans that are long themselves."""
    return write_through(molecules_spread(spark, folder), "molecules")


MOLECULES = f"WITH molecules AS ({molecules_select('duckdb')})\n"

# Gold answers and predictions from ``events``: a third is wrong, JSON ones are written differently.
PREDICTIONS_SELECT = """
SELECT event_id AS example_id, event_type AS question_id,
  'It is <answer>' || g || '</answer>' AS gold,
  CASE WHEN event_id % 3 = 0 THEN 'Maybe <answer>' || w || '</answer>.'
       WHEN event_id % 5 = 0 THEN g
       ELSE 'I say <answer>1</answer>, no: <answer> ' || p || '. </answer>' END AS prediction
FROM (
  SELECT event_id, event_type,
    CASE WHEN event_id % 4 = 0 THEN props WHEN event_id % 4 = 1 THEN '0'
         ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS g,
    CASE WHEN event_id % 4 = 0 THEN replace(replace(props, chr(125), '.0 ' || chr(125)), ': ', ':') WHEN event_id % 4 = 1 THEN '0'
         ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS p,
    CASE WHEN event_id % 8 = 0 THEN chr(123) || '"k": -1' || chr(125) WHEN event_id % 8 = 4 THEN 'none'
         ELSE CAST(CAST(floor(value) AS BIGINT) + 1 AS STRING) END AS w
  FROM {events}) AS drafted"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PREDICTIONS_SELECT, events=read(spark, folder, "events"))


PREDICTIONS = "WITH predictions AS (" + PREDICTIONS_SELECT.replace("{events}", "events") + ")\n"

# Reaction lines from three molecules per row, some repeated, some malformed.
REACTIONS_SELECT = """
SELECT cid, CASE WHEN cid % 11 = 0 THEN a || '>' || b
  ELSE a || '.' || b || '.' || a || '>' || CASE WHEN cid % 3 = 0 THEN '' ELSE 'O.[Na+:' || CAST(cid % 5 AS STRING) || ']' END
       || '>' || c END AS value
FROM (
  SELECT cid, 'C' || {f1} AS a, '[CH3:1]' || {f2} AS b, {f3} || 'C' AS c FROM (
    SELECT p_partkey AS cid, md5(CAST(p_partkey % 500 AS STRING)) AS h FROM {part}) AS keyed) AS built"""


def _reactions_select(dialect: str, source: str) -> str:
    d = Dialect(dialect)
    names = [u[0] for u in UNITS]
    text = REACTIONS_SELECT
    for i in (1, 2, 3):
        text = text.replace(f"{{f{i}}}", d.pick(names, digit(i)))
    return text.replace("{part}", source)


def reactions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(_reactions_select("spark", "{part}"), part=read(spark, folder, "part"))


REACTIONS = f"WITH reactions AS ({_reactions_select('duckdb', 'part')})\n"
