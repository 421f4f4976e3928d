"""Registered queries: fingerprints, similarity joins, diverse picks and their expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.operators import similarity as C
from qaprep.plans import fixtures as X
from qaprep.plans.registry import query
from qaprep.session import write_through

THRESHOLD = 0.7

# fingerprints in DuckDB: all character runs of length 1 to 3, unparsable text has none
FINGERPRINTS = X.MOLECULES.rstrip() + """, grams AS (
    SELECT DISTINCT cid, substr(smiles, CAST(i AS INT), CAST(g AS INT)) AS gram
    FROM (SELECT cid, smiles, unnest(generate_series(1, length(smiles))) AS i FROM molecules WHERE valid), (VALUES (1), (2), (3)) s(g)
    WHERE i + g - 1 <= length(smiles)),
  bits AS (SELECT DISTINCT cid, CAST(('0x' || substr(md5(gram), 1, 8)) AS BIGINT) % 2048 AS bit FROM grams),
  prints AS (SELECT m.cid, m.num_atoms, coalesce(list_sort(list(bit) FILTER (WHERE bit IS NOT NULL)), []) AS fp
    FROM molecules m LEFT JOIN bits b USING (cid) GROUP BY m.cid, m.num_atoms)
"""
_SHARED = "len(list_intersect(a.fp, b.fp))"
_TANIMOTO = f"({_SHARED} / (len(a.fp) + len(b.fp) - {_SHARED}))"


def prints(spark: SparkSession, folder: str) -> DataFrame:
    bits = F.when(F.col("valid"), C.fingerprint(F.col("smiles"))).otherwise(F.array().cast("array<int>"))
    return X.molecules_spread(spark, folder).select("cid", "num_atoms", bits.alias("bits"))


@query("fingerprint", FINGERPRINTS + "SELECT cid, array_to_string(fp, ' ') AS bits FROM prints")
def fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return prints(spark, folder).select("cid", F.array_join(F.col("bits").cast("array<string>"), " ").alias("bits"))


@query(
    "fingerprint_documents",
    """WITH chars AS (SELECT doc_id, string_split(text, '') AS c FROM documents),
    grams AS (SELECT DISTINCT doc_id, unnest(list_concat(c, list_transform(list_zip(c, c[2:]), lambda z: z[1] || z[2]),
      list_transform(list_zip(c, c[2:], c[3:]), lambda z: z[1] || z[2] || z[3]))) AS gram FROM chars),
    bits AS (SELECT DISTINCT doc_id, CAST(('0x' || substr(md5(gram), 1, 8)) AS BIGINT) % 2048 AS bit FROM grams WHERE gram IS NOT NULL)
    SELECT doc_id, count(*) AS n_bits, array_to_string(list_sort(list(bit)), ' ') AS bits FROM bits GROUP BY doc_id""",
)
def fingerprint_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts."""
    found = X.spread_out(spark, folder, "documents", "doc_id", "text").select("doc_id", C.fingerprint(F.col("text")).alias("fp"))
    shown = F.array_join(F.col("fp").cast("array<string>"), " ").alias("bits")
    return found.select("doc_id", F.size("fp").cast("bigint").alias("n_bits"), shown)


@query(
    "tanimoto",
    FINGERPRINTS + f"""SELECT a.cid, round(CASE WHEN len(a.fp) + len(b.fp) = 0 THEN 0.0 ELSE {_TANIMOTO} END, 6) AS similarity
      FROM prints a JOIN prints b ON b.cid = a.cid + 1""",
)
def tanimoto(spark: SparkSession, folder: str) -> DataFrame:
    """Each molecule with the next one."""
    rows = prints(spark, folder)
    following = rows.select((F.col("cid") - 1).alias("cid"), F.col("bits").alias("next_bits"))
    return rows.join(following, "cid").select("cid", F.round(C.tanimoto(F.col("bits"), F.col("next_bits")), 6).alias("similarity"))


@query(
    "similarity_join",
    FINGERPRINTS.rstrip() + f""", uniq AS (SELECT fp, min(cid) AS cid, count(*) AS n FROM prints WHERE len(fp) > 0 GROUP BY fp)
      SELECT a.cid AS id_a, b.cid AS id_b, a.n AS n_a, b.n AS n_b, round({_TANIMOTO}, 6) AS similarity
      FROM uniq a JOIN uniq b ON a.cid < b.cid AND len(a.fp) >= {THRESHOLD} * len(b.fp) AND len(b.fp) >= {THRESHOLD} * len(a.fp)
      WHERE {_TANIMOTO} >= {THRESHOLD}
      UNION ALL SELECT cid, cid, n, n, 1.0 FROM uniq WHERE n > 1""",
)
def similarity_join(spark: SparkSession, folder: str) -> DataFrame:
    pairs = C.similarity_join(prints(spark, folder), "cid", "bits", THRESHOLD)
    return pairs.withColumn("similarity", F.round("similarity", 6))


_PICKS_SQL = FINGERPRINTS.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + """, ordered AS (
    SELECT *, row_number() OVER (ORDER BY cid) AS pos FROM prints),
  scan(pos, cid, picked, leaders) AS (
    SELECT CAST(0 AS BIGINT), CAST(-1 AS BIGINT), false, CAST([] AS BIGINT[][])
    UNION ALL
    SELECT s.pos + 1, o.cid, near = 0, CASE WHEN near = 0 AND len(o.fp) > 0 THEN list_append(s.leaders, o.fp) ELSE s.leaders END
    FROM (SELECT s.*, o.fp AS ofp, len(list_filter(s.leaders, lambda q: len(list_intersect(q, o.fp)) / (len(q) + len(o.fp) - len(list_intersect(q, o.fp))) >= 0.4)) AS near
      FROM scan s JOIN ordered o ON o.pos = s.pos + 1) s JOIN ordered o ON o.pos = s.pos + 1),
  picks AS (SELECT cid FROM scan WHERE picked)
"""


@query("leader_pick", _PICKS_SQL + "SELECT cid FROM picks")
def leader_pick(spark: SparkSession, folder: str) -> DataFrame:
    return C.leader_pick(prints(spark, folder), "cid", "bits")


def with_picks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprints and the leaders among them, both written."""
    rows = write_through(prints(spark, folder), "molecule-prints")
    return rows, write_through(C.leader_pick(rows, "cid", "bits"), "leaders")


_SIMILAR_SQL = _PICKS_SQL.rstrip() + f""", nearby AS (
    SELECT a.cid, min(b.cid) AS similar_id FROM prints a JOIN picks USING (cid) JOIN prints b ON a.cid <> b.cid AND len(a.fp) > 0 AND len(b.fp) > 0
      AND b.num_atoms >= a.num_atoms * CAST(0.83 AS DOUBLE) AND b.num_atoms <= a.num_atoms * CAST(1.17 AS DOUBLE)
    WHERE {_TANIMOTO} >= 0.45 AND {_TANIMOTO} < 0.65 GROUP BY a.cid)
"""


@query("similar_join", _SIMILAR_SQL + "SELECT cid, similar_id FROM nearby")
def similar_join(spark: SparkSession, folder: str) -> DataFrame:
    rows, picks = with_picks(spark, folder)
    return C.similar_join(rows, picks, "cid", "bits", "num_atoms")


@query("merge_picks", _SIMILAR_SQL + "SELECT cid FROM picks UNION SELECT similar_id FROM nearby")
def merge_picks(spark: SparkSession, folder: str) -> DataFrame:
    rows, picks = with_picks(spark, folder)
    return C.merge_picks(picks, C.similar_join(rows, picks, "cid", "bits", "num_atoms"), "cid")


@query(
    "expand_picks",
    _SIMILAR_SQL + "SELECT cid, num_atoms FROM molecules WHERE cid IN (SELECT cid FROM picks UNION SELECT similar_id FROM nearby)",
)
def expand_picks(spark: SparkSession, folder: str) -> DataFrame:
    rows, picks = with_picks(spark, folder)
    return C.expand_picks(rows, picks, "cid", "bits", "num_atoms").select("cid", "num_atoms")
