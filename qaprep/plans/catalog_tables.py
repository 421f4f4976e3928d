"""Registered queries: filters, joins, aggregations, row numbers, samples, splits, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions.templates import Template
from qaprep.operators import filters as P
from qaprep.operators import indexing as W
from qaprep.operators import isomers as J
from qaprep.operators import sampling as O
from qaprep.operators.joins import sliced_join
from qaprep.plans import fixtures as X
from qaprep.plans.generate import expand_templates
from qaprep.plans.question_sets import question_set
from qaprep.plans.registry import query
from qaprep.session import new_folder
from qaprep.sources import tables

M = X.MOLECULES
BLANKS = "chr(9) || chr(10) || chr(13) || ' '"


def draw_sql(seed: int, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


# --- filters -----------------------------------------------------------------------------------


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return X.read(spark, folder, "documents").drop("text").join(X.read(spark, folder, "labels"), "doc_id", "left")


@query("drop_null_columns", "SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d LEFT JOIN labels l USING (doc_id)")
def drop_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    return P.drop_null_columns(_labelled(spark, folder))


@query("range_filter", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 3 AND 40")
def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    part = X.read(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return P.range_filter(part, "p_size", 3, 40)


@query("nonblank_filter", M + f"SELECT cid, iupac FROM molecules WHERE iupac IS NOT NULL AND trim(iupac, {BLANKS}) <> ''")
def nonblank_filter(spark: SparkSession, folder: str) -> DataFrame:
    return P.nonblank(X.molecules(spark, folder).select("cid", "iupac"), "iupac")


@query(
    "all_answers_mask",
    M + f"""SELECT cid, trim(coalesce(iupac, 'None'), {BLANKS}) <> '' AND trim(smiles, {BLANKS}) <> ''
      AND trim(CAST(num_atoms AS VARCHAR)) <> '' AS is_valid FROM molecules""",
)
def all_answers_mask(spark: SparkSession, folder: str) -> DataFrame:
    mask = P.answers_valid(["iupac", "smiles", "num_atoms"])
    return X.molecules(spark, folder).select("cid", mask.alias("is_valid"))


@query("not_empty_string", M + "SELECT cid, iupac FROM molecules WHERE iupac <> ''")
def not_empty_string(spark: SparkSession, folder: str) -> DataFrame:
    return P.not_empty(X.molecules(spark, folder).select("cid", "iupac"), "iupac")


@query(
    "clean_molecules",
    M + """SELECT cid, smiles, iupac, num_atoms FROM molecules WHERE num_atoms >= 3 AND strpos(smiles, '.') = 0
      AND strpos(iupac, 'None') = 0 AND strpos(smiles, '[2H]') = 0""",
)
def clean_molecules(spark: SparkSession, folder: str) -> DataFrame:
    return P.clean_molecules(X.molecules(spark, folder).select("cid", "smiles", "iupac", "num_atoms"))


@query(
    "replace_answer_cols",
    M + """SELECT cid, num_atoms, coalesce(iupac, 'None') AS iupac, length(smiles) AS n_characters
      FROM molecules WHERE iupac IS NULL OR iupac <> ''""",
)
def replace_answer_cols(spark: SparkSession, folder: str) -> DataFrame:
    table = X.molecules(spark, folder).select("cid", "iupac", "num_atoms", "smiles")
    answers = {"iupac": F.coalesce("iupac", F.lit("None")), "n_characters": F.length("smiles").cast("bigint")}
    valid = F.col("iupac").isNull() | (F.col("iupac") != "")
    return P.replace_answers(table, answers, valid).drop("smiles")


@query(
    "response_status",
    """SELECT page_id, CASE WHEN page_id % 7 = 1 THEN 'http_error' WHEN page_id % 7 = 2 THEN 'throttled'
      WHEN page_id % 7 = 3 THEN 'invalid_id' WHEN page_id % 7 = 4 THEN 'fault' WHEN page_id % 7 = 5 THEN 'no_record'
      WHEN page_id % 7 = 6 THEN 'wrong_heading' ELSE 'ok' END AS state FROM pages""",
)
def response_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = responses(spark, folder)
    state = P.response_status(F.col("status"), F.col("header"), F.col("body"))
    return rows.select("page_id", state.alias("state"))


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched records made from ``pages``: one in seven is accepted, the others fail in their own way."""
    kind = F.col("page_id") % 7
    record = lambda heading: F.to_json(
        F.struct(
            F.struct(
                F.col("page_id").alias("RecordNumber"),
                F.struct(F.array(F.lit(heading)).alias("TOCHeading")).alias("Section"),
                F.col("url").alias("Url"),
            ).alias("Record")
        )
    )
    body = (
        F.when(kind == 3, "Invalid record number")
        .when(kind == 4, F.to_json(F.struct(F.struct(F.lit("busy").alias("Message")).alias("Fault"))))
        .when(kind == 5, F.to_json(F.struct(F.col("url"))))
        .when(kind == 6, record("Other"))
        .otherwise(record("Preferred Compound"))
    )
    return X.read(spark, folder, "pages").select(
        "page_id",
        F.when(kind == 1, 503).otherwise(200).alias("status"),
        F.when(kind == 2, "Request Count status: Yellow (60%)").otherwise("Green (0%)").alias("header"),
        body.alias("body"),
    )


@query("require_columns", "SELECT p_partkey AS cid, p_size AS num_atoms FROM part")
def require_columns(spark: SparkSession, folder: str) -> DataFrame:
    table = X.molecules(spark, folder).select("cid", "num_atoms")
    return P.require_columns(table, ["cid", "num_atoms"])


# --- joins ---------------------------------------------------------------------------------------


@query("id_semi_join", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def id_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    ids = X.read(spark, folder, "labels").filter("quality = 1")
    return P.id_semi_join(X.read(spark, folder, "documents").select("doc_id", "lang", "n_chars"), ids, "doc_id")


@query("resume_anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    return P.resume_anti_join(X.read(spark, folder, "documents").select("doc_id"), X.read(spark, folder, "labels"), "doc_id")


TEMPLATES = [
    Template("atoms", "How many atoms has {smiles}?\n", "There are <answer>{num_atoms}</answer>\n"),
    Template("name", "Name {smiles} in braces {{}}.", "It is <answer>{iupac}</answer>"),
]


@query(
    "expand_templates",
    M + """SELECT t.question_id, t.question_template, t.assistant_template, 'train' AS split, cid, smiles, num_atoms, iupac
      FROM molecules, (VALUES
        ('atoms', 'How many atoms has {smiles}?' || chr(10), 'There are <answer>{num_atoms}</answer>' || chr(10)),
        ('name', 'Name {smiles} in braces {{}}.', 'It is <answer>{iupac}</answer>')
      ) t(question_id, question_template, assistant_template)""",
)
def expand(spark: SparkSession, folder: str) -> DataFrame:
    table = X.molecules(spark, folder).select("cid", "smiles", "num_atoms", "iupac")
    return expand_templates(table, TEMPLATES).select(
        "question_id", "question_template", "assistant_template", "split", "metadata.*"
    )


@query(
    "isomer_pairs",
    M + """SELECT a.cid, a.formula, a.connectivity_key, CAST(count(*) AS BIGINT) AS n_isomers
      FROM molecules a JOIN molecules b ON a.formula = b.formula AND a.connectivity_key <> b.connectivity_key
      GROUP BY 1, 2, 3""",
)
def isomer_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return J.isomer_pairs(X.molecules_table(spark, folder))


def _isomer_sql(formula: str, key: str, condition: str) -> str:
    """Positions by window functions, draws as in the library."""
    hit = lambda slot: f"CAST(('0x' || substr(md5('42:' || CAST(cid AS VARCHAR) || ':{slot}'), 1, 8)) AS BIGINT)"
    return f"""rows_ AS (
      SELECT cid, smiles, alt_smiles, {formula} AS f, {key} AS k,
        row_number() OVER (PARTITION BY {formula} ORDER BY {key}, cid) - 1 AS pos,
        count(*) OVER (PARTITION BY {formula}) AS n_formula, count(*) OVER (PARTITION BY {formula}, {key}) AS n_key,
        rank() OVER (PARTITION BY {formula} ORDER BY {key}) - 1 AS key_first
      FROM molecules WHERE {condition}),
    sized AS (SELECT *, n_formula - n_key AS m, {hit(0)} AS h0, {hit(1)} AS h1, {hit(2)} AS h2 FROM rows_ WHERE n_formula > n_key),
    one AS (SELECT *, CASE WHEN m >= 3 THEN h0 % greatest(m - 2, 1) ELSE 0 END AS o0 FROM sized),
    two AS (SELECT *, CASE WHEN m >= 3 THEN CASE WHEN h1 % greatest(m - 1, 1) = o0 THEN m - 2 ELSE h1 % greatest(m - 1, 1) END
      WHEN m = 2 THEN 1 ELSE h1 % m END AS o1 FROM one),
    three AS (SELECT *, CASE WHEN m >= 3 AND h2 % m NOT IN (o0, o1) THEN h2 % m WHEN m >= 3 THEN m - 1 ELSE h2 % m END AS o2 FROM two),
    draws AS (
      SELECT cid, f, smiles, alt_smiles, s.slot, s.slot >= m AS repeated,
        CASE s.slot WHEN 0 THEN o0 WHEN 1 THEN o1 ELSE o2 END AS o, key_first, n_key
      FROM three, (VALUES (0), (1), (2)) s(slot)),
    fetched AS (
      SELECT d.cid, d.slot, d.repeated, b.cid AS candidate_cid, b.smiles AS c_smiles, b.alt_smiles AS c_alt
      FROM draws d JOIN rows_ b ON b.f = d.f AND b.pos = CASE WHEN d.o < d.key_first THEN d.o ELSE d.o + d.n_key END)"""


_MCQ_TAIL = """, options AS (
      SELECT cid, slot, CASE WHEN repeated THEN c_alt ELSE c_smiles END AS text FROM fetched
      UNION ALL SELECT cid, 3, alt_smiles FROM sized),
    placed AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY
      CAST(('0x' || substr(md5('42:' || CAST(cid AS VARCHAR) || ':option:' || CAST(slot AS VARCHAR)), 1, 8)) AS BIGINT), slot) AS spot FROM options)
    SELECT p.cid, s.smiles AS kekulized_smiles,
      max(CASE WHEN spot = 1 THEN text END) AS "smiles_A", max(CASE WHEN spot = 2 THEN text END) AS "smiles_B",
      max(CASE WHEN spot = 3 THEN text END) AS "smiles_C", max(CASE WHEN spot = 4 THEN text END) AS "smiles_D",
      substr('ABCD', CAST(min(CASE WHEN text = s.alt_smiles THEN spot END) AS INT), 1) AS isomer_answer
    FROM placed p JOIN sized s USING (cid) GROUP BY p.cid, s.smiles, s.alt_smiles"""


@query("isomer_mcq", M.rstrip() + ", " + _isomer_sql("formula", "connectivity_key", "valid") + _MCQ_TAIL)
def isomer_mcq(spark: SparkSession, folder: str) -> DataFrame:
    return J.isomer_questions(X.molecules_table(spark, folder).filter("valid"))


@query("structure", M.rstrip() + ", " + _isomer_sql("formula", "connectivity_key", "valid") + _MCQ_TAIL)
def structure(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the question set, which drops rows that do not parse itself."""
    answered = question_set("structure")(X.molecules_table(spark, folder))
    return answered.select("cid", "kekulized_smiles", *[f"smiles_{c}" for c in J.LETTERS], "isomer_answer")


@query("isomer_mcq_large_groups", M.rstrip() + ", " + _isomer_sql("brand", "kind", "true") + _MCQ_TAIL)
def isomer_mcq_large_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The same where a formula holds a fixed share of the whole table."""
    return J.isomer_questions(X.molecules_table(spark, folder), formula="brand", key="kind")


@query(
    "sample_per_group",
    M.rstrip() + ", " + _isomer_sql("brand", "kind", "true") + " SELECT cid, CAST(slot AS INT) AS slot, candidate_cid FROM fetched",
)
def sample_per_group(spark: SparkSession, folder: str) -> DataFrame:
    rows, draws = J.sample_candidates(X.molecules_table(spark, folder), "brand", "kind")
    pool = rows.select(F.col("_no").alias("candidate"), F.col("cid").alias("candidate_cid"))
    return sliced_join(draws, pool, ["candidate"], ["cid", "slot"]).select("cid", "slot", "candidate_cid")


@query(
    "take_rows",
    """SELECT p.p_partkey AS cid, p.p_name, k.pick_no FROM part p JOIN (
      SELECT DISTINCT doc_id AS cid, doc_id * 2 AS pick_no FROM labels WHERE toxic = 0) k ON k.cid = p.p_partkey""",
)
def take_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = X.read(spark, folder, "part").select(F.col("p_partkey").alias("cid"), "p_name")
    labels = X.read(spark, folder, "labels").filter("toxic = 0")
    picks = labels.select(F.col("doc_id").alias("cid"), (F.col("doc_id") * 2).alias("pick_no")).distinct()
    return W.take_rows(table, picks, "cid")


# --- aggregations ----------------------------------------------------------------------------------


@query(
    "duplicate_groups",
    M + "SELECT cid, formula FROM molecules WHERE formula IN (SELECT formula FROM molecules GROUP BY 1 HAVING count(*) > 1)",
)
def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return P.duplicate_groups(X.molecules(spark, folder).select("cid", "formula"), "formula", "cid").orderBy("formula", "cid")


@query(
    "null_counts",
    """SELECT unnest(['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic']) AS column_name,
      unnest([count(*) - count(d.doc_id), count(*) - count(lang), count(*) - count(source), count(*) - count(n_chars),
              count(*) - count(quality), count(*) - count(toxic)]) AS null_count
      FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.null_counts(_labelled(spark, folder))


@query(
    "group_members",
    "SELECT p_brand AS formula, p_partkey AS cid, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS member_no FROM part",
)
def group_members(spark: SparkSession, folder: str) -> DataFrame:
    part = X.read(spark, folder, "part").select(F.col("p_brand").alias("formula"), F.col("p_partkey").alias("cid"))
    return J.group_members(part)


# --- row numbers, sort, limit, samples, splits ------------------------------------------------------


@query("row_index", "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS row_no FROM documents")
def row_index(spark: SparkSession, folder: str) -> DataFrame:
    documents = X.read(spark, folder, "documents").select("doc_id", "n_chars")
    return W.global_index(documents, [F.desc("n_chars"), F.asc("doc_id")]).select("doc_id", "row_no")


@query(
    "top_per_group",
    """SELECT doc_id, source, n_chars FROM documents
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 5""",
)
def top_per_group(spark: SparkSession, folder: str) -> DataFrame:
    documents = X.read(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return W.top_per_group(documents, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 5, F.col("doc_id"))


@query("curriculum_sort", "SELECT p_partkey AS cid, p_size AS num_atoms, p_name AS iupac FROM part ORDER BY p_size, p_partkey")
def curriculum_sort(spark: SparkSession, folder: str) -> DataFrame:
    part = X.read(spark, folder, "part")
    table = part.select(F.col("p_partkey").alias("cid"), F.col("p_size").alias("num_atoms"), F.col("p_name").alias("iupac"))
    return O.curriculum_sort(table)


@query("prefix_limit", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 500")
def prefix_limit(spark: SparkSession, folder: str) -> DataFrame:
    return W.first_rows(X.read(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 500)


@query("eval_trim", X.PREDICTIONS + "SELECT example_id, gold FROM predictions ORDER BY example_id LIMIT 64")
def eval_trim(spark: SparkSession, folder: str) -> DataFrame:
    return W.first_rows(X.predictions(spark, folder).select("example_id", "gold"), ["example_id"], 64)


@query(
    "seeded_sample",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {draw_sql(42, 'o_orderkey')}, o_orderkey LIMIT 1000",
)
def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return O.seeded_sample(orders, "o_orderkey", 1000).orderBy("o_orderkey")


@query(
    "assign_splits",
    f"""SELECT o_orderkey, CASE WHEN u < 0.025 THEN 'test' WHEN u < 0.05 THEN 'valid' ELSE 'train' END AS split
      FROM (SELECT o_orderkey, {draw_sql(42, 'o_orderkey')} / 4294967296.0 AS u FROM orders)""",
)
def assign_splits(spark: SparkSession, folder: str) -> DataFrame:
    return O.assign_splits(X.read(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "random_partition",
    f"""SELECT doc_id, CASE WHEN u < 0.9 THEN 'train' WHEN u < 0.95 THEN 'eval' ELSE 'test' END AS part
      FROM (SELECT doc_id, {draw_sql(7, 'doc_id')} / 4294967296.0 AS u FROM documents)""",
)
def random_partition(spark: SparkSession, folder: str) -> DataFrame:
    shares = {"train": 0.9, "eval": 0.05, "test": 0.05}
    return O.random_partition(X.read(spark, folder, "documents").select("doc_id"), "doc_id", shares, seed=7)


_SPLIT_CASE = "CASE o_orderkey % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' WHEN 2 THEN 'test' ELSE 'other' END"


def _split_orders(spark: SparkSession, folder: str) -> DataFrame:
    return X.read(spark, folder, "orders").selectExpr("o_orderkey", "o_custkey", f"{_SPLIT_CASE} AS split")


@query("split_by_column", f"SELECT {_SPLIT_CASE} AS frame, o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 < 3")
def split_by_column(spark: SparkSession, folder: str) -> DataFrame:
    frames = O.split_by_column(_split_orders(spark, folder))
    labelled = [df.select(F.lit(name).alias("frame"), "*") for name, df in frames.items()]
    out = labelled[0]
    for df in labelled[1:]:
        out = out.unionByName(df)
    return out


@query("split_counts", f"SELECT {_SPLIT_CASE} AS split, count(*) AS n_rows FROM orders WHERE o_orderkey % 4 < 3 GROUP BY 1")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return O.split_counts(_split_orders(spark, folder))


# --- set operations -----------------------------------------------------------------------------------


@query(
    "sorted_set",
    r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(
      string_split_regex(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' '), lambda v: v <> ''))), ' ') AS members
      FROM documents""",
)
def sorted_set(spark: SparkSession, folder: str) -> DataFrame:
    words = F.split(F.regexp_replace("text", "[^A-Za-z ]", ""), " ")
    return X.spread_out(spark, folder, "documents", "doc_id", "text").select("doc_id", F.array_join(O.sorted_set(words), " ").alias("members"))


@query(
    "concat_files",
    """SELECT 'customer' AS part_of, c_custkey AS id FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def concat_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of different formats, read as one table."""
    root = new_folder(spark, "concat")
    X.read(spark, folder, "customer").select(F.col("c_custkey").alias("id")).write.parquet(f"{root}/customer.parquet")
    X.read(spark, folder, "supplier").select(F.col("s_suppkey").alias("id")).write.json(f"{root}/supplier.jsonl")
    return tables.concat_files(spark, [f"{root}/customer.parquet", f"{root}/supplier.jsonl"], "part_of")
