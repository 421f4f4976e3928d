"""Registered queries: templates, prompts, answer text, scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.functions import templates as T
from qaprep.functions import text as X_
from qaprep.operators import evaluation as E
from qaprep.operators import filters as P
from qaprep.operators import reactions as A
from qaprep.operators.conversations import chat_context as recent_turns
from qaprep.plans import fixtures as X
from qaprep.plans.generate import expand_templates, rendered_questions
from qaprep.plans.question_sets import answer_json
from qaprep.plans.registry import query

M = X.MOLECULES
SYSTEM = "Answer in tags. "
SPACES_SQL = "'" + X_.SPACES + "'"

FLAGSHIP = [
    T.Template("atoms", "How many atoms has {smiles}?\n", "There are <answer>{num_atoms}</answer>\n"),
    T.Template("formula", "What is the formula of {smiles}?\n", "It is <answer>{formula}</answer>\n"),
]


@query(
    "flagship",
    M + f"""SELECT cid, question_id, '{SYSTEM}' || chr(10) || chr(10) || 'user: ' || question || chr(10) || chr(10) || 'assistant: ' AS prompt, answer
      FROM (
        SELECT cid, 'atoms' AS question_id, 'How many atoms has ' || smiles || '?' || chr(10) AS question,
          'There are <answer>' || CAST(num_atoms AS VARCHAR) || '</answer>' || chr(10) AS answer, iupac, num_atoms FROM molecules
        UNION ALL
        SELECT cid, 'formula', 'What is the formula of ' || smiles || '?' || chr(10),
          'It is <answer>' || formula || '</answer>' || chr(10), iupac, num_atoms FROM molecules)
      WHERE num_atoms BETWEEN 3 AND 60 AND iupac IS NOT NULL AND trim(iupac, {SPACES_SQL}) <> ''""",
)
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    table = X.molecules(spark, folder).select("cid", "smiles", "formula", "num_atoms", "iupac")
    usable = P.nonblank(P.range_filter(table, "num_atoms", 3, 60), "iupac")
    questions = rendered_questions(usable, FLAGSHIP, keep=["cid"])
    return questions.select("cid", "question_id", T.eval_prompt(F.lit(SYSTEM), F.col("question")).alias("prompt"), "answer")


@query(
    "render_template",
    M + """SELECT cid, 'Is ' || smiles || ' {' || coalesce(iupac, 'None') || '} with ' || CAST(num_atoms AS VARCHAR) || ' atoms ('
      || CASE WHEN valid THEN 'True' ELSE 'False' END || ')?' AS question, '<answer>' || formula || '</answer>' AS answer FROM molecules""",
)
def render_template(spark: SparkSession, folder: str) -> DataFrame:
    """Templates that sit in a column, rendered from the metadata of their row."""
    table = X.molecules(spark, folder).select("cid", "smiles", "iupac", "num_atoms", "valid", "formula")
    asked = T.Template("q", "Is {smiles} {{{iupac}}} with {num_atoms} atoms ({valid})?", "<answer>{formula}</answer>")
    records = expand_templates(table, [asked])
    values = T.value_map(records.schema["metadata"].dataType, "metadata.")
    return records.select(
        "metadata.cid",
        T.render_column(F.col("question_template"), values).alias("question"),
        T.render_column(F.col("assistant_template"), values).alias("answer"),
    )


@query(
    "build_prompt",
    f"""SELECT item_id, '{SYSTEM}' || chr(10) || chr(10) || 'user: ' || text || chr(10) || chr(10) || 'assistant: ' || CAST(length(text) AS VARCHAR) AS train_prompt,
      '{SYSTEM}' || chr(10) || chr(10) || 'user: ' || text || chr(10) || chr(10) || 'assistant: ' AS eval_prompt FROM benchmark""",
)
def build_prompt(spark: SparkSession, folder: str) -> DataFrame:
    answer = F.length("text").cast("string")
    return X.read(spark, folder, "benchmark").select(
        "item_id",
        T.train_prompt(F.lit(SYSTEM), F.col("text"), answer).alias("train_prompt"),
        T.eval_prompt(F.lit(SYSTEM), F.col("text")).alias("eval_prompt"),
    )


@query(
    "chat_messages",
    f"""SELECT conv_id, turn, '[system]{SYSTEM};[user]' || text || ';[assistant]' AS markup, 2 AS n_messages
      FROM conversations""",
)
def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    turns = X.read(spark, folder, "conversations")
    messages = T.chat_messages(F.lit(SYSTEM), F.col("text"))
    return turns.select(
        "conv_id", "turn", T.chat_markup(messages, "[{role}]", ";", "[assistant]").alias("markup"),
        F.size(messages).alias("n_messages"),
    )


@query(
    "chat_training",
    f"""SELECT item_id, '[system]{SYSTEM};[user]' || text || ';[assistant]' || length(text) || ';' AS markup, 3 AS n_messages FROM benchmark""",
)
def chat_training(spark: SparkSession, folder: str) -> DataFrame:
    """The form a model is trained on: question and answer."""
    messages = T.chat_messages(F.lit(SYSTEM), F.col("text"), F.length("text").cast("string"))
    return X.read(spark, folder, "benchmark").select("item_id", T.chat_markup(messages, "[{role}]", ";").alias("markup"), F.size(messages).alias("n_messages"))


@query(
    "chat_context",
    """SELECT conv_id, turn, string_agg('User: ' || text, ' ') OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS context FROM conversations WHERE role = 'user'""",
)
def chat_context(spark: SparkSession, folder: str) -> DataFrame:
    return recent_turns(X.read(spark, folder, "conversations").filter("role = 'user'"))


_THOUGHT = "CASE WHEN turn % 3 = 0 THEN text ELSE 'hm' || chr(10) || '</think>' || chr(10) || chr(10) || text || chr(10) END"


@query(
    "strip_thinking",
    f"""SELECT conv_id, turn, trim(CASE WHEN turn % 3 = 0 THEN text ELSE text || chr(10) END, chr(10)) AS answer,
      CASE WHEN turn % 3 = 0 THEN NULL ELSE 'hm' || chr(10) || '</think>' END AS thinking FROM conversations""",
)
def strip_thinking(spark: SparkSession, folder: str) -> DataFrame:
    said = X.read(spark, folder, "conversations").selectExpr("conv_id", "turn", f"{_THOUGHT} AS output")
    return said.select(
        "conv_id", "turn", X_.visible_answer(F.col("output")).alias("answer"), X_.thinking_part(F.col("output")).alias("thinking")
    )


_COLON = """CASE o_orderkey % 5 WHEN 0 THEN 'Status: ' || o_orderstatus || '. More text'
  WHEN 1 THEN 'First: ignore Second: ' || CAST(o_custkey AS STRING) || '</s>tail'
  WHEN 2 THEN 'The order is ' || o_orderpriority || '.. </s>' WHEN 3 THEN '  ' || CAST(o_totalprice AS STRING) || '  '
  ELSE 'Time: 10:30, Count: ' || CAST(o_orderkey AS STRING) || ' of ' || o_orderstatus END"""


@query(
    "norm_colon",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderstatus WHEN 1 THEN CAST(o_custkey AS VARCHAR)
      WHEN 2 THEN string_split(o_orderpriority, ' ')[-1] WHEN 3 THEN CAST(o_totalprice AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS answer
      FROM orders""",
)
def norm_colon(spark: SparkSession, folder: str) -> DataFrame:
    rows = X.read(spark, folder, "orders").selectExpr("o_orderkey", f"{_COLON} AS output")
    return rows.select("o_orderkey", X_.norm_colon(F.col("output"), "</s>").alias("answer"))


def tagged_sql(text: str) -> str:
    tail = f"string_split({text}, '<answer>')[-1]"
    body = f"trim(string_split({tail}, '</answer>')[1], {SPACES_SQL})"
    return f"""CASE WHEN contains({text}, '<answer>') AND contains({tail}, '</answer>')
      THEN CASE WHEN ends_with({body}, '.') THEN trim(substr({body}, 1, length({body}) - 1), {SPACES_SQL}) ELSE {body} END
      ELSE trim({text}, {SPACES_SQL}) END"""


_TAGGED = """CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN 'x <answer>' || text || '</answer> y'
  WHEN 2 THEN '<answer>a</answer><answer>  ' || text || '.  </answer>' WHEN 3 THEN '<answer>b</answer> <answer>' || text
  ELSE text || '</answer><answer>' || lang || '...</answer></answer>' END"""


@query("norm_tagged", f"SELECT doc_id, {tagged_sql('output')} AS answer FROM (SELECT doc_id, {_TAGGED} AS output FROM documents)")
def norm_tagged(spark: SparkSession, folder: str) -> DataFrame:
    rows = X.read(spark, folder, "documents").selectExpr("doc_id", f"{_TAGGED} AS output")
    return rows.select("doc_id", X_.norm_tagged(F.col("output")).alias("answer"))


@query(
    "tagged_spans",
    f"""SELECT doc_id, len(bodies) AS n_spans, array_to_string(bodies, '|') AS bodies FROM (
      SELECT doc_id, regexp_extract_all({_TAGGED}, '(?s)<answer>(.*?)</answer>', 1) AS bodies FROM documents)""",
)
def tagged_spans(spark: SparkSession, folder: str) -> DataFrame:
    rows = X.read(spark, folder, "documents").selectExpr("doc_id", f"{_TAGGED} AS output")
    found = rows.select("doc_id", X_.tagged_spans(F.col("output")).alias("found"))
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_spans"), F.array_join("found", "|").alias("bodies"))


@query(
    "answer_json",
    """SELECT p_partkey, '{"size": ' || CAST(p_size AS VARCHAR) || ', "key": ' || CAST(p_partkey AS VARCHAR) || '}' AS answer FROM part""",
)
def answer_json_text(spark: SparkSession, folder: str) -> DataFrame:
    text = answer_json({"size": F.col("p_size"), "key": F.col("p_partkey")})
    return X.read(spark, folder, "part").select("p_partkey", text.alias("answer"))


# --- reactions ------------------------------------------------------------------------------------------

R = X.REACTIONS
_side = lambda i: f"""array_to_string(list_sort(list_distinct(list_filter(string_split(
  regexp_replace(string_split(value, '>')[{i}], ':[0-9]+\\]', ']', 'g'), '.'), lambda v: v <> ''))), '.')"""
_PARSED = f"SELECT cid, {_side(1)} AS reactants, {_side(2)} AS agents, {_side(3)} AS products FROM reactions WHERE len(string_split(value, '>')) = 3"


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.array_join(name, ".") for name in A.PARTS})


@query("parse_reaction", R + _PARSED)
def parse_reaction(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(A.parse_reactions(X.reactions(spark, folder)).select("cid", *A.PARTS))


@query("reaction_dedup", R + f"SELECT min(cid) AS cid, reactants, agents, products FROM ({_PARSED}) GROUP BY reactants, agents, products")
def reaction_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(A.reaction_dedup(A.parse_reactions(X.reactions(spark, folder)), "cid"))


# --- scoring ------------------------------------------------------------------------------------------------

_SCORED = f"""scored AS (SELECT example_id, question_id, {tagged_sql('gold')} AS g, {tagged_sql('prediction')} AS p FROM predictions),
  judged AS (SELECT *, g = p AS plain_match, CASE WHEN starts_with(g, chr(123)) THEN coalesce(
      TRY_CAST(json_extract_string(g, '$.k') AS DOUBLE) = CASE WHEN json_valid(p) AND starts_with(p, chr(123)) THEN TRY_CAST(json_extract_string(p, '$.k') AS DOUBLE) END, false)
    ELSE g = p END AS is_match FROM scored)"""
S = X.PREDICTIONS.rstrip() + ", " + _SCORED + "\n"


@query("json_match", S + "SELECT example_id, g AS gold_answer, p AS pred_answer, is_match FROM judged")
def json_match(spark: SparkSession, folder: str) -> DataFrame:
    return E.with_match(X.predictions(spark, folder)).select("example_id", "gold_answer", "pred_answer", "is_match")


@query("align_predictions", X.PREDICTIONS + "SELECT example_id, question_id, gold, prediction FROM predictions")
def align_predictions(spark: SparkSession, folder: str) -> DataFrame:
    both = X.predictions(spark, folder)
    gold, predicted = both.select("example_id", "question_id", "gold"), both.select("example_id", "prediction")
    return E.align_predictions(gold, predicted)


@query("exact_match", S + "SELECT round(avg(CASE WHEN is_match THEN 1.0 ELSE 0.0 END), 6) AS exact_match FROM judged")
def exact_match(spark: SparkSession, folder: str) -> DataFrame:
    return E.exact_match(E.with_match(X.predictions(spark, folder))).select(F.round("exact_match", 6).alias("exact_match"))


def _accuracy(condition: str, prefix: str) -> str:
    hit, n = f"count(*) FILTER (WHERE plain_match AND {condition})", f"count(*) FILTER (WHERE {condition})"
    return f"{n} AS {prefix}total, {hit} AS {prefix}correct, CASE WHEN {n} > 0 THEN round(CAST({hit} AS DOUBLE) / {n}, 6) END AS {prefix}accuracy"


@query(
    "accuracy_by_question",
    S + f"""SELECT question_id, {_accuracy('true', '')}, {_accuracy("g = '0'", 'zero_')}, {_accuracy("g <> '0'", 'non_zero_')}
      FROM judged GROUP BY question_id""",
)
def accuracy_by_question(spark: SparkSession, folder: str) -> DataFrame:
    out = E.accuracy_by_question(X.predictions(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("accuracy")})


@query(
    "accuracy_summary",
    S + """SELECT coalesce(kind, 'overall') AS answer_type, count(*) AS total, count(*) FILTER (WHERE plain_match) AS correct,
      round(CAST(count(*) FILTER (WHERE plain_match) AS DOUBLE) / count(*), 6) AS accuracy
      FROM (SELECT *, CASE WHEN g = '0' THEN 'zero' ELSE 'non_zero' END AS kind FROM judged) GROUP BY ROLLUP (kind)""",
)
def accuracy_summary(spark: SparkSession, folder: str) -> DataFrame:
    return E.accuracy_summary(X.predictions(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


@query("example_log", X.PREDICTIONS + "SELECT example_id, prediction, gold FROM predictions ORDER BY example_id LIMIT 10")
def example_log(spark: SparkSession, folder: str) -> DataFrame:
    return E.example_log(X.predictions(spark, folder).select("example_id", "prediction", "gold"), ["example_id"])
