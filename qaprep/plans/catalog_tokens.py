"""Registered queries: vocabularies, token arrays, labels, dataset profiles. Arrays are shown as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qaprep.functions import tokens as N
from qaprep.functions.text import OPEN_TAG, CLOSE_TAG
from qaprep.operators import evaluation as E
from qaprep.plans import fixtures as X
from qaprep.plans.build import tokenise_eval, tokenise_train
from qaprep.plans.registry import query
from qaprep.session import new_folder
from qaprep.sources.sinks import write_dataset

MAX_LENGTH = 1024
LABEL_LENGTH = 96


def shown(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


# the same in DuckDB: bytes of a text as a list, left padding, a list as text
def bytes_sql(text: str, limit: str | None = None) -> str:
    digits = f"hex(encode({text}))"
    if limit is not None:
        digits = f"substr({digits}, 1, 2 * {limit})"
    return f"list_transform(regexp_extract_all({digits}, '..'), lambda x: CAST('0x' || x AS INT))"


def padded_sql(ids: str, size: str, fill: int) -> str:
    return f"list_concat(list_resize(CAST([] AS INT[]), {size} - len({ids}), {fill}), {ids})"


def shown_sql(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


@query(
    "build_vocab",
    r"""SELECT token, frequency, row_number() OVER (ORDER BY frequency DESC, token) - 1 AS token_id FROM (
      SELECT token, count(*) AS frequency FROM (
        SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) AS token FROM documents) GROUP BY token)""",
)
def build_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return N.build_vocab(X.spread_out(spark, folder, "documents"), "text")


@query(
    "encode",
    f"""SELECT doc_id, {shown_sql(padded_sql('ids', str(MAX_LENGTH), N.PAD))} AS input_ids,
      {shown_sql(padded_sql('list_transform(ids, lambda x: 1)', str(MAX_LENGTH), 0))} AS attention_mask
      FROM (SELECT doc_id, {bytes_sql('text', str(MAX_LENGTH))} AS ids FROM documents)""",
)
def encode(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    mask = N.attention_mask(N.token_count(text, MAX_LENGTH), MAX_LENGTH)
    return X.spread_out(spark, folder, "documents").select(
        "doc_id",
        shown(N.pad_left(N.token_ids(text, MAX_LENGTH), MAX_LENGTH)).alias("input_ids"),
        shown(mask).alias("attention_mask"),
    )


@query(
    "encode_words",
    r"""WITH pieces AS (
        SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS t FROM documents)),
      vocab AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS token_id FROM pieces GROUP BY token),
      known AS (SELECT * FROM vocab WHERE token_id < 2000)
      SELECT doc_id, string_agg(CAST(coalesce(token_id, -1) AS VARCHAR), ' ' ORDER BY pos) AS input_ids
      FROM pieces LEFT JOIN known USING (token) GROUP BY doc_id""",
)
def encode_words(spark: SparkSession, folder: str) -> DataFrame:
    documents = X.spread_out(spark, folder, "documents")
    vocab = N.build_vocab(documents, "text", size=2000)
    coded = N.encode_words(documents.select("doc_id", "text"), "text", vocab)
    return coded.select("doc_id", shown(F.col("input_ids")).alias("input_ids"))


@query("decode", "SELECT doc_id, text FROM documents")
def decode(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts there and back."""
    ids = N.pad_left(N.byte_ids(F.col("text")), F.octet_length("text") + 3)
    return X.spread_out(spark, folder, "documents").select("doc_id", N.decode_ids(ids).alias("text"))


_ANSWER = "substr(text, 20, 12)"


def _span_sql(prompt: str, answer: str, limit: int) -> str:
    """start and stop of the first occurrence, in a left-padded window of ``limit`` bytes."""
    at = f"strpos({prompt}, {answer})"
    first = f"strlen(substr({prompt}, 1, {at} - 1))"
    return f"""{limit} - least(strlen({prompt}), {limit}) + {first} AS start,
      {limit} - least(strlen({prompt}), {limit}) + least({first} + strlen({answer}), least(strlen({prompt}), {limit})) AS stop,
      {first} < {limit} AND length({answer}) > 0 AS inside"""


# turns of conversations are at most some two thousand bytes long: a window of this size holds every whole text
WHOLE = 4096


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return X.spread_out(spark, folder, "conversations", "conv_id", "turn", "text")


@query(
    "answer_span",
    f"""SELECT conv_id, turn, CASE WHEN inside THEN start END AS start, CASE WHEN inside THEN stop END AS stop FROM (
      SELECT conv_id, turn, {_span_sql('text', _ANSWER, WHOLE)} FROM conversations)""",
)
def answer_span(spark: SparkSession, folder: str) -> DataFrame:
    answer = F.substring("text", 20, 12)
    span = N.answer_span(F.col("text"), answer, WHOLE)
    found = _turns(spark, folder).select("conv_id", "turn", span.alias("span"))
    return found.select("conv_id", "turn", F.col("span.start").cast("bigint").alias("start"), F.col("span.stop").cast("bigint").alias("stop"))


def _blank_separated(texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
    """A caller's tokenizer: what single blanks separate, the length as id."""
    out = []
    for text in texts:
        at, places = 0, []
        for piece in text.split(" "):
            places.append((at, at + len(piece)))
            at += len(piece) + 1
        out.append(([b - a for a, b in places], places))
    return out


@query(
    "answer_span_offsets",
    f"""WITH w AS (SELECT doc_id, {_ANSWER} AS answer, strpos(text, {_ANSWER}) - 1 AS place, unnest(string_split(text, ' ')) AS word,
        generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
      o AS (SELECT *, CAST(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - 1 AS stop FROM w),
      t AS (SELECT *, stop - length(word) AS start FROM o)
      SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, min(i - 1) FILTER (WHERE hit) AS start, max(i) FILTER (WHERE hit) AS stop,
        CAST(coalesce(sum(length(word)) FILTER (WHERE hit), 0) AS BIGINT) AS id_sum
      FROM (SELECT *, start < place + length(answer) AND stop > place AND stop > start AND length(answer) > 0 AS hit FROM t) GROUP BY doc_id""",
)
def answer_span_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the offset map of a caller's tokenizer, over whole documents."""
    rows = X.spread_out(spark, folder, "documents").filter("text IS NOT NULL").withColumn("map", N.offset_tokenizer(_blank_separated)(F.col("text")))
    rows = rows.withColumn("span", N.mapped_span(F.col("map"), F.col("text"), F.substring("text", 20, 12)))
    inside = F.slice(N.mapped_ids(F.col("map")), F.col("span.start") + 1, F.col("span.stop") - F.col("span.start"))
    return rows.select(
        "doc_id", F.size("map").cast("bigint").alias("n_tokens"), F.col("span.start").cast("bigint").alias("start"), F.col("span.stop").cast("bigint").alias("stop"),
        F.coalesce(F.reduce(inside, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint").alias("id_sum"),
    )


@query(
    "subsequence_find",
    """SELECT doc_id, strlen(substr(text, 1, strpos(text, substr(text, 20, 12)) - 1)) AS found FROM documents
      WHERE length(text) >= 20 UNION ALL SELECT doc_id, 0 FROM documents WHERE length(text) < 20""",
)
def subsequence_find(spark: SparkSession, folder: str) -> DataFrame:
    rows = X.spread_out(spark, folder, "documents")
    found = N.find_ids(N.byte_ids(F.col("text")), N.byte_ids(F.substring("text", 20, 12)))
    return rows.select("doc_id", found.cast("bigint").alias("found"))


# a question from a benchmark text and a tagged answer, as the training form
_PROMPT = "'Q: ' || text || ' A: '"
_TAGGED = f"'It is {OPEN_TAG}' || CAST(length(text) AS STRING) || '{CLOSE_TAG}'"
TRAIN_LENGTH = WHOLE


def _training(spark: SparkSession, folder: str) -> DataFrame:
    rows = _turns(spark, folder).selectExpr("conv_id", "turn", f"{_PROMPT} || {_TAGGED} AS whole", f"{_TAGGED} AS answer")
    ids = N.pad_left(N.token_ids(F.col("whole"), TRAIN_LENGTH, True), TRAIN_LENGTH)
    return rows.withColumn("ids", ids)


_TRAIN_SQL = f"""WITH qa AS (SELECT conv_id, turn, {_PROMPT} || {_TAGGED} AS whole, {_TAGGED} AS answer FROM conversations),
  coded AS (SELECT *, list_slice(list_concat({bytes_sql('whole')}, [256]), 1, {TRAIN_LENGTH}) AS raw FROM qa),
  ready AS (SELECT *, len(raw) AS n, {padded_sql('raw', str(TRAIN_LENGTH), 256)} AS ids FROM coded)\n"""


@query(
    "train_labels",
    _TRAIN_SQL + f"""SELECT conv_id, turn, {shown_sql('ids')} AS input_ids, array_to_string(list_transform(ids, lambda x, i:
      CASE WHEN i - 1 - ({TRAIN_LENGTH} - n) >= strlen(whole) - strlen(answer) THEN x ELSE -100 END), ' ') AS labels FROM ready""",
)
def train_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _training(spark, folder)
    span = N.closing_span(F.col("whole"), F.col("answer"), TRAIN_LENGTH)
    labels = rows.withColumn("span", span).select(
        "conv_id", "turn", shown(F.col("ids")).alias("input_ids"), shown(N.train_labels(F.col("ids"), F.col("span"))).alias("labels")
    )
    return labels


@query(
    "position_weights",
    _TRAIN_SQL + f"""SELECT conv_id, turn, len(list_filter(w, lambda v: v = 5)) AS n_inside, len(w) AS n_positions,
      CAST(coalesce(list_position(w, 5) - 1, -1) AS BIGINT) AS first_inside
      FROM (SELECT conv_id, turn, list_transform(ids, lambda x, i: CASE WHEN i - 1 - ({TRAIN_LENGTH} - n) >= ahead
          AND i - 1 - ({TRAIN_LENGTH} - n) < ahead + strlen(body) THEN 5 ELSE 0 END) AS w
        FROM (SELECT *, strlen(substr(whole, 1, strpos(whole, body) - 1)) AS ahead
          FROM (SELECT *, regexp_extract(answer, '<answer>(.*?)</answer>', 1) AS body FROM ready)))""",
)
def position_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = _training(spark, folder)
    spans = N.weight_spans(F.col("whole"), F.col("answer"), TRAIN_LENGTH)
    weights = rows.withColumn("spans", spans).withColumn("w", N.position_weights(F.col("ids"), F.col("spans")))
    return weights.select(
        "conv_id", "turn",
        F.size(F.filter("w", lambda v: v == 5.0)).cast("bigint").alias("n_inside"),
        F.size("w").cast("bigint").alias("n_positions"),
        (F.array_position("w", 5.0) - 1).cast("bigint").alias("first_inside"),
    )


_EVAL_SQL = f"list_slice(list_concat({bytes_sql('text')}, [256]), 1, {WHOLE})"


@query(
    "eval_labels",
    f"SELECT conv_id, turn, {shown_sql(padded_sql('ids', str(WHOLE), N.MASKED))} AS labels FROM (SELECT conv_id, turn, {_EVAL_SQL} AS ids FROM conversations)",
)
def eval_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _turns(spark, folder).select("conv_id", "turn", shown(N.eval_labels(F.col("text"), WHOLE)).alias("labels"))


@query(
    "decode_labels",
    f"""SELECT item_id, CASE WHEN item_id % 4 = 0 THEN '{N.NO_LABELS}' ELSE text END AS text FROM benchmark""",
)
def decode_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = N.eval_labels(F.col("text"), 4096)
    masked = F.when(F.col("item_id") % 4 == 0, F.transform(labels, lambda x: F.lit(N.MASKED))).otherwise(labels)
    return X.read(spark, folder, "benchmark").select("item_id", N.decode_labels(masked).alias("text"))


@query(
    "left_pad_batch",
    f"""SELECT conv_id, turn, {shown_sql(padded_sql('ids', 'longest', N.PAD))} AS ids FROM (
      SELECT conv_id, turn, ids, max(len(ids)) OVER (PARTITION BY conv_id) AS longest
      FROM (SELECT conv_id, turn, {bytes_sql('text')} AS ids FROM conversations))""",
)
def left_pad_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch is a conversation."""
    coded = _turns(spark, folder).select("conv_id", "turn", N.byte_ids(F.col("text")).alias("ids"))
    return N.left_pad_batches(coded, "conv_id", {"ids": N.PAD}).select("conv_id", "turn", shown(F.col("ids")).alias("ids"))


_MOST_ROWS, _MOST_IDS = 64, 1 << 18


@query(
    "left_pad_bounded",
    f"""WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n FROM documents),
      b AS (SELECT *, length(bin(n)) AS bucket, row_number() OVER (PARTITION BY length(bin(n)) ORDER BY n, doc_id) - 1 AS pos FROM d),
      c AS (SELECT *, pos // greatest(least({_MOST_ROWS}, {_MOST_IDS} // ((CAST(1 AS BIGINT) << bucket) - 1)), 1) AS batch FROM b)
      SELECT doc_id, bucket, CAST(batch AS BIGINT) AS batch, CAST(max(n) OVER w AS BIGINT) AS n_padded, CAST(max(n) OVER w - n AS BIGINT) AS n_pads,
        CAST(count(*) OVER w AS BIGINT) AS n_rows FROM c WINDOW w AS (PARTITION BY bucket, batch)""",
)
def left_pad_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents in batches of bounded rows and ids."""
    coded = X.spread_out(spark, folder, "documents").select("doc_id", N.byte_ids(F.coalesce("text", F.lit(""))).alias("ids"))
    batches = N.bounded_batches(coded, "ids", ["doc_id"], _MOST_ROWS, _MOST_IDS)
    padded = N.left_pad_batches(batches, ["bucket", "batch"], {"ids": N.PAD})
    rows = F.count("*").over(Window.partitionBy("bucket", "batch"))
    return padded.select(
        "doc_id", "bucket", "batch", F.size("ids").cast("bigint").alias("n_padded"), (F.size("ids") - F.size(F.array_remove("ids", N.PAD))).cast("bigint").alias("n_pads"), rows.alias("n_rows")
    )


@query(
    "sanitize_ids",
    "SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN CAST(floor(x * 1000) AS INT) BETWEEN 0 AND 256 THEN CAST(floor(x * 1000) AS INT) ELSE 256 END), ' ') AS ids FROM embeddings",
)
def sanitize_ids(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.transform("embedding", lambda x: F.floor(x * F.lit(1000).cast("float")).cast("int"))
    return X.read(spark, folder, "embeddings").select("vec_id", shown(N.sanitize_ids(raw)).alias("ids"))


def _tokenised(spark: SparkSession, folder: str) -> DataFrame:
    """Two datasets with three splits each, made of the documents."""
    rows = X.spread_out(spark, folder, "documents").selectExpr(
        "doc_id", "text", "CASE WHEN doc_id % 2 = 0 THEN 'full' ELSE 'minimal' END AS dataset",
        "CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'valid' ELSE 'test' END AS split",
    )
    return rows.withColumns(
        {
            "input_ids": N.pad_left(N.token_ids(F.col("text"), MAX_LENGTH, True), MAX_LENGTH),
            "labels": N.eval_labels(F.col("split"), LABEL_LENGTH),
        }
    )


_COUNTS_SQL = f"""SELECT CASE WHEN doc_id % 2 = 0 THEN 'full' ELSE 'minimal' END AS dataset,
  CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'valid' ELSE 'test' END AS split,
  {MAX_LENGTH} - least(strlen(text) + 1, {MAX_LENGTH}) + CASE WHEN strlen(text) < {MAX_LENGTH} THEN 1 ELSE 0 END AS pads,
  {LABEL_LENGTH} - 1 - length(CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'valid' ELSE 'test' END) AS masks FROM documents"""


def _stats_sql(column: str, prefix: str) -> str:
    return f"CAST(min({column}) AS DOUBLE) AS {prefix}min, CAST(max({column}) AS DOUBLE) AS {prefix}max, round(avg({column}), 6) AS {prefix}mean"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith("mean")})


@query("padding_stats", f"SELECT {_stats_sql('pads', 'pad_')} FROM ({_COUNTS_SQL})")
def padding_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(E.padding_stats(_tokenised(spark, folder)))


@query("label_mask_stats", f"SELECT {_stats_sql('masks', 'masked_')} FROM ({_COUNTS_SQL})")
def label_mask_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(E.label_mask_stats(_tokenised(spark, folder)))


@query(
    "dataset_profile",
    f"""SELECT dataset, split, count(*) AS n_rows, {_stats_sql('pads', 'pad_')}, {_stats_sql('masks', 'masked_')}
      FROM ({_COUNTS_SQL}) GROUP BY dataset, split""",
)
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(E.dataset_profile(_tokenised(spark, folder)))


@query("score_predictions", "SELECT round(avg(CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE 1.0 END), 6) AS exact_match FROM documents")
def score_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts as ids, a third of the predictions altered."""
    said = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    rows = X.spread_out(spark, folder, "documents").select(
        N.byte_ids(F.concat(F.lit(OPEN_TAG), said, F.lit(CLOSE_TAG))).alias("pred_ids"),
        N.pad_left(N.byte_ids(F.concat(F.lit(OPEN_TAG), F.col("text"), F.lit(CLOSE_TAG))), F.octet_length("text") + 40, N.MASKED).alias("labels"),
    )
    return E.score_predictions(rows).select(F.round("exact_match", 6).alias("exact_match"))


@query(
    "saved_profile",
    f"""WITH q AS (SELECT *, 'Document ' || doc_id || ' in ' || lang AS prompt FROM documents WHERE doc_id % 10 > 6),
      e AS (SELECT CASE WHEN doc_id % 10 < 9 THEN 'valid' ELSE 'test' END AS split, 96 - least(strlen(prompt), 96) AS pads, 32 - least(strlen(source) + 1, 32) AS masks FROM q),
      t AS (SELECT 'train' AS split, 96 - least(strlen('Document ' || doc_id || ' in ' || lang) + strlen(source), 96) AS pads,
              96 - strlen(source) - 1 AS masks FROM documents WHERE doc_id % 10 <= 6),
      r AS (SELECT 'full' AS dataset, * FROM e UNION ALL SELECT 'minimal', * FROM e UNION ALL SELECT 'minimal', * FROM t)
      SELECT dataset, split, count(*) AS n_rows, {_stats_sql('pads', 'pad_')}, {_stats_sql('masks', 'masked_')}, CAST(least(count(*), 2) AS BIGINT) AS n_samples FROM r GROUP BY dataset, split""",
)
def saved_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of what ``write_dataset`` saved: questions that ask for the source of a document."""
    rows = X.spread_out(spark, folder, "documents").selectExpr(
        "concat('Document ', doc_id, ' in ', lang) AS prompt", "source AS answer",
        "CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'valid' ELSE 'test' END AS split",
    )
    path = new_folder(spark, "dataset")
    write_dataset(tokenise_train(rows.filter("split = 'train'"), 96), tokenise_eval(rows.filter("split <> 'train'"), 96, 32), path)
    found = E.saved_profile(spark, path, samples=2)
    return _rounded(found).select("dataset", "split", "n_rows", "pad_min", "pad_max", "pad_mean", "masked_min", "masked_max", "masked_mean", F.size("samples").cast("bigint").alias("n_samples"))
