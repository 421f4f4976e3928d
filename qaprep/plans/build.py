"""From question records to tokenised splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from qaprep.functions import tokens as N
from qaprep.functions.templates import chat_markup, chat_messages, eval_prompt, render_column, value_map
from qaprep.functions.text import tagged_spans
from qaprep.operators.filters import require_columns
from qaprep.operators.indexing import group_positions
from qaprep.operators.sampling import SPLITS, seeded_sample
from qaprep.session import write_through
from qaprep.sources.sinks import write_dataset


Markup = tuple[str, str, str]


def render_records(df: DataFrame, system_prompt: str | None = None, markup: Markup | None = None) -> DataFrame:
    """Attach ``prompt`` (without the answer) and ``answer`` to question records. ``markup``: what opens and
    closes a turn (``{role}`` is the speaker) and what asks for the answer, for models with a chat form."""
    values = value_map(df.schema["metadata"].dataType, "metadata.")
    system = F.lit(system_prompt) if system_prompt is not None else F.col("system_prompt")
    rendered = df.withColumns(
        {
            "_question": render_column(F.col("question_template"), values),
            "answer": render_column(F.col("assistant_template"), values),
        }
    )
    question = F.col("_question")
    prompt = eval_prompt(system, question) if markup is None else chat_markup(chat_messages(system, question), *markup)
    return rendered.withColumn("prompt", prompt).drop("_question")


def _ids(text: Column, limit: int, end: bool) -> dict[str, Column]:
    ids = N.token_ids(text, limit, end)
    return {
        "input_ids": N.pad_left(ids, limit),
        "attention_mask": N.attention_mask(N.token_count(text, limit, end), limit),
    }


def tokenise_train(
    df: DataFrame, max_length: int = 1024, weights: bool = False, default_weight: float = 0.5, answer_weight: float = 5.0
) -> DataFrame:
    """Prompt and answer as one sequence; only the answer is labelled."""
    whole = df.withColumn("_text", F.concat("prompt", "answer"))
    coded = whole.withColumns(
        _ids(F.col("_text"), max_length, True)
        | {"_span": N.closing_span(F.col("_text"), F.col("answer"), max_length)}
    )
    out = coded.withColumn("labels", N.train_labels(F.col("input_ids"), F.col("_span")))
    if weights:
        spans = N.weight_spans(F.col("_text"), F.col("answer"), max_length)
        out = out.withColumn("_spans", spans).withColumn(
            "position_weights", N.position_weights(F.col("input_ids"), F.col("_spans"), default_weight, answer_weight)
        )
    return out.drop("_text", "_span", "_spans")


def tokenise_eval(df: DataFrame, max_length: int = 1024, max_label_len: int = 512) -> DataFrame:
    """The prompt alone, and the answer as right-aligned labels."""
    return df.withColumns(_ids(F.col("prompt"), max_length, False) | {"labels": N.eval_labels(F.col("answer"), max_label_len)})


def plugged_train(df: DataFrame, tokenizer: Callable[[Column], Column], end_id: int, max_length: int = 1024) -> DataFrame:
    """``tokenise_train`` with a caller's tokenizer: prompt and answer are encoded one by one, so that the
    labels begin with the answer's first id whatever the tokenizer merges."""
    coded = df.withColumns({"_p": tokenizer(F.col("prompt")), "_a": F.concat(tokenizer(F.col("answer")), F.array(F.lit(end_id)))})
    ids = F.slice(F.concat("_p", "_a"), 1, max_length)
    start = F.lit(max_length) - F.size("_ids") + F.size("_p")
    span = F.when(F.size("_p") < max_length, F.struct(start.alias("start"), F.lit(max_length).alias("stop")))
    out = coded.withColumn("_ids", ids).withColumns(
        {"input_ids": N.pad_left(F.col("_ids"), max_length, end_id), "attention_mask": N.attention_mask(F.size("_ids"), max_length), "_span": span}
    )
    return out.withColumn("labels", N.train_labels(F.col("input_ids"), F.col("_span"))).drop("_p", "_a", "_ids", "_span")


def mapped_train(
    df: DataFrame, tokenizer: Callable[[Column], Column], end_id: int, max_length: int = 1024,
    weights: bool = False, default_weight: float = 0.5, answer_weight: float = 5.0,
) -> DataFrame:
    """``tokenise_train`` with a caller's ``offset_tokenizer``: prompt and answer are encoded as one text, and the
    answer's tokens are those that overlap it, the end id included. So are the tokens that weigh more: those
    overlapping the first occurrence of each tag body of the answer."""
    coded = df.withColumn("_text", F.concat("prompt", "answer")).withColumn("_map", tokenizer(F.col("_text")))
    coded = coded.withColumn("_ids", F.slice(F.concat(N.mapped_ids(F.col("_map")), F.array(F.lit(end_id))), 1, max_length))
    total, count = F.size("_map"), F.size("_ids")
    covered = N.overlapping_tokens(F.col("_map"), F.length("prompt"), F.length("_text"))
    closing = F.struct(F.coalesce(covered["start"], total).alias("start"), (total + 1).alias("stop"))
    out = coded.withColumns({"input_ids": N.pad_left(F.col("_ids"), max_length, end_id), "attention_mask": N.attention_mask(count, max_length), "_span": N.placed_span(closing, count, max_length)})
    out = out.withColumn("labels", N.train_labels(F.col("input_ids"), F.col("_span")))
    if weights:
        span = lambda body: N.placed_span(N.mapped_span(F.col("_map"), F.col("_text"), body), count, max_length)
        spans = F.filter(F.transform(tagged_spans(F.col("answer")), span), lambda s: s.isNotNull())
        out = out.withColumn("_spans", spans).withColumn("position_weights", N.position_weights(F.col("input_ids"), F.col("_spans"), default_weight, answer_weight))
    return out.drop("_text", "_map", "_ids", "_span", "_spans")


def plugged_eval(
    df: DataFrame, tokenizer: Callable[[Column], Column], end_id: int, max_length: int = 1024, max_label_len: int = 512
) -> DataFrame:
    """``tokenise_eval`` with a caller's tokenizer."""
    coded = df.withColumns({"_p": F.slice(tokenizer(F.col("prompt")), 1, max_length), "_a": F.concat(tokenizer(F.col("answer")), F.array(F.lit(end_id)))})
    return coded.withColumns(
        {
            "input_ids": N.pad_left(F.col("_p"), max_length, end_id),
            "attention_mask": N.attention_mask(F.size("_p"), max_length),
            "labels": N.pad_left(F.slice("_a", 1, max_label_len), max_label_len, N.MASKED),
        }
    ).drop("_p", "_a")


def build_dataset(
    records: DataFrame,
    path: str,
    system_prompt: str | None = None,
    limit: int | None = None,
    key: str | None = None,
    max_length: int = 1024,
    max_label_len: int = 512,
    weights: bool = False,
    tokenizer: Callable[[Column], Column] | None = None,
    end_id: int = N.PAD,
    markup: Markup | None = None,
) -> int:
    """Write ``full`` (valid, test) and ``minimal`` (all splits). Rows of ``full`` get an
    ``example_id``, a hash of the record that every build gives alike, by which predictions are paired with
    them later; records that are repeated are told apart by an occurrence number. ``tokenizer`` (such as
    ``plugged_tokenizer`` or ``offset_tokenizer`` makes) and its ``end_id`` take the place of the bytes; weights need
    bytes or offsets. Returns how many training rows have no label left
    because the truncation cut their answer off; the write itself counts them."""
    offsets = getattr(tokenizer, "offsets", False)
    if weights and tokenizer is not None and not offsets:
        raise ValueError("position weights need the byte tokenizer or one with offsets")
    require_columns(records, ["split"])
    if limit is not None:
        records = seeded_sample(records, key, limit)
    rendered = render_records(records.filter(F.col("split").isin(*SPLITS)), system_prompt, markup)
    learned, held = rendered.filter("split = 'train'"), rendered.filter("split <> 'train'")
    if tokenizer is None:
        train = tokenise_train(learned, max_length, weights)
    elif offsets:
        train = mapped_train(learned, tokenizer, end_id, max_length, weights)
    else:
        train = plugged_train(learned, tokenizer, end_id, max_length)
    unlabelled = Observation("unlabelled")
    kept = F.size(F.array_remove(F.col("labels"), N.MASKED))
    train = train.observe(unlabelled, F.count_if(kept == 0).alias("n"))
    evaluate = tokenizer
    if offsets:
        evaluate = lambda text: N.mapped_ids(tokenizer(text))
    evaluation = tokenise_eval(held, max_length, max_label_len) if tokenizer is None else plugged_eval(held, evaluate, end_id, max_length, max_label_len)
    record = F.to_json(F.struct("split", "prompt", "answer", *[c for c in records.columns if c not in ("split", "prompt", "answer")]))
    numbered = numbered_records(evaluation.withColumn("_record", F.xxhash64(record)))
    write_dataset(train, numbered.drop("prompt", "answer"), path)
    return unlabelled.get["n"]


def numbered_records(df: DataFrame) -> DataFrame:
    """``example_id`` from the hash ``_record``: the hash itself, and for the second, third ... of equal records the hash of
    it and their number. Only hashes that occur more than once are numbered, and these in a global order, so
    that a record repeated any number of times is not one task's."""
    repeated = df.groupBy("_record").agg(F.count("*").alias("_copies")).filter("_copies > 1").select("_record")
    repeated = write_through(repeated, "repeated")
    once = df.join(repeated, "_record", "left_anti").withColumn("example_id", F.col("_record"))
    if repeated.isEmpty():
        return once.drop("_record")
    again = group_positions(df.join(repeated, "_record", "left_semi").withColumn("_nth", F.monotonically_increasing_id()), ["_record"], ["_nth"], "_copy")
    numbered = again.withColumn("example_id", F.when(F.col("_copy") == 0, F.col("_record")).otherwise(F.xxhash64("_record", "_copy")))
    return once.unionByName(numbered.drop("_nth", "_copy")).drop("_record")
