"""Token arrays. The native tokenizer works on UTF-8 bytes: ids 0-255 are bytes, 256 is padding
and end of text at once. Word tokens use a learned vocabulary of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaprep.functions.text import strip, tagged_spans
from qaprep.operators.indexing import global_index, group_positions
from qaprep.operators.joins import sliced_join
from qaprep.session import write_through

# Fixed values
PAD = 256
MASKED = -100
NO_LABELS = "[No valid labels]"
#: Tokens of a vocabulary that travels to the tasks, at most.
TRAVELLING = 1 << 16
WORD_PATTERN = r"([\p{L}\p{N}]+|[^\s\p{L}\p{N}])"


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_values(texts: pa.Array) -> pa.Array:
    """The bytes of a batch are one buffer already: widened, they are the ids of all its rows."""
    filled = texts.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    ids = pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(values.astype(np.int32)))
    return pc.if_else(texts.is_valid(), ids, None).cast(pa.list_(pa.int32()))


@F.arrow_udf(T.BinaryType())
def _joined_bytes(ids: pa.Array) -> pa.Array:
    """The ids below 256 of each row as bytes."""
    wide = ids.cast(pa.large_list(pa.int32()))
    lengths = wide.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = wide.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = (values >= 0) & (values < PAD)
    before = np.concatenate([[0], np.cumsum(kept)])
    offsets = before[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)].astype(np.int64)
    data = values[kept].astype(np.uint8)
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pc.if_else(ids.is_valid(), joined, None).cast(pa.binary())


def byte_ids(text: Column, limit: int | None = None) -> Column:
    """Byte ids of a text; of a limited one only the bytes that are kept travel. An array function
    would cost a microsecond per byte, a batch of bytes in Arrow a few nanoseconds."""
    data = F.encode(text, "utf-8")
    return _byte_values(data if limit is None else F.substring(data, F.lit(1), F.lit(limit)))


def token_ids(text: Column, limit: int, end: bool = False) -> Column:
    """Byte ids, with the end id appended when asked for, truncated to ``limit``."""
    ids = byte_ids(text, limit)
    return F.slice(F.concat(ids, F.array(F.lit(PAD))), 1, limit) if end else ids


def pad_left(ids: Column, size: Column | int, fill: int = PAD) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return F.concat(F.array_repeat(F.lit(fill), (size - F.size(ids)).cast("int")), ids)


def attention_mask(count: Column, size: int) -> Column:
    """0 over the left padding, 1 over ``count`` tokens."""
    return F.concat(
        F.array_repeat(F.lit(0), (F.lit(size) - count).cast("int")), F.array_repeat(F.lit(1), count.cast("int"))
    )


def token_count(text: Column, limit: int, end: bool = False) -> Column:
    return F.least(F.octet_length(text) + (1 if end else 0), F.lit(limit))


def decode_ids(ids: Column) -> Column:
    """Text of the byte ids; padding, masks and other special ids are skipped."""
    return F.make_valid_utf8(_joined_bytes(ids).cast("string"))


def decode_labels(labels: Column) -> Column:
    """Text of the labels that are not masked."""
    none_left = F.size(F.filter(labels, lambda x: x != MASKED)) == 0
    return F.when(none_left, F.lit(NO_LABELS)).otherwise(decode_ids(labels))


def sanitize_ids(ids: Column, vocab_size: int = PAD + 1, pad: int = PAD) -> Column:
    """Ids outside the vocabulary, masks among them, become padding."""
    return F.transform(ids, lambda x: F.when((x >= 0) & (x < vocab_size), x).otherwise(F.lit(pad)))


def answer_span(prompt: Column, answer: Column, limit: int, end: bool = False) -> Column:
    """Half-open token range of the first occurrence of ``answer`` in the left-padded prompt.

    A text that occurs only without its outer spaces is looked for trimmed. A range cut by the
    truncation keeps its remaining part; null when nothing of it is left.
    """
    exact = F.position(answer, prompt)
    trimmed = F.position(strip(answer), prompt)
    found = F.when(exact > 0, exact).otherwise(trimmed)
    first = F.octet_length(F.substring(prompt, F.lit(1), found - 1))
    last = F.octet_length(F.substring(prompt, F.lit(1), found - 1 + F.length(answer)))
    return _placed(first, last, F.octet_length(prompt), found > 0, limit, end)


def closing_span(prompt: Column, answer: Column, limit: int) -> Column:
    """Token range of an answer that closes the prompt, its end id included."""
    total = F.octet_length(prompt)
    first = total - F.octet_length(answer)
    return _placed(first, total + 1, total, F.endswith(prompt, answer), limit, True)


def _placed(first: Column, last: Column, total: Column, found: Column, limit: int, end: bool) -> Column:
    count = F.least(total + (1 if end else 0), F.lit(limit))
    shift = F.lit(limit) - count
    span = F.struct(
        (shift + first).cast("int").alias("start"), (shift + F.least(last, count)).cast("int").alias("stop")
    )
    return F.when(found & (first < F.least(last, count)), span)


def train_labels(ids: Column, span: Column) -> Column:
    """The ids inside the answer range, everything else masked."""
    start = F.coalesce(span["start"], F.lit(0))
    inside = F.coalesce(span["stop"] - span["start"], F.lit(0))
    masks = lambda n: F.array_repeat(F.lit(MASKED), n)
    return F.concat(masks(start), F.slice(ids, start + 1, inside), masks(F.size(ids) - start - inside))


def weight_spans(prompt: Column, answer: Column, limit: int, end: bool = True) -> Column:
    """Token ranges of the tag bodies of ``answer``."""
    spans = F.transform(tagged_spans(answer), lambda body: answer_span(prompt, body, limit, end))
    return F.filter(spans, lambda s: s.isNotNull())


def position_weights(ids: Column, spans: Column, default: float = 0.5, inside: float = 5.0) -> Column:
    """One weight per position; positions inside any of the ranges weigh more. The ranges are the
    outer argument of the fold: in an inner function they would be worked out again per position."""
    start = F.array_repeat(F.lit(float(default)), F.size(ids))
    raise_in = lambda weights, s: F.transform(
        weights, lambda w, i: F.when((i >= s["start"]) & (i < s["stop"]), F.lit(float(inside))).otherwise(w)
    )
    return F.aggregate(spans, start, raise_in)


def eval_labels(answer: Column, limit: int) -> Column:
    """Right-aligned answer ids; an answer that is too long keeps its first ids."""
    return pad_left(token_ids(answer, limit, end=True), limit, MASKED)


def find_ids(ids: Column, wanted: Column) -> Column:
    """Zero-based position where ``wanted`` first occurs as a run in ``ids``; null when it does not."""
    spaced = lambda a: F.concat(F.lit(" "), F.array_join(a.cast("array<string>"), " "), F.lit(" "))
    place = F.position(spaced(wanted), spaced(ids))
    before = F.substring(spaced(ids), F.lit(1), place)
    steps = F.length(before) - F.length(F.replace(before, F.lit(" "))) - 1
    return F.when(F.size(wanted) == 0, F.lit(0)).when(place > 0, steps.cast("int"))


def bounded_batches(df: DataFrame, ids: str, order: Sequence[str], max_rows: int = 64, max_ids: int = 1 << 18) -> DataFrame:
    """``df`` with ``bucket`` and ``batch``: batches of rows of about the same length, at most ``max_rows`` rows and, once
    padded to the longest, ``max_ids`` ids (a row longer than that is a batch by itself).

    A bucket holds the lengths of as many binary digits; its rows are numbered by length and ``order``, across
    tasks, and cut into batches of as many rows as its greatest length allows. So padding at most doubles a row
    and no group grows with the table. A null array counts as empty. Only lengths and ``order`` are sorted and numbered; the
    arrays stay in the written table and meet their numbers by row."""
    sized = df.withColumn("_n", F.greatest(F.coalesce(F.size(ids), F.lit(0)), F.lit(0)).cast("bigint")).withColumn("bucket", F.length(F.bin("_n")))
    rows = write_through(sized.withColumn("_row", F.monotonically_increasing_id()), "sized")
    light = rows.select("_row", "_n", "bucket", *[F.col(c) for c in order if c not in ("_n", "bucket")])
    placed = group_positions(light, ["bucket"], ["_n", *order], "_at").select("_row", "_at")
    numbered = rows.join(placed, "_row").drop("_row")
    fit = F.expr(f"{max_ids}L div (shiftleft(1L, bucket) - 1)")  # rows of the bucket's greatest length
    full = F.greatest(F.least(F.lit(max_rows).cast("bigint"), fit), F.lit(1).cast("bigint"))
    return numbered.withColumn("batch", F.floor(F.col("_at") / full).cast("bigint")).drop("_n", "_at")


def left_pad_batches(df: DataFrame, batch: str | Sequence[str], columns: dict[str, int]) -> DataFrame:
    """Pad each array column to the longest of its batch, such as ``bounded_batches`` makes."""
    over = Window.partitionBy(*([batch] if isinstance(batch, str) else batch))
    longest = {c: F.max(F.size(c)).over(over) for c in columns}
    sized = df.withColumns({f"_{c}_max": longest[c] for c in columns})
    padded = sized.withColumns({c: pad_left(F.col(c), F.col(f"_{c}_max"), fill) for c, fill in columns.items()})
    return padded.drop(*[f"_{c}_max" for c in columns])


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 1)


def build_vocab(df: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """token, frequency, token_id; ids follow falling frequency. Counting combines map-side."""
    counted = (
        df.select(F.explode(words(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("frequency"))
    )
    ranked = global_index(counted, [F.desc("frequency"), F.asc("token")], "token_id")
    return ranked if size is None else ranked.filter(F.col("token_id") < size)


def _looked_up(vocab: pa.Table, unknown: int) -> Callable[[Column], Column]:
    """The ids of an array of tokens, by a vocabulary that travels to the tasks."""
    tokens, numbers = vocab.column("token").combine_chunks(), vocab.column("token_id").combine_chunks().cast(pa.int32())

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(rows: pa.Array) -> pa.Array:
        offsets = np.r_[0, np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int32)
        found = pc.index_in(rows.flatten(), value_set=tokens.cast(rows.type.value_type))
        return pa.ListArray.from_arrays(pa.array(offsets), numbers.take(found).fill_null(unknown), mask=rows.is_null())

    return run


def encode_words(df: DataFrame, text: str, vocab: DataFrame, output: str = "input_ids", unknown: int = -1, travelling: int = TRAVELLING) -> DataFrame:
    """Word ids of a text column, for a vocabulary of any size: one of at most ``travelling`` tokens is looked up where
    the row is; in a larger one every token meets its id in a join, and the ids of a row are put
    together again. A null text has null ids, a text without words an empty array."""
    known = write_through(vocab.filter("token IS NOT NULL").select("token", "token_id"), "vocabulary")
    if known.count() <= travelling:
        return df.withColumn(output, _looked_up(known.toArrow(), unknown)(words(F.col(text))))
    rows = write_through(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    pieces = rows.select("_row", F.posexplode(words(F.col(text))).alias("_pos", "token"))
    found = sliced_join(pieces, known, ["token"], ["_row", "_pos"], "left")
    item = F.struct("_pos", F.coalesce("token_id", F.lit(unknown)).cast("int").alias("id"))
    joined = found.groupBy("_row").agg(F.array_sort(F.collect_list(item)).alias("_ids"))
    ids = F.coalesce(F.transform("_ids", lambda i: i["id"]), F.when(F.col(text).isNotNull(), F.array().cast("array<int>")))
    return rows.join(joined, "_row", "left").withColumn(output, ids).drop("_row", "_ids")


def plugged_tokenizer(encode: Callable[[Sequence[str] | str], list[int]]) -> Callable[[Column], Column]:
    """A caller's own tokenizer as an Arrow-batched function returning ``array<int>``."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(values: pd.Series) -> pd.Series:
        return values.map(encode, na_action="ignore")

    return run


Offsets = Sequence[tuple[int, int]]
_MAP = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("id", "start", "stop")]))
#: Texts a caller's tokenizer gets at once.
TEXTS_AT_ONCE = 1000


def offset_tokenizer(encode: Callable[[list[str]], Sequence[tuple[Sequence[int], Offsets]]]) -> Callable[[Column], Column]:
    """A caller's tokenizer that knows where its tokens come from, as an Arrow-batched function returning the
    offset map of a text: ``array<struct<id, start, stop>>``, offsets in characters.

    ``encode`` gets a list of texts and gives ids and (start, stop) offsets of each. A token that stands for no
    text has an empty range. A null text has a null map."""

    @F.arrow_udf(_MAP)
    def run(texts: pa.Array) -> pa.Array:
        known = texts.drop_null()
        ids: list[int] = []
        places: list[tuple[int, int]] = []
        sizes: list[int] = []
        for at in range(0, len(known), TEXTS_AT_ONCE):
            for own, offsets in encode(known.slice(at, TEXTS_AT_ONCE).to_pylist()):
                if len(own) != len(offsets):
                    raise ValueError("a tokenizer must give an offset for each id")
                ids.extend(own)
                places.extend(offsets)
                sizes.append(len(own))
        ends = np.zeros(len(texts) + 1, dtype=np.int64)
        ends[1:][np.asarray(texts.is_valid())] = sizes
        where = np.asarray(places, dtype=np.int32).reshape(-1, 2)
        entries = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in (ids, where[:, 0], where[:, 1])], names=["id", "start", "stop"])
        maps = pa.ListArray.from_arrays(pa.array(np.cumsum(ends).astype(np.int32)), entries)
        return pc.if_else(texts.is_valid(), maps, None)

    run.offsets = True
    return run


def mapped_ids(offsets: Column) -> Column:
    return F.transform(offsets, lambda t: t["id"])


def overlapping_tokens(offsets: Column, first: Column, last: Column) -> Column:
    """Half-open range of the tokens of an offset map that share a character with [first, last); null when
    none does. Tokens without text share none."""
    inside = lambda t: (t["start"] < last) & (t["stop"] > first) & (t["stop"] > t["start"])
    places = F.filter(F.transform(offsets, lambda t, i: F.when(inside(t), i)), lambda i: i.isNotNull())
    return F.when(F.size(places) > 0, F.struct(F.array_min(places).alias("start"), (F.array_max(places) + 1).alias("stop")))


def mapped_span(offsets: Column, prompt: Column, answer: Column) -> Column:
    """Token range of the first occurrence of ``answer`` in ``prompt``, by the prompt's offset map. A text that occurs
    only without its outer spaces is looked for trimmed; null for an empty answer or none found."""
    exact, trimmed = F.position(answer, prompt), F.position(strip(answer), prompt)
    first = F.when(exact > 0, exact).otherwise(trimmed) - 1
    return F.when((first >= 0) & (F.length(answer) > 0), overlapping_tokens(offsets, first, first + F.length(answer)))


def placed_span(span: Column, count: Column, limit: int) -> Column:
    """A token range of a text of ``count`` kept tokens in its left-padded window; null when it is cut off whole."""
    shift = F.lit(limit) - count
    moved = F.struct((shift + span["start"]).cast("int").alias("start"), (shift + F.least(span["stop"], count)).cast("int").alias("stop"))
    return F.when(span["start"] < count, moved)
