"""Question templates: the YAML file, rendering, prompts and chat messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from string import Formatter
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPLATE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("user_template", T.StringType(), False),
        T.StructField("assistant_template", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType()), False),
    ]
)


@dataclass(frozen=True)
class Template:
    """One question: what the user asks and what the assistant answers."""

    id: str
    user_template: str
    assistant_template: str
    type: str = "generic"
    extras: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class QuestionConfig:
    """The content of one configuration file; its size is that of the file."""

    system_prompt: str
    question_set: str
    templates: Sequence[Template]


def read_config(content: Mapping[str, Any]) -> QuestionConfig:
    """Build a configuration from parsed YAML; the three top-level keys are required."""
    named = ("id", "user_template", "assistant_template", "type")
    templates = [
        Template(
            **{k: entry[k] for k in named[:3]},
            type=entry.get("type", "generic"),
            extras={k: v for k, v in entry.items() if k not in named},
        )
        for entry in content["questions"]
    ]
    return QuestionConfig(content["system_prompt"], content["question_set"], templates)


def load_config(path: str) -> QuestionConfig:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a template file needs PyYAML") from error
    with open(path, encoding="utf-8") as handle:
        return read_config(yaml.safe_load(handle))


def templates_table(spark: SparkSession, config: QuestionConfig) -> DataFrame:
    rows = [
        (t.id, t.user_template, t.assistant_template, t.type, {k: str(v) for k, v in t.extras.items()})
        for t in config.templates
    ]
    return spark.createDataFrame(rows, TEMPLATE_SCHEMA)


def template_fields(template: str) -> list[str]:
    """Field names in order of appearance."""
    return [name for _, name, _, _ in Formatter().parse(template) if name is not None]


def _float_text(value: Column) -> Column:
    """A floating-point number as Python writes it: plain from 1e-4 up to 1e16, an exponent of two digits
    or more beyond. Spark writes an exponent from 1e7 and below 1e-3."""
    text = value.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    digits = F.rtrim(F.replace(F.regexp_extract(text, r"([0-9.]+)E", 1), F.lit("."), F.lit("")), F.lit("0"))
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    wide = F.rpad(digits, F.greatest(power + 1, F.length(digits)), F.lit("0"))
    fraction = F.substr(wide, power + 2)
    plain = F.concat(F.substr(wide, F.lit(1), power + 1), F.lit("."), F.when(fraction == "", "0").otherwise(fraction))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    rest = F.substr(digits, F.lit(2))
    size = F.abs(power).cast("string")
    exponent = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"),
        F.when(power < 0, "-").otherwise("+"), F.when(F.abs(power) < 10, F.concat(F.lit("0"), size)).otherwise(size),
    )
    written = F.when(power.between(0, 15), plain).when(power.between(-4, -1), small).otherwise(exponent)
    named = F.when(F.isnan(value), "nan").when(text == "Infinity", "inf").when(text == "-Infinity", "-inf")
    return F.coalesce(named, F.when(F.contains(text, F.lit("E")), F.concat(sign, written)), text)


def format_value(value: Column, dtype: T.DataType | None = None) -> Column:
    """A value as Python would format it: ``None`` for null, ``True``/``False`` for booleans."""
    text = _float_text(value) if isinstance(dtype, (T.DoubleType, T.FloatType)) else value.cast("string")
    if isinstance(dtype, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit("None"))


def render(template: str, schema: T.StructType, prefix: str = "") -> Column:
    """Compile one template into a ``concat``; an unknown field fails before anything runs."""
    parts: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if spec or conversion:
            raise ValueError(f"format directives are not supported: {{{name}}}")
        if name not in schema.fieldNames():
            raise KeyError(name)
        parts.append(format_value(F.col(f"{prefix}`{name}`"), schema[name].dataType))
    return F.concat(*parts) if parts else F.lit("")


def value_map(schema: T.StructType, prefix: str = "") -> Column:
    """Field name -> formatted value, for rendering templates that live in a column."""
    pairs: list[Column] = []
    for item in schema.fields:
        pairs += [F.lit(item.name), format_value(F.col(f"{prefix}`{item.name}`"), item.dataType)]
    return F.create_map(*pairs)


def render_column(template: Column, values: Column) -> Column:
    """Render a template held in a column from a name -> text map; an unknown field raises."""
    pieces = F.regexp_extract_all(template, F.lit(r"(\{\{|\}\}|\{[^{}]*\}|[^{}]+)"), 1)

    def piece_text(piece: Column) -> Column:
        name = F.substring(piece, F.lit(2), F.length(piece) - 2)
        missing = F.raise_error(F.concat(F.lit("unknown template field: "), name))
        return (
            F.when(piece == "{{", "{")
            .when(piece == "}}", "}")
            .when(F.startswith(piece, F.lit("{")), F.coalesce(F.try_element_at(values, name), missing))
            .otherwise(piece)
        )

    return F.array_join(F.transform(pieces, piece_text), "")


def train_prompt(system: Column, question: Column, answer: Column) -> Column:
    return F.concat(eval_prompt(system, question), answer)


def eval_prompt(system: Column, question: Column) -> Column:
    """The prompt a model sees when it has to answer."""
    return F.concat(system, F.lit("\n\nuser: "), question, F.lit("\n\nassistant: "))


def chat_messages(system: Column, question: Column, answer: Column | None = None) -> Column:
    """The same turns as an array of role/content structs."""
    turns = [("system", system), ("user", question)]
    if answer is not None:
        turns.append(("assistant", answer))
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns])


def chat_markup(messages: Column, opening: str, closing: str, generate: str = "") -> Column:
    """Flatten messages with a model's own markup; ``{role}`` in ``opening`` is the speaker."""
    turn = lambda m: F.concat(F.replace(F.lit(opening), F.lit("{role}"), m["role"]), m["content"], F.lit(closing))
    return F.concat(F.array_join(F.transform(messages, turn), ""), F.lit(generate))
