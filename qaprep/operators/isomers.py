"""Same-formula questions. Candidates are addressed by position, so no pair is ever emitted.

All rows are numbered by (formula, connectivity key, id). The rows of one formula are then one run
of numbers and those of one key a shorter run inside it; the isomers of a row are the formula's run
without the key's. Drawing a candidate is arithmetic, fetching it is a join on a unique number. A
formula that holds a third of the table costs no more per row than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.functions.hashing import draw
from qaprep.operators.indexing import global_index, group_positions
from qaprep.operators.joins import sliced_join
from qaprep.session import write_through

LETTERS = "ABCD"
DECOYS = 3


def group_members(df: DataFrame, formula: str = "formula", key: str = "cid") -> DataFrame:
    """formula -> members, as rows (formula, member_no, id): a list per formula could outgrow a task."""
    return group_positions(df.select(formula, key).filter(F.col(formula).isNotNull()), [formula], [key])


def _number_candidates(df: DataFrame, columns: Sequence[str], formula: str, key: str, row_id: str) -> DataFrame:
    """Rows with their number, the two runs they lie in, and the count of their isomers."""
    usable = df.select(*columns).filter(F.col(formula).isNotNull() & F.col(key).isNotNull())
    rows = global_index(usable, [formula, key, row_id], "_no")
    per_key = rows.groupBy(formula, key).agg(F.min("_no").alias("_key_first"), F.count("*").alias("_key_size"))
    per_formula = per_key.groupBy(formula).agg(
        F.min("_key_first").alias("_first"), F.sum("_key_size").alias("_size")
    )
    runs = sliced_join(per_key, per_formula, [formula], [key])
    return sliced_join(rows, runs, [formula, key], [row_id]).withColumn("n_isomers", F.col("_size") - F.col("_key_size"))


def isomer_pairs(df: DataFrame, formula: str = "formula", key: str = "connectivity_key", row_id: str = "cid") -> DataFrame:
    """Rows that have isomers, with their number: the pair relation in compact form."""
    numbered = _number_candidates(df, [row_id, formula, key], formula, key, row_id)
    return numbered.filter("n_isomers > 0").select(row_id, formula, key, "n_isomers")


def _distinct_draws(seed: int, row_id: Column, total: Column) -> list[Column]:
    """Up to three different offsets below ``total``, every subset equally likely (Floyd's method).
    With fewer candidates each is used once and the rest are repeats."""
    hit = [draw(seed, row_id, F.lit(slot)) for slot in range(DECOYS)]
    first = hit[0] % F.greatest(total - 2, F.lit(1))
    second = hit[1] % F.greatest(total - 1, F.lit(1))
    second = F.when(second == first, total - 2).otherwise(second)
    third = hit[2] % total
    third = F.when((third == first) | (third == second), total - 1).otherwise(third)
    repeat = lambda slot: hit[slot] % total
    return [
        F.when(total >= DECOYS, first).otherwise(F.lit(0)),
        F.when(total >= DECOYS, second).when(total == 2, F.lit(1)).otherwise(repeat(1)),
        F.when(total >= DECOYS, third).otherwise(repeat(2)),
    ]


def sample_candidates(
    df: DataFrame, formula: str = "formula", key: str = "connectivity_key", row_id: str = "cid", seed: int = 42,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``n_isomers``, draws): each draw is (id, slot, candidate number, repeat flag)."""
    ready = _number_candidates(df, [row_id, formula, key, *carry], formula, key, row_id).filter("n_isomers > 0")
    numbered = write_through(ready, "isomers")  # read three times: drawing, fetching, the rows themselves
    offsets = _distinct_draws(seed, F.col(row_id), F.col("n_isomers"))
    local_first = F.col("_key_first") - F.col("_first")
    slots = F.array(
        *[
            F.struct(
                F.lit(slot).alias("slot"),
                (F.col("_first") + o + F.when(o >= local_first, F.col("_key_size")).otherwise(0)).alias("candidate"),
                (F.lit(slot) >= F.col("n_isomers")).alias("repeat"),
            )
            for slot, o in enumerate(offsets)
        ]
    )
    return numbered, numbered.select(row_id, F.inline(slots))


def isomer_questions(
    df: DataFrame,
    formula: str = "formula",
    key: str = "connectivity_key",
    row_id: str = "cid",
    smiles: str = "smiles",
    respelled: str = "alt_smiles",
    seed: int = 42,
) -> DataFrame:
    """Multiple choice: which option is the given molecule? (id, kekulized_smiles, smiles_A-D, isomer_answer)

    A row without isomers is dropped. With one or two, the remaining options are other spellings of
    them. The right option is another spelling of the row itself.
    """
    rows, draws = sample_candidates(df, formula, key, row_id, seed, carry=[smiles, respelled])
    pool = rows.select(F.col("_no").alias("candidate"), F.col(smiles).alias("_smiles"), F.col(respelled).alias("_other"))
    # one candidate may be drawn by very many rows of its formula
    decoys = sliced_join(draws, pool, ["candidate"], [row_id, "slot"]).select(
        row_id, "slot", F.when(F.col("repeat"), F.col("_other")).otherwise(F.col("_smiles")).alias("text"),
        F.lit(None).cast("string").alias("given"),
    )
    right = rows.select(row_id, F.lit(DECOYS).alias("slot"), F.col(respelled).alias("text"), F.col(smiles).alias("given"))
    options = decoys.unionByName(right).withColumn("place", draw(seed, F.col(row_id), F.lit("option"), F.col("slot")))
    grouped = options.groupBy(row_id).agg(
        F.max("given").alias("kekulized_smiles"),
        F.max(F.when(F.col("slot") == DECOYS, F.col("text"))).alias("_right"),
        F.array_sort(F.collect_list(F.struct("place", "slot", "text"))).alias("_options"),
    )
    texts = F.transform("_options", lambda o: o["text"])
    return grouped.select(
        row_id,
        "kekulized_smiles",
        *[F.element_at(texts, i + 1).alias(f"smiles_{letter}") for i, letter in enumerate(LETTERS)],
        F.substring(F.lit(LETTERS), F.array_position(texts, F.col("_right")).cast("int"), F.lit(1)).alias("isomer_answer"),
    )
