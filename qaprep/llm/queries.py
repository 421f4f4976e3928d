"""The registered queries of this package, thin readings of its operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaprep.llm import bpe, language_id, toxicity
from qaprep.llm.bin_completion import pack_whole
from qaprep.llm.common import NO_ID, crc32_of_id, id_of, slices, table
from qaprep.llm.embedding_dedup import similar_embeddings
from qaprep.llm.exact_dedup import exact_duplicates
from qaprep.llm.lm_scoring import score_texts
from qaprep.llm.minhash import near_duplicates
from qaprep.llm.packing import pack
from qaprep.llm.period_runs import periodic_runs
from qaprep.llm.prefix_trie import ordered_turns, prefix_trie
from qaprep.llm.suffix_dedup import remove_repeats
from qaprep.llm.token_files import read_tokens, write_tokens
from qaprep.session import new_folder, write_through


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op3_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, {_LOWERED} AS norm FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM t JOIN g USING (norm)
    """,
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents")).drop("copy")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"), crc32_of_id(F.col("doc_id")) % 5 != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc32_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("sentences").alias("n_offending"))


@query(
    "op6_minhash",
    f"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                 ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS sh FROM w),
    n AS (SELECT doc_id, len(sh) AS n FROM s),
    x AS (SELECT doc_id, unnest(sh) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * both_n >= 75 * (na.n + nb.n - both_n)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (WITH RECURSIVE walk(node, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT walk.node, e.b FROM walk JOIN e ON e.a = walk.reach) SELECT node, min(reach) AS component_id FROM walk GROUP BY node)
    SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, r.component_id, n.doc_id = r.component_id AS kept FROM n JOIN r ON r.node = n.doc_id
    """,
)
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).withColumn("kept", F.sha2("kept", 256)).withColumnRenamed("kept", "kept_sha256")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc32_of_id(F.col("doc_id")) % 4 == 2
    model = language_id.train(docs, ~held_out)
    return language_id.predict(docs, model, runs=False).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    written = new_folder(spark, "token-files")
    write_tokens(docs, written, vocabulary("word_bpe_49k.json"))
    return read_tokens(spark, written).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return similar_embeddings(table(spark, folder, "embeddings"))


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    held_out = crc32_of_id(F.col("doc_id")) % 5 == 1
    scored = score_texts(table(spark, folder, "documents"), ~held_out, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_bin_completion")
def op11_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_whole(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query(
    "op12_prefix_trie",
    """
    WITH RECURSIVE bits(i, k, c) AS (
        SELECT range, 0, range FROM range(256)
        UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
    t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations),
    ids AS (SELECT conv_id, max(pos) AS n FROM t GROUP BY conv_id),
    c AS (SELECT conv_id, n, conv_id - conv_id % 100 AS base,
                 xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ''), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                 lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h FROM ids, crc),
    m AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN ids b ON b.conv_id = c.base),
    r AS (SELECT m.conv_id, taken + pos - h AS d, role, text FROM m JOIN t ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND pos > h
          UNION ALL SELECT m.conv_id, pos, role, text FROM m JOIN t ON t.conv_id = m.base AND pos <= taken),
    s AS (SELECT m.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS turns FROM m LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY m.conv_id),
    p AS (SELECT conv_id, unnest(range(len(turns) + 1)) AS d, turns FROM s),
    q AS (SELECT conv_id, d, turns[1:d] AS pre, CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS chars, len(turns) = d AS ends FROM p),
    g AS (SELECT pre, d, min(coalesce(conv_id, -9223372036854775808)) AS rep, count(*) AS n, any_value(chars) AS chars,
                 coalesce(string_agg(coalesce(CAST(conv_id AS VARCHAR), ''), ',' ORDER BY conv_id NULLS FIRST) FILTER (WHERE ends), '') AS ids FROM q GROUP BY pre, d),
    k AS (SELECT pre[1:d-1] AS pre, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
    e AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN k ON k.pre = g.pre),
    u AS (SELECT pre[1:a] AS pre, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n - 1) * chars) AS saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM e) GROUP BY 1)
    SELECT nullif(e.rep, -9223372036854775808) AS conv_id, CAST(e.d AS BIGINT) AS depth, nullif(o.rep, -9223372036854775808) AS parent_conv_id, CAST(e.n AS BIGINT) AS n_convs,
           CAST(e.n_children AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(e.ids) AS ends_sha256
    FROM e JOIN u ON u.pre = e.pre LEFT JOIN e o ON e.d > 0 AND o.pre = e.pre[1:e.d-1]
    """,
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """A null id has no base: its crc32 is that of nothing, so it takes no turns."""
    turns = ordered_turns(table(spark, folder, "conversations"))
    sizes = write_through(turns.groupBy("conv").agg(F.count("*").alias("n")), "sizes")
    own_id = id_of(F.col("conv"))
    wanted = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % 100).alias("base"), (crc32_of_id(own_id) % 6).alias("h"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)).cast("bigint"))
    convs = wanted.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left").withColumn("taken", taken)
    convs = write_through(convs.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "rebuilt")
    own = turns.join(convs, "conv").filter("pos >= h").select("conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "role", "text")
    first = turns.filter("pos < 5 AND conv % 100 = 0").withColumnRenamed("conv", "base")  # h is 5 at most
    shared = first.join(convs, "base").filter("pos < taken").select("conv", (F.col("pos") + 1).alias("depth"), "role", "text")
    return prefix_trie(own.unionByName(shared), convs.select("conv", "size"))


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose ``planted`` number is a multiple of ten become periodic from some word on."""
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for row, h in enumerate(batch.column("planted").to_pylist()):
            if h % 10 == 0 and (words := texts[row].split()):
                g, n = h // 10, len(words)
                a = g % n
                period = words[a : a + 1 + (n - a) // (3 + g % 8)]
                texts[row] = b" ".join(words[:a] + (period * (-(-(n - a) // len(period))))[: n - a])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "text"])


@query("op13_period_runs")
def op13_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A null id has no decimal digits: it is planted by the crc32 of nothing, as other queries treat it."""
    docs = table(spark, folder, "documents")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), crc32_of_id(F.col("doc_id")).alias("planted"))
    found = periodic_runs(rows.mapInArrow(_planted, "doc_id bigint, text binary"))
    greater = "a.length * b.period > b.length * a.period"  # exact; runs are in order, so the first of equals stays
    best = F.expr(f"reduce(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0], (b, a) -> IF({greater}, a, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    some = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return some.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
