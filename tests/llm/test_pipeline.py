"""The pipeline stage by stage on a small table, and the registered queries on the smallest test tables."""

import time

import numpy as np
import pytest
from llm_cases import SF, needs_tables, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from qaprep.llm import packing


@pytest.fixture(scope="module")
def folder(llm, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    bad = "what a scoundrel."
    rows = [(i, prose(i, 60) + (" " + bad if i % 5 == 0 else ".")) for i in range(100)]
    rows += [(200, rows[1][1]), (201, rows[2][1].upper()), (202, rows[3][1] + " and more"), (203, prose(77, 20) + "\n" + rows[4][1]), (204, None), (205, "")]
    frame = llm.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string")
    frame.write.parquet(f"{root}/documents.parquet")
    llm.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(100)], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, folder)
        path = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = llm.read.parquet(path)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_key"]
    clean = {i for i in range(100) if i % 5} | {200, 201, 202, 203, 204, 205}
    assert seen[0] == clean
    assert seen[1] == clean - {1, 2, 204}  # the largest id of equal texts stays; null and empty are equal
    assert seen[2] == seen[1] - {202}
    assert seen[3] == seen[2]  # 203 loses a passage, no more
    assert seen[4] == seen[3]
    pieces = docs.filter("doc_id = 203").collect()
    assert 0 < sum(p.length for p in pieces) < 70 and all(len(packing.unpack(p.ids)) == p.length for p in pieces)


def test_run(llm, folder):
    rows = corpus_pipeline.run(llm, folder).collect()
    assert {r.doc_id for r in rows} >= {3, 203, 205} and not {5, 1, 202} & {r.doc_id for r in rows}


@needs_tables
def test_embeddings_query_has_the_recall(llm):
    """Links of every vector, not a sample of them, against all pairs."""
    rows = llm.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.array(list(rows.embedding), dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = ((x @ x.T) >= 0.9).sum() - len(x)
    got = entry_points.queries()["op10_embedding_dedup"](llm, SF).toPandas()
    assert 0.9 * true <= got.n_links.sum() <= true


def test_ten_operators_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_written_steps_leave_no_shuffle_files(llm):
    """They went only when the driver happened to collect its garbage."""
    from qaprep.session import SHUFFLE_CLEANUP, write_through

    def shuffles():
        files = llm._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    def fresh():  # files are dropped a moment later
        for _ in range(50):
            if not (new := shuffles() - there):
                break
            time.sleep(0.2)
        return new

    there, before = shuffles(), llm.conf.get(SHUFFLE_CLEANUP, None)
    grouped = llm.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    written = write_through(grouped, "grouped")
    assert not fresh() and llm.conf.get(SHUFFLE_CLEANUP, None) == before
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, grouped.collect()))  # the frame itself can be read again
    held = grouped.collect()
    again = write_through(grouped, "grouped")
    assert again.count() == 7 and sorted(grouped.collect()) == sorted(held)
