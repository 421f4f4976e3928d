"""Readers, writers and streams on small files."""

import gzip
import json
import pathlib

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from pyspark.sql import functions as F

from qaprep.functions.templates import QuestionConfig, Template, load_config
from qaprep.plans import build, evaluate, generate
from qaprep.sources import sdf, sinks, tables
from qaprep.streaming import jobs

RECORD = "{cid}\n  x\n\n  0  0  0     0  0            999 V2000\nM  END\n{props}$$$$\n"
PROPERTY = "> <{name}>\n{value}\n\n"


def structure_file(records):
    text = ""
    for cid, props in records:
        body = "".join(PROPERTY.format(name=n, value=v) for n, v in {"PUBCHEM_COMPOUND_CID": cid, **props}.items())
        text += RECORD.format(cid=cid, props=body)
    return text


def test_sdf(spark, tmp_path):
    one = structure_file([(1, {"PUBCHEM_XLOGP3": "1.5", "PUBCHEM_IUPAC_NAME": "two\nlines"}), (2, {"PUBCHEM_HEAVY_ATOM_COUNT": "many"}), (3, {})])
    two = structure_file([(4, {"PUBCHEM_HEAVY_ATOM_COUNT": "7", "PUBCHEM_XLOGP3": "nan"}), (5, {})]) + "broken\n$$$$\n"
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.sdf").write_text(one)
    (tmp_path / "in" / "deep" / "b.sdf").write_text(two)
    (tmp_path / "c.sdf.gz").write_bytes(gzip.compress(two.encode()))
    rows = {int(r.cid): r for r in sdf.sdf_source(spark, str(tmp_path / "in"), recursive=True).collect()}
    assert set(rows) == {1, 2, 3, 4, 5}
    assert rows[1].logp == 1.5 and rows[1].iupac == "two\nlines" and rows[2].num_atoms is None and rows[4].num_atoms == 7
    assert rows[3].formula is None
    assert sdf.sdf_source(spark, str(tmp_path / "c.sdf.gz")).count() == 2
    files = [str(tmp_path / "in" / "a.sdf"), str(tmp_path / "in" / "deep" / "b.sdf")]
    capped = sdf.sdf_source(spark, files, max_records=2)
    assert sorted(int(r.cid) for r in capped.collect()) == [1, 2, 4, 5]
    assert sdf.sdf_source(spark, files).schema == sdf.compound_schema()


def test_casts(evaluate):
    assert evaluate(lambda c: sdf.lenient_cast(c, "int"), ["3", " 3 ", "3.0", "x", None, ""]) == [3, 3, None, None, None, None]
    assert evaluate(lambda c: sdf.lenient_cast(c, "double"), ["3", "1e3", "2d", "inf", "x"]) == [3.0, 1000.0, None, float("inf"), None]
    assert evaluate(lambda c: sdf.lenient_cast(c, "boolean"), ["TRUE", "1", "0", "yes", None]) == [True, True, False, False, None]
    assert "inchi VARCHAR(2047), inchi_key VARCHAR(2047)" in sinks.column_types()


def test_arrow_files(spark, tmp_path):
    schema = pa.schema([("cid", pa.uint64()), ("name", pa.string_view()), ("v", pa.list_(pa.float32()))])
    path = tmp_path / "x.arrow"
    with ipc.new_file(str(path), schema) as writer:
        for start in (0, 3, 6):
            ids = [2**64 - 1 - i for i in range(start, start + 3)]
            writer.write_batch(pa.record_batch([pa.array(ids, pa.uint64()), pa.array(["a", None, "c"], pa.string_view()), pa.array([[1.0], [], None], pa.list_(pa.float32()))], schema=schema))
    table = tables.arrow_source(spark, str(path), batches_per_split=2)
    assert table.rdd.getNumPartitions() == 2
    assert sorted(int(r.cid) for r in table.collect()) == sorted(2**64 - 1 - i for i in range(9))
    assert table.filter("name IS NULL").count() == 3
    out = tmp_path / "out"
    sinks.write_arrow(spark.range(10).repartition(3), str(out), stream=True)
    parts = sorted(out.glob("part-*.arrow"))
    assert sum(ipc.open_stream(str(p)).read_all().num_rows for p in parts) == 10 and not list(out.glob("_attempt*"))


def test_text_readers(spark, tmp_path):
    (tmp_path / "r1.txt").write_text('header\nA>B>C\n\n"q",x>>y\n')
    (tmp_path / "r2.txt").write_text("header\n  \nA>B>C\n")
    lines = tables.reaction_lines(spark, str(tmp_path / "r*.txt"))
    assert sorted(r.value for r in lines.collect()) == ['"q",x>>y', "A>B>C", "A>B>C"]
    assert tables.reaction_lines(spark, str(tmp_path / "r2.txt"), skip_header=False).count() == 2
    (tmp_path / "ids").write_text("3\n\n 5 \n3\n")
    assert sorted(r.cid for r in tables.id_list(spark, str(tmp_path / "ids")).collect()) == [3, 5]
    (tmp_path / "t.tsv").write_text("1\tC\tmethane\n2\tCC\t\n")
    tsv = tables.headerless_tsv(spark, str(tmp_path / "t.tsv"), "cid INT, smiles STRING, iupac STRING").collect()
    assert [tuple(r) for r in tsv] == [(1, "C", "methane"), (2, "CC", None)]
    with gzip.open(tmp_path / "summaries_1_2.json.gz", "wt") as handle:
        json.dump([{"Record": {"RecordNumber": 1}}, {"Record": {"RecordNumber": 2}}], handle, indent=2)
    bundles = tables.summary_bundles(spark, str(tmp_path / "summaries_1_2.json.gz"))
    assert sorted(r.Record.RecordNumber for r in bundles.collect()) == [1, 2]


def test_load_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x ""y"""\n2,z\n')
    (tmp_path / "t.jsonl").write_text('{"a": 1, "b": null}\n{"a": 2, "b": "z"}\n')
    assert [tuple(r) for r in tables.load_table(spark, str(tmp_path / "t.csv")).collect()] == [(1, 'x "y"'), (2, "z")]
    assert tables.load_table(spark, str(tmp_path / "t.jsonl"), limit=1).count() == 1
    with pytest.raises(ValueError):
        tables.load_table(spark, str(tmp_path / "t.xlsx"))


CONFIG = """
system_prompt: "Answer in tags. "
question_set: iupac_naming
questions:
  - id: name
    user_template: "Name {smiles}\\n"
    assistant_template: "It is <answer>{iupac_name}</answer>\\n"
    difficulty: 2
"""


def test_paths_end_to_end(spark, tmp_path):
    """Table to questions, questions to splits, splits and predictions to metrics."""
    (tmp_path / "c.yaml").write_text(CONFIG)
    config = load_config(str(tmp_path / "c.yaml"))
    rows = [(i, "C" * i, f"name {i}" if i != 3 else None, i, "test" if i > 4 else "train") for i in range(1, 9)]
    spark.createDataFrame(rows, "cid int, smiles string, iupac string, num_atoms int, split string").write.parquet(str(tmp_path / "in.parquet"))
    written = generate.generate_file(spark, str(tmp_path / "in.parquet"), config, str(tmp_path / "q"), low=2)
    assert written == 6
    lines = [json.loads(line) for p in pathlib.Path(tmp_path / "q").glob("part-*") for line in p.read_text().splitlines()]
    assert set(lines[0]) == {"question_id", "question_template", "assistant_template", "split", "metadata"}
    assert "split" not in lines[0]["metadata"] and lines[0]["question_template"] == "Name {smiles}\n"
    records = tables.questions_source(spark, str(tmp_path / "q"))
    assert build.build_dataset(records, str(tmp_path / "d"), config.system_prompt, max_length=96, max_label_len=64) == 0
    assert build.build_dataset(records, str(tmp_path / "short"), config.system_prompt, max_length=20, max_label_len=64) == 2
    sampled = build.build_dataset(records, str(tmp_path / "few"), config.system_prompt, limit=3, max_length=96)
    assert sampled == 0 and spark.read.parquet(str(tmp_path / "few" / "minimal")).count() == 3
    assert not (tmp_path / "d" / "full" / "split=train").exists() and (tmp_path / "d" / "minimal" / "split=train").exists()
    with pytest.raises(ValueError):
        tables.tokenised_source(spark, str(tmp_path / "d" / "full"), "val")
    full = tables.tokenised_source(spark, str(tmp_path / "d" / "full"), "test")
    assert full.count() == 4
    assert full.select("example_id").distinct().count() == 4
    keyed = full.withColumn("example_id", F.col("metadata.cid"))
    keyed.write.partitionBy("split").parquet(str(tmp_path / "k"))
    said = spark.createDataFrame([(5, "<answer>name 5</answer>"), (6, "<answer>wrong</answer>"), (7, "name 7"), (8, "<answer>name 8.</answer>")], "example_id int, prediction string")
    out = evaluate.evaluate(spark, str(tmp_path / "k"), said, csv_path=str(tmp_path / "p"))
    assert out["exact_match"].first().exact_match == 0.75
    assert out["by_question"].first().correct == 3
    csv = spark.read.csv(str(tmp_path / "p"), header=True, multiLine=True, escape='"').orderBy("index").collect()
    assert [r["index"] for r in csv] == ["0", "1", "2", "3"] and csv[1].prediction == "<answer>wrong</answer>"


def test_missing_template_field(spark):
    df = spark.createDataFrame([("C", "x", 5)], "smiles string, iupac string, num_atoms int")
    config = QuestionConfig("", "iupac_naming", [Template("q", "{kekulized_smiles}", "{iupac}")])
    with pytest.raises(KeyError):
        generate.generate_questions(df, config)


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    record = lambda i: json.dumps({"Record": {"RecordNumber": i, "Section": {"TOCHeading": ["Preferred Compound"]}}})
    rows = [(i, 200 if i % 4 else 404, "", record(i)) for i in range(40)]
    schema = "page_id long, status int, header string, body string"
    make = lambda part: spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_batch=1)
        jobs.incremental_ingest(stream, "page_id", str(tmp_path / "out"), str(tmp_path / "cp"), bundle_size=4).awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).select(F.inline("records")).select("page_id").collect()
        return sorted(r.page_id for r in found)

    make(rows[:15])
    assert run() == [i for i in range(15) if i % 4]
    assert run() == [i for i in range(15) if i % 4]
    make(rows[15:30])
    make(rows[30:])
    assert run() == [i for i in range(40) if i % 4]


def test_watermarked_dedup(spark, tmp_path):
    rows = [(i % 3, f"2024-01-01 00:0{i}:00") for i in range(9)]
    df = spark.createDataFrame(rows, "k int, t string").selectExpr("k", "timestamp(t) AS t")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), df.schema)
    jobs.streaming_dedup(stream, ["k"], str(tmp_path / "out"), str(tmp_path / "cp"), event_time="t").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]


def test_two_appends_and_crlf(spark, tmp_path):
    path = str(tmp_path / "arrow")
    for part in (range(5), range(5, 10)):
        sinks.write_arrow(spark.createDataFrame([(i,) for i in part], "i int"), path)
    assert sorted(r.i for r in tables.arrow_source(spark, path).collect()) == list(range(10))
    record = "{0}\n  made\n\nM  END\n> <PUBCHEM_COMPOUND_CID>\n{0}\n\n> <PUBCHEM_MOLECULAR_FORMULA>\nC{0}\n\n$$$$\n"
    (tmp_path / "crlf.sdf").write_bytes("".join(record.format(i) for i in (1, 2, 3)).replace("\n", "\r\n").encode())
    (tmp_path / "lf.sdf").write_bytes("".join(record.format(i) for i in (4, 5)).encode())
    for name, want in (("crlf", [(1, "C1"), (2, "C2"), (3, "C3")]), ("lf", [(4, "C4"), (5, "C5")])):
        rows = sdf.sdf_source(spark, str(tmp_path / f"{name}.sdf")).collect()
        assert sorted((int(r.cid), r.formula) for r in rows) == want


def test_arrow_streams(spark, tmp_path):
    """Streams of several batches come back whole, read by several tasks; so does a stream with dictionaries, by one."""
    from qaprep.sources import arrow_files

    rows = [(i, None if i % 7 == 0 else "x" * (i % 50), [float(i), None]) for i in range(500)]
    table = pa.table({"i": pa.array([r[0] for r in rows], pa.uint64()), "t": pa.array([r[1] for r in rows]), "v": pa.array([r[2] for r in rows])})
    path = tmp_path / "s.arrow"
    with ipc.new_stream(str(path), table.schema) as out:
        out.write_table(table, max_chunksize=60)
    back = tables.arrow_source(spark, str(path), batches_per_split=2)
    assert back.rdd.getNumPartitions() == 5
    assert [(int(r.i), r.t, r.v) for r in back.orderBy("i").collect()] == rows
    with pa.OSFile(str(path)) as source:
        places = arrow_files.stream_batches(source)
        schema = ipc.open_stream(source).schema if source.seek(0) == 0 else None
        got = []
        for place in places:
            source.seek(place)
            got.append(ipc.read_record_batch(ipc.read_message(source), schema))
    assert len(places) == 9 and pa.Table.from_batches(got).equals(table)
    coded = pa.table({"w": pa.array(["a", "b", "a", "c"] * 10).dictionary_encode(), "n": list(range(40))})
    with ipc.new_stream(str(tmp_path / "d.arrow"), coded.schema) as out:
        out.write_table(coded, max_chunksize=10)
    with pa.OSFile(str(tmp_path / "d.arrow")) as source:
        assert arrow_files.stream_batches(source) is None
    with ipc.new_stream(str(tmp_path / "e.arrow"), table.schema):
        pass
    assert tables.arrow_source(spark, str(tmp_path / "e.arrow")).count() == 0
    out = str(tmp_path / "written")
    sinks.write_arrow(spark.range(100).repartition(3), out, stream=True)
    assert sorted(r.id for r in tables.arrow_source(spark, out, batches_per_split=1).collect()) == list(range(100))


def test_predictions_keep_their_order(spark, tmp_path):
    rows = [(i * 7919 % 1000, f'g "{i}"', "a,\nb") for i in range(1000)]
    df = spark.createDataFrame(rows, "example_id int, gold string, prediction string").repartition(5)
    sinks.write_predictions(df, str(tmp_path / "p"))
    import csv

    read = []
    for part in sorted((tmp_path / "p").glob("part-*.csv")):
        with open(part, newline="") as source:
            read += [tuple(r) for r in csv.reader(source)][1:]
    assert read == [(str(n), gold, said) for n, (_, gold, said) in enumerate(sorted(rows))]
    sinks.write_predictions(df.limit(0), str(tmp_path / "none"))
    assert spark.read.csv(str(tmp_path / "none"), header=True, schema="index long, gold_label string, prediction string").count() == 0
