"""Token arrays and labels."""

from pyspark.sql import functions as F

from qaprep.functions import tokens as N
from qaprep.plans import build


def test_encode_and_decode(spark, evaluate):
    texts = ["héllo ü 漢", "", "abc"]
    assert evaluate(lambda c: N.decode_ids(N.pad_left(N.byte_ids(c), 40)), texts) == texts
    assert evaluate(lambda c: N.pad_left(N.token_ids(c, 5, True), 5), ["abcdefg", "ab"]) == [[97, 98, 99, 100, 101], [256, 256, 97, 98, 256]]
    assert evaluate(lambda c: N.attention_mask(N.token_count(c, 5, True), 5), ["abcdefg", "ab"]) == [[1] * 5, [0, 0, 1, 1, 1]]
    # a character cut by the truncation decodes to the replacement character
    assert evaluate(lambda c: N.decode_ids(N.token_ids(c, 2)), ["aü"]) == ["a�"]


def test_eval_labels(evaluate):
    assert evaluate(lambda c: N.eval_labels(c, 4), ["ab", "abcdef", ""]) == [[-100, 97, 98, 256], [97, 98, 99, 100], [-100, -100, -100, 256]]
    assert evaluate(lambda c: N.decode_labels(N.eval_labels(c, 4)), ["ab"]) == ["ab"]
    assert evaluate(N.decode_labels, [[-100, -100]], "array<int>") == [N.NO_LABELS]


def test_answer_span(spark):
    rows = [
        ("question é answer", "answer", 32, (32 - 18 + 12, 32)),
        ("aa bb aa", "aa", 16, (8, 10)),  # the first occurrence
        ("xx yy", " yy ", 16, (14, 16)),  # found without its outer blanks
        ("0123456789", "89", 9, (8, 9)),  # cut by the truncation: the part that is left
        ("0123456789", "9", 9, None),
        ("abc", "z", 8, None),
        ("abc", "", 8, None),
    ]
    for prompt, answer, limit, wanted in rows:
        df = spark.createDataFrame([(prompt, answer)], "p string, a string")
        got = df.select(N.answer_span(F.col("p"), F.col("a"), limit).alias("s")).first().s
        assert (None if got is None else (got.start, got.stop)) == wanted, (prompt, answer)


def test_find_ids(spark):
    df = spark.createDataFrame([([1, 12, 1, 2, 3], [1, 2]), ([1, 12], [2]), ([5], [5]), ([1, 2], [])], "h array<int>, n array<int>")
    assert [r.x for r in df.select(N.find_ids(F.col("h"), F.col("n")).alias("x")).collect()] == [2, None, 0, 0]


def test_training_rows(spark):
    metadata = "struct<smiles:string,n:int>"
    rows = [("q", "How many in {smiles}?", "There are <answer>{n}</answer>", "train", ("CCO", 3))]
    df = spark.createDataFrame(rows, f"question_id string, question_template string, assistant_template string, split string, metadata {metadata}")
    rendered = build.render_records(df, "Sys")
    row = build.tokenise_train(rendered, 128, weights=True).first()
    assert len(row.input_ids) == len(row.labels) == len(row.position_weights) == len(row.attention_mask) == 128
    text = bytes(i for i in row.input_ids if i < 256).decode()
    assert text == "Sys\n\nuser: How many in CCO?\n\nassistant: There are <answer>3</answer>"
    kept = [i for i in row.labels if i != -100]
    assert bytes(i for i in kept if i < 256).decode() == "There are <answer>3</answer>" and kept[-1] == 256
    assert row.labels[-len(kept):] == kept
    heavy = [i for i, w in enumerate(row.position_weights) if w == 5.0]
    assert [row.input_ids[i] for i in heavy] == [ord("3")] and set(row.position_weights) == {0.5, 5.0}
    assert sum(row.attention_mask) == len(text) + 1
    lost = build.tokenise_train(rendered, 20).first()
    assert set(lost.labels) == {-100}
    held = build.tokenise_eval(rendered, 128, 48).first()
    assert bytes(i for i in held.input_ids if i < 256).decode().endswith("assistant: ")
    assert len(held.labels) == 48


def pieces_tokenizer():
    """A tokenizer that merges across words: two characters a token, a token without text at the front."""

    def encode(texts):
        pair = lambda t, i: 1000 * ord(t[i]) + (ord(t[i + 1]) if i + 1 < len(t) else 0)
        return [([9000, *(pair(t, i) for i in range(0, len(t), 2))], [(0, 0), *((i, min(i + 2, len(t))) for i in range(0, len(t), 2))]) for t in texts]

    return encode


def test_offset_map(spark):
    rows = [("abcdef", "cd"), ("abcdef", "bc"), ("xx yy", " yy "), ("abc", "z"), ("abc", ""), (None, "a"), ("", "a"), ("漢字é!", "é")]
    df = spark.createDataFrame(rows, "p string, a string").repartition(2).withColumn("m", N.offset_tokenizer(pieces_tokenizer())(F.col("p")))
    got = {(r.p, r.a): (r.m, r.s) for r in df.withColumn("s", N.mapped_span(F.col("m"), F.col("p"), F.col("a"))).collect()}
    spans = {k: None if s is None else (s.start, s.stop) for k, (_, s) in got.items()}
    assert spans == {("abcdef", "cd"): (2, 3), ("abcdef", "bc"): (1, 3), ("xx yy", " yy "): (2, 4), ("abc", "z"): None, ("abc", ""): None, (None, "a"): None, ("", "a"): None, ("漢字é!", "é"): (2, 3)}
    assert got[None, "a"][0] is None and len(got["", "a"][0]) == 1
    assert [(t.start, t.stop) for t in got["abcdef", "cd"][0]] == [(0, 0), (0, 2), (2, 4), (4, 6)]


def test_weights_with_a_callers_tokenizer(spark, tmp_path):
    metadata = "struct<smiles:string,n:int>"
    rows = [(f"q{i}", "How many in {smiles}?", "There are <answer>{n}</answer>", split, ("CCO", 30 + i)) for i, split in enumerate(["train", "valid", "valid", "test"])]
    rows += [rows[2]] * 2  # repeated records
    df = spark.createDataFrame(rows, f"question_id string, question_template string, assistant_template string, split string, metadata {metadata}")
    tokenizer = N.offset_tokenizer(pieces_tokenizer())
    assert build.build_dataset(df, str(tmp_path / "d"), "Sys", weights=True, tokenizer=tokenizer, end_id=7, max_length=64, max_label_len=32) == 0
    row = spark.read.parquet(f"{tmp_path}/d/minimal").filter("split = 'train'").first()
    assert len(row.input_ids) == len(row.labels) == len(row.position_weights) == len(row.attention_mask) == 64
    whole = "Sys\n\nuser: How many in CCO?\n\nassistant: There are <answer>30</answer>"
    ids, offsets = pieces_tokenizer()([whole])[0]
    first = whole.index("There")
    kept = [x for x, (a, b) in zip(ids, offsets) if b > first and b > a] + [7]
    assert [x for x in row.labels if x != -100] == kept and row.labels[-len(kept):] == kept
    assert [x for x, m in zip(row.input_ids, row.attention_mask) if m] == [*ids, 7]
    body = whole.index("30")
    heavy = {row.input_ids[i] for i, w in enumerate(row.position_weights) if w == 5.0}
    assert heavy and heavy <= {x for x, (a, b) in zip(ids, offsets) if a < body + 2 and b > body}
    full = spark.read.parquet(f"{tmp_path}/d/full").select("split", "example_id").collect()
    assert len(full) == 5 and len({r.example_id for r in full}) == 5
    try:
        build.build_dataset(df, str(tmp_path / "e"), "Sys", weights=True, tokenizer=N.plugged_tokenizer(lambda t: [1]), end_id=7)
    except ValueError as e:
        assert "offsets" in str(e)
    else:
        raise AssertionError
    cut = build.mapped_train(build.render_records(df, "Sys"), tokenizer, 7, 12, weights=True).first()
    assert set(cut.labels) == {-100} and set(cut.position_weights) == {0.5}


def test_words(spark):
    df = spark.createDataFrame([(1, "a b a, a"), (2, "b c"), (3, ""), (4, None)], "k int, t string")
    vocab = {r.token: r.token_id for r in N.build_vocab(df, "t").collect()}
    assert vocab == {"a": 0, "b": 1, ",": 2, "c": 3}
    coded = N.encode_words(df, "t", N.build_vocab(df, "t", size=2)).orderBy("k").collect()
    assert [r.input_ids for r in coded] == [[0, 1, 0, -1, 0], [1, -1], [], None]


def test_sanitize(evaluate):
    assert evaluate(N.sanitize_ids, [[-100, 0, 256, 257, 5]], "array<int>") == [[256, 0, 256, 256, 5]]


def test_bounded_batches(spark):
    lengths = [0, 0, 1, 2, 3, 5, 8, 200, 3000] + [50] * 300 + [None]
    df = spark.createDataFrame([(i, None if n is None else [7] * n) for i, n in enumerate(lengths)], "i int, ids array<int>").repartition(3)
    batched = N.bounded_batches(df, "ids", ["i"], max_rows=16, max_ids=640)
    groups = {}
    for r in batched.collect():
        groups.setdefault((r.bucket, r.batch), []).append(len(r.ids or []))
    assert sum(map(len, groups.values())) == len(lengths)
    for sizes in groups.values():
        assert len(sizes) <= 16 and (len(sizes) * max(sizes) <= 640 or len(sizes) == 1) and max(sizes) <= 2 * max(1, min(sizes))
    padded = N.left_pad_batches(batched.filter("ids IS NOT NULL"), ["bucket", "batch"], {"ids": 256}).collect()
    assert all(r.ids == [256] * (len(r.ids) - lengths[r.i]) + [7] * lengths[r.i] for r in padded)


def test_saved_profile(spark, tmp_path):
    from qaprep.operators import evaluation as E
    from qaprep.sources.sinks import write_dataset

    rows = spark.createDataFrame([(f"q{i}", f"a{i % 3}", "train" if i < 20 else "valid" if i < 26 else "test") for i in range(30)], "prompt string, answer string, split string").repartition(4)
    train, held = build.tokenise_train(rows.filter("split = 'train'"), 16), build.tokenise_eval(rows.filter("split <> 'train'"), 16, 8)
    write_dataset(train, held, str(tmp_path / "d"))
    found = E.saved_profile(spark, str(tmp_path / "d"), samples=4)
    got = {(r.dataset, r.split): r for r in found.collect()}
    assert {k: r.n_rows for k, r in got.items()} == {("full", "valid"): 6, ("full", "test"): 4, ("minimal", "valid"): 6, ("minimal", "test"): 4, ("minimal", "train"): 20}
    want = E.dataset_profile(spark.read.parquet(f"{tmp_path}/d/minimal"), ["split"])
    for r in want.collect():
        own = got["minimal", r.split]
        assert (own.pad_min, own.pad_max, round(own.pad_mean, 9), own.masked_min, own.masked_max, round(own.masked_mean, 9)) == (r.pad_min, r.pad_max, round(r.pad_mean, 9), r.masked_min, r.masked_max, round(r.masked_mean, 9))
    assert "prompt" in got["full", "test"].columns and "prompt" not in got["minimal", "test"].columns
    shown = E.decoded_samples(found).collect()
    assert len(shown) == 4 * 5
    assert all(r.labels == f"a{int(r.input[1:]) % 3}" for r in shown if r.dataset == "full")
    again = E.decoded_samples(E.saved_profile(spark, str(tmp_path / "d"), samples=4)).collect()
    assert sorted(map(tuple, shown)) == sorted(map(tuple, again))  # seeded
    few = E.decoded_samples(E.saved_profile(spark, str(tmp_path / "d"), samples=2)).collect()
    assert set(map(tuple, few)) <= set(map(tuple, shown))


def test_bounded_batches_sort_no_arrays(spark, monkeypatch):
    """Only lengths and the order are numbered; a null or repeated key keeps its rows."""
    seen, real = [], N.group_positions
    monkeypatch.setattr(N, "group_positions", lambda df, *rest: seen.append(df.columns) or real(df, *rest))
    df = spark.createDataFrame([(None if i % 3 else 1, [i] * (i % 7)) for i in range(50)], "i int, ids array<int>").repartition(3)
    out = N.bounded_batches(df, "ids", ["i"], max_rows=4, max_ids=64)
    assert out.columns == ["i", "ids", "bucket", "batch"] and seen == [["_row", "_n", "bucket", "i"]]
    assert sorted((r.i or 0, r.ids) for r in out.collect()) == sorted((r.i or 0, r.ids) for r in df.collect())


def test_python_gets_small_batches(spark):
    """A batch is bounded in rows and bytes, whatever a task reads."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    few = spark.range(0, 20_000, 1, 1).mapInArrow(sizes, "n long, size long").collect()
    large = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 20000) AS t").mapInArrow(sizes, "n long, size long").collect()
    assert max(r.n for r in few) <= 2000 and max(r.size for r in large) < 5 << 20


def test_encode_words_where_the_row_is(spark):
    """A small vocabulary is looked up without moving a word; a large one is joined, with the same ids."""
    df = spark.createDataFrame([(1, "a b, a c"), (1, "a b, a c"), (None, None), (3, ""), (4, " \n"), (5, "c " * 500 + "é")] * 3, "k int, t string").repartition(3)
    vocab = N.build_vocab(df, "t", size=3)
    near, far = (N.encode_words(df, "t", vocab, travelling=n) for n in (3, 2))
    rows = lambda out: sorted(((r.k or 0), r.t or "", r.input_ids) for r in out.collect())
    assert rows(near) == rows(far) and near.columns == far.columns == ["k", "t", "input_ids"]
    assert "Join" not in near._jdf.queryExecution().analyzed().toString() and "Generate" not in near._jdf.queryExecution().analyzed().toString()
    nothing = N.encode_words(df, "t", vocab.limit(0))
    assert all(r.input_ids is None if r.t is None else set(r.input_ids) <= {-1} for r in nothing.collect())
