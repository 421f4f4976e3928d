"""Packing, BPE and token files against the tokenizer libraries."""

import base64
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaprep.llm import bpe, packing, token_files
from qaprep.llm.tokens import WordEncoder

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
ODD = ["", " ", "  a  b ", "don't  stop\n\n\tnow ", "a b c ́x", "x" * 700, "ab" * 400, "a<|endoftext|>b", "<|startoftext|>x <|STARTOFTEXT|> y<|endoftext|>", "<|start of|> <|", "Straße İstanbul ΣΑΣ ŉ it's WE'LL 3½ x²y ÀÉ n\u0303 \u00adsoft a\u0301b </w> a</w>b", "日本語 テキスト 12345 ½ ²", " lead", "trail ", "CamelCase's WE'LL \x1c \x85 end", "a" * 300 + " " + "é" * 300]


def library(vocab, name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab.path(name))


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_word_encoder(vocab, edge_rows, name, spaced):
    texts = ODD + [t or "" for _, t in edge_rows]
    encoder = WordEncoder(vocab.path(name), spaced, most=5)  # the table starts afresh again and again
    assert (encoder.ranked is not None) == spaced
    want = [e.ids for e in library(vocab, name).encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == want
    assert [np.frombuffer(encoder.encode([t])[0], encoder.dtype).tolist() for t in texts] == want
    encoder.ranked = None  # word by word with the library of the file
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == want


def test_plain_words_need_one_call_and_no_slow_library(vocab, monkeypatch):
    words = ["don't", "WE'LL", "x" * 50, "a1b22", "\u00c9t\u00e9", "'s", "'", "!?'re", "\u0149\u017f", "1\u00b2\u00bd", "rock'n'roll"]
    texts = [" ".join(words), "\n".join(words) + "\n", "", " ", *words]
    encoder, calls = WordEncoder(vocab.path("word_bpe_49k.json"), False), []
    encode = encoder.pieces.encode_ordinary
    monkeypatch.setattr(encoder.pieces, "encode_ordinary", lambda text: calls.append(text) or encode(text))
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert len(calls) == 1 and "tokenizer" not in vars(encoder)
    assert got == [e.ids for e in library(vocab, "word_bpe_49k.json").encode_batch_fast(texts, add_special_tokens=False)]
    odd = "\x01 a\x01b \u0130 \u03a3\u03a3 \t word"  # the end mark, and words that are not plain
    assert np.frombuffer(encoder.encode([odd])[0], encoder.dtype).tolist() == library(vocab, "word_bpe_49k.json").encode(odd, add_special_tokens=False).ids


def test_bpe(vocab, llm, edge_docs, edge_rows):
    import tiktoken

    path = vocab.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(path, vocab.PATTERN)
    for text in ODD:
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)
    decoded = bpe.decode(bpe.encode(edge_docs, path, vocab.PATTERN), path).collect()
    got = sorted((r.doc_id or 0, tuple(r.ids), bytes(r.decoded)) for r in decoded)
    assert got == sorted((i or 0, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in edge_rows)


def test_pair_table():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    table = bpe.PairTable(ranks)
    assert table.find(np.array([97, 256, 97, 98, 120, -1]), np.array([98, 99, 258, 99, 121, 98])).tolist() == [256, 257, 257, 258, 1 << 40, 1 << 40]


def test_first_fit_decreasing():
    sizes = np.array([4, 8, 1, 4, 2, 1, 7, 3])
    bins = packing.first_fit_decreasing(sizes, 10)
    room, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(10)
        room[at] -= sizes[i]
        want[i] = at
    assert bins.tolist() == want


def test_packing(vocab, edge_docs, edge_rows):
    path = vocab.path("byte_bpe_50k.json")
    rows = packing.pack(edge_docs, path, length=64, group=20).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and 0 < p.length == len(packing.unpack(p.ids))
            at += p.length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding == 0
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r)
    tokenizer = library(vocab, "byte_bpe_50k.json")
    for i, t in edge_rows:
        if [x for x, _ in edge_rows].count(i) > 1:
            continue
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(texts[i], key=lambda p: p.start)
        assert [x for p in own for x in packing.unpack(p.ids)] == ids and {p.doc_tokens for p in own} == {len(ids)}
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own[:-1]]))
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in edge_rows)


def test_token_files(llm, vocab, edge_docs, edge_rows, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(edge_docs, folder, vocab.path("word_bpe_49k.json"))
    rows = sorted(token_files.read_tokens(llm, folder).collect(), key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys) and len(rows) == len(edge_rows)
    tokenizer, at = library(vocab, "word_bpe_49k.json"), 0
    wanted = {}
    for i, t in edge_rows:
        wanted.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    for r in rows:
        ids = packing.unpack(r.ids)
        assert r.start == at and r.n_tokens == len(ids) and ids in wanted[r.doc_id]
        at += len(ids)
    few = token_files.read_tokens(llm, folder, [4, 13]).collect()
    assert {(r.doc_id, r.start) for r in few} == {(r.doc_id, r.start) for r in rows if r.doc_id in (4, 13)}


def test_token_files_name_their_dictionary(llm, vocab, edge_docs, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(edge_docs, folder, vocab.path("word_bpe_49k.json"))
    llm.createDataFrame([("0" * 64, bytearray(b""))], "dictionary string, bytes binary").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="needs the dictionary"):
        token_files.read_tokens(llm, folder).collect()


def test_empty(llm, vocab, no_docs, tmp_path):
    assert packing.pack(no_docs, vocab.path("byte_bpe_50k.json")).count() == 0
    path = vocab.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.decode(bpe.encode(no_docs, path, vocab.PATTERN), path).count() == 0
    token_files.write_tokens(no_docs, str(tmp_path / "none"), vocab.path("word_bpe_49k.json"))
    assert token_files.read_tokens(llm, str(tmp_path / "none")).count() == 0


def test_digest_of_ids(llm, vocab):
    rows = llm.createDataFrame([(1, "the cat sat")], "doc_id bigint, text string")
    piece = packing.pack(rows, vocab.path("byte_bpe_50k.json")).select("ids", F.crc32("ids").alias("c")).collect()
    assert all(packing.checksum(packing.unpack(p.ids)) == p.c for p in piece)
