"""Packing, token files and piece codes against the libraries."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import packing, pieces, queries, token_files, token_ids
from headway.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library_ids(path, texts, end):
    library = Tokenizer.from_file(path)
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [b"".join(i.to_bytes(4, "little") for i in [*e.ids, end]) for e in found]


ODD = "ab the ing 's 'll I'M \xa0 \n\t\x1c\x0b\x00é日本é語😀<|endoftext|>ΩΣς ΑΣ Ж١\r xqz019.,;'\"İʼn<|startoftext|>​"


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_of_odd_texts(path):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(50))) for _ in range(1500)]
    encoder = token_ids.Encoder(path)
    assert encoder.pattern is not None
    assert encoder.encode(texts) == encoder.whole(texts) == encoder.encode(texts)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_added_tokens_as_the_library_gives_them(path):
    texts = ["a <|endoftext|> b", "<|startoftext|>It's", "x<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "<|endoftext", "a b"]
    wanted = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    found = [list(memoryview(ids).cast("I")) for ids in token_ids.Encoder(path).encode(texts)]
    assert found == wanted
    assert {WORDS: 49407, BYTES: 50256}[path] in found[0]


def test_ids_beyond_the_width_raise(tmp_path):
    with pytest.raises(ValueError, match="width"):
        token_files.Packing(2, b"").serialize((70_000).to_bytes(4, "little"))
    assert token_ids.Encoder(BYTES).width == 2
    with pytest.raises(ValueError, match="file system"):
        token_files._place("s3a://bucket/folder")


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(token_ids, "REMEMBERED", 50)
    encoder = token_ids.Encoder(BYTES)
    texts = [" ".join(f"w{i}x{k}" for k in range(9)) for i in range(60)]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert len(encoder.known) <= 50 and len(encoder.known.older) <= 50


def test_packing_query(spark, small, texts):
    ids = dict(zip(texts, library_ids(WORDS, texts.values(), 1)))
    rows = queries.op2_tiered_packing(spark, small).collect()
    by_doc, by_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        mine = ids[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(mine[4 * r.start : 4 * (r.start + r.length)])
        assert r.doc_tokens == len(mine) // 4 and r.length > 0
        by_doc[r.doc_id].append((r.start, r.length))
        by_window[r.sequence_id].append((r.offset, r.length, r.tier))
    assert by_doc.keys() == ids.keys()
    for doc, found in by_doc.items():
        assert [s for s, _ in sorted(found)] == [sum(n for _, n in sorted(found)[:k]) for k in range(len(found))]
        assert sum(n for _, n in found) == len(ids[doc]) // 4
    padding = 0
    for found in by_window.values():
        found.sort()
        assert [o for o, _, _ in found] == [sum(n for _, n, _ in found[:k]) for k in range(len(found))]
        total = sum(n for _, n, _ in found)
        assert total <= found[0][2] <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding < 2048 * packing.TIERS[0] / packing.GROUP_ROWS * len(texts) + 2048


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60))
def test_windows_are_full_but_one(lengths):
    windows = packing.pack(enumerate(lengths))
    parts = collections.defaultdict(list)
    for tier, pieces_ in windows:
        assert sum(n for _, _, n in pieces_) <= tier
        for name, start, n in pieces_:
            parts[name].append((start, n))
    assert sum(sum(n for _, _, n in p) < t for t, p in windows) <= 1
    for name, length in enumerate(lengths):
        found = sorted(parts[name])
        assert [s for s, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))]
        assert sum(n for _, n in found) == length
    numbers = packing.steps(windows)
    for step in set(numbers):
        assert len({windows[i][0] for i, s in enumerate(numbers) if s == step}) == 1


def test_token_file_query(spark, small, texts):
    start, wanted = 0, []
    for doc, ids in zip(texts, library_ids(BYTES, texts.values(), 0)):
        wanted.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(map(tuple, queries.op4_token_files(spark, small).collect())) == wanted


def test_one_document_by_the_index(spark, small, texts, monkeypatch):
    folder = token_files.qualified(spark, scratch_path(spark, "tokens"))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    token_files.write(docs, folder, BYTES, 0)
    packing_ = token_files.stored_packing(spark, folder)
    assert packing_.dictionary
    ids = dict(zip(texts, library_ids(BYTES, texts.values(), 0)))
    order = iter(texts)
    for r in spark.read.parquet(f"{folder}/manifest").orderBy("name").collect():
        for place in range(r.documents):
            doc = next(order)
            if place in (0, 7, r.documents - 1):
                assert token_files.document(folder, packing_, r.name, place) == ids[doc]
    other = token_files.Packing(2, packing_.dictionary[:-1])
    name = spark.read.parquet(f"{folder}/manifest").first().name
    data = open(f"{folder}/files/{name}".removeprefix("file:"), "rb").read()
    with pytest.raises(ValueError, match="dictionary"):
        list(token_files.parse(data, other))


@pytest.fixture(scope="module")
def codec():
    return pieces.Encoder(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_piece_query(spark, small, texts, codec):
    library = codec[1]
    wanted = {}
    for doc, text in texts.items():
        ids = library.encode(text or "")
        code = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted[doc] = (len(ids), code, hashlib.sha256(library.decode(ids).encode()).hexdigest())
    rows = queries.op6_piece_round_trip(spark, small).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == wanted


def test_pieces_of_odd_texts(codec):
    mine, library = codec
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice(ODD + "▁ aaatt  ") for _ in range(rng.randrange(50)))
        assert mine.encode(text) == library.encode(text), text
        assert pieces.decoded(mine.parts(text)) == library.decode(library.encode(text)), text
    for _ in range(2000):
        text = "".join(library.id_to_piece(rng.randrange(3, 32000)) for _ in range(rng.randrange(1, 9)))
        assert mine.encode(text) == library.encode(text), text
    for text in ("a" * 3000, "ab" * 2000, " " * 999, "\n" * 50):
        assert mine.encode(text) == library.encode(text)


def test_long_parts_take_linear_time(codec):
    import time

    mine, library = codec
    rng = random.Random(2)
    spent = []
    for n in (200_000, 2_000_000):
        text = "".join(rng.choices("thereinganost", k=n))
        start = time.process_time()
        found = mine.encode(text)
        spent.append(time.process_time() - start)
        assert found == library.encode(text)
    assert spent[1] < 25 * spent[0]


def test_parts_met_lately_are_bounded(monkeypatch, codec):
    monkeypatch.setattr(pieces, "REMEMBERED", 40)
    mine = pieces.Encoder(MODEL)
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join(f"part{rng.randrange(150)}" for _ in range(5))
        assert mine.encode(text) == codec[1].encode(text)
        assert len(mine.known) <= 40 and len(mine.older) <= 40
    parts = mine.parts("part1 part2")
    assert mine.parts("part1 part2")[0] is parts[0]


def test_backtracking_equals_merging(codec):
    vocabulary = codec[0].vocabulary
    rng = random.Random(6)
    for _ in range(800):
        text = "".join(rng.choice("thereinganost▁") for _ in range(rng.randrange(1, 20)))
        assert vocabulary.encode_known(text) == vocabulary.merge_plainly(text)


def test_decoding_any_ids(codec):
    mine, library = codec
    rng = random.Random(8)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(0, 270), rng.randrange(32000)]) for _ in range(rng.randrange(9))]
        assert mine.vocabulary.decode(ids) == library.decode(ids), ids
