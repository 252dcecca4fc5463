"""Ids, token files and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wattledger.llm import catalog, ids, token_counts, token_files
from wattledger.llm.tables import new_folder
from wattledger.llm.words import slices

from .conftest import given, same_rows, texts

PIECES = ["a", "B", " ", " ", " ", "\n", "\t", "\r", "'s", "'", "é", "\u0301", "\xa0", "\u2003", "\u3000", "\x1c", "\x85", "1", ",", ".",
          "<|endoftext|>", "<|startoftext|>", "ǅ", "İ", "한", "😀", "\u200d", "\x00", "\x0b", "_", "ß", "’", "the", "and"]


def odd_texts(n=4000):
    draw = random.Random(5)
    return [t or "" for t in texts()] + ["".join(draw.choices(PIECES, k=draw.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("name, leading", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@pytest.mark.parametrize("size, memory", [(500, 50), (4 << 20, 2_500_000)])
def test_ids_equal_those_of_the_library(name, leading, size, memory, monkeypatch):
    monkeypatch.setattr(ids, "MEMORY_PARTS", memory)
    own = ids.Encoder(ids.public_path(name), leading)
    given_ = odd_texts()
    got = []
    for s in slices(pa.array(given_), size=size):
        flat, at = own.texts(s)
        got += [flat[at[i]:at[i + 1]].tolist() for i in range(s.rows)]
    library = Tokenizer.from_file(ids.public_path(name))
    for text, mine, theirs in zip(given_, got, library.encode_batch(given_, add_special_tokens=False), strict=True):
        assert mine == theirs.ids, text


def test_counts_equal_those_of_the_library(spark, docs, empty):
    path = ids.public_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(odd_texts())) + given(docs), "doc_id long, text string")
    rows = given(df)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    want = [(i, len((t or "").encode()), k, k > 2048) for (i, t), k in zip(rows, n)]
    same_rows([tuple(r) for r in token_counts.count(df, path).collect()], want)
    assert token_counts.count(empty, path).count() == 0


def test_merges_by_heap_equal_merges_by_scan():
    own = token_counts.Counter(ids.public_path("word_bpe_49k.json"))
    draw = random.Random(9)
    for _ in range(500):
        word = "".join(draw.choices("theandinr", k=draw.randrange(1, 30)))
        symbols = [*word[:-1], word[-1] + own.suffix]
        while pairs := [(own.rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in own.rank]:
            _, i = min(pairs)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        assert own.merged(word) == len(symbols)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_numbers_round_trip(n):
    draw = random.Random(n)
    values = np.array([draw.choice([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]) for _ in range(n)], dtype=np.uint32)
    raw = token_files.pack_numbers(values)
    got, used = token_files.unpack_numbers(np.frombuffer(raw + b"rest", np.uint8), n)
    assert got.tolist() == values.tolist() and used == len(raw)


def test_block_round_trip():
    keys, lengths, ranks = token_files.read_block(token_files.write_block([None, -5, 7], np.array([1, 2, 0]), np.array([3, 70_000, 5])))
    assert keys == [None, -5, 7] and lengths.tolist() == [1, 2, 0] and ranks.tolist() == [3, 70_000, 5]


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_files_hold_every_document_in_order(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    name, path = ids.public_path("word_bpe_49k.json"), new_folder(spark, "tokens")
    library = Tokenizer.from_file(name)
    token_files.write(docs.repartition(3), path, name)
    # another session has nothing but the folder
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_files.read(spark.newSession(), path).collect()]
    assert token_files.header(spark, path)[:2] == ("word_bpe_49k.json", 2)
    got.sort(key=lambda r: r[1])
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in given(docs)]
    same_rows([(i, x) for i, _, x in got], want)
    assert [i for i, _, _ in got] == sorted([i for i, _ in want], key=lambda i: (i is not None, i))
    assert [s for _, s, _ in got] == np.cumsum([0, *[len(x) for _, _, x in got]])[:-1].tolist()
    none = new_folder(spark, "tokens")
    token_files.write(empty, none, name)
    assert token_files.read(spark, none).count() == 0


def test_frequent_ids_get_small_ranks(spark, docs):
    path = new_folder(spark, "tokens")
    token_files.write(docs, path, ids.public_path("word_bpe_49k.json"))
    by_rank = token_files.header(spark, path)[2]
    assert sorted(by_rank.tolist()) == list(range(len(by_rank)))
    library = Tokenizer.from_file(ids.public_path("word_bpe_49k.json"))
    count = np.bincount(sum([[*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in given(docs)], []), minlength=len(by_rank))
    assert (np.diff(count[by_rank]) <= 0).all()


def test_query_of_the_files(spark, tmp_path, docs):
    docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(ids.public_path("word_bpe_49k.json"))
    start = 0
    want = []
    for i, t in sorted(given(spark.read.parquet(f"{tmp_path}/documents.parquet"))):
        x = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    same_rows([tuple(r) for r in catalog.op2_token_files(spark, str(tmp_path)).collect()], want)
