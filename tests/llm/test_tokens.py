import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paddock.llm import token_counts, token_output, tokenizing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
ODD = [None, "", " ", "a", "\n\n", "  two  spaces ", "it's we'll\x1c !\x1c x", "end<|endoftext|>start <|endoftext|>",
       "zero \0abc abc \0", "tab\t x  y  z", "naïve Ünï ½ ² 漢字 🙂🙂", "x" * 5000, "word " * 3000, "a\r\n b\u0085 c", "a", "a"]


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\0'a1Zé漢.!\x1c\x85\u2003sl½_", "<|endoftext|>", "  ", " \n"]), max_size=40).map("".join), max_size=4))
def test_units_and_pre_tokens_match_the_library(texts):
    enc = token_output.UnitEncoder(PATH, 1000)
    assert enc.ids(texts, b"") == [np.array(ids(t), dtype="<u4").tobytes() for t in texts]
    counter = token_counts.TwoTierCounter(PATH, {"a": 1}, 1000)
    assert counter.counts(texts) == [len(ids(t)) for t in texts]


def test_new_units_are_encoded_in_runs():
    enc, seen = token_output.UnitEncoder(PATH, 100_000), []
    encode = enc.encode
    enc.encode = lambda texts, **options: seen.extend(texts) or encode(texts, **options)
    texts = [" ".join(f"w{i * j}x" for i in range(500)) + "\n" for j in range(1, 5)]
    want = [np.array(ids(t), dtype="<u4").tobytes() for t in texts]
    assert enc.ids(texts, b"") == want and len(seen) < 20
    enc.known.clear()
    enc.spaced[:] = False  # no place to cut a run: every unit by itself
    assert enc.ids(texts, b"") == want and len(seen) > 1000


def test_runs_make_no_special_strings(tmp_path):
    path = str(tmp_path / "t.json")
    own = Tokenizer.from_file(PATH)
    own.add_special_tokens(["a b", "b a"])
    own.save(path)
    texts = ["x a", "x b", "x a b", "b a x"]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert token_output.UnitEncoder(path, 1000).ids(texts, b"") == want


def test_slices_do_not_change_counts():
    text = ("some words\n\n  and   spaces " * 400)[:9000]
    assert "".join(tokenizing.slices(text, 100)) == text
    assert sum(len(ids(s)) for s in tokenizing.slices(text, 100)) == len(ids(text))


@pytest.mark.parametrize("bits", [False, True])
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
@settings(max_examples=50, deadline=None)
def test_planes_round_trip(bits, values):
    a = np.array(values, dtype="<u4")
    planes = token_output.shuffle_planes(a, bits)
    assert len(planes) == (32 if bits else 4)
    assert token_output.unshuffle_planes(planes, len(a)).tolist() == values


@given(st.binary(max_size=200), st.binary(max_size=300))
@settings(max_examples=100, deadline=None)
def test_crc_of_two_parts(a, b):
    assert token_output.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_tokens int")


def test_count_tokens_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(None, "null id"), (3, "a")]
    got = token_counts.count_tokens(_docs(spark, rows), PATH, table_entries=8, cache_entries=2).collect()
    assert sorted(((r.doc_id or -1), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        ((i or -1), len((t or "").encode()), len(ids(t)), len(ids(t)) > 1024) for i, t in rows)
    assert token_counts.count_tokens(_docs(spark, []), PATH).collect() == []


@pytest.mark.parametrize("bits", [False, True])
def test_write_and_read_back(spark, bits):
    rows = list(enumerate(ODD)) + [(None, "null id"), (3, "a"), (3, "again")]
    path = token_output.write_tokens(_docs(spark, rows).repartition(3), PATH, 2, block_ids=64, bits=bits, cache_entries=4)
    got = sorted(token_output.documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] + sorted(i for i, _ in rows if i is not None)
    at, texts = 0, {}
    for r in got:
        assert r.start == at
        at += r.n_tokens
        texts.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    want = {}
    for i, t in rows:
        a = np.array(ids(t) + [2], dtype="<u4")
        want.setdefault(i, []).append((len(a), zlib.crc32(a.tobytes())))
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    pieces = token_output.read_pieces(spark, path).orderBy("start", "offset").collect()
    assert b"".join(bytes(p.ids) for p in pieces if p.doc_id == 12) == np.array(ids(ODD[12]) + [2], dtype="<u4").tobytes()
    sizes = spark.read.parquet(f"{path}/chunks").select("n_ids").collect()
    assert max(r.n_ids for r in sizes) == 64
    empty = token_output.write_tokens(_docs(spark, []), PATH, 2)
    assert token_output.documents(spark, empty).collect() == []
