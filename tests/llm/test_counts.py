"""Token counts against the library, whole and piece by piece."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lacuna.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "'s", "'", "'re", "'r", "'l", "'ll", "'ve", "'t", " ", "  ", "\n", "\t", " ", "　",
         "é", "中", "１", "½", "\U0001f642", "<|endoftext|>", "<|endoftext", "|>", "l", "e", "r", "1", "23",
         "_", "...", "\x1c", "\x85", "​", "́", "the", " the", "ing", "aaaa", "=====", "\x00", "'S"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def counted(texts):
    return C.count_tokens(pa.array(texts), PATH)[1].tolist()


def test_random_texts(library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.choice([0, 1, 2, 3, 5, 8, 30, 200]))) for _ in range(6000)]
    assert counted(texts) == library(texts)


def test_long_pieces(library):
    rng = random.Random(4)
    texts = []
    for n in (63, 64, 65, 128, 129, 1000, 40_000):
        texts += [x * n for x in ("a", "ab", " ", "\n", "'", "中", "=", "é")]
        texts += ["".join(rng.choices(x, k=n)) for x in ("abcdefgh", "aA", "中文字符", "=-_")]
    assert counted(texts) == library(texts)


def test_every_code_point(library):
    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    texts = ["".join(f"a{p}1{p} {p}{p}x" for p in points[k:k + 200]) for k in range(0, len(points), 200)]
    assert counted(texts) == library(texts)


def test_vocabulary_and_triples(library):
    rng = random.Random(5)
    tokens = [t.decode() for t in C.compiled(PATH).v.bytes.values() if t.isascii()]
    texts = tokens + ["".join(rng.choices(tokens, k=3)) for _ in range(20_000)]
    assert counted(texts) == library(texts)


def test_a_small_table_changes_nothing(library):
    small = C.Counter(C.Vocabulary(PATH), 50)
    rng = random.Random(6)
    pieces = ["".join(rng.choices("abcdeinorst", k=rng.choice([1, 5, 9, 70, 40_000]))) for _ in range(60)]
    raw = np.frombuffer("".join(pieces).encode(), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    got = small.count(raw, np.concatenate([[0], ends[:-1]]), ends)
    assert got.tolist() == library(pieces)
    assert len(small.keys) < 50 + C.BLOCK


def test_scan_composes_maps():
    maps = np.random.default_rng(1).integers(0, C.CUTTER, (77, C.CUTTER)).astype(np.uint8)
    now, got = np.arange(C.CUTTER, dtype=np.uint8), C.scan(maps)
    for k in range(77):
        now = maps[k][now]
        assert (got[k] == now).all()


COLUMNS = ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def expected(rows, library):
    texts = [t or "" for _, t in rows]
    return sorted(((d, len(t.encode()), n, n > 1024) for (d, _), t, n in zip(rows, texts, library(texts))), key=str)


def test_query_equals_library(spark, sf_small, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert of(C.op11_token_counts(spark, sf_small)) == expected(rows, library)


def test_odd_rows(spark, odd_docs, odd_rows, as_table, library):
    got = of(C.op11_token_counts(spark, as_table(documents=odd_docs)))
    assert got == expected([(d, t) for d, t, _ in odd_rows], library)


def test_special_strings_where_texts_meet(spark, library):
    rows = [(1, "x <|endo"), (2, "ftext|> y"), (3, "<|endoftext|><|endoftext|>"), (4, None), (5, "a<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert of(C.token_counts(df, PATH)) == expected(rows, library)


def test_empty_table(spark, no_docs, as_table):
    assert C.op11_token_counts(spark, as_table(documents=no_docs)).count() == 0


def test_packing_ids_do_not_depend_on_its_cache(monkeypatch):
    """Words forgotten and learned again, in any case, have the tokenizer's ids."""
    from lacuna.llm import packing
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(8)
    words = ["Word", "word", "WORD", "don't", "x1y2", "été", "Straße", "中文", "a-b", "\U0001f642"] + [
        "".join(rng.choices("abcdeABC'1", k=rng.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(60)]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (0, 20_000, 1 << 30):
        monkeypatch.setattr(packing, "CACHED_BYTES", most)
        ids = packing.WordIds(path)
        got = [np.frombuffer(x, "<u4").tolist() for lo in range(0, 60, 5) for x in ids.of(texts[lo:lo + 5])]
        assert got == want
