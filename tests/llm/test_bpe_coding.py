import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import awkward_rows, documents
from tickwise.llm import bpe_coding as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
ENCODE = op.PrefixEncoder(PATH)
BYTES = op.Vocabulary(PATH).bytes_of


def library(text):
    ids = TOK.encode(text, add_special_tokens=False).ids
    return np.asarray(ids, "<u4").tobytes(), TOK.decode(ids, skip_special_tokens=False)


def both(text):
    ids = ENCODE([text])[0]
    return ids, op.decode(ids, BYTES)


PARTS = ["<|endoftext|>", "the", " ", "  ", "a", "aa", "aaa", "'re", "'", "\n", "\t", "é", "É", "日本", "𝒳", "՘",
         "࢏", "\x1c", "\x85", "\xa0", "12", "ำ", "<|", "|>", "endoftext", "x" * 70, "\x00", "²", "🙂"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=30))
def test_ids_and_text_are_the_librarys(text):
    assert both(text) == library(text)


def test_every_token_that_merging_can_leave_encodes_to_itself():
    tokens = op.Vocabulary(PATH).tokens()
    assert len(tokens) == len(BYTES) - 1
    for text, token in random.Random(1).sample(sorted(tokens.items()), 3000):
        assert ENCODE.follow(ENCODE.last_tokens(text)) == token.to_bytes(4, "little")


def test_last_tokens_are_those_of_every_prefix():
    word = " internationalisationalised".encode()
    last = ENCODE.last_tokens(word)
    for n in range(1, len(word) + 1):
        ids, _ = library(word[:n].decode())
        assert last[n] == int.from_bytes(ids[-4:], "little")
    assert ENCODE.together([word[:n] for n in range(len(word), 0, -1)]) == [
        library(word[:n].decode())[0] for n in range(len(word), 0, -1)]


def test_character_classes():
    for c in range(op.STABLE + 1):
        text = f"a{chr(c)}b1{chr(c)} {chr(c)}!  {chr(c)} "
        assert [text[a:b] for _, (a, b) in ENCODE.own.pre_tokenize_str(text)] == ENCODE.words.findall(text), c


def test_long_words():
    for text in ["x" * 30_000, " " * 20_000 + "a", "ab" * 10_000, "日本語テキスト" * 3_000, "".join(
            random.Random(2).choice("etaoin") for _ in range(20_000))]:
        assert both(text) == library(text)


def test_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(op, "CACHE_WORDS", 3)
    monkeypatch.setattr(op, "CACHE_PAIRS", 1)
    monkeypatch.setattr(op, "LONG_WORD", 5)
    monkeypatch.setattr(op, "LEARN_WORDS", 2)
    encode, texts = op.PrefixEncoder(PATH), [r[1] or "" for r in awkward_rows()]
    for _ in range(2):
        assert [encode([t])[0] for t in texts] == [library(t)[0] for t in texts]


def test_ids_that_spell_no_text():
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 6))]
        assert op.decode(np.asarray(ids, "<u4").tobytes(), BYTES) == TOK.decode(ids, skip_special_tokens=False)


def test_tables(spark, monkeypatch):
    rows = awkward_rows()
    got = op.bpe_decode(op.bpe_encode(documents(spark, rows)))
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = [(r[0], *library(r[1] or "")) for r in rows]
    assert sorted(((r[0], bytes(r[1]), r[2]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    together = op.bpe_encode(documents(spark, rows), decoded=True)
    assert together.columns == got.columns and sorted(map(str, together.collect())) == sorted(map(str, got.collect()))
    empty = op.bpe_decode(op.bpe_encode(documents(spark, [])))
    assert empty.columns == got.columns and empty.count() == 0


def test_query(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    got = E.queries()["op11_bpe_coding"](spark, sf).collect()
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for doc_id, text in texts:
        ids, decoded = library(text or "")
        want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
