import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import awkward_rows, documents
from tickwise.llm import best_fit_packing as op

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def brute_pieces(rows, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.asarray(ids[at:at + capacity], "<u4")
            out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pieces_and_places(spark, capacity):
    rows = awkward_rows()
    got = op.best_fit_packing(documents(spark, rows), capacity=capacity)
    assert got.columns == COLUMNS
    got = got.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_pieces(rows, capacity)
    sequences = check_places(got, capacity)
    assert sequences <= 1.25 * sum(r.length for r in got) / capacity + 1


def test_empty_table(spark):
    got = op.best_fit_packing(documents(spark, []))
    assert got.columns == COLUMNS and got.count() == 0


def places_of(plan, counts):
    """Every piece's (sequence, offset, length) of a plan."""
    got = {n: 0 for n in counts}
    out = []
    for length, first_rank, pieces, first, per, offset in sorted(plan):
        assert first_rank == got[length]
        got[length] += pieces
        out += [(first + k // per, offset + k % per * length, length) for k in range(pieces)]
    assert got == counts
    return out


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece_once(counts):
    filled = {}
    for sequence, offset, length in places_of(op.packing_plan(counts, 60), counts):
        filled.setdefault(sequence, []).append((offset, length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 60
    large = {n: c for n, c in counts.items() if 3 * n > 60}
    # greedy matching: as many pairs as any matching of the large pieces
    lengths, pairs = sorted((n for n, c in large.items() for _ in range(c)), reverse=True), 0
    while len(lengths) > 1:
        if lengths[0] + lengths[-1] <= 60:
            lengths.pop()
            pairs += 1
        lengths.pop(0)
    used = len({s for s, _, n in places_of(op.packing_plan(large, 60), large)}) if large else 0
    assert used == sum(large.values()) - pairs


def test_hot_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "GROUP_ROWS", 3)
    rows = [(i, "one two three", "en", "a") for i in range(200)]
    got = op.best_fit_packing(documents(spark, rows), capacity=16).collect()
    assert len(got) == 200 and check_places(got, 16) == 50


def test_words_and_marks_without_the_whole_tokenizer(monkeypatch):
    encode = op.WordEncoder(op.default_tokenizer())
    latin = [chr(c) for c in range(0xA0, 0x180)]
    marks = [m for m in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
    words = (["Haus", "ÉTÉ", "straße", "ñandú,", "end.", "end...", "Ende?!", "x$$$", "END.", "it's", "we'll,", "a<|endoftext|>",
              "<|startoftext|>", "b|>", "e\u0301t\u00e9.", "ÿ", "Ÿ", "µm", "ªº", "a×b", "a1.", "...", ".a", "İ.", "ſ,"]
             + ["Wort" + m for m in marks] + ["wört" + m + n for m in marks for n in marks[::5]]
             + ["A" + c + "b." for c in latin] + latin)
    whole = [np.asarray(encode.tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert encode(words) == whole
    assert op.WordEncoder(op.default_tokenizer())([" ".join(words)]) == [
        np.asarray(encode.tok.encode(" ".join(words), add_special_tokens=False).ids, "<u4").tobytes()]
    plain = op.WordEncoder(op.default_tokenizer())
    monkeypatch.setattr(plain, "_learn", lambda words: pytest.fail(f"encoded as other text: {words}"))
    plain(["Plain words, ÉTÉ and straße... (end) ###".replace("(", "").replace(" ###", "###")])
