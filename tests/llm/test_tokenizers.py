"""Token counts and the SentencePiece codec against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm import queries
from sensorlake.llm.pieces import joinable, processor, proven, segment_pattern
from sensorlake.llm.sentencepiece_codec import Codec, encode_decode
from sensorlake.llm.token_counts import count_tokens, encode_resynchronised


PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab \n▁é😀中\x00\x07,.#<0x>  ퟿\U0010ffffĊ\t\r"


def random_texts(n, most, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


LONG = ["a" * 70_000, "ab" * 20_000 + " x" * 20_000, "\n" * 40_000, " " * 40_000, "中" * 15_000, "word, " * 9_000 + "q" * 3_000 + " end" * 5_000]


def test_a_proven_boundary_splits_the_encoding():
    sp = processor(PATH)
    for text in random_texts(300, 30):
        data = text.encode()
        for at in range(1, len(data)):
            if data[at] & 0xC0 != 0x80 and proven(PATH, data, at) and data[at : at + 1] != b" " and data[at : at + 3] != "▁".encode():
                # Behind a line feed, which nothing joins, the right part is encoded as in the text.
                left, right = data[:at].decode(), data[at:].decode()
                assert sp.encode(left) + sp.encode("\n" + right)[2:] == sp.encode(text)
                break


def test_segments_end_at_proven_boundaries():
    pattern = segment_pattern(PATH)
    for text in random_texts(300, 40):
        text = text.replace("▁", " ")
        parts = pattern.findall(text)
        assert "".join(parts) == text
        for a, b in zip(parts, parts[1:]):
            assert (a[-1] + b[0]).replace(" ", "▁") not in joinable(PATH)


@pytest.mark.parametrize("window,overlap", [(12, 4), (20, 5), (64, 8)])
def test_resynchronised_windows_give_the_library_ids(window, overlap):
    sp = processor(PATH)
    for text in random_texts(800, 120):
        got = [i for part, _ in encode_resynchronised(PATH, text.encode(), window, overlap) for i in part.tolist()]
        assert got == sp.encode(text)


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_long_texts(text):
    expected = processor(PATH).encode(text)
    parts = list(encode_resynchronised(PATH, text.encode()))
    assert [i for part, _ in parts for i in part.tolist()] == expected
    own = Codec(PATH)
    ids = own.encode(text)
    own.check()
    assert ids.tolist() == expected and own.decode(ids) == processor(PATH).decode(expected)


def test_an_overlap_without_a_boundary_is_widened():
    parts = list(encode_resynchronised(PATH, ("ab" * 20_000 + " x" * 20_000).encode()))
    assert len(parts) > 1 and sum(again for _, again in parts) > 0


def test_codec_on_random_texts():
    own, sp = Codec(PATH), processor(PATH)
    for text in random_texts(2000, 40, seed=2):
        ids = own.encode(text)
        assert ids.tolist() == sp.encode(text) and own.decode(ids) == sp.decode(ids.tolist())
    own.check()


def test_codec_check_finds_a_wrong_segment():
    own = Codec(PATH)
    own.unchecked = [("word", [5])]
    with pytest.raises(RuntimeError):
        own.check()


def test_forgotten_segments_are_encoded_anew(monkeypatch):
    import sensorlake.llm.sentencepiece_codec as module

    monkeypatch.setattr(module, "REMEMBERED", 3)
    own, sp = Codec(PATH), processor(PATH)
    text = " ".join(f"w{i % 11}" for i in range(100))
    assert own.encode(text).tolist() == sp.encode(text) and len(own.young) <= 3


def test_operators_on_nulls_repeats_and_clashing_columns(docs):
    rows = [(1, None), (2, ""), (3, "two words"), (3, "two words"), (None, "x"), (4, LONG[1])]
    frame = docs(rows, n_tokens=F.lit("mine"), token_ids=F.lit(0), batch=F.lit("kept"))
    sp = processor(PATH)
    counted = count_tokens(frame, PATH).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counted) == sorted((str(i), len(sp.encode(t or ""))) for i, t in rows)
    assert all(r["batch"] == "kept" for r in counted) and "text" not in counted[0]
    coded = encode_decode(frame, PATH).collect()
    assert sorted((str(r["doc_id"]), r["token_ids"], r["decoded"]) for r in coded) == sorted(
        (str(i), sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in rows
    )


def test_empty_tables(docs):
    assert count_tokens(docs([]), PATH).count() == 0 and encode_decode(docs([]), PATH).count() == 0


def test_queries_match_the_library(spark, sample):
    sp = processor(PATH)
    ids = {i: sp.encode(t or "") for i, t, _ in sample}
    text = {i: t or "" for i, t, _ in sample}
    for r in queries.op1_token_counts(spark, SF).collect():
        n = len(ids[r["doc_id"]])
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text[r["doc_id"]].encode()), n > 4096)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = queries.op7_sentencepiece(spark, SF).collect()
    assert len(rows) == len(sample)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["n_tokens"] == len(own) and r["ids_sha256"] == hexed(",".join(map(str, own))) and r["decoded_sha256"] == hexed(sp.decode(own))


def test_only_merge_type_vocabularies(monkeypatch):
    import sensorlake.llm.sentencepiece_codec as module

    class Bare:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a"

        def get_score(self, i):
            return 0.0

        is_unknown = is_control = is_byte = is_unused = lambda self, i: False

    monkeypatch.setattr(module, "processor", lambda path: Bare())
    with pytest.raises(ValueError):
        Codec("none")


def test_ids_are_int32():
    assert Codec(PATH).encode("a b").dtype == np.int32
