"""Packing: the library's ids come back out of the sequences, each once, and little is padded."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm.byte_bpe import ByteBpe, byte_bpe, stretches
from sensorlake.llm.packing import CONTEXTS, Packer, Piece, Shelf, pack, pack_rest, pack_tiers, step_groups
from sensorlake.llm.queries import op11_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tok = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def padding(sequences):
    """Padded positions over all, by lengths of sequences: none at a power of two, else up to the longest context."""
    return sum(0 if n & (n - 1) == 0 else CONTEXTS[0] - n for n in sequences)


SIGNS = [
    "a", "é", "ñ", "ß", " ", "  ", "\n", "\t", "\r\n", "\x00", "\x1c", "\x85", "\xa0", " ", ",", ".", "'", "'s", "'t", "'ll", "!", "1", "٣", "中", "ǆ", "ª",
    "<|endoftext|>", "<|endo", "日本", "́", "🙂", "ࡰ", "Ᲊ", "word", " The", "I'm", "\x0b", "_", "-", "　",
]


def test_ids_are_the_librarys(library):
    bpe, rng = byte_bpe(PATH), random.Random(6)
    for _ in range(8000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 12)))
        assert bpe.encode(text).tolist() == library(text), text
    for text in (" " * 900_000, "ab1 " * 200_000, "é" * 300_000, "x" * 100 + "\n " * 300_000):
        assert bpe.encode(text).tolist() == library(text)


def test_stretches_keep_the_text():
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice(SIGNS) for _ in range(60))
        for most in (1, 7, 1000):
            assert "".join(stretches(text, most)) == text


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        ByteBpe(public_tokenizers.path("word_bpe_49k.json"))


def pieces_of(lengths):
    shelf = Shelf()
    for i, n in enumerate(lengths):
        shelf.put(Piece(i, 0, n, np.arange(n, dtype=np.uint32)))
    return shelf


@pytest.mark.parametrize("seed", range(5))
def test_tiers_fill_every_window(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 2047), rng.randint(1, 130), rng.randint(1, 9), 512]) for _ in range(rng.choice([0, 1, 3, 400]))]
    full, rest = pack_tiers(pieces_of(lengths))
    assert all(c in CONTEXTS and sum(len(p.ids) for p in ps) == c for c, ps in full)
    left = pack_rest(rest)
    assert sum(sum(len(p.ids) for p in ps) < c for c, ps in left) <= 1
    assert sum(len(p.ids) for p in rest) < CONTEXTS[0]
    whole = defaultdict(list)
    for _, ps in full + left:
        for p in ps:
            whole[p.ident].append((p.start, p.ids))
    for i, n in enumerate(lengths):
        assert np.concatenate([ids for _, ids in sorted(whole[i], key=lambda x: x[0])]).tolist() == list(range(n))


def test_long_windows_are_filled_from_shorter_tiers():
    full, rest = pack_tiers(pieces_of([1500, 300, 200, 48, 1100, 900, 24, 24]))
    assert not rest and sorted([len(p.ids) for p in ps] for _, ps in full) == [[1100, 900, 24, 24], [1500, 300, 200, 48]]


def test_steps_are_balanced():
    rng = random.Random(1)
    sequences = [(rng.choice(CONTEXTS), []) for _ in range(900)]
    load = defaultdict(int)
    for (c, _), g in zip(sequences, step_groups(sequences, 20_000)):
        load[g] += c
    assert len(load) == round(sum(c for c, _ in sequences) / 20_000) and max(load.values()) - min(load.values()) <= CONTEXTS[0]
    assert step_groups([]) == []


def test_a_pool_leaves_less_than_a_window():
    packer, rows = Packer(3, CONTEXTS, 1 << 14), []
    for i in range(50):
        packer.add(i, np.arange(997 + 61 * i, dtype=np.uint32))
        if i % 9 == 0:
            rows += packer.flush()
    rows += packer.flush()
    left = list(packer.end())
    assert sum(r[2] for r in left) < CONTEXTS[0] and all(r[8] for r in left) and not any(r[8] for r in rows)
    assert sum(r[2] for r in rows + left) == sum(997 + 61 * i for i in range(50))


def check(rows, texts, library, most_padding):
    """Every id of every text in one piece, sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= CONTEXTS[0]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for ident, text in texts:
        want[ident].append([*library(text), 1])
    assert set(by_doc) == set(want)
    for ident, wanted in want.items():
        assert {r["doc_tokens"] for r in by_doc[ident]} == {len(w) for w in wanted}
        if len(wanted) == 1:
            own = sorted(by_doc[ident], key=lambda r: r["start"])
            assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
            assert np.frombuffer(b"".join(r["ids"] for r in own), "<u4").tolist() == wanted[0]
        assert sum(r["length"] for r in by_doc[ident]) == sum(map(len, wanted))
    lengths = []
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert len({(r["context"], r["step"]) for r in own}) == 1
        lengths.append(sum(r["length"] for r in own))
        assert lengths[-1] <= own[0]["context"]
    assert padding(lengths) <= most_padding


CASES = [(1, "a b c"), (2, None), (3, ""), (4, "long text, " * 3000), (5, "x" * 9000), (6, "<|endoftext|> é"), (None, "nobody"), (7, "twice"), (7, "twice"), (8, "q " * 2047)]


@pytest.mark.parametrize("pool", [1, 5000, 1 << 21])
def test_rows(spark, docs, library, pool):  # noqa: F811
    frame = docs(CASES, **{c: F.lit("x") for c in ("ident", "ids", "open", "start", "sequence_id", "bucket")})
    check(pack(frame, PATH, pool=pool).collect(), CASES, library, CONTEXTS[0] - 1)
    assert pack(frame.filter(F.lit(False)), PATH).collect() == []


def test_column_names_and_contexts(spark, docs):  # noqa: F811
    for wrong in ({"contexts": (2048, 1000)}, {"columns": {"length": F.crc32}}):
        with pytest.raises(ValueError):
            pack(docs(CASES), PATH, **wrong)


def test_query_on_the_given_table(spark, sample, library):  # noqa: F811
    frame = spark.read.parquet(f"{SF}/documents.parquet").repartition(6)
    check(pack(frame, PATH).collect(), [(i, t) for i, t, _ in sample], library, CONTEXTS[0] - 1)
    rows = op11_packing(spark, SF).collect()
    ids = {i: np.array([*library(t), 1], "<u4") for i, t, _ in sample}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
