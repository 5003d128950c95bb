import zlib

import numpy as np
import pyarrow as pa
import pytest

from ecoledger.llm import packing, tokenfiles, tokens
from ecoledger.llm.common import texts_of

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

ODD = [
    "", " ", "a  b", "x \ny", "\n\na", "foo.\nBar baz", "a\n\nb", "Ünïcode x y", "it's we'll 12 345", "ΣΑΣ ς", "İstanbul",
    "éa", "\x1cq r", "<|endoftext|> a", "a\tb", "tail ", "ﬁ", "日本 語", "a.\n.b", "a.b c,d", "...", "foo.. bar!", " a b",
    "word " * 3000,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_whole(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)  # generations change while texts are encoded
    whole, pieces = tokenizers.Tokenizer.from_file(P.path(name)), tokens.Encoder(P.path(name))
    mixed = ODD + [f"{a} {b}" for a in ODD[:20] for b in ODD[:20]]
    for text in mixed:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, pieces.dtype).tobytes()
        assert pieces.encode(text) == want, text
    assert pieces.encode(None) == b""


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_an_encoder_keeps_no_more_pieces_than_told(name):
    text = " ".join(f"w{k} x{k % 40}" for k in range(3000))
    few, many = tokens.Encoder(P.path(name), 50), tokens.Encoder(P.path(name))
    assert few.encode(text) == many.encode(text)
    assert all(len(held) <= 50 for p in (few.first, few.spaced) for held in (p, p.older)) and len(many.spaced) > 3000


def test_token_files_round_trip(spark, make_docs, tmp_path):
    texts = [*ODD, None]
    docs = make_docs(*[(k * 7 % 31, t) for k, t in enumerate(texts)], (None, "no id"), (3, "again"), at="1", shard="2")
    manifest = tokenfiles.write_ids(docs, str(tmp_path / "t"), P.path("byte_bpe_50k.json"), 2)
    index = tokenfiles.write_index(manifest, str(tmp_path / "t"))
    got = tokenfiles.digests(tokenfiles.read_ids(manifest, index), manifest).collect()
    whole = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))

    def ids(text):
        return np.array((whole.encode(text, add_special_tokens=False).ids if text else []) + [2], "<u4")

    want = sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(ids(r.text).tobytes()), len(ids(r.text))) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32, r.n_tokens) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]


def test_foreign_keys_are_refused(spark, make_docs, tmp_path):
    docs = make_docs(*[(k, f"text {k}") for k in range(500)])
    manifest = tokenfiles.write_ids(docs, str(tmp_path / "t"), P.path("byte_bpe_50k.json"), 2)
    index = tokenfiles.write_index(manifest, str(tmp_path / "t"))
    asked = spark.range(400, 1000).selectExpr("id AS doc_id", "0L AS repeat")
    assert {r.doc_id for r in tokenfiles.read_ids(asked, index).collect()} == set(range(400, 500))


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    found, slots = tokenfiles.perfect_hash(h1, h2)
    assert sorted(slots) == list(range(n))
    assert (tokenfiles.locate(h1, h2, found, n) == slots).all()


def test_no_documents(spark, make_docs, tmp_path):
    docs = make_docs((1, "x")).limit(0)
    manifest = tokenfiles.write_ids(docs, str(tmp_path / "t"), P.path("byte_bpe_50k.json"), 2)
    index = tokenfiles.write_index(manifest, str(tmp_path / "t"))
    assert tokenfiles.digests(tokenfiles.read_ids(manifest, index), manifest).count() == 0
    pieces = packing.token_pieces(docs, P.path("word_bpe_49k.json"), 0, 16)
    assert packing.pack(pieces, 16).count() == 0


def test_lower_bound_holds_and_is_met():
    assert packing.lower_bound(np.array([6]), np.array([3]), 10) == 3
    assert packing.lower_bound(np.array([5, 4]), np.array([2, 2]), 10) == 2
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 30, rng.integers(1, 60))
        bins, offsets, room = packing.best_fit_decreasing(lengths, 30)
        used = np.bincount(bins, lengths)
        assert used.max() <= 30 and (30 - used == room).all()
        assert packing.lower_bound(*np.unique(lengths, return_counts=True), 30) <= len(room)
        for b in range(len(room)):
            at = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
            assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))]


def test_packing_covers_every_piece(spark, make_docs, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PARTITION", 20)
    docs = make_docs(*[(k % 40, "w " * (k * 13 % 70)) for k in range(90)], (None, None), length="7", bin="1")
    pieces = packing.token_pieces(docs, P.path("word_bpe_49k.json"), 0, 16)
    rows = packing.pack(pieces, 16).collect()
    assert len(rows) == pieces.count() and sum(r.length for r in rows) == sum(k * 13 % 70 + 1 for k in range(90)) + 1
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in groups.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))]
        assert sum(n for _, n in placed) <= 16
    bound = -(-sum(r.length for r in rows) // 16)
    assert bound <= len(groups) <= bound + 3


def test_texts_are_made_a_few_at_a_time():
    given = [*ODD, None]
    column = pa.array(["before", *given, "behind"]).slice(1, len(given))
    assert list(texts_of(column, at_once=4)) == list(texts_of(column)) == given
