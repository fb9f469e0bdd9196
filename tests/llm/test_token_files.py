import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockledger.llm import rans, tokens
from stockledger.llm.packing import hilbert_keys, pack, packed_pieces
from stockledger.llm.queries import tokenizer_path
from stockledger.llm.token_files import read_token_files, round_trip, write_token_files
from stockledger.llm.tokens import Encoder
from stockledger.llm.words import words
from tests.llm.rows import clashing, colliding_words, documents, edge_texts

PATH = tokenizer_path()
TRICKY = [
    "", " ", "\n", "\n\n", "  a  b", "a\n b", "a  b\t c   d", "x <|endoftext|> y", " a b ", "a   b",
    "don't I'll 'ere ’s x.", "é.à ß, ñ", "a\x1cb \x1c c", "٣ ٤٥ a٣.", "a\n", "\na", "a\n\nb", "a.\n\n b ",
    "a .b,c;d ...e!? f.'s g.", "foo…. bar’. x\r\ny\r\n\r\nz", "x\n\ty", " \n \n", "'s 's", "a\n'll b", "q\x0b.r",
]


@pytest.fixture(scope="module")
def coder():
    return Encoder(PATH)


def whole(coder, text):
    return coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_stretches_give_the_ids_of_whole_texts(coder):
    found = coder.encode(TRICKY)
    assert [np.frombuffer(x, coder.dtype).tolist() for x in found] == [whole(coder, t) for t in TRICKY]


def test_ids_are_those_of_the_plain_call(coder):
    plain = Tokenizer.from_file(PATH)
    texts = [*TRICKY, "<|endoftext|>", "a<|endoftext|>\n<|endoftext|> b.", "<|endoftext| >"]
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)] == wanted
    assert 50256 in wanted[TRICKY.index("x <|endoftext|> y")]


def test_words_that_collide_modulo_a_power_of_two(spark, coder):
    x, y = colliding_words()
    hashes, _ = words([x, y])
    assert hashes[0] != hashes[1]
    texts = [x, y, f"{x} {y}", f"{y} {x}", "end"]
    assert [np.frombuffer(b, coder.dtype).tolist() for b in coder.encode(texts)] == [whole(coder, t) for t in texts]
    found = sorted(map(tuple, round_trip(documents(spark, list(enumerate(texts))), PATH).collect()))
    start = 0
    for (doc_id, at, n, crc), text in zip(found, texts, strict=True):
        ids = np.array([*whole(coder, text), 0], "<u4")
        assert (at, n, crc) == (start, len(ids), zlib.crc32(ids.tobytes())), doc_id
        start += len(ids)


def test_stretches_that_share_a_hash_go_whole(monkeypatch):
    texts = ["one two three", "two one three", "", "three"]
    monkeypatch.setattr(tokens, "stretch_hashes", lambda codes, starts, ends: (ends - starts).astype(np.uint64))
    coder = Encoder(PATH)
    assert [np.frombuffer(b, coder.dtype).tolist() for b in coder.encode(texts)] == [whole(coder, t) for t in texts]


def test_files_hold_the_ids_of_the_plain_call(spark):
    plain = Tokenizer.from_file(PATH)
    rows = [(1, "x <|endoftext|> y"), (2, "z")]
    ids = [[*plain.encode(t, add_special_tokens=False).ids, 0] for _, t in rows]
    wanted = [(1, 0, len(ids[0]), zlib.crc32(np.array(ids[0], "<u4").tobytes())),
              (2, len(ids[0]), len(ids[1]), zlib.crc32(np.array(ids[1], "<u4").tobytes()))]
    assert sorted(tuple(r) for r in round_trip(documents(spark, rows), PATH).collect()) == wanted


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t.,!'abé  19s\r", max_size=12), max_size=4))
def test_any_text(coder, texts):
    found = coder.encode(texts, 7)
    assert [np.frombuffer(x, coder.dtype).tolist() for x in found] == [[*whole(coder, t), 7] for t in texts]


def test_forgetting_changes_nothing(coder, monkeypatch):
    monkeypatch.setattr("stockledger.llm.tokens.REMEMBERED", 3)
    for _ in range(2):
        for text in TRICKY:
            assert np.frombuffer(coder.encode([text])[0], coder.dtype).tolist() == whole(coder, text)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 1000, 70_001])
def test_blocks_come_back(n):
    drawn = np.random.default_rng(n)
    ids = (drawn.zipf(1.3, n) % 50_257).astype(np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=50_257))
    block = rans.encode(ids, table, lanes=64, every=16)
    assert (rans.decode(block, table) == ids).all()
    for point in range(1, rans.HEAD.unpack_from(block)[3] + 1):
        rest = rans.decode(block, table, point)
        assert len(rest) < n and (rest == ids[n - len(rest) :]).all()


def test_one_id_and_damage():
    ids = np.zeros(5000, np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=10))
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    with pytest.raises(ValueError):
        rans.decode(block[:40] + bytes([block[40] ^ 1]) + block[41:], table)


def expected(rows, end):
    coder = Encoder(PATH)
    return sorted((i is not None, i or 0, [*whole(coder, t or ""), end]) for i, t in rows)


def test_round_trip(spark):
    rows = edge_texts()
    at, wanted = 0, []
    for known, i, ids in expected(rows, 0):
        wanted.append((i if known else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = [tuple(r) for r in round_trip(clashing(documents(spark)), PATH).collect()]
    assert sorted(found, key=lambda r: r[1]) == wanted


def test_blocks_end_with_documents(spark, tmp_path):
    rows = [(i, "word " * (i % 7)) for i in range(300)]
    path = str(tmp_path / "files")
    write_token_files(documents(spark, rows).repartition(3), PATH, path, block_ids=100)
    assert spark.read.parquet(f"{path}/blocks").count() > 5
    found = read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == list(range(300))
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in found)


def test_empty_tables(spark):
    assert round_trip(documents(spark, []), PATH).collect() == []
    assert pack(documents(spark, []), PATH).collect() == []


def test_pieces_hold_every_id_once(spark):
    rows = edge_texts()
    length = 64
    pieces = pack(clashing(documents(spark)).repartition(4), PATH, length=length).collect()
    by_place = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    for (s, o, n), (t, q, _) in zip(by_place, by_place[1:]):
        assert (t, q) == ((s, o + n) if o + n < length else (s + 1, 0))
    assert by_place[0][:2] == (0, 0) and all(o + n <= length for _, o, n in by_place)
    documents_found: dict = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"]
        documents_found.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids))
    found = []
    for (doc_id, total), parts in documents_found.items():
        copies = sum(start == 0 for start, _ in parts)
        joined = [x for _, ids in sorted(parts)[:: copies] for x in ids]
        assert len(joined) == total
        found += [(doc_id is not None, doc_id or 0, joined)] * copies
    assert sorted(found) == expected(rows, 1)


def test_neighbours_on_the_curve(spark):
    rows = [(2 * i + k, f"{'alpha beta gamma' if k else 'uno dos tres'} {i} " * 50) for i in range(20) for k in (0, 1)]
    pieces = packed_pieces(documents(spark, rows), PATH).orderBy("sequence_id", "offset").collect()
    kinds = [p["doc_id"] % 2 for p in pieces if p["start"] == 0]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) < 10


def test_hilbert_curve_steps_to_neighbours():
    side, axes = 8, 3
    points = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), -1).reshape(-1, axes)
    keys = hilbert_keys(points, 3)
    assert sorted(keys.tolist()) == list(range(side**axes))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()
