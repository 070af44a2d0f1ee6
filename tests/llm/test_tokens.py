import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from pricelake.llm import tokens as T
from pricelake.llm.common import run_folder

from .conftest import nasty_rows, rows_of


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(public_tokenizers.path(T.VOCABULARY))
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_encoder_is_the_library_on_whole_texts(whole):
    r = random.Random(6)
    bits = ["the", "The", "don't", "...", "é", "e\u0301", "H\u0331", "İ", "ΣΑΣ", "ſ", "ß", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c",
            "\x85", "\xa0", "\u2003", "\u200b", "1", "23", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "of.", "Of,", "ÉtÉ!", "ÀÞ", "µ", "×.", "a!'s", "b.###", "###c", "&'ll", "²!", "İ.", "\u0958.", "\u0958", "x\u0301.", ".", "_", "a.b,c", "3.14", "x_.", "\u00b4.", "\x1c.", "ªº", "中文", "😀", "'s", "'S", ",", "-", "\x00", "\u0301"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(4000)] + [t for _, t, *_ in nasty_rows()]
    e = T.Encoder()
    for t, got in zip(texts, e.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == whole(t), repr(t)


def test_held_words_are_bounded(monkeypatch, whole):
    monkeypatch.setattr(T, "HELD", 5)
    e = T.Encoder()
    for t in ("a b c d e f g", "h i j k l a b", "a b zebra"):
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == whole(t)
        assert len(e) < 20


def test_round_trip_of_nasty_rows(nasty, whole):
    got = rows_of(T.tokenized(nasty, shard_bytes=3000), "start")
    rows = nasty_rows()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids == [None] * ids.count(None) + sorted(i for i in ids if i is not None)
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    want = []
    for d, t, *_ in rows:
        x = np.asarray(whole(t) + [2], "<u4")
        want.append((d, len(x), zlib.crc32(x.tobytes())))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)


def test_only_wanted_documents_are_decompressed(spark, nasty, whole, monkeypatch):
    path = run_folder(spark, "test-tokens")
    T.write_shards(nasty, path, shard_bytes=3000)
    text = {d: t for d, t, *_ in nasty_rows()}
    got = {r["doc_id"]: r["token_ids"] for r in rows_of(T.read_documents(spark, path, [3, 108, 105, 99999]), "doc_id")}
    assert got == {d: whole(text[d]) + [2] for d in (3, 108, 105)}
    blob = bytes(T.shards(spark, path).first().content)
    r = T.ShardReader(blob)
    done = []
    monkeypatch.setattr(r, "frame", lambda i, f=r.frame: done.append(i) or f(i))
    r.document(1)
    assert done == [2]


def test_frames_are_the_seekable_format():
    import struct

    import xxhash
    import zstandard
    w = T.ShardWriter(3, 4)
    docs = [(7, b"\1\0\0\0"), (None, b"\2\0\0\0" * 5), (9, b"")]
    for d, ids in docs:
        w.add(d, ids)
    blob = w.close()
    n, flags, magic = struct.unpack("<IBI", blob[-9:])
    assert (n, flags, magic) == (4, 0x80, 0x8F92EAB1)
    skip, size = struct.unpack("<II", blob[-9 - 12 * n - 8:-9 - 12 * n])
    assert skip == 0x184D2A5E and size == 12 * n + 9
    at = 0
    for i in range(n):
        c, d, check = struct.unpack("<III", blob[-9 - 12 * (n - i):][:12])
        x = zstandard.ZstdDecompressor().decompress(blob[at:at + c], max_output_size=max(1, d))
        assert len(x) == d and xxhash.xxh64_intdigest(x) & 0xFFFFFFFF == check
        at += c
    r = T.ShardReader(blob)
    assert (r.part, r.seq, r.ids) == (3, 4, [7, None, 9]) and [r.frame(i + 1) for i in range(3)] == [x for _, x in docs]
    broken = bytearray(blob)
    broken[r.offsets[2] + 10] ^= 1
    with pytest.raises(Exception):
        T.ShardReader(bytes(broken)).document(1)


def test_empty_table(empty):
    assert T.tokenized(empty).count() == 0
