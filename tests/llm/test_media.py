import hashlib
import io
import zlib

import numpy as np
import pytest

from tickloom.llm import media as M


def test_round_trips_of_both_formats():
    a = np.random.default_rng(0).integers(0, 256, (5, 7, 3), dtype=np.uint8)
    assert (M.decode(M.encode_pnm(a)) == a).all() and (M.decode(M.encode_bmp(a)) == a).all()
    assert (M.decode(M.encode_pnm(a[:, :, 0])) == a[:, :, 0]).all()


def test_other_netpbm_kinds():
    assert M.decode(b"P1\n# c\n3 1\n1 0 1\n").tolist() == [[0, 255, 0]]
    assert M.decode(b"P2 2 1 15 15 0").tolist() == [[255, 0]]
    assert M.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert M.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert M.decode(b"P5 1 1 65535\n\xff\xff").tolist() == [[255]]
    for bad in (b"", b"P6 9 9 255\nx", b"GIF89a"):
        with pytest.raises(ValueError):
            M.decode(bad)


def brute_resize(a, h, w):
    big = np.repeat(np.repeat(a.astype(float), h, 0), w, 1)
    return big.reshape(h, a.shape[0], w, a.shape[1]).mean(axis=(1, 3))


@pytest.mark.parametrize("shape", [(1, 64), (5, 3), (16, 16), (33, 64), (9, 1)])
def test_area_resize_is_exact(shape):
    a = np.random.default_rng(1).integers(0, 256, shape, dtype=np.uint8)
    for h, w in ((8, 9), (16, 16), (1, 1)):
        np.testing.assert_allclose(M.area_resize(a, h, w), brute_resize(a, h, w), atol=1e-9)


def test_documents_as_media(spark):
    texts = [None, "", "a", "a", "é" * 96, "x" * 193, "long \n" * 100000]
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    for form in ("pnm", "bmp"):
        got = {r.doc_id: r for r in M.documents_as_media(df, form=form).collect()}
        for i, t in enumerate(texts):
            raw = (t or "").encode()
            p = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
            r = got[i]
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
            assert np.load(io.BytesIO(r.tile)).shape == (16, 16) and len(r.feature) == 16
        assert got[0][1:] == got[1][1:] and got[2][1:] == got[3][1:]


def test_unreadable_and_empty(spark):
    df = spark.createDataFrame([(1, bytearray(b"junk")), (2, None)], "doc_id long, media binary")
    assert [r.feature for r in M.read_media(df).collect()] == [None, None]
    assert M.documents_as_media(spark.createDataFrame([], "doc_id long, text string")).count() == 0
