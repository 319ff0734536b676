import numpy as np
import pytest

from kindred.llm import media, webp


def picture(h, w, colours=256, seed=0):
    r = np.random.default_rng(seed)
    x = r.integers(0, colours, (h, w, 4), np.uint8)
    x[h // 2 :] = x[: h - h // 2]  # something to refer back to
    return x


@pytest.mark.parametrize("shape", [(1, 1), (1, 7), (9, 1), (13, 21), (40, 16)])
def test_literals(shape):
    x = picture(*shape)
    assert (webp.decode(webp.encode(x)) == x).all()


@pytest.mark.parametrize("transforms", [(2,), (0,), (1,), (2, 0), (0, 1, 2), (1, 0)])
@pytest.mark.parametrize("references, cache", [(False, 0), (True, 0), (False, 6), (True, 10)])
def test_transforms(transforms, references, cache):
    x = picture(19, 23, 8, 3)
    modes = np.random.default_rng(1).integers(0, 14, (5, 6))
    assert (webp.decode(webp.encode(x, transforms, modes=modes, references=references, cache_bits=cache)) == x).all()


@pytest.mark.parametrize("mode", range(14))
def test_every_predictor(mode):
    x = picture(9, 11, 256, mode)
    assert (webp.decode(webp.encode(x, (0,), modes=mode)) == x).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 9, 16, 17, 200])
def test_palettes(colours):
    r = np.random.default_rng(colours)
    table = r.integers(0, 256, (colours, 4), np.uint8)
    x = table[r.integers(0, colours, (10, 13))]
    for more in ({}, {"references": True, "cache_bits": 3}):
        assert (webp.decode(webp.encode(x, (3,), **more)) == x).all()


def test_known_bytes():
    """A file put together by hand: one opaque pixel of red 1, green 2, blue 3, each a code of one symbol."""
    bits = "0" * 14 + "0" * 14 + "1" + "000" + "0" + "0" + "0"
    for value in (2, 1, 3, 255, 0):
        bits += "1" + "0" + "1" + f"{value:08b}"[::-1]
    body = b"\x2f" + bytes(int(bits[i : i + 8][::-1].zfill(8), 2) for i in range(0, len(bits), 8))
    data = b"RIFF" + (len(body) + 12).to_bytes(4, "little") + b"WEBPVP8L" + len(body).to_bytes(4, "little") + body
    assert webp.decode(data).tolist() == [[[1, 2, 3, 255]]]


@pytest.mark.parametrize("text", ["", "a", "x" * 64, "né " * 500, "word " * 300_000, "".join(map(chr, range(1, 200))) * 3, "ab\n" * 40, "".join(chr(32 + i % 90) * (i % 7) for i in range(900))])
def test_payload_round_trip(text):
    n, data = media.payload(text)
    got = media.back(media.read(media.store(data))).tobytes()
    assert got == data and len(data) % 64 == 0 and len(data) > 0 and data[:n] == text.encode()
