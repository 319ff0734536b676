"""Files put together bit by bit from the format's description, with pixels worked out by hand: none of the encoder's code."""

import pytest

from kindred.llm import webp


def num(v, n):
    return f"{v:0{n}b}"[::-1] if n else ""


def one(s):
    """A code of one symbol."""
    return "1" + "0" + "1" + num(s, 8)


def two(a, b):
    """A code of two symbols; the lesser one is 0."""
    return "1" + "1" + "1" + num(a, 8) + num(b, 8)


def sparse(a, b, count):
    """A code of two symbols, of any size: lengths written with 18 (0), 1 (10) and 17 (11)."""

    def zeros(n):
        out = ""
        while n >= 11:
            k = min(n, 138)
            out, n = out + "0" + num(k - 11, 7), n - k
        assert n == 0 or n >= 3
        return out + ("11" + num(n - 3, 3) if n else "")

    return "0" + num(0, 4) + num(2, 3) + num(1, 3) + num(0, 3) + num(2, 3) + "0" + zeros(a) + "10" + zeros(b - a - 1) + "10" + zeros(count - b - 1)


def file(width, height, bits):
    bits = num(width - 1, 14) + num(height - 1, 14) + "1" + "000" + bits
    body = b"\x2f" + bytes(int(bits[i : i + 8][::-1].zfill(8), 2) for i in range(0, len(bits), 8))
    body += bytes(len(body) & 1)
    return b"RIFF" + (len(body) + 12).to_bytes(4, "little") + b"WEBPVP8L" + len(body).to_bytes(4, "little") + body


MAIN = "0" + "0" + "0"  # no more transforms, no cache, no groups


@pytest.mark.parametrize("mode, last", [(0, (250, 10)), (1, (14, 24)), (2, (14, 24)), (3, (8, 30)), (4, (4, 30)), (5, (12, 25)), (6, (9, 24)), (7, (14, 24)), (8, (9, 27)), (9, (11, 27)), (10, (10, 26)), (11, (14, 24)), (12, (24, 28)), (13, (19, 24))])
def test_predictor(mode, last):
    """Greens of two rows of three: 10, 20, 14 and 20, then as the mode says; rests are 10 and -6."""
    bits = "1" + num(0, 2) + num(0, 3) + "0" + one(mode) + one(0) + one(0) + one(255) + one(0)
    bits += MAIN + two(10, 250) + one(0) + one(0) + one(0) + one(0) + "001" + "010"
    out = webp.decode(file(3, 2, bits))
    assert out[..., 1].tolist() == [[10, 20, 14], [20, *last]]
    assert (out[..., 0] == 0).all() and (out[..., 3] == 255).all()


def test_cross_colour():
    """Green to red 3, green to blue -5, red to blue 7, in 32nds: 10 + 9, 20 - 16 + 4."""
    bits = "1" + num(1, 2) + num(0, 3) + "0" + one(251) + one(7) + one(3) + one(255) + one(0)
    assert webp.decode(file(1, 1, bits + MAIN + one(100) + one(10) + one(20) + one(255) + one(0))).tolist() == [[[19, 100, 8, 255]]]


def test_subtracted_green():
    assert webp.decode(file(1, 1, "1" + num(2, 2) + MAIN + one(100) + one(10) + one(200) + one(255) + one(0))).tolist() == [[[110, 100, 44, 255]]]


def test_palette():
    """Two colours, the second as the difference to the first; eight pixels in one."""
    bits = "1" + num(3, 2) + num(1, 8) + "0" + two(2, 20) + two(1, 10) + two(3, 30) + two(0, 255) + one(0) + "1111" + "0000"
    first, second = [10, 20, 30, 255], [11, 22, 33, 255]
    assert webp.decode(file(3, 1, bits + MAIN + one(0b101) + one(0) + one(0) + one(255) + one(0))).tolist() == [[second, first, second]]


def test_back_reference():
    """A pixel, then three more from one to the left, which is the second short distance."""
    bits = MAIN + sparse(7, 258, 280) + one(8) + one(9) + one(255) + one(1) + "0" + "1"
    assert webp.decode(file(4, 1, bits)).tolist() == [[[8, 7, 9, 255]] * 4]


def test_back_reference_to_the_row_above():
    """Two pixels, then two from a row above, the first short distance."""
    bits = MAIN + sparse(7, 257, 280) + two(8, 88) + one(9) + one(255) + one(0) + "00" + "01" + "1"
    assert webp.decode(file(2, 2, bits)).tolist() == [[[8, 7, 9, 255], [88, 7, 9, 255]]] * 2


def test_colour_cache():
    slot = lambda b: (0x1E35A7BD * (255 << 24 | 8 << 16 | 7 << 8 | b) & 0xFFFFFFFF) >> 31
    blue = next(b for b in range(256) if slot(b))
    bits = "0" + "1" + num(1, 4) + "0" + sparse(7, 281, 282) + one(8) + one(blue) + one(255) + one(0) + "0" + "1" + "1"
    assert webp.decode(file(3, 1, bits)).tolist() == [[[8, 7, blue, 255]] * 3]
