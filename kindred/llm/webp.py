"""Lossless WebP (VP8L) in numpy: a decoder of the whole format and an encoder of its parts.

Pixels are uint8 arrays of shape (height, width, 4) in the order red, green, blue, alpha.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS, GREEN, PALETTE = range(4)
#: Short distances stand for near pixels (x to the left, y up), nearest first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))
MULTIPLIER = 0x1E35A7BD


class Bits:
    """Reads bits, the least significant first."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data + bytes(8), at

    def read(self, n: int) -> int:
        v = self.peek() & ((1 << n) - 1)
        self.at += n
        return v

    def ahead(self, at: int, n: int) -> int:
        return int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7) & ((1 << n) - 1)

    def peek(self) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 8], "little") >> (self.at & 7)


@lru_cache(16)
def _reversed(n: int) -> np.ndarray:
    """Numbers of n bits with their bits reversed."""
    out = np.zeros(1, np.uint32)
    for _ in range(n):
        out = np.concatenate([out << np.uint32(1), out << np.uint32(1) | np.uint32(1)])
    return out


@lru_cache(256)
def table(size: bytes) -> tuple[int, np.ndarray, np.ndarray, int]:
    """Of a canonical code by its lengths: the longest, by that many coming bits the symbol and its length, and the
    greatest symbol."""
    of = np.frombuffer(size, np.uint8)
    used = np.flatnonzero(of)
    if len(used) <= 1:
        return 0, used[:1] if len(used) else np.zeros(1, np.int64), np.zeros(1, np.int64), int(used.max(initial=0))
    top = int(of.max())
    order = used[np.argsort(of[used], kind="stable")]
    times = 1 << (top - of[order].astype(np.int64))
    symbols, steps, back = np.zeros(1 << top, np.int64), np.zeros(1 << top, np.int64), _reversed(top)
    held = int(times.sum())
    symbols[back[:held]], steps[back[:held]] = np.repeat(order, times), np.repeat(of[order], times)
    return top, symbols, steps, int(used[-1])


def canonical(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By symbol its code, bits reversed as they are stored, and its length; a lone symbol takes no bits."""
    codes, used = np.zeros(len(size), np.uint32), np.flatnonzero(size)
    if len(used) <= 1:
        return codes, np.zeros(len(size), np.uint8)
    order = used[np.argsort(size[used], kind="stable")]
    n = size[order].astype(np.uint32)
    step = np.uint32(1) << (np.uint32(15) - n)
    codes[order] = _reversed(15)[np.cumsum(step) - step]
    return codes, size


def _symbol(bits: Bits, code: tuple) -> int:
    top, symbols, steps, _ = code
    i = bits.peek() & ((1 << top) - 1)
    bits.at += int(steps[i])
    return int(symbols[i])


def _code(bits: Bits, count: int) -> tuple:
    size = np.zeros(count, np.uint8)
    if bits.read(1):
        two = bits.read(1)
        found = [bits.read(8 if bits.read(1) else 1)] + ([bits.read(8)] if two else [])
        size[found] = 1
        return table(size.tobytes())
    own = np.zeros(19, np.uint8)
    for i in range(4 + bits.read(4)):
        own[LENGTH_ORDER[i]] = bits.read(3)
    top, symbols, steps, _ = table(own.tobytes())
    symbols, steps, mask = symbols.tolist(), steps.tolist(), (1 << top) - 1
    most = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else count
    coming, out, last, taken = bits.ahead(bits.at, 14 * count), [], 8, 0
    while len(out) < count and most:
        most -= 1
        s, n = symbols[coming & mask], steps[coming & mask]
        coming >>= n
        taken += n
        if s < 16:
            out.append(s)
            last = s or last
        else:
            least, n = ((3, 2), (3, 3), (11, 7))[s - 16]
            out += [last if s == 16 else 0] * (least + (coming & ((1 << n) - 1)))
            coming >>= n
            taken += n
    bits.at += taken
    size[: len(out)] = out[:count]
    return table(size.tobytes())


def _extra(bits: Bits, s: int) -> int:
    if s < 4:
        return s + 1
    n = (s - 2) >> 1
    return ((2 + (s & 1)) << n) + bits.read(n) + 1


def _image(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """An entropy-coded image as uint32 ARGB."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups, block, meta = 1, 0, None
    if top and bits.read(1):
        block = bits.read(3) + 2
        meta = (_image(bits, -(-width >> block), -(-height >> block), False) >> 8) & 0xFFFF
        groups = int(meta.max()) + 1
    cache = 1 << cache_bits if cache_bits else 0
    codes = [[_code(bits, 280 + cache), *(_code(bits, 256) for _ in range(3)), _code(bits, 40)] for _ in range(groups)]
    if groups == 1 and not cache and not any(c[0] for c in codes[0][1:4]):
        bytes_of = _one_channel if codes[0][0][3] > 255 else _literals
        r, b, a = (int(c[1][0]) for c in codes[0][1:4])
        green = np.frombuffer(bytes_of(bits, codes[0], width, width * height), np.uint8)
        return (green.astype(np.uint32) << 8 | np.uint32(a << 24 | r << 16 | b)).reshape(height, width)
    out, colours, at, total = [0] * (width * height), [0] * cache, 0, width * height
    while at < total:
        code = codes[int(meta[at // width >> block, at % width >> block])] if groups > 1 else codes[0]
        s = _symbol(bits, code[0])
        start = at
        if s < 256:
            r, b, a = (_symbol(bits, c) for c in code[1:4])
            out[at] = a << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < 280:
            n, d = _extra(bits, s - 256), _extra(bits, _symbol(bits, code[4]))
            d = d - 120 if d > 120 else max(1, NEAR[d - 1][0] + NEAR[d - 1][1] * width)
            for at in range(at, min(at + n, total)):
                out[at] = out[at - d]
            at += 1
        else:
            out[at] = colours[s - 280]
            at += 1
        if cache:
            for v in out[start:at]:
                colours[(MULTIPLIER * v & 0xFFFFFFFF) >> (32 - cache_bits)] = v
    return np.array(out, np.uint32).reshape(height, width)


#: Of a length or distance by its prefix symbol: extra bits, and what these add to.
EXTRA = np.array([0 if s < 4 else (s - 2) >> 1 for s in range(40)], np.int64)
LEAST = np.array([s + 1 if s < 4 else ((2 + (s & 1)) << ((s - 2) >> 1)) + 1 for s in range(40)], np.int64)


def _literals(bits: Bits, codes: list[tuple], width: int, count: int) -> bytes:
    """Green alone, without references, all at once: from each bit the place of the next symbol, by doubling that of the
    8th, then a walk in strides of 8 and the places between."""
    top, symbols, steps, _ = codes[0]
    first = bits.at >> 3
    raw = np.frombuffer(bits.data, np.uint8)[first:].astype(np.uint32)
    word = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    coming = ((word[:, None] >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << top) - 1)).ravel().astype(np.int64)
    strides = [steps.take(coming) + np.arange(len(coming))]
    for _ in range(3):
        strides.append(strides[-1].take(strides[-1], mode="clip"))
    at, walk, far = bits.at - 8 * first, [], strides.pop()
    for _ in range(-(-count // 8)):
        walk.append(at)
        at = far.item(at)
    p = np.array(walk, np.int64)
    for move in reversed(strides):
        p = np.stack([p, move.take(p, mode="clip")], axis=1).ravel()
    p = p[:count]
    if count:
        bits.at = 8 * first + int(strides[0][p[-1]])
    return symbols.take(coming.take(p)).astype(np.uint8).tobytes()


def _one_channel(bits: Bits, codes: list[tuple], width: int, count: int) -> bytes:
    """As ``_image``, where red, blue and alpha are the same everywhere and take no bits: green alone."""
    # symbol and step in one number
    own, their = ((c[1] << 4 | c[2]).tolist() for c in (codes[0], codes[4]))
    mask, far = (1 << codes[0][0]) - 1, (1 << codes[4][0]) - 1
    at, first = bits.at & 7, bits.at >> 3
    raw = np.frombuffer(bits.data, np.uint8)[first:].astype(np.uint32)
    word = (raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24).tolist()
    extra, least = EXTRA.tolist(), LEAST.tolist()
    out = bytearray()
    put, left = out.append, count
    while left > 0:
        found = own[word[at >> 3] >> (at & 7) & mask]
        at += found & 15
        if found < 4096:
            put(found >> 4)
            left -= 1
            continue
        s = (found >> 4) - 256
        n, e = least[s], extra[s]
        if e:
            n += word[at >> 3] >> (at & 7) & ((1 << e) - 1)
            at += e
        found = their[word[at >> 3] >> (at & 7) & far]
        at += found & 15
        s = found >> 4
        d, e = least[s], extra[s]
        if e:
            d += word[at >> 3] >> (at & 7) & ((1 << e) - 1)
            at += e
        d = d - 120 if d > 120 else max(1, NEAR[d - 1][0] + NEAR[d - 1][1] * width)
        n = min(n, left)
        left -= n
        start = len(out) - d
        out += out[start : start + n] if d >= n else (out[start:] * (n // d + 1))[:n]
    bits.at = 8 * first + at
    return bytes(out)


def decode(data: bytes) -> np.ndarray:
    """Pixels of one lossless WebP file."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L" or data[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    bits = Bits(data[21 : 20 + struct.unpack("<I", data[16:20])[0]])
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(4)
    steps, wide = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind == PALETTE:
            colours = _bytes(_image(bits, bits.read(8) + 1, 1, False))[0].cumsum(axis=0, dtype=np.uint8)
            pack = next((k for k, n in ((3, 2), (2, 4), (1, 16)) if len(colours) <= n), 0)
            steps.append((kind, wide, pack, colours))
            wide = -(-wide >> pack)
        elif kind == GREEN:
            steps.append((kind, wide, 0, None))
        else:
            block = bits.read(3) + 2
            steps.append((kind, wide, block, _bytes(_image(bits, -(-wide >> block), -(-height >> block), False))))
    out = _bytes(_image(bits, wide, height, True))
    for kind, w, block, extra in reversed(steps):
        out = (_unpredict, _uncross, _ungreen, _unpalette)[kind](out, w, block, extra)
    return out


def _bytes(argb: np.ndarray) -> np.ndarray:
    """uint32 ARGB as red, green, blue, alpha."""
    return _swapped(argb).astype("<u4").view(np.uint8).reshape(*argb.shape, 4)


def _swapped(v: np.ndarray) -> np.ndarray:
    """uint32 pixels with their highest colour and their lowest exchanged."""
    return v & np.uint32(0xFF00FF00) | v >> 16 & np.uint32(255) | (v & np.uint32(255)) << 16


def _ungreen(x: np.ndarray, *_) -> np.ndarray:
    x = x.copy()
    x[..., 0] += x[..., 1]
    x[..., 2] += x[..., 1]
    return x


def _delta(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((t.astype(np.int8).astype(np.int32) * c.astype(np.int8)) >> 5).astype(np.uint8)


def _spread(blocks: np.ndarray, shape: tuple, block: int) -> np.ndarray:
    return blocks[np.arange(shape[0])[:, None] >> block, np.arange(shape[1]) >> block]


def _uncross(x: np.ndarray, width: int, block: int, blocks: np.ndarray) -> np.ndarray:
    x, t = x.copy(), _spread(blocks, x.shape, block)
    x[..., 0] += _delta(t[..., 2], x[..., 1])
    x[..., 2] += _delta(t[..., 1], x[..., 1])
    x[..., 2] += _delta(t[..., 0], x[..., 0])
    return x


def _unpalette(x: np.ndarray, width: int, pack: int, colours: np.ndarray) -> np.ndarray:
    at = x[..., 1]
    if pack:
        n, size = 1 << pack, 8 >> pack
        at = ((at[..., None] >> (np.arange(n) * size)) & ((1 << size) - 1)).reshape(len(at), -1)[:, :width]
    return np.where((at < len(colours))[..., None], colours[np.minimum(at, len(colours) - 1)], 0).astype(np.uint8)


def predicted(mode: int, left: list, top: list, right: list, corner: list) -> list:
    """The prediction of a pixel from those to its left, above, above to the right and above to the left."""
    mean = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b)]
    clamp = lambda v: min(255, max(0, v))
    if mode == 11:
        p = [x + y - z for x, y, z in zip(left, top, corner)]
        return left if sum(abs(x - y) for x, y in zip(p, left)) < sum(abs(x - y) for x, y in zip(p, top)) else top
    if mode == 12:
        return [clamp(x + y - z) for x, y, z in zip(left, top, corner)]
    if mode == 13:
        return [clamp(x + int((x - z) / 2)) for x, z in zip(mean(left, top), corner)]
    of = (lambda: [0, 0, 0, 255], lambda: left, lambda: top, lambda: right, lambda: corner, lambda: mean(mean(left, right), top), lambda: mean(left, corner), lambda: mean(left, top), lambda: mean(corner, top), lambda: mean(top, right), lambda: mean(mean(left, corner), mean(top, right)))
    return of[mode]() if mode < 11 else [0, 0, 0, 255]


def _around(x: list, modes: np.ndarray, block: int, r: int, c: int) -> list:
    """What is predicted at a place: the first row from the left, the first column from above."""
    if not r:
        return x[0][c - 1] if c else [0, 0, 0, 255]
    if not c:
        return x[r - 1][0]
    right = x[r - 1][c + 1] if c + 1 < len(x[r]) else x[r][0]
    return predicted(int(modes[r >> block, c >> block]) & 15, x[r][c - 1], x[r - 1][c], right, x[r - 1][c - 1])


def _unpredict(x: np.ndarray, width: int, block: int, blocks: np.ndarray) -> np.ndarray:
    modes = np.unique(blocks[..., 1] & 15)
    if len(modes) == 1 and modes[0] in (1, 2):  # all from the left, or all from above
        out = x.copy()
        out[:1, :1, 3] += np.uint8(255)
        if modes[0] == 1:
            out[:, 0] = out[:, 0].cumsum(axis=0, dtype=np.uint8)
            return out.cumsum(axis=1, dtype=np.uint8)
        out[0] = out[0].cumsum(axis=0, dtype=np.uint8)
        return out.cumsum(axis=0, dtype=np.uint8)
    out = x.tolist()
    for r, row in enumerate(out):
        for c, pixel in enumerate(row):
            row[c] = [(a + b) & 255 for a, b in zip(pixel, _around(out, blocks[..., 1], block, r, c))]
    return np.array(out, np.uint8)


# The encoder.


def lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Huffman code lengths of at most ``most`` bits for symbols with a count."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weights, n = counts[order].tolist(), len(order)
    while True:
        # two queues: leaves by weight, and joined nodes, which come by weight themselves
        joined, parent, leaf, inner = [], [0] * (2 * n - 2), 0, 0
        for k in range(n - 1):
            total = 0
            for _ in range(2):
                if inner == len(joined) or leaf < n and weights[leaf] <= joined[inner]:
                    total += weights[leaf]
                    parent[leaf] = n + k
                    leaf += 1
                else:
                    total += joined[inner]
                    parent[n + inner] = n + k
                    inner += 1
            joined.append(total)
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            out[order] = depth[:n]
            return out
        weights = [(w >> 1) + 1 for w in weights]


class Writer:
    """Collects (value, bits); the least significant bit comes first."""

    def __init__(self) -> None:
        self.values, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)]
        self.held: list[tuple[int, int]] = []

    def put(self, value: int, size: int) -> None:
        self.held.append((value, size))

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.held:
            v, s = zip(*self.held)
            self.held = []
            self.extend(np.array(v, np.uint32), np.array(s, np.uint8))
        self.values.append(values)
        self.sizes.append(sizes)

    def bytes(self) -> bytes:
        self.extend(np.zeros(0, np.uint32), np.zeros(0, np.uint8))
        sizes = np.concatenate(self.sizes).astype(np.int64)
        ends = np.cumsum(sizes)
        # each value is shifted into a word of 64 bits that begins at its word of 32; values share no bits, so that
        # sums put them together
        at = ends - sizes
        wide = np.concatenate(self.values).astype(np.uint64) << (at & 31).astype(np.uint64)
        word = at >> 5
        first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
        out[word[first]] = np.add.reduceat(wide, first)
        out[1:] += out[:-1] >> np.uint64(32)
        return out.astype("<u4").tobytes()[: -(-int(ends[-1]) // 8)]


def _put_code(w: Writer, size: np.ndarray) -> None:
    used = np.flatnonzero(size)
    if len(used) <= 2 and (not len(used) or used[-1] < 256):
        found = [int(s) for s in used] or [0]
        for v, n in ((1, 1), (len(found) - 1, 1), (1, 1), *((s, 8) for s in found)):
            w.put(v, n)
        return
    runs, size = [], size[: int(used[-1]) + 1]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(size)) + 1, [len(size)]])
    for v, n in zip(size[edges[:-1]].tolist(), np.diff(edges).tolist()):
        while not v and n >= 3:
            k = min(n, 138)
            runs.append((17, k - 3, 3) if k < 11 else (18, k - 11, 7))
            n -= k
        runs += [(v, 0, 0)] * n
    own = lengths(np.bincount([r[0] for r in runs], minlength=19), 7)
    if np.count_nonzero(own) == 1:  # a code needs two symbols here
        own[0 if not own[0] else 1] = own[np.flatnonzero(own)[0]] = 1
    count = max([4, *(k + 1 for k, s in enumerate(LENGTH_ORDER) if own[s])])
    w.put(0, 1)
    w.put(count - 4, 4)
    for s in LENGTH_ORDER[:count]:
        w.put(int(own[s]), 3)
    w.put(1, 1)
    n = max(2, (max(0, len(runs) - 2)).bit_length())
    n += n & 1
    w.put((n - 2) // 2, 3)
    w.put(len(runs) - 2, n)
    found = np.array(runs)
    codes, sizes = canonical(own)
    w.extend(np.stack([codes[found[:, 0]], found[:, 1]], axis=1).ravel().astype(np.uint32), np.stack([sizes[found[:, 0]], found[:, 2]], axis=1).ravel().astype(np.uint8))


def _split(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths or distances as prefix symbols, extra bits and their values."""
    s = np.searchsorted(LEAST, v, "right") - 1
    return s, EXTRA[s], v - LEAST[s]


#: Pixels that a copy has at least.
SHORTEST = 6


def copies(argb: np.ndarray, least: int = SHORTEST) -> np.ndarray:
    """Rows (start, size, distance) of back-references, in order and apart: at each place the latest equal run of
    ``least`` pixels, as far as that distance lasts."""
    m = len(argb) - least + 1
    if m < 2:
        return np.zeros((0, 3), np.int64)
    green = least <= 8 and not ((argb ^ argb[0]) & np.uint32(0xFFFF00FF)).any()
    wide, key = (argb >> 8 & 255 if green else argb).astype(np.uint64), np.zeros(m, np.uint64)
    for j in range(least):
        key = key << np.uint64(8) | wide[j : j + m] if green else (key ^ wide[j : j + m]) * np.uint64(0x9E3779B97F4A7C15)
    # of few pixels a short hash, which sorts faster, tells most keys apart
    mark = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    order = np.argsort(mark.astype(np.uint16) if m <= 1 << 14 else key, kind="stable")
    held = key[order]
    same = np.flatnonzero(held[1:] == held[:-1])
    at = order[same + 1]
    d = at - order[same]
    order = np.argsort(at)
    at, d = at[order], d[order]
    for j in range(0 if green else least):  # equal keys of unequal pixels
        keep = argb[at + j] == argb[at + j - d]
        if not keep.all():
            at, d = at[keep], d[keep]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    edges = np.concatenate([[0], np.flatnonzero((np.diff(at) != 1) | (np.diff(d) != 0)) + 1])
    ends = at[np.append(edges[1:], len(at)) - 1] + least
    out, done = [], 0  # start, size and distance in turn
    for start, end, distance in zip(at[edges].tolist(), ends.tolist(), d[edges].tolist()):
        start = max(start, done)
        while end - start >= least:
            n = min(end - start, 4096)
            out += (start, n, distance)
            start = done = start + n
    return np.array(out, np.int64).reshape(-1, 3)


@lru_cache(64)
def _codes_of(width: int) -> np.ndarray:
    """By short distance in pixels its code; 0 for those without."""
    out = np.zeros(8 * width + 9, np.int64)
    for k in range(len(NEAR), 0, -1):
        out[max(1, NEAR[k - 1][0] + NEAR[k - 1][1] * width)] = k
    return out


def _put_image(w: Writer, argb: np.ndarray, width: int, top: bool, cache_bits: int = 0, found: np.ndarray | None = None) -> None:
    """Pixels as literals, as places in a colour cache of 2**cache_bits, and as the back-references ``found``."""
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    if top:
        w.put(0, 1)
    at = np.arange(len(argb))
    if found is not None and len(found):
        inside = np.zeros(len(argb) + 1, np.int64)
        inside[found[:, 0]] += 1
        np.subtract.at(inside, found[:, 0] + found[:, 1], 1)
        at = at[inside[:-1].cumsum() == 0]
    v = argb[at]
    values = [(v >> 8 & 255).astype(np.int64), v >> 16 & 255, v & 255, v >> 24]
    plain = slice(None)
    if cache_bits:
        # a pixel is in the cache if the last one of its slot was equal
        slot = (argb.astype(np.uint64) * MULTIPLIER & 0xFFFFFFFF).astype(np.int64) >> (32 - cache_bits)
        order = np.argsort(slot, kind="stable")
        again = np.zeros(len(argb), bool)
        again[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (argb[order[1:]] == argb[order[:-1]])
        plain = ~again[at]
        values[0][~plain] = 280 + slot[at[~plain]]
    varied = (argb ^ argb[0]) if len(argb) else argb
    varied = np.bitwise_or.reduce(varied) if len(argb) else 0
    alike = [False, *(not varied >> shift & 255 for shift in (16, 0, 24))]
    counts = [np.bincount(values[0], minlength=280 + (1 << cache_bits if cache_bits else 0)), *(None if same else np.bincount(x[plain], minlength=256) for x, same in zip(values[1:], alike[1:])), np.zeros(40, np.int64)]
    if len(at) < len(argb):
        short, d = _codes_of(width), found[:, 2]
        near = np.where(d < len(short), short[np.minimum(d, len(short) - 1)], 0)
        sizes, distances = _split(found[:, 1]), _split(np.where(near > 0, near, d + 120))
        counts[0] = counts[0] + np.bincount(sizes[0] + 256, minlength=len(counts[0]))
        counts[4] = np.bincount(distances[0], minlength=40)
    codes = []
    for i, (c, most) in enumerate(zip(counts, (15, 15, 15, 15, 13))):
        if c is None:  # a code of one symbol, without bits
            for v, n in ((1, 1), (0, 1), (1, 1), (int(argb[0]) >> (0, 16, 0, 24)[i] & 255, 8)):
                w.put(v, n)
            codes.append(None)
            continue
        size = lengths(c, most)
        if np.count_nonzero(size) == 1 and np.flatnonzero(size)[0] > 255:
            size[0] = 1
        _put_code(w, size)
        codes.append(canonical(size))
    columns = []
    for held, x in zip(codes, values):
        if held is None:
            continue
        code, size = held
        if not columns:
            columns.append((code[x], size[x]))
        elif size.any():
            columns.append((code[x], size[x]) if not cache_bits else (code[x] * plain, size[x] * plain))
    if len(at) < len(argb):
        # a length and a distance, each with its extra bits, stand where a literal has its channels
        n, m = codes[0][1][sizes[0] + 256], codes[4][1][distances[0]]
        own = [(codes[0][0][sizes[0] + 256] | sizes[2] << n, n + sizes[1]), (codes[4][0][distances[0]] | distances[2] << m, m + distances[1])]
        while len(columns) < 2:
            columns.append((np.zeros(len(at), np.uint32), np.zeros(len(at), np.uint8)))
        while len(own) < len(columns):
            own.append((np.zeros(len(found), np.uint32), np.zeros(len(found), np.uint8)))
        order = np.argsort(np.concatenate([at, found[:, 0]]), kind="stable")
        columns = [tuple(np.concatenate([x, y])[order] for x, y in zip(a, b)) for a, b in zip(columns, own)]
    bits, used = (np.stack(x, axis=1).ravel() if len(x) > 1 else x[0] for x in zip(*columns))
    w.extend(bits.astype(np.uint32), used.astype(np.uint8))


def _predictions(x: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    """The prediction of each pixel of a known image."""
    if not modes.ndim:
        out = np.roll(x, 1, axis=int(modes == 1)) if modes in (1, 2) else None
        if out is not None:
            out[0, 1:], out[1:, 0], out[0, 0] = x[0, :-1], x[:-1, 0], (0, 0, 0, 255)
            return out
    rows, modes = x.tolist(), np.broadcast_to(modes, (-(-x.shape[0] >> block), -(-x.shape[1] >> block)))
    return np.array([[_around(rows, modes, block, r, c) for c in range(x.shape[1])] for r in range(x.shape[0])], np.uint8)


def _argb(x: np.ndarray) -> np.ndarray:
    """Pixels one after another as uint32."""
    return _swapped(np.ascontiguousarray(x).view("<u4").ravel())


def encode(pixels: np.ndarray, transforms: tuple[int, ...] = (), block: int = 2, modes: np.ndarray | None = None, cross: tuple[int, int, int] = (3, -5, 7), cache_bits: int = 0, references: bool = False) -> bytes:
    """A lossless WebP file of ``pixels``, through any ``transforms`` in their order; ``modes`` are the predictor's, by
    block, ``cross`` the factors green to red, green to blue and red to blue."""
    height, width = pixels.shape[:2]
    if not (0 < width <= 16384 and 0 < height <= 16384):
        raise ValueError("a side has 1 to 16384 pixels")
    w = Writer()
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 4)
    x = pixels
    for kind in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        blocks = np.zeros((-(-x.shape[0] >> block), -(-x.shape[1] >> block), 4), np.uint8)
        if kind == GREEN:
            x = x.copy()
            x[..., [0, 2]] -= x[..., 1:2]
        elif kind == PREDICTOR:
            modes = np.asarray(0 if modes is None else modes)
            blocks[..., 1] = modes
            x = x - _predictions(x, modes, block)
        elif kind == CROSS:
            blocks[..., :3] = np.array(cross[::-1], np.int8).view(np.uint8)
            t, y = _spread(blocks, x.shape, block), x.copy()
            y[..., 2] -= _delta(t[..., 1], x[..., 1]) + _delta(t[..., 0], x[..., 0])
            y[..., 0] -= _delta(t[..., 2], x[..., 1])
            x = y
        else:
            colours, at = np.unique(_argb(x), return_inverse=True)
            if len(colours) > 256:
                raise ValueError("a palette has at most 256 colours")
            w.put(len(colours) - 1, 8)
            _put_image(w, _argb(np.diff(_bytes(colours), axis=0, prepend=np.zeros((1, 4), np.uint8))), len(colours), False)
            pack = next((k for k, n in ((3, 2), (2, 4), (1, 16)) if len(colours) <= n), 0)
            at = at.reshape(x.shape[:2])
            at = np.pad(at, ((0, 0), (0, -at.shape[1] % (1 << pack)))).reshape(len(at), -1, 1 << pack)
            green = (at << (np.arange(1 << pack) * (8 >> pack))).sum(axis=2).astype(np.uint8)
            x = np.zeros((*green.shape, 4), np.uint8)
            x[..., 1], x[..., 3] = green, 255
        if kind in (PREDICTOR, CROSS):
            w.put(block - 2, 3)
            _put_image(w, _argb(blocks), blocks.shape[1], False)
    w.put(0, 1)
    argb = _argb(x)
    _put_image(w, argb, x.shape[1], True, cache_bits, copies(argb) if references else None)
    body = b"\x2f" + w.bytes()
    body += bytes(len(body) & 1)
    return b"RIFF" + struct.pack("<I", len(body) + 12) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body
