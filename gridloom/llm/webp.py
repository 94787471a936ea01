"""Decoder of lossless WebP: prefix codes, back-references, colour cache, all transforms."""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR_DISTANCES = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3),
    (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3),
    (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5),
    (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7),
    (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7),
    (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6),
    (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
LENGTHS, DISTANCES, LITERALS = 24, 40, 256
SIGNATURE = 0x2F
CACHE_FACTOR = 0x1E35A7BD

Image = np.ndarray  # height, width, 4 samples: alpha, red, green, blue


class WebpError(ValueError):
    """The bytes aren't a lossless WebP image."""


class Bits:
    """Reads bits from the least significant of each byte on."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def read(self, n: int) -> int:
        end = self.at + n
        if end > 8 * len(self.data):
            raise WebpError("the stream ends early")
        word = int.from_bytes(self.data[self.at >> 3 : (end + 7) >> 3], "little") >> (self.at & 7)
        self.at = end
        return word & ((1 << n) - 1)

    def peek(self, n: int) -> int:
        return (int.from_bytes(self.data[self.at >> 3 : (self.at + n + 7) >> 3], "little") >> (self.at & 7)) & ((1 << n) - 1)


class PrefixCode:
    """A canonical prefix code as a table from the next bits to a symbol and its length."""

    def __init__(self, lengths: list[int]):
        used = [s for s, n in enumerate(lengths) if n]
        if not used:
            raise WebpError("a prefix code without symbols")
        self.only = used[0] if len(used) == 1 else None
        if self.only is not None:
            return
        self.width = max(lengths)
        if sum(1 << (self.width - lengths[s]) for s in used) != 1 << self.width:
            raise WebpError("an over- or undersubscribed prefix code")
        self.symbol, self.length = [0] * (1 << self.width), [0] * (1 << self.width)
        code = 0
        for n in range(1, self.width + 1):
            for s in used:
                if lengths[s] == n:
                    first = int(f"{code:0{n}b}"[::-1], 2)
                    for at in range(first, 1 << self.width, 1 << n):
                        self.symbol[at], self.length[at] = s, n
                    code += 1
            code <<= 1

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        word = bits.peek(self.width)
        bits.at += self.length[word]
        if bits.at > 8 * len(bits.data):
            raise WebpError("the stream ends early")
        return self.symbol[word]


def read_prefix_code(bits: Bits, alphabet: int) -> PrefixCode:
    lengths = [0] * alphabet
    if bits.read(1):  # simple: one or two symbols
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        symbols = [first, bits.read(8)] if two else [first]
        if max(symbols) >= alphabet:
            raise WebpError("a symbol outside of the alphabet")
        for s in symbols:
            lengths[s] = 1
        return PrefixCode(lengths)
    inner = [0] * 19
    for k in range(4 + bits.read(4)):
        inner[CODE_LENGTH_ORDER[k]] = bits.read(3)
    code = PrefixCode(inner)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    at, last = 0, 8
    while at < alphabet and left:
        left -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            at, last = at + 1, s or last
        else:
            n, value = {16: (lambda: 3 + bits.read(2), last), 17: (lambda: 3 + bits.read(3), 0), 18: (lambda: 11 + bits.read(7), 0)}[s]
            n = n()
            if at + n > alphabet:
                raise WebpError("code lengths run over the alphabet")
            lengths[at : at + n] = [value] * n
            at += n
    return PrefixCode(lengths)


def _prefixed(bits: Bits, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


class CodeGroup:
    """The five prefix codes of an image: green with lengths and cache entries, red, blue,
    alpha, distance. ``symbol`` and ``length`` are the tables of the first four, all over the
    next ``width`` bits; equal tables are one object."""

    def __init__(self, codes: list[PrefixCode]):
        self.codes = codes
        self.width = max([c.width for c in codes[:4] if c.only is None], default=1)
        self.symbol, self.length = [], []
        for c in codes[:4]:
            tables = ([c.only], [0]) if c.only is not None else (c.symbol, c.length)
            for held, table, kind in zip((self.symbol, self.length), tables, (np.uint16, np.uint8)):
                whole = np.tile(np.array(table, kind), (1 << self.width) // len(table))
                held.append(next((t for t in held[1:] if (t == whole).all()), whole))
        #: green's length, or 255 before a length or a cache entry
        self.first = np.where(self.symbol[0] < LITERALS, self.length[0], np.uint8(255))


#: Groups of codes read before, by alphabets, size in bits and bits; a worker remembers a few.
_READ: dict[tuple[int, ...], dict[int, dict[int, CodeGroup]]] = {}
REMEMBERED = 64


def read_group(bits: Bits, alphabets: tuple[int, ...]) -> CodeGroup:
    sizes = _READ.setdefault(alphabets, {})
    for size, known in sizes.items():
        if bits.at + size <= 8 * len(bits.data) and (group := known.get(bits.peek(size))) is not None:
            bits.at += size
            return group
    begin = bits.at
    group = CodeGroup([read_prefix_code(bits, a) for a in alphabets])
    end, bits.at = bits.at, begin
    if sum(len(known) for by in _READ.values() for known in by.values()) >= REMEMBERED:
        _READ.clear()
        sizes = _READ.setdefault(alphabets, {})
    sizes.setdefault(end - begin, {})[bits.read(end - begin)] = group
    return group


def _reference(bits: Bits, symbol: int, distance: PrefixCode, width: int, at: int, n: int) -> tuple[int, int]:
    """A back-reference's number of pixels and how far back they lie."""
    length = _prefixed(bits, symbol - LITERALS)
    code = _prefixed(bits, distance.read(bits))
    if code > len(NEAR_DISTANCES):
        back = code - len(NEAR_DISTANCES)
    else:
        dx, dy = NEAR_DISTANCES[code - 1]
        back = max(1, dx + dy * width)
    if back > at or at + length > n:
        raise WebpError("a back-reference outside of the image")
    return length, back


#: Bytes of a stream whose bit positions are looked up together.
STRIDE = 1 << 14


def _one_group(bits: Bits, width: int, n: int, group: CodeGroup, cache_bits: int) -> np.ndarray:
    """Pixels of an image with one group of codes. Where a pixel's four symbols would end is
    worked out for every bit position of a stretch of the stream at once; following the pixels
    is then one step each. Only back-references are read one by one."""
    out = np.zeros(n, np.uint32)
    cache: dict[int, int] = {}
    shift, factor = np.uint32(32 - cache_bits), np.uint32(CACHE_FACTOR)
    slots = lambda pixels: ((pixels * factor) >> shift).tolist()
    symbol, length = group.symbol, group.length
    total, at = 8 * len(bits.data), 0
    raw = np.frombuffer(bits.data, np.uint8)
    mask, eight = np.uint32((1 << group.width) - 1), np.arange(8, dtype=np.uint32)
    while at < n:
        lo = bits.at >> 3
        if 8 * lo > total:
            raise WebpError("the stream ends early")
        part = raw[lo : lo + STRIDE + 16]
        size = 8 * min(STRIDE, len(part) + 1)
        byte = np.zeros(len(part) + 20, np.uint32)
        byte[: len(part)] = part
        byte = byte[:-3] | (byte[1:-2] << 8) | (byte[2:-1] << 16)
        look = ((byte[:, None] >> eight) & mask).ravel()
        taken = {id(t): t.take(look) for t in {id(t): t for t in length[1:]}.values()}
        step = [taken[id(t)] for t in length[1:]]
        end = group.first.take(look[:size]).astype(np.int32)
        special = end == 255
        end += np.arange(size, dtype=np.int32)
        for after in step:
            end += after.take(end, mode="clip")
        end[special] = -1
        if cache_bits:  # a cache entry is a pixel by itself
            entry = np.flatnonzero(special)
            entry = entry[symbol[0].take(look[entry]) >= LITERALS + LENGTHS]
            end[entry] = entry + length[0].take(look[entry])
        nxt = memoryview(np.append(end, np.full(64, -1, np.int32)))
        here, starts, copies, ahead = bits.at - 8 * lo, [], [], 0
        append = starts.append
        while (left := n - at - ahead - len(starts)) > 0:
            for _ in range(left):
                then = nxt[here]
                if then < 0:
                    break
                append(here)
                here = then
            else:
                break
            if here >= size:
                break
            code = int(look[here])
            bits.at = 8 * lo + here + int(length[0][code])
            found = _reference(bits, int(symbol[0][code]), group.codes[4], width, at + ahead + len(starts), n)
            copies.append((len(starts), *found))
            ahead += found[0]
            here = bits.at - 8 * lo
            if here >= size:
                break
        bits.at = 8 * lo + here
        if bits.at > total:
            raise WebpError("the stream ends early")
        place = np.array(starts, np.int64)
        code = look.take(place)
        green = symbol[0].take(code)
        pixels = green.astype(np.uint32) << 8
        place += length[0].take(code)
        for table, after, up in zip(symbol[1:], step, (16, 0, 24)):
            code = look.take(place, mode="clip")
            pixels |= table.take(code).astype(np.uint32) << up
            place += after.take(place, mode="clip")
        entries = np.flatnonzero(green >= LITERALS)  # cache entries by place, then an end mark
        marks = iter([*zip(entries.tolist(), (green[entries] - (LITERALS + LENGTHS)).tolist()), (len(starts), -1)])
        if cache_bits:
            slot, plain = slots(pixels), pixels.tolist()
        done = 0
        entry_at, entry_slot = next(marks)
        for upto, count, back in [*copies, (len(starts), 0, 0)]:
            first = done
            while entry_at < upto:
                cache.update(zip(slot[done:entry_at], plain[done:entry_at]))
                pixels[entry_at] = cache.get(entry_slot, 0)
                done = entry_at + 1
                entry_at, entry_slot = next(marks)
            if cache_bits:
                cache.update(zip(slot[done:upto], plain[done:upto]))
            out[at : at + upto - first] = pixels[first:upto]
            at, done = at + upto - first, upto
            if count:
                out[at : at + count] = np.resize(out[at - back : at], count) if back < count else out[at - back : at - back + count]
                if cache_bits:
                    cache.update(zip(slots(out[at : at + count]), out[at : at + count].tolist()))
                at += count
    return out


def read_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """One entropy-coded image as 32-bit ARGB numbers, row by row."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise WebpError("a colour cache of over 11 bits")
    groups, tile_bits, tiles_wide = 1, 0, 0
    which = None
    if main and bits.read(1):
        tile_bits = 2 + bits.read(3)
        tiles_wide = (width + (1 << tile_bits) - 1) >> tile_bits
        tiles_high = (height + (1 << tile_bits) - 1) >> tile_bits
        which = (read_pixels(bits, tiles_wide, tiles_high, False) >> 8) & 0xFFFF
        groups = int(which.max()) + 1
    alphabets = (LITERALS + LENGTHS + ((1 << cache_bits) if cache_bits else 0), LITERALS, LITERALS, LITERALS, DISTANCES)
    codes = [read_group(bits, alphabets) for _ in range(groups)]
    if groups == 1:
        return _one_group(bits, width, width * height, codes[0], cache_bits)
    return _many_groups(bits, width, width * height, codes, which, tile_bits, tiles_wide, cache_bits)


def _many_groups(bits: Bits, width: int, n: int, groups: list[CodeGroup], which: np.ndarray, tile_bits: int, tiles_wide: int, cache_bits: int) -> np.ndarray:
    """Pixels of an image whose tiles have codes of their own, symbol by symbol."""
    out = [0] * n
    cache = [0] * (1 << cache_bits) if cache_bits else []
    shift = 32 - cache_bits
    at = cached = 0
    while at < n:
        green, red, blue, alpha, distance = groups[which[(at // width >> tile_bits) * tiles_wide + (at % width >> tile_bits)]].codes
        s = green.read(bits)
        if s < LITERALS:
            r, b = red.read(bits), blue.read(bits)
            out[at] = alpha.read(bits) << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < LITERALS + LENGTHS:
            length, back = _reference(bits, s, distance, width, at, n)
            for _ in range(length):
                out[at] = out[at - back]
                at += 1
        else:
            if cache_bits:  # the cache holds all pixels written so far
                for p in out[cached:at]:
                    cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> shift] = p
                cached = at
            out[at] = cache[s - LITERALS - LENGTHS]
            at += 1
    return np.array(out, np.uint32)


def _channels(argb: np.ndarray) -> np.ndarray:
    return np.stack([(argb >> k) & 255 for k in (24, 16, 8, 0)], axis=-1).astype(np.uint8)


def _average(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a + b) >> 1


def _predict(mode: int, left: np.ndarray, top: np.ndarray, top_right: np.ndarray, top_left: np.ndarray) -> np.ndarray:
    """The prediction of some pixels from their neighbours, one row of four samples each."""
    if mode == 0 or mode > 13:
        return np.broadcast_to([255, 0, 0, 0], left.shape)
    if mode < 5:
        return (left, top, top_right, top_left)[mode - 1]
    if mode == 5:
        return _average(_average(left, top_right), top)
    if mode < 10:
        return _average(*((left, top_left), (left, top), (top_left, top), (top, top_right))[mode - 6])
    if mode == 10:
        return _average(_average(left, top_left), _average(top, top_right))
    if mode == 11:
        nearer_left = np.abs(top - top_left).sum(axis=-1) < np.abs(left - top_left).sum(axis=-1)
        return np.where(nearer_left[:, None], left, top)
    if mode == 12:
        return np.clip(left + top - top_left, 0, 255)
    mean = _average(left, top)
    return np.clip(mean + ((mean - top_left) / 2).astype(int), 0, 255)


def undo_predictor(image: Image, modes: np.ndarray, tile_bits: int) -> Image:
    """Add each pixel's prediction from its decoded neighbours, mode by tile.

    One mode of the left or upper pixel everywhere is a running sum. Else pixels with equal
    ``x + 2 y`` are worked out together: none of them is a neighbour that another needs."""
    height, width, _ = image.shape
    out = image.copy()
    out[0, 0, 0] = (int(out[0, 0, 0]) + 255) & 255
    out[0] = np.cumsum(out[0], axis=0, dtype=np.uint8)
    first = int(modes.flat[0])
    if first == 2 and (modes == 2).all():
        return np.cumsum(out, axis=0, dtype=np.uint8)
    out[:, 0] = np.cumsum(out[:, 0], axis=0, dtype=np.uint8)
    if first == 1 and (modes == 1).all():
        out[1:] = np.cumsum(out[1:], axis=1, dtype=np.uint8)
        return out
    out = out.astype(int)
    for diagonal in range(3, width + 2 * height - 2):
        y = np.arange(max(1, (diagonal - width + 2) // 2), min(height - 1, (diagonal - 1) // 2) + 1)
        x = diagonal - 2 * y
        if not len(y):
            continue
        right = np.where((x + 1 < width)[:, None], out[y - 1, np.minimum(x + 1, width - 1)], out[y, 0])
        around = (out[y, x - 1], out[y - 1, x], right, out[y - 1, x - 1])
        mode = modes[y >> tile_bits, x >> tile_bits]
        for m in np.unique(mode):
            own = mode == m
            out[y[own], x[own]] = (out[y[own], x[own]] + _predict(int(m), *(a[own] for a in around))) & 255
    return out.astype(np.uint8)


def undo_cross_colour(image: Image, elements: Image, tile_bits: int) -> Image:
    """Add what green and red contribute to red and blue, by tile."""
    height, width, _ = image.shape
    each = elements.repeat(1 << tile_bits, 0)[:height].repeat(1 << tile_bits, 1)[:, :width]
    signed = lambda a: a.astype(np.uint8).view(np.int8).astype(int)
    delta = lambda t, c: (signed(t) * signed(c)) >> 5
    out = image.astype(int)
    red = (out[..., 1] + delta(each[..., 3], image[..., 2])) & 255
    blue = (out[..., 3] + delta(each[..., 2], image[..., 2]) + delta(each[..., 1], red)) & 255
    out[..., 1], out[..., 3] = red, blue
    return out.astype(np.uint8)


def undo_palette(image: Image, palette: np.ndarray, width: int) -> Image:
    """Palette colours for indices, several of which share a green sample if there are few."""
    size = len(palette)
    pack = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
    x = np.arange(width)
    each = 8 >> pack
    index = (image[..., 2].astype(int)[:, x >> pack] >> ((x & ((1 << pack) - 1)) * each)) & ((1 << each) - 1)
    whole = np.zeros((256, 4), np.uint8)
    whole[:size] = palette
    return whole[index]


def _stream(data: bytes) -> bytes:
    """The lossless chunk's bits, also of an extended file with other chunks before."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise WebpError("not a WebP file")
    at = 12
    while at + 8 <= len(data):
        kind, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if kind == b"VP8L":
            if size < 5 or data[at + 8 : at + 9] != bytes([SIGNATURE]):
                break
            return data[at + 9 : at + 8 + size]
        at += 8 + size + size % 2
    raise WebpError("not a lossless WebP file")


def decode(data: bytes) -> Image:
    """The pixels of a lossless WebP file, as an array of height x width x (alpha, red, green,
    blue). Raises WebpError for anything else."""
    bits = Bits(_stream(data))
    width, height = bits.read(14) + 1, bits.read(14) + 1
    has_alpha, version = bits.read(1), bits.read(3)
    if version:
        raise WebpError("an unknown version")
    transforms, seen, wide = [], set(), width
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise WebpError("a transform twice")
        seen.add(kind)
        if kind < 2:
            tile = 2 + bits.read(3)
            across, down = (wide + (1 << tile) - 1) >> tile, (height + (1 << tile) - 1) >> tile
            transforms.append((kind, _channels(read_pixels(bits, across, down, False)).reshape(down, across, 4), tile, wide))
        elif kind == 2:
            transforms.append((kind, None, 0, wide))
        else:
            n = bits.read(8) + 1
            palette = np.cumsum(_channels(read_pixels(bits, n, 1, False)), axis=0).astype(np.uint8)
            transforms.append((kind, palette, 0, wide))
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            wide = (wide + (1 << pack) - 1) >> pack
    image = _channels(read_pixels(bits, wide, height, True)).reshape(height, wide, 4)
    for kind, extra, tile, before in reversed(transforms):
        if kind == 0:
            image = undo_predictor(image, extra[..., 2] & 15, tile)
        elif kind == 1:
            image = undo_cross_colour(image, extra, tile)
        elif kind == 2:
            image = image.copy()
            image[..., 1] += image[..., 2]
            image[..., 3] += image[..., 2]
        else:
            image = undo_palette(image, extra, before)
    if not has_alpha:
        image = image.copy()
        image[..., 0] = 255
    return image
