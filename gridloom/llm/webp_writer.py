"""Writer of lossless WebP for byte payloads: four bytes a pixel, 144 pixels a row."""

from __future__ import annotations

import heapq
import struct
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np

from gridloom.llm.webp import CACHE_FACTOR, CODE_LENGTH_ORDER, LENGTHS, LITERALS, NEAR_DISTANCES, SIGNATURE, WebpError

WIDTH, MOST_ROWS = 144, 1 << 14
CACHE_BITS = 8
#: Pixels in a row that are worth a back-reference, and the most that one can copy or reach.
LEAST_COPY, MOST_COPY, MOST_BACK = 4, 4096, (1 << 20) - 120
MOST_COLOURS = 16

Fields = tuple[np.ndarray, np.ndarray]  # values and their numbers of bits


def code_lengths(weights: np.ndarray, most: int) -> list[int]:
    """Lengths of an optimal prefix code; weights are flattened until none is over ``most``."""
    while True:
        heap = [(float(w), k, None) for k, w in enumerate(weights)]
        heapq.heapify(heap)
        number = len(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], number, (a, b)))
            number += 1
        lengths, stack = [0] * len(weights), [(heap[0], 0)]
        while stack:
            (_, k, parts), depth = stack.pop()
            if parts is None:
                lengths[k] = depth
            else:
                stack += [(parts[0], depth + 1), (parts[1], depth + 1)]
        if max(lengths) <= most:
            return lengths
        weights = np.sqrt(weights)


def canonical(lengths: list[int]) -> Fields:
    """Each symbol's code, first bit lowest, and its length."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    for n, s in sorted((n, s) for s, n in enumerate(lengths) if n):
        code <<= n - last
        codes[s], last = int(f"{code:0{n}b}"[::-1], 2), n
        code += 1
    return codes, np.array(lengths, np.uint8)


def text_weights() -> np.ndarray:
    """How often bytes of running text are expected: letters by rank, marks, digits, capitals,
    the bytes of two- and three-byte characters, the rest. No byte is impossible."""
    out = np.full(256, 2.0**-13)
    for rank, c in enumerate(b" etaoinsrhldcumfpgwybvkxjqz"):
        out[c] = 0.16 * 0.86**rank
    out[list(b".,\n-'")] = 0.01
    out[ord("0") : ord("9") + 1] = 0.002
    out[ord("A") : ord("Z") + 1] = 0.002
    out[0x80:0xC0] = 0.002
    out[0xC2:0xF0] = 0.001
    return out


def step_weights() -> np.ndarray:
    """How often differences are expected: mostly none, then small ones of either sign."""
    size = np.minimum(np.arange(256), 256 - np.arange(256))
    return 0.25 / (1 + size) ** 1.5


class Code:
    """A static code with its own description in a stream."""

    def __init__(self, lengths: list[int]):
        self.code, self.bits = canonical(lengths)
        self.head = described(lengths)


def described(lengths: list[int]) -> list[tuple[int, int]]:
    """A normal code's description: its lengths, repeats written as such, coded in turn."""
    tokens: list[tuple[int, int, int]] = []  # symbol, extra value, its bits
    at = 0
    while at < len(lengths):
        run = 1
        while at + run < len(lengths) and lengths[at + run] == lengths[at]:
            run += 1
        if lengths[at] == 0 and run >= 3:
            run = min(run, 138)
            tokens.append((17, run - 3, 3) if run < 11 else (18, run - 11, 7))
            at += run
            continue
        tokens.append((lengths[at], 0, 0))
        left = run - 1
        while lengths[at] and left >= 3:
            tokens.append((16, min(left, 6) - 3, 2))
            left -= min(left, 6)
        tokens += [(lengths[at], 0, 0)] * left
        at += run
    used = sorted({s for s, _, _ in tokens})
    often = np.array([sum(t[0] == s for t in tokens) for s in used], float)
    inner = [0] * 19
    if len(used) == 1:  # a second symbol, never used, keeps the code complete
        used, often = [used[0], (used[0] + 1) % 16], np.array([1.0, 1.0])
    for s, n in zip(used, code_lengths(often, 7)):
        inner[s] = n
    code, bits = canonical(inner)
    last = max(k for k, s in enumerate(CODE_LENGTH_ORDER) if inner[s])
    count = max(4, last + 1)
    out = [(0, 1), (count - 4, 4)] + [(inner[s], 3) for s in CODE_LENGTH_ORDER[:count]] + [(0, 1)]
    for s, extra, n in tokens:
        out += [(int(code[s]), int(bits[s])), (extra, n)]
    return out


class One:
    """A code of one symbol, which takes no bits."""

    def __init__(self, symbol: int):
        self.code, self.bits = np.zeros(LITERALS, np.uint32), np.zeros(LITERALS, np.uint8)
        self.head = [(1, 1), (0, 1), (1, 1), (symbol, 8)]


def _green(weights: np.ndarray, cache_bits: int) -> Code:
    more = [np.full(LENGTHS, 2.0**-11)]
    if cache_bits:
        more.append(np.full(1 << cache_bits, 0.15 / (1 << cache_bits)))
    return Code(code_lengths(np.concatenate([weights / weights.sum(), *more]), 15))


def _tiles(transform: int, red: int, green: int) -> list[tuple[int, int]]:
    """A transform with one colour for all tiles of the largest size."""
    return [(1, 1), (transform, 2), (7, 3), (0, 1), *One(green).head, *One(red).head, *One(0).head, *One(255).head, *One(0).head]


@dataclass(frozen=True)
class Form:
    """A way of writing an image: transforms, and the codes of its four samples."""

    codes: tuple[Code | One, ...]  # green, red, blue, alpha, distance
    transforms: tuple[tuple[int, int], ...]
    cache_bits: int

    @cached_property
    def head(self) -> list[tuple[int, int]]:
        cache = [(1, 1), (self.cache_bits, 4)] if self.cache_bits else [(0, 1)]
        return [*self.transforms, (0, 1), *cache, (0, 1), *(f for c in self.codes for f in c.head)]

    @cached_property
    def head_bits(self) -> int:
        return sum(k for _, k in self.head)


@lru_cache(maxsize=1)
def forms() -> dict[str, Form]:
    text, step = text_weights(), step_weights()
    words, steps = Code(code_lengths(text, 15)), Code(code_lengths(step, 15))
    flat = Code([8] * 256)
    far = Code([5] * 24 + [6] * 16)
    plain = _green(text, 0)
    return {
        "plain": Form((plain, words, words, words, far), (), 0),
        "cached": Form((_green(text, CACHE_BITS), words, words, words, far), (), CACHE_BITS),
        "left": Form((_green(step, 0), steps, steps, steps, far), tuple(_tiles(0, 0, 1)), 0),
        "top": Form((_green(step, 0), steps, steps, steps, far), tuple(_tiles(0, 0, 2)), 0),
        "cross": Form((plain, words, steps, words, far), tuple(_tiles(1, 32, 0)), 0),
        "flat": Form((_green(np.full(256, 1 / 256), 0), flat, flat, flat, far), (), 0),
        "index": Form((_green(step, 0), One(0), One(0), One(255), far), (), 0),
    }


def find_copies(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of pixels that also stand earlier: ``(start, number, distance)``, apart from each
    other and in order. Of the earlier places of four pixels only the last is tried."""
    n = len(pixels)
    if n <= LEAST_COPY:
        return []
    pairs = pixels[:-1].astype(np.uint64) << np.uint64(32) | pixels[1:]
    four = pairs[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ pairs[2:]
    order = np.argsort(four, kind="stable")
    same = four[order[1:]] == four[order[:-1]]
    back = np.zeros(len(four), np.int64)
    back[order[1:][same]] = order[1:][same] - order[:-1][same]
    edge = np.flatnonzero(np.append(True, back[1:] != back[:-1]))
    size = np.diff(np.append(edge, len(four)))
    good = (back[edge] > 0) & (back[edge] <= MOST_BACK)
    out, free = [], 0
    for at, k, d in zip(edge[good].tolist(), size[good].tolist(), back[edge[good]].tolist()):
        lo, hi = max(at, free), at + k + LEAST_COPY - 1  # the last four are copied whole
        if hi - lo >= LEAST_COPY and np.array_equal(pixels[lo:hi], pixels[lo - d : hi - d]):
            out += [(x, min(MOST_COPY, hi - x), d) for x in range(lo, hi, MOST_COPY)]
            free = hi
    return out


def _prefix(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol, extra bits' value and number for lengths and distance codes from 1 on."""
    low = value - 1
    top = np.where(low < 4, 0, np.floor(np.log2(np.maximum(low, 1))).astype(np.int64) - 1)
    symbol = np.where(low < 4, low, 2 * (top + 1) + ((low >> top) & 1))
    return symbol, np.where(low < 4, 0, low & ((1 << top) - 1)), top


def image_fields(pixels: np.ndarray, form: Form, cached: Form | None = None) -> tuple[bool, Fields]:
    """The entropy-coded pixels: per literal four codes, per copy two codes with extra bits,
    per cache entry one code. Written in the ``cached`` form, if one is given, where that is
    shorter; whether it was comes first."""
    green, red, blue, alpha, far = form.codes
    n = len(pixels)
    sample = [(pixels >> np.uint32(k)) & np.uint32(255) for k in (8, 16, 0, 24)]
    values, bits = np.empty((n, 4), np.uint32), np.empty((n, 4), np.uint8)
    for k, (c, v) in enumerate(zip((green, red, blue, alpha), sample)):
        values[:, k], bits[:, k] = c.code.take(v), c.bits.take(v)
    copies = find_copies(pixels)
    token = np.ones(n, bool)
    for at, k, _ in copies:
        token[at : at + k] = False
    shorter = False
    if cached is not None:
        slot = (pixels * np.uint32(CACHE_FACTOR)) >> np.uint32(32 - cached.cache_bits)
        order = np.argsort(slot.astype(np.uint16), kind="stable")
        held = np.zeros(n, bool)
        held[order[1:]] = pixels[order[1:]] == pixels[order[:-1]]  # equal pixels have equal slots
        held &= token
        entry = cached.codes[0].bits.take(LITERALS + LENGTHS + slot[held])
        with_cache = cached.codes[0].bits.take(sample[0])
        gain = int(bits[held].sum(dtype=np.int64)) - int(entry.sum(dtype=np.int64))
        loss = int(with_cache[token & ~held].sum(dtype=np.int64)) - int(bits[token & ~held, 0].sum(dtype=np.int64))
        shorter = gain - loss > cached.head_bits - form.head_bits
        if shorter:
            green = cached.codes[0]
            values[:, 0], bits[:, 0] = green.code.take(sample[0]), with_cache
            values[held, 0], bits[held, 0] = green.code.take(LITERALS + LENGTHS + slot[held]), entry
            bits[held, 1:] = 0
            values[held, 1:] = 0
    if copies:
        at, number, back = (np.array(x, np.int64) for x in zip(*copies))
        token[at] = True
        length, more, size = _prefix(number)
        distance, more_far, size_far = _prefix(back + len(NEAR_DISTANCES))
        values[at] = np.stack([green.code[LITERALS + length], more, far.code[distance], more_far], axis=1)
        bits[at] = np.stack([green.bits[LITERALS + length], size, far.bits[distance], size_far], axis=1)
        values, bits = values[token], bits[token]
    return shorter, (values.ravel(), bits.ravel())


def joined(parts: list[Fields]) -> bytes:
    """Fields one after another, each from its lowest bit on."""
    values = np.concatenate([np.asarray(v, np.uint64) for v, _ in parts])
    bits = np.concatenate([np.asarray(b, np.int64) for _, b in parts])
    begin = np.cumsum(bits) - bits
    total = int(begin[-1] + bits[-1])
    word, shifted = begin >> 5, values << (begin & 31).astype(np.uint64)
    out = np.zeros((total >> 5) + 2, np.uint64)
    for k, half in ((0, shifted & np.uint64(0xFFFFFFFF)), (1, shifted >> np.uint64(32))):
        # fields don't overlap, so the sums are exact
        sums = np.bincount(word + k, weights=half.astype(float), minlength=len(out))
        out += sums[: len(out)].astype(np.uint64)
    return out.astype("<u4").tobytes()[: (total + 7) // 8]


def _fields(pairs: list[tuple[int, int]]) -> Fields:
    return np.array([v for v, _ in pairs], np.uint64), np.array([n for _, n in pairs], np.int64)


@lru_cache(maxsize=16)
def _head(name: str) -> Fields:
    return _fields(forms()[name].head)


def _packed(samples: np.ndarray) -> np.ndarray:
    """32-bit pixels from rows of red, green, blue, alpha."""
    p = samples.reshape(-1, 4).astype(np.uint32)
    return (p[:, 3] << 24) | (p[:, 0] << 16) | (p[:, 1] << 8) | p[:, 2]


def steps(image: np.ndarray, mode: int) -> np.ndarray:
    """Differences to the left (1) or upper (2) pixel, the first row's and column's fixed."""
    out = image.copy()
    if mode == 1:
        out[:, 1:] -= image[:, :-1]
        out[1:, 0] -= image[:-1, 0]
    else:
        out[1:] -= image[:-1]
        out[0, 1:] -= image[0, :-1]
    out[0, 0, 3] = (int(out[0, 0, 3]) - 255) & 255
    return out


def _cost(code: Code, samples: np.ndarray) -> int:
    return int(np.bincount(samples.ravel(), minlength=256) @ code.bits[:256].astype(np.int64))


def _palette(pixels: np.ndarray, colours: np.ndarray, height: int) -> list[Fields]:
    """Few colours: their steps as an image of one row, and several indices in one pixel."""
    n = len(colours)
    pack = 3 if n <= 2 else 2 if n <= 4 else 1
    each, wide = 8 >> pack, -(-WIDTH >> pack)
    index = np.zeros((height, wide << pack), np.uint32)
    index[:, :WIDTH] = np.searchsorted(colours, pixels).reshape(height, WIDTH)
    shifts = (np.arange(1 << pack) * each).astype(np.uint32)
    green = (index.reshape(height, wide, 1 << pack) << shifts).sum(axis=2, dtype=np.uint32).ravel()
    samples = colours.astype("<u4").view(np.uint8).reshape(-1, 4)[:, (2, 1, 0, 3)]
    change = np.diff(samples, axis=0, prepend=np.zeros((1, 4), np.uint8))
    flat = forms()["flat"]
    inner = [(0, 1), *(f for c in flat.codes for f in c.head)]  # no cache, no groups of codes
    return [
        _fields([(1, 1), (3, 2), (n - 1, 8), *inner]),
        image_fields(_packed(change), flat)[1],
        _head("index"),
        image_fields((np.uint32(0xFF) << np.uint32(24)) | (green << np.uint32(8)), forms()["index"])[1],
    ]


def encode_rows(part: bytes) -> tuple[str, bytes]:
    """The form chosen and the file of whole rows of 576 bytes, red, green, blue and alpha
    being four bytes in a row. Up to sixteen colours are a palette; else the form whose codes
    suit the samples best: text as it is, differences to the left or upper pixel, or blue's to
    red's; and text with a colour cache where that is shorter."""
    height = len(part) // (4 * WIDTH)
    samples = np.frombuffer(part, np.uint8).reshape(height, WIDTH, 4)
    pixels = _packed(samples)
    size = _fields([(WIDTH - 1, 14), (height - 1, 14), (1, 1), (0, 3)])
    # a first look at some pixels spares sorting all; none is decided by it alone
    if len(np.unique(pixels[:: max(1, len(pixels) // 64)])) <= MOST_COLOURS and len(colours := np.unique(pixels)) <= MOST_COLOURS:
        name, parts = "palette", _palette(pixels, colours, height)
    else:
        all_forms = forms()
        text, step = all_forms["plain"].codes[1], all_forms["left"].codes[1]
        crossed = samples.copy()
        # what the decoder adds back: 32 times red over 32, so red itself
        crossed[..., 2] -= samples[..., 0]
        ways = {"plain": samples, "left": steps(samples, 1), "top": steps(samples, 2), "cross": crossed}
        # the filling at the end is a copy in any form
        used = len(pixels) - int((np.append(pixels[::-1] != 0xFFFFFFFF, True)).argmax())
        flat = {k: v.reshape(-1, 4)[:used] for k, v in ways.items()}
        cost = {k: _cost(step, flat[k]) for k in ("left", "top")}
        cost["plain"] = _cost(text, flat["plain"])
        cost["cross"] = cost["plain"] - _cost(text, flat["plain"][:, 2]) + _cost(step, flat["cross"][:, 2])
        name = min(sorted(cost, key=lambda k: k != "plain"), key=cost.__getitem__)
        shorter, coded = image_fields(_packed(ways[name]), all_forms[name], all_forms["cached"] if name == "plain" else None)
        name = "cached" if shorter else name
        parts = [_head(name), coded]
    stream = bytes([SIGNATURE]) + joined([size, *parts])
    return name, container(stream)


def container(stream: bytes) -> bytes:
    pad = b"\0" * (len(stream) % 2)
    return b"RIFF" + struct.pack("<I", 12 + len(stream) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(stream)) + stream + pad


def encode_payload(payload: bytes) -> bytes:
    """A payload of whole rows of 576 bytes as lossless WebP: one file up to 16384 rows, then
    the next. Equal payloads give equal files."""
    row = 4 * WIDTH
    if not payload or len(payload) % row:
        raise WebpError("the payload isn't a positive number of whole rows")
    return b"".join(encode_rows(payload[at : at + row * MOST_ROWS])[1] for at in range(0, len(payload), row * MOST_ROWS))
