import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from gridloom.llm import webp
from gridloom.llm import webp_writer as W
from gridloom.llm.media import decode_media, decode_payload, pad, split_files, store_texts
from gridloom.llm.webp import WebpError, decode
from gridloom.llm.webp_writer import container, encode_payload, encode_rows


class Stream:
    """Writes streams by hand, independently of the package's own writer."""

    def __init__(self):
        self.word, self.size = 0, 0

    def put(self, value, n):
        self.word |= value << self.size
        self.size += n
        return self

    def bytes(self):
        return self.word.to_bytes((self.size + 7) // 8, "little")

    def head(self, width, height, alpha=1):
        self.put(0x2F, 8).put(width - 1, 14).put(height - 1, 14).put(alpha, 1).put(0, 3)
        return self

    def one(self, symbol):
        self.put(1, 1).put(0, 1).put(1, 1).put(symbol, 8)
        return self

    def two(self, a, b):
        self.put(1, 1).put(1, 1).put(1, 1).put(a, 8).put(b, 8)
        return self

    def lengths(self, lengths):
        """A normal code; code lengths are themselves coded with four bits each."""
        self.put(0, 1).put(15, 4)
        for s in webp.CODE_LENGTH_ORDER:
            self.put(4 if s < 16 else 0, 3)
        self.put(0, 1)
        for n in lengths:
            self.put(int(f"{n:04b}"[::-1], 2), 4)
        used, code, self.codes = sorted((n, s) for s, n in enumerate(lengths) if n), 0, {}
        last = used[0][0]
        for n, s in used:
            code <<= n - last
            self.codes[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
            code, last = code + 1, n
        return dict(self.codes)

    def file(self):
        return container(self.bytes())


def argb(image):
    return [tuple(int(v) for v in p) for row in image for p in row]


def test_literals_and_simple_codes():
    s = Stream().head(2, 2)
    s.put(0, 1).put(0, 1).put(0, 1).two(7, 9).one(1).one(2).one(255).one(0)
    for bit in (0, 1, 1, 0):
        s.put(bit, 1)
    assert argb(decode(s.file())) == [(255, 1, g, 2) for g in (7, 9, 9, 7)]


def test_back_references_and_cache():
    s = Stream().head(3, 3)
    s.put(0, 1).put(1, 1).put(3, 4).put(0, 1)  # cache of 8 entries
    sizes = [0] * (256 + 24 + 8)
    colour = 0xFF << 24 | 1 << 16 | 5 << 8 | 2
    slot = (0x1E35A7BD * colour & 0xFFFFFFFF) >> 29
    for k in (5, 6, 256 + 2, 280 + slot):
        sizes[k] = 2
    code = s.lengths(sizes)
    s.one(1).one(2).one(255)
    s.two(1, 4)  # distance symbols 1 -> code 2, 4 -> codes 5 and 6
    s.put(*code[5]).put(*code[6])
    s.put(*code[258]).put(0, 1)  # length 3 at distance code 2: one pixel left
    s.put(*code[280 + slot])
    s.put(*code[258]).put(0, 1)
    got = [p[2] for p in argb(decode(s.file()))]
    assert got == [5, 6, 6, 6, 6, 5, 5, 5, 5]


def test_over_long_reference_is_refused():
    s = Stream().head(2, 1)
    s.put(0, 1).put(0, 1).put(0, 1)
    sizes = [0] * 280
    sizes[3] = sizes[256 + 3] = 1
    code = s.lengths(sizes)
    s.one(0).one(0).one(0).one(1)
    s.put(*code[3]).put(*code[259])
    with pytest.raises(WebpError, match="back-reference"):
        decode(s.file())


def flat_image(s, pixels, cache=True, main=False):
    """An entropy-coded image of literal codes of eight bits for all four samples."""
    s.put(0, 1)
    if main:
        s.put(0, 1)
    for size in (280, 256, 256, 256):
        s.lengths([8] * 256 + [0] * (size - 256))
    s.one(0)
    for a, r, g, b in pixels:
        for v in (g, r, b, a):
            s.put(int(f"{v:08b}"[::-1], 2), 8)


def test_subtract_green_and_cross_colour():
    rng = np.random.default_rng(1)
    pixels = [tuple(map(int, p)) for p in rng.integers(0, 256, (20, 4))]
    s = Stream().head(5, 4)
    s.put(1, 1).put(1, 2).put(0, 3)
    flat_image(s, [(0, 3, 200, 17), (0, 250, 9, 130)])  # two tiles of 4 x 4
    s.put(1, 1).put(2, 2).put(0, 1)
    flat_image(s, pixels, main=True)
    want = []
    signed = lambda v: v - 256 if v > 127 else v
    for k, (a, r, g, b) in enumerate(pixels):
        r, b = (r + g) & 255, (b + g) & 255
        red_to_blue, green_to_blue, green_to_red = ((3, 200, 17), (250, 9, 130))[k % 5 >= 4]
        r = (r + (signed(green_to_red) * signed(g) >> 5)) & 255
        b = (b + (signed(green_to_blue) * signed(g) >> 5) + (signed(red_to_blue) * signed(r) >> 5)) & 255
        want.append((a, r, g, b))
    assert argb(decode(s.file())) == want


@pytest.mark.parametrize("colours,pack", [(2, 8), (4, 4), (16, 2), (40, 1)])
def test_palette(colours, pack):
    rng = np.random.default_rng(colours)
    palette = rng.integers(0, 256, (colours, 4))
    index = rng.integers(0, colours, (3, 11))
    s = Stream().head(11, 3)
    s.put(1, 1).put(3, 2).put(colours - 1, 8)
    steps = np.diff(palette, axis=0, prepend=np.zeros((1, 4), int)) % 256
    flat_image(s, steps.tolist())
    s.put(0, 1)
    each = 8 // pack
    rows = [(255, 0, sum(int(v) << (each * k) for k, v in enumerate(row[at : at + pack])), 0) for row in index for at in range(0, 11, pack)]
    flat_image(s, rows, main=True)
    assert (decode(s.file()) == palette[index]).all()


@pytest.mark.parametrize("mode", range(14))
def test_predictor(mode):
    rng = np.random.default_rng(mode)
    image = rng.integers(0, 256, (4, 4, 4))
    residual = np.zeros_like(image)
    for y in range(4):
        for x in range(4):
            L, T = image[y, x - 1], image[y - 1, x]
            TL, TR = image[y - 1, x - 1], image[y - 1, x + 1] if x < 3 else image[y, 0]
            half = lambda a, b: (a + b) // 2
            nearer = np.abs(L + T - TL - L).sum() < np.abs(L + T - TL - T).sum()
            guesses = [np.array([255, 0, 0, 0]), L, T, TR, TL, half(half(L, TR), T), half(L, TL), half(L, T), half(TL, T), half(T, TR), half(half(L, TL), half(T, TR)), L if nearer else T, np.clip(L + T - TL, 0, 255), np.clip(half(L, T) + np.fix((half(L, T) - TL) / 2).astype(int), 0, 255)]
            guess = guesses[mode] if x and y else L if x else T if y else guesses[0]
            residual[y, x] = (image[y, x] - guess) % 256
    s = Stream().head(4, 4)
    s.put(1, 1).put(0, 2).put(0, 3)
    flat_image(s, [(0, 0, mode, 0)])
    s.put(0, 1)
    flat_image(s, residual.reshape(-1, 4).tolist(), main=True)
    assert (decode(s.file()) == image).all()


def test_groups_of_codes():
    s = Stream().head(8, 1, alpha=0)
    s.put(0, 1).put(0, 1).put(1, 1).put(0, 3)  # tiles of 4 x 4
    flat_image(s, [(0, 0, 0, 0), (0, 0, 1, 0)])
    for green in (10, 20):
        s.one(green).one(1).one(2).one(3).one(0)
    assert argb(decode(s.file())) == [(255, 1, 10, 2)] * 4 + [(255, 1, 20, 2)] * 4


@pytest.mark.parametrize("data", [b"", b"RIFF", b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 20, encode_payload(b"x" * 576)[:-9]])
def test_broken_files(data):
    with pytest.raises(WebpError):
        decode(data)


def test_payload_round_trip():
    rng = np.random.default_rng(0)
    for rows in (1, 3, W.MOST_ROWS + 2):
        payload = rng.integers(0, 256, 576 * rows, dtype=np.uint8).tobytes()
        media = encode_payload(payload)
        assert decode_payload(media)[0] == payload
        assert len(split_files(media)) == 1 + (rows > W.MOST_ROWS)


WORDS = "the of and to in is that it was for on are as with his they at be this have from or one had by".split()


def sample_texts():
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "."]) for _ in range(n))
    return {
        "palette": [b"", b"ab" * 300, b"\n" * 5000, bytes([k % 7 for k in range(4000) for _ in range(4)])],
        "plain": ["".join(rng.choice("etaoinshrldcumfpgw ") for _ in range(n)).encode() for n in (300, 2000)],
        "cached": [(" ".join(f"{w:<7}" for w in text(400).split())).encode()],
        "left": [bytes((k // 40) & 255 for k in range(20_000)), bytes(v for k in range(3000) for v in (k & 255, k & 255, 7, 200))],
        "top": [bytes(np.add.outer(np.arange(30), np.random.default_rng(0).integers(0, 256, 576)).astype(np.uint8))],
        "cross": [b"".join(bytes([r, g, r, a]) for r, g, a in ([rng.randrange(100, 200)] + rng.choices(b"etaoin shr", k=2) for _ in range(3000)))],
    }


@pytest.mark.parametrize("name", ["palette", "plain", "cached", "left", "top", "cross"])
def test_every_form_is_chosen_and_read_back(name):
    for text in sample_texts()[name]:
        payload = pad(text)
        chosen, file = encode_rows(payload)
        assert chosen == name
        assert decode_payload(file)[0] == payload


def test_files_hold_references_and_are_shorter_than_text():
    for text in sample_texts()["plain"] + sample_texts()["cached"]:
        once, twice = (len(encode_payload(pad(t))) for t in (text, text + b" " * (-len(text) % 4) + text))
        assert twice < 1.3 * once < 1.3 * (len(text) + 400)
    assert W.find_copies(np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 9, 9, 9, 9, 9, 9], np.uint32)) == [(5, 4, 5), (10, 5, 1)]


def test_fast_reader_equals_the_plain_one(monkeypatch):
    """Both readers on the writer's streams, also with stretches of a few bytes."""
    texts = [t for some in sample_texts().values() for t in some]
    want = [decode(encode_payload(pad(t))) for t in texts]
    monkeypatch.setattr(webp, "STRIDE", 24)
    again = [decode(encode_payload(pad(t))) for t in texts]
    monkeypatch.setattr(webp, "_one_group", lambda bits, width, n, group, cache: webp._many_groups(bits, width, n, [group], np.zeros(n, int), 0, 0, cache))
    plain = [decode(encode_payload(pad(t))) for t in texts]
    assert all((a == b).all() and (a == c).all() for a, b, c in zip(want, again, plain))


def test_random_payloads():
    rng = np.random.default_rng(9)
    for k in range(60):
        rows = int(rng.integers(1, 5))
        data = rng.integers(0, [2, 20, 256][k % 3], 576 * rows, dtype=np.uint8)
        if k % 2:
            data = np.repeat(data, 4)[: 576 * rows]
        assert decode_payload(encode_payload(data.tobytes()))[0] == data.tobytes()


def test_extended_container():
    file = encode_payload(b"x y z " * 96)
    extended = b"RIFF" + (len(file) + 10).to_bytes(4, "little") + b"WEBPVP8X" + (10).to_bytes(4, "little") + bytes(10) + file[12:]
    assert (decode(extended) == decode(file)).all()


def test_wide_predictor_image():
    rng = np.random.default_rng(2)
    image, modes = rng.integers(0, 256, (9, 13, 4), dtype=np.uint8), rng.integers(0, 14, (3, 4))
    out = webp.undo_predictor(image, modes, 2)
    for y in range(9):
        for x in range(13):
            if y and x:
                o = out.astype(int)
                around = [o[y, x - 1], o[y - 1, x], o[y - 1, x + 1] if x < 12 else o[y, 0], o[y - 1, x - 1]]
                guess = webp._predict(int(modes[y >> 2, x >> 2]), *(a[None] for a in around))[0]
            else:
                guess = out[0, x - 1] if x else out[y - 1, 0] if y else np.array([255, 0, 0, 0])
            assert ((image[y, x] + guess.astype(int)) & 255 == out[y, x]).all()


def test_table(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("media", T.StringType()), T.StructField("feature", T.LongType())])
    texts = [None, "", "é" * 288, "x" * 577, "same", "same"]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)] + [(None, "same", None, None)], schema)
    rows = store_texts(docs, with_media=True)
    got = rows.collect()
    assert len(got) == 7
    for r in got:
        text = (texts[r["doc_id"]] if r["doc_id"] is not None else "same") or ""
        payload = text.encode() + b"\xff" * (-len(text.encode()) % 576 or (0 if text else 576))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(text.encode()), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(payload[-32:])
        assert (r["media_bytes"], r["media_sha256"]) == (len(r["media"]), hashlib.sha256(r["media"]).hexdigest())
    assert len({(r["media_sha256"], r["feature"]) for r in got[4:]}) == 1
    pixels = decode_media(rows.select("doc_id", "media")).collect()
    assert all(p["pixels"] and p["media_error"] is None for p in pixels)
    broken = decode_media(spark.createDataFrame([(1, None), (2, bytearray(b"junk"))], "doc_id long, media binary")).collect()
    assert all(p["pixels"] is None and p["media_error"] for p in broken)
    assert store_texts(spark.createDataFrame([], schema)).collect() == []
