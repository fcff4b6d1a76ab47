import struct
import time
import zlib

import numpy as np
import pytest

from siftwell.functions import images


def gif(frames, palette=((0, 0, 0), (255, 255, 255), (255, 0, 0), (0, 0, 255)), interlaced=False, transparent=None, disposal=0):
    """A GIF of index arrays; codes are written with a clear code before the table can grow."""
    h, w = frames[0].shape
    out = b"GIF89a" + struct.pack("<HH", w, h) + bytes([0x80 | 1, 0, 0]) + b"".join(bytes(c) for c in palette)
    for frame in frames:
        rows = frame
        if interlaced:
            rows = np.concatenate([frame[s::d] for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
        bits, held, n = bytearray(), 0, 0
        for i, code in enumerate(rows.ravel().tolist()):
            for c in ([4] if i % 2 == 0 else []) + [code]:
                held |= c << n
                n += 3
        held |= 5 << n
        n += 3
        while n > 0:
            bits.append(held & 255)
            held >>= 8
            n -= 8
        out += b"\x21\xf9\x04" + bytes([disposal << 2 | (transparent is not None), 0, 0, transparent or 0, 0])
        out += b"\x2c" + struct.pack("<HHHH", 0, 0, w, h) + bytes([0x40 if interlaced else 0, 2])
        for i in range(0, len(bits), 255):
            out += bytes([len(bits[i : i + 255])]) + bytes(bits[i : i + 255])
        out += b"\x00"
    return out + b"\x3b"


def grid(seed=1, size=(12, 10)):
    return np.random.default_rng(seed).integers(0, 4, size)


COLOURS = np.array([(0, 0, 0), (255, 255, 255), (255, 0, 0), (0, 0, 255)])


@pytest.mark.parametrize("interlaced", [False, True])
def test_gif_pixels(interlaced):
    a, b = grid(1), grid(2)
    frames = images.decode_gif(gif([a, b], interlaced=interlaced))
    assert len(frames) == 2 and (frames[0][..., :3] == COLOURS[a]).all() and (frames[1][..., :3] == COLOURS[b]).all()


def test_encoded_gifs_are_read_back():
    a, b = grid(3, (7, 5)), grid(4, (7, 5))
    frames = images.decode_gif(images.encode_gif([a, b], COLOURS))
    assert (frames[0][..., :3] == COLOURS[a]).all() and (frames[1][..., :3] == COLOURS[b]).all()


def test_gif_transparency_keeps_what_is_below():
    a, b = np.full((4, 4), 1), np.array([[0, 2, 0, 2]] * 4)
    frames = images.decode_gif(gif([a, b], transparent=0))
    assert (frames[1][:, 1, :3] == (255, 0, 0)).all() and (frames[1][:, 0, :3] == (255, 255, 255)).all()


def test_lzw_grows_its_codes():
    assert images._unpack_lzw(bytes([0x44, 0x01, 0x05]), 2, 3).size <= 3
    data = bytes(range(4)) * 50
    codes, table, width, out, n = [], {bytes([i]): i for i in range(4)}, 3, 0, 0
    buffer = bytearray()

    def emit(code):
        nonlocal out, n
        out |= code << n
        n += width
        while n >= 8:
            buffer.append(out & 255)
            out >>= 8
            n -= 8

    emit(4)
    w, following = b"", 6
    for byte in data:
        c = w + bytes([byte])
        if c in table:
            w = c
            continue
        emit(table[w])
        table[c] = following
        if following == 1 << width:
            width += 1
        following += 1
        w = bytes([byte])
    emit(table[w])
    emit(5)
    buffer.append(out & 255)
    assert images._unpack_lzw(bytes(buffer), 2, len(data)).tobytes() == data
    assert codes == []


def test_codes_of_one_width_are_read_at_once():
    """As many pixels as the table takes before its codes widen, then a clear code; one more pixel, or a longer code, is for the loop."""

    def stream(codes, width):
        return np.packbits([c >> k & 1 for c in codes for k in range(width)], bitorder="little").tobytes()

    for bits in range(2, 9):
        clear = 1 << bits
        pixels = np.random.default_rng(bits).integers(0, clear, 5 * (clear - 2)).tolist()
        runs = [pixels[k : k + clear - 2] for k in range(0, len(pixels), clear - 2)]
        data = stream([c for run in runs for c in [clear, *run]] + [clear + 1], bits + 1)
        assert images._plain_pixels(data, bits).tolist() == images._unpack_lzw(data, bits, len(pixels)).tolist() == pixels
        assert images._unpack_lzw(data, bits, 7).tolist() == pixels[:7]
        assert images._plain_pixels(stream([clear, *pixels[: clear - 1]], bits + 1), bits) is None
        assert images._plain_pixels(stream([clear, 1, clear + 2, clear + 1], bits + 1), bits) is None
    repeated = stream([4, 1, 6, 5], 3)
    assert images._unpack_lzw(repeated, 2, 9).tolist() == [1, 1, 1]


@pytest.mark.parametrize("data", [b"", b"GIF89a", b"no gif at all", gif([grid()])[:60]])
def test_broken_gifs(data):
    with pytest.raises(ValueError):
        images.decode_gif(data)


def test_resize_keeps_means():
    x = np.random.default_rng(3).uniform(0, 255, (20, 30, 3))
    for method in ("triangle", "lanczos"):
        assert images.resize(np.full((20, 30), 7.0), 5, 9, method) == pytest.approx(np.full((5, 9), 7.0))
        assert images.resize(x, 10, 10, method).shape == (10, 10, 3)
    assert images.to_input(x, 16).shape == (3, 16, 16) and images.to_input(np.full((8, 8, 3), 255), 4).max() == pytest.approx(1)


@pytest.mark.parametrize("method", ["triangle", "lanczos"])
@pytest.mark.parametrize("shape", [(9, 14), (9, 14, 1), (9, 14, 3), (1, 2, 4)])
def test_resize_is_the_double_sum(method, shape):
    x = np.random.default_rng(8).uniform(0, 255, shape)
    rows, columns = images._weights(shape[0], 5, method), images._weights(shape[1], 20, method)
    whole = np.array([[sum(rows[i, j] * columns[k, m] * x[j, m] for j in range(shape[0]) for m in range(shape[1])) for k in range(20)] for i in range(5)])
    assert images.resize(x, 5, 20, method) == pytest.approx(whole)


def test_hashing_and_embedding_cost_less_than_decoding():
    data = images.encode_gif([grid(k, (32, 32)) for k in range(6)], COLOURS)

    def least(work):
        taken = []
        for _ in range(5):
            began = time.perf_counter()
            work()
            taken.append(time.perf_counter() - began)
        return min(taken)

    frames = images.decode_gif(data)
    assert least(lambda: [images.gradient_hash(f) for f in frames] + [images.average_embedding(frames[:5])]) < 2 * least(lambda: images.decode_gif(data))


def test_hashes_are_near_for_near_images():
    x = images.resize(np.random.default_rng(4).uniform(0, 255, (12, 12)), 64, 64)
    y = np.clip(x + np.random.default_rng(5).normal(0, 2, x.shape), 0, 255)
    z = images.resize(np.random.default_rng(6).uniform(0, 255, (12, 12)), 64, 64)
    bits = lambda h: np.unpackbits(np.frombuffer(h, np.uint8))
    for make, size in ((images.median_hash, 32), (images.gradient_hash, 128)):
        hx, hy, hz = make(x), make(y), make(z)
        assert len(hx) == size and (bits(hx) != bits(hy)).sum() < (bits(hx) != bits(hz)).sum() / 2


def test_gif_tables(spark):
    a, b = np.zeros((8, 8), int), np.tile([1, 0, 2, 3], (8, 2))
    rows = [("same", gif([a, a])), ("one", gif([b])), ("moving", gif([a, b, a, b, b, a])), ("broken", b"GIF89a?"), ("none", None)]
    df = spark.createDataFrame(rows, "id string, content binary")
    frames = {r["id"]: (r["n_frames"], r["error"] is None) for r in images.gif_frames(df).collect()}
    assert frames["moving"] == (6, True) and frames["broken"] == (None, False) and frames["none"] == (None, False)
    got = {r["id"]: r for r in images.embed_gifs(df, "id").collect()}
    assert got["same"]["status"] == got["one"]["status"] == "same_frame" and got["moving"]["status"] == "ok" and got["none"]["status"] == "not read"
    assert np.linalg.norm(got["moving"]["embedding"]) == pytest.approx(1, abs=1e-5)


def test_mean_vector(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("a", None), ("z", [0.0, 0.0])], "g string, v array<float>")
    got = {r["g"]: r["v"] for r in images.mean_vector(rows, "g", "v").collect()}
    assert got["a"] == pytest.approx([0.5**0.5] * 2) and got["z"] is None


def test_image_source(spark, tmp_path):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    pixels = np.random.default_rng(7).integers(0, 255, (32, 32, 3)).astype(np.uint8)
    raw = b"".join(b"\x00" + row.tobytes() for row in pixels)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 32, 32, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    (tmp_path / "a.png").write_bytes(png)
    (tmp_path / "b.png").write_bytes(b"not an image")
    rows = {r["key"].rsplit("/", 1)[-1]: r for r in images.image_hash(spark.read.format("image").load(str(tmp_path))).collect()}
    assert bytes(rows["a.png"]["hash"]) == images.median_hash(pixels) and rows["b.png"]["error"] == "not an image"
