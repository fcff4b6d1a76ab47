"""Image kernels in numpy and the columns built on them: decoding of GIFs, resizing, hashes, embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _plain_pixels(data: bytes, code_size: int) -> np.ndarray | None:
    """The pixels of a stream whose codes all have one width and stand for one pixel each; None for any other stream.

    Encoders without a table write so: a clear code comes before the width would change.
    """
    clear, stop, width = 1 << code_size, (1 << code_size) + 1, code_size + 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    codes = bits[: len(bits) // width * width].reshape(-1, width) @ (1 << np.arange(width))
    ends = np.flatnonzero(codes == stop)
    codes = codes[: ends[0]] if len(ends) else codes
    if not len(codes) or codes[0] != clear or codes.max() > clear:
        return None
    runs = np.diff(np.append(np.flatnonzero(codes == clear), len(codes))) - 1
    # the table has clear + 2 entries, one more from the second code of a run on
    if runs.max() > clear - 2:
        return None
    return codes[codes < clear].astype(np.uint8)


def _unpack_lzw(data: bytes, code_size: int, expected: int) -> np.ndarray:
    if 1 < code_size < 9 and (pixels := _plain_pixels(data, code_size)) is not None:
        return pixels[:expected]
    clear, stop = 1 << code_size, (1 << code_size) + 1
    table: list[bytes] = []
    first: list[bytes] = []
    out = bytearray()
    width, held, bits, previous = code_size + 1, 0, 0, None
    for byte in data:
        held |= byte << bits
        bits += 8
        while bits >= width:
            code = held & ((1 << width) - 1)
            held >>= width
            bits -= width
            if code == clear:
                first = first or [bytes([i]) for i in range(clear)] + [b"", b""]
                table = first.copy()
                width, previous = code_size + 1, None
                continue
            if code == stop:
                return np.frombuffer(bytes(out[:expected]), np.uint8)
            if previous is None:
                entry = table[code]
            elif code < len(table):
                entry = table[code]
                table.append(previous + entry[:1])
            elif code == len(table):
                entry = previous + previous[:1]
                table.append(entry)
            else:
                raise ValueError("broken LZW data")
            out += entry
            previous = entry
            if len(table) == 1 << width and width < 12:
                width += 1
    return np.frombuffer(bytes(out[:expected]), np.uint8)


def decode_gif(data: bytes) -> list[np.ndarray]:
    """Composited frames (height, width, 4) of a GIF; ValueError if the data are broken."""
    try:
        return _frames(data)
    except (IndexError, KeyError) as e:
        raise ValueError("truncated GIF") from e


def _frames(data: bytes) -> list[np.ndarray]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF")
    width, height = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    palette_of = lambda at, flags: np.frombuffer(data[at : at + 3 * (2 << (flags & 7))], np.uint8).reshape(-1, 3)
    at, shared = 13, None
    if data[10] & 0x80:
        shared = palette_of(13, data[10])
        at += shared.size
    canvas, frames = np.zeros((height, width, 4), np.uint8), []
    see_through, disposal = None, 0

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                flags = data[at + 3]
                disposal, see_through = (flags >> 2) & 7, data[at + 6] if flags & 1 else None
            _, at = blocks(at + 2)
            continue
        if data[at] != 0x2C:
            raise ValueError("unknown block")
        x, y, w, h = (int.from_bytes(data[at + i : at + i + 2], "little") for i in (1, 3, 5, 7))
        flags = data[at + 9]
        at += 10
        palette = shared
        if flags & 0x80:
            palette = palette_of(at, flags)
            at += palette.size
        if palette is None:
            raise ValueError("no palette")
        packed, after = blocks(at + 1)
        index = _unpack_lzw(packed, data[at], w * h)
        at = after
        if len(index) < w * h:
            raise ValueError("too little data")
        index = index.reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(index)
            straight[order] = index
            index = straight
        before = canvas.copy()
        area = canvas[y : y + h, x : x + w]
        index = index[: area.shape[0], : area.shape[1]]
        solid = np.hstack([palette, np.full((len(palette), 1), 255, np.uint8)])
        colours = solid[np.minimum(index, len(palette) - 1)]
        if see_through is None:
            area[:] = colours
        else:
            area[index != see_through] = colours[index != see_through]
        frames.append(canvas.copy())
        if disposal == 2:
            canvas[y : y + h, x : x + w] = 0
        elif disposal == 3:
            canvas = before
        see_through, disposal = None, 0
    if not frames:
        raise ValueError("no frame")
    return frames


def encode_gif(frames: list[np.ndarray], palette: np.ndarray) -> bytes:
    """A GIF of frames of palette indices; a clear code before every second pixel keeps the codes at one width."""
    bits = max(2, int(len(palette) - 1).bit_length())
    colours = np.zeros((1 << bits, 3), np.uint8)
    colours[: len(palette)] = palette
    height, width = frames[0].shape
    size = width.to_bytes(2, "little") + height.to_bytes(2, "little")
    out = [b"GIF89a", size, bytes([0x80 | (bits - 1), 0, 0]), colours.tobytes()]
    for frame in frames:
        index = frame.ravel().astype(np.int64)
        codes = np.full((-(-len(index) // 2), 3), -1)
        codes[:, 0] = 1 << bits
        codes[:, 1] = index[0::2]
        codes[: len(index) // 2, 2] = index[1::2]
        stream = np.append(codes[codes >= 0], (1 << bits) + 1)
        packed = np.packbits(((stream[:, None] >> np.arange(bits + 1)) & 1).ravel().astype(np.uint8), bitorder="little").tobytes()
        blocks = b"".join(bytes([len(packed[i : i + 255])]) + packed[i : i + 255] for i in range(0, len(packed), 255))
        out += [b"\x2c\0\0\0\0", size, b"\0", bytes([bits]), blocks, b"\0"]
    return b"".join([*out, b"\x3b"])


@lru_cache(maxsize=32)
def _weights(source: int, target: int, method: str) -> np.ndarray:
    scale = max(source / target, 1.0)
    centre = (np.arange(target) + 0.5) * source / target
    t = (np.arange(source)[None] + 0.5 - centre[:, None]) / scale
    w = np.maximum(1 - np.abs(t), 0) if method == "triangle" else np.sinc(t) * np.sinc(t / 3)
    w[np.abs(t) > (1.0 if method == "triangle" else 3.0)] = 0
    w /= w.sum(axis=1, keepdims=True)
    w.flags.writeable = False
    return w


def resize(image: np.ndarray, height: int, width: int, method: str = "triangle") -> np.ndarray:
    """The image at another size, by a triangle or a three-lobed Lanczos filter: first its rows, then its columns."""
    rows = _weights(image.shape[0], height, method)
    columns = _weights(image.shape[1], width, method)
    half = rows @ image.astype(np.float64).reshape(image.shape[0], -1)
    if image.ndim == 2:
        return half @ columns.T
    return columns @ half.reshape(height, image.shape[1], image.shape[2])


def to_input(image: np.ndarray, size: int) -> np.ndarray:
    """(3, size, size) in -1..1: resized to fill the square, cut to its middle, colours scaled by 2/255 - 1."""
    h, w = image.shape[:2]
    ratio = max(size / h, size / w)
    big = resize(image[..., :3], max(size, round(h * ratio)), max(size, round(w * ratio)))
    top, left = (big.shape[0] - size) // 2, (big.shape[1] - size) // 2
    return (np.clip(big[top : top + size, left : left + size], 0, 255) * 2 / 255 - 1).transpose(2, 0, 1)


def grey(image: np.ndarray) -> np.ndarray:
    return image[..., :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114]) if image.ndim == 3 else image.astype(np.float64)


def median_hash(image: np.ndarray, side: int = 16) -> bytes:
    """side*side bits: low cosine frequencies above their median."""
    n = side * 2
    small = resize(grey(image), n, n, "lanczos")
    basis = np.cos(np.pi * (np.arange(n)[None] + 0.5) * np.arange(side)[:, None] / n)
    low = basis @ small @ basis.T
    return np.packbits(low > np.median(low)).tobytes()


def gradient_hash(image: np.ndarray, side: int = 32) -> bytes:
    """side*side bits: whether brightness rises from each cell to the next in its row."""
    small = resize(grey(image), side, side + 1, "lanczos")
    return np.packbits(np.diff(small, axis=1) > 0).tobytes()


def gif_frames(files: DataFrame, content: str = "content") -> DataFrame:
    """The rows without the content, plus n_frames, hashes (array<binary>, one a frame) and error."""
    keep = [c for c in files.columns if c != content]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for data in frame[content]:
                try:
                    if data is None:
                        raise ValueError("not read")
                    found = decode_gif(bytes(data))
                    rows.append((len(found), [gradient_hash(f) for f in found], None))
                except ValueError as e:
                    rows.append((None, None, str(e)))
            extra = pd.DataFrame(rows, columns=["n_frames", "hashes", "error"], index=frame.index)
            yield pd.concat([frame[keep], extra.astype({"n_frames": "Int32"})], axis=1)

    schema = files.select(*keep).schema.simpleString()[len("struct<") : -1]
    return files.mapInPandas(run, f"{schema}{',' if keep else ''}n_frames:int,hashes:array<binary>,error:string")


def average_embedding(images: list[np.ndarray]) -> np.ndarray:
    """A stand-in embedder: the 8 x 8 colour means of the prepared image, unit length."""
    out = []
    for image in images:
        x = to_input(image, 32).reshape(3, 8, 4, 8, 4).mean(axis=(2, 4)).ravel()
        out.append(x / max(np.linalg.norm(x), 1e-12))
    return np.array(out)


def embed_gifs(files: DataFrame, key: str, content: str = "content", embedder=average_embedding, same_below: float = 5, batch: int = 32) -> DataFrame:
    """(id, status, embedding): the mean of the embeddings of the sampled frames, at unit length.

    status is 'ok', 'same_frame' (every frame's hash nearer than ``same_below`` bits to the first, or only one
    frame), or the error. The embedder gets lists of at most ``batch`` images and is made ready once a worker.
    """

    def sample(n: int) -> list[int]:
        return list(range(n)) if n < 5 else sorted({0, n // 4, n // 2, 3 * n // 4, n - 1})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for point, data in zip(frame[key], frame[content]):
                try:
                    found = decode_gif(bytes(data)) if data is not None else None
                    if found is None:
                        raise ValueError("not read")
                    hashes = [np.unpackbits(np.frombuffer(gradient_hash(f), np.uint8)) for f in found]
                    if all((h != hashes[0]).sum() < same_below for h in hashes[1:]):
                        rows.append((point, "same_frame", None))
                        continue
                    chosen = [found[i] for i in sample(len(found))]
                    parts = np.concatenate([embedder(chosen[i : i + batch]) for i in range(0, len(chosen), batch)])
                    mean = parts.mean(axis=0)
                    rows.append((point, "ok", (mean / max(np.linalg.norm(mean), 1e-12)).astype(np.float32)))
                except ValueError as e:
                    rows.append((point, str(e), None))
            yield pd.DataFrame(rows, columns=["id", "status", "embedding"])

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, content).mapInPandas(run, f"id {kind}, status string, embedding array<float>")


def mean_vector(vectors: DataFrame, group: str, vec: str) -> DataFrame:
    """(group, vec): mean of the vectors of each group at unit length; NULL vectors do not count."""
    at = vectors.select(group, F.posexplode(vec).alias("i", "x"))
    means = at.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    rows = means.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("s"))
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda acc, e: acc + e["m"] * e["m"]))
    scaled = F.transform(F.array(length), lambda n: F.when(n > 0, F.transform("s", lambda e: (e["m"] / n).cast("float"))))
    return rows.select(group, F.element_at(scaled, 1).alias(vec))


def image_hash(images: DataFrame, image: str = "image", key: str | None = None) -> DataFrame:
    """(key, hash, error) of rows of Spark's image source by the median hash: 32 bytes; undecodable ones give an error row."""
    path: Column = F.col(key) if key else F.col(f"{image}.origin")
    held = images.select(path.alias("key"), *(F.col(f"{image}.{c}").alias(c) for c in ("height", "width", "nChannels", "data")))
    kind = held.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for k, h, w, n, data in zip(frame["key"], frame["height"], frame["width"], frame["nChannels"], frame["data"]):
                if h is None or h <= 0 or data is None:
                    rows.append((k, None, "not an image"))
                    continue
                pixels = np.frombuffer(bytes(data), np.uint8).reshape(h, w, n)
                rows.append((k, median_hash(pixels[..., 2::-1] if n >= 3 else pixels[..., 0]), None))
            yield pd.DataFrame(rows, columns=["key", "hash", "error"])

    return held.mapInPandas(run, f"key {kind}, hash binary, error string")
