import math
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.functions import ids, paths, payload, tags, vectors
from siftwell.functions.frames import frames_identical, sampled_frames
from siftwell.functions.magic import detect_extension


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


def test_content_uuid_golden(spark):
    assert one(spark, ids.content_uuid(F.col("b")), "b binary", b"qwq") == "6c439572-44ed-5ba9-a6fb-627b06406c73"
    assert one(spark, ids.content_uuid(F.col("b")), "b binary", None) is None


def test_canonical_uuid_spellings(spark):
    rows = []
    for text in (str(uuid.UUID(int=5)), str(uuid.UUID(int=2**128 - 1)), str(uuid.UUID(int=2**64)), "6c439572-44ed-5ba9-a6fb-627b06406c73"):
        u = uuid.UUID(text)
        rows += [(s, text) for s in (text, text.upper(), "{" + text + "}", u.urn, u.hex, u.hex.upper(), str(u.int), f" {text} ")]
    rows += [("", None), (None, None), ("Not an id", "not an id"), (str(2**128), str(2**128))]
    got = spark.createDataFrame(rows, "s string, want string").select("s", "want", ids.canonical_uuid("s").alias("c")).collect()
    assert [r for r in got if r["c"] != r["want"]] == []


def test_numeric_id(spark):
    assert one(spark, ids.numeric_id_to_uuid(F.col("n")), "n bigint", 5) == "00000000-0000-0000-0000-000000000005"


@pytest.mark.parametrize(
    "path",
    ["a b/größe/x.jpg", "./a b/größe/x.jpg", "/a b/größe/x.jpg", "s3://bucket/a b/größe/x.jpg", "a b\\größe\\x.jpg", "a b//größe///x.jpg", "a%20b/gr%C3%B6%C3%9Fe%2Fx.jpg", "a%20b%5Cgr%C3%B6%C3%9Fe/x%2Ejpg"],
)
def test_plain_path(spark, path):
    assert one(spark, paths.plain_path("p"), "p string", path) == "a b/größe/x.jpg"


def test_plain_path_odd(spark):
    assert one(spark, paths.plain_path("p"), "p string", "a+b/100%.jpg") == "a+b/100%.jpg"
    assert one(spark, paths.plain_path("p"), "p string", None) is None


def test_path_parts(spark):
    c = F.col("p")
    row = spark.createDataFrame([("d.x/a.b.png",), ("noext",), ("dir/.hidden",)], "p string").select(
        paths.file_stem(c), paths.last_segment_extension(c), paths.name_extension(c), paths.rename_target(c, F.lit("jpg"))
    ).collect()
    assert tuple(row[0]) == ("a.b", "png", "png", "d.jpg")
    assert tuple(row[1]) == ("noext", "noext", None, "noext.jpg")
    assert row[2][2] is None


def test_uri(spark):
    rows = [
        ("https://example.com/resources/", "url", "https://example.com/resources/i.jpg"),
        ("https://example.com/resources", "url", "https://example.com/i.jpg"),
        ("https://a.b", "url", "https://a.b/i.jpg"),
        ("/path/to/resources/", "path", "/path/to/resources/i.jpg"),
        ("C:\\path\\to\\resources\\", "path", "C:\\path\\to\\resources\\i.jpg"),
        ("/path", "path", "/path/i.jpg"),
    ]
    df = spark.createDataFrame(rows, "p string, kind string, uri string")
    for r in df.select("*", paths.prefix_kind(F.col("p")).alias("k"), paths.point_uri(F.col("p"), F.lit("i"), F.lit("jpg")).alias("u")).collect():
        assert (r["k"], r["u"]) == (r["kind"], r["uri"])
    assert one(spark, paths.point_uri(F.col("p"), F.lit("i"), F.lit(None).cast("string")), "p string", "/a") is None


def test_etag_and_tags(spark):
    assert one(spark, paths.plain_etag(F.col("e")), "e string", 'W/"AbC"') == "abc"
    got = one(spark, tags.plain_tags(F.col("t")), "t array<string>", [" Blue_Cat", "blue-  cat", "", None, "_", "A"])
    assert got == ["a", "blue cat"]
    assert one(spark, tags.plain_tags(F.col("t")), "t array<string>", None) == []


def test_cosine(spark):
    sim = vectors.cosine_similarity(F.col("a"), F.col("b"))
    schema = "a array<float>, b array<float>"
    assert one(spark, sim, schema, [1.234] * 768, [1.234] * 768) == pytest.approx(1, abs=1e-3)
    assert one(spark, sim, schema, [0.5] * 768, [-0.5] * 768) == pytest.approx(-1, abs=1e-3)
    assert one(spark, sim, schema, [1.0, 0.0] * 384, [0.0, 1.0] * 384) == pytest.approx(0, abs=1e-3)
    assert one(spark, sim, schema, [0.0, 0.0], [1.0, 1.0]) is None
    rng = np.random.default_rng(42)
    for _ in range(5):
        a, b = rng.uniform(-1, 1, (2, 768))
        want = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
        assert one(spark, sim, schema, a.tolist(), b.tolist()) == pytest.approx(want, abs=1e-3)
    with pytest.raises(Exception, match="unequal"):
        one(spark, sim, schema, [1.0], [1.0, 2.0])


def test_hamming_and_bytes(spark):
    schema, a, b = "a binary, b binary", bytes(range(32)), bytes([0, 255, *range(2, 32)])
    assert one(spark, vectors.hamming_bytes(F.col("a"), F.col("b")), schema, a, b) == 1
    assert one(spark, vectors.hamming_bytes(F.col("a"), F.col("b"), share=True), schema, a, b) == pytest.approx(1 / 32)
    assert one(spark, vectors.hamming_bits(F.col("a"), F.col("b")), schema, a, b) == 7
    assert one(spark, vectors.bytes_to_floats(F.col("a")), "a binary", b"\x00\xff") == [0.0, 255.0]
    assert one(spark, vectors.sign_bytes(F.col("v"), 9), "v array<float>", [1.0, -1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 2.0, 3.0]) == bytes([0b10100001, 0b10000000])
    assert one(spark, vectors.l2_normalize(F.col("v")), "v array<float>", [3.0, 4.0]) == pytest.approx([0.6, 0.8])
    assert one(spark, vectors.euclidean_distance(F.col("a"), F.col("b")), "a array<float>, b array<float>", [0.0, 0.0], [3.0, 4.0]) == 5


@pytest.mark.parametrize("n,want", [(0, []), (1, [0]), (4, [0, 1, 2, 3]), (5, [0, 1, 2, 3, 4]), (6, [0, 1, 3, 4, 5]), (100, [0, 25, 50, 75, 99])])
def test_frame_sampling(spark, n, want):
    assert one(spark, sampled_frames(F.col("n")), "n int", n) == want


def test_frames_identical(spark):
    same = frames_identical(F.col("h"), vectors.hamming_bits)
    assert one(spark, same, "h array<binary>", [b"\x00"]) is True
    assert one(spark, same, "h array<binary>", [b"\x00", b"\x0f", b"\x00"]) is True
    assert one(spark, same, "h array<binary>", [b"\x00", b"\x1f"]) is False


@pytest.mark.parametrize(
    "head,ext",
    [
        (b"\xff\xd8\xff\xe0", "jpg"), (b"\x89PNG\r\n\x1a\n", "png"), (b"GIF89a..", "gif"), (b"RIFF....WEBP", "webp"), (b"text", None), (b"", None),
        (b"JUNK....WEBP", None), (b"RIFF....WAVE", "wav"), (b"RIFF....AVI LIST", "avi"),
        (b"\0\0\0\x20ftypisom", "mp4"), (b"\0\0\0\x20ftypqt  ", "mov"), (b"\0\0\0\x20ftypheic", "heif"), (b"\0\0\0\x20ftypmif1\0\0\0\0mif1heic", "heif"),
        (b"\0\0\0\x20ftypmif1\0\0\0\0mif1avif", "avif"), (b"\0\0\0\x20ftypavif", "avif"), (b"\0\0\0\x20ftypM4A ", "m4a"), (b"\0\0\0\x20ftypwhat", None),
        (b"PK\x03\x04" + b"." * 26 + b"mimetypeapplication/epub+zip", "epub"), (b"PK\x03\x04" + b"." * 26 + b"[Content_Types].xml..word/document.xml", "docx"),
        (b"PK\x03\x04" + b"." * 26 + b"[Content_Types].xml..xl/workbook.xml", "xlsx"), (b"PK\x03\x04" + b"." * 26 + b"word/notes.txt", "zip"),
    ],
)
def test_magic(spark, head, ext):
    assert one(spark, detect_extension(F.col("b")), "b binary", head) == ext


def test_payload(spark):
    schema, p = "p string", '{"height": 5, "tags": ["a", 1, "b"], "ocr": "hi", "n": 3}'
    assert one(spark, payload.payload_int(F.col("p"), "height"), schema, p) == 5
    assert one(spark, payload.payload_strings(F.col("p"), "tags"), schema, p) == ["a", "b"]
    assert one(spark, payload.payload_strings(F.col("p"), "n"), schema, p) is None
    assert one(spark, payload.payload_string(F.col("p"), "ocr"), schema, p) == "hi"
    assert one(spark, payload.payload_string(F.col("p"), "n"), schema, p) is None
    assert one(spark, payload.payload_int(F.col("p"), "height"), schema, "no json") is None
    assert one(spark, payload.text_info(F.col("v"), F.col("t")), "v array<float>, t string", None, "x") is None


def test_layout(spark):
    got = one(spark, payload.layout_on_circle(F.lit(0), F.lit(4), 1000), "x int", 1)
    assert (got["x"], got["y"]) == (900, 500)
    assert math.isclose(got["x"], 900)
