"""File types from leading bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes that are looked at.
HEAD_BYTES = 8193

#: (extension, [(offset, bytes in hex), ...]), all must be there, first match counts; public file signatures (fixed values).
SIGNATURES = [
    ("jpg", [(0, "FFD8FF")]),
    ("png", [(0, "89504E470D0A1A0A")]),
    ("gif", [(0, "474946383761")]),
    ("gif", [(0, "474946383961")]),
    ("webp", [(0, "52494646"), (8, "57454250")]),
    ("tif", [(0, "49492A00")]),
    ("tif", [(0, "4D4D002A")]),
    ("bmp", [(0, "424D")]),
    ("psd", [(0, "38425053")]),
    ("ico", [(0, "00000100")]),
    ("webm", [(0, "1A45DFA3")]),
    ("avi", [(0, "52494646"), (8, "41564920")]),
    ("wav", [(0, "52494646"), (8, "57415645")]),
    ("mp3", [(0, "494433")]),
    ("ogg", [(0, "4F676753")]),
    ("flac", [(0, "664C6143")]),
    ("epub", [(0, "504B0304"), (30, "6D696D65747970656170706C69636174696F6E2F657075622B7A6970")]),
    ("rar", [(0, "526172211A07")]),
    ("7z", [(0, "377ABCAF271C")]),
    ("gz", [(0, "1F8B08")]),
    ("bz2", [(0, "425A68")]),
    ("xz", [(0, "FD377A585A00")]),
    ("zst", [(0, "28B52FFD")]),
    ("pdf", [(0, "25504446")]),
]
#: Major brands of the ISO media container, the four characters behind ``ftyp`` (fixed values).
BRANDS = {
    "avif": ["avif", "avis"],
    "heif": ["heic", "heix", "hevc", "hevx", "heim", "heis", "mif1", "msf1"],
    "mov": ["qt  "],
    "m4v": ["M4V ", "M4VH", "M4VP"],
    "m4a": ["M4A ", "M4B ", "M4P "],
    "3gp": ["3gp4", "3gp5", "3gp6", "3gp7", "3ge6", "3gg6", "3g2a"],
    "mp4": ["isom", "iso2", "iso4", "iso5", "iso6", "avc1", "mp41", "mp42", "mp71", "mmp4", "MSNV", "dash", "F4V "],
}
#: Folders by which office documents among zip files are told (fixed values).
OFFICE = {"docx": "word/", "xlsx": "xl/", "pptx": "ppt/"}


def detect_extension(content: Column) -> Column:
    """Extension that the leading bytes stand for, NULL if none is known or the content is NULL.

    Media containers go by their brand, an image that only says it is of the general kind (mif1, msf1) by the
    first compatible brand that says more. Zip files with a folder of an office format are that format.
    """
    head = F.hex(F.substring(content, 1, 64))
    at = lambda offset, signature: F.substring(head, 2 * offset + 1, len(signature)) == signature
    found = None
    for ext, parts in SIGNATURES:
        hit = at(*parts[0])
        for part in parts[1:]:
            hit = hit & at(*part)
        found = F.when(hit, F.lit(ext)) if found is None else found.when(hit, F.lit(ext))
    latin = F.decode(F.substring(content, 1, HEAD_BYTES), "ISO-8859-1")
    brand, others = F.substring(latin, 9, 4), F.substring(latin, 17, 16)
    general = brand.isin("mif1", "msf1") & (F.contains(others, F.lit("avif")) | F.contains(others, F.lit("avis")))
    media = F.when(general, F.lit("avif"))
    for ext, brands in BRANDS.items():
        media = media.when(brand.isin(*brands), F.lit(ext))
    zipped = F.lit("zip")
    for ext, folder in OFFICE.items():
        office = F.contains(latin, F.lit("[Content_Types].xml")) & F.contains(latin, F.lit(folder))
        zipped = F.when(office, F.lit(ext)).otherwise(zipped)
    return found.when(at(4, "66747970"), media).when(at(0, "504B0304"), zipped)


def head_of(content: Column) -> Column:
    return F.substring(content, 1, HEAD_BYTES)
